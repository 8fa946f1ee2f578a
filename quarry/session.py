"""Session helpers: one place that knows the engine settings the operators rely on."""

from __future__ import annotations

import os
import re
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings every job of the library expects. AQE re-plans joins from runtime sizes (this is the
# size check behind every join that is not hinted), coalesces small shuffle partitions and splits
# skewed ones; UTC makes epoch seconds and calendar keys repeatable.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "quarry", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    ``master`` defaults to ``local[$BENCH_CPUS or *]``; on a cluster pass nothing and let
    ``spark-submit`` decide. ``shuffle_partitions`` should follow the data size: a few hundred MB
    of shuffle input per partition.
    """
    b = SparkSession.builder.appName(app)
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    This is ``spark.checkpoint.dir`` as the cluster sets it (a shared file system every executor
    sees). Where it is unset, a local master (driver and executors in one process, as in tests) gets a fresh
    scratch folder; any other master is an error, since each executor would write to its own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def local_table(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A small table given by the caller (query words, ids) as a local relation.

    Spark knows its size in bytes, so joins broadcast it below ``spark.sql.autoBroadcastJoinThreshold``
    and shuffle it above, with no hint and no counting job.
    """
    fields = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields
    cols = [pa.array([r[i] for r in rows], to_arrow(f.dataType)) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.table(cols, names=[f.name for f in fields]), schema=StructType(fields))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size of ``df`` (exact for local relations) is below its broadcast threshold. For tables that hold
    no more than ``df`` does but whose size Spark cannot derive, such as per-query aggregates."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= conf.autoBroadcastJoinThreshold()


def to_arrow(dt) -> pa.DataType:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "double": pa.float64(),
             "boolean": pa.bool_()}
    return kinds[dt.simpleString()]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one written table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
