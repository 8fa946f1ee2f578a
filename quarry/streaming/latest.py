"""The latest version of every key of a stream, with one state row per key.

A stateful processor keeps each key's newest row and a timer at that row's time. Once the watermark has passed it, every row
that may still arrive is newer, so the timer frees the state. Older versions and rows behind the watermark give nothing;
a replayed batch finds its rows in the state and gives nothing either.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from quarry.streaming.delta import LOOKBACK

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# ---- fixed values: rows of a task that are brought down to the newest of each key at a time ----
COMBINED_ROWS = 500_000
# ---- end of fixed values ----


def _newest(keys: list[str], order: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The newest row of every key among the next rows of a task, by the order of ``_order``."""

    def combine(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        if any(pa.types.is_floating(c.type) and pc.any(pc.is_nan(c)).as_py() for c in rows.columns):
            yield from batches  # not a number has no place in that order
            return
        rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in order], null_placement="at_start"))
        at = rows.append_column("_at", pa.array(range(rows.num_rows), pa.int64()))
        last = at.select([*keys, "_at"]).group_by(keys, use_threads=False).aggregate([("_at", "max")])
        yield from rows.take(last["_at_max"]).combine_chunks().to_batches()

    def newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for b in batches:
            kept, n = [*kept, b], n + b.num_rows
            if n >= COMBINED_ROWS:
                yield from combine(kept)
                kept, n = [], 0
        if kept:
            yield from combine(kept)

    return newest


def _order(row: tuple) -> tuple:
    """Time first, then the other columns; null before any value."""
    plain = (v.timestamp() if isinstance(v, datetime) else v for v in row)
    return tuple((v is not None, v) if v is not None else (False,) for v in plain)


class Latest(StatefulProcessor):
    """State and output: the time in microseconds and the other columns of a key's newest row."""

    def __init__(self, keys: list[str], fields: list[str], schema: T.StructType):
        self.keys, self.fields, self.schema = keys, fields, schema

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = max((tuple(r[f] for f in self.fields) for r in rows), key=_order)
        old = self.newest.get()  # None for a new key
        old = tuple(old) if old is not None else None
        if old is not None and _order(new) <= _order(old):
            return
        if old is not None:
            self.handle.deleteTimer(old[0] // 1000)
        self.newest.update(new)
        self.handle.registerTimer(new[0] // 1000)
        yield Row(**dict(zip([*self.keys, *self.fields], [*key, *new], strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_latest(stream: DataFrame, keys: list[str], ts_col: str, delay: str = LOOKBACK) -> DataFrame:
    """Every key's newest row (by ``ts_col``, then the other columns) whenever it changes, in update mode; rows later than
    ``delay`` are dropped, and so are rows without a time. Write it with ``run_versions``; ``latest_versions`` picks
    each key's newest from what was written. Needs the RocksDB state store, which it sets for the session."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rest = [c for c in stream.columns if c != ts_col and c not in keys]
    fields = ["_micros", *rest]
    s = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).where(F.col(ts_col).isNotNull())
    if not any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in s.schema.fields):
        s = s.mapInArrow(_newest(keys, [ts_col, *rest]), s.schema)  # the older rows of a task need not meet the state
    s = s.withWatermark(ts_col, delay).withColumn("_micros", F.unix_micros(ts_col))
    of = {f.name: f.dataType for f in s.schema.fields}
    state, out = (T.StructType([T.StructField(n, of[n], True) for n in names]) for names in (fields, [*keys, *fields]))
    newest = s.groupBy(*keys).transformWithState(Latest(keys, fields, state), out, "Update", "EventTime")
    return newest.select(*keys, F.timestamp_micros("_micros").alias(ts_col), *rest)
