import os

from conftest import rows
from quarry.operators import index as ix
from quarry.operators import match as mt
from quarry.session import scratch_path
from quarry.streaming import delta as sd


def _write_batches(spark, docs, root):
    for i, part in enumerate([docs.where("doc_id <= 3"), docs.where("doc_id > 3")]):
        part.write.mode("overwrite").parquet(os.path.join(root, f"part{i}"))


def test_stream_equals_batch(spark, docs, idx):
    root = scratch_path(spark, "t-stream-src")
    _write_batches(spark, docs, root)
    out = scratch_path(spark, "t-stream-out")
    s = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(root)
    q = sd.stream_delta_index(s, ("title", "body"), out, scratch_path(spark, "t-stream-ckpt"), available_now=True)
    q.awaitTermination()
    got = sd.read_stream_index(spark, out, ("title", "body"))
    assert rows(got.postings, "term", "doc_id", "field", "pos") == rows(idx.postings, "term", "doc_id", "field", "pos")
    queries = ix.queries_from_terms(spark, [(1, 0, "the"), (1, 1, "fox")])
    aout = scratch_path(spark, "t-alerts")
    a = sd.stream_alerts(spark.readStream.schema(docs.schema).option("recursiveFileLookup", "true").parquet(root),
                         queries, ("title", "body"), aout, scratch_path(spark, "t-alerts-ckpt"), available_now=True)
    a.awaitTermination()
    assert rows(spark.read.parquet(aout).select("query_id", "doc_id")) == rows(mt.match_all(idx, queries))


def test_compaction_exchanges_no_texts(spark, docs, idx):
    """The replaced ids are counted and broadcast; files are compressed alike."""
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    delta = ix.build_index("d", docs.where("doc_id IN (2, 6)").withColumn("body", F.lit("new words of the sea")), ("title", "body"),
                           "doc_id", attrs=["lang", "source", "author_id", "created_on"])
    merged = mt.main_delta(idx, delta).settled()
    for table in (merged.docs, merged.texts, merged.lengths):  # was: hashed by their part of the ids
        assert "rightHint=(strategy=broadcast)" in table._jdf.queryExecution().optimizedPlan().toString()
    out = scratch_path(spark, "t-compact")
    once = sd.compact(idx, delta, out)
    assert rows(once.texts) == rows(mt.main_delta(idx, delta).texts) and rows(once.lengths) == rows(mt.main_delta(idx, delta).lengths)
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for d in ("lists", "words", "docs", "texts")
              for f in glob.glob(f"{out}/{d}/*.parquet") if pq.ParquetFile(f).metadata.num_rows}
    assert codecs == {"ZSTD"}


def test_a_table_streams_from_one_file_or_a_folder(spark, docs):
    """A stored table may be a folder of part files; each holds the same rows as one file."""
    root = scratch_path(spark, "t-table")
    docs.repartition(3).write.parquet(f"{root}/folder/documents.parquet")
    docs.coalesce(1).write.parquet(f"{root}/one")
    os.makedirs(f"{root}/file")
    part = next(f for f in os.listdir(f"{root}/one") if f.endswith(".parquet"))
    os.link(f"{root}/one/{part}", f"{root}/file/documents.parquet")
    for kind in ("folder", "file"):
        out = scratch_path(spark, f"t-table-{kind}")
        s = sd.read_table_stream(spark, f"{root}/{kind}", "documents", docs.schema)
        sd.stream_delta_index(s, ("title", "body"), out, scratch_path(spark, "t-table-ckpt"), available_now=True).awaitTermination()
        assert sorted(r["doc_id"] for r in spark.read.parquet(f"{out}/docs").collect()) == [1, 2, 3, 4, 5, 6]


def test_stream_facets_and_dedup(spark):
    root = scratch_path(spark, "t-ev")
    ev = spark.createDataFrame([(1, "2024-01-01 01:00:00", "a"), (2, "2024-01-01 02:00:00", "a"),
                                (3, "2024-01-02 01:00:00", "b"), (4, "2024-01-02 01:30:00", "a")],
                               "id long, ts string, k string").selectExpr("id", "cast(ts as timestamp) ts", "k")
    ev.write.parquet(root)
    s = spark.readStream.schema(ev.schema).parquet(root)
    out = sd.run_to_sink(sd.stream_facets(s, "ts", ["k"], window="1 day"), "t-facets")
    assert rows(spark.read.parquet(out), "k", "count") == [("a", 1), ("a", 2), ("b", 1)]


def test_stream_dedup_keeps_the_latest_version(spark):
    root = scratch_path(spark, "t-versions")
    batches = [[("a", "2024-01-01 00:00:00", "old"), ("b", "2024-01-01 00:00:00", "only")],
               [("a", "2024-01-05 00:00:00", "new"), ("a", "2024-01-04 00:00:00", "between")],
               [("c", "2024-01-05 00:00:00", "fresh")], [("a", "2024-01-01 12:00:00", "too late")]]
    schema = "k string, ts timestamp, v string"
    for part in batches:
        df = spark.createDataFrame(part, "k string, t string, v string").selectExpr("k", "timestamp(t) ts", "v")
        df.coalesce(1).write.mode("append").parquet(root)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(root)
    out = scratch_path(spark, "t-versions-out")
    sd.run_versions(sd.stream_dedup(s, ["k"], "ts"), out, scratch_path(spark, "t-versions-ckpt"), True).awaitTermination()
    written = spark.read.parquet(out)
    assert rows(sd.latest_versions(written, ["k"], "ts"), "k", "v") == [("a", "new"), ("b", "only"), ("c", "fresh")]
    assert written.where("v = 'too late'").count() == 0  # past the watermark


def test_stream_latest_keeps_one_state_row_per_key(spark):
    """A late row, an older version, a replayed file and expiry: rows written and state rows after every batch."""
    from quarry.streaming import latest as sl

    root, out = scratch_path(spark, "t-latest"), scratch_path(spark, "t-latest-out")
    batches = [[("a", "2024-01-01 00:00:00", "old"), ("a", "2024-01-01 01:00:00", "newer"), ("b", "2024-01-01 00:00:00", "only")],
               [("a", "2024-01-01 00:30:00", "between"), ("c", None, "no time"), ("b", "2024-01-01 00:00:00", "only")],
               [("a", "2024-01-05 00:00:00", "new")], [("d", "2024-01-05 01:00:00", "fresh")],
               [("b", "2024-01-01 12:00:00", "too late"), (None, "2024-01-05 00:00:00", "no key")]]
    written, state, ckpt = [], [], scratch_path(spark, "t-latest-ckpt")
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        for part in batches:
            df = spark.createDataFrame(part, "k string, t string, v string").selectExpr("k", "timestamp(t) ts", "v")
            df.coalesce(1).write.mode("append").parquet(root)
            s = spark.readStream.schema("k string, ts timestamp, v string").parquet(root)
            q = sd.run_versions(sl.stream_latest(s, ["k"], "ts"), out, ckpt, True)
            q.awaitTermination()
            written.append(sorted(r["v"] for r in spark.read.parquet(out).collect()))
            state.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    assert written[:2] == [["newer", "only"]] * 2  # older versions and replayed rows give nothing
    assert written[4] == sorted(["newer", "only", "new", "fresh", "no key"])
    got = sd.latest_versions(spark.read.parquet(out), ["k"], "ts")
    assert sorted((str(r["k"]), r["v"]) for r in got.collect()) == [("None", "no key"), ("a", "new"), ("b", "only"), ("d", "fresh")]
    assert state[0] == state[1] and state[4] < 3 * state[0]  # b is freed once the watermark has passed it


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["query_id", "doc_id", "weight", "lang", "source", "rank"]
    assert df.count() >= 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 90


def test_older_rows_of_a_task_do_not_reach_the_state():
    import pyarrow as pa

    from quarry.streaming.latest import _newest

    def batch(*rows):
        return pa.RecordBatch.from_pylist([dict(zip(("k", "t", "v", "x"), r)) for r in rows],
                                          pa.schema([("k", pa.string()), ("t", pa.int64()), ("v", pa.int64()), ("x", pa.float64())]))

    run = lambda *b: sorted((str(r["k"]), r["t"], r["v"]) for o in _newest(["k"], ["t", "v", "x"])(iter(b)) for r in o.to_pylist())
    a = batch(("a", 1, 9, 0.0), ("a", 2, None, 0.0), (None, 5, 2 ** 60 + 1, 0.0), ("b", 1, 1, 0.0))
    b = batch(("a", 2, 3, 0.0), (None, 5, 2 ** 60, 0.0))
    assert run(a, b) == [("None", 5, 2 ** 60 + 1), ("a", 2, 3), ("b", 1, 1)]
    assert len(run(a, batch(("a", 0, 0, float("nan"))))) == 5  # no order: all rows go on


def test_compaction_lists_documents_once(spark, monkeypatch):
    """Lists reach their ranges without a pass that only looks for the ranges, and replaced documents are not listed. A word of
    every document over several ranges, repeated and missing ids, a stored main; files are in order and do not overlap."""
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from quarry.operators import list_ranges as lr

    for name, few in (("CUT_DOCS", 20), ("CUT_KEYS", 200), ("RANGE_NUMBERS", 900), ("SMALL_NUMBERS", 100), ("PACK_ROWS", 7)):
        monkeypatch.setattr(lr, name, few)
    ids = [None, None, 7, 7, 40_000, *range(8, 90)]
    table = spark.createDataFrame([(i, f"the w{k % 9}" if k % 5 else None, f"the z{k} the ж{k % 4}") for k, i in enumerate(ids)],
                                  "doc_id long, title string, body string").repartition(3)
    main = ix.build_index("m", table, ("title", "body"), "doc_id", attrs=[])
    delta = ix.build_index("d", table.where("doc_id < 60 OR doc_id > 1000").withColumn("body", F.lit("the new end")), ("title", "body"), "doc_id", attrs=[])
    merged = mt.main_delta(main, delta).settled()
    plan = lr.lists_in_ranges(merged.sources(), 87)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # was: every document listed twice, the first time for the ranges only

    def table_of(df):
        return sorted((str((r["term"], r["doc_id"], r["tf"], sorted((a["field"], sorted(a["pos"])) for a in r["at"]))) for r in df.collect()))

    def sizes(df):
        return sorted(str(tuple(r)) for r in df.select("doc_id", "field", "len").collect())

    out = scratch_path(spark, "t-compact-once")
    once = sd.compact(main, delta, out)
    again = sd.compact(once, delta, f"{out}-again")
    want = table_of(merged.lists()), sizes(merged.lengths), rows(merged.vocabulary())
    for path, found in ((out, once), (f"{out}-again", again)):
        assert (table_of(found.lists()), sizes(found.lengths), rows(found.vocabulary())) == want
        spans = []
        for f in glob.glob(f"{path.removeprefix('file://').removeprefix('file:')}/lists/*.parquet"):
            keys = [(r["term"], -1 if r["doc_id"] is None else r["doc_id"]) for r in pq.read_table(f, columns=["term", "doc_id"]).to_pylist()]
            assert keys == sorted(keys)
            spans += [(keys[0], keys[-1], f)] if keys else []
        spans.sort()
        assert len(spans) > 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert sum(a[0][0] <= "the" <= a[1][0] for a in spans) > 1
        files = {(r["file"], r["first"], r["last"]) for r in spark.read.parquet(f"{path}/directory").where("tab = 'lists'").collect()}
        assert files == {(os.path.basename(f), a[0], b[0]) for a, b, f in spans}


def test_ids_are_tested_bit_by_bit(spark):
    import random

    from quarry.operators import bitmap as bm

    held = set(random.Random(2).sample(range(-40_000, 70_000), 30_000))
    ids = bm.id_bitmap(spark.createDataFrame([(i,) for i in held], "i long"))
    table = spark.createDataFrame([(i,) for i in range(-40_000, 70_000, 3)] + [(None,)], "doc_id long")
    assert {r[0] for r in bm.without(table, ids).collect()} == {i for i in range(-40_000, 70_000, 3) if i not in held} | {None}
    assert {r[0] for r in bm.within(table, ids).collect()} == {i for i in range(-40_000, 70_000, 3) if i in held}
