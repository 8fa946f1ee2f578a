import re

import corpus_pipeline as P
from quarry.llm import exact_dedup, near_dedup, toxicity
from quarry.llm.common import read
from tests.llm.helpers import edge_rows, near_components

SF = "/root/testdata/sf0.001"


def test_pipeline_matches_its_definition_stage_by_stage(spark):
    docs = read(spark, SF, "documents")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, read(spark, SF, "labels")).collect()}
    stay = {i for i in text if scores[i] < 0.5}

    groups = {}
    for i in stay:
        groups.setdefault(re.sub(exact_dedup.WHITE_SPACE, "", text[i]), []).append((-len(text[i]), i))
    stay = {min(g)[1] for g in groups.values()}

    comp = near_components([(i, text[i]) for i in sorted(stay)], 5, 80)
    stay = {i for i in stay if comp[i] == i}

    def plain(t):
        return " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)))

    items = [f" {plain(r['text'])} " for r in read(spark, SF, "benchmark").collect()]
    stay = {i for i in stay if not any(x in f" {plain(text[i])} " for x in items)}

    packed = P.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == stay
    size = {}
    for r in packed:
        size[r["doc_id"]] = size.get(r["doc_id"], 0) + r["length"]
    assert size == {i: len(re.findall(r"[^\x20\x09-\x0D]+", text[i])) + 1 for i in stay}


def test_stages_keep_the_columns_and_handle_empty_tables(spark):
    docs = read(spark, SF, "documents")
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs.limit(0), SF)
        assert out.columns == docs.columns and out.count() == 0
    assert P.pack(spark, docs.limit(0), SF).count() == 0


def test_near_stage_uses_five_words_and_four_fifths():
    import inspect

    signature = inspect.signature(near_dedup.near_dedup)
    assert signature.parameters["shingle"].default == 5 and signature.parameters["percent"].default == 80


def test_stages_keep_columns_whose_names_clash_or_hold_dots(spark):
    rows = [(i, t) for i, t in edge_rows() if i is not None]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", k, 1.5, "x", k) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, _row int, _score double, `a.b` string, _key int")
    ids = sorted({i for i, _ in rows})
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    tox = toxicity.drop_toxic(docs, labels)
    assert tox.schema == docs.schema and set(tox.collect()) <= set(docs.collect())
    near = near_dedup.near_dedup(docs)
    assert near.schema == docs.schema
    assert set(near.collect()) <= set(docs.collect()) and near.count() < docs.count()
