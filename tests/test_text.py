from pyspark.sql import functions as F

from conftest import rows
from quarry.functions import stemmers
from quarry.functions.text import html_attr_values, html_strip, words
from quarry.operators import index as ix


def test_words_fold_and_split(spark):
    df = spark.createDataFrame([("Hello, WORLD! Привет_мир 42x ÉTÉ",)], "t string")
    got = df.select(words("t").alias("w")).first()["w"]
    # É is not in the charset table: it separates words; Cyrillic capitals fold
    assert got == ["hello", "world", "привет_мир", "42x", "t"]


def test_tokenize_positions_per_field(idx):
    p = idx.postings.where("doc_id = 2")
    assert rows(p.where("field = 'title'"), "pos", "term") == [(0, "of"), (1, "the"), (2, "sea")]
    assert rows(p.where("field = 'body' and term = 'of'"), "pos") == [(1,), (5,)]


def test_lengths_and_stats(idx):
    assert rows(idx.lengths.where("doc_id = 5"), "field", "len") == [("title", 1)]  # empty body: no row
    n, avg = idx.docs.sparkSession.range(1).select(*idx.stats()).first()
    assert n == 6
    total = sum(r["len"] for r in idx.lengths.collect())
    assert abs(avg - total / 6) < 1e-12


def test_vocabulary(idx):
    v = {r["term"]: (r["docs"], r["hits"]) for r in idx.vocabulary().collect()}
    assert v["the"] == (4, 8)
    assert v["fox"] == (2, 5)
    assert v["привет"] == (1, 2)


def test_min_word_len_and_stopwords(spark, idx):
    p = ix.min_word_len(idx.postings, 4)
    assert p.where("char_length(term) < 4").count() == 0
    assert rows(p.where("doc_id = 1 and field = 'body'"), "pos", "term")[0] == (1, "quick")
    stop = spark.createDataFrame([("the",), ("of",)], "term string")
    s = ix.stopwords(idx.postings, stop)
    assert s.where("term in ('the', 'of')").count() == 0
    assert rows(s.where("doc_id = 2 and field = 'title'"), "pos", "term") == [(2, "sea")]


def test_html_strip_and_attrs(spark):
    html = ('<html><head><style>p{x}</style><script>var a="<b>";</script></head><body><!-- c -->'
            '<p>Fish &amp; chips</p><img src="a.png" alt="Red boat" title="Sea"><a href="/x" title="Go">link</a>'
            '</body></html>')
    df = spark.createDataFrame([(html,)], "h string")
    txt = df.select(html_strip("h").alias("t")).first()["t"]
    assert " ".join(txt.split()) == "Fish & chips link"
    attrs = df.select(html_attr_values(F.col("h"), {"img": ["alt", "title"], "a": ["title"]}).alias("a")).first()["a"]
    assert attrs == "Red boat Sea Go"


def test_query_tables_and_word_stats(spark, idx):
    q = ix.queries_from_texts(spark, {1: "The Fox", 2: "unknown words"})
    assert rows(q) == [(1, 0, "the"), (1, 1, "fox"), (2, 0, "unknown"), (2, 1, "words")]
    ws = ix.query_word_stats(q, idx.vocabulary())
    assert rows(ws) == [(1, "fox", 2, 5), (1, "the", 4, 8), (2, "unknown", 0, 0), (2, "words", 0, 0)]
    kw = ix.keywords(spark.createDataFrame([(1, "Fox DOGS")], "query_id int, text string"), idx)
    assert rows(kw, "qpos", "tokenized", "docs") == [(0, "fox", 2), (1, "dogs", 1)]


def test_attr_tokens(idx):
    t = ix.attr_tokens(idx.docs, "t", ["lang", "author_id"])
    got = rows(t.where("doc_id = 6"), "term")
    assert got == [("t_lang_en",)]  # author_id NULL gives no word


def test_porter_published_pairs():
    pairs = {
        "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
        "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
        "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
        "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
        "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
        "rational": "ration", "digitizer": "digit", "predication": "predic", "operator": "oper",
        "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
        "formaliti": "formal", "sensitiviti": "sensit", "triplicate": "triplic", "formative": "form",
        "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope",
        "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
        "airliner": "airlin", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
        "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
        "communism": "commun", "activate": "activ", "effective": "effect", "bowdlerize": "bowdler",
        "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
        "generalization": "gener", "connection": "connect",
    }
    bad = {w: (stemmers.porter_stem(w), s) for w, s in pairs.items() if stemmers.porter_stem(w) != s}
    assert not bad


def test_russian_stem():
    assert stemmers.russian_stem("вагоны") == "вагон"
    assert stemmers.russian_stem("важная") == "важн"
    assert stemmers.russian_stem("книги") == "книг"
    assert stemmers.enru_stem("running") == "run"
    assert stemmers.enru_stem("красивый") == "красив"


def test_morphology_on_index(spark, docs):
    idx = ix.build_index("m", docs, ("title", "body"), "doc_id", morphology="stem_en")
    terms = {r["term"] for r in idx.postings.select("term").distinct().collect()}
    assert "jump" in terms and "jumps" not in terms and "song" in terms
    sx = ix.normalize_terms(spark.createDataFrame([("robert",), ("rupert",)], "term string"), "soundex")
    assert {r["norm"] for r in sx.collect()} == {"R163"}
