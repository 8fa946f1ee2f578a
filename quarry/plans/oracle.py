"""SQL building blocks for the DuckDB oracle: the same stand-ins and word splitting as the Spark side.

Only the oracle uses these; the library never parses or plans SQL itself.
"""

from __future__ import annotations

from quarry.functions.text import LOWER_CHARS, UPPER_CHARS, WORD_PATTERN
from quarry.sources.standins import CORPUS_EPOCH, N_AUTHORS


def fold_sql(x: str) -> str:
    return f"translate({x}, '{UPPER_CHARS}', '{LOWER_CHARS}')"


def words_sql(x: str) -> str:
    return f"regexp_extract_all({fold_sql(x)}, '{WORD_PATTERN}')"


def values_sql(rows: list[tuple], cols: str) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({cols}))"


CORPUS = (
    "corpus AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, text AS body, lang, source, "
    f"doc_id % {N_AUTHORS} AS author_id, "
    f"TIMESTAMP '{CORPUS_EPOCH}' + to_hours(CAST(doc_id AS INTEGER)) AS created_on, "
    "radians(doc_id % 180 - 90) AS lat, radians(doc_id % 360 - 180) AS long FROM documents)"
)
FIELDS = ("fields AS (SELECT doc_id, 'title' AS field, title AS txt FROM corpus "
          "UNION ALL SELECT doc_id, 'body' AS field, body AS txt FROM corpus)")
TOKS = f"toks AS (SELECT doc_id, field, {words_sql('txt')} AS t FROM fields)"
POSTINGS = "postings AS (SELECT doc_id, field, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS pos FROM toks)"
INDEX = f"{CORPUS}, {FIELDS}, {TOKS}, {POSTINGS}"
STATS = ("stats AS (SELECT (SELECT count(*) FROM corpus) AS n_docs, "
         "CAST((SELECT count(*) FROM postings) AS DOUBLE) / (SELECT count(*) FROM corpus) AS avgdl)")


def bm25_ctes(q: str = "qv") -> str:
    """CTEs bm (query_id, doc_id, bm25) and sidf (query_id, sum_idf) for queries view ``q``."""
    return f"""{STATS},
qd AS (SELECT DISTINCT query_id, term FROM {q}),
nt AS (SELECT p.term, count(DISTINCT p.doc_id) AS n FROM postings p JOIN (SELECT DISTINCT term FROM qd) USING (term) GROUP BY p.term),
idf AS (SELECT term, ln(1 + (CAST((SELECT n_docs FROM stats) AS DOUBLE) - n + 0.5::DOUBLE) / (n + 0.5::DOUBLE)) AS idf FROM nt),
tf AS (SELECT qd.query_id, p.doc_id, p.term, count(*) AS tf FROM postings p JOIN qd USING (term) GROUP BY ALL),
dl AS (SELECT doc_id, count(*) AS dl FROM postings GROUP BY doc_id),
bm AS (SELECT tf.query_id, tf.doc_id, sum(idf.idf * tf.tf * 2.2::DOUBLE / (tf.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl.dl / (SELECT avgdl FROM stats)))) AS bm25
       FROM tf JOIN idf USING (term) JOIN dl USING (doc_id) GROUP BY ALL),
sidf AS (SELECT qd.query_id, sum(coalesce(idf.idf, 0)) AS sum_idf FROM qd LEFT JOIN idf USING (term) GROUP BY qd.query_id)"""


def lcs_ctes(q: str = "qv") -> str:
    """CTE pf (query_id, doc_id, field, lcs, hits, n_words) for queries view ``q``."""
    return f"""h AS (SELECT q.query_id, q.qpos, p.term, p.doc_id, p.field, p.pos FROM postings p JOIN {q} q USING (term)),
isl AS (SELECT query_id, doc_id, field, pos - qpos AS diag,
               qpos - row_number() OVER (PARTITION BY query_id, doc_id, field, pos - qpos ORDER BY qpos) AS island FROM h),
runs AS (SELECT query_id, doc_id, field, diag, island, count(*) AS run FROM isl GROUP BY ALL),
lcs AS (SELECT query_id, doc_id, field, max(run) AS lcs FROM runs GROUP BY ALL),
cnt AS (SELECT query_id, doc_id, field, count(*) AS hits, count(DISTINCT term) AS n_words FROM h GROUP BY ALL),
pf AS (SELECT * FROM lcs JOIN cnt USING (query_id, doc_id, field))"""


# Fixed value: the reflected CRC-32 polynomial (IEEE 802.3, as zlib), 0xEDB88320.
CRC32_POLY = 0xEDB88320


def crc32_sql(x: str) -> str:
    """CRC32 of the UTF-8 bytes of ``x``, bit by bit (DuckDB has no crc32 function)."""
    byts = (f"list_transform(range(0, octet_length(encode({x}))), "
            f"lambda i: ('0x' || substr(hex(encode({x})), 2 * i + 1, 2))::BIGINT)")
    step = f"lambda r, k: xor(r >> 1, CASE WHEN r & 1 = 1 THEN {CRC32_POLY} ELSE 0 END)"
    return (f"xor(list_reduce({byts}, lambda acc, b: list_reduce(range(8), {step}, xor(acc, b)), "
            f"4294967295), 4294967295)")


# American Soundex digit per letter A..Z, as Spark's soundex uses them
# (0 = vowel-like, dropped; 7 = H and W, skipped without breaking a run).
SOUNDEX_CODES = "01230127022455012623017202"


def soundex_sql(x: str) -> str:
    """Spark's ``soundex``: a word not starting with an ASCII letter is kept as it is; else the
    upper-cased first letter, then the digits of the following letters (a digit equal to the
    previous one is skipped, any non-letter resets it), padded or cut to four characters."""
    code = f"substr('{SOUNDEX_CODES}', ascii(upper(c)) - 64, 1)"
    first = f"upper(substr({x}, 1, 1))"
    step = (f"lambda a, c: CASE WHEN NOT regexp_full_match(c, '[A-Za-z]') THEN {{'s': a.s, 'l': '0'}} "
            f"WHEN {code} = '7' THEN a "
            f"WHEN {code} <> '0' AND {code} <> a.l AND length(a.s) < 4 THEN {{'s': a.s || {code}, 'l': {code}}} "
            f"ELSE {{'s': a.s, 'l': {code}}} END")
    init = f"{{'s': {first}, 'l': substr('{SOUNDEX_CODES}', ascii({first}) - 64, 1)}}"
    fold = f"list_reduce(string_split(substr({x}, 2), ''), {step}, {init}).s"
    return (f"CASE WHEN {x} = '' OR NOT regexp_matches({x}, '^[A-Za-z]') THEN {x} "
            f"ELSE rpad(CASE WHEN length({x}) = 1 THEN {first} ELSE {fold} END, 4, '0') END")
