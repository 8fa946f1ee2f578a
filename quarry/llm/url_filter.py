"""URL filtering: stated rules by host and path, association rules for the rest, in DataFrame functions only.

Labelled pages become baskets of URL tokens (host labels, path words, query keys). Spark's FP-growth mines
the token combinations that go with blocked pages; rules survive by support, confidence and lift, and a rule
goes when a shorter one with the same tokens is at least as confident. A surviving rule is filed under its
rarest token, so a page meets only rules that share a token with it (an inverted index), never all rules.

Edge cases: a null url or one without ``://`` has an empty host and path and no rule; repeated rows stay, one
result each; no labelled page, or labels of one kind only, gives no mined rule (verdict ``allow``); empty tables
give no rows; columns other than the id and the url are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = "label=block"
PIECE = 10_000  # repeats of one basket written by one task


def split_url(url: str = "url") -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a url column."""
    rest = F.expr(f"CASE WHEN instr(`{url}`, '://') > 0 THEN substring(`{url}`, instr(`{url}`, '://') + 3) ELSE '' END")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def stated_rule(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest of ``rules`` (host, path, verdict) that fits, as (rule, verdict), null where none
    does. A rule fits its host and every subdomain when the path starts with the rule's path. Rules are
    settings stated by the caller, tried longest first, so one expression per rule decides without a join."""
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def url_tokens(url: str, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: host labels, path words (runs of letters), query keys."""
    query = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "\\?([^#]*)", 1)
    return F.array_sort(F.array_distinct(F.concat(
        F.transform(F.filter(F.split(host, "[.]"), lambda x: x != ""), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(F.regexp_extract_all(path, F.lit("[A-Za-z]{2,}"), 0), lambda x: F.concat(F.lit("path:"), F.lower(x))),
        F.transform(F.regexp_extract_all(query, F.lit("([^&=]+)="), 1), lambda x: F.concat(F.lit("key:"), x)))))


def mine_rules(labelled: DataFrame, min_count: int = 20, min_share: float = 0.001, min_confidence: float = 0.6,
               min_lift: float = 1.2) -> tuple[DataFrame, DataFrame]:
    """Rules (tokens, index_token, confidence, support) from ``labelled`` (tokens, blocked boolean), and the classes
    (token, rep, freq) of the tokens they name: a rule holds for a url with any token of each of its classes.

    A rule's support is at least ``min_share`` of the labelled rows and ``min_count`` rows, so only tokens of that many
    blocked rows are mined. Tokens of exactly the same urls are one class, so that a long url repeated many times is one
    item, not every subset of its tokens; a class found in blocked rows only is a rule by itself (nothing longer is more
    confident) and is not mined."""
    rows = stored(labelled.groupBy("tokens").agg(F.count("*").alias("n"), F.sum(F.col("blocked").cast("long")).alias("bad")),
                  "url-baskets")
    total, bad = (x or 0 for x in rows.agg(F.sum("n"), F.sum("bad")).first())
    need = max(min_count, math.ceil(min_share * total))
    each = rows.select("n", "bad", F.xxhash64("tokens").alias("h1"), F.xxhash64(F.lit(1), "tokens").alias("h2"), F.explode("tokens").alias("token"))
    same = ["x1", "x2", "freq", "freq_bad"]
    counted = each.groupBy("token").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), F.sum("n").alias("freq"),
                                        F.sum("bad").alias("freq_bad")).where(F.col("freq_bad") >= need)
    classes = stored(counted.join(counted.groupBy(*same).agg(F.min("token").alias("rep")), same)
                     .select("token", "rep", "freq", "freq_bad"), "url-classes")
    sure = classes.where((F.col("token") == F.col("rep")) & (F.col("freq") == F.col("freq_bad")) & F.lit(total >= min_lift * bad))
    unsure = classes.where((F.col("token") == F.col("rep")) & (F.col("freq") > F.col("freq_bad")))
    fed = (rows.select("tokens", "n", "bad", F.explode("tokens").alias("token")).join(unsure.select("token"), "token")
           .groupBy("tokens", "n", "bad").agg(F.collect_list("token").alias("items"))
           .groupBy(F.array_sort("items").alias("items")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
           .select(F.inline(F.array(F.struct(F.array_append("items", BLOCK).alias("items"), F.col("bad").alias("n")),
                                    F.struct("items", (F.col("n") - F.col("bad")).alias("n"))))).where("n > 0"))
    # a basket as often as it occurs, a frequent one dealt to several tasks
    fed = fed.select("items", "n", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("long"), F.lit(PIECE).cast("long"))).alias("from"))
    fed = stored(fed.repartition("items", "from").select("items", F.explode(F.sequence(
        F.col("from"), F.least(F.col("from") + PIECE, F.col("n")) - 1)).alias("i")).select("items"), "url-baskets")
    n_fed = max(fed.count(), 1)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, need / n_fed), minConfidence=min_confidence).fit(fed)
    mined = (model.associationRules.where(F.array_contains("consequent", BLOCK) & (F.col("support") * n_fed >= need - 0.5)
                                          & (F.col("confidence") * total >= min_lift * bad))
             .select(F.array_sort("antecedent").alias("tokens"), "confidence", (F.col("support") * n_fed / total).alias("support")))
    rules = mined.unionByName(sure.select(F.array("rep").alias("tokens"), F.lit(1.0).alias("confidence"),
                                          (F.col("freq") / total).alias("support")))
    each = rules.select("tokens", "confidence", "support", F.explode("tokens").alias("token")).join(
        classes.select("token", "freq"), "token")
    indexed = stored(each.groupBy("tokens").agg(
        F.min(F.struct("freq", "token"))["token"].alias("index_token"), F.first("confidence").alias("confidence"),
        F.first("support").alias("support")), "url-rules")
    # a longer rule adds nothing when a shorter one inside it is as confident
    inner = indexed.select(F.col("tokens").alias("s_tokens"), F.col("index_token").alias("token"),
                           F.col("confidence").alias("s_conf"))
    longer = (indexed.select("tokens", "confidence", F.explode("tokens").alias("token")).join(inner, "token")
              .where((F.size("s_tokens") < F.size("tokens")) & (F.col("s_conf") >= F.col("confidence"))
                     & (F.size(F.array_except("s_tokens", "tokens")) == 0)).select("tokens").distinct())
    return stored(indexed.join(longer, "tokens", "left_anti"), "url-rules"), classes.select("token", "rep", "freq")


def match_rules(baskets: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct ``baskets`` (basket, tokens) that hold a token of every class of some rule, with the most confident rule:
    rows (basket, confidence, matched), ``matched`` being the basket's own tokens."""
    own = (baskets.select("basket", F.explode("tokens").alias("token")).join(classes.select("token", "rep"), "token")
           .groupBy("basket", "rep").agg(F.min("token").alias("own"))
           .groupBy("basket").agg(F.map_from_entries(F.collect_list(F.struct("rep", "own"))).alias("own")))
    held = F.map_keys("own")
    return (own.select("basket", "own", F.explode(held).alias("index_token"))
            .join(rules.select(F.col("tokens").alias("r"), "index_token", "confidence"), "index_token")
            .where(F.size(F.array_except("r", held)) == 0)
            .select("basket", "confidence", F.transform("r", lambda x: F.element_at(F.col("own"), x)).alias("r"))
            .groupBy("basket").agg(F.max(F.struct("confidence", "r")).alias("best"))
            .select("basket", F.col("best.confidence").alias("confidence"), F.col("best.r").alias("matched")))


def url_filter(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
               url_col: str = "url", **limits) -> DataFrame:
    """Judge every page. ``labels`` holds (id, blocked boolean) for some pages. Returns one row per page:
    id, host, path, rule, verdict, matched (tokens of the mined rule that blocked it), confidence."""
    host, path = split_url(url_col)
    rule, verdict = stated_rule(rules, F.col("host"), F.col("path"))
    judged = (pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host.alias("host"), path.alias("path"))
              .withColumns({"rule": rule, "_verdict": verdict, "tokens": url_tokens("_url", F.col("host"), F.col("path"))})
              .withColumn("basket", F.concat_ws(" ", "tokens")).drop("_url"))
    judged = stored(judged, "url-pages")
    known = labels.toDF("_id", "blocked").where("_id IS NOT NULL AND blocked IS NOT NULL").groupBy("_id").agg(
        F.max("blocked").alias("blocked"))
    mined, classes = mine_rules(judged.join(known, "_id").select("tokens", "blocked"), **limits)
    open_pages = judged.where("rule IS NULL").select("basket", "tokens").distinct()
    hits = stored(match_rules(open_pages, mined, classes), "url-hits")
    return (judged.join(hits, "basket", "left").select(
        F.col("_id").alias(id_col), "host", "path", "rule",
        F.coalesce("_verdict", F.when(F.col("matched").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("matched")).alias("matched"),
        F.when(F.col("rule").isNull(), F.col("confidence")).alias("confidence")))
