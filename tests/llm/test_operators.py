import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import chat_format, decontam, packing, queries, token_codec, toxicity, url_filter
from tests.llm.helpers import edge_docs, edge_rows, prose, words

# ---- op1


def test_block_round_trip_and_checks():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 255, 256, 257, 3000, 70000):
        for ids in (rng.integers(0, 50257, n), np.minimum(rng.zipf(1.2, n), 50256), np.full(n, 3)):
            block = token_codec.encode_block(ids.astype(np.uint32), 50257)
            assert (token_codec.decode_block(block) == ids).all()
    block = bytearray(token_codec.encode_block(np.arange(1000, dtype=np.uint32), 50257))
    block[-40] ^= 1
    with pytest.raises(ValueError):
        token_codec.decode_block(bytes(block))
    with pytest.raises(ValueError):
        token_codec.decode_block(bytes(block[:-7]))
    with pytest.raises(ValueError):
        token_codec.encode_block(np.array([9], np.uint32), 9)


def test_repetition_is_compressed():
    ids = np.tile(np.random.default_rng(1).integers(0, 50257, 500), 200).astype(np.uint32)
    assert len(token_codec.encode_block(ids, 50257)) < len(ids) * 4 / 10


TRICKY = ["", "a  b", " x", "a\n\nb", "tab\tq", "don't <|endoftext|> x.y, z", "é ñ 日本 語.", "a\n b", "x\r\ny", "12 34's 'll.",
          "<|endoftext|>", "a <|endoftext|>b", "x. <|endoftext|>\n<|endoftext|>", "end ", "a.\nB, c", "nul\x00x", "\u00a0y z", "x., y!. z"]


def test_pieces_equal_whole_text_encoding():
    from tokenizers import Tokenizer

    enc, plain = token_codec.PieceEncoder(queries.byte_bpe()), Tokenizer.from_file(queries.byte_bpe())
    texts = TRICKY + [t or "" for _, t in edge_rows()]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, np.uint32).tobytes() for t in texts]
    assert enc.encode(texts) == want == enc.encode(texts)
    assert np.frombuffer(want[TRICKY.index("<|endoftext|>")], np.uint32).tolist() == [50256]


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_codec, "BLOCK_TOKENS", 300)
    enc = token_codec.PieceEncoder(queries.byte_bpe())
    rows = edge_rows() + [(100 + k, t) for k, t in enumerate(TRICKY)]
    path = str(tmp_path / "tokens")
    token_codec.write_tokens(edge_docs(spark, rows), path, queries.byte_bpe())
    got = token_codec.with_start(spark, path, token_codec.read_tokens(spark, path)).collect()
    got = sorted(got, key=lambda r: r["start"])
    assert sorted((str(r["doc_id"]), zlib.crc32(r["ids"])) for r in got) == sorted(
        (str(i), zlib.crc32(enc._library([t or ""])[0] + (2).to_bytes(4, "little"))) for i, t in rows)
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    empty = str(tmp_path / "none")
    token_codec.write_tokens(edge_docs(spark).limit(0), empty, queries.byte_bpe())
    assert token_codec.read_tokens(spark, empty).count() == 0


# ---- op3


def plain_best_fit(lengths, tags, capacity):
    """Every bin is looked at for every piece."""
    bins, out = [], []
    for n, own in zip(lengths, tags, strict=True):
        fit = [(cap, k) for k, (cap, held) in enumerate(bins) if cap >= n and not held & own]
        if fit:
            k = min(fit)[1]
        else:
            bins.append([capacity, set()])
            k = len(bins) - 1
        out.append((k, capacity - bins[k][0]))
        bins[k] = [bins[k][0] - n, bins[k][1] | own]
    return out


def test_pieces_of_many_texts_are_the_librarys(monkeypatch):
    """Odd characters at every border, many texts at a time; long pieces and whole texts are not kept."""
    import random

    from tokenizers import Tokenizer

    rng = random.Random(1)
    some = [" ", "\n", "a", "B9", "\u00e9", "\u00d7", "\u00f7", "\u0178", ".", ",", "\u201c", "\u3001", "\u4e2d", "'s", "x" * 70]
    odd = ["  ", "\t", "\x00", "\u00a0", "\u2003", "\u3000", "\x85", "\u1680", "\u205f", "\x1c", "<|endoftext|>"]
    texts = ["".join(rng.choices(some if rng.random() < 0.8 else some + odd, k=rng.randint(0, 8))) for _ in range(3000)]
    enc, plain = token_codec.PieceEncoder(queries.byte_bpe()), Tokenizer.from_file(queries.byte_bpe())
    want = [np.array(x.ids, np.uint32).tobytes() for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want and enc.encode([]) == [] and enc.encode(["", ""]) == [b"", b""]
    assert enc.known and max(map(len, enc.known)) <= token_codec.PIECE_BYTES  # was: of any length, looked up one by one
    data, offsets = np.frombuffer("ab c\u00e9.\u00d7,\nqd  e".encode(), np.uint8), np.array([0, 0, 12, 16])
    starts, safe = token_codec.split_safely(data, offsets)
    assert starts.tolist() == [0, 2, 6, 10, 11, 12] and safe.tolist() == [True, True, False]


def test_best_fit_equals_plain_search():
    rng = random.Random(2)
    for trial in range(30):
        capacity = rng.choice([1, 7, 50, 64])
        n = rng.randint(1, 120)
        lengths = sorted((rng.randint(1, capacity) for _ in range(n)), reverse=True)
        tags = [{("s", rng.choice([0, 0, 0, 1, 2, 3])), ("c", rng.randint(0, n // 2))} if rng.random() < 0.9 else set()
                for _ in range(n)]
        number = {t: 1 << (k + 1) for k, t in enumerate(sorted({x for s in tags for x in s}))}
        bins, offsets = packing.best_fit(lengths, [sum(number[x] for x in s) for s in tags], capacity)
        assert list(zip(bins, offsets, strict=True)) == plain_best_fit(lengths, tags, capacity)


def test_pack_places_every_piece_once(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice([0, 3, 40, 100, 230, None]), rng.choice(["hot", "hot", "a", None]), rng.choice([1, 2, 3, k, None]), k)
            for k in range(400)] + [(None, 5, "a", 1, 0), (7, 100, "hot", 7, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, length int, source string, cluster int, shard int")
    out = packing.pack(docs, capacity=100, shard_rows=150).collect()
    assert sum(r["length"] for r in out) == sum(max(r[1] or 1, 1) for r in rows)
    meta = {}
    for r in rows:
        meta.setdefault(r[0], []).append(r)
    bins = {}
    for r in out:
        bins.setdefault(r["bin_id"], []).append(r)
    for held in bins.values():
        held.sort(key=lambda r: r["bin_offset"])
        ends = [r["bin_offset"] + r["length"] for r in held]
        assert [r["bin_offset"] for r in held] == [0, *ends[:-1]] and ends[-1] <= 100
        for col in (2, 3):
            if all(len(meta[r["doc_id"]]) == 1 for r in held):
                tags = [meta[r["doc_id"]][0][col] for r in held if meta[r["doc_id"]][0][col] is not None]
                assert len(tags) == len(set(tags))
    assert packing.pack(docs.limit(0)).count() == 0


def test_loose_bins_of_all_shards_are_packed_again(spark):
    rng = random.Random(11)
    rows = [(k if k % 5 else None, rng.randint(20, 70), None, None) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, length int, source string, cluster string")

    def bins(shard_rows):
        out = packing.pack(docs, capacity=100, shard_rows=shard_rows).collect()
        assert sorted(r["length"] for r in out) == sorted(r[1] for r in rows)
        held = {}
        for r in out:
            held.setdefault(r["bin_id"], []).append((r["bin_offset"], r["length"]))
        assert all(sum(n for _, n in h) <= 100 and len({a for a, _ in h}) == len(h) for h in held.values())
        return len(held)

    one, many = bins(1 << 20), bins(50)
    assert one <= many <= 1.01 * one


# ---- op4


def test_escape_is_reversible():
    for t in ("<|im_end|>", "<\\|x", "<\\\\|<|", "plain <| \\<", "<", ""):
        assert "<|" not in chat_format.escape(t) and chat_format.unescape(chat_format.escape(t)) == t
        assert chat_format.unescape_role(chat_format.escape_role(t + "\n\\n")) == t + "\n\\n"


def test_chat_examples_and_digest(spark):
    rows = [(1, 0, "system", "be <|im_start|>nice"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo <|im_end|>\n<\\|"),
            (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "bye"), (2, 0, "user", "alone"), (3, 0, "assistant", "x"),
            (3, 0, "assistant", "x"), (None, 0, "user", "q"), (None, 1, "assistant", "r"), (4, None, None, "t"),
            *[(5, k, ("user", "assistant")[k % 2], f"turn {k} " + "z" * 50) for k in range(300)]]
    turns = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn int, role string, text string, example string")
    examples = chat_format.chat_examples(turns)
    for r in examples.collect():
        said = chat_format.parse_turns(r["text"])
        assert said
        if r["loss_start"] is not None:
            assert said[-1] == ("assistant", chat_format.unescape(r["text"][r["loss_start"]:r["loss_end"]]))
    want = {}
    for c, _, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] or 0)):
        want.setdefault(c, []).append((role or "", text or ""))
    got = {r["conv_id"]: r for r in chat_format.chat_digest(examples).collect()}
    assert set(got) == set(want)
    for c, said in want.items():
        target = "".join(t for role, t in said if role == "assistant")
        r = got[c]
        assert r["n_turns"] == len(said) and r["loss_chars"] == len(target)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(target.encode()).hexdigest()
    assert chat_format.chat_digest(chat_format.chat_examples(turns.limit(0))).count() == 0


# ---- op6


def toxic_rows(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        w = prose(seed * 10000 + k, 40).split()
        bad = k % 6 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randint(0, len(w)), rng.choice(["zorgling", "Zorgful", "blekzorg"]))
        out.append((k, " ".join(w), int(bad)))
    return out


def test_toxicity_held_out_accuracy_and_edges(spark):
    rows = toxic_rows(600, 7)
    docs = edge_docs(spark, [(i, t) for i, t, _ in rows] + [(9000, None), (9001, ""), (None, "x"), (9002, prose(1, 30000))])
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(0, 1, 0), (9001, None, 0), (None, 1, 0)],
                                   "doc_id long, toxic int, quality int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == len(rows) + 4
    held = [(got[i]["predicted"], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    assert len(held) > 80 and sum(a == b for a, b in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    out = toxicity.drop_toxic(docs, labels)
    assert out.schema == docs.schema and {9000, 9001, 9002} <= {r["doc_id"] for r in out.collect()}
    assert toxicity.toxicity(docs, labels.limit(0)).where("score = 0.5").count() == len(rows) + 4
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_never_learned(spark):
    rows = toxic_rows(300, 9)
    docs = edge_docs(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(docs, x).collect()) for x in (labels, flipped))
    assert a == b


# ---- op8


def test_url_rules_and_split(spark):
    urls = ["https://a.example.org/es/1", "http://EXAMPLE.org/en/12?x=1", "http://example.org/en/2", "http://x.com/fr/?q", "ftp://x.com/de/9#a",
            "http://notorg/", "http://org", "http://org/", "nothing", None, "", "http://", "http://a.b?c://d/e", "x://y.COM/de/", "http://com/de"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filter.url_filter(
        pages, spark.createDataFrame([], "doc_id long, blocked boolean"), queries.URL_RULES).collect()}
    for k, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, default=(0, None, "allow"))
        assert (got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"]) == (host, path, rule[1], rule[2]), u


def test_mined_rules_block_by_tokens(spark):
    rng = random.Random(3)
    rows = []
    for k in range(600):
        bad = k % 3 == 0
        host = f"{'casino' if bad else 'news'}{'' if rng.random() < .9 else 'x'}.site{k % 7}.net"
        rows.append((k, f"http://{host}/{'win' if bad else 'read'}/{k}?ref=1", bad))
    pages = spark.createDataFrame([(k, u) for k, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(k, b) for k, _, b in rows if k % 2 == 0], "doc_id long, blocked boolean")
    got = {r["page_id"]: r for r in url_filter.url_filter(pages, labels, []).collect()}
    assert all((got[k]["verdict"] == "block") == b for k, _, b in rows)
    assert all(len(r["matched"]) == 1 for r in got.values() if r["verdict"] == "block")  # longer rules are redundant


def plain_rules(rows, need, confidence, lift):
    """Every token set by counting: support, confidence, lift, then without a shorter set as confident."""
    from itertools import combinations

    total, bad, seen = len(rows), sum(b for _, b in rows), {}
    for tokens, b in rows:
        for size in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), size):
                n, m = seen.get(part, (0, 0))
                seen[part] = (n + 1, m + b)
    good = {p: m / n for p, (n, m) in seen.items() if m >= need and m / n >= confidence and m / n * total >= lift * bad}
    return {p: c for p, c in good.items() if not any(good.get(q, -1) >= c for size in range(1, len(p)) for q in combinations(p, size))}


def test_mined_rules_equal_counting(spark):
    rng, rows = random.Random(11), []
    for k in range(900):
        hosts = rng.choice(["a.net", "a.org", "b.net", "c.b.org"])
        path = "/".join(sorted(rng.sample(["win", "read", "buy", "spin", "jackpot"], rng.randint(0, 3))))
        twin = "?ref=1&via=2" if k % 4 else "?ref=1"
        bad = ("win" in path and hosts.startswith("a")) or ("spin" in path and rng.random() < .7) or rng.random() < .1
        rows.append((k, f"http://{hosts}/{path}{twin}", bad))
    pages = spark.createDataFrame([(k, u) for k, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(k, b) for k, _, b in rows if k % 3], "doc_id long, blocked boolean")
    got = {r["page_id"]: r for r in url_filter.url_filter(pages, labels, [], min_share=0.03).collect()}

    def tokens(u):
        host, rest = u.split("://")[1].split("/", 1)
        path, query = rest.split("?")
        return {f"host:{x}" for x in host.split(".")} | {f"path:{x}" for x in path.split("/") if x} | {
            f"key:{x.split('=')[0]}" for x in query.split("&")}

    rules = plain_rules([(tokens(u), b) for k, u, b in rows if k % 3], 20, 0.6, 1.2)
    assert rules and any(len(p) > 1 for p in rules)
    for k, u, _ in rows:
        best = max((c for p, c in rules.items() if set(p) <= tokens(u)), default=None)
        assert (got[k]["verdict"] == "block") == (best is not None) and got[k]["confidence"] == pytest.approx(best), u
        assert best is None or set(got[k]["matched"]) <= tokens(u)


def test_a_long_url_repeated_is_one_item(spark):
    long = "http://h.net/" + "/".join(a + b for a in ("qu", "we", "rt", "yu", "io") for b in ("xa", "xb", "xc", "xd"))
    rows = [(k, long, k % 10 != 0) for k in range(60)] + [(k, f"http://n.org/p{'abc'[k % 3]}", False) for k in range(60, 200)]
    pages = spark.createDataFrame([(k, u) for k, u, _ in rows] + [(900, "http://z.org/weXC"), (901, None)], "page_id long, url string")
    labels = spark.createDataFrame([(k, b) for k, _, b in rows], "doc_id long, blocked boolean")
    got = {r["page_id"]: r for r in url_filter.url_filter(pages, labels, []).collect()}
    assert all((got[k]["verdict"] == "block") == (k < 60) for k, _, _ in rows)
    assert got[900]["matched"] == ["path:wexc"] and got[900]["confidence"] == pytest.approx(0.9)  # any token of the class
    assert got[901]["verdict"] == "allow"
    none = pages.where("page_id < 0")
    assert url_filter.url_filter(none, labels, queries.URL_RULES).count() == 0


# ---- op10


def test_common_subsequence_matches_table():
    rng = np.random.default_rng(8)
    for _ in range(40):
        a, b = (rng.integers(0, 6, rng.integers(1, 90)).astype(np.uint64) for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        assert decontam.common_subsequence(a, b) == best[-1, -1]


def contaminated_rows():
    items = [(k, prose(500 + k, 15 + k)) for k in range(40)] + [(90, None), (91, ""), (92, prose(500, 15))]
    rng = random.Random(6)
    docs, true = [], {}
    for k in range(120):
        body = prose(1000 + k, 120).split()
        if k % 3 == 0:
            item = items[k % 40][1].split()
            if k % 2:  # a paraphrase: a fifth of the words replaced, but not the last five
                for j in rng.sample(range(len(item) - 5), len(item) // 5):
                    item[j] = f"new{j}"
            at = rng.randint(0, len(body))
            body[at:at] = item
            true[k] = k % 40
        docs.append((k, " ".join(body)))
    return items, docs + [(500, None), (501, ""), (502, prose(77, 30000) + " " + items[3][1]), (None, items[5][1])], true | {502: 3}


def test_contamination_recall_and_clean_documents(spark):
    items, rows, true = contaminated_rows()
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int")
    docs = edge_docs(spark, rows)
    got = decontam.contamination(docs, bench).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"] for r in got if r["contaminated"]}
    assert found == set(true) | {None}  # every planted passage (recall 1.0) and no clean document
    assert all(r["item_id"] in (true[r["doc_id"]], 92) for r in got if r["contaminated"] and r["doc_id"] is not None)
    out = decontam.decontaminate(docs, bench)
    assert out.schema == docs.schema and out.count() == len(rows) - len(found)
    assert decontam.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert decontam.contamination(docs.limit(0), bench).count() == 0


def test_contamination_is_the_verdict_over_all_windows(spark):
    """Long, short and half-kept items, also with the words of little weight kept, against all windows and items."""
    lengths = [1, 2, 3, 4, 4, 5, 9, 16, 17, 33, 60, 99, 130, 200, 300, 300, 500]
    items = [(k, prose(700 + k, n)) for k, n in enumerate(lengths)]
    common = "the of and to in is it on as at by or".split()
    items += [(50 + k, " ".join(w + " " + common[j % 12] for j, w in enumerate(prose(800 + k, 10).split()))) for k in range(6)]
    rng, docs = random.Random(4), [(900, None), (901, "")]
    for k, (_, text) in enumerate(items * 5):
        item, body = text.split(), prose(2000 + k, rng.choice([5, 150, 900])).split()
        body = [w for pair in zip(body, rng.choices(common, k=len(body))) for w in pair]
        for j in rng.sample(range(max(0, len(item) - 5)), round(max(0, len(item) - 5) * (k // len(items)) / 6)):
            item[j] = rng.choice(common + [f"new{j}"])
        at = rng.randint(0, len(body))
        body[at:at] = item if k % 4 else [w for x in item for w in (x, "between")]
        docs.append((k, " ".join(body)))
    want = set()
    for i, text in docs:
        doc = np.array([hash(w) for w in (text or "").split()], np.int64)
        for _, t in items:
            item = np.array([hash(w) for w in t.split()], np.int64)
            starts = range(0, max(len(doc) - decontam.STEP, min(len(doc), 1)), decontam.STEP)
            if any(decontam.verdict(item, item[-5:], doc[max(0, s - len(item)): s + 2 * decontam.STEP + len(item)])[2] for s in starts):
                want.add(i)
                break
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(edge_docs(spark, docs), bench).collect()
    assert {r["doc_id"] for r in got if r["contaminated"]} == want and 40 < len(want) < len(docs)
    left = decontam.decontaminate(edge_docs(spark, docs), bench).collect()
    assert {r["doc_id"] for r in left} == {i for i, _ in docs} - want


def test_retrieval_recall_in_several_blocks_of_low_rank(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PASSAGES", 16)
    monkeypatch.setattr(decontam, "RANK", 8)
    items, rows, true = contaminated_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(edge_docs(spark, rows), bench).collect()
    found = {r["doc_id"] for r in got if r["contaminated"]} - {None}
    assert found <= set(true) and len(found) >= 0.9 * len(true)


def test_blocks_of_items_score_like_one_block(spark, monkeypatch):
    items, rows, true = contaminated_rows()
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), edge_docs(spark, rows)

    def scores():
        got = decontam.contamination(docs, bench).where("doc_id IS NOT NULL").collect()
        return {r["doc_id"]: (r["contaminated"], r["item_id"] and r["item_id"] % 92, r["lcs_share"], r["cosine"]) for r in got}

    one = scores()
    monkeypatch.setattr(decontam, "PASSAGES", 16)
    monkeypatch.setattr(decontam, "RANK", 8)
    many = scores()
    assert {k for k, v in many.items() if v[0]} == set(true)
    assert {k: v[:3] for k, v in many.items() if v[0]} == {k: v[:3] for k, v in one.items() if v[0]}


def test_latent_space_keeps_the_stated_weight_in_fewer_directions(spark):
    rng, topics = random.Random(3), [prose(40 + k, 40).split() for k in range(6)]
    texts = [" ".join(rng.sample(topics[k % 6], 30)) for k in range(60)] + [prose(99, 20)]
    rows = spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], "item_id long, text string, answer string")
    items = rows.mapInArrow(decontam._item_words(np.ones(1 << decontam.CELL_BITS, np.float32)), decontam.ITEM)
    held = sorted(items.collect(), key=lambda r: r["item_id"])
    terms, weights = ([np.frombuffer(r[c][0], kind) for r in held] for c, kind in (("terms", np.uint64), ("weights", np.float64)))
    used, basis, latent = decontam.latent_space(items, terms, weights)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-6)
    kept = (latent ** 2).sum(axis=1)
    assert kept.mean() >= decontam.ENERGY and kept.min() >= decontam.FLOOR and 7 <= basis.shape[1] < 30
    dense = np.zeros((len(texts), len(used)))
    for i, (t, w) in enumerate(zip(terms, weights, strict=True)):
        dense[i, np.searchsorted(used, t)] = w / np.linalg.norm(w)
    best = np.cumsum(np.linalg.svd(dense)[1] ** 2)
    assert abs(kept.sum() - best[basis.shape[1] - 1]) < 0.01 * len(texts)  # as good as the exact decomposition


def test_common_words_in_order_are_not_retrieved(spark):
    """An item's everyday words stand in order in any long text; its own words do not."""
    common = "the of and to in is it on as at by or".split()
    item = " ".join([*prose(5, 7).split(), *common[:8]])
    docs = [(k, " ".join(w for x in prose(60 + k, 300).split() for w in (x, common[len(x) * 7 % 12]))) for k in range(30)]
    docs = [(k, t + " " + " ".join(common[:8])) for k, t in docs] + [(99, prose(7, 90) + " " + item)]
    got = decontam.contamination(edge_docs(spark, docs), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r["doc_id"] for r in got if r["contaminated"]} == {99}


def test_words_split_like_the_definition():
    from quarry.llm.common import text_bytes
    from quarry.llm.words import byte_tables, row_shingles, word_hashes
    import pyarrow as pa

    texts = [t for _, t in edge_rows()]
    hashes, ends = word_hashes(*text_bytes(pa.array(texts)), *byte_tables())
    assert np.diff(ends).tolist() == [len(words(t)) for t in texts]
    sets = row_shingles(hashes, ends, 3)
    assert (sets[0] == sets[1]).all() and (sets[0] == sets[8]).all()


# ---- op6 against plain code


def plain_cells(text):
    """Cells of the 3- to 5-character grams of one text, gram by gram."""
    chars, out = [ord(c) for c in f" {text} ".lower()], set()
    for n in toxicity.ORDERS:
        for i in range(len(chars) - n + 1):
            poly = 0
            for c in chars[i: i + n]:
                poly = (poly * 0x01000193 + c) % (1 << 32)
            cell = (poly * 0x9E3779B1) % (1 << 32) ^ ((poly >> 15) * (0x85EBCA77 + 2 * n)) % (1 << 32)
            out.add(cell >> (32 - toxicity.FEATURE_BITS))
    return out


def plain_scores(rows, label, steps=150, l1=3e-4):
    """Log-count ratios, proximal gradient fit on a dense table and scores of ``rows`` (id, text), learned from ``label``."""
    held = {i: plain_cells(t or "") for i, t in rows}
    train = sorted(label)
    n = [sum(1 for i in train if label[i] == k) for k in (0, 1)]
    ratio = {}
    for cell in set().union(*(held[i] for i in train)):
        count = [sum(cell in held[i] for i in train if label[i] == k) for k in (0, 1)]
        neg, pos = count[0] + 0.5, count[1] + 0.5
        r = np.log(pos / (n[1] + 1)) - np.log(neg / (n[0] + 1))
        if sum(count) >= toxicity.MIN_ROWS and abs(r) / np.sqrt(1 / pos + 1 / neg) >= toxicity.MIN_Z:
            ratio[cell] = r
    cells = sorted(ratio)
    table = lambda ids: np.array([[ratio[c] * (c in held[i]) for c in cells] for i in ids])
    x, y = table(train), np.array([label[i] for i in train], float)
    w, b = np.zeros(len(cells)), np.log(n[1] / n[0])
    g2, gb2 = np.full(len(cells), 1e-8), 1e-8
    for _ in range(steps):
        e = 1 / (1 + np.exp(-(x @ w + b))) - y
        g, gb = x.T @ e / len(y), e.mean()
        g2, gb2 = g2 + g * g, gb2 + gb * gb
        rate = 0.3 / np.sqrt(g2)
        w = w - rate * g
        w = np.sign(w) * np.maximum(abs(w) - rate * l1, 0)
        b -= 0.3 * gb / np.sqrt(gb2)
    ids = [i for i, _ in rows]
    return dict(zip(ids, 1 / (1 + np.exp(-(table(ids) @ w + b))), strict=True))


def test_toxicity_equals_plain_code(spark):
    rng = random.Random(5)
    rows = []
    for k in range(160):
        bad = ["vile", "rotten", "scum"] if k % 3 == 0 else ["calm", "kind", "warm"]
        rows.append((k, " ".join(rng.choice(bad + ["the", "of", "and", "river", "É1"]) for _ in range(rng.randint(0, 12)))))
    rows += [(200, None), (201, "")]
    label = {k: int(k % 3 == 0) for k in range(160) if zlib.crc32(str(k).encode()) % 5}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(160)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    want = plain_scores(rows, label)
    assert got.keys() == want.keys() and max(want.values()) > 0.9 and min(want.values()) < 0.1
    assert max(abs(got[k] - want[k]) for k in want) < 1e-3


def test_new_words_go_through_the_library_many_at_a_time():
    """op1: words are split already when they reach the library; ids stay those of whole texts."""
    from tokenizers import Tokenizer

    rnd = random.Random(5)
    letters = "abzAZéßñžЖяԱΩ²½ªʰ１٣́0179'-.,԰ՠ" + "​"
    words = ["".join(rnd.choices(letters, k=rnd.randrange(1, 9))) for _ in range(3000)]
    words += ["".join(rnd.choices("abcdeéñж", k=rnd.randrange(1, 70))) for _ in range(2000)] + [str(rnd.randrange(10**9)) for _ in range(500)]
    texts = ["\n".join(" ".join(rnd.choices(words, k=rnd.randrange(1, 40))) for _ in range(3)) for _ in range(300)]
    enc, plain = token_codec.PieceEncoder(queries.byte_bpe()), Tokenizer.from_file(queries.byte_bpe())
    calls, library = [], enc._library
    enc._library = lambda t, *of: calls.append(len(t)) or library(t, *of)
    got = enc.encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, np.uint32).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert sum(calls) < len(enc.known)  # was: one call's text for every new piece


def test_pieces_in_use_outlast_the_cache(monkeypatch):
    """op1: a full cache lets go of what was not met lately, not of everything."""
    monkeypatch.setattr(token_codec, "PIECE_CACHE", 20)
    enc = token_codec.PieceEncoder(queries.byte_bpe())
    calls, library = [], enc._library
    enc._library = lambda t, *of: calls.extend(t) or library(t, *of)
    for k in range(12):
        enc.encode([f"kept {' '.join(str(1000 * k + i) for i in range(8))}"])
        assert len(enc.known) + len(enc.older) <= 20 + 2 * 9
    assert sum("k" in t.lower() for t in calls) == 1


def test_marks_after_words_are_pieces_of_their_own():
    """op1: a word is met once whatever follows it; new words reach the library without anything between but spaces."""
    from tokenizers import Tokenizer

    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()] + ["***", "!!", "''s", "'ll", ").", "\"'t"]
    words = ["ab", "café", "B9", "12", "één", "жу"]
    texts = [f"{w} {w}{m} x{m}{w}{m}\n{m}{w} {m} {w}{m}" for w in words for m in marks]
    enc, plain = token_codec.PieceEncoder(queries.byte_bpe()), Tokenizer.from_file(queries.byte_bpe())
    sent, library = [], enc._library
    enc._library = lambda t, *of: sent.extend(t if of and of[0] else []) or library(t, *of)
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, np.uint32).tobytes() for t in texts]
    assert enc.encode(texts) == want
    assert {b" ab", b" caf\xc3\xa9", b"***"} <= enc.known.keys()
    assert not {b" ab***", b" 12***", b" caf\xc3\xa9#"} & enc.known.keys()  # was: a piece for every word and mark
    assert sent and not any("Ċ" in t for t in sent)  # was: a newline after every word


def test_plain_words():
    pieces = [b" ab", b"ab", b" 12", b"3", b" a1", b" ", b"a.", b" caf\xc3\xa9", b"\xc3\x97", b" \xc3\xb7a", b"\xd0\xb6", b"\n", b"  a", b"a\xc2\xaa"]
    assert token_codec.plain_words(pieces).tolist() == [True] * 4 + [False] * 3 + [True] + [False] * 6
    assert token_codec.plain_words([]).tolist() == []


def test_block_bytes_stay_the_same():
    """op1: files written before can be read."""
    for n, crc in [(1, 2183311521), (257, 473537163), (5000, 1842682769), (100000, 2435554512)]:
        k = np.arange(n, dtype=np.int64)
        ids = np.where(k % 3 == 0, k * k * 2654435761 % 50257, k // 7 % 40).astype(np.uint32)
        block = token_codec.encode_block(ids, 50257)
        assert zlib.crc32(block) == crc and (token_codec.decode_block(block) == ids).all()
