"""Token-id files: an adaptive context-mixing range coder in independent, checksummed blocks.

Texts are tokenized with the given tokenizer, an end id is appended to each, and the ids are written in
ascending id order as blocks of whole documents. Every block starts from an empty model and carries a
CRC-32 of its ids, so any block can be read alone and a damaged one is an error, not wrong ids.

Model. Three predictions are mixed for the next id: order 0 (how often ids occurred in the block so far),
order 1 (the id that last followed the previous id) and order 2 (the id that last followed the previous two).
The order-1 and order-2 predictions are point masses whose weights are learned as the block goes, separately for
every pair of their hit counters; order 0 gets the rest. The mixed distribution drives a 64-bit range coder.
A block is coded as many short lanes side by side that share one model: at each step all lanes code one id
under the current model, then the model learns from all of them. That keeps the work in whole-array
operations and one block's model in cache.

Files are Parquet rows, one per block: part and block number, document ids and lengths, payload. Spark's writer
commits them, so they survive lost executors and live wherever Spark can write.

Edge cases: null text is empty (its only id is the end id); null ids sort first; rows that share an id are ordered by
a hash of their text; very long documents make one longer block (a document is never split); an empty table
writes no block; other columns are not read; ids outside the vocabulary are an error.
"""

from __future__ import annotations

import codecs
import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import shuffle_partitions, text_bytes

BLOCK_TOKENS, STEPS = 1 << 20, 256
ORDER0_BITS, TOTAL_BITS, SLOT_BITS = 18, 24, 18
TOP_HITS = 7
MAGIC = b"TKB1"
HEADER = "<4sQIII"
HEADER_BYTES = struct.calcsize(HEADER)
BLOCKS = "part int, block int, doc_ids array<long>, lengths array<long>, n_tokens long, payload binary"
PIECE_CACHE, PIECE_BYTES, TEXT_BYTES, JOINED = 600_000, 64, 1 << 23, 512
# texts whose white space is single spaces and newlines between other characters split safely before each
UNSAFE = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z|\x00")
# the characters that stand for bytes in a byte-level vocabulary; here a tab, which no word holds, becomes a plain space
SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
HIDDEN = [b for b in range(256) if b not in SHOWN]
ALPHABET = "".join(" " if b == 9 else chr(b if b in SHOWN else 256 + HIDDEN.index(b)) for b in range(256))
# one word of the pattern: digits, or (if letters all) characters up to U+04FF
WORD = re.compile(rb" ?(?:[0-9]+|[\x41-\x5A\x61-\x7A\x80-\xD3]+)")
# by bytes: kinds that a split looks at
SPACE, NEWLINE, STOP, LETTER, DIGIT, ODD, LATIN, LEAD = (1 << k for k in range(8))
KIND = np.zeros(256, np.uint8)
KIND[0x21:0x7F] = STOP
KIND[0x20], KIND[0x0A], KIND[0xC3], KIND[0x30:0x3A] = SPACE, NEWLINE, LATIN, DIGIT
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KIND[[0, 0x09, *range(0x0B, 0x0E), *range(0x1C, 0x20)]] = ODD  # no text that holds one splits safely
KIND[[0xC2, 0xE1, 0xE2, 0xE3]] = LEAD  # the first bytes of all other white space


def split_safely(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of UTF-8 texts laid end to end begin (a text's first byte does), and per text whether it splits at
    all: before a single space, around a single newline, and before a mark of ASCII that follows a letter (of Latin-1) or
    digit. Texts with a character that may be other white space are looked at one by one."""
    kind = KIND[data]
    full = offsets[1:] > offsets[:-1]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    white = (kind & (SPACE | NEWLINE)) != 0
    bad = (kind & ODD) != 0
    bad[1:] |= white[1:] & white[:-1]
    bad[first] = (kind[first] & (SPACE | NEWLINE | ODD)) != 0  # whatever the text before ends with
    bad[last] |= white[last]
    def none(at):
        place = np.searchsorted(at, offsets)
        return place[1:] == place[:-1]

    safe = none(np.flatnonzero(bad))
    lead = np.flatnonzero((kind[:-1] & LEAD) != 0)
    one, two = data[lead], data[lead + 1]
    odd = np.where(one == 0xC2, (two == 0x85) | (two == 0xA0), (two == 0x9A) & (one == 0xE1) | (two == 0x80) & (one >= 0xE2) |
                   (two == 0x81) & (one == 0xE2))
    for t in np.flatnonzero(safe & ~none(lead[odd])):
        safe[t] = not UNSAFE.search(data[offsets[t]:offsets[t + 1]].tobytes().decode())
    starts = white.copy()
    starts[1:] |= (kind[:-1] & NEWLINE) != 0
    letter = (kind & (LETTER | DIGIT)) != 0
    letter[1:] |= ((kind[:-1] & LATIN) != 0) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    starts[1:] |= ((kind[1:] & STOP) != 0) & letter[:-1]
    for t in np.flatnonzero(~safe):
        starts[offsets[t]:offsets[t + 1]] = False
    starts[first] = True
    return np.flatnonzero(starts), safe


def plain_words(pieces: list[bytes]) -> np.ndarray:
    """Per piece whether it is one word of the pattern, of digits or of letters of Latin-1, with or without a space before."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    starts, data = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(pieces), np.uint8)
    if not len(data):
        return np.zeros(len(pieces), bool)
    kind = KIND[data]
    letter = (kind & (LETTER | LATIN)) != 0
    letter[1:] |= ((kind[:-1] & LATIN) != 0) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    long = sizes - (data[starts] == 0x20)
    count = [np.add.reduceat(x, starts, dtype=np.int32) for x in (letter, (kind & DIGIT) != 0)]
    return (long > 0) & ((count[0] == long) | (count[1] == long))


class PieceEncoder:
    """Ids of whole texts from a ``tokenizers`` file. The byte-level pattern always splits before a single
    space, around a single newline and between a word and a mark, so such pieces are encoded once and
    looked up; a text with any other white space, or with the string of an added token (which the library takes
    out first), goes through the library whole. Pieces are found and looked up by whole arrays. New ones that
    are one word of the pattern go through the library's model many at a time, already split."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size()
        # pieces met since the last turn and before it; at a turn those not met since are let go
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.split = Tokenizer(self.tokenizer.model)  # the same model
        self.split.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.tokenizer.get_vocab()
        # bytes that an id stands for
        self.width = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        self.width[list(vocab.values())] = list(map(len, vocab))
        self.splits = (self.tokenizer.normalizer is None and isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
                       and all(x in vocab for x in ALPHABET if x != " "))

    def _library(self, texts: list[str], tokenizer=None) -> list[bytes]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32).tobytes() for x in found]

    def _new(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces that were not met before. ``JOINED`` words at a time, with spaces between, are written in the
        vocabulary's characters; the bytes that their ids stand for must end where the words do."""
        out: list[bytes | None] = [None] * len(pieces)
        words = [i for i, plain in enumerate(plain_words(pieces).tolist()) if len(pieces[i]) <= PIECE_BYTES and (
            plain or WORD.fullmatch(pieces[i]) and pieces[i].decode().lstrip(" ").isalpha())] if self.splits else []
        groups = [words[at:at + JOINED] for at in range(0, len(words), JOINED)]
        texts = [codecs.charmap_decode(b"\t".join([pieces[i] for i in g]), "strict", ALPHABET)[0] for g in groups]
        for group, found in zip(groups, self._library(texts, self.split), strict=True):
            upto = np.cumsum(self.width[np.frombuffer(found, np.uint32)])
            ends = np.cumsum([len(pieces[i]) for i in group])
            at = np.searchsorted(upto, ends)
            if len(upto) and upto[-1] == ends[-1] and (upto[at] == ends).all():
                cuts = ((at + 1) * 4).tolist()
                for i, a, b in zip(group, [0, *cuts], cuts):
                    out[i] = found[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, found in zip(rest, self._library([pieces[i].decode() for i in rest]), strict=True):
            out[i] = found
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        out: list[bytes | None] = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if any(x in t for x in self.added)]
        for i, found in zip(whole, self._library([texts[i] for i in whole]), strict=True):
            out[i] = found
        rest = [i for i, x in enumerate(out) if x is None]
        for i, found in zip(rest, self._pieces([texts[i] for i in rest]), strict=True):
            out[i] = found
        return out

    def _pieces(self, texts: list[str]) -> list[bytes]:
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        starts, _ = split_safely(data, offsets)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, bounds, pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > PIECE_CACHE // 2:
            self.known, self.older = {}, self.known
        ids = list(map(self.known.get, words))
        for i in [i for i, x in enumerate(ids) if x is None]:
            ids[i] = found = self.older.pop(words[i], None)
            if found is not None:
                self.known[words[i]] = found
        new = [i for i, x in enumerate(ids) if x is None]
        for i, found in zip(new, self._new([words[i] for i in new]), strict=True):
            ids[i] = found
            if len(words[i]) <= PIECE_BYTES:  # a whole text is not kept
                self.known[words[i]] = found
        ends = np.cumsum([0, *map(len, ids)]) // 4
        every = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.uint32))).take(coded.indices)
        cuts = every.offsets.to_numpy()[np.searchsorted(starts, offsets)]
        flat = every.values.to_numpy()
        return [flat[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def worker_encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker. Spark reuses workers between tasks; what an encoder has looked up
    (at most PIECE_CACHE pieces) stays with the process."""
    state = sys.modules.setdefault("_quarry_worker_state", types.ModuleType("_quarry_worker_state")).__dict__
    return state.get(path) or state.setdefault(path, PieceEncoder(path))


def _div(a: np.ndarray, b) -> np.ndarray:
    """``a // b`` by way of doubles: exact for a below 2**53 and b times the quotient's next power of two below 2**52."""
    return (a / b).astype(np.int64)


# a place of a context holds its guess (one more than an id, 0: none yet) and above that its counter of hits
HIT = np.int32(1 << 28)


class Mixer:
    """The adaptive model shared by the lanes of a block; coder and decoder run the same steps. Ids go in and out as one
    more than they are, so that 0 is free."""

    def __init__(self, vocab: int, lanes: int):
        if not 0 < vocab < 1 << (ORDER0_BITS - 1):
            raise ValueError(f"vocabulary of {vocab} ids is out of range")
        self.vocab, self.lanes, self.step = vocab, lanes, 0
        self.count = np.zeros(vocab, np.int64)
        self.every, self.sums, self.shares = np.arange(vocab + 1), np.zeros(vocab + 1, np.int64), np.empty(vocab + 1)
        # cumulative shares below each id, and up to it
        self.below = np.zeros(vocab + 2, np.int64)
        self.upto = self.below[1:]
        self.slot = np.empty(1 << ORDER0_BITS, np.int32)
        self.fresh: list[np.ndarray] = []
        self.follow = [np.zeros(vocab + 2, np.int32), np.zeros(1 << SLOT_BITS, np.int32)]
        self.outcome = np.tile(np.array([2, 1, 3], np.int64), (128, 1))
        self.before = [np.full(lanes, vocab + 1, np.int64), np.full(lanes, vocab + 1, np.int64)]
        self.rebuild(False)

    def rebuild(self, table: bool) -> None:
        """Order-0 cumulative shares, every id at least one of 2**ORDER0_BITS."""
        if self.fresh:
            self.count += np.bincount(np.concatenate(self.fresh), minlength=self.vocab + 1)[1:]
            self.fresh = []
        free = (1 << ORDER0_BITS) - self.vocab
        np.cumsum(self.count, out=self.sums[1:])
        total = int(self.sums[-1])
        # free shares by count, rounded down: in doubles exact while the block's ids are fewer than 2**34
        np.multiply(self.sums if total else self.every, float(free), out=self.shares)
        self.shares /= total or self.vocab
        np.copyto(self.upto, self.shares, casting="unsafe")
        self.upto += self.every
        if table:
            self.slot[:] = 0
            self.slot[0] = 1
            self.slot[self.upto[1:-1]] = 1
            np.cumsum(self.slot, out=self.slot, dtype=np.int32)

    def predict(self, active: int):
        """Masses for the first ``active`` lanes: order-0 share and the two point masses."""
        p1, p2 = self.before[0][:active], self.before[1][:active]
        self.at = [p1, (((p1 - 1) * 0x2545F491 + (p2 - 1) * 0x9E3779B1) >> 7) & ((1 << SLOT_BITS) - 1)]
        self.held = [self.follow[k].take(self.at[k], mode="clip") for k in (0, 1)]
        self.guess = [h & (HIT - 1) for h in self.held]
        one, two = self.guess
        # counter of order 2, of order 1, and whether both guess the same
        self.state = (self.held[1] >> 24 | self.held[0] >> 27 | (one == two)).astype(np.int64)
        room = (1 << TOTAL_BITS) - (1 << ORDER0_BITS)
        share = (self.outcome[:, :2] * room // self.outcome.sum(axis=1, keepdims=True)).T.copy()
        share[0, 1::2] += share[1, 1::2]  # the same guess has one mass
        share[1, 1::2] = 0
        q2 = share[0].take(self.state, mode="clip") * (two > 0)
        q1 = share[1].take(self.state, mode="clip") * (one > 0)
        return (1 << TOTAL_BITS) - q1 - q2, q1, q2

    def bounds(self, ids, q0, q1, q2):
        """Cumulative mass below each id, and its own mass."""
        one, two = self.guess
        self.ids, at = ids, ids.astype(np.int64)
        self.before = [at, self.before[0][:len(at)]]
        self.hit = [one == ids, two == ids]
        below = q0 * self.below.take(at, mode="clip") >> ORDER0_BITS
        own = (q0 * self.upto.take(at, mode="clip") >> ORDER0_BITS) - below
        below += q1 * (one < ids)
        below += q2 * (two < ids)
        own += q1 * self.hit[0]
        own += q2 * self.hit[1]
        return below, own

    def find(self, v, q0, q1, q2):
        """The id whose interval holds ``v``."""
        one, two = self.guess
        low, high = np.minimum(one, two), np.maximum(one, two)
        q_low = np.where(one < two, q1, q2)
        q_high = q1 + q2 - q_low
        # where the guesses' masses end, each after the order-0 share of its id; one not made yet has none
        end_low = (q0 * self.upto.take(low, mode="clip") >> ORDER0_BITS) + q_low
        end_high = (q0 * self.upto.take(high, mode="clip") >> ORDER0_BITS) + q_low + q_high
        above_low, above_high = v >= end_low, v >= end_high
        rest = v - q_low * above_low - q_high * above_high
        ids = self.slot.take(_div(rest << ORDER0_BITS | (1 << ORDER0_BITS) - 1, q0), mode="clip")
        np.copyto(ids, high, where=(v >= end_high - q_high) > above_high)
        np.copyto(ids, low, where=(v >= end_low - q_low) > above_low)
        return ids

    def learn(self, table: bool) -> None:
        """From the ids that ``bounds`` was asked for."""
        hit = self.hit
        # columns: neither guess hit, the first alone, the second
        kind = np.bincount((self.state << 2) + (hit[0].view(np.int8) + 2 * hit[1].view(np.int8)), minlength=512).reshape(128, 4)
        self.outcome[:, 0] += kind[:, 2] + kind[:, 3]
        self.outcome[:, 1:] += kind[:, 1::-1]
        # of lanes that share a context the last one counts: repeated places keep the last value assigned
        # a hit counts one up, a miss one down or, with none left, puts its id in the place
        for k in (0, 1):
            held, none = self.held[k], self.held[k] < HIT
            up, down = hit[k] & (held < TOP_HITS * HIT), ~(hit[k] | none)
            new = held + (up.view(np.int8) - down.view(np.int8)) * HIT
            np.copyto(new, self.ids, where=none > hit[k])
            self.follow[k][self.at[k]] = new
        self.fresh.append(self.before[0])
        self.step += 1
        if self.step < 8 or self.step % 8 == 0:
            self.rebuild(table)


def _lengths(n: int) -> tuple[int, int]:
    """Lanes of a block and ids of the last lane."""
    lanes = -(-n // STEPS)
    return lanes, n - (lanes - 1) * STEPS


def encode_block(ids: np.ndarray, vocab: int) -> bytes:
    """One self-contained block."""
    ids = np.ascontiguousarray(ids, np.uint32)
    if len(ids) and int(ids.max()) >= vocab:
        raise ValueError("an id lies outside the vocabulary")
    lanes, last = _lengths(len(ids))
    head = struct.pack(HEADER, MAGIC, len(ids), vocab, lanes, zlib.crc32(ids.tobytes()))
    if not lanes:
        return head
    grid = np.zeros(lanes * STEPS, np.int32)
    grid[: len(ids)] = ids
    grid += 1
    grid = np.ascontiguousarray(grid.reshape(lanes, STEPS).T)
    model = Mixer(vocab, lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    words, owner = [], []
    for t in range(STEPS if lanes > 1 else last):
        active = lanes if t < last else lanes - 1
        own = grid[t, :active]
        mass = model.predict(active)
        a, n = model.bounds(own, *mass)
        part = size[:active] >> np.uint64(TOTAL_BITS)
        low[:active] += part * a.view(np.uint64)
        size[:active] = part * n.view(np.uint64)
        out = _shrink(low, size, active)
        words.append((low[out] >> np.uint64(32)).astype(np.uint32))
        owner.append(out)
        low[out] <<= np.uint64(32)
        size[out] <<= np.uint64(32)
        model.learn(False)
    words.append(((low + size - np.uint64(1)) >> np.uint64(32)).astype(np.uint32))
    owner.append(np.arange(lanes))
    owner, words = np.concatenate(owner), np.concatenate(words)
    order = np.argsort(owner.astype(np.min_scalar_type(lanes)), kind="stable")  # by radix where lanes are few
    count = np.bincount(owner, minlength=lanes).astype(np.uint16)
    return head + count.tobytes() + words[order].tobytes()


def _shrink(low: np.ndarray, size: np.ndarray, active: int) -> np.ndarray:
    """Lanes whose top word is settled; a range that straddles a word border gives up its upper part."""
    out = np.flatnonzero(size[:active] < np.uint64(1 << 32))
    a, n = low[out], size[out]
    cross = (a ^ (a + n - np.uint64(1))) >> np.uint64(32) != 0
    size[out[cross]] = (np.uint64(0) - a[cross]) & np.uint64(0xFFFFFFFF)
    return out


def decode_block(block: bytes) -> np.ndarray:
    """Ids of a block; a block that does not check out is an error."""
    magic, n, vocab, lanes, crc = struct.unpack_from(HEADER, block)
    if magic != MAGIC or (lanes, n) != (_lengths(n)[0], n):
        raise ValueError("not a token block")
    if not lanes:
        return np.empty(0, np.uint32)
    count = np.frombuffer(block, np.uint16, lanes, HEADER_BYTES).astype(np.int64)
    body = np.frombuffer(block, np.uint32, -1, HEADER_BYTES + 2 * lanes) if len(block) % 4 == (HEADER_BYTES + 2 * lanes) % 4 else None
    if body is None or len(body) != count.sum():
        raise ValueError("a token block is cut short")
    words = np.append(body.astype(np.uint64), np.uint64(0))
    end = np.cumsum(count)
    at = end - count

    def take(lane):
        got = words[np.where(at[lane] < end[lane], at[lane], len(words) - 1)]
        at[lane] += 1
        return got

    every = np.arange(lanes)
    code = take(every) << np.uint64(32)
    code |= take(every)
    last = _lengths(n)[1]
    model = Mixer(vocab, lanes)
    model.rebuild(True)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    grid = np.zeros((STEPS, lanes), np.uint32)
    top = np.uint64((1 << TOTAL_BITS) - 1)
    for t in range(STEPS if lanes > 1 else last):
        active = lanes if t < last else lanes - 1
        mass = model.predict(active)
        part = size[:active] >> np.uint64(TOTAL_BITS)
        v = np.minimum((code[:active] - low[:active]) // part, top).astype(np.int64)
        own = model.find(v, *mass)
        a, m = model.bounds(own, *mass)
        low[:active] += part * a.view(np.uint64)
        size[:active] = part * m.view(np.uint64)
        out = _shrink(low, size, active)
        low[out] <<= np.uint64(32)
        size[out] <<= np.uint64(32)
        code[out] = code[out] << np.uint64(32) | take(out)
        grid[t, :active] = own - 1
        model.learn(True)
    ids = np.ascontiguousarray(grid.T).reshape(-1)[:n]
    if zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("a token block fails its checksum")
    return ids


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        encoder = None
        ids: list = []
        held: list[bytes] = []
        size = 0
        end = np.array([end_id], np.uint32).tobytes()

        def close():
            nonlocal block, size
            lengths = [len(x) // 4 for x in held]
            payload = encode_block(np.frombuffer(b"".join(held), np.uint32), encoder.size)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([sum(lengths)], pa.int64()), pa.array([payload], pa.binary())],
                ["part", "block", "doc_ids", "lengths", "n_tokens", "payload"])
            block, size = block + 1, 0
            ids.clear()
            held.clear()
            return row

        for batch in batches:
            encoder = encoder or worker_encoder(path)
            doc = batch.column("doc_id").to_pylist()
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // TEXT_BYTES, prepend=-1, append=-1)) if len(doc) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                texts = [t or "" for t in batch.column("text").slice(a, b - a).to_pylist()]
                for i, found in zip(doc[a:b], encoder.encode(texts), strict=True):
                    ids.append(i)
                    held.append(found + end)
                    size += len(found) // 4 + 1
                    if size >= BLOCK_TOKENS:
                        yield close()
        if ids:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Writes the token-id files of ``docs`` to ``path``, in ascending id order."""
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("tie"))
    (rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
     .mapInArrow(_encode(tokenizer, end_id), BLOCKS).write.parquet(path))


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            raw = decode_block(row["payload"]).tobytes()
            ends = np.concatenate([[0], np.cumsum(np.array(row["lengths"], np.int64))])
            k = len(row["doc_ids"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"]] * k, pa.int32()),
                 pa.array([row["block"]] * k, pa.int32()), pa.array(ends[:-1]), pa.array(row["lengths"], pa.int64()),
                 pa.array([raw[4 * a: 4 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                ["doc_id", "part", "block", "offset", "n_tokens", "ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of token-id files: doc_id, part, block, offset (in its block), n_tokens, ids (little-endian
    unsigned 32-bit integers)."""
    return spark.read.parquet(path).mapInArrow(
        _decode, "doc_id long, part int, block int, offset long, n_tokens long, ids binary")


def with_start(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """``docs`` (part, block, offset) plus start: ids of all documents before. Files are summed first (one row
    per file in the ordered window), blocks within their file."""
    blocks = spark.read.parquet(path).select("part", "block", "n_tokens")
    files = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inner = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("in_file", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(files, "part").select(
        "part", "block", (F.col("base") + F.col("in_file")).alias("block_start"))
    return docs.join(starts, ["part", "block"]).withColumn("start", F.col("block_start") + F.col("offset"))
