"""Position lists and words of whole documents: one pass over each document's words, without an exchange.

A row of ``doc_id`` and one text per field is split into words (``functions.text.words`` on the bytes of a whole batch) and
becomes its list rows (``term, doc_id, tf, dl, at``), its row of the words table (``doc_id, dl, words``) or part of a group of
documents. Neighbouring documents are taken together and their list rows come out word by word, so that
rows of one word lie together in a shuffle's blocks. Ids must not repeat among the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quarry.functions.text import LOWER_CHARS, UPPER_CHARS

# ---- fixed values: words and bytes of text taken together (a longer document is taken alone), rows handed on at a time ----
WORDS_AT_ONCE, BYTES_AT_ONCE, ROWS_OUT = 2_000_000, 1 << 23, 50_000
# ---- end of fixed values ----

# The index charset byte by byte: what a byte folds to and whether it is a word character; a Cyrillic letter is two bytes.
_FOLDED, _IN_WORD = np.arange(256, dtype=np.uint8), np.zeros(256, bool)
_PAIR = np.zeros(1 << 16, np.uint16)  # two bytes of a letter -> those of its lower case, 0: no letter
for _u, _l in zip((*UPPER_CHARS, *LOWER_CHARS, *"0123456789_"), (*LOWER_CHARS, *LOWER_CHARS, *"0123456789_")):
    if len(_u.encode()) == 1:
        _FOLDED[ord(_u)], _IN_WORD[ord(_u)] = ord(_l), True
    else:
        _PAIR[int.from_bytes(_u.encode())] = int.from_bytes(_l.encode())
_LEAD = np.zeros(256, bool)
_LEAD[np.flatnonzero(_PAIR) >> 8] = True
_LEAST_LEAD = np.flatnonzero(_LEAD)[0]

LISTS = "term string, doc_id long, tf long, dl long, at array<struct<field:string,pos:array<int>>>"
WORDS = "doc_id long, dl long, words array<struct<term:string,tf:long>>"
LENGTHS = "doc_id long, field string, len long"


def word_lists(col: pa.StringArray) -> pa.ListArray:
    """The words of each text: the word list column of ``functions.text.words``."""
    raw, n = col.buffers()[2], len(col)
    ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset: col.offset + n + 1].astype(np.int64)
    text = np.frombuffer(raw, np.uint8)[ends[0]: ends[-1]] if raw is not None else np.zeros(0, np.uint8)
    ends -= ends[0]
    folded, held = _FOLDED[text], np.zeros(len(text) + 2, bool)  # a byte that is no word before and after
    inside = held[1:-1]
    inside[:] = _IN_WORD[text]
    if (text >= _LEAST_LEAD).any():
        lead = np.flatnonzero(_LEAD[text[:-1]])
        lower = _PAIR[text[lead].astype(np.uint16) << 8 | text[lead + 1]]
        lead, lower = lead[lower > 0], lower[lower > 0]
        inside[lead] = inside[lead + 1] = True
        folded[lead], folded[lead + 1] = lower >> 8, lower & 255
    edges = np.flatnonzero(held[1:] != held[:-1])  # first byte of a word, byte after it, and so on
    cut = np.unique(ends[held[ends] & held[ends + 1]])  # a word ends with its text
    if len(cut):
        edges = np.sort(np.concatenate([edges, cut, cut]), kind="stable")
    starts = edges[::2]
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(0, np.cumsum(edges[1::2] - starts)).astype(np.int32)),
                                        pa.py_buffer(folded[inside]))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, ends).astype(np.int32)), words)


def _runs(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose sizes come to ``most`` or little more."""
    part = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _split(batch: pa.RecordBatch, n_fields: int) -> Iterator[pa.RecordBatch]:
    """``doc_id`` and the texts as ``doc_id, dl`` and the words of each text."""
    sizes = sum(pc.binary_length(batch.column(1 + f)).to_numpy().astype(np.int64) for f in range(n_fields))
    for part in _runs(batch, sizes, BYTES_AT_ONCE):
        toks = [word_lists(part.column(1 + f).cast(pa.string())) for f in range(n_fields)]
        dl = sum(pc.list_value_length(t).to_numpy().astype(np.int64) for t in toks)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(dl), *toks], ["doc_id", "dl", *(f"toks{f}" for f in range(n_fields))])


def _slices(batch: pa.RecordBatch, n_fields: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of ``WORDS_AT_ONCE`` words or little more."""
    sizes = sum(pc.list_value_length(batch.column(2 + f)).to_numpy(zero_copy_only=False) for f in range(n_fields))
    return _runs(batch, sizes, WORDS_AT_ONCE)


def _tokens(batch: pa.RecordBatch, n_fields: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words in order, and of every occurrence (field by field, document by document) its word's number, document
    row, field and position."""
    texts, docs, fields, pos = [], [], [], []
    for f in range(n_fields):
        col = batch.column(2 + f)
        n = pc.list_value_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
        texts.append(col.flatten().cast(pa.string()))
        docs.append(np.repeat(np.arange(len(n)), n))
        fields.append(np.full(n.sum(), f, np.int32))
        pos.append((np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32))
    coded = pa.concat_arrays(texts).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()], *map(np.concatenate, (docs, fields, pos))


def _starts(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _offsets(starts: np.ndarray, n: int) -> pa.Array:
    return pa.array(np.append(starts, n).astype(np.int32))


def _list_rows(batch: pa.RecordBatch, names: tuple[str, ...]) -> pa.RecordBatch:
    terms, word, doc, field, pos = _tokens(batch, len(names))
    order = np.argsort(word * batch.num_rows + doc, kind="stable")  # fields and positions stay in order
    word, doc, field, pos = word[order], doc[order], field[order], pos[order]
    rows, parts = _starts(word, doc), _starts(word, doc, field)
    at = pa.StructArray.from_arrays(
        [pa.array(names, pa.string()).take(pa.array(field[parts])), pa.ListArray.from_arrays(_offsets(parts, len(pos)), pa.array(pos))],
        ["field", "pos"])
    of = pa.array(doc[rows])
    return pa.RecordBatch.from_arrays(
        [terms.take(pa.array(word[rows])), batch.column(0).take(of), pa.array(np.diff(np.append(rows, len(pos))).astype(np.int64)),
         batch.column(1).take(of), pa.ListArray.from_arrays(_offsets(np.searchsorted(parts, rows), len(parts)), at)],
        ["term", "doc_id", "tf", "dl", "at"])


def _word_rows(batch: pa.RecordBatch, names: tuple[str, ...]) -> pa.RecordBatch:
    terms, word, doc, _, _ = _tokens(batch, len(names))
    key, tf = np.unique(doc * max(len(terms), 1) + word, return_counts=True)
    doc, word = key // max(len(terms), 1), key % max(len(terms), 1)
    rows = _starts(doc)
    words = pa.StructArray.from_arrays([terms.take(pa.array(word)), pa.array(tf.astype(np.int64))], ["term", "tf"])
    of = pa.array(doc[rows])
    return pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of),
                                       pa.ListArray.from_arrays(_offsets(rows, len(word)), words)], ["doc_id", "dl", "words"])


def _length_rows(batch: pa.RecordBatch, names: tuple[str, ...]) -> pa.RecordBatch:
    n = len(batch)
    rows = pa.RecordBatch.from_arrays(
        [pa.concat_arrays([batch.column(0)] * len(names)), pa.array(names, pa.string()).take(pa.array(np.repeat(np.arange(len(names)), n))),
         pa.concat_arrays([pc.list_value_length(batch.column(2 + f)).cast(pa.int64()) for f in range(len(names))])], ["doc_id", "field", "len"])
    return rows.filter(pc.greater(rows.column(2), 0))


def parts(batches: Iterator[pa.RecordBatch], n_fields: int) -> Iterator[pa.RecordBatch]:
    """Texts as words, in runs of rows."""
    for batch in batches:
        for split in _split(batch, n_fields):
            yield from _slices(split, n_fields)


def _each(docs: DataFrame, names: tuple[str, ...], make, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, len(names)):
            out = make(part, names)
            for at in range(0, out.num_rows, ROWS_OUT):
                yield out.slice(at, ROWS_OUT)

    return docs.mapInArrow(run, schema)


def doc_lists(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``term, doc_id, tf, dl, at`` of ``docs`` (``doc_id``, then a text for each field of ``names``)."""
    return _each(docs, names, _list_rows, LISTS)


def doc_words(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``doc_id, dl, words`` of the documents that have words."""
    return _each(docs, names, _word_rows, WORDS)


def doc_lengths(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``doc_id, field, len`` of the fields that have words."""
    return _each(docs, names, _length_rows, LENGTHS)
