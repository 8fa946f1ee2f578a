"""Chat formatting by prefix-target expansion.

Every assistant turn becomes its own example: all turns before it as context, and only its reply
trainable. Turns that follow the last assistant turn (or a conversation without one) end with one more
example without a trainable span, so the output holds every turn.

Turns are dealt to partitions by conversation and sorted by turn; a worker walks them in order, keeps the text
of the conversation so far and emits an example per target. Memory is bounded by the longest single
conversation, whatever the number of its examples (their number of characters grows with the square of the
turns: that is what the expansion means).

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. A control string inside a text or role never reaches the
output as such: every ``<`` + backslashes + ``|`` gets one more backslash, which reading removes again. Roles
also escape newlines and backslashes.

Edge cases: null text and null role are empty; ties and repeated (conversation, turn) rows are ordered by
role and text and all stay; null conversation ids form one conversation; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import shuffle_partitions

START, END = "<|im_start|>", "<|im_end|>\n"
TARGET_ROLE = "assistant"
FLUSH_CHARS = 4 << 20
EXAMPLES = "conv_id long, example int, text string, loss_start int, loss_end int"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}"


def parse_turns(text: str) -> list[tuple[str, str]]:
    """Inverse of ``format_turn`` over a whole example."""
    out = []
    for part in text.split(START)[1:]:
        role, _, body = part[: -len(END)].partition("\n")
        out.append((unescape_role(role), unescape(body)))
    return out


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("example", pa.int32()), ("text", pa.string()),
                        ("loss_start", pa.int32()), ("loss_end", pa.int32())])
    rows: list[tuple] = []
    size, now, started = 0, None, False
    so_far, length, number, open_turns = [], 0, 0, False

    def flush():
        nonlocal size
        batch = pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(schema.names)}, schema)
        rows.clear()
        size = 0
        return batch

    for batch in batches:
        for conv, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
            if not started or conv != now:
                if open_turns:
                    rows.append((now, number, "".join(so_far), None, None))
                    size += length
                started, now, so_far, length, number, open_turns = True, conv, [], 0, 0, False
            turn = format_turn(role or "", text or "")
            if role == TARGET_ROLE:
                # the prefix is joined once per example and kept joined
                head = "".join(so_far)
                rows.append((now, number, head + turn, len(head) + len(START) + len(role) + 1,
                             len(head) + len(turn) - len(END)))
                so_far, number = [rows[-1][2]], number + 1
                size += length + len(turn)
            else:
                so_far.append(turn)
            length += len(turn)
            open_turns = role != TARGET_ROLE
            if size >= FLUSH_CHARS:
                yield flush()
    if open_turns:
        rows.append((now, number, "".join(so_far), None, None))
    if rows:
        yield flush()


def chat_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """Examples (conv_id, example, text, loss_start, loss_end): the loss span counts code points of ``text``,
    null where nothing is trainable. Examples of a conversation stay together and in order."""
    n = shuffle_partitions(turns.sparkSession)
    return (turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                         F.col(role_col).alias("role"), F.col(text_col).alias("text"))
            .repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(_expand, EXAMPLES))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    done: list[tuple] = []
    now = last = loss = None
    chars = total = count = 0

    def close():
        turns = parse_turns(last)
        said = hashlib.sha256()
        for role, text in turns:
            said.update(f"{role}\n{text}\n".encode())
        return (now, len(turns), said.hexdigest(), chars, loss.hexdigest(), total, count)

    for batch in batches:
        for conv, text, a, b in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "text", "loss_start", "loss_end")),
                                    strict=True):
            if loss is None or conv != now:
                if loss is not None:
                    done.append(close())
                now, loss, chars, total, count = conv, hashlib.sha256(), 0, 0, 0
            if a is not None:
                target = unescape(text[a:b])
                loss.update(target.encode())
                chars += len(target)
            last, total, count = text, total + len(text), count + 1
    if loss is not None:
        done.append(close())
    if done:
        yield pa.RecordBatch.from_pydict({n: [r[i] for r in done] for i, n in enumerate(names)}, schema)


def chat_digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from ``chat_examples``: n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars (of all its examples), n_examples. The last example holds every turn."""
    return examples.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                        "loss_sha256 string, formatted_chars long, n_examples long")
