"""Chat formatting by columnar byte assembly, and reading formatted text back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from shelfcast.llm.arrow import BATCH_BYTES
from shelfcast.session import ship

# The template: <|start|>role\n text <|end|>\n
START, MIDDLE, END = "<|start|>", "\n", "<|end|>\n"

# Strings with a meaning to this template or to others, which no text may spell out.
CONTROLS = ("<|start|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")

ASSISTANT = "assistant"

#: Bytes after which the formatted text of a conversation continues in a further part.
PART_BYTES = 1 << 20

_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
_ESCAPE = r"([<\[])(\\*)(" + _REST + ")"
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(" + _REST + ")")


# The backslash comes first: later forms contain one.
_ROLE_FORMS = {"\\\\": "\\", "\\n": "\n", "\\l": "<", "\\b": "["}


def escape(texts: pa.Array) -> pa.Array:
    """A backslash after the first character of every control string, and of every one so marked before."""
    return pc.replace_substring_regex(texts, pattern=_ESCAPE, replacement=r"\1\\\2\3")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def escape_role(roles: pa.Array) -> pa.Array:
    """Roles keep to one line and spell no control: backslash, line feed and opening brackets get forms
    of two characters."""
    for written, plain in _ROLE_FORMS.items():
        roles = pc.replace_substring(roles, pattern=plain, replacement=written)
    return roles




def unescape_role(role: str) -> str:
    return re.sub(r"\\[\\nlb]", lambda m: _ROLE_FORMS[m.group()], role)


def _bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string array without nulls."""
    array = pc.cast(array, pa.large_string())
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), ends


def assemble(segments: Sequence[str | pa.Array], n: int) -> tuple[pa.Buffer, np.ndarray, np.ndarray]:
    """One buffer with the segments of row 0, then those of row 1, ...: (buffer, start of each row and the
    end, start of each segment as rows x segments). A segment is a constant or a string array.

    Lengths give cumulative offsets, and these give the place of every byte; each segment is copied for
    all rows at once.
    """
    constants = [np.frombuffer(s.encode(), dtype=np.uint8) if isinstance(s, str) else None for s in segments]
    arrays = [None if isinstance(s, str) else _bytes_of(s) for s in segments]
    lengths = np.stack(
        [np.full(n, len(c), dtype=np.int64) if c is not None else np.diff(a[1]) for c, a in zip(constants, arrays)], axis=1
    )
    ends = np.cumsum(lengths.ravel())
    starts = np.r_[0, ends[:-1]].reshape(n, len(segments))
    total = int(ends[-1]) if n else 0
    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, dtype=np.uint8)
    for k, (constant, array) in enumerate(zip(constants, arrays)):
        if constant is not None:
            out[starts[:, k, None] + np.arange(len(constant))] = constant
        else:
            data, at = array
            source = np.arange(at[0], at[-1])
            shift = np.repeat(starts[:, k] - at[:-1], lengths[:, k])
            out[source + shift] = data[source]
    return buffer, np.r_[starts[:, 0], total], starts


PARTS = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("place", LongType()),
        StructField("n_turns", IntegerType()),
        StructField("formatted", StringType()),
        StructField("loss_starts", ArrayType(LongType())),
        StructField("loss_ends", ArrayType(LongType())),
    ]
)


def _spans(rows: np.ndarray, first: np.ndarray, at: np.ndarray) -> pa.Array:
    """Of every run of rows that begins at ``first`` the values ``at`` of its chosen ``rows``, as a list."""
    offsets = np.searchsorted(rows, first).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.r_[offsets, len(rows)], pa.int32()), pa.array(at, pa.int64()))


def _format_batch(batch: pa.RecordBatch, task: int, count: int) -> pa.RecordBatch:
    """A part for every run of turns of one conversation; the texts lie in the assembled buffer itself."""
    conv, role, text = (batch.column(i) for i in range(3))
    n = batch.num_rows
    role, text = pc.fill_null(role, ""), pc.fill_null(text, "")
    buffer, row_at, starts = assemble([START, escape_role(role), MIDDLE, escape(text), END], n)
    known = pc.fill_null(conv, 0).to_numpy(zero_copy_only=False)
    missing = pc.is_null(conv).to_numpy(zero_copy_only=False)
    size = np.diff(row_at)
    change = np.r_[True, (known[1:] != known[:-1]) | (missing[1:] != missing[:-1])]
    # A part ends with its conversation or where another PART_BYTES of the batch are full.
    full = (row_at[:-1] + size) // PART_BYTES
    change[1:] |= full[1:] != full[:-1]
    first = np.flatnonzero(change)
    offsets = pa.py_buffer(np.ascontiguousarray(row_at[np.r_[first, n]], dtype=np.int64))
    texts = pa.LargeStringArray.from_buffers(len(first), offsets, buffer)
    rows = np.flatnonzero(pc.equal(role, ASSISTANT).to_numpy(zero_copy_only=False))
    start_of_part = row_at[first[np.searchsorted(first, rows, side="right") - 1]]
    return pa.RecordBatch.from_arrays(
        [
            conv.take(pa.array(first)),
            pa.array(np.arange(count, count + len(first)) + (task << 32), pa.int64()),
            pa.array(np.diff(np.r_[first, n]), pa.int32()),
            pc.cast(texts, pa.string()),
            _spans(rows, first, starts[rows, 3] - start_of_part),
            _spans(rows, first, starts[rows, 4] - start_of_part),
        ],
        names=PARTS.fieldNames(),
    )


def format_conversations(turns: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """Formatted text in parts: conv_id, place, n_turns, formatted, loss_starts, loss_ends.

    ``turns`` has conv_id (long), turn, role and text. Turns are ordered by turn, nulls first, and rows of
    the same turn by a hash of their content; null roles and texts are empty, turns without a conversation make up one with the id
    null, repeated rows are turns of their own, other columns are ignored. ``place`` orders the parts of
    a conversation. A loss span is the byte range in ``formatted`` of an assistant's text.

    Turns are dealt out by ranges of conversation, turn and content, so a conversation of any size spreads
    over tasks; a part holds one conversation and about PART_BYTES at most (a longer turn is one part).
    """
    spark = turns.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("__content")]
    slim = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = slim.withColumn("__content", F.xxhash64(F.coalesce("role", F.lit("\n")), F.lit("\n"), "text")).repartitionByRange(n, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            if batch.num_rows:
                parts = _format_batch(batch, task, count)
                count += parts.num_rows
                yield parts

    return dealt.sortWithinPartitions(*order).select("conv_id", "role", "text").mapInArrow(run, PARTS)


DIGESTS = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("n_turns", LongType()),
        StructField("turns_sha256", StringType()),
        StructField("loss_chars", LongType()),
        StructField("loss_sha256", StringType()),
        StructField("formatted_chars", LongType()),
    ]
)

_TURN = re.compile(re.escape(START) + "([^\n]*)\n(.*?)" + re.escape(END), re.S)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn; raises if anything stands outside the turns."""
    at = 0
    for match in _TURN.finditer(formatted):
        if match.start() != at:
            break
        at = match.end()
        yield unescape_role(match[1]), unescape(match[2])
    if at != len(formatted):
        raise ValueError(f"not a turn at {at}: {formatted[at : at + 40]!r}")


class _Conversation:
    def __init__(self, number: int | None):
        self.number, self.n_turns, self.loss_chars, self.chars = number, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, starts: list[int], ends: list[int]) -> None:
        for role, text in parse(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        raw = formatted.encode()
        for a, b in zip(starts, ends):
            text = unescape(raw[a:b].decode())
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.number, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of every conversation, read from the parts of :func:`format_conversations`.

    A digest runs over a conversation from its start to its end, so its parts pass one task, one after
    the other: what is held is one part and two hash states, whatever the size of the conversation.
    """
    spark = parts.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Conversation | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if current is None or current.number != row["conv_id"]:
                    if current is not None:
                        done.append(current.row())
                    current = _Conversation(row["conv_id"])
                current.add(row["formatted"], row["loss_starts"], row["loss_ends"])
            if done:
                yield _digest_batch(done)
        if current is not None:
            yield _digest_batch([current.row()])

    ordered = parts.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "place")
    return ordered.select("conv_id", "formatted", "loss_starts", "loss_ends").mapInArrow(run, DIGESTS)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=DIGESTS.fieldNames())
