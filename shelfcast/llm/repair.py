"""Conversations brought into the order (system, then) user, assistant, ... by the cheapest edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from shelfcast.llm import viterbi
from shelfcast.llm.arrow import BATCH_BYTES, map_columns
from shelfcast.llm.ranks import COUNT, INDEX, ranked
from shelfcast.llm.text import SPACES
from shelfcast.operators.joins import attach
from shelfcast.schema import N_ROWS
from shelfcast.session import cut_lineage, ship

#: Rows of a piece of a conversation: what a task holds of one at once.
CHUNK = 4096

_GROUP, _TURN, _ROLE, _TEXT, _KEY, _ROW = "__group", "__turn", "__role", "__text", "__key", "__row"
_VECTOR = ArrayType(LongType())


def damaged(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with repeatable damage, chosen by the CRC-32 of ``conversation:turn`` (null: one space) modulo
    20: 0 drops the row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes it the
    user's. Null roles and texts become one space."""
    or_space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(or_space(conversation), F.lit(":"), or_space(turn)).cast("binary")) % 20
    said = or_space(text)
    rows = turns.select(
        F.col(f"`{conversation}`").alias(conversation),
        F.col(f"`{turn}`").alias(turn),
        F.when(fate == 4, "user").otherwise(or_space(role)).alias(role),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias(text),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("__times"),
    )
    times = F.when(F.col("__times") > 0, F.sequence(F.lit(1), "__times"))
    return rows.withColumn("__times", F.explode(times)).drop("__times")


def _group_of(column: str) -> Column:
    text = F.col(f"`{column}`").cast("string")
    return F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), text))


def _is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{SPACES}]")


def _rows(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Conversation, turn, role, digest of role and text, and text of every row."""
    said_by, said = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role, text))
    key = F.unhex(F.sha2(F.concat(F.octet_length(said_by).cast("string"), F.lit(":"), said_by, said).cast("binary"), 256))
    return turns.select(
        _group_of(conversation).alias(_GROUP), F.col(f"`{turn}`").alias(_TURN), said_by.alias(_ROLE), key.alias(_KEY), said.alias(_TEXT)
    )


def coded(rows: DataFrame) -> DataFrame:
    """(conversation, turn, role, digest, place, count, code) of every row, without its text.

    A row's first fault counts: blank, then duplicate (an earlier row of the conversation has its role and
    text), then truncated. Only digests that occur twice meet their rows again, and those of many rows are
    split, so neither a hot conversation nor a hot row gathers in one task.
    """
    text = F.col(_TEXT)
    initial = F.substring(_ROLE, 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(_is_blank(text), 1).when(text.rlike(rf"[.!?][{SPACES}]*\z"), 0).otherwise(3)
    slim = cut_lineage(
        rows.select(_GROUP, _TURN, _ROLE, _KEY, role.alias("__initial"), fault.alias("__fault"), F.monotonically_increasing_id().alias(_ROW))
    )
    placed = ranked(slim, [_GROUP], [_TURN, _ROLE, _KEY, _ROW])
    repeated = placed.where("__fault <> 1").groupBy(_GROUP, _KEY).agg(F.min(INDEX).alias("__first"), F.count(F.lit(1)).alias(N_ROWS))
    repeated = cut_lineage(repeated.where(F.col(N_ROWS) > 1))
    found = attach(placed, repeated, [_GROUP, _KEY], weights=repeated, how="left")
    again = (F.col("__fault") != 1) & (F.col(INDEX) > F.col("__first"))
    code = F.col("__initial") + viterbi.ROLES * F.when(again, 2).otherwise(F.col("__fault"))
    return found.select(_GROUP, _TURN, _ROLE, _KEY, INDEX, COUNT, F.char(code + ord("A")).alias("__code"))


def _vectors(array: pa.Array) -> np.ndarray:
    return array.flatten().to_numpy(zero_copy_only=False).reshape(-1, viterbi.STATES)


def _lists(vectors: np.ndarray) -> pa.Array:
    offsets = np.arange(0, vectors.size + 1, vectors.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.astype(np.int64).ravel()))


def _constant(vector: Sequence[int]) -> Column:
    return F.array(*[F.lit(int(x)).cast("long") for x in vector])


def _pieces(codes: DataFrame, chunk: int) -> DataFrame:
    """Pieces of at most ``chunk`` rows, each with its codes as a text and the costs before it, which are
    those of the whole conversation for its last piece and speculative for the others."""
    place = F.call_function("div", F.col(INDEX), F.lit(chunk).cast("long"))
    row = F.struct(INDEX, "__code", _TURN, _ROLE, _KEY)
    grouped = codes.groupBy(_GROUP, place.alias("__piece"), COUNT).agg(F.array_sort(F.collect_list(row)).alias("__rows"))
    last = F.col("__piece") == F.call_function("div", F.col(COUNT) - 1, F.lit(chunk).cast("long"))
    whole = grouped.select(
        _GROUP,
        "__piece",
        last.alias("__last"),
        F.array_join("__rows.__code", "").alias("__codes"),
        F.when(last, _constant(viterbi.END)).otherwise(_constant(viterbi.SPECULATIVE)).alias("__end"),
        "__rows",
    )

    def make():
        return lambda codes, ends: [_lists(viterbi.entry_costs(codes.to_pylist(), _vectors(ends)))]

    return map_columns(whole, ["__codes", "__end"], whole.columns, [StructField("__entry", _VECTOR)], make)


def _converged(pieces: DataFrame) -> DataFrame:
    """(conversation, piece, end) of the conversations in several pieces, with the true costs behind each
    piece up to a constant.

    A piece whose successor's costs are not a constant away from those assumed for it is run again with
    them, all such pieces at once, until there are none: usually after a pass or two, as few rows suffice
    for costs from different starts to run in parallel, and after as many passes as there are pieces at most.
    """
    slim = cut_lineage(pieces.where(~F.col("__last") | (F.col("__piece") > 0)).select(_GROUP, "__piece", "__codes", "__end", "__entry"))

    def make():
        return lambda codes, old, new, entries: [
            _lists(viterbi.fixed_up(codes.to_pylist(), _vectors(old), _vectors(new), _vectors(entries)))
        ]

    while True:
        following = slim.select(_GROUP, (F.col("__piece") - 1).alias("__piece"), F.col("__entry").alias("__wanted"))
        joined = slim.join(following, [_GROUP, "__piece"], "left")
        stale = F.col("__wanted").isNotNull() & (F.col("__wanted") != F.col("__end"))
        if joined.where(stale).isEmpty():
            return slim.select(_GROUP, "__piece", "__end", "__codes")
        again = map_columns(
            joined.where(stale), ["__codes", "__end", "__wanted", "__entry"], [_GROUP, "__piece", "__codes", "__wanted"],
            [StructField("__new", _VECTOR)], make,
        )
        rerun = again.select(_GROUP, "__piece", "__codes", F.col("__wanted").alias("__end"), F.col("__new").alias("__entry"))
        slim = cut_lineage(joined.where(~stale).drop("__wanted").unionByName(rerun))


def _entry_states(converged: DataFrame) -> DataFrame:
    """(conversation, piece, state before it): every piece's exits for all entries, run through in order.

    What passes one task is four numbers a piece of CHUNK rows.
    """

    def make():
        return lambda codes, ends: [_lists(viterbi.exit_states(codes.to_pylist(), _vectors(ends)))]

    exits = map_columns(converged, ["__codes", "__end"], [_GROUP, "__piece", "__end"], [StructField("__exits", _VECTOR)], make)
    schema = StructType([converged.schema[_GROUP], converged.schema["__piece"], converged.schema["__end"], StructField("__state", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state = None, viterbi.START
        for batch in batches:
            states = []
            for own, piece, leads in zip(*(batch.column(c).to_pylist() for c in (_GROUP, "__piece", "__exits"))):
                if own != group:
                    group, state = own, viterbi.START
                states.append(state)
                state = leads[state]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(states, pa.int64())], names=schema.fieldNames())

    return exits.repartition(_GROUP).sortWithinPartitions(_GROUP, "__piece").mapInArrow(run, schema)


def edits(codes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Pieces (conversation, piece, last, rows) with ``__edits``, the letters of :func:`viterbi.trace`."""
    pieces = cut_lineage(_pieces(codes, chunk))
    plain = pieces.where(F.col("__last") & (F.col("__piece") == 0)).withColumn("__state", F.lit(viterbi.START).cast("long"))
    columns = [_GROUP, "__piece", "__last", "__codes", "__end", "__rows", "__state"]
    known = plain.select(*columns)
    if not pieces.where(F.col("__piece") > 0).isEmpty():
        entries = _entry_states(_converged(pieces))
        several = pieces.where(~F.col("__last") | (F.col("__piece") > 0)).drop("__end", "__entry")
        known = known.unionByName(several.join(cut_lineage(entries), [_GROUP, "__piece"]).select(*columns))

    def make():
        def run(codes: pa.Array, ends: pa.Array, states: pa.Array, last: pa.Array) -> list[pa.Array]:
            entries = states.to_numpy(zero_copy_only=False)
            texts, _ = viterbi.trace(codes.to_pylist(), _vectors(ends), entries, last.to_numpy(zero_copy_only=False))
            return [pa.array(texts, pa.string())]

        return run

    inputs = ["__codes", "__end", "__state", "__last"]
    return map_columns(known, inputs, [_GROUP, "__piece", "__last", "__rows"], [StructField("__edits", StringType())], make)


class _Report:
    """What one conversation's rows say, met in order."""

    def __init__(self, group: str):
        self.group, self.conversation = group, None
        self.first = self.latest = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial: int | None = None
        self.audit: list[str] = []
        self.repaired, self.empty = hashlib.sha256(), True
        self.state, self.text = viterbi.START, None

    def _say(self, line: str) -> None:
        self.repaired.update((line if self.empty else "\n" + line).encode())
        self.empty = False

    def _wanted(self) -> str:
        return "assistant" if self.state == viterbi.USER else "user"

    def _insert(self, n: int) -> None:
        for _ in range(n):
            self._say(f"{self._wanted()}:")
            self.state = viterbi.ASSISTANT if self.state == viterbi.USER else viterbi.USER
        self.audit.append("I" * n)
        self.cost += viterbi.INSERT * n

    def row(self, turn: int | None, role: str, code: str, edit: str) -> None:
        if turn is not None and turn != self.latest:
            self.first = turn if self.first is None else self.first
            self.latest = turn
            self.turns += 1
        number = ord(code) - ord("A")
        initial, fault = number % viterbi.ROLES, number // viterbi.ROLES
        self.blank += fault == 1
        self.duplicate += fault == 2
        self.truncated += fault == 3
        if self.initial is not None:
            self.illegal += (self.initial, initial) not in ((0, 1), (1, 2), (2, 1))
        self.initial = initial
        inserted, choice = divmod(ord(edit) - ord("A"), 4)
        self._insert(inserted)
        letter = viterbi.EDITS[choice]
        self.audit.append(letter)
        if letter == "D":
            self.cost += viterbi.DELETE
            return
        self.cost += (viterbi.REROLE if letter == "R" else 0) + (viterbi.TRUNCATED if fault == 3 else 0)
        self._say(f"{self._wanted() if letter == 'R' else role}:{self.text}")
        self.state = viterbi.SYSTEM if letter == "K" and initial == 0 else viterbi.ASSISTANT if self.state == viterbi.USER else viterbi.USER

    def end(self, edit: str) -> None:
        self._insert(ord(edit) - ord("A"))

    def values(self) -> tuple:
        gaps = 0 if self.first is None else self.latest - self.first + 1 - self.turns
        counts = self.blank, self.duplicate, self.truncated, self.illegal, self.cost
        return self.conversation, min(gaps, (1 << 63) - 1), *counts, "".join(self.audit), self.repaired.hexdigest()


RESULTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

# Order of what is known of a conversation: its name, its rows (text before its edits), its end.
_NAME, _SAID, _EDIT, _END = range(4)


def repair(
    turns: DataFrame,
    names: DataFrame | None = None,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per conversation: its name, faults, the cost and letters of its cheapest edits (``audit``),
    and the digest of the repaired ``role:text`` lines.

    Rows are taken by turn (nulls first), then by role and a digest of the text. Keep costs nothing, Rerole
    to user or assistant 2, Delete 3 (blank and duplicate rows must go), Insert of an empty user or
    assistant row 2, and a truncated row that stays 1. The result's roles begin with s, u or a and read
    ``(s?(ua)+)?``; of equally cheap edits the ASCII-least letters are taken. ``names`` may be a table with
    conversations beyond those of ``turns``: those without rows have zeros, no audit and the digest of the
    empty text. Null roles and texts count as one space, a null name is a conversation of its own, repeated
    rows are duplicates, an empty table has no rows. Other columns are not looked at.

    Only codes of a byte a row take part in the search, in pieces of ``chunk`` rows, so a conversation may
    hold any share of the table. The lines of a conversation pass one task, in order and one at a time, as a
    digest over them must.
    """
    spark = turns.sparkSession
    said = _rows(turns, conversation, turn, role, text)
    traced = cut_lineage(edits(coded(said), chunk))
    every = turns if names is None else names
    name = every.select(_group_of(conversation).alias(_GROUP), F.col(f"`{conversation}`").alias("__name")).distinct()
    absent = {
        "__name": turns.schema[conversation].dataType, _TURN: turns.schema[turn].dataType, _ROLE: "string", _KEY: "binary",
        INDEX: "long", _TEXT: "string", "__code": "string", "__edit": "string",
    }
    columns = [_GROUP, "__section", *absent]

    def filled(df: DataFrame, section: int) -> DataFrame:
        missing = {c: F.lit(None).cast(kind) for c, kind in absent.items() if c not in df.columns}
        return df.withColumns({**missing, "__section": F.lit(section)}).select(*columns)

    letters = F.split("__edits", "")
    each = traced.select(_GROUP, F.explode(F.zip_with("__rows", letters, lambda r, e: F.struct(r.alias("r"), e.alias("e")))).alias("x"))
    rows = each.where(F.col("x.r").isNotNull()).select(_GROUP, "x.r.*", F.col("x.e").alias("__edit"))
    ends = traced.where("__last").select(_GROUP, F.substring("__edits", -1, 1).alias("__edit"))
    parts = [filled(name, _NAME), filled(said.where(~_is_blank(F.col(_TEXT))), _SAID), filled(rows, _EDIT), filled(ends, _END)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    middle = F.when(F.col("__section") == _NAME, 0).when(F.col("__section") == _END, 2).otherwise(1)
    order = [_GROUP, middle, F.col(_TURN).asc_nulls_first(), _ROLE, _KEY, "__section", INDEX]
    ordered = union.repartition(_GROUP).sortWithinPartitions(*order)
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    fields = [StructField(c, LongType() if c in longs else StringType()) for c in RESULTS]
    schema = StructType([StructField(conversation, turns.schema[conversation].dataType), *fields])
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)

        def batch_of(reports: list[_Report]) -> pa.RecordBatch:
            values = zip(*[r.values() for r in reports])
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, kinds)], names=schema.fieldNames())

        report: _Report | None = None
        for batch in batches:
            done = []
            for group, section, named, at, by, _, _, line, code, edit in zip(*[c.to_pylist() for c in batch.columns]):
                if report is None or group != report.group:
                    if report is not None:
                        done.append(report)
                    report = _Report(group)
                if section == _NAME:
                    report.conversation = named
                elif section == _SAID:
                    report.text = line
                elif section == _EDIT:
                    report.row(at, by, code, edit)
                else:
                    report.end(edit)
            if done:
                yield batch_of(done)
        if report is not None:
            yield batch_of([report])

    return ordered.mapInArrow(run, schema)
