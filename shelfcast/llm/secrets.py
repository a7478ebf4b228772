"""Secret scan with ownership frequency: who else holds the same string?"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.llm.text import whole
from shelfcast.operators.joins import attach
from shelfcast.schema import N_ROWS
from shelfcast.session import cut_lineage

# Kinds in the order of ties, their patterns and least lengths. The keyword of `assign` is
# matched in either case (ASCII), its value is what follows the separator.
KEYWORD = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
PATTERNS = {
    "assign": KEYWORD + r"(?-i)[A-Za-z0-9+/_.=-]+",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "owned": r"[A-Za-z0-9+/_-]{20,}",
}
BASE = ("assign", "access", "hex")
MIN_VALUE = 6

#: A candidate is owner-specific if no more owners than this hold it, and copied otherwise.
MAX_OWNERS = 1


def _gaps_and_matches(text: Column, pattern: str) -> Column:
    """Null without a match, else [(code points before the match and after the last one, match), ...]."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    return F.when(text.rlike(pattern), F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match")))


def _value(kind: Column, match: Column) -> Column:
    return F.when(kind == "assign", F.regexp_replace(match, "^" + KEYWORD, "")).otherwise(match)


def _is_candidate(kind: Column, value: Column) -> Column:
    """The failing matches go: short values, and long words that do not mix letters and digits."""
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return F.when(kind == "assign", F.length(value) >= MIN_VALUE).when(kind == "owned", mixed).otherwise(F.lit(True))


def _scanned(df: DataFrame, text: str, owner: str, repository: str, carry: Sequence[str]) -> DataFrame:
    """One row per document with the matches of each kind, written once so that row numbers stay."""
    found = df.select(
        F.monotonically_increasing_id().alias("__row"),
        *[F.col(f"`{c}`").alias(f"__carry_{i}") for i, c in enumerate(carry)],
        F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")).alias("__owner"),
        F.coalesce(F.col(f"`{repository}`").cast("string"), F.lit("")).alias("__repository"),
        whole(F.col(f"`{text}`")).alias("__text"),
    )
    plain = [c for c in found.columns if c != "__text"]
    return cut_lineage(found.select(*plain, *[_gaps_and_matches(F.col("__text"), p).alias(k) for k, p in PATTERNS.items()]))


def _any_match() -> Column:
    return reduce(or_, [F.col(kind).isNotNull() for kind in PATTERNS])


def _candidates(scanned: DataFrame) -> DataFrame:
    """(row, owner, repository, rank, kind, start, end, value) of every match that passes its length."""
    matches = F.array(
        *[F.struct(F.lit(i).alias("rank"), F.lit(k).alias("kind"), F.col(k).alias("found")) for i, k in enumerate(PATTERNS)]
    )
    by_kind = scanned.where(_any_match()).select("__row", "__owner", "__repository", F.inline(matches))
    each = by_kind.where(F.col("found").isNotNull()).select(
        "__row", "__owner", "__repository", "rank", "kind", F.posexplode("found").alias("place", "part")
    )
    each = each.select("*", F.col("part.gap").alias("gap"), F.col("part.match").alias("match")).where(F.col("match").isNotNull())
    # Windows within one text and kind: bounded by the length of a text.
    within = Window.partitionBy("__row", "rank").orderBy("place")
    end = F.sum(F.col("gap") + F.length("match")).over(within)
    placed = each.select("__row", "__owner", "__repository", "rank", "kind", "match", end.alias("end"))
    valued = placed.select("*", (F.col("end") - F.length("match")).alias("start"), _value(F.col("kind"), F.col("match")).alias("value"))
    return valued.where(_is_candidate(F.col("kind"), F.col("value")))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_rows, n_owners, n_repositories) over the whole corpus.

    Candidates are reduced to one row for each (hash, owner, repository) inside each task first, so a string
    that a third of the corpus holds arrives as a few rows.
    """
    held = candidates.groupBy("hash", "__owner", "__repository").agg(F.count(F.lit(1)).alias(N_ROWS))
    return held.groupBy("hash").agg(
        F.sum(N_ROWS).alias(N_ROWS),
        F.count_distinct("__owner").alias("n_owners"),
        F.count_distinct("__owner", "__repository").alias("n_repositories"),
    )


def find_secrets(
    df: DataFrame, text: str = "text", owner: str = "source", repository: str = "lang", carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``carry`` and ``found`` per document: an array of (start, rank, end, kind, hash, n_owners,
    n_repositories, live), ordered by start, then kind.

    Base kinds are always there; ``live`` tells whether only one owner holds the value. Long strings that
    mix letters and digits (kind ``owned``) are added where that is so and no base span overlaps them:
    the same string at several owners is an example that people copy. A repository is one ``repository``
    value of an owner. Offsets are code points, the end is exclusive. Null and empty texts find nothing,
    unknown owners count as one owner, repeated rows are scanned each, and an empty table gives no rows. Whole
    texts are scanned, whatever their length. An input column called ``found`` is not carried.

    A string that very many rows hold is spread over tasks where it meets its owners.
    """
    carry = [c for c in dict.fromkeys(carry) if c != "found"]
    scanned = _scanned(df, text, owner, repository, carry)
    candidates = cut_lineage(_candidates(scanned).select("__row", "__owner", "__repository", "rank", "kind", "start", "end", F.md5("value").alias("hash")))
    held = cut_lineage(ownership(candidates))
    judged = attach(candidates, held, ["hash"], weights=held)
    # Windows within one text: does a base span reach into this one from the left or start inside it?
    is_base, text_rows = F.col("rank") < len(BASE), Window.partitionBy("__row")
    to_here = text_rows.orderBy(F.col("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = text_rows.orderBy(F.col("start").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reach, following = F.max(F.when(is_base, F.col("end"))).over(to_here), F.min(F.when(is_base, F.col("start"))).over(from_here)
    live = F.col("n_owners") <= MAX_OWNERS
    placed = judged.select("*", live.alias("live"), reach.alias("reach"), following.alias("following"))
    clash = F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("following") < F.col("end"), F.lit(False))
    span = F.struct("start", "rank", "end", "kind", "hash", "n_owners", "n_repositories", "live")
    wanted = placed.where(is_base | (F.col("live") & ~clash))
    spans = wanted.groupBy("__row").agg(F.array_sort(F.collect_list(span)).alias("found"))
    empty = F.array().cast(spans.schema["found"].dataType)
    kept = [F.col(f"__carry_{i}").alias(c) for i, c in enumerate(carry)]
    matched = scanned.where(_any_match()).join(spans, "__row", "left").select(*kept, F.coalesce("found", empty).alias("found"))
    # Documents without a match need no join, so what they carry is not shuffled.
    return matched.unionByName(scanned.where(~_any_match()).select(*kept, empty.alias("found")))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every found span replaced by ``mask``; overlapping spans are replaced together."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc, s):
        piece = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        added = F.concat(acc["parts"], F.array(piece, F.lit(mask)))
        parts = F.when(s["start"] >= acc["at"], added).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    tail = lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, tail)).otherwise(text)
