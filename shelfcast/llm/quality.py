"""Quality rules on whole texts, and host verdicts from shrunken failure rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.text import SPACES, whole, words
from shelfcast.operators.joins import attach
from shelfcast.schema import N_ROWS
from shelfcast.session import cut_lineage

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

#: Limits of the soft rules at a host as good as the others: symbols a word character, repeated lines a line.
MAX_SYMBOL_SHARE = 0.1
MAX_DUP_LINE_SHARE = 0.6

#: A host's limits are its usual ones divided by how often its documents fail against the mean of all
#: hosts; by this number at most, and multiplied by it at most.
MAX_STRICTNESS = 2.0

#: Strength of the prior, in documents, where the hosts' rates do not differ at all.
MAX_PRIOR = 1e6

#: What a soft rule counts, its limit, and what the limit is a share of.
SOFT_RULES = {"symbols": ("n_symbols", MAX_SYMBOL_SHARE, "word_chars"), "dup_lines": ("n_dup_lines", MAX_DUP_LINE_SHARE, "n_lines")}
RULES = ("base", *SOFT_RULES)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeat_words(windows: Column, ordered: Column) -> Column:
    """Words covered by windows found twice or more; ``ordered``: (window, place) sorted, null without repeats."""
    n = F.size(windows)
    pairs = F.zip_with(
        F.slice(ordered, 1, n - 1),
        F.slice(ordered, 2, n - 1),
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )
    places = F.array_sort(F.array_distinct(F.flatten(pairs)))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        places,
        start,
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    return F.when(ordered.isNull(), F.lit(0)).otherwise(covered)


def text_counts(df: DataFrame, text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """``carry`` and the counts of every text: words, code points in words, symbols, lines with a word,
    lines equal to an earlier one, and words inside repeated 3-word windows.

    Null and empty texts have zero everywhere. Everything of a row is computed in that row; sorting the
    windows, the one step above linear, happens only where a window does occur twice.
    """
    keep = [F.col(f"`{c}`") for c in carry]
    t = F.col("__text")
    step = df.select(*keep, whole(F.col(f"`{text}`")).alias("__text"))
    lines = F.filter(F.split(t, "\n", -1), lambda line: line.rlike(f"[^{SPACES}]"))
    symbols = F.length(F.regexp_replace(t, "[^" + "".join(f"\\{c}" for c in SYMBOLS) + "]+", ""))
    step = step.select(*keep, words(t).alias("__words"), lines.alias("__lines"), symbols.cast("long").alias("n_symbols"))
    w, n = F.col("__words"), F.size("__words")
    window = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    step = step.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, window).otherwise(F.array().cast("array<string>")).alias("__windows"),
    )
    x = F.col("__windows")
    placed = F.array_sort(F.transform(x, lambda v, i: F.struct(v.alias("w"), i.alias("i"))))
    counts = [c for c in COUNTS if c != "n_repeat_words"]
    step = step.select(
        *keep, *counts, "__windows", F.when(F.size(x) > F.size(F.array_distinct(x)), placed).alias("__ordered")
    )
    repeat = _repeat_words(F.col("__windows"), F.col("__ordered")).cast("long")
    return step.select(*keep, *counts, repeat.alias("n_repeat_words"))


def rule_failures() -> dict[str, Column]:
    """Failure of each rule as a boolean over the counts of :func:`text_counts`."""
    return {
        "base": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        **{rule: F.col(count) > limit * F.col(of) for rule, (count, limit, of) in SOFT_RULES.items()},
    }


def host_rates(failed: DataFrame, host: str, rules: Sequence[str] = RULES) -> tuple[DataFrame, dict[str, float]]:
    """(host, n_rows, rate_<rule>): failure rates shrunk by a beta prior fitted to all hosts; the priors' means.

    The prior of a rule has the mean and the variance of the hosts' raw rates (method of moments). Every
    task sums its documents first, so a host with a third of them sends one row per task.
    """
    n = F.col(N_ROWS)
    hosts = cut_lineage(
        failed.where(F.col(host).isNotNull())
        .groupBy(host)
        .agg(F.count(F.lit(1)).alias(N_ROWS), *[F.count_if(F.col(f"fails_{r}")).alias(f"n_{r}") for r in rules])
    )
    moments = hosts.agg(
        *[F.avg(F.col(f"n_{r}") / n).alias(f"mean_{r}") for r in rules],
        *[F.var_pop(F.col(f"n_{r}") / n).alias(f"var_{r}") for r in rules],
    ).first()
    rates, means = [], {}
    for r in rules:
        mean, var = moments[f"mean_{r}"] or 0.0, moments[f"var_{r}"] or 0.0
        strength = min(max(mean * (1 - mean) / var - 1, 1.0), MAX_PRIOR) if var > 0 else MAX_PRIOR
        means[r] = mean
        rates.append(((F.col(f"n_{r}") + mean * strength) / (n + strength)).alias(f"rate_{r}"))
    return hosts.select(host, N_ROWS, *rates), means


def _strictness(rates: dict[str, Column], means: dict[str, float], rule: str) -> Column:
    """How much closer a host's limit for a soft rule is: its rates of that rule and of the base rules against
    the means, rounded so that equal hosts are exactly 1."""
    excess = F.lit(1.0)
    for r in (rule, "base"):
        if means[r] > 0:
            excess = excess * (rates[r] / F.lit(means[r]))
    return F.round(F.greatest(F.least(excess, F.lit(MAX_STRICTNESS)), F.lit(1 / MAX_STRICTNESS)), 6)


def judge(df: DataFrame, text: str = "text", host: str = "source", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry``, ``host``, the counts, ``base_failed``, ``host_bad`` and ``kept`` per document.

    A document goes if it fails the base rules, or a soft rule at the limit of its host: a host whose
    documents fail more often than others' is trusted less, and its limits are closer. ``host_bad`` tells
    that a limit is as close as it gets. Counts are written once to the shared folder, so texts are read
    once. Documents without a host have the limits of a host like the others. Null and empty texts have no
    words and fail; repeated rows are judged each and count each for their host; an empty table gives no
    rows; input columns with the names of results are not carried. Rows of a host that holds very many are
    spread over tasks where its verdict meets them.
    """
    names = (*COUNTS, *[f"fails_{r}" for r in RULES], "base_failed", "host_bad", "kept", "__host")
    keep = [c for c in dict.fromkeys(carry) if c not in names]
    hosted = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__source_text"), F.col(f"`{host}`").alias("__host"))
    counted = text_counts(hosted, "__source_text", [*keep, "__host"])
    failed = cut_lineage(counted.withColumns({f"fails_{r}": c for r, c in rule_failures().items()}))
    rates, means = host_rates(failed, "__host")
    by_rule = {r: F.col(f"rate_{r}") for r in RULES}
    verdicts = cut_lineage(rates.select("__host", N_ROWS, *[_strictness(by_rule, means, r).alias(f"strict_{r}") for r in SOFT_RULES]))
    joined = attach(failed, verdicts, ["__host"], weights=verdicts, how="left")
    strict = {r: F.coalesce(f"strict_{r}", F.lit(1.0)) for r in SOFT_RULES}
    soft = F.lit(False)
    for rule, (count, limit, of) in SOFT_RULES.items():
        soft = soft | (F.col(count) * strict[rule] > limit * F.col(of))
    return joined.select(
        *[F.col(f"`{c}`") for c in keep],
        *COUNTS,
        F.col("fails_base").alias("base_failed"),
        (F.greatest(*strict.values()) >= MAX_STRICTNESS).alias("host_bad"),
        (~(F.col("fails_base") | soft)).alias("kept"),
    )
