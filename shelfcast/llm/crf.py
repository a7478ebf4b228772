"""Document quality from lines: a linear-chain conditional random field, trained and run in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField

from shelfcast.llm.arrow import map_column
from shelfcast.llm.text import whole
from shelfcast.session import cut_lineage

#: Bounds of the training sample: different documents a label, consecutive lines a document.
SAMPLE_DOCS = 3000
SAMPLE_LINES = 64

STEPS, RATE, PENALTY = 200, 0.1, 1e-3

#: A document is predicted good from this score on.
GOOD = 0.7

#: Score of every document where nothing could be learnt.
UNKNOWN = 0.5

#: Bytes of lines that are looked at together; a longer line stands alone.
_SLICE = 4 << 20

# Classes of bytes: space, lower, upper, digit, sentence mark, exclamation mark, bar, other sign, not ASCII.
_SPACE, _LOWER, _UPPER, _DIGIT, _MARK, _CRY, _BAR, _SIGN, _WIDE = range(9)
_CLASSES = 9
_CLASS = np.full(256, _SIGN, dtype=np.int64)
_CLASS[128:] = _WIDE
for _chars, _kind in ((b" \t\n\v\f\r", _SPACE), (b".,;:?'\"-()", _MARK), (b"!", _CRY), (b"|", _BAR)):
    _CLASS[list(_chars)] = _kind
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_FOLDED = np.arange(256, dtype=np.uint64)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_FOLDED = (_FOLDED + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)

#: Base of the rolling hash of words, odd, and its inverse modulo 2 ** 64.
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)

FEATURES = (
    "log_words", "upper", "digits", "marks", "cries", "bars", "signs", "word_length", "repeats", "distinct", "seen_before", "ended",
)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _line_counts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines that begin at ``starts``, each ended by a line feed, but for ``seen_before``,
    and a hash of every line's words."""
    n = len(starts)
    sizes = np.diff(np.append(starts, len(data)))
    line = np.repeat(np.arange(n), sizes)
    kind = _CLASS[data]
    counts = np.bincount(line * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES)
    solid = counts[:, 1:].sum(axis=1)
    letters = counts[:, [_LOWER, _UPPER, _WIDE]].sum(axis=1)

    space = kind == _SPACE
    begins = np.flatnonzero(~space & np.append(True, space[:-1]))
    ends = np.flatnonzero(space & np.append(False, ~space[:-1]))
    of_line = line[begins]
    words = np.bincount(of_line, minlength=n)
    power = _powers(_BASE, len(data))
    sums = np.append(np.uint64(0), np.cumsum(_FOLDED[data] * power))
    hashed = (sums[ends] - sums[begins]) * _powers(_INVERSE, len(data))[begins]
    same = (of_line[1:] == of_line[:-1]) & (hashed[1:] == hashed[:-1])
    repeats = np.bincount(of_line[1:][same], minlength=n)
    order = np.lexsort((hashed, of_line))
    first = np.append(True, (np.diff(of_line[order]) != 0) | (hashed[order][1:] != hashed[order][:-1]))[: len(order)]
    distinct = np.bincount(of_line[order][first], minlength=n)
    place = np.arange(len(begins)) - np.repeat(np.append(0, np.cumsum(words)[:-1]), words)
    mixed = hashed * (np.uint64(2) * place.astype(np.uint64) + np.uint64(1))
    totals = np.append(np.uint64(0), np.cumsum(mixed))
    bounds = np.append(0, np.cumsum(words))
    line_hash = totals[bounds[1:]] - totals[bounds[:-1]] + words.astype(np.uint64)

    per_byte = np.maximum(solid, 1)
    last = data[np.maximum(starts + sizes - 2, 0)]
    ended = np.isin(last, list(b".!?")) & (sizes > 1)
    share = lambda c: np.sqrt(counts[:, c] / per_byte)
    columns = [
        np.log1p(words), np.sqrt(counts[:, _UPPER] / np.maximum(letters, 1)), share(_DIGIT), share(_MARK), share(_CRY), share(_BAR),
        share(_SIGN), np.minimum(solid / np.maximum(words, 1), 20) / 10, repeats / np.maximum(words, 1),
        distinct / np.maximum(words, 1), np.zeros(n), ended,
    ]
    return np.stack(columns, axis=1), line_hash


def line_features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, bytes of every line with its end, lines of every text).

    Lines are what line feeds separate, so an empty text is one empty line. Words are compared in lower
    case (ASCII); a line has been seen before if an earlier one of its text has the same words.
    """
    raw = [t.encode() + b"\n" for t in texts]
    per_text = np.array([r.count(b"\n") for r in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    starts = np.append(0, np.flatnonzero(data == 10)[:-1] + 1)
    sizes = np.diff(np.append(starts, len(data)))
    parts, hashes, at = [], [], 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + _SLICE)))
        stop = starts[end] if end < len(starts) else len(data)
        features, hashed = _line_counts(data[starts[at] : stop], starts[at:end] - starts[at])
        parts.append(features)
        hashes.append(hashed)
        at = end
    found, line_hash = np.concatenate(parts), np.concatenate(hashes)
    text = np.repeat(np.arange(len(texts)), per_text)
    order = np.lexsort((line_hash, text))
    again = (np.diff(text[order]) == 0) & (line_hash[order][1:] == line_hash[order][:-1]) & (found[order[1:], 0] > 0)
    found[order[1:][again], FEATURES.index("seen_before")] = 1
    return found, sizes, per_text


def with_neighbours(features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Every line's features, those of the line before and after it in its text (zeros where there is none,
    with a flag), and a constant."""
    n = len(features)
    ends = np.cumsum(per_text)
    first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    first[ends - per_text], last[ends - 1] = True, True
    before, after = np.roll(features, 1, axis=0), np.roll(features, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.concatenate([features, before, after, first[:, None], last[:, None], np.ones((n, 1))], axis=1)


def _chains(per_text: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the first, second, ... lines of all texts that have one, longest texts first."""
    order = np.argsort(-per_text, kind="stable")
    begins, lengths = (np.cumsum(per_text) - per_text)[order], per_text[order]
    for t in range(int(lengths[0]) if len(lengths) else 0):
        yield begins[: np.searchsorted(-lengths, -t)] + t


def forward_backward(emission: np.ndarray, transition: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward, backward, log partition per line) in logarithms; ``emission`` is that of good, bad has 0."""
    n = len(emission)
    score = np.stack([np.zeros(n), emission], axis=1)
    forward, backward, total = score.copy(), np.zeros((n, 2)), np.empty(n)
    steps = list(_chains(per_text))
    for before, at in zip(steps, steps[1:]):
        came = forward[at - 1][:, :, None] + transition
        forward[at] = score[at] + np.logaddexp(came[:, 0], came[:, 1])
    for at in reversed(steps[1:]):
        goes = transition + (score[at] + backward[at])[:, None, :]
        backward[at - 1] = np.logaddexp(goes[:, :, 0], goes[:, :, 1])
    both = forward + backward
    total = np.logaddexp(both[:, 0], both[:, 1])
    return forward, backward, total


@dataclass
class Field:
    """Weights of the features and of the transitions (from, to) between bad (0) and good (1) lines."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    transition: np.ndarray

    @classmethod
    def fitted(cls, features: list[np.ndarray], labels: np.ndarray, importance: np.ndarray) -> Field:
        """The field of greatest penalised likelihood, every line having the label of its document."""
        per_text = np.array([len(f) for f in features])
        raw = np.concatenate(features)
        mean, scale = raw.mean(axis=0), raw.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        mean = np.where(raw.std(axis=0) > 1e-9, mean, 0.0)
        x = (raw - mean) / scale
        y = np.repeat(labels, per_text).astype(np.float64)
        weight = np.repeat(importance / per_text, per_text)
        weight /= weight.sum()
        field = cls(mean, scale, np.zeros(x.shape[1]), np.zeros((2, 2)))
        inner = np.ones(len(x), dtype=bool)
        inner[np.cumsum(per_text) - 1] = False
        pairs = np.flatnonzero(inner)
        label = y.astype(np.int64)[pairs]
        flat = np.concatenate([field.weights, field.transition.ravel()])
        mean_g, mean_s = np.zeros_like(flat), np.zeros_like(flat)
        for step in range(1, STEPS + 1):
            w, a = flat[:-4], flat[-4:].reshape(2, 2)
            e = x @ w
            forward, backward, total = forward_backward(e, a, per_text)
            good = np.exp(forward[:, 1] + backward[:, 1] - total)
            grad = np.empty_like(flat)
            grad[:-4] = x.T @ (weight * (good - y)) + PENALTY * w
            score = np.stack([np.zeros(len(e)), e], axis=1)
            joint = forward[pairs][:, :, None] + a + (score + backward)[pairs + 1][:, None, :] - total[pairs][:, None, None]
            expected = (np.exp(joint) * weight[pairs][:, None, None]).sum(axis=0)
            seen = np.zeros((2, 2))
            np.add.at(seen, (label, label), weight[pairs])
            grad[-4:] = (expected - seen + PENALTY * a).ravel()
            mean_g += 0.1 * (grad - mean_g)
            mean_s += 0.001 * (grad * grad - mean_s)
            flat -= RATE * (mean_g / (1 - 0.9**step)) / (np.sqrt(mean_s / (1 - 0.999**step)) + 1e-8)
        field.weights, field.transition = flat[:-4], flat[-4:].reshape(2, 2)
        return field

    def line_marginals(self, features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Probability that a line is good, given its whole document."""
        emission = (features - self.mean) / self.scale @ self.weights
        forward, backward, total = forward_backward(emission, self.transition, per_text)
        return np.exp(np.minimum(forward[:, 1] + backward[:, 1] - total, 0))

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """Marginals of every text's lines, weighted by their bytes."""
        if not len(texts):
            return np.empty(0)
        features, sizes, per_text = line_features(texts)
        good = self.line_marginals(with_neighbours(features, per_text), per_text)
        ends = np.cumsum(per_text) - per_text
        return np.clip(np.add.reduceat(good * sizes, ends) / np.add.reduceat(sizes, ends), 0, 1)


def held_out(id_column: Column) -> Column:
    """Whether a document's label may not be learnt from; without an id there is no label."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    df: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    label: str = "quality",
    sample_docs: int = SAMPLE_DOCS,
    sample_lines: int = SAMPLE_LINES,
) -> Field | None:
    """A field fitted on a bounded sample: the ``sample_docs`` different texts of each label (0, 1) that come
    first by their hash, ``sample_lines`` consecutive lines of each. None unless both labels are there.

    Held-out documents and other labels are left out; documents count by what share of their label was
    sampled. Texts are not moved: hashes meet the labels, and the chosen ids, which ``sample_docs`` bounds,
    are sent to the texts. Only features of the sample reach the driver.
    """
    known = labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    hashed = df.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(whole(F.col(f"`{text}`"))).alias("hash"))
    different = cut_lineage(hashed.join(known, "id").groupBy("label", "hash").agg(F.min("id").alias("id")))
    counts = {r["label"]: r["n"] for r in different.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(counts) != {0, 1}:
        return None
    # A share somewhat larger than wanted, of which the window then takes the exact number.
    rate = F.when(F.col("label") == 1, 2 * sample_docs / counts[1]).otherwise(2 * sample_docs / counts[0])
    spread = F.pmod(F.xxhash64("hash"), F.lit(1 << 30)) / float(1 << 30)
    first = Window.partitionBy("label").orderBy(F.xxhash64("hash"), "hash")
    chosen = different.where(spread < rate).withColumn("place", F.row_number().over(first)).where(F.col("place") <= sample_docs)
    chosen = cut_lineage(chosen.select("label", "id", "hash"))

    def make():
        def run(texts: pa.Array) -> list[pa.Array]:
            values = texts.to_pylist()
            features, _, per_text = line_features(values)
            ready = with_neighbours(features, per_text).astype(np.float32)
            out, at = [], 0
            for n, value in zip(per_text, values):
                skip = (len(value) * 7919) % (n - sample_lines + 1) if n > sample_lines else 0
                out.append(ready[at + skip : at + min(n, skip + sample_lines)].ravel())
                at += n
            return [pa.array(out, pa.list_(pa.float32()))]

        return run

    texts = df.select(F.col(f"`{id_column}`").alias("id"), whole(F.col(f"`{text}`")).alias("text"))
    texts = texts.join(F.broadcast(chosen), "id").where(F.xxhash64("text") == F.col("hash"))
    found = map_column(texts, "text", ["label", "hash"], [StructField("features", ArrayType(FloatType()))], make)
    rows = {(r["label"], r["hash"]): r["features"] for r in found.collect()}
    width = 3 * len(FEATURES) + 3
    order = sorted(rows)
    features = [np.array(rows[k], dtype=np.float64).reshape(-1, width) for k in order]
    y = np.array([k[0] for k in order])
    importance = np.where(y == 1, counts[1] / max(1, (y == 1).sum()), counts[0] / max(1, (y == 0).sum()))
    return Field.fitted(features, y, importance)


def score_quality(df: DataFrame, field: Field | None, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry``, ``score`` (0 to 1, higher: better) and ``predicted`` (1 from GOOD on) for every whole text.

    Null counts as the empty text, which is one empty line. Repeated rows are scored each, rows stay where
    they are, and of an empty table nothing comes. Without a field every score is UNKNOWN. Input columns
    with the names of results are not carried.
    """

    def make(field=field):
        def run(texts: pa.Array) -> list[pa.Array]:
            values = [t or "" for t in texts.to_pylist()]
            return [pa.array(np.full(len(values), UNKNOWN) if field is None else field.scores(values), pa.float64())]

        return run

    kept = [c for c in carry if c not in ("score", "predicted")]
    scored = map_column(df, text, kept, [StructField("score", DoubleType())], make)
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
