"""Language identification by a byte convolutional network, trained and run in numpy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from shelfcast.llm.arrow import map_column
from shelfcast.llm.text import whole

#: Filter widths in bytes, filters of each, and bytes per window.
WIDTHS = (2, 3, 4)
FILTERS = 8
WINDOW = 256

#: Bounds of the training sample: documents per language, windows per document.
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 3

EPOCHS, BATCH, RATE, SEED = 8, 32, 0.01, 7

#: Windows scored together.
_GROUP = 256

UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_REACH = max(WIDTHS) - 1


def windows_of(raw: bytes) -> np.ndarray:
    """The lower-cased (ASCII) bytes as rows of WINDOW, each followed by the bytes its last filters need;
    zeros after the end. Every n-gram of the text lies in some row."""
    data = np.frombuffer(raw.lower(), dtype=np.uint8)
    n = max(1, -(-len(data) // WINDOW))
    padded = np.zeros(n * WINDOW + _REACH, dtype=np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + _REACH)[::WINDOW]


@dataclass
class Network:
    """Convolutions over one-hot bytes (a table per offset), max pooling, and a softmax layer."""

    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, 256, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    @classmethod
    def fresh(cls, languages: Sequence[str]) -> Network:
        random = np.random.default_rng(SEED)
        filters = [random.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        size = FILTERS * len(WIDTHS)
        weights = random.normal(0, 0.1, (size, len(languages))).astype(np.float32)
        zeros = np.zeros(size, dtype=np.float32), np.zeros(len(languages), dtype=np.float32)
        return cls(list(languages), filters, zeros[0], weights, zeros[1])

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.weights, self.offset]

    def gradients(self, rows: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over windows; a max passes its gradient to where it was reached."""
        n = len(rows)
        pooled, places = [], []
        for w, table in zip(WIDTHS, self.filters):
            out = sum(table[j][rows[:, j : j + WINDOW]] for j in range(w))
            best = out.argmax(axis=1)
            places.append(best)
            pooled.append(np.take_along_axis(out, best[:, None, :], axis=1)[:, 0])
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        error = _softmax(hidden @ self.weights + self.offset)
        error[np.arange(n), label] -= 1
        error /= n
        back = (error @ self.weights.T) * (hidden > 0)
        grads = []
        for k, (w, best) in enumerate(zip(WIDTHS, places)):
            grad = np.zeros_like(self.filters[k])
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            for j in range(w):
                byte = np.take_along_axis(rows, best + j, axis=1)
                np.add.at(grad[j], (byte, np.arange(FILTERS)[None, :]), own)
            grads.append(grad)
        return [*grads, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]

    def fit(self, rows: np.ndarray, label: np.ndarray) -> None:
        """Adam over shuffled windows, always in the same order."""
        random = np.random.default_rng(SEED)
        mean = [np.zeros_like(p) for p in self.parameters()]
        square = [np.zeros_like(p) for p in self.parameters()]
        step = 0
        for _ in range(EPOCHS):
            order = random.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                step += 1
                for p, g, m, s in zip(self.parameters(), self.gradients(rows[chosen], label[chosen]), mean, square):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """Per width: (offset, sums of its filters for every two bytes or for one), fewer look-ups a place."""
        out = []
        for w, table in zip(WIDTHS, self.filters):
            own = [(j, (table[j][:, None] + table[j + 1][None, :]).reshape(65536, FILTERS)) for j in range(0, w - 1, 2)]
            out.append(own + ([(w - 1, table[w - 1])] if w % 2 else []))
        return out

    def log_probabilities(self, rows: np.ndarray, tables: list[list[tuple[int, np.ndarray]]]) -> np.ndarray:
        parts = []
        for at in range(0, len(rows), _GROUP):
            # Places first, so that the maximum runs over whole rows of all windows and filters.
            byte = np.ascontiguousarray(rows[at : at + _GROUP].T)
            pair = byte[:-1].astype(np.uint16) * 256 + byte[1:]
            pooled = []
            for width in tables:
                out = None
                for j, table in width:
                    found = table[(pair if len(table) > 256 else byte)[j : j + WINDOW]]
                    out = found if out is None else np.add(out, found, out=out)
                pooled.append(out.max(axis=0))
            hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
            parts.append(np.log(_softmax(hidden @ self.weights + self.offset) + 1e-9))
        return np.concatenate(parts)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(id_column: Column) -> Column:
    """Whether a document may not be learnt from; a document without an id is neither held out nor learnt from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(df: DataFrame, text: str = "text", label: str = "lang", id_column: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """A network fitted on a bounded sample: about ``sample_docs`` different texts of every language, chosen by
    a hash of the text, with SAMPLE_WINDOWS windows spread over each whole text. None without labels. The
    share that is chosen goes by the different texts of a language, so one made of copies is learnt too.

    Held-out documents, null labels and texts without letters are left out. Only windows reach the driver.
    """
    content = whole(F.col(f"`{text}`"))
    known = df.select(content.alias("text"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{id_column}`").alias("id")).where(
        F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    # As many rows as the network has outputs.
    different = F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(different).collect()}
    if not counts:
        return None
    bounds = F.create_map(*[F.lit(x) for label, n in counts.items() for x in (label, min(1.0, sample_docs / max(n, 1)))])
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.element_at(bounds, F.col("label")) * (1 << 20)
    step = F.greatest(F.length("text") / SAMPLE_WINDOWS, F.lit(1))
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)),
        lambda i: F.substring(F.col("text"), (F.floor(i * step) + 1).cast("int"), F.lit(WINDOW)),
    )
    chosen = known.where(share).where(F.col("text").rlike(r"\p{L}"))
    sample = chosen.select("label", F.xxhash64("text").alias("h"), pieces.alias("pieces")).distinct().collect()
    by_language: dict[str, list] = {}
    for row in sorted(sample, key=lambda r: (r["label"], r["h"], r["pieces"])):
        own = by_language.setdefault(row["label"], [])
        if len(own) < sample_docs:
            own.append(row["pieces"])
    if not by_language:
        return None
    network = Network.fresh(sorted(by_language))
    rows, labels = [], []
    for i, language in enumerate(network.languages):
        found = [windows_of(p.encode())[0] for pieces in by_language[language] for p in pieces if _LETTER.search(p)]
        rows += found
        labels += [i] * len(found)
    network.fit(np.stack(rows), np.array(labels))
    return network


def identify(df: DataFrame, network: Network | None, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry``, ``lang_pred`` and ``score`` (probability of that language) for every whole text.

    A text's log probabilities are the mean of those of its windows, weighted by their bytes. Null texts
    and texts without a letter are ``und`` with score 0, and so is everything if nothing was learnt. Texts of
    any length are read whole, repeated rows are answered each, an empty table gives no rows. Rows stay where
    they are; input columns with the names of results are not carried.
    """

    def make(network=network):
        tables = network.tables() if network else []

        def run(texts: pa.Array) -> list[pa.Array]:
            contents = texts.to_pylist()
            known = [i for i, t in enumerate(contents) if network is not None and t is not None and _LETTER.search(t)]
            found = [(UNDETERMINED, 0.0)] * len(contents)
            if known:
                for i, answer in zip(known, whole_texts(network, tables, [contents[i].encode() for i in known])):
                    found[i] = answer
            return [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]

        return run

    return map_column(df, text, carry, [StructField("lang_pred", StringType()), StructField("score", DoubleType())], make)


def whole_texts(network: Network, tables: list, raw: Sequence[bytes]) -> list[tuple[str, float]]:
    """(language, probability) of every text, the windows of all of them scored together."""
    rows = [windows_of(r) for r in raw]
    counts = np.array([len(r) for r in rows])
    sizes = np.full(counts.sum(), WINDOW, dtype=np.float64)
    ends = np.cumsum(counts)
    sizes[ends - 1] = [len(r) - WINDOW * (n - 1) for r, n in zip(raw, counts)]
    logs = network.log_probabilities(np.concatenate(rows), tables) * sizes[:, None]
    mean = np.add.reduceat(logs, ends - counts, axis=0) / np.array([len(r) for r in raw])[:, None]
    probability = _softmax(mean)
    best = probability.argmax(axis=1)
    return [(network.languages[b], float(min(1.0, p[b]))) for b, p in zip(best, probability)]
