"""Benchmark decontamination: BM25 over test items, block-max pruning, question and answer overlap."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from shelfcast.llm.arrow import map_column
from shelfcast.llm.text import whole

# BM25 weights, and the share of an item's own score that a passage must reach.
K1, B = 1.2, 0.75
THRESHOLD = 0.6

#: Share of the distinct words of question and answer that the passage holds, and of the item's 5-word
#: shingles in their order.
MIN_OVERLAP = 0.8
MIN_SHINGLES = 0.5
SHINGLE = 5

#: Items per block of the index, and words of test items that go to the workers at once.
BLOCK = 8
INDEX_WORDS = 1_000_000

#: Words of documents that are scored together.
BATCH_WORDS = 200_000

# Fixed value: ASCII punctuation, which separates words just as spaces do.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CLEAN = bytes.maketrans((_UPPER + PUNCTUATION).encode(), (_LOWER + " " * len(PUNCTUATION)).encode())


def clean_words(text: Column) -> Column:
    """Words without case and punctuation, both in ASCII only."""
    clean = F.translate(whole(text), _UPPER + PUNCTUATION, _LOWER + " " * len(PUNCTUATION))
    return F.array_remove(F.split(clean, r"[\x20\x09-\x0D]+"), "")


def _words_of(text: str) -> list[bytes]:
    return text.encode().translate(_CLEAN).split()


class Index:
    """Inverted index of the test items of one length class.

    Impacts are an item's BM25 weights divided by its own score, so a passage holding the whole item
    scores 1. ``block_max`` has the largest impact of each term per block of items.
    """

    def __init__(self, items: list[list[int]], numbers: list[int], idf: np.ndarray, mean_length: float):
        self.items, self.numbers = items, numbers
        self.stride = max(len(i) for i in items)
        terms, owners, impacts = [], [], []
        for i, words in enumerate(items):
            term, count = np.unique(np.array(words, dtype=np.int64), return_counts=True)
            weight = idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * len(words) / mean_length))
            terms.append(term)
            owners.append(np.full(len(term), i))
            impacts.append(weight / weight.sum())
        term, owner, impact = np.concatenate(terms), np.concatenate(owners), np.concatenate(impacts)
        n_terms = len(idf)
        order = np.lexsort((owner, term))
        self.owner, self.impact = owner[order], impact[order]
        self.at = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.n_blocks = -(-len(items) // BLOCK)
        pairs, first = np.unique(term[order] * self.n_blocks + self.owner // BLOCK, return_index=True)
        self.block = pairs % self.n_blocks
        self.block_max = np.maximum.reduceat(self.impact, first)
        self.block_at = np.searchsorted(pairs // self.n_blocks, np.arange(n_terms + 1))
        self.bound = np.zeros(n_terms)
        np.maximum.at(self.bound, term, impact)
        shingles = [{tuple(w[i : i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))} for w in items]
        self.shingles = shingles

    def search(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) of every pair scoring at least THRESHOLD; input: distinct pairs, ordered.

        The terms of a passage are taken by rising bound. While their bounds add up to less than the
        threshold, an item found by these terms alone cannot pass; the term that lifts the sum over it is
        the pivot, and only blocks that hold the pivot or a later term are looked at. A block is skipped
        unless the block maxima of all terms of the passage reach the threshold together.
        """
        bound = self.bound[term]
        known = bound > 0
        passage, term, bound = passage[known], term[known], bound[known]
        order = np.lexsort((bound, passage))
        passage, term, bound = passage[order], term[order], bound[order]
        starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]]) if len(passage) else np.zeros(0, dtype=int)
        sums = np.cumsum(bound)
        before = np.repeat(sums[starts] - bound[starts], np.diff(np.r_[starts, len(passage)]))
        essential = sums - before >= THRESHOLD - 1e-9
        reached = np.unique(passage[essential])
        if not len(reached):
            return passage[:0], term[:0], bound[:0]
        rows, blocks = self._expand(passage[essential], term[essential], self.block_at)
        candidates = np.unique(rows * self.n_blocks + self.block[blocks])
        mine = np.isin(passage, reached, assume_unique=False)
        passage, term = passage[mine], term[mine]
        rows, blocks = self._expand(passage, term, self.block_at)
        upper = self._sums(rows * self.n_blocks + self.block[blocks], self.block_max[blocks], candidates)
        candidates = candidates[upper >= THRESHOLD - 1e-9]
        mine = np.isin(passage, candidates // self.n_blocks)
        rows, entries = self._expand(passage[mine], term[mine], self.at)
        owner = self.owner[entries]
        mine = np.isin(rows * self.n_blocks + owner // BLOCK, candidates)
        keys = rows[mine] * len(self.items) + owner[mine]
        hits, place = np.unique(keys, return_inverse=True)
        score = np.bincount(place, weights=self.impact[entries[mine]], minlength=len(hits))
        good = score >= THRESHOLD
        return hits[good] // len(self.items), hits[good] % len(self.items), score[good]

    @staticmethod
    def _expand(passage: np.ndarray, term: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The passage and the place of every posting of its terms."""
        n = at[term + 1] - at[term]
        ends = np.cumsum(n)
        places = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n - at[term], n)
        return np.repeat(passage, n), places

    @staticmethod
    def _sums(keys: np.ndarray, weights: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
        hit = wanted[place] == keys
        return np.bincount(place[hit], weights=weights[hit], minlength=len(wanted))

    def verify(self, item: int, words: np.ndarray) -> tuple[float, float, float]:
        """Overlap of the first and the second half of the item's words, and of its shingles in order."""
        own, seen = self.items[item], words.tolist()
        half = (len(own) + 1) // 2
        have = set(seen)
        question, answer = set(own[:half]), set(own[half:]) or set(own)
        size = min(SHINGLE, len(own))
        found = {tuple(seen[i : i + size]) for i in range(len(seen) - size + 1)} & self.shingles[item]
        return (
            len(question & have) / len(question),
            len(answer & have) / len(answer),
            len(found) / len(self.shingles[item]),
        )


class Matcher:
    """All length classes of one part of the test items."""

    def __init__(self, items: list[list[str]], frequency: dict[str, int], n_items: int, mean_length: float):
        self.vocabulary = {w.encode(): i + 1 for i, w in enumerate(frequency)}
        idf = np.array([0.0] + [math.log(1 + (n_items - n + 0.5) / (n + 0.5)) for n in frequency.values()])
        by_class: dict[int, list[int]] = {}
        for number, words in enumerate(items):
            by_class.setdefault(max(6, (len(words) - 1).bit_length()), []).append(number)
        self.indexes = []
        for numbers in by_class.values():
            numbers.sort(key=lambda n: len(items[n]))
            coded = [[self.vocabulary[w.encode()] for w in items[n]] for n in numbers]
            self.indexes.append(Index(coded, numbers, idf, mean_length))

    def match(self, texts: list[str]) -> Iterator[dict[int, tuple[float, float, float]]]:
        """For each text: item number -> (score, question overlap, answer overlap) of verified items."""
        batch, size = [], 0
        for text in texts:
            words = _words_of(text)
            batch.append(np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.int64, count=len(words)))
            size += len(words)
            if size >= BATCH_WORDS:
                yield from self._match(batch)
                batch, size = [], 0
        yield from self._match(batch)

    def _match(self, coded: list[np.ndarray]) -> list[dict[int, tuple[float, float, float]]]:
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in coded]
        if not coded:
            return found
        lengths = np.array([len(c) for c in coded])
        words = np.concatenate(coded)
        text_of_word = np.repeat(np.arange(len(coded)), lengths)
        start_of_text = np.cumsum(lengths) - lengths
        known = np.flatnonzero(words)
        n_terms = len(self.vocabulary) + 1
        for index in self.indexes:
            # Passages of two cells, half overlapping: an item lies within one of them wherever it stands.
            cells = -(-lengths // index.stride)
            first_cell = np.cumsum(cells) - cells
            text = text_of_word[known]
            inside = known - start_of_text[text]
            cell = first_cell[text] + inside // index.stride
            again = inside >= index.stride
            keys = np.unique(np.r_[cell * n_terms + words[known], (cell[again] - 1) * n_terms + words[known][again]])
            passages, items, scores = index.search(keys // n_terms, keys % n_terms)
            for p, item, score in zip(passages.tolist(), items.tolist(), scores.tolist()):
                t = int(np.searchsorted(first_cell, p, side="right")) - 1
                at = (p - int(first_cell[t])) * index.stride
                question, answer, order = index.verify(item, coded[t][at : at + 2 * index.stride])
                if question >= MIN_OVERLAP and answer >= MIN_OVERLAP and order >= MIN_SHINGLES:
                    number = index.numbers[item]
                    found[t][number] = max(found[t].get(number, (0.0, 0.0, 0.0)), (score, question, answer))
        return found


def find_contamination(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    index_words: int = INDEX_WORDS,
) -> DataFrame:
    """``carry`` and ``matches`` for every row: an array of (item, score, question_overlap, answer_overlap).

    Every passage of every text is a query against a BM25 index of the test items; what reaches THRESHOLD
    of an item's own score is verified on the words of its two halves (question, answer) and on their
    order. Document frequencies come from all items. The index goes to the workers in parts of at most
    about ``index_words`` words, each part being a pass over the documents, so its size has a bound; one
    pass serves tens of thousands of items. Documents are neither shuffled nor collected.

    Null and empty texts match nothing, items without words are skipped, items with equal ids or texts
    match each, and without items nothing matches. An input column named ``matches`` is not carried.
    """
    items = benchmark.select(F.col(f"`{item_id}`").alias("item"), clean_words(F.col(f"`{item_text}`")).alias("words"))
    items = items.where(F.size("words") > 0)
    total = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("words")).alias("words")).first()
    kind = benchmark.schema[item_id].dataType
    measures = ("score", "question_overlap", "answer_overlap")
    match_type = ArrayType(StructType([StructField("item", kind), *[StructField(m, DoubleType(), False) for m in measures]]))
    kept = [c for c in carry if c != "matches"]
    if not total["n"]:
        return df.select(*[F.col(f"`{c}`") for c in kept], F.array().cast(match_type).alias("matches"))
    n_parts = math.ceil(total["words"] / index_words)
    parted = items.withColumn("part", F.pmod(F.xxhash64("item", "words"), F.lit(n_parts)))
    frequency = items.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    names = [f"__carry_{i}" for i in range(len(kept))]
    out = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)], F.col(f"`{text}`").alias("__text"))
    out = out.withColumn("__matches", F.array().cast(match_type))
    struct = pa.struct([pa.field("item", to_arrow_type(kind)), *[pa.field(m, pa.float64(), nullable=False) for m in measures]])
    for part in range(n_parts):
        own = parted.where(F.col("part") == part).orderBy(F.size("words"), "item", "words").collect()
        if not own and part < n_parts - 1:
            continue
        words = parted.where(F.col("part") == part).select(F.explode("words").alias("word")).distinct()
        counts = {r["word"]: r["n"] for r in frequency.join(words, "word").collect()}
        ids = [r["item"] for r in own]
        matcher = Matcher([r["words"] for r in own], counts, total["n"], total["words"] / total["n"])

        def make(matcher=matcher, ids=ids):
            def run(texts: pa.Array) -> list[pa.Array]:
                found = matcher.match([t.as_py() or "" for t in texts])
                rows = [[dict(zip(("item", *measures), (ids[n], *m))) for n, m in sorted(own.items())] for own in found]
                return [pa.array(rows, pa.list_(struct))]

            return run

        again = [] if part == n_parts - 1 else ["__again"]  # the text comes back only for a further pass
        out = map_column(out.withColumn("__again", F.col("__text")), "__text", [*names, "__matches", *again], [StructField("__found", match_type)], make)
        text_again = [F.col("__again").alias("__text")] if again else []
        out = out.select(*names, *text_again, F.concat("__matches", "__found").alias("__matches"))
    return out.select(*[F.col(n).alias(c) for c, n in zip(kept, names)], F.col("__matches").alias("matches"))
