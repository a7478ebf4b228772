"""Token counts of whole texts: only lengths come back from the workers."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField

from shelfcast.llm.arrow import map_column
from shelfcast.llm.text import n_bytes

#: Bytes of text in one call of the tokenizer.
CALL_BYTES = 256 << 10

#: Characters of a text looked at together; a longer one is split at safe boundaries.
PIECE_CHARS = 1 << 20

#: Chunks whose length a worker remembers, as many again before they are forgotten.
MEMORY = 300_000

#: Characters of the chunks that a worker remembers: text without spaces has long ones.
MEMORY_CHARS = 8 << 20

# The characters with the Unicode property White_Space. A place between another character
# and one of these is a safe boundary: a word takes spaces before it, never after it.
WHITE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_BOUNDARY = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut at safe boundaries only."""
    at = 0
    while len(text) - at > size:
        cut = _BOUNDARY.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Counter:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            # Sentence pieces see spaces across words: only whole texts are safe there.
            self.pieces = lambda text: iter([text])
            self.chunks = lambda text: [text] if text else []
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.pieces = pieces
            self.chunks = _CHUNK.findall
            self.lengths = lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.known_chars = 0

    def _learn(self, new: set[str]) -> None:
        call, size = [], 0
        for chunk in [*new, None]:
            if call and (chunk is None or size + len(chunk) > CALL_BYTES):
                self.known.update(zip(call, self.lengths(call)))
                call, size = [], 0
            if chunk is not None:
                call.append(chunk)
                size += len(chunk)

    def _count(self, texts: list[list[str]]) -> Iterator[int]:
        wanted = set().union(*texts).difference(self.known)
        chars = sum(map(len, wanted))
        if len(self.known) + len(wanted) > MEMORY or self.known_chars + chars > MEMORY_CHARS:
            # What was met lately stays: older chunks go when the next ones become old.
            self.older, self.known, self.known_chars = self.known, {}, 0
            wanted = set().union(*texts)
            chars = sum(map(len, wanted))
        self.known_chars += chars
        self.known.update((c, n) for c in wanted if (n := self.older.get(c)) is not None)
        self._learn(wanted.difference(self.known))
        for chunks in texts:
            yield sum(map(self.known.__getitem__, chunks))

    def count(self, texts: Sequence[str | None]) -> list[int]:
        """Tokens of each text, in batches of about PIECE_CHARS characters."""
        totals, batch, owners, size = [0] * len(texts), [], [], 0

        def flush() -> None:
            for owner, n in zip(owners, self._count(batch)):
                totals[owner] += n
            batch.clear()
            owners.clear()

        for i, text in enumerate(texts):
            for piece in self.pieces(text or ""):
                batch.append(self.chunks(piece))
                owners.append(i)
                size += len(piece)
                if size >= PIECE_CHARS:
                    flush()
                    size = 0
        flush()
        return totals


@functools.lru_cache(maxsize=1)
def _counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(df: DataFrame, tokenizer: str, text: str = "text", carry: Sequence[str] = ("doc_id",), limit: int = 512) -> DataFrame:
    """``carry``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) per row.

    A worker cuts its texts into chunks at safe boundaries, encodes the distinct chunks it has not met
    in calls of equal bytes and adds up their lengths. Rows stay where they are. Special strings inside
    texts count as the library handles them by default. Null counts as the empty text: no bytes, no
    tokens; repeated rows are counted each, an empty table gives no rows. Input columns with the names of
    results are not carried.
    """
    names = ("n_bytes", "n_tokens", "over_limit")
    sized = df.withColumn("n_bytes", n_bytes(F.col(f"`{text}`")))

    def make():
        counter = _counter(tokenizer)

        def run(texts: pa.Array) -> list[pa.Array]:
            return [pa.array(counter.count([x.as_py() for x in texts]), pa.int64())]

        return run

    kept = [c for c in carry if c not in names]
    source = sized.select(*[F.col(f"`{c}`") for c in kept], "n_bytes", F.col(f"`{text}`").alias("__text"))
    counted = map_column(source, "__text", [*kept, "n_bytes"], [StructField("n_tokens", LongType())], make)
    return counted.select(*[F.col(f"`{c}`") for c in kept], "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
