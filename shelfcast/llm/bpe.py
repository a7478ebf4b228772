"""BPE encoding by forced boundaries, and decoding.

Merging never crosses two neighbouring bytes that no vocabulary token holds side by side. Such places are
certain cuts: the fragments between them are encoded on their own and put together again, so a fragment
that was met before need not be encoded again, and no text is too long.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField
from tokenizers import Tokenizer

from shelfcast.llm.arrow import map_column, text_batches

#: Fragments that a worker remembers, as many again before they are forgotten.
MEMORY = 150_000

#: Characters of the fragments, or of the pieces, that a worker remembers: text without spaces has long ones.
MEMORY_CHARS = 8 << 20

#: Bytes of text whose fragments are looked up together; a longer text is looked up by itself.
PART_BYTES = 1 << 20

# Fragments for which normaliser and word splitter are asked themselves.
_BEYOND_LATIN = re.compile("[^\\x00-\\x1b\\x20-\\x84\\x86-\\x9f\\xa1-\\u024f]")
_NEVER = re.compile(r"(?!)")

#: Marks a piece after which its word goes on; no letter of a byte.
_GOES_ON = " "

_SPACES = b"\t\n\x0b\x0c\r "


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: visible Latin-1 characters stand
    for themselves, the others in order for the code points from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class ForcedBoundaryEncoder:
    """Encodes as the tokenizer file's library does, special tokens added by a post-processor left out."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        if parts["model"]["type"] != "BPE" or parts["model"].get("ignore_merges"):
            raise ValueError("forced boundaries need a BPE model that always merges")
        self.library = Tokenizer.from_str(json.dumps({**parts, "truncation": None, "padding": None}))
        self.special = re.compile("|".join(re.escape(t["content"]) for t in parts["added_tokens"]) or "(?!)")
        bare = {**parts, "truncation": None, "padding": None, "normalizer": None, "pre_tokenizer": None}
        bare |= {"post_processor": None, "added_tokens": []}
        suffix = parts["model"].get("end_of_word_suffix") or ""
        inner = {**bare, "model": {**parts["model"], "end_of_word_suffix": None}}
        # A fragment that does not end its word must not get the end-of-word suffix.
        self.final, self.inner = Tokenizer.from_str(json.dumps(bare)), Tokenizer.from_str(json.dumps(inner))

        letters = byte_letters()
        self.byte_of = np.zeros(512, dtype=np.uint8)
        self.letter_of = np.array([ord(letter) for letter in letters], dtype="<u2")
        self.byte_of[self.letter_of] = np.arange(256)
        self.inside = self._pairs_inside(parts["model"]["vocab"], suffix)
        space = np.frombuffer(_SPACES, dtype=np.uint8)
        other = np.setdiff1d(np.arange(256), space)
        spaces, others = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
        if self.inside[np.ix_(other, space)].any():
            self.fragments = None  # words and the spaces after them share tokens: no cut is certain here
        elif self.inside[np.ix_(space, other)].any() or self.library.encode(" ", add_special_tokens=False).ids:
            self.fragments = re.compile(f"{spaces}*{others}+|{spaces}+")
        else:
            self.fragments = re.compile(f"{others}+")  # spaces have no tokens at all
        self.quick = self._quick_words(parts) if self.fragments and self.fragments.pattern == f"{others}+" else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.known_chars = self.pieces_chars = 0

    def _pairs_inside(self, vocab: dict[str, int], suffix: str) -> np.ndarray:
        """inside[a, b]: whether some token holds byte a directly before byte b."""
        inside = np.zeros((256, 256), dtype=bool)
        for token in vocab:
            body = token.removesuffix(suffix) if suffix else token
            if len(body) > 1 and all(ord(c) < 512 for c in body):
                codes = self.byte_of[[ord(c) for c in body]]
                inside[codes[:-1], codes[1:]] = True
        return inside

    @staticmethod
    def _quick_words(parts: dict) -> regex.Pattern | None:
        """The word pattern, if the normaliser composes, joins spaces and lower-cases and no more."""
        normal = [(n["type"], n.get("content")) for n in (parts["normalizer"] or {}).get("normalizers", [])]
        split = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        known = [("NFC", None), ("Replace", " "), ("Lowercase", None)]
        if normal != known or [s["type"] for s in split] != ["Split", "ByteLevel"]:
            return None
        words, letters = split
        if (words["behavior"], words["invert"], letters["add_prefix_space"], letters["use_regex"]) != ("Removed", True, False, False):
            return None
        return regex.compile(words["pattern"]["Regex"])

    def _encode_pieces(self, wanted: set[str]) -> None:
        new = list(wanted.difference(self.pieces))
        self.pieces_chars += sum(map(len, new))
        for model, own in ((self.final, [p for p in new if p[-1] != _GOES_ON]), (self.inner, [p for p in new if p[-1] == _GOES_ON])):
            if own:
                found = model.encode([p.rstrip(_GOES_ON) for p in own], is_pretokenized=True, add_special_tokens=False)
                ids = np.array(found.ids, dtype="<u4").tobytes()
                ends = 4 * np.searchsorted(np.array(found.word_ids), np.arange(len(own)), side="right")
                at = 0
                for piece, end in zip(own, ends.tolist()):
                    self.pieces[piece] = ids[at:end]
                    at = end

    def _learn(self, new: list[str]) -> None:
        """Encode fragments of text not met before: normalise, cut into words, cut at forced pairs."""
        plain = []
        odd = _BEYOND_LATIN if self.quick is not None else _NEVER
        for text in new:
            if self.special.search(text) or odd.search(text):
                ids = self.library.encode(text, add_special_tokens=False).ids
                self.known[text] = np.array(ids, dtype="<u4").tobytes()
            else:
                plain.append(text)
        if not plain:
            return
        if self.quick is not None:
            # No fragment holds a space and no word goes over one, so all are cut into words at once. Up
            # to U+024F nothing composes and letters and numbers are the same in every Unicode version.
            lowered = " ".join(plain).lower()
            lengths = np.fromiter(map(len, lowered.split(" ")), dtype=np.int64, count=len(plain))
            found = [(m.start(), m.group()) for m in self.quick.finditer(lowered)]
            first = np.searchsorted(np.fromiter((at for at, _ in found), np.int64, len(found)), np.cumsum(lengths + 1) - lengths - 1)
            upto_word = [*first.tolist(), len(found)]
            raw = "".join([w for _, w in found]).encode()
            characters = np.cumsum(np.fromiter((len(w) for _, w in found), np.int64, len(found)))
            codes = np.frombuffer(raw, dtype=np.uint8)
            starts_of = np.r_[np.flatnonzero((codes & 0xC0) != 0x80), len(codes)]
            ends = starts_of[characters]
            together = self.letter_of[codes].tobytes().decode("utf-16-le")
        else:
            normal, split = self.library.normalizer, self.library.pre_tokenizer
            texts = [normal.normalize_str(t) if normal else t for t in plain]
            words_of = [[w for w, _ in split.pre_tokenize_str(t)] if split else [t] for t in texts]
            words = list(chain.from_iterable(words_of))
            upto_word = np.cumsum([0, *map(len, words_of)]).tolist()
            together = "".join(words)
            codes = self.byte_of[np.frombuffer(together.encode("utf-16-le"), dtype="<u2")]
            ends = np.cumsum(np.array([len(w) for w in words], dtype=np.int64))
        if len(codes):
            ends_word = np.zeros(len(codes), dtype=bool)
            ends_word[ends - 1] = True
            cut = ends_word.copy()
            cut[:-1] |= ~self.inside[codes[:-1], codes[1:]]
            stops = np.flatnonzero(cut) + 1
            starts = np.concatenate(([0], stops[:-1]))
            pieces = [together[a:b] for a, b in zip(starts.tolist(), stops.tolist())]
            for i in np.flatnonzero(~ends_word[stops - 1]).tolist():
                pieces[i] += _GOES_ON
            self._encode_pieces(set(pieces))
            encoded = list(map(self.pieces.__getitem__, pieces))
            upto = [0, *np.searchsorted(stops, ends, side="right").tolist()]
        for i, text in enumerate(plain):
            a, b = upto_word[i], upto_word[i + 1]
            self.known[text] = b"".join(encoded[upto[a] : upto[b]]) if a < b else b""

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers."""
        if self.fragments is None:
            return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(list(texts), add_special_tokens=False)]
        out = []
        for part in text_batches(texts, PART_BYTES):
            fragments = [self.fragments.findall(text) for text in part]
            wanted = set().union(*fragments).difference(self.known)
            chars = sum(map(len, wanted))
            if len(self.known) + len(wanted) > MEMORY or self.known_chars + chars > MEMORY_CHARS:
                # What was met lately stays: older fragments go when the next ones become old.
                self.older, self.known, self.known_chars = self.known, {}, 0
                wanted = set().union(*fragments)
                chars = sum(map(len, wanted))
            self.known_chars += chars
            if len(self.pieces) > MEMORY or self.pieces_chars > MEMORY_CHARS:
                self.pieces.clear()
                self.pieces_chars = 0
            new = []
            for fragment in wanted:
                if (ids := self.older.get(fragment)) is None:
                    new.append(fragment)
                else:
                    self.known[fragment] = ids
            if new:
                self._learn(new)
            out += [b"".join(map(self.known.__getitem__, own)) for own in fragments]
        return out


class Decoder:
    """Decodes ids as the tokenizer file's library does, special tokens included."""

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        size = library.get_vocab_size(with_added_tokens=True)
        self.token = [library.id_to_token(i) for i in range(size)]
        self.library = library if library.decoder else None

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        if self.library is None:
            return " ".join(map(self.token.__getitem__, numbers))
        return self.library.decode(numbers, skip_special_tokens=False)


# One per worker: workers outlive tasks, and what they have learnt stays.
@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> ForcedBoundaryEncoder:
    return ForcedBoundaryEncoder(path)


@functools.lru_cache(maxsize=1)
def _decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(df: DataFrame, tokenizer: str, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry`` and ``ids``: the tokens of every whole text as little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of the tokenizer's file, the same on every machine. Rows stay where they
    are. Null and empty texts have no tokens; a column named ``ids`` is not carried.
    """

    def make():
        encoder = _encoder(tokenizer)

        def run(texts: pa.Array) -> list[pa.Array]:
            return [pa.array(encoder.encode([x.as_py() or "" for x in texts]), pa.binary())]

        return run

    return map_column(df, text, carry, [StructField("ids", BinaryType())], make)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry`` and ``decoded``: the text that the ids stand for; null ids give the empty text."""

    def make():
        decoder = _decoder(tokenizer)

        def run(column: pa.Array) -> list[pa.Array]:
            return [pa.array([decoder.decode(x.as_py() or b"") for x in column], pa.string())]

        return run

    return map_column(df, ids, carry, [StructField("decoded", StringType())], make)


def n_tokens(ids: Column) -> Column:
    return F.floor(F.octet_length(ids) / 4).cast("long")


