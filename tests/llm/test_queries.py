"""Registered queries against SQL or brute force: on given tables, awkward rows and empty tables."""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
import zlib
from tokenizers import Tokenizer

import corpus_pipeline
from shelfcast.llm import decontamination, langid, secrets
from shelfcast.llm.queries import ORACLES, QUERIES

TABLES = "/root/testdata/sf0.001"
SPACE = r"[^\x20\x09-\x0D]+"


@pytest.fixture(params=["given", "awkward"])
def tables(request, awkward) -> str:
    if request.param == "given" and not os.path.isdir(TABLES):
        pytest.skip("no test tables")
    return TABLES if request.param == "given" else awkward


def _counter(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, tables, name):
    df = QUERIES[name](spark, tables)
    result = duck(tables).execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert _counter(df.columns, df.collect()) == _counter(names, result.fetchall())


@pytest.mark.parametrize("name", sorted([*QUERIES, "pipeline"]))
def test_empty_tables_give_no_rows(spark, empty, name):
    rows = {**QUERIES, "pipeline": corpus_pipeline.run}[name](spark, empty).collect()
    assert [r for r in rows if name != "op10_chat_formatting" or r.conv_id != -1] == []


def _texts(duck, tables) -> list[tuple]:
    return duck(tables).execute("SELECT doc_id, text, lang FROM documents").fetchall()


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_bpe_equals_the_library(spark, duck, tables):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for doc_id, text, _ in _texts(duck, tables):
        ids = model.encode(text or "", add_special_tokens=False).ids
        decoded = model.decode(ids, skip_special_tokens=False)
        expected[doc_id, len(ids), _sha(np.array(ids, dtype="<u4").tobytes()), _sha(decoded.encode())] += 1
    assert Counter(map(tuple, QUERIES["op2_bpe"](spark, tables).collect())) == expected


def test_token_counts_equal_the_library(spark, duck, tables):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for doc_id, text, _ in _texts(duck, tables):
        n = len(model.encode(text or "", add_special_tokens=False).ids)
        expected[doc_id, len((text or "").encode()), n, n > 512] += 1
    assert Counter(map(tuple, QUERIES["op4_token_counts"](spark, tables).collect())) == expected


def fingerprint(text: str | None) -> int:
    words = re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int]) -> list[int]:
    """Index of the group of every print."""
    group = list(range(len(prints)))

    def find(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                group[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash_equals_brute_force(spark, duck, tables):
    docs = _texts(duck, tables)
    prints = [fingerprint(t) for _, t, _ in docs]
    groups = components(prints)
    least = defaultdict(list)
    for (doc_id, _, _), g in zip(docs, groups):
        if doc_id is not None:
            least[g].append(doc_id)
    expected = Counter((d, f"{p:016x}", min(least[g], default=None)) for (d, _, _), p, g in zip(docs, prints, groups))
    assert Counter(map(tuple, QUERIES["op3_simhash"](spark, tables).collect())) == expected


def contaminated(text: str | None, items: list[tuple]) -> set:
    """Items all of whose words stand in the text in one piece."""
    own = [w.decode() for w in decontamination._words_of(text or "")]
    found = set()
    for item, item_text in items:
        wanted = [w.decode() for w in decontamination._words_of(item_text or "")]
        if wanted and any(own[i : i + len(wanted)] == wanted for i in range(len(own) - len(wanted) + 1)):
            found.add(item)
    return found


def test_decontamination_finds_every_whole_item(spark, duck, tables):
    items = duck(tables).execute("SELECT item_id, text FROM benchmark").fetchall()
    expected = {(d, i) for d, t, _ in _texts(duck, tables) for i in contaminated(t, items)}
    rows = QUERIES["op8_decontamination"](spark, tables).collect()
    assert expected and expected <= {(r.doc_id, r.item_id) for r in rows}
    assert all(r.score >= decontamination.THRESHOLD and min(r.question_overlap, r.answer_overlap) >= 0.8 for r in rows)


def scored(docs: list[tuple], items: list[tuple]) -> dict[tuple, float]:
    """(document, item) -> best score of all passages that pass, by BM25 of every passage against every item.

    Items of a length class (up to 64 words, then by powers of two) share the stride, the longest of them;
    passages are two strides long and begin at every stride.
    """
    split = lambda t: [w.decode() for w in decontamination._words_of(t or "")]
    wanted = [(i, split(t)) for i, t in items]
    wanted = [(i, w) for i, w in wanted if w]
    if not wanted:
        return {}
    frequency = Counter(w for _, words in wanted for w in set(words))
    mean = sum(len(w) for _, w in wanted) / len(wanted)
    idf = {w: math.log(1 + (len(wanted) - n + 0.5) / (n + 0.5)) for w, n in frequency.items()}
    length_class = lambda words: max(6, (len(words) - 1).bit_length())
    stride = {}
    for _, words in wanted:
        stride[length_class(words)] = max(stride.get(length_class(words), 0), len(words))
    found: dict[tuple, float] = {}
    texts = [(d, split(t)) for d, t, _ in docs]
    for item, words in wanted:
        counts, step = Counter(words), stride[length_class(words)]
        k1, b = decontamination.K1, decontamination.B
        weight = {w: idf[w] * n * (k1 + 1) / (n + k1 * (1 - b + b * len(words) / mean)) for w, n in counts.items()}
        total, half = sum(weight.values()), (len(words) + 1) // 2
        size = min(decontamination.SHINGLE, len(words))
        grams = lambda own: {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}  # noqa: E731, B023
        question, answer, order = set(words[:half]), set(words[half:]) or set(words), grams(words)
        for doc, own in texts:
            for at in range(0, len(own), step):
                passage = own[at : at + 2 * step]
                have = set(passage)
                score = sum(v for w, v in weight.items() if w in have) / total
                if score < decontamination.THRESHOLD - 1e-9:
                    continue
                overlaps = [len(part & have) / len(part) for part in (question, answer)]
                if min(overlaps) >= decontamination.MIN_OVERLAP and len(grams(passage) & order) / len(order) >= decontamination.MIN_SHINGLES:
                    found[doc, item] = max(found.get((doc, item), 0.0), score)
    return found


def test_decontamination_equals_all_scores(spark, duck, tables):
    items = duck(tables).execute("SELECT item_id, text FROM benchmark").fetchall()
    expected = scored(_texts(duck, tables), items)
    rows = QUERIES["op8_decontamination"](spark, tables).collect()
    got: dict[tuple, float] = {}
    for r in rows:
        got[r.doc_id, r.item_id] = max(got.get((r.doc_id, r.item_id), 0.0), r.score)
    assert expected and got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(v, abs=1e-6) for k, v in expected.items())


def test_language_identification(spark, duck, tables):
    rows = QUERIES["op9_language_id"](spark, tables).collect()
    docs = _texts(duck, tables)
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _, _ in docs)
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 3 == 1 for d, _, _ in docs}
    assert all(r.held_out == held[r.doc_id] and 0 <= r.score <= 1 for r in rows)
    if tables == TABLES:
        label = {d: x for d, _, x in docs}
        right = [r.lang_pred == label[r.doc_id] for r in rows if r.held_out]
        assert sum(right) / len(right) > 0.97
    else:
        assert {r.doc_id for r in rows if r.lang_pred == langid.UNDETERMINED} == {0, 1, 2, 14, None}


def test_chat_reads_back(spark, duck, tables):
    rows = duck(tables).execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    rows += [(-1, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))]
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn, role or "", text or ""))
    got = {r.conv_id: r for r in QUERIES["op10_chat_formatting"](spark, tables).collect()}
    assert got.keys() == by.keys()
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0))
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), _sha(said.encode()))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), _sha(loss.encode()))


PATTERNS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"(AKIA[A-Z0-9]{16,})", "hex": r"([0-9a-f]{24,})", "owned": r"([A-Za-z0-9+/_-]{20,})",
}


def redacted(docs: list[tuple]) -> list[str]:
    """Texts with the strings masked that one owner alone holds."""
    owners, found = defaultdict(set), []
    for _, text, source in docs:
        own = []
        for kind, pattern in PATTERNS.items():
            for m in re.finditer(pattern, text or ""):
                value = m[1]
                mixed = re.search("[0-9]", value) and re.search("[A-Za-z]", value)
                if (kind != "assign" or len(value) >= 6) and (kind != "owned" or mixed):
                    own.append((*m.span(), kind, value))
                    owners[value].add(source or "")
        found.append(own)
    out = []
    for (_, text, _), own in zip(docs, found):
        base = [s for s in own if s[2] != "owned"]
        live = [s for s in base if len(owners[s[3]]) == 1]
        live += [s for s in own if s[2] == "owned" and len(owners[s[3]]) == 1 and not any(b[0] < s[1] and s[0] < b[1] for b in base)]
        masked, at = "", 0
        for start, end, *_ in sorted(live, key=lambda s: (s[0], list(PATTERNS).index(s[2]))):
            if start >= at:
                masked += (text or "")[at:start] + "[SECRET]"
            at = max(at, end)
        out.append(masked + (text or "")[at:])
    return out


def test_pipeline_equals_its_stages_by_brute_force(spark, duck, tables):
    con = duck(tables)
    docs = con.execute("SELECT doc_id, text, source FROM documents").fetchall()
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    accepted = langid.train(spark.read.parquet(f"{tables}/documents.parquet"))
    kept = []
    for doc_id, text, source in docs:
        if text is not None and re.search(r"[^\W\d_]", text):
            ((_, score),) = langid.whole_texts(accepted, accepted.tables(), [text.encode()])
            if score >= corpus_pipeline.MIN_SCORE:
                kept.append((doc_id, text, source))
    groups = components([fingerprint(t) for _, t, _ in kept])
    first = {}
    for i, g in enumerate(groups):
        order = (kept[i][0] is None, kept[i][0] or 0, i)
        first[g] = min(first.get(g, order), order)
    kept = [kept[i] for i in sorted(o[2] for o in first.values())]
    kept = [d for d in kept if not contaminated(d[1], items)]
    rows = corpus_pipeline.run(spark, tables).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _, _ in kept)
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for (doc_id, _, _), text in zip(kept, redacted(kept)):
        ids = model.encode(text, add_special_tokens=False).ids
        expected[doc_id, len(ids), np.array(ids, dtype="<u4").tobytes()] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in rows) == expected


def test_redaction_masks_live_secrets_only(spark):
    rows = [(1, "a token=abcdef123 b", "s1", "x"), (2, "é token=shared99 c", "s1", "x"), (3, "d token=shared99", "s2", "x")]
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), carry=["doc_id", "text"])
    out = found.select("doc_id", secrets.redact(found["text"], found["found"]).alias("t")).where("doc_id < 3")
    assert {r.doc_id: r.t for r in out.collect()} == {1: "a [SECRET] b", 2: "é [SECRET] c"}
    assert {r.doc_id: [s["live"] for s in r.found] for r in found.collect()} == {1: [True], 2: [False], 3: [False]}
