"""Quality field: features by plain Python, marginals by all labellings, gradients, sample and held-out rows."""

from __future__ import annotations

import itertools
import math
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import crf
from shelfcast.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.01"
TEXTS = [
    "", "\n", "One two TWO three.\n\nfour!! | | #$ 5\nOne two two THREE.\n", "a", "ä ö ü ß 日本", "x\r\ny z\t\v\fz", "aa aa aa bb aa\naa aa\nb",
    "word " * 300, " \n \n", "end?\nEND?\nend", "line.\n" * 40,
]


def plain_features(text: str) -> list[list[float]]:
    seen, out = set(), []
    for line in text.split("\n"):
        raw = line.encode()
        words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", raw)]
        solid = sum(map(len, words))
        per, n = max(solid, 1), max(len(words), 1)
        upper = sum(65 <= b <= 90 for b in raw)
        letters = upper + sum(97 <= b <= 122 or b >= 128 for b in raw)
        marks, signs = sum(b in b".,;:?'\"-()" for b in raw), sum(33 <= b < 127 and not chr(b).isalnum() for b in raw)
        share = lambda c: math.sqrt(c / per)
        key = tuple(words)
        cries, bars = raw.count(b"!"), raw.count(b"|")
        out.append([
            math.log1p(len(words)), math.sqrt(upper / max(letters, 1)), share(sum(48 <= b <= 57 for b in raw)), share(marks), share(cries),
            share(bars), share(signs - marks - cries - bars), min(solid / n, 20) / 10, sum(a == b for a, b in zip(words, words[1:])) / n,
            len(set(words)) / n, float(bool(words) and key in seen), float(raw[-1:] in (b".", b"!", b"?")),
        ])
        seen.add(key)
    return out


@pytest.mark.parametrize("size", [1, 1 << 22])
def test_features_equal_plain_ones(monkeypatch, size):
    """Looked at line by line and all together."""
    monkeypatch.setattr(crf, "_SLICE", size)
    found, sizes, per_text = crf.line_features(TEXTS)
    expected = [plain_features(t) for t in TEXTS]
    assert per_text.tolist() == [len(e) for e in expected]
    assert sizes.tolist() == [len(x.encode()) + 1 for t in TEXTS for x in t.split("\n")]
    np.testing.assert_allclose(found, np.concatenate(expected), atol=1e-12)


def test_neighbours_stay_within_their_text():
    features = np.arange(1, 7, dtype=float)[:, None]
    got = crf.with_neighbours(features, np.array([1, 3, 2]))
    assert got.tolist() == [
        [1, 0, 0, 1, 1, 1], [2, 0, 3, 1, 0, 1], [3, 2, 4, 0, 0, 1], [4, 3, 0, 0, 1, 1], [5, 0, 6, 1, 0, 1], [6, 5, 0, 0, 1, 1],
    ]


def test_marginals_equal_all_labellings():
    random = np.random.default_rng(1)
    per_text = np.array([3, 1, 6, 2])
    emission, transition = random.normal(0, 2, per_text.sum()), random.normal(0, 1, (2, 2))
    forward, backward, total = crf.forward_backward(emission, transition, per_text)
    got = np.exp(forward[:, 1] + backward[:, 1] - total)
    at = 0
    for n in per_text:
        mass = np.zeros(n)
        whole = 0.0
        for labels in itertools.product((0, 1), repeat=int(n)):
            score = sum(emission[at + i] for i in range(n) if labels[i]) + sum(transition[a, b] for a, b in zip(labels, labels[1:]))
            whole += math.exp(score)
            mass += math.exp(score) * np.array(labels)
        np.testing.assert_allclose(got[at : at + n], mass / whole, atol=1e-12)
        at += n


def test_scores_do_not_depend_on_the_batch():
    random = np.random.default_rng(2)
    width = 3 * len(crf.FEATURES) + 3
    field = crf.Field(np.zeros(width), np.ones(width), random.normal(0, 0.5, width), random.normal(0, 1, (2, 2)))
    together, alone = field.scores(TEXTS), np.concatenate([field.scores([t]) for t in TEXTS])
    np.testing.assert_allclose(together, alone, atol=1e-12)
    assert ((together >= 0) & (together <= 1)).all() and len(field.scores([])) == 0


def test_very_long_chains_stay_finite():
    width = 3 * len(crf.FEATURES) + 3
    field = crf.Field(np.zeros(width), np.ones(width), np.full(width, 0.3), np.array([[2.0, -2.0], [-2.0, 2.0]]))
    assert np.isfinite(field.scores(["x y z.\n" * 20_000])).all()


def test_a_label_made_of_copies_is_learnt(spark):
    docs = [(i, "JUNK!! ### $$$") for i in range(2000)] + [(5000 + i, f"A quiet sentence number {i}, nothing more.") for i in range(400)]
    labels = [(i, 0) for i in range(2000)] + [(5000 + i, 1) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    field = crf.train(df, spark.createDataFrame(labels, "doc_id long, quality int"), sample_docs=50)
    bad, good = field.scores(["JUNK!! ### $$$", "A quiet sentence, nothing more."])
    assert bad < 0.3 and good > 0.7


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert crf.train(df, labels) is None
    rows = crf.score_quality(df.withColumn("score", F.lit("clash")), None, carry=["doc_id", "score"]).collect()
    assert sorted((r.doc_id, r.score, r.predicted) for r in rows) == [(1, 0.5, 0), (2, 0.5, 0)]


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_held_out_quality(spark):
    rows = QUERIES["op12_quality_classifier"](spark, TABLES).collect()
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{TABLES}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert sum(p == q for p, q in held) / len(held) > 0.95
    assert sum(p == 1 for p, q in held if q == 1) / sum(q for _, q in held) > 0.97


def test_every_document_has_one_score(spark, awkward):
    rows = QUERIES["op12_quality_classifier"](spark, awkward).collect()
    assert len(rows) == spark.read.parquet(f"{awkward}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)
