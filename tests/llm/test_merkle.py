"""Merkle manifest against a plain tree, for several run lengths and levels a pass."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import merkle
from shelfcast.llm.ranks import COUNT, INDEX, ranked


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves: list[str], arity: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """(root, siblings before and after every leaf's nodes, level by level)."""
    paths: list[list[tuple[str, str]]] = [[] for _ in leaves]
    nodes, owners = leaves, [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        following, held = [], []
        for at in range(0, len(nodes), arity):
            run = nodes[at : at + arity]
            for j, own in enumerate(owners[at : at + arity]):
                for leaf in own:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            following.append(sha("".join(run)))
            held.append([leaf for own in owners[at : at + arity] for leaf in own])
        nodes, owners = following, held
    return nodes[0], paths


@pytest.mark.parametrize(("arity", "levels"), [(2, 1), (2, 2), (2, 10), (3, 2), (5, 3)])
def test_manifest_equals_a_plain_tree(spark, arity, levels):
    rng = random.Random(arity * 10 + levels)
    rows = [(g, rng.randint(0, 9) if rng.random() < 0.9 else None, sha(str(rng.random()))) for g, n in
            [(None, 5), ("", 1), ("a", 33), ("ä", 2), ("b", 16), ("z", 3)] for _ in range(n)]
    df = spark.createDataFrame(rows, "lang string, doc long, leaf string").withColumn("path", F.lit("clash")).repartition(6)
    got = merkle.manifest(df, "lang", ["doc"], carry=["lang", "doc", "path"], arity=arity, levels=levels)
    folded = got.withColumns({"folded": merkle.fold(F.col("leaf"), F.col("path")), "proof": merkle.proof(F.col("path"))}).collect()
    groups = {}
    for lang, doc, leaf in rows:
        groups.setdefault(lang, []).append((doc is not None, doc or 0, leaf))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: plain_tree([leaf for *_, leaf in sorted(groups[g])], arity) for g in names}
    root, over = plain_tree([trees[g][0] for g in names], arity)
    expected = {}
    for g, above in zip(names, over):
        for i, (*_, leaf) in enumerate(sorted(groups[g])):
            path = trees[g][1][i] + above
            expected[g, leaf] = (i, trees[g][0], root, root, sha("".join(a + b for a, b in path)))
    assert {(r.lang, r.leaf): (r["index"], r.subroot, r.root, r.folded, r.proof) for r in folded} == expected
    assert len(folded) == len(rows)


def test_a_changed_leaf_gives_another_root(spark):
    df = spark.range(9).select(F.lit("x").alias("lang"), "id", merkle.leaf_hash(F.col("id")).alias("leaf"))
    tree = merkle.manifest(df, "lang", ["id"], carry=["id"])
    checks = tree.select(
        merkle.verified(F.col("path"), F.col("leaf"), F.col("root")).alias("own"),
        merkle.verified(F.col("path"), merkle.leaf_hash(F.col("id") + 1), F.col("root")).alias("other"),
    )
    assert {tuple(r) for r in checks.collect()} == {(True, False)}


def test_leaf_hash_tells_null_from_empty_and_fields_apart(spark):
    rows = [(None, "a"), ("", "a"), ("a", None), ("a", ""), ("1:a", ""), ("-", "é")]
    df = spark.createDataFrame(rows, "x string, y string")
    fields = lambda v: "-" if v is None else f"{len(v.encode())}:{v}"
    got = [r.h for r in df.select(merkle.leaf_hash(F.col("x"), F.col("y")).alias("h")).collect()]
    assert got == [sha(fields(x) + fields(y)) for x, y in rows] and len(set(got)) == len(rows)


def test_repeated_rows_are_leaves_of_their_own(spark):
    df = spark.createDataFrame([("x", 1, "h1")] * 7, "lang string, id long, leaf string")
    got = merkle.manifest(df, "lang", ["id"]).collect()
    assert sorted(r["index"] for r in got) == list(range(7)) and {r.subroot for r in got} == {plain_tree(["h1"] * 7, 2)[0]}


def test_places_in_a_group_over_many_tasks(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), (-F.col("id")).alias("o"))
    got = ranked(df.repartition(8), ["g"], ["o"]).where("g = 'hot'").collect()
    assert sorted((r[INDEX], r.o) for r in got) == list(enumerate(sorted(-i for i in range(0, 1000, 3))))
    assert {r[COUNT] for r in got} == {334}
