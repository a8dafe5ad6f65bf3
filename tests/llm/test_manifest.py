"""The manifest against plain hashing, and on odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strata.llm import manifest

ROWS = "doc_id long, text string, lang string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes):
    """Root, and the siblings of each node at each level as (left, right)."""
    ways, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for w, p in zip(ways, place, strict=True):
            start = p - p % 8
            w.append(("".join(nodes[start:p]), "".join(nodes[p + 1 : start + 8])))
        place = [p // 8 for p in place]
        nodes = [digest(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], ways


def plain_proofs(rows):
    groups = {}
    for doc_id, text, lang in rows:
        groups.setdefault("-" if lang is None else f"={lang}", []).append((doc_id is not None, doc_id or 0, plain_leaf(doc_id, text, lang), doc_id))
    names = sorted(groups, key=lambda g: g.encode())
    trees = {g: plain_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, above = plain_tree([trees[g][0] for g in names])
    out = []
    for g, way in zip(names, above, strict=True):
        for x, own in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1], strict=True):
            out.append((x[3], x[2], trees[g][0], root, tuple(own + way)))
    return sorted(out, key=repr)


def built(spark, rows, **more):
    df = spark.createDataFrame(rows, ROWS).repartition(4).withColumns({c: F.lit(1) for c in ("group", "position", "size", "digest", "tie")})
    return manifest.build(df, F.col("lang"), F.col("doc_id"), manifest.leaf(*map(F.col, ("doc_id", "text", "lang"))), {"doc_id": F.col("doc_id")}, **more)


@pytest.mark.parametrize("sizes", [[1], [1, 1, 1], [8, 9, 64, 65, 1], [513, 1], [1200, 600, 3], [2] * 70])
def test_proofs(spark, sizes):
    rng = random.Random(1)
    names = [None, "", "é", "en", "日本"] + [f"l{i}" for i in range(80)]
    rows = [(i * 1000 + j, f"text {j}", names[i]) for i, n in enumerate(sizes) for j in range(n)]
    rng.shuffle(rows)
    tree = built(spark, rows)
    found = manifest.proofs(tree)
    got = [(r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.proof)) for r in found.collect()]
    assert sorted(got, key=repr) == plain_proofs(rows)
    assert found.filter(manifest.fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert found.filter(manifest.fold(F.lit(digest("x")), F.col("proof")) == F.col("root")).count() == 0
    assert manifest.root(tree) == got[0][3]


def test_odd_rows(spark):
    """Null ids come first, null and empty differ, repeated rows each have a proof."""
    rows = [(None, "a", "x"), (None, None, "x"), (1, "", "x"), (1, None, "x"), (1, None, "x"), (2, "é" * 100_000, None)]
    found = manifest.proofs(built(spark, rows)).collect()
    got = [(r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.proof)) for r in found]
    assert sorted(got, key=repr) == plain_proofs(rows)
    empty = built(spark, [])
    assert manifest.proofs(empty).count() == 0 and manifest.root(empty) is None


def test_written(spark, tmp_path):
    """Only every third level is stored; a manifest is read again from its folder."""
    rows = [(i, "t", "en") for i in range(600)]
    built(spark, rows, folder=f"{tmp_path}/m")
    assert {p.name for p in (tmp_path / "m").iterdir()} >= {"rows-0", "rows-3", "rows-6", "groups-0"}
    tree = manifest.read(spark, f"{tmp_path}/m")
    assert tree.rounds == 2 and manifest.proofs(tree).count() == 600
    some = manifest.proofs(tree, F.col("doc_id").isin(5, 599)).collect()
    assert {r.doc_id for r in some} == {5, 599}
    assert all(r.root == manifest.root(tree) for r in some)
