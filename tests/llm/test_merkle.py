"""Merkle manifests against a plain rebuilding of the trees."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sparkelt.llm import merkle
from sparkelt.llm.queries import tampered_manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Top digest and, per node, the steps of its proof."""
    paths = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        upper, held = [], []
        for s in range(0, len(nodes), 3):
            run = nodes[s : s + 3]
            for k in range(len(run)):
                for i in members[s + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            upper.append(sha("".join(run)))
            held.append([i for m in members[s : s + 3] for i in m])
        nodes, members = upper, held
    return nodes[0], paths


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, inner = [], []
    for name in names:
        group = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        top, paths = tree([leaf_of(r) for r in group])
        tops.append(top)
        inner.append((group, paths))
    root, upper = tree(tops)
    out = []
    for (group, paths), above, top in zip(inner, upper, tops):
        for row, path in zip(group, paths):
            steps = path + above
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            at = leaf_of((*row[:4], text))
            for left, right in steps:
                at = sha(left + at + right)
            proof = sha("".join(left + right for left, right in steps))
            out.append((row[0], leaf_of(row), top, root, proof, at, at == root))
    return out


def check(spark, rows, levels):
    schema = "doc_id long, source string, lang string, n_chars long, text string, at string, g string, node string, path int"
    docs = spark.createDataFrame([(*r, "x", None, "y", 1) for r in rows], schema).repartition(5)
    found = tampered_manifest(docs, levels).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected(rows), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_trees_of_many_sizes(spark, levels):
    rng = random.Random(levels)
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "é": 28, "漢": 82, None: 10, "": 9, "Z": 27}
    rows = [(rng.randrange(10**9), s, "en", i, f"t{i}\nx" if i % 3 else None) for s, n in sizes.items() for i in range(n)]
    check(spark, rows, levels)


def test_odd_rows(spark):
    same = (5, "s", None, None, "twice\n")
    check(spark, [same, same, (5, "s", "en", 1, "other"), (None, "s", "en", 0, ""), (7, None, "en", 0, None), (-1, "s", "", 3, "x\n" * 50_000)], 2)


def test_one_row(spark):
    check(spark, [(3, "s", "en", 1, "a\nb")], 6)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert tampered_manifest(docs).collect() == []


def test_proofs_lead_to_the_root(spark, sf_dir):
    found = merkle.manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert found.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert found.select("root").distinct().count() == 1
