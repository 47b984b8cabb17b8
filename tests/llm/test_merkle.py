from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cardtide.llm import merkle
from cardtide.llm.merkle import GROUP, ID, LEAF, PROOF, ROOT, SUBROOT, folded, leaf_hash, manifest, proof_hash
from tests.llm.helpers import messy_docs

FIELDS = ["doc_id", "source", "text"]


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values) -> str:
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(hashes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The last node, and each leaf's steps."""
    paths = [[] for _ in hashes]
    under = [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        runs = [range(i, min(i + 16, len(hashes))) for i in range(0, len(hashes), 16)]
        for run in runs:
            for j in run:
                step = "".join(hashes[k] for k in run if k < j), "".join(hashes[k] for k in run if k > j)
                for i in under[j]:
                    paths[i].append(step)
        under = [[i for j in run for i in under[j]] for run in runs]
        hashes = [digest(*[hashes[j] for j in run]) for run in runs]
    return hashes[0], paths


def slow(rows: list[tuple]) -> list[tuple]:
    """(id, source, leaf, subroot, root, steps), sorted, of (id, source, text)."""
    groups = defaultdict(list)
    for i, source, text in rows:
        groups[source].append((i, leaf(i, source, text)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = climb([h for _, h in groups[name]])
    root, above = climb([trees[name][0] for name in names])
    out = []
    for name, way in zip(names, above, strict=True):
        subroot, paths = trees[name]
        out += [(i, name, h, subroot, root, tuple(p + way)) for (i, h), p in zip(groups[name], paths, strict=True)]
    return out


def found_in(rows) -> list[tuple]:
    return [(r[ID], r[GROUP], r[LEAF], r[SUBROOT], r[ROOT], tuple((s[0], s[1]) for s in r[PROOF])) for r in rows.collect()]


def by_all(rows: list[tuple]) -> list[str]:
    return sorted(map(repr, rows))


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 7, "l") for r in rows], "doc_id long, source string, text string, place int, leaf string").repartition(3)


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [1, 1], [5, 1, 300], [257, 16, 1, 33], [1] * 17, [3] * 40 + [280]], ids=str)
def test_against_brute_force(spark, sizes):
    rng = random.Random(3)
    rows = []
    for g, n in enumerate(sizes):
        name = [None, "", "é", "a", "="][g] if g < 5 else f"s{g}"
        rows += [(rng.randrange(10**6), name, f"Text {i}") for i in range(n)]
    rng.shuffle(rows)
    assert by_all(found_in(manifest(docs_of(spark, rows), FIELDS))) == by_all(slow(rows))


def test_deep_tree_in_several_rounds(spark):
    """Four levels in one source and two above: three rounds of jumps."""
    rows = [(i * 7 % 5003, "big" if i % 8 else f"s{i % 200:03}", None if i % 5 else "x") for i in range(5003)]
    found = manifest(docs_of(spark, rows), FIELDS)
    assert by_all(found_in(found)) == by_all(slow(rows))
    whole = found.select(folded(F.col(LEAF), F.col(PROOF)).alias("h"), ROOT)
    assert whole.where(F.col("h") != F.col(ROOT)).count() == 0


def test_messy_rows(spark):
    docs = messy_docs(spark).withColumnRenamed("lang", "source")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    assert by_all(found_in(manifest(docs, FIELDS))) == by_all(slow(rows))
    assert manifest(messy_docs(spark, []).withColumnRenamed("lang", "source"), FIELDS).collect() == []


def test_changed_leaves_do_not_verify(spark):
    rows = [(i, "ab"[i % 2], "AB" if i % 3 else "ab") for i in range(100)]
    docs = docs_of(spark, rows)
    altered = F.when(F.col("doc_id") % 2 == 0, leaf_hash([F.col("doc_id"), F.col("source"), F.lower("text")]))
    found = manifest(docs, FIELDS, altered=altered)
    kept = found.select(F.col(ID).alias("i"), (folded(F.coalesce(merkle.ALTERED, LEAF), F.col(PROOF)) == F.col(ROOT)).alias("ok"), proof_hash(F.col(PROOF)).alias("p"))
    proofs = {r[0]: digest(*[b + a for b, a in r[5]]) for r in slow(rows)}
    for r in kept.collect():
        assert r["ok"] == (r["i"] % 2 == 1 or r["i"] % 3 == 0) and r["p"] == proofs[r["i"]]


def test_no_texts_in_shuffles(spark, capsys):
    docs = docs_of(spark, [(i, "a", "t") for i in range(40)])
    manifest(docs, FIELDS).explain("formatted")
    plan = capsys.readouterr().out
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "text#" not in plan and "Python" not in plan
