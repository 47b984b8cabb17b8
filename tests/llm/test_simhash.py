from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cardtide.llm import simhash
from cardtide.llm.components import components
from cardtide.llm.simhash import FINGERPRINT, GROUP, fingerprint, near_pairs, simhash_dedup, simhash_groups
from tests.llm.helpers import DOCS, messy_docs, words


def slow_fingerprint(text: str | None) -> int:
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_roots(codes: list[int], distance: int = 3) -> list[int]:
    """For each code the least place of its component."""
    root = list(range(len(codes)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(codes):
            for j in range(i):
                low = min(root[i], root[j])
                if (a ^ codes[j]).bit_count() <= distance and (root[i] != low or root[j] != low):
                    root[i] = root[j] = low
                    changed = True
    return root


@given(st.text(alphabet="aAbZ é\n\t日", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_is_the_slow_one(text):
    assert fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("kind", range(16))
def test_permutations_come_back(kind):
    values = np.random.default_rng(kind).integers(0, 1 << 63, 50, dtype=np.uint64)
    assert (simhash.restored(simhash.permuted(values, kind), kind) == values).all()


def _clustered(seed: int, n: int) -> list[int]:
    """Codes in chains and balls, so that many pairs are near and few are connected directly."""
    rng = np.random.default_rng(seed)
    codes = [int(rng.integers(0, 1 << 63)) for _ in range(n // 8)]
    while len(codes) < n:
        code = codes[int(rng.integers(len(codes)))]
        for bit in rng.choice(64, int(rng.integers(1, 6)), replace=False):
            code ^= 1 << int(bit)
        codes.append(code)
    return sorted(set(codes))


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_components_of_near_pairs(spark, distance, monkeypatch):
    monkeypatch.setattr(simhash, "_PAIRS", 50)
    codes = _clustered(distance, 300)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    rows = spark.createDataFrame([(c,) for c in signed], "code long").repartition(3)
    found = {r["node"]: r["root"] for r in components(near_pairs(rows, distance)).collect()}
    groups: dict[int, set[int]] = {}
    for c in signed:
        groups.setdefault(found.get(c, c), set()).add(c)
    expected: dict[int, set[int]] = {}
    for c, r in zip(signed, slow_roots(codes, distance)):
        expected.setdefault(r, set()).add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("depth", range(len(simhash._FREE) - 1))
def test_turned_bits_come_back(depth):
    values = np.random.default_rng(depth).integers(0, 1 << 63, 50, dtype=np.uint64)
    blocks = []
    for sub in range(4):
        moved = simhash.turned(values, depth, sub)
        assert (simhash.turned(moved, depth, sub, back=True) == values).all()
        blocks.append(simhash.turned(np.array([1 << i for i in range(64)], np.uint64), depth, sub))
    # The bits that come first, behind those shared already, are other ones in each of the four.
    first = [{i for i in range(64) if simhash._FREE[depth + 1] <= int(b[i]).bit_length() - 1 < simhash._FREE[depth]} for b in blocks]
    assert sum(map(len, first)) == len(set.union(*first)) == 4 * (simhash._FREE[depth] - simhash._FREE[depth + 1])


@pytest.mark.parametrize("crowd", [16, 64])
def test_crowded_groups_are_dealt_again(spark, crowd, monkeypatch):
    """Codes that share most of their bits, dealt several times over: the same components, and no group that stays large."""
    monkeypatch.setattr(simhash, "_CROWD", crowd)
    monkeypatch.setattr(simhash, "_EVERY", 1)
    rng = np.random.default_rng(crowd)
    base = int(rng.integers(0, 1 << 63))
    codes = {base ^ int(x) for x in rng.integers(0, 1 << 16, 500)} | {base ^ (int(x) << 48) for x in rng.integers(0, 1 << 12, 200)} | set(_clustered(3, 200))
    signed = [c - (1 << 64) if c >> 63 else c for c in sorted(codes)]
    rows = spark.createDataFrame([(c,) for c in signed], "code long").repartition(3)
    pairs = near_pairs(rows)
    assert pairs._jdf.queryExecution().analyzed().toString().count("LeftAnti") >= 1
    found = {r["node"]: r["root"] for r in components(pairs).collect()}
    roots = slow_roots(sorted(codes))
    expected, groups = {}, {}
    for c, r in zip(signed, roots, strict=True):
        expected.setdefault(r, set()).add(c)
        groups.setdefault(found.get(c, c), set()).add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_one_hot_ball_gives_few_edges(spark):
    """All codes within a few bits of each other: nearly all pairs are near, but edges stay below the codes times the tables."""
    rng = np.random.default_rng(0)
    codes = {0}
    while len(codes) < 3000:
        codes.add(int(sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 4)), replace=False))) & ((1 << 63) - 1))
    edges = near_pairs(spark.createDataFrame([(c,) for c in codes], "code long"))
    assert edges.count() < 16 * len(codes)
    assert components(edges).select("root").distinct().count() == 1


def test_components_of_a_chain_a_star_and_a_ring(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    ring = [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    odd = [(5, 5), (None, 4), (7, None)]
    rows = spark.createDataFrame(chain + star + ring + odd, "a long, b long").repartition(5)
    found = {r["node"]: r["root"] for r in components(rows).collect()}
    assert found == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1200), 1000), **dict.fromkeys(range(2000, 2050), 2000)}
    assert components(rows.limit(0)).count() == 0


def test_groups_of_messy_rows(spark):
    docs = messy_docs(spark)
    found = simhash_groups(docs).collect()
    rows = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in docs.collect()), key=str)
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in found), key=str) == rows
    codes = [r[FINGERPRINT] & (2**64 - 1) for r in found]
    assert codes == [slow_fingerprint(r["text"]) for r in found]
    roots = slow_roots(codes)
    for i, r in enumerate(found):
        ids = [x["doc_id"] for x, root in zip(found, roots) if root == roots[i] and x["doc_id"] is not None]
        assert r[GROUP] == min(ids)
    assert found[0]["_part"] == 7


def test_dedup_keeps_one_of_each_group(spark):
    docs = messy_docs(spark)
    groups = {r[GROUP] for r in simhash_groups(docs).collect()}
    kept = simhash_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids) == sorted(groups)


def test_groups_without_any_id(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "x y z u v w")], "doc_id long, text string")
    assert [r[GROUP] for r in simhash_groups(docs).collect()] == [None] * 3
    assert simhash_dedup(docs).count() == 2


def test_empty_table(spark):
    docs = messy_docs(spark, [])
    assert simhash_groups(docs).count() == 0
    assert simhash_dedup(docs).count() == 0


def test_distance_is_limited(spark):
    with pytest.raises(ValueError):
        near_pairs(spark.createDataFrame([], "code long"), 4)
    assert "text" in DOCS
