from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardtide.llm.pivots import _place, _whole, nearest, scaled
from cardtide.llm.queries import op9_exact_top_k
from tests.conftest import TESTDATA

SCHEMA = "vec_id long, embedding array<float>, score int, cell string"


def slow(rows: list[tuple], k: int, every: int, scale: float = 1024.0) -> list[tuple]:
    clean = []
    for vec_id, vector, *_ in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        clean.append((vec_id, tuple(math.floor(scale * float(np.float32(x))) for x in vector)))
    clean = sorted(set(clean))
    best: dict[int, set[tuple[int, int]]] = {}
    for q, x in clean:
        if q % every == 0:
            best.setdefault(q, set()).update((-sum(a * b for a, b in zip(x, y)), i) for i, y in clean if i != q)
    return sorted((q, rank, i, -s) for q, found in best.items() for rank, (s, i) in enumerate(sorted(found)[:k], 1))


def fast(rows, **options) -> list[tuple]:
    return sorted(tuple(r) for r in nearest(rows, **options).collect())


def _rows(seed: int, n: int, width: int, spread: float) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width))
    vectors = centres[rng.integers(0, 5, n)] + spread * rng.normal(size=(n, width))
    vectors *= rng.uniform(0.2, 1.5, (n, 1))
    return [(i, [float(x) for x in v], 1, "c") for i, v in enumerate(vectors)]


@pytest.mark.parametrize(("spread", "block"), [(0.05, 16), (1.0, 50), (0.0, 4096)])
def test_against_brute_force(spark, spread, block):
    rows = _rows(3, 400, 6, spread)
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert fast(table, every=10, k=5, block=block, pivots=8, sample=100) == slow(rows, 5, 10)


def test_messy_rows(spark):
    rows = _rows(1, 60, 4, 0.3)
    rows += [(1000 + i, [0.5, 0.25, 0.125, 0.1], 1, "hot") for i in range(300)]  # one vector, many rows: ties
    rows += [
        (None, [1.0] * 4, 1, ""), (2000, None, 1, ""), (2001, [1.0, None, 1.0, 1.0], 1, ""), (2002, [float("nan")] * 4, 1, ""),
        (2003, [float("inf"), 0.0, 0.0, 0.0], 1, ""), (2100, [1.0], 1, "short"), (2200, [], 1, "none"), rows[0], rows[20], (40, [9.0, 0.0, 0.0, 0.0], 1, "again"),
    ]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    padded = [(i, None if v is None else [*v, *[0.0] * (4 - len(v))], *r) for i, v, *r in rows]
    assert fast(table, every=20, k=7, block=32, pivots=4) == slow(padded, 7, 20)


@pytest.mark.parametrize("block", [16, 4096])
def test_every_row_several_times(spark, block):
    rows = _rows(5, 300, 6, 0.3)
    table = spark.createDataFrame(rows * 3, SCHEMA).repartition(4)
    assert fast(table, every=10, k=5, block=block, pivots=8, sample=100) == slow(rows, 5, 10)


def test_one_score_of_several_vectors(spark):
    """Ten vectors of an id that differ only where the queries are 0 are one result to them."""
    rows = [(i, [1.0, 0.0, 0.001 * i], 1, "") for i in range(0, 40, 10)]
    rows += [(1 + 10 * i, [2.0 - i / 64, j / 8, 0.0], 1, "") for i in range(12) for j in range(10)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for block in (16, 4096):
        assert fast(table, every=10, k=5, block=block, pivots=4) == slow(rows, 5, 10)


DOUBLES = "vec_id long, embedding array<double>"


def slow_whole(rows, k, every):
    """Whole numbers of any size; scores beyond a long are given as the long next to them."""
    def whole(x):
        share = Fraction(x) * 1024
        return share.numerator // share.denominator

    clean = sorted({(i, tuple(map(whole, v))) for i, v in rows})
    best: dict[int, set[tuple[int, int]]] = {}
    for q, x in clean:
        if q % every == 0:
            best.setdefault(q, set()).update((-sum(a * b for a, b in zip(x, y)), i) for i, y in clean if i != q)
    return sorted((q, rank, i, max(-(2**63), min(2**63 - 1, -s))) for q, found in best.items() for rank, (s, i) in enumerate(sorted(found)[:k], 1))


@pytest.mark.parametrize("size", [1e6, 1e15, 1e160, 1e300, 1.7e308])
def test_large_components_are_exact(spark, size):
    """Scores that differ in their last digits alone, and components whose products no double holds."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=4)
    rows = [(i, [float(x) for x in np.clip(base / np.abs(base).max() * size * (1 + 1e-16 * rng.integers(0, 3, 4)) * (1 if i % 3 else 0.3), -1.79e308, 1.79e308)]) for i in range(80)]
    rows += [(100 + i, [float(x) for x in rng.normal(size=4)]) for i in range(40)] + [(200, [0.0, 5e-324, -0.0, -5e-324]), (201, [0.001, size, -size, 0.3]), rows[10]]
    table = spark.createDataFrame(rows, DOUBLES).repartition(3)
    for block in (16, 4096):
        assert fast(table, every=10, k=5, block=block, pivots=6) == slow_whole(rows, 5, 10)


@given(st.lists(st.integers(-(2**2030), 2**2030), min_size=2, max_size=10))
def test_places_are_in_the_order_of_numbers(numbers):
    assert sorted(numbers) == sorted(numbers, key=_place)


@given(st.floats(allow_nan=False, allow_infinity=False), st.integers(990, 1024))
def test_whole_numbers_come_back(x, shift):
    _, vectors = scaled(pa.array([1]), pa.array([[x]]), 1, 1024.0, shift)
    share = Fraction(x) * 1024
    if math.frexp(x)[1] <= shift:
        assert _whole(vectors[0], shift, 1024.0) == [share.numerator // share.denominator]


def test_long_vectors_and_short_distances(spark):
    """Just short enough for doubles: distances of near vectors lose most of their digits, and nothing may get lost by it."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=8)
    base *= 2.0**15.9 / np.linalg.norm(base)
    rows = [(i, [float(x) for x in np.floor(base * 1024 + rng.integers(-40, 41, 8)) / 1024]) for i in range(300)]
    table = spark.createDataFrame(rows, DOUBLES).repartition(3)
    assert fast(table, every=10, k=5, block=16, pivots=16) == slow_whole(rows, 5, 10)


def test_few_and_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0], 1, ""), (1, [3.0, -1.0], 1, ""), (2, [0.0, 0.0], 1, "")], SCHEMA)
    assert fast(few, every=1) == slow([tuple(r) for r in few.collect()], 10, 1)
    for rows in ([], [(0, None, 1, "")], [(None, [1.0], 1, "")], [(0, [], 1, "")]):
        table = spark.createDataFrame(rows, SCHEMA)
        assert nearest(table).columns == ["query_id", "rank", "vec_id", "score"]
        assert nearest(table).count() == 0
    assert nearest(spark.createDataFrame([(0, [1.0], 1, "")], SCHEMA)).count() == 0


def test_query_against_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{TESTDATA}/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = op9_exact_top_k(spark, f"{TESTDATA}/sf0.001")
    assert [f.dataType.typeName() for f in found.schema] == ["long", "integer", "long", "long"]
    assert sorted(tuple(r) for r in found.collect()) == slow(rows, 10, 100)
    assert found.where(F.col("query_id") == F.col("vec_id")).count() == 0
