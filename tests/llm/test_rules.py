from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardtide.llm.rules import BASE, COUNTS, EVALUATED, FURTHER, KEPT, REJECTED_BY, Features, Rule, cascaded, ordered, sampled
from cardtide.llm.common import HIDDEN
from cardtide.llm.queries import op3_quality_rules
from tests.conftest import TESTDATA
from tests.llm.helpers import messy_docs, messy_texts, words

TEXTS = [*messy_texts(), "a b c d e f a b c d e", "x x x x x x", "l1 w\n l1 w\nl1 w\n\n\nl1 w", "# $ % & * < > |" * 3, "1 2 3 4 5 6 7 8 9 10 11"]


def slow(text: str | None) -> tuple[int, ...]:
    found = words(text)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    again = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_counts(text):
    features = Features(text)
    assert tuple(getattr(features, c) for c in COUNTS) == slow(text)


def test_order_is_by_rejection_per_cost():
    ticks = iter(range(0, 100_000))
    spent = {"cheap": 1, "dear": 40}
    clock = {"now": 0}

    def rule(name, rejects):
        def run(f):
            clock["now"] += spent[name]
            return rejects

        return Rule(name, run)

    both = [rule("dear", True), rule("cheap", True)]
    assert [r.name for r in ordered(both, ["x"] * 10, lambda: clock["now"])] == ["cheap", "dear"]
    both = [rule("cheap", False), rule("dear", True)]
    assert [r.name for r in ordered(both, ["x"] * 100, lambda: clock["now"])] == ["dear", "cheap"]
    assert [r.name for r in ordered(both, [], lambda: next(ticks))] == ["cheap", "dear"]


def test_cascade_stops_at_the_first_rejection(spark):
    docs = messy_docs(spark, TEXTS)
    rules = [*BASE, *FURTHER]
    forward = cascaded(docs, rules, counts=COUNTS).collect()
    backward = cascaded(docs, rules[::-1], batch_rows=2).collect()
    assert len(forward) == docs.count()
    assert [r[KEPT] for r in forward] == [r[KEPT] for r in backward]
    for r in forward:
        names = [rule.name for rule in rules if rule.rejects(Features(r["text"]))]
        assert r[KEPT] == (not names) and r[REJECTED_BY] == (names[0] if names else None)
        assert r[EVALUATED] == ([rule.name for rule in rules].index(names[0]) + 1 if names else len(rules))
        assert tuple(r[HIDDEN + c] for c in COUNTS) == slow(r["text"]) and r["kept"] == "k"
    assert cascaded(messy_docs(spark, []), rules, counts=COUNTS).count() == 0


def test_the_sample_is_bounded_and_fixed(spark):
    docs = messy_docs(spark, TEXTS)
    some = sampled(docs, "text", F.col("doc_id"), rows=5)
    assert len(some) == 5 and some == sampled(docs.repartition(7), "text", F.col("doc_id"), rows=5)
    assert all(len(t or "") <= 100 for t in sampled(docs, "text", F.col("doc_id"), max_bytes=100))


def test_query(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    rows = op3_quality_rules(spark, f"{TESTDATA}/sf0.001").join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        counts = slow(r["text"])
        assert tuple(r[c] for c in COUNTS) == counts
        assert r["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert r["kept"] == (not any(rule.rejects(Features(r["text"])) for rule in [*BASE, *FURTHER]))
