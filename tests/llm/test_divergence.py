from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cardtide.llm.common import packed_text
from cardtide.llm.divergence import UNIT, _terms, divergences
from tests.llm.helpers import messy_docs, messy_texts, prose

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = "doc_id long, text string, lang string, source string, n long, docs string, term string, _part int"


def lowered(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def slow(rows: list[tuple[str | None, str | None, str | None]], min_docs: int = 3, top: int = 200) -> set[tuple]:
    """(lang, source, part, item, value, rank) from (text, lang, source), term by term and pair by pair."""
    docs = [(Counter(TERM.findall(lowered(t))), lang or "", source or "") for t, lang, source in rows]
    out = set()
    for lang in {d[1] for d in docs}:
        here = [d for d in docs if d[1] == lang]
        spread = Counter(t for words, *_ in here for t in words)
        kept = sorted((t for t in spread if spread[t] >= min_docs), key=str.encode)
        count: dict[str, Counter] = defaultdict(Counter)
        for words, _, source in here:
            count[source].update({t: n for t, n in words.items() if spread[t] >= min_docs})
        whole = sum(count.values(), Counter())

        def chances(c: Counter) -> list[int]:
            return [1 + UNIT * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept]

        q_all = chances(whole)
        for source in count:
            p = chances(count[source])
            pairs = [(other, sum((x - y) ** 2 // y for x, y in zip(p, chances(count[other]), strict=True))) for other in count if other != source]
            terms = [(t, (x - y) ** 2 // y) for t, x, y in zip(kept, p, q_all, strict=True) if count[source][t] and x > y]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for i, (item, value) in enumerate(sorted(found, key=lambda f: (-f[1], f[0].encode()))[:most]):
                    out.add((lang, source, part, item, value, i + 1))
    return out


def rows_of(found) -> list[tuple]:
    return [tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect()]


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 1, "d", "t", 2) for i, (t, lang, source) in enumerate(rows)], COLUMNS).repartition(3)


def test_terms_are_those_of_the_pattern():
    texts = [t or "" for t in messy_texts()] + ["Ünï-CODE_x9y", "\x00a\x7fb", "日本 語"]
    row, code, terms = _terms(*packed_text(pa.array(texts)))
    found = [[] for _ in texts]
    for i, c in zip(row.tolist(), code.tolist(), strict=True):
        found[i].append(terms[c].as_py())
    assert found == [TERM.findall(lowered(t)) for t in texts]


@pytest.mark.parametrize("blocks", [(16, 4096), (2, 7), (1, 1)])
def test_against_brute_force(spark, blocks):
    rng = np.random.default_rng(5)
    words = TERM.findall(prose(11, 60))
    rows = []
    for i in range(90):
        source = ["big", None, "", "s1", "s2", "É", "z"][int(rng.integers(7)) if i % 3 else 0]
        rows.append((" ".join(rng.choice(words, int(rng.integers(0, 30)))), ["en", "de", None][i % 3], source))
    rows += [(None, "en", "empty"), ("!!", "xx", "lone"), ("a b", "yy", "p"), ("c", "yy", "q")] + rows[:5]
    found = rows_of(divergences(table(spark, rows), source_block=blocks[0], term_block=blocks[1]))
    true = slow(rows)
    assert len(found) == len(true) and set(found) == true
    assert {r[4] for r in found if r[0] == "yy"} == {0} and not [r for r in found if r[0] == "xx"]


def test_only_the_first_terms(spark):
    rows = [(" ".join(f"{w}{'x' * i}" for i in range(6)), "en", w) for w in ("a", "b") for _ in range(3)]
    found = rows_of(divergences(table(spark, rows), top=2))
    assert set(found) == slow(rows, top=2) and len(found) == 6


def test_messy_rows(spark):
    docs = messy_docs(spark).withColumnRenamed("host", "source")
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    found = rows_of(divergences(docs, min_docs=2))
    assert set(found) == slow(rows, min_docs=2) and len(found) == len(set(found))
    assert divergences(messy_docs(spark, []).withColumnRenamed("host", "source")).count() == 0


def test_large_counts_stay_exact(spark):
    """Counts whose product with the unit passes 2^53."""
    rows = [("a " * 40_000_000 + "b", "en", "s"), ("a b", "en", "t"), ("a b c", "en", "u"), ("c", "en", "t")]
    assert set(rows_of(divergences(table(spark, rows)))) == slow(rows)


def test_no_cross_join(spark, capsys):
    divergences(table(spark, [("a", "en", "s")])).explain("formatted")
    plan = capsys.readouterr().out
    assert "Cartesian" not in plan and "NestedLoop" not in plan
