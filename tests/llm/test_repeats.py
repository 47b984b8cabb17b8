from __future__ import annotations

import hashlib
import pickle
import random
import time

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardtide.llm import repeats
from cardtide.llm.repeats import KEPT, N_BYTES, N_REMOVED, N_SPANS, repeated_bytes, runs_by_anchor
from cardtide.llm.suffix import least_owner, suffix_array, words_at
from tests.llm.helpers import messy_docs, prose

LAST = 2**63 - 1


def slow(rows: list[tuple[int | None, str | None]], length: int) -> list[tuple]:
    texts = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    first: dict[bytes, int] = {}
    for owner, data in texts:
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            first[window] = min(first.get(window, LAST), owner)
    out = []
    for (i, _), (owner, data) in zip(rows, texts):
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < owner:
                gone[p : p + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone & ~np.concatenate([[False], gone])[: len(gone)]).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fast(docs, **options) -> list[tuple]:
    rows = repeated_bytes(docs, **options).select("doc_id", N_BYTES, N_REMOVED, N_SPANS, KEPT).collect()
    return sorted(((*r[:4], hashlib.sha256(bytes(r[KEPT])).hexdigest()) for r in rows), key=str)


@given(st.binary(max_size=120), st.sampled_from([b"", b"ab", b"\0", b"abcabcabc"]))
@settings(max_examples=150, deadline=None)
def test_suffix_array(data, unit):
    data += unit * 12
    order = suffix_array(words_at(np.frombuffer(data, np.uint8)), len(data))
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


@pytest.mark.parametrize("shard", [40, 200, 10_000])
@pytest.mark.parametrize("length", [8, 9, 20])
def test_least_owner(shard, length):
    rng = random.Random(shard + length)
    runs = ["".join(rng.choices("ab\0", k=rng.randint(length, length + 12))).encode() for _ in range(60)]
    runs += runs[:20]
    rng.shuffle(runs)
    sizes = np.array([len(r) - length + 1 for r in runs])
    firsts = np.cumsum([0, *map(len, runs[:-1])])
    owners = np.array([rng.randint(0, 9) for _ in runs])
    found = least_owner(np.frombuffer(b"".join(runs), np.uint8), firsts, sizes, owners, length, shard)
    least: dict[bytes, int] = {}
    windows = [(r[p : p + length], o) for r, o, s in zip(runs, owners.tolist(), sizes.tolist()) for p in range(s)]
    for w, o in windows:
        least[w] = min(least.get(w, 99), o)
    assert found.tolist() == [least[w] for w, _ in windows]


@pytest.mark.parametrize("gram", [8, 10, 24])
def test_runs_cover_all_windows_and_agree(gram):
    """Every window is in exactly one run, and equal windows have equal anchor keys."""
    texts = [prose(i, 40 + i).encode() for i in range(6)] * 2 + [b"", b"x" * 49, b"y" * 50, b"z" * 300]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    first, number, doc, key = runs_by_anchor(data, offsets, 50, gram)
    places = np.concatenate([np.arange(f, f + n) for f, n in zip(first, number)])
    expected = [p for i, j in zip(offsets[:-1], offsets[1:]) for p in range(i, j - 49)]
    assert places.tolist() == expected
    keys: dict[bytes, set[int]] = {}
    for f, n, k in zip(first, number, key):
        for p in range(f, f + n):
            keys.setdefault(data[p : p + 50].tobytes(), set()).add(int(k))
    assert all(len(v) == 1 for v in keys.values())
    assert ((offsets[doc] <= first) & (first + number + 49 <= offsets[doc + 1])).all()


def test_messy_rows(spark):
    docs = messy_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = slow(rows, 50)
    assert sum(r[2] for r in expected) > 1000
    assert fast(docs) == expected
    assert fast(docs, shard_bytes=2000, hot=0) == expected
    assert fast(docs, shard_bytes=700, hot=3, gram=16) == expected
    assert fast(docs, length=20, gram=8) == slow(rows, 20)


def test_a_passage_of_many_documents(spark):
    """Half the documents hold one passage, each between texts of its own: all hot runs are dealt by content."""
    passage = prose(9, 25)
    texts = [prose(100 + i, 20) + (passage if i % 2 else "") + prose(500 + i, 20) for i in range(200)]
    docs = messy_docs(spark, texts, parts=7)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert fast(docs, shard_bytes=4000, hot=20) == slow(rows, 50)


def test_other_columns_come_back(spark):
    docs = messy_docs(spark)
    found = repeated_bytes(docs).select(*docs.columns)
    assert found.schema == docs.schema
    assert sorted(map(str, found.collect())) == sorted(map(str, docs.collect()))


def test_text_form_cuts_whole_characters(spark):
    docs = spark.createDataFrame([(1, "日本語" * 40), (2, "é" + "本語日" * 40 + "ü"), (3, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in repeated_bytes(docs, as_text=True).collect()}
    assert rows[1][KEPT] == "日本語" * 40 and rows[2][KEPT] in ("éü", "é語ü", "é日ü") and rows[3][KEPT] == ""


def test_empty_tables(spark):
    assert repeated_bytes(messy_docs(spark, [])).count() == 0
    short = messy_docs(spark, [None, "", "short"])
    assert [r[2] for r in fast(short)] == [0] * 5


def test_anchor_keys_spread_evenly():
    """Key ranges are dealt to tasks, so no tenth of the range may hold much more than a tenth of the anchors."""
    data = np.random.default_rng(0).integers(97, 123, 200_000, dtype=np.uint8)
    key = runs_by_anchor(data, np.array([0, len(data)]), 50, 24)[3]
    tenths = np.bincount((key >> np.uint64(38)).astype(np.int64) * 10 >> 10, minlength=10) / len(key)
    assert 0.09 < tenths.min() and tenths.max() < 0.11


@pytest.mark.parametrize("parts, of_each", [(400, 7), (2800, 1), (30, 93), (5, 3)])
def test_bundles_are_few_and_bounded(spark, parts, of_each):
    """What is sent between bundles and content shards is one row for each pair, so there must not be a bundle for each shard."""
    n = parts * of_each
    shard = F.shiftleft(F.floor(F.col("id") / of_each), 32) + F.col("id") % of_each
    bundles = spark.range(n).groupBy(repeats.bundle_of(shard, n, parts)).count().collect()
    assert max(r["count"] for r in bundles) <= 4
    assert len(bundles) <= max(n / 3, 96)


@pytest.mark.parametrize("held", [1, 32 << 20])
def test_bundles_of_several_shards(spark, monkeypatch, held):
    monkeypatch.setattr(repeats, "_BUNDLES", 1)
    monkeypatch.setattr(repeats, "_HELD", held)
    docs = messy_docs(spark)
    expected = slow([(r["doc_id"], r["text"]) for r in docs.collect()], 50)
    assert fast(docs, shard_bytes=700, hot=3, gram=16) == expected
    assert fast(docs.coalesce(1), shard_bytes=2000) == expected


def test_deciding_takes_time_by_windows_and_not_by_senders():
    """The same runs from two senders and from 3,000: the time per sender must not be that of all windows."""
    data = np.random.default_rng(1).integers(0, 256, 60_000 * 63, dtype=np.uint8)

    def decided(senders):
        values = [(data.tobytes(), np.full(60_000, 14, np.int32), np.arange(60_000, dtype=np.int32), np.arange(60_000) * 63, np.zeros(60_000, np.int64))]
        for some in np.array_split(np.arange(60_000, dtype=np.int32), senders):
            body = data.reshape(-1, 63)[some].tobytes()
            values.append((body, np.full(len(some), 14, np.int32), np.arange(len(some), dtype=np.int32), some.astype(np.int64) * 63, np.ones(len(some), np.int64)))
        packed = pa.chunked_array([pa.array([zstandard.ZstdCompressor(1).compress(pickle.dumps(v, 5)) for v in values], pa.binary())])
        took = []
        for _ in range(2):
            began = time.process_time()
            found = repeats._flagged(list(range(senders + 1)), packed, 50, 4 << 20)
            took.append(time.process_time() - began)
        spans = [x for _, v in found for x in zip(*(a.tolist() for a in repeats._unpacked(v)))]
        return sorted(spans), [i for i, _ in found], min(took)

    few, _, base = decided(1)
    many, senders, time_of_many = decided(3000)
    assert many == few == [(63 * i, 14) for i in range(60_000)] and senders == list(range(1, 3001))
    assert time_of_many < 3 * base
