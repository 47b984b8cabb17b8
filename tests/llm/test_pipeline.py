from __future__ import annotations

import random
from collections import Counter

import numpy as np
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from cardtide.llm.common import landed, not_held_out
from cardtide.llm.mixing import COPIES, RATE, repeated
from cardtide.llm.queries import QUERIES, TOXIC_FROM, learned_language, learned_toxicity
from cardtide.llm.sentencepieces import read_model
from cardtide.llm.subwords import POSTERIOR, TOKENS, classified
from tests.conftest import TESTDATA
from tests.llm.helpers import messy_docs, prose, words
from tests.llm.test_models import _goal, _slow_chances, _slow_score, slow_rates
from tests.llm.test_simhash import slow_fingerprint, slow_roots

SF = f"{TESTDATA}/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = landed(stage(spark, docs, SF), "stage")
        after = {r["doc_id"] for r in docs.collect()}
        assert docs.columns == columns and after <= before, name
        if name in ("suffix-array dedup", "mixing"):
            assert after == before
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and last.where("size(token_ids) <> n_tokens").count() == 0


def test_run_is_all_stages(spark):
    one, two = (corpus_pipeline.run(spark, SF) for _ in range(2))
    assert one.count() == two.count() and one.exceptAll(two).count() == 0
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]


def test_messy_documents_go_through(spark):
    """Every stage takes nulls, empty texts, copies and odd columns, and an empty table."""
    for texts in (None, []):
        docs = messy_docs(spark, texts).withColumnsRenamed({"host": "source"}).selectExpr(
            "*", "cast(length(text) as long) as n_chars"
        )
        for _, stage in corpus_pipeline.STAGES:
            docs = landed(stage(spark, docs, SF), "messy")
        assert (docs.count() > 0) == (texts is None)


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
INSULTS = ("qwgrub", "vexnog", "jkmuff")


def _planted(spark, folder) -> str:
    """Clean and toxic texts, exact and near copies, passages that several texts share, empty and null ones."""
    rng = random.Random(17)
    texts: list[str | None] = []
    for i in range(130):
        body = prose(1000 + i, rng.randint(30, 60)).split()
        if i % 4 == 0:
            for at in (3, 9, 15, 22):
                body[at] = INSULTS[(i + at) % 3]
        texts.append(" ".join(body))
    long = [prose(2000 + i, 200) for i in range(4)]
    texts += [*long, *long, long[0], *[t.replace(t.split()[50], "Other", 1) for t in long], long[1].upper()]
    passage = prose(3000, 60)
    texts += [f"{prose(3100 + i, 20)} {passage} é{prose(3200 + i, 20)}" for i in range(5)] + [passage, None, "", " ", None, "short text"]
    rows = [(7 + 3 * i, t, ["en", "de", None][i % 3], f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCUMENTS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 1, int(any(x in (r[1] or "") for x in INSULTS))) for r in rows[:130]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def _slow_toxicity(spark, rows, sf) -> list:
    """The rows whose score, by dictionaries, is below the limit; the calibration alone is the model's."""
    docs, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    used = docs.where(not_held_out(F.col("doc_id"))).join(labels, "doc_id")
    place = F.xxhash64("doc_id", "text", F.lit("calibration"))
    counted = used.where(~(F.pmod(place, F.lit(1 << 30)) < int((1 << 30) / 8))).select("text", (F.col("toxic") > 0).alias("bad"))
    chance = _slow_chances([tuple(r) for r in counted.collect()], 0.75)
    calibration = learned_toxicity(spark, sf).calibration
    return [r for r in rows if _slow_score(r["text"], chance, calibration) < TOXIC_FROM]


def _slow_near(rows) -> list:
    rows = sorted(rows, key=lambda r: r["doc_id"])
    roots = slow_roots([slow_fingerprint(r["text"]) for r in rows])
    return [r for i, r in enumerate(rows) if roots[i] == i]


def _slow_cut(rows) -> list[tuple]:
    """Texts without the characters that any byte of a string of 50 bytes, started in a smaller document too, lies in."""
    first: dict[bytes, int] = {}
    for r in rows:
        data = (r["text"] or "").encode()
        for i in range(len(data) - 49):
            first[data[i : i + 50]] = min(first.get(data[i : i + 50], r["doc_id"]), r["doc_id"])
    out = []
    for r in rows:
        data = (r["text"] or "").encode()
        gone = {j for i in range(len(data) - 49) if first[data[i : i + 50]] < r["doc_id"] for j in range(i, i + 50)}
        kept, at = "", 0
        for c in r["text"] or "":
            size = len(c.encode())
            kept += "" if gone & set(range(at, at + size)) else c
            at += size
        out.append((r["doc_id"], kept if gone else r["text"], len(kept) if gone else r["n_chars"]))
    return out


def test_every_stage_against_plain_python(spark, tmp_path):
    """Each stage on all that the stage before kept, given the same fitted models."""
    sf = _planted(spark, str(tmp_path))
    docs = spark.read.schema(DOCUMENTS).parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    before = docs.collect()

    def after(name):
        nonlocal docs
        docs = landed(stages[name](spark, docs, sf), "stage")
        return docs.collect()

    kept = after("toxicity")
    assert Counter(map(tuple, kept)) == Counter(map(tuple, _slow_toxicity(spark, before, sf)))
    toxic = {r["doc_id"] for r in before if any(x in (r["text"] or "") for x in INSULTS)}
    left = {r["doc_id"] for r in kept}
    assert len(toxic & left) < 0.2 * len(toxic) and len(left) > 0.95 * (len(before) - len(toxic))

    before, kept = kept, after("simhash near-dedup")
    assert Counter(map(tuple, kept)) == Counter(map(tuple, _slow_near(before)))
    assert len(kept) <= len(before) - 8

    before, kept = kept, after("suffix-array dedup")
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in kept) == sorted(_slow_cut(before), key=lambda r: r[0])
    assert sum(r["text"] != b["text"] for r, b in zip(sorted(kept), sorted(before))) >= 4

    before = kept
    model = learned_language(docs)
    rows = classified(docs, model).collect()
    chance, tokens = np.array([r[POSTERIOR] for r in rows]), np.array([len(words(r["text"])) for r in rows], float)
    assert [r[TOKENS] for r in rows] == tokens.tolist()
    rates = slow_rates(chance, tokens, _goal(chance, tokens, 1.0, labels=model.labels), 1.0)
    rated = spark.createDataFrame([(r["doc_id"], float(x)) for r, x in zip(rows, rates, strict=True)], f"doc_id long, {RATE} double")
    times = {r["doc_id"]: r[COPIES] for r in repeated(rated, "doc_id").collect()}
    kept = after("mixing")
    wanted = Counter({tuple(r): times[r["doc_id"]] for r in before})
    assert Counter(map(tuple, kept)) == wanted and min(times.values()) >= 1

    before, kept = kept, after("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_proto=read_model())
    assert Counter(r["doc_id"] for r in kept) == Counter(r["doc_id"] for r in before)
    assert all(r["token_ids"] == library.encode(r["text"] or "") and r["n_tokens"] == len(r["token_ids"]) for r in kept)
