"""Small tables with everything that may be wrong with rows, and brute-force counterparts."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, rate double, host string, fingerprint string, _part int, label string, kept string"

_SYLLABLES = "th an he re in on er nd ti es or ea st le ou ç é ß 日".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


def messy_texts() -> list[str | None]:
    """Nulls, empty and blank texts, copies, near copies, shared passages, one very long text, odd bytes."""
    passage = prose(1, 30)
    base = prose(2, 400)
    near = base.replace(base[200:206], "XyZzyx", 1)
    return [
        None, "", " \n\t ", "one", "two words", base, base, near, base.upper(), passage,
        prose(3, 50) + passage + prose(4, 50), prose(5, 50) + " " + passage, "a" * 500, "ab" * 300 + "a" * 49,
        "\x00\x00" * 60, "\x00" * 130, prose(6, 30_000), "日本語" * 40, "本語日" * 40, None, "", "\r\n" + passage + "\v",
    ]


def messy_docs(spark: SparkSession, texts: list[str | None] | None = None, parts: int = 3) -> DataFrame:
    """The texts as rows with clashing column names; one row has no id, and one is there twice."""
    texts = messy_texts() if texts is None else texts
    rows = [(100 - i, t, ["en", "de", None][i % 3], 1.0, "h", "f", 7, "l", "k") for i, t in enumerate(texts)]
    if rows:
        rows += [rows[5 % len(rows)], (None, *rows[6 % len(rows)][1:])]
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
