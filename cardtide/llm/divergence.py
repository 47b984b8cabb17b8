"""Divergences between the word distributions of sources, over a cube of (sources, sources, terms)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardtide.llm.common import HIDDEN, landed, packed_text, pieces, releasing

#: Probabilities are whole numbers of this share.
UNIT = 1_000_000_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_COUNTS = "lang string, source string, term string, n long, docs long"
_PARTIAL = "lang string, source string, item string, value long"


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str, batch_bytes: int = 1 << 22) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and rows that hold it; and one row of a null term per group.

    A term is a longest run of ASCII letters and characters beyond ASCII, with A-Z in lower case. Null values are
    empty ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", batch_bytes):
            lang, source = (batch.column(c).fill_null("").dictionary_encode() for c in ("lang", "source"))
            kinds = len(source.dictionary)
            group = lang.indices.to_numpy().astype(np.int64) * kinds + source.indices.to_numpy()
            some = np.unique(group)
            names = [some, np.full(len(some), -1), np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)]
            data, offsets = packed_text(batch.column("text"))
            row, code, terms = _terms(data, offsets)
            if len(code):
                # Once per row and term, then once per group and term.
                each, times = np.unique(row * len(terms) + code, return_counts=True)
                key = group[each // len(terms)] * len(terms) + each % len(terms)
                by = np.argsort(key, kind="stable")
                key = key[by]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                found = [key[first] // len(terms), key[first] % len(terms), np.add.reduceat(times[by], first), np.diff(np.append(first, len(key)))]
                names = [np.concatenate([a, b]) for a, b in zip(names, found, strict=True)]
            at, term, n, rows = names
            yield pa.RecordBatch.from_arrays(
                [
                    lang.dictionary.take(pa.array(at // kinds)),
                    source.dictionary.take(pa.array(at % kinds)),
                    terms.take(pa.array(term, mask=term < 0)).cast(pa.string()),
                    pa.array(n.astype(np.int64)),
                    pa.array(rows.astype(np.int64)),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    plain = docs.select(*[F.col(c).cast("string").alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = plain.mapInArrow(releasing(run), _COUNTS)
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For every term in order its text and its number among the different terms; and those."""
    letter = _LETTER[data]
    begin = letter.copy()
    begin[1:] &= ~letter[:-1]
    inner = offsets[:-1][np.diff(offsets) > 0]
    begin[inner] = letter[inner]
    places = np.flatnonzero(begin)
    row = np.searchsorted(offsets, places, "right") - 1
    before = np.cumsum(letter) - letter
    edges = np.append(before[places], letter.sum()).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(edges), pa.py_buffer(_LOWER[data[letter]])).dictionary_encode()
    return row, terms.indices.to_numpy().astype(np.int64), terms.dictionary


def _chance(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(UNIT (n + 1) / (total + kinds)), exactly."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", above, (total + kinds).cast("decimal(19,0)"))


def _term_chi(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _cell(table: pa.Table) -> pa.Table:
    """Divergences over one block of terms, of each source of one block from each of another, both ways."""
    lang, a, b = (table.column(c)[0].as_py() for c in ("lang", "a", "b"))
    own = table.column("block").to_numpy()
    source = table.column("source").to_pylist()
    rest = table.column("rest").to_numpy()
    width = table.column("width")[0].as_py()
    places = [np.array(x or [], np.int64) for x in table.column("places").to_pylist()]
    chances = [np.array(x or [], np.int64) for x in table.column("chances").to_pylist()]
    present = np.unique(np.concatenate(places))
    absent = width - len(present)
    # Sources that lack a term have the chance of an unseen one; terms that no source of the cell has are alike.
    full = np.repeat(rest[:, None], len(present) + 1, 1)
    for row, place, chance in zip(full, places, chances, strict=True):
        row[np.searchsorted(present, place)] = chance
    weight = np.ones(len(present) + 1, np.int64)
    weight[-1] = absent
    left = np.flatnonzero(own == a)
    right = np.flatnonzero(own == b)
    out: tuple[list, list, list] = ([], [], [])
    for i in left:
        other = right if a != b else right[right != i]
        squares = (full[i] - full[other]) ** 2
        there = (squares // full[other]) @ weight
        out[0].extend([source[i]] * len(other))
        out[1].extend(source[j] for j in other)
        out[2].extend(there.tolist())
        if a != b:
            back = (squares // full[i]) @ weight
            out[0].extend(source[j] for j in other)
            out[1].extend([source[i]] * len(other))
            out[2].extend(back.tolist())
    names = ["lang", "source", "item", "value"]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table([pa.array(x, kind) for x, kind in zip(([lang] * len(out[0]), *out), kinds, strict=True)], names)


def divergences(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = 3,
    top: int = 200,
    source_block: int = 16,
    term_block: int = 4096,
) -> DataFrame:
    """How far the sources of each language are from each other, and what terms set them apart: (lang, source, part, item, value, rank).

    A language keeps the terms that ``min_docs`` of its rows hold. Each source of it, and the language as a whole,
    gives each kept term a smoothed probability in whole billionths, and p diverges from q by the sum of floor((p -
    q)^2 / q), all in whole numbers. Part ``pair``: for every other source of the language, as q, the sum over all
    kept terms. Part ``term``: the kept terms that a source has and that are likelier there than in the language, with
    their values, to rank ``top``. Ranks go by value downwards, then by item in the order of its bytes.

    Pairs are summed over a cube: terms are dealt by hash into blocks of about ``term_block``, sources into blocks of
    about ``source_block``, and a task owns cells (block of sources, block of sources, block of terms). The numbers of
    a source in a block of terms are one row, sent to each cell that it has a part in; a cell's size does not grow
    with the table. The cells' sums are then added up along the terms.

    Null texts, languages and sources count as empty ones. A group without terms is compared like any other; a
    language without kept terms has pairs of value 0; one with a single source has none. Repeated rows count as often
    as they are there. An empty table gives no rows.
    """
    counts = landed(term_counts(docs, lang_col, source_col, text_col), "term-counts")
    groups = counts.where("term is null").select("lang", "source")
    seen = counts.where("term is not null")
    kept = seen.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = landed(kept.where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    sizes = (
        groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
        .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("lang_n").alias("lang_total")), "lang", "left")
        .na.fill(0, ["kinds", "lang_total"])
        .withColumns(
            {
                "source_blocks": F.ceil(F.col("sources") / source_block).cast("int"),
                "term_blocks": F.greatest(F.lit(1), F.ceil(F.col("kinds") / term_block)).cast("int"),
            }
        )
    )
    sizes = landed(sizes, "languages")
    # Terms by block, numbered within it: a block has about as many terms whatever the table.
    block = Window.partitionBy("lang", "term_at")
    dealt = kept.join(sizes.select("lang", "term_blocks"), "lang").withColumn("term_at", F.pmod(F.xxhash64("term"), "term_blocks").cast("int"))
    numbers = {"place": F.row_number().over(block.orderBy("term")) - 1, "width": F.count(F.lit(1)).over(block)}
    dealt = landed(dealt.drop("term_blocks").withColumns(numbers), "dealt-terms")
    mine = landed(seen.select("lang", "source", "term", "n").join(dealt, ["lang", "term"]), "kept-counts")
    totals = (
        groups.join(mine.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").na.fill(0, ["total"])
        .join(sizes, "lang")
        .select(
            "lang", "source", "total", "kinds", "lang_total", "source_blocks", "term_blocks",
            F.pmod(F.xxhash64("source"), "source_blocks").cast("int").alias("block"),
            F.when(F.col("kinds") > 0, _chance(F.lit(0), F.col("total"), F.col("kinds"))).otherwise(1).alias("rest"),
        )
    )
    totals = landed(totals, "source-totals")
    chances = mine.join(totals.select("lang", "source", "total", "kinds", "lang_total"), ["lang", "source"]).select(
        "lang", "source", "term", "term_at", "place",
        _chance(F.col("n"), F.col("total"), F.col("kinds")).alias("p"),
        _chance(F.col("lang_n"), F.col("lang_total"), F.col("kinds")).alias("q"),
    )

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = (
        chances.where(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _term_chi(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
    )

    slices = chances.groupBy("lang", "source", "term_at").agg(F.collect_list(F.struct("place", "p")).alias("held"))
    widths = dealt.groupBy("lang", "term_at").agg(F.max("width").alias("width"))
    grid = (
        totals.withColumn("term_at", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)))
        .join(widths, ["lang", "term_at"], "left")
        .join(slices, ["lang", "source", "term_at"], "left")
        .withColumn("across", F.explode(F.sequence(F.lit(0), F.col("source_blocks") - 1)))
        .select(
            "lang", F.least("block", "across").alias("a"), F.greatest("block", "across").alias("b"), "term_at", "block", "source", "rest",
            F.coalesce("width", F.lit(0)).alias("width"), F.col("held.place").alias("places"), F.col("held.p").alias("chances"),
        )
    )
    pair = (
        grid.groupBy("lang", "a", "b", "term_at").applyInArrow(_cell, _PARTIAL)
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(best))
    )
    return pair.unionByName(term)
