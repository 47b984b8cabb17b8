"""SimHash near-duplicates over a hierarchical index in Gray order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cardtide.llm.common import HIDDEN, landed, releasing
from cardtide.llm.components import EDGE, components
from cardtide.operators.skew import join_spread

FINGERPRINT = f"{HIDDEN}fingerprint"
GROUP = f"{HIDDEN}group"
ROW = f"{HIDDEN}row"

#: Bits below those that a pair shares: at first one block of 16 and one of the 4 blocks of 12 in the rest, and in
#: groups that are dealt once more, one of 4 blocks of the bits left.
_FREE = (36, 27, 21, 16, 12, 9, 7, 6, 5, 4)
_PAIRS = 1 << 20
#: A group of about so many codes is dealt once more.
_CROWD = 4096
#: Codes that group sizes are estimated from, one of so many.
_EVERY = 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of one text; 0 for a text without words, or null."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[: len(words) - shingle] + 1])
    n, counts = len(begins), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        spans = zip(begins[at : at + (1 << 16)].tolist(), ends[shingle - 1 :][at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([digest(line[i:j], seed) for i, j in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def permuted(values: np.ndarray, kind: int) -> np.ndarray:
    """Bits moved so that block ``kind // 4`` of 16 and then sub-block ``kind % 4`` of 12 come first."""
    block, sub = divmod(kind, 4)
    turned = _rotated(values, 16 * block, 64)
    low = turned & np.uint64((1 << 48) - 1)
    return (turned ^ low) | _rotated(low, 12 * sub, 48)


def restored(values: np.ndarray, kind: int) -> np.ndarray:
    block, sub = divmod(kind, 4)
    low = values & np.uint64((1 << 48) - 1)
    return _rotated((values ^ low) | _rotated(low, 48 - 12 * sub, 48), 64 - 16 * block, 64)


def turned(values: np.ndarray, depth: int, sub: int, back: bool = False) -> np.ndarray:
    """The free bits of a depth turned so that their block ``sub`` of the next depth comes first, or turned back."""
    free = _FREE[depth]
    low = values & np.uint64((1 << free) - 1)
    by = sub * (free - _FREE[depth + 1])
    return (values ^ low) | _rotated(low, free - by if back else by, free)


def _rotated(values: np.ndarray, by: int, width: int) -> np.ndarray:
    by %= width
    if not by:
        return values
    kept = np.uint64((1 << width) - 1)
    return ((values << np.uint64(by)) | (values >> np.uint64(width - by))) & kept


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected Gray order; equal leading bits stay equal."""
    rank = values.copy()
    for by in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(by)
    return rank


class _Labels:
    """Component labels of the leaves, merged by batches of pairs."""

    def __init__(self, n: int) -> None:
        self.of = np.arange(n)

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            a, b = self.of[x], self.of[y]
            differ = a != b
            if not differ.any():
                return
            x, y, a, b = x[differ], y[differ], a[differ], b[differ]
            np.minimum.at(self.of, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.of[self.of]
                if np.array_equal(up, self.of):
                    break
                self.of = up


def forest(kinds: np.ndarray, ranks: np.ndarray, distance: int, free: int = _FREE[0]) -> tuple[np.ndarray, np.ndarray]:
    """Edges (as places in the input) that connect all pairs of a group within ``distance`` bits.

    The input is sorted by kind and Gray rank and holds whole groups: equal kind and equal shared
    bits. Nodes of a level are runs with equal leading bits; a pair of nodes carries the differences
    summed so far and is dropped with everything below once they exceed the distance, or once all
    its leaves are connected already. Neighbours in Gray order are connected first.
    """
    codes = ranks ^ (ranks >> np.uint64(1))
    n = len(codes)
    labels = _Labels(n)
    levels = []
    shifts = (free, 2 * free // 3, free // 3, 0)
    for shift in shifts:
        key = codes >> np.uint64(shift)
        levels.append(np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (kinds[1:] != kinds[:-1])])))
    ends = [np.concatenate([x[1:], [n]]) for x in levels]
    inside = np.concatenate([np.ones(n - 1, bool), [False]])
    inside[ends[0][:-1] - 1] = False
    near = np.flatnonzero(inside)
    near = near[np.bitwise_count(codes[near] ^ codes[near + 1]) <= distance]
    labels.link(near, near + 1)
    children = [
        (np.searchsorted(levels[i + 1], levels[i]), np.searchsorted(levels[i + 1], ends[i])) for i in range(len(levels) - 1)
    ]
    roots = np.flatnonzero(ends[0] - levels[0] > 1)
    todo = [(0, roots, roots, np.zeros(len(roots), np.int64))]
    while todo:
        level, a, b, d = todo.pop()
        alike = _one_label(labels.of, levels[level], a, b)
        a, b, d = a[~alike], b[~alike], d[~alike]
        first, last = children[level]
        sizes = (last[a] - first[a]) * (last[b] - first[b])
        if len(a) > 1 and sizes.sum() > _PAIRS:
            cut = max(1, min(len(a) - 1, int(np.searchsorted(np.cumsum(sizes), _PAIRS))))
            todo += [(level, a[cut:], b[cut:], d[cut:]), (level, a[:cut], b[:cut], d[:cut])]
            continue
        for x, y, sums in _crossed(a, b, d, first, last, sizes):
            starts = levels[level + 1]
            fresh = np.uint64(((1 << (shifts[level] - shifts[level + 1])) - 1) << shifts[level + 1])
            sums = sums + np.bitwise_count((codes[starts[x]] ^ codes[starts[y]]) & fresh)
            kept = (sums <= distance) & (x <= y)
            x, y, sums = x[kept], y[kept], sums[kept]
            if level + 2 == len(levels):
                labels.link(starts[x], starts[y])
            else:
                todo.append((level + 1, x, y, sums))
    linked = np.flatnonzero(labels.of != np.arange(n))
    return linked, labels.of[linked]


def _one_label(of: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether all leaves below both nodes of a pair have one label by now."""
    low, high = np.minimum.reduceat(of, starts), np.maximum.reduceat(of, starts)
    return (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])


def _crossed(a, b, d, first, last, sizes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of children of each pair of nodes; of one very wide pair, some rows of children at a time."""
    if len(a) == 1 and sizes[0] > _PAIRS:
        right = np.arange(first[b[0]], last[b[0]])
        step = max(1, _PAIRS // len(right))
        for at in range(first[a[0]], last[a[0]], step):
            left = np.arange(at, min(at + step, last[a[0]]))
            yield np.repeat(left, len(right)), np.tile(right, len(left)), np.full(len(left) * len(right), d[0])
        return
    pair = np.repeat(np.arange(len(a)), sizes)
    place = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    width = (last[b] - first[b])[pair]
    yield first[a][pair] + place // width, first[b][pair] + place % width, d[pair]


def near_pairs(codes: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (a, b) between different codes (column ``code``: long) that connect what ``distance`` bits link.

    Within 3 bits a pair agrees in one of 4 blocks of 16 bits, and then in one of 4 blocks of 12 of the other bits: 16
    tables, in each of which groups share 28 bits. Groups are joined with themselves over the index of ``forest``; a
    group gives fewer edges than it has members, however many pairs it has.

    A crowded group (over about ``_CROWD`` codes, by an estimate) is not one task's work: its codes are dealt once
    more, by each of 4 blocks of the bits that the group leaves free, in one of which each of its pairs agrees too;
    and so on with what is still crowded. That changes what tasks get, not what is found.
    """
    if not 0 <= distance <= 3:
        raise ValueError("distance must be from 0 to 3: the blocks find pairs of up to 3 differing bits")
    codes, edges, depth = landed(codes.select("code"), "codes"), None, 0
    rows = codes.mapInArrow(releasing(_dealt), "kind int, place long")
    some = codes.where(F.pmod(F.xxhash64("code"), F.lit(_EVERY)) == 0).mapInArrow(releasing(_dealt), "kind int, place long")
    while depth + 1 < len(_FREE):
        group = F.shiftrightunsigned("place", _FREE[depth]).alias("group")
        sizes = some.groupBy("kind", group).count().where(F.col("count") > _CROWD // _EVERY)
        crowded = landed(sizes.select("kind", "group"), "crowded")
        if crowded.isEmpty():
            break
        keyed, key = rows.withColumn("group", group), ["kind", "group"]
        found = _group_pairs(keyed.join(crowded, key, "left_anti").drop("group"), depth, distance)
        edges = found if edges is None else edges.unionAll(found)
        again = releasing(_dealt_again(depth))
        rows, some = (
            x.withColumn("group", group).join(crowded, key, "left_semi").mapInArrow(again, "kind int, place long") for x in (rows, some)
        )
        depth += 1
    found = _group_pairs(rows, depth, distance)
    return found if edges is None else edges.unionAll(found)


#: Ranks are unsigned; as longs they are kept in the same order.
_SIGN = np.uint64(1 << 63)


def _batch(kind: np.ndarray, ranks: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array((ranks ^ _SIGN).view(np.int64))], ["kind", "place"])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("code").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for kind in range(16):
            yield _batch(np.full(len(values), kind), gray_rank(permuted(values, kind)))


def _dealt_again(depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks = batch.column("place").to_numpy().view(np.uint64) ^ _SIGN
            values, kind = ranks ^ (ranks >> np.uint64(1)), batch.column("kind").to_numpy()
            for sub in range(4):
                yield _batch(4 * kind + sub, gray_rank(turned(values, depth, sub)))

    return run


def _code(values: np.ndarray, kinds: np.ndarray, depth: int) -> np.ndarray:
    """The codes that stand in tables ``kinds`` of a depth as ``values``."""
    out = np.zeros(len(values), np.uint64)
    for kind in np.unique(kinds).tolist():
        mine = kinds == kind
        found = values[mine]
        for d in range(depth - 1, -1, -1):
            kind, sub = divmod(kind, 4)
            found = turned(found, d, sub, back=True)
        out[mine] = restored(found, kind)
    return out


def _group_pairs(rows: DataFrame, depth: int, distance: int) -> DataFrame:
    """Edges within the groups of equal kind and shared bits of (kind, place)."""
    free = _FREE[depth]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, ranks = np.zeros(0, np.int32), np.zeros(0, np.uint64)
        for batch in batches:
            kinds = np.concatenate([kinds, batch.column("kind").to_numpy()])
            ranks = np.concatenate([ranks, batch.column("place").to_numpy().view(np.uint64) ^ _SIGN])
            group = ranks >> np.uint64(free)
            changes = np.flatnonzero((kinds[1:] != kinds[:-1]) | (group[1:] != group[:-1]))
            whole = int(changes[-1]) + 1 if len(changes) else 0
            if whole:
                yield edges(kinds[:whole], ranks[:whole])
                kinds, ranks = kinds[whole:], ranks[whole:]
        if len(kinds):
            yield edges(kinds, ranks)

    def edges(kinds: np.ndarray, ranks: np.ndarray) -> pa.RecordBatch:
        group = ranks >> np.uint64(free)
        same = np.concatenate([[False], (kinds[1:] == kinds[:-1]) & (group[1:] == group[:-1]), [False]])
        several = same[1:] | same[:-1]
        kinds, ranks = kinds[several], ranks[several]
        x = y = np.zeros(0, np.int64)
        if len(kinds):
            x, y = forest(kinds, ranks, distance, free)
        codes = _code(ranks ^ (ranks >> np.uint64(1)), kinds, depth)
        return pa.RecordBatch.from_arrays([pa.array(codes[place].view(np.int64)) for place in (x, y)], ["a", "b"])

    return rows.repartition("kind", F.shiftrightunsigned("place", free)).sortWithinPartitions("kind", "place").mapInArrow(releasing(joined), EDGE)


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, seed: int = 42
) -> DataFrame:
    """All rows and columns of ``docs``, with three hidden ones: FINGERPRINT (long), GROUP and ROW.

    GROUP is the smallest id that can be reached over links of at most ``distance`` differing bits; ROW
    is a number of its own for each row. A null text, or one without words, has fingerprint 0, which
    links like any other; a null id never names a group unless the whole group has no other; repeated
    rows stay and share a group. An empty table gives an empty one. The rows are written once, as are
    the rounds of the component search; equal fingerprints are one node, so copies cost nothing there.
    """
    return join_spread(*_grouped(docs, id_col, text_col, shingle, distance, seed), [FINGERPRINT], [ROW], 8)


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """``docs`` with FINGERPRINT and ROW, written; and (FINGERPRINT, GROUP) for each different fingerprint."""
    schema = StructType([*docs.schema.fields, StructField(FINGERPRINT, LongType())])
    at = docs.columns.index(text_col)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column(at)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes.view(np.int64))], [f.name for f in schema])

    rows = landed(docs.mapInArrow(releasing(marked), schema).withColumn(ROW, F.monotonically_increasing_id()), "fingerprints")
    classes = rows.groupBy(F.col(FINGERPRINT).alias("code")).agg(F.min(id_col).alias("least"))
    linked = landed(components(near_pairs(classes, distance)), "groups")
    least = (
        join_spread(linked.withColumnRenamed("node", "code"), classes, ["code"], ["code"], 1)
        .groupBy("root").agg(F.min("least").alias("group_least"))
    )
    of_linked = join_spread(linked, least, ["root"], ["node"]).select(F.col("node").alias("code"), "group_least")
    named = classes.join(of_linked, "code", "left").select(
        F.col("code").alias(FINGERPRINT),
        F.when(F.col("group_least").isNull(), F.col("least")).otherwise(F.col("group_least")).alias(GROUP),
    )
    return rows, named


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The columns of ``docs`` for one row of each group of ``simhash_groups``: the one with the smallest id.

    Among rows with that same id the first written stays. Cases are those of ``simhash_groups``. Groups are found
    without the other columns: of whole rows there is one shuffle, to the numbers of the rows that stay.
    """
    rows, named = _grouped(docs, id_col, text_col, shingle, distance)
    members = join_spread(rows.select(F.col(id_col).alias("id"), FINGERPRINT, ROW), named, [FINGERPRINT], [ROW], 8)
    kept = (
        members.groupBy(GROUP, F.when(F.col(GROUP).isNull(), F.col(FINGERPRINT)).alias("apart"))
        .agg(F.min(F.struct(F.col("id").isNull(), "id", ROW)).getField(ROW).alias(ROW))
        .select(ROW)
    )
    return rows.join(kept, ROW, "left_semi").select(*docs.columns)


def hex_fingerprint(code: str = FINGERPRINT) -> F.Column:
    return F.lpad(F.lower(F.hex(F.col(code))), 16, "0")

