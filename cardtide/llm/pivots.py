"""Exact search for the highest inner products over an index of pivots and distances."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardtide.llm.common import hashed_sample, landed, releasing

_INDEX = "block long, cell int, low double, high double, ids binary, radii binary, box binary, vectors binary"
_QUERIES = "part long, cell int, low double, high double, near double, far double, body binary"
_HITS = "part long, query_id long, vec_id long, score long, place binary"

#: Annuli that a block of queries opens in the first round; each round takes so many times as many.
_FIRST, _MORE = 4, 4

#: Below this squared length every inner product, and every part of its sum, is a whole number that a double holds.
_EXACT = 2.0**53
#: What one rounding may add to a number, as a share of it.
_ROUNDING = 2.0**-52


def scaled(ids: pa.Array, vectors: pa.Array, width: int, scale: float, shift: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and floor(scale * x) of the rows that take part, shorter vectors filled up with zeros.

    With a ``shift`` the whole numbers come divided by scale and by 2^shift, which is exact too as scale is a power of
    two: so no number is too large, and none loses a bit.
    """
    lists = vectors.cast(pa.large_list(pa.float64()))
    n = len(lists)
    offsets = np.zeros(n + 1, np.int64) if n == 0 else lists.offsets.to_numpy()
    values = lists.values.fill_null(np.nan).to_numpy(zero_copy_only=False) if n else np.zeros(0)
    sizes = np.diff(offsets) if n else np.zeros(0, np.int64)
    missing = np.asarray(lists.is_null()) | np.asarray(ids.is_null())
    sizes = np.where(missing, 0, sizes)
    row = np.repeat(np.arange(n), sizes)
    column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((n, width))
    out[row, column] = values[np.repeat(offsets[:-1], sizes) + column] if len(row) else 0.0
    good = ~missing & np.isfinite(out).all(1)
    out = out[good]
    if shift is None:
        with np.errstate(over="ignore"):
            out = np.floor(scale * out)
    else:
        # From 2^52 on a double is a whole number.
        small = np.abs(out) < 2.0**52
        out = np.ldexp(np.where(small, np.floor(np.where(small, out, 0.0) * scale) / scale, out), -shift)
    # Adding 0 makes -0 and 0 the same bytes.
    return ids.fill_null(0).to_numpy(zero_copy_only=False)[good].astype(np.int64), out + 0.0


def _whole(vector: np.ndarray, shift: int, scale: float) -> list[int]:
    """The whole numbers of a vector that was scaled with a ``shift``."""
    found = []
    for x in vector.tolist():
        share, power = math.frexp(x)
        # 53 bits of the number, moved to their place.
        move = power - 53 + shift + int(math.log2(scale))
        bits = int(math.ldexp(share, 53))
        found.append(bits << move if move >= 0 else bits >> -move)
    return found


def _place(score: int) -> bytes:
    """Bytes in the order of whole numbers of up to 65,535 bytes."""
    body = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    if score >= 0:
        return b"\1" + len(body).to_bytes(2, "big") + body
    return b"\0" + (65_535 - len(body)).to_bytes(2, "big") + bytes(255 - b for b in body)


def _pivots(sample: np.ndarray, most: float, count: int) -> np.ndarray:
    """Pivots in the lifted space, each the sample's farthest vector from those before it."""
    lifted = _lifted(sample, most)
    chosen = [0]
    gap = ((lifted - lifted[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(lifted)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((lifted - lifted[chosen[-1]]) ** 2).sum(1))
    return lifted[chosen]


def _lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    """One more component, with which all vectors have the squared length ``most``."""
    rest = np.sqrt(np.maximum(most - (vectors**2).sum(1), 0))
    return np.concatenate([vectors, rest[:, None]], 1)


def _gaps(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def nearest(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 100,
    k: int = 10,
    scale: float = 1024.0,
    pivots: int = 64,
    sample: int = 4096,
    block: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row whose id is divisible by ``every``.

    Components become floor(scale * x); the score is the inner product, ties go to the smaller id, and a query's own
    id is no candidate. Scores are exact, whatever finite components there are: while all vectors are shorter than
    2^26.5, doubles hold every sum; beyond, they only choose candidates, with a margin for their rounding, and whole
    numbers of any size rank these. A score that no long holds is ranked by its value and given as the long next to
    it. ``scale`` is a power of two.

    * One more component makes all vectors equally long, so that the highest inner product is the least distance.
      ``pivots`` are fitted on at most ``sample`` rows (by hash of the id); every row is indexed by its nearest pivot
      and its distance to it, in sorted blocks of at most ``block`` rows.
    * A query first looks at the block it lives in. Its k-th score there gives a distance that no result exceeds; by
      the triangle inequality only the annuli [d - that, d + that] around the pivots can hold results. A block of
      queries opens them nearest first, a few and then more from round to round; after each round the k-th scores so
      far make the distances shorter, and it ends when no annulus within them is left. A query passes over an opened
      block that one of all its pivot distances rules out.

    Rows whose id or vector is null, or that hold a null or non-finite component, take no part. Shorter vectors count
    as filled up with zeros. Equal rows count once; of an id with several vectors the best scores count. With fewer
    than ``k`` candidates all are given; an empty table gives no rows.
    """
    spark = rows.sparkSession
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    width = base.agg(F.max(F.size("vector"))).first()[0] or 0
    if width <= 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    if math.frexp(scale)[0] != 0.5:
        raise ValueError("scale must be a power of two")

    def longest(shift: int | None) -> tuple[float | None, float | None]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, vectors = scaled(batch.column(0), batch.column(1), width, scale, shift)
                if len(vectors):
                    # Where the floor of a component is no double, the component itself is near the largest one.
                    with np.errstate(over="ignore"):
                        square, peak = (vectors**2).sum(1).max(), min(np.abs(vectors).max(), np.finfo(float).max)
                    yield pa.RecordBatch.from_arrays([pa.array([square]), pa.array([peak])], ["most", "peak"])

        return base.mapInArrow(releasing(run), "most double, peak double").agg(F.max("most"), F.max("peak")).first()

    most, peak = longest(None)
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shift = None
    if not most < _EXACT:
        shift = math.frexp(peak)[1]
        most, _ = longest(shift)
    # Twice what a score may be off by, per unit of the query's length.
    margin = 0.0 if shift is None else 4 * (width + 2) * _ROUNDING * math.sqrt(most)
    # Squared distances are sums of squares that cancel: what is left of them is off by this much at most.
    slack = max(1e-3, 4 * math.sqrt((width + 4) * _ROUNDING * most))
    some = hashed_sample(base, F.col("id"), "pivots", sample).select("id", "vector").toArrow().combine_chunks()
    _, fitted = scaled(some.column(0).combine_chunks(), some.column(1).combine_chunks(), width, scale, shift)
    centres = _pivots(fitted if len(fitted) else np.zeros((1, width)), most, pivots)

    def floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                ids, vectors = scaled(part.column(0), part.column(1), width, scale, shift)
                raw = vectors.astype("<f8").tobytes()
                size = 8 * width
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array([raw[i * size : (i + 1) * size] for i in range(len(ids))], pa.binary())], ["id", "vector"]
                )

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                vectors = np.frombuffer(b"".join(part.column("vector").to_pylist()), "<f8").reshape(-1, width)
                gaps = _gaps(_lifted(vectors, most), centres)
                cell = gaps.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), pa.array(gaps[np.arange(len(cell)), cell]), part.column("id"), part.column("vector")],
                    ["cell", "radius", "id", "vector"],
                )

    def distances(body: bytes) -> np.ndarray:
        return _gaps(_lifted(np.frombuffer(body, "<f8").reshape(-1, width), most), centres)

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            begin = 0
            while begin < batch.num_rows:
                if held and held[0].column("cell")[0].as_py() != cells[begin]:
                    yield _block(held, number, distances)
                    held, number = [], number + 1
                room = block - sum(h.num_rows for h in held)
                end = min(begin + room, int(np.searchsorted(cells, cells[begin], "right")))
                held.append(batch.slice(begin, end - begin))
                begin = end
                if sum(h.num_rows for h in held) >= block:
                    yield _block(held, number, distances)
                    held, number = [], number + 1
        if held:
            yield _block(held, number, distances)

    index = landed(
        base.mapInArrow(releasing(floored), "id long, vector binary").distinct()
        .mapInArrow(releasing(keyed), "cell int, radius double, id long, vector binary")
        .repartitionByRange("cell", "radius", "id")
        .sortWithinPartitions("cell", "radius", "id")
        .mapInArrow(releasing(blocked), _INDEX),
        "pivot-index",
    )

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for row in batch.select(["ids", "vectors"]).to_pylist():
                ids, vectors = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], "<f8").reshape(-1, width)
                mine = np.flatnonzero(ids % every == 0)
                if not len(mine):
                    continue
                scores = vectors[mine] @ vectors.T
                scores[ids[mine][:, None] == ids] = -np.inf
                if shift is None:
                    bound = _bounds(scores, ids, k)
                else:
                    bound = np.array([_by_id(x, ids, k) for x in scores]) - margin * np.sqrt((vectors[mine] ** 2).sum(1))
                held.append((ids[mine], vectors[mine], bound))
                if sum(len(h[0]) for h in held) >= 256:
                    yield needs(held, number)
                    held, number = [], number + 1
        if held:
            yield needs(held, number)

    def needs(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], number: int) -> pa.RecordBatch:
        ids, vectors, bound = (np.concatenate(x) for x in zip(*held, strict=True))
        gaps = _gaps(np.concatenate([vectors, np.zeros((len(ids), 1))], 1), centres)
        reach = _reach(vectors, bound, most, slack)
        body = b"".join(x.astype("<f8" if x.dtype.kind == "f" else "<i8").tobytes() for x in (ids, bound, reach, vectors))
        low, high = (gaps - reach[:, None]).min(0), (gaps + reach[:, None]).max(0)
        # The queries themselves travel once, with a cell that no block has.
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(centres) + 1, number)),
                pa.array(np.arange(-1, len(centres)), pa.int32()),
                pa.array(np.concatenate([[reach.max()], low])),
                pa.array(np.concatenate([[reach.max()], high])),
                pa.array(np.concatenate([[0], gaps.min(0)])),
                pa.array(np.concatenate([[0], gaps.max(0)])),
                pa.array([body, *[None] * len(centres)], pa.binary()),
            ],
            ["part", "cell", "low", "high", "near", "far", "body"],
        )

    queries = landed(index.select("ids", "vectors").mapInArrow(releasing(asked), _QUERIES), "pivot-queries")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                *hits, places = _hits(row, width, centres, k, margin, shift, scale)
                parts = pa.array([row["part"]] * len(places), pa.int64())
                names = ["part", "query_id", "vec_id", "score", "place"]
                yield pa.RecordBatch.from_arrays([parts, *map(pa.array, hits), pa.array(places, pa.binary())], names)

    def tightened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["body"]) // (8 * (width + 3))
                ids = np.frombuffer(row["body"], "<i8", n)
                bound, reach = np.frombuffer(row["body"], "<f8", 2 * n, 8 * n).reshape(2, n).copy()
                points = np.frombuffer(row["body"], "<f8", n * width, 24 * n).reshape(n, width)
                known = {q["query_id"]: q["least"] for q in row["found"] or []}
                bound = np.maximum(bound, [known.get(i, -np.inf) for i in ids.tolist()])
                reach = np.minimum(reach, _reach(points, bound, most, slack))
                body = b"".join([row["body"][: 8 * n], bound.tobytes(), reach.tobytes(), row["body"][24 * n :]])
                columns = [pa.array([row["part"]]), pa.array([reach.max()]), pa.array([body], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "reach", "body"])

    blocks = index.select("block", "cell", "low", "high")
    rings = queries.where("cell >= 0").select("part", "cell", "near", "far", F.col("low").alias("from"), F.col("high").alias("to"))
    met = blocks.join(rings, (blocks["cell"] == rings["cell"]) & (F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from")))
    gap = F.greatest(F.lit(0.0), F.col("low") - F.col("far"), F.col("near") - F.col("high"))
    nearest_first = Window.partitionBy("part").orderBy("gap", "block")
    # One row for each annulus that a block of queries may have to open.
    annuli = landed(met.select("part", "block", gap.alias("gap")).withColumn("nth", F.row_number().over(nearest_first)), "pivot-annuli")

    best = Window.partitionBy("query_id").orderBy(F.desc("place"), F.desc("score"), "vec_id")
    bodies = queries.where("cell < 0").select("part", F.col("low").alias("reach"), "body")
    found, begin, end = spark.createDataFrame([], f"{_HITS}, rank int"), 0, _FIRST
    while True:
        due = annuli.where((F.col("nth") > begin) & (F.col("nth") <= end)).join(bodies, "part").where(F.col("gap") <= F.col("reach"))
        hits = (
            due.select("block", "part", "body")
            .join(index.select("block", "cell", "ids", "radii", "box", "vectors"), "block")
            .select("part", "cell", "ids", "radii", "box", "vectors", "body")
            .mapInArrow(releasing(opened), _HITS)
        )
        # An id with several vectors may be asked for in several blocks of queries.
        once = found.drop("rank").unionByName(hits).groupBy("query_id", "vec_id", "score", "place").agg(F.min("part").alias("part"))
        ranked = once.withColumn("rank", F.row_number().over(best))
        found = landed(ranked.where(F.col("rank") <= k), "pivot-found")
        left = annuli.where(F.col("nth") > end)
        if shift is None:
            # Of each query the k-th score: as many as a block has queries.
            last = F.struct("query_id", F.col("score").cast("double").alias("least"))
            least = found.where(F.col("rank") == k).groupBy("part").agg(F.collect_list(last).alias("found"))
            asking = bodies.join(least, "part", "left").select("part", "body", "found")
            bodies = landed(asking.mapInArrow(releasing(tightened), "part long, reach double, body binary"), "pivot-bodies")
        if left.join(bodies.select("part", "reach"), "part").where(F.col("gap") <= F.col("reach")).isEmpty():
            break
        begin, end = end, end * _MORE
    return found.select("query_id", "rank", "vec_id", "score")


def _bounds(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Per query the ``k``-th best of a block's different (id, score); -inf where it has fewer."""
    bound = np.full(len(scores), -np.inf)
    if len(ids) <= k:
        return bound
    if len(np.unique(ids)) == len(ids):
        return np.partition(scores, len(ids) - k, 1)[:, len(ids) - k]
    # Different vectors of one id may have one score.
    for i, mine in enumerate(scores):
        order = np.lexsort((ids, -mine))
        ranked, who = mine[order], ids[order]
        new = np.isfinite(ranked)
        new[1:] &= (ranked[1:] != ranked[:-1]) | (who[1:] != who[:-1])
        places = np.flatnonzero(new)
        if len(places) >= k:
            bound[i] = ranked[places[k - 1]]
    return bound


def _by_id(scores: np.ndarray, ids: np.ndarray, k: int) -> float:
    """The ``k``-th best of the best scores of the ids: rounded scores do not tell whether two of one id are equal."""
    order = np.argsort(-scores, kind="stable")
    _, first = np.unique(ids[order], return_index=True)
    best = -np.sort(-scores[order][first])
    return float(best[k - 1]) if len(best) >= k else -np.inf


def _reach(queries: np.ndarray, bound: np.ndarray, most: float, slack: float) -> np.ndarray:
    """The distance in the lifted space at which the inner product is ``bound``, rounded up."""
    square = (queries**2).sum(1) + most - 2 * bound
    return np.where(np.isfinite(bound), np.sqrt(np.maximum(square, 0)) * (1 + 1e-9) + 2 * slack, np.inf)


def _block(held: list[pa.RecordBatch], number: int, distances: Callable[[bytes], np.ndarray]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held)
    radii = rows.column("radius").to_numpy()
    body = b"".join(rows.column("vector").to_pylist())
    gaps = distances(body)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([rows.column("cell")[0].as_py()], pa.int32()),
            pa.array([radii[0]]),
            pa.array([radii[-1]]),
            pa.array([rows.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
            pa.array([radii.astype("<f8").tobytes()], pa.binary()),
            pa.array([np.stack([gaps.min(0), gaps.max(0)]).astype("<f8").tobytes()], pa.binary()),
            pa.array([body], pa.binary()),
        ],
        ["block", "cell", "low", "high", "ids", "radii", "box", "vectors"],
    )


def _hits(row: dict, width: int, centres: np.ndarray, k: int, margin: float, shift: int | None, scale: float) -> tuple:
    """Per query of a block of queries the best ``k`` different (id, score) of one block of the index that reach its bound."""
    ids, radii = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["radii"], "<f8")
    vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, width)
    n = len(row["body"]) // (8 * (width + 3))
    asked = np.frombuffer(row["body"], "<i8", n)
    bound, reach = np.frombuffer(row["body"], "<f8", 2 * n, 8 * n).reshape(2, n)
    points = np.frombuffer(row["body"], "<f8", n * width, 24 * n).reshape(n, width)
    every = _gaps(np.concatenate([points, np.zeros((n, 1))], 1), centres)
    gaps = every[:, row["cell"]]
    low, high = np.frombuffer(row["box"], "<f8").reshape(2, -1)
    open_ = np.flatnonzero((np.maximum(low - every, every - high).max(1) <= reach) & (gaps - reach <= radii[-1]) & (gaps + reach >= radii[0]))
    if not len(open_):
        return *(np.zeros(0, np.int64),) * 3, []
    begin = int(np.searchsorted(radii, (gaps - reach)[open_].min()))
    end = int(np.searchsorted(radii, (gaps + reach)[open_].max(), "right"))
    scores = points[open_] @ vectors[begin:end].T
    kept = (scores >= bound[open_][:, None]) & (asked[open_][:, None] != ids[begin:end])
    if shift is not None:
        return _ranked(asked[open_], points[open_], ids[begin:end], vectors[begin:end], scores, kept, k, margin, shift, scale)
    query, place = np.nonzero(kept)
    score, found = scores[query, place], ids[begin:end][place]
    order = np.lexsort((found, -score, query))
    ranked = np.stack([query[order], found[order]], 1), score[order]
    new = np.ones(len(order), bool)
    new[1:] = (ranked[0][1:] != ranked[0][:-1]).any(1) | (ranked[1][1:] != ranked[1][:-1])
    order = order[new]
    query = query[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    order = order[rank < k]
    return asked[open_][query[rank < k]], found[order], score[order].astype(np.int64), [None] * len(order)


def _ranked(asked, points, ids, vectors, scores, kept, k, margin, shift, scale) -> tuple:
    """The same by whole numbers, of the candidates whose rounded scores do not rule them out."""
    out: list[tuple[int, int, int, bytes]] = []
    known: dict[int, list[int]] = {}
    for q in np.flatnonzero(kept.any(1)).tolist():
        mine = np.flatnonzero(kept[q])
        least = _by_id(scores[q, mine], ids[mine], k)
        mine = mine[scores[q, mine] >= least - margin * math.sqrt((points[q] ** 2).sum())]
        point = _whole(points[q], shift, scale)
        exact = set()
        for i in mine.tolist():
            if i not in known:
                known[i] = _whole(vectors[i], shift, scale)
            exact.add((-sum(a * b for a, b in zip(point, known[i], strict=True)), int(ids[i])))
        for score, i in sorted(exact)[:k]:
            out.append((int(asked[q]), i, max(-(1 << 63), min((1 << 63) - 1, -score)), _place(-score)))
    if not out:
        return *(np.zeros(0, np.int64),) * 3, []
    query, found, score, place = zip(*out, strict=True)
    return np.array(query, np.int64), np.array(found, np.int64), np.array(score, np.int64), list(place)
