"""Toxicity by two class-conditional Kneser-Ney models of bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cardtide.llm.common import HIDDEN, laid_out, landed, packed_text, pieces, release_memory, release_shuffles, releasing, row_table

TOXICITY = f"{HIDDEN}toxicity"

#: Bytes of the longest sequence; keys hold it in 48 bits.
_ORDER = 6
#: Up to this length both classes share one model, fed by the counts of both.
_SHARED = 3
#: Bytes of a passage that is compared by itself.
_PASSAGE = 16
#: Spreads the bytes before a byte over the model's order, 2^24 places.
_SPREAD = 0x9E3779B1


def sequences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of the last ``_ORDER`` bytes at every byte, and offsets; zeros stand before each text, A-Z are a-z."""
    n = len(data)
    padded = np.zeros(n + _ORDER + 7, np.uint8)
    padded[_ORDER - 1 : _ORDER - 1 + n] = _LOWER[data]
    # Eight bytes from every place on, of which the first six, read from the left, are the key.
    key = (np.ndarray(n, "<u8", padded, 0, (1,)).byteswap() >> np.uint64(64 - 8 * _ORDER)).view(np.int64)
    begins, sizes = offsets[:-1], np.diff(offsets)
    for place in range(_ORDER - 1):
        key[begins[sizes > place] + place] &= (1 << (8 * (place + 1))) - 1
    return key, offsets


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def counted(rows: DataFrame, text: str, positive: str, batch_bytes: int = 1 << 20) -> DataFrame:
    """(key, hot, cold: long): how often each sequence of ``_ORDER`` bytes is in texts where ``positive`` is true, and else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in pieces(batches, text, batch_bytes):
            data, offsets = packed_text(batch.column(text))
            if not len(data):
                continue
            hot = np.repeat(np.asarray(batch.column(positive).fill_null(False)).astype(np.uint64), np.diff(offsets))
            held.append(_tallied(sequences(data, offsets)[0], hot))
            if sum(len(keys) for keys, _ in held) > 1 << 21:
                held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
                if len(held[0][0]) > 1 << 20:
                    yield _counts(*held.pop())
        if held:
            yield _counts(*_summed(*map(np.concatenate, zip(*held, strict=True))))

    found = rows.select(text, positive).mapInArrow(releasing(run), "key long, hot long, cold long")
    return found.groupBy("key").agg(F.sum("hot").alias("hot"), F.sum("cold").alias("cold"))


def _tallied(keys: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and how often each occurs where ``hot`` is 1 and where it is 0."""
    both = np.sort((keys.view(np.uint64) << np.uint64(1)) | hot)
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    number = np.diff(np.append(first, len(both))).astype(np.int32)
    both = both[first]
    is_hot = (both & np.uint64(1)).astype(bool)
    times = np.stack([np.where(is_hot, number, 0), np.where(is_hot, 0, number)], 1).astype(np.int32)
    keys = (both >> np.uint64(1)).view(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times, first, axis=0)


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    by = np.argsort(keys)
    keys = keys[by]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times[by], first, axis=0)


def _counts(keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    hot, cold = times.astype(np.int64).T.copy()
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(hot), pa.array(cold)], ["key", "hot", "cold"])


def model_rows(counts: DataFrame, discount: float) -> tuple[DataFrame, DataFrame]:
    """Seen sequences (length, key, n, gain) and contexts (length, key, n, gain), gains being log ratios hot : cold.

    Interpolated Kneser-Ney with absolute discounting. Below the longest length a count is that of different
    bytes before the sequence. Lengths up to ``_SHARED`` are estimated from both classes together, so that what
    one class has hardly seen is judged by the same backoff in both. A sequence's gain is the ratio of its
    probabilities; a context's is the ratio of the weights with which the classes back off in it.
    """
    levels = {_ORDER: counts}
    for length in range(_ORDER - 1, 0, -1):
        upper = levels[length + 1]
        key = F.col("key").bitwiseAND((1 << (8 * length)) - 1)
        if length > _SHARED:
            lower = upper.groupBy(key.alias("key")).agg(
                F.count_if(F.col("hot") > 0).alias("hot"), F.count_if(F.col("cold") > 0).alias("cold")
            )
        else:
            lower = upper.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("hot")).withColumn("cold", F.col("hot"))
        levels[length] = landed(lower, f"sequences-{length}")
    below = counts.sparkSession.createDataFrame([(0, 1 / 256, 1 / 256)], "suffix long, hot_below double, cold_below double")
    seen = contexts = None
    for length in range(1, _ORDER + 1):
        here = levels[length].withColumn("context", F.shiftright("key", 8)).withColumn(
            "suffix", F.col("key").bitwiseAND((1 << (8 * (length - 1))) - 1)
        )
        totals = here.groupBy("context").agg(
            F.sum("hot").alias("hot_all"), F.count_if(F.col("hot") > 0).alias("hot_kinds"),
            F.sum("cold").alias("cold_all"), F.count_if(F.col("cold") > 0).alias("cold_kinds"),
        )
        weight = {c: F.when(F.col(f"{c}_all") > 0, discount * F.col(f"{c}_kinds") / F.col(f"{c}_all")).otherwise(1.0) for c in ("hot", "cold")}
        chance = {
            c: F.when(F.col(f"{c}_all") > 0, F.greatest(F.col(c) - discount, F.lit(0.0)) / F.col(f"{c}_all")).otherwise(0.0)
            + weight[c] * F.col(f"{c}_below")
            for c in ("hot", "cold")
        }
        known = here.join(totals, "context").join(below, "suffix").select(
            F.lit(length).alias("length"), "key", (F.col("hot") + F.col("cold")).alias("n"),
            chance["hot"].alias("hot_chance"), chance["cold"].alias("cold_chance"),
        )
        if length > 1:
            known = landed(known, f"chances-{length}")
        below = known.select(F.col("key").alias("suffix"), F.col("hot_chance").alias("hot_below"), F.col("cold_chance").alias("cold_below"))
        if length > _SHARED:
            one = known.select("length", "key", "n", F.log(F.col("hot_chance") / F.col("cold_chance")).alias("gain"))
            two = totals.select(
                F.lit(length).alias("length"), F.col("context").alias("key"), (F.col("hot_all") + F.col("cold_all")).alias("n"),
                F.log(weight["hot"] / weight["cold"]).alias("gain"),
            )
            seen = one if seen is None else seen.union(one)
            contexts = two if contexts is None else contexts.union(two)
    return seen, contexts


def _slot(key: np.ndarray, length: int, context: bool, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """First slot of keys of one kind, and what tells them from all others: the whole key, and the kind above its 48 bits."""
    whole = key | ((2 * length + context) << 56)
    return _first_slot(whole, bits), whole


def _first_slot(whole: np.ndarray, bits: int) -> np.ndarray:
    mixed = whole.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _tabled(whole: np.ndarray, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys and gains in slots, all of them: a key whose first slot is taken stands in the next free one."""
    bits = max(4, int(np.ceil(np.log2(1.5 * len(whole) + 1))))
    first = _first_slot(whole, bits)
    by = np.argsort(first, kind="stable")
    at = np.arange(len(by))
    slot = at + np.maximum.accumulate(first[by] - at)
    # The last slot stays empty, so that no search goes past it.
    size = max(1 << bits, int(slot[-1]) + 1 if len(slot) else 0) + 1
    checks, found = np.zeros(size, np.int64), np.full(size, np.nan, np.float32)
    checks[slot], found[slot] = whole[by], gains[by]
    return checks, found, bits


def _places(key: np.ndarray) -> np.ndarray:
    """Where in the model's order all lookups of a byte are: a hash of the 3 bytes before it, which all its lengths share."""
    return (((key >> 8) & 0xFFFFFF) * _SPREAD & 0xFFFFFFFF) >> 8


@dataclass(frozen=True)
class Gains:
    """Log ratios of sequences and contexts, one block of them, in a table of slots."""

    checks: np.ndarray
    gains: np.ndarray
    bits: int

    def _found(self, key: np.ndarray, length: int, context: bool) -> tuple[np.ndarray, np.ndarray]:
        slot, check = _slot(key, length, context, self.bits)
        check = check.astype(self.checks.dtype)
        gain = self.gains[slot].astype(np.float32)
        known = (self.checks[slot] == check) & ~np.isnan(gain)
        # Slots taken by other keys: the next ones, up to an empty one.
        left = np.flatnonzero(~known & ~np.isnan(gain))
        while len(left):
            slot[left] = (slot[left] + 1) % len(self.gains)
            here = self.gains[slot[left]].astype(np.float32)
            taken = ~np.isnan(here)
            same = taken & (self.checks[slot[left]] == check[left])
            known[left[same]], gain[left[same]] = True, here[same]
            left = left[taken & ~same]
        return known, gain

    def of_keys(self, key: np.ndarray) -> np.ndarray:
        total = np.zeros(len(key), np.float32)
        left = np.arange(len(key))
        for length in range(_ORDER, _SHARED, -1):
            here = key[left] & ((1 << (8 * length)) - 1)
            known, gain = self._found(here, length, False)
            total[left[known]] += gain[known]
            left, here = left[~known], here[~known]
            if not len(left):
                break
            # Not seen: the classes back off, each with its own weight.
            known, gain = self._found(here >> 8, length, True)
            total[left[known]] += gain[known]
        return total


@dataclass(frozen=True)
class Model:
    """The gains as a table (whole key, place, gain), the number of blocks that its places are dealt into, and the calibration."""

    gains: DataFrame
    blocks: int
    calibration: tuple[float, ...] = ()

    def scores(self, signs: np.ndarray) -> np.ndarray:
        bias, *weights = self.calibration
        return 1 / (1 + np.exp(-np.clip(bias + signs @ np.array(weights), -30, 30)))


def signs_of(total: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """What the calibration weighs of each text, from the gain of every byte: its log likelihood as toxic less that as ordinary, normalised.

    Per 100 bytes and per root of bytes (what a text is like, and how sure that is), the highest sum of a passage of
    ``_PASSAGE`` bytes (short expressions in a long text), and the log of the length, with which that highest sum
    grows.
    """
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), 4))
    size = np.maximum(sizes, 1)
    out[:, 3] = np.log(size)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    edges = np.stack([offsets[some], offsets[some + 1]], 1).ravel()
    ratio = np.add.reduceat(np.append(total, 0), edges, dtype=np.float64)[::2]
    out[some, 0], out[some, 1] = 100 * ratio / size[some], ratio / np.sqrt(size[some])
    upto = np.concatenate([[0], np.cumsum(total, dtype=np.float64), np.zeros(_PASSAGE)])
    passage = upto[_PASSAGE:] - upto[:-_PASSAGE]
    edges = np.stack([offsets[some], offsets[some] + np.maximum(sizes[some] - _PASSAGE + 1, 1)], 1).ravel()
    best = np.maximum.reduceat(passage, edges)[::2]
    out[some, 2] = np.where(sizes[some] < _PASSAGE, ratio, best)
    return out


def _signs_by_rows(total: np.ndarray, offsets: np.ndarray, limit: int = 1 << 21) -> np.ndarray:
    """``signs_of`` of about ``limit`` bytes of texts at a time: sums of a whole shard would be the largest part of a task."""
    out, i, n = [np.zeros((0, 4))], 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        out.append(signs_of(total[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
        i = j
    return np.concatenate(out)


def learned(
    rows: DataFrame,
    text: str,
    positive: str,
    order: Column,
    discount: float = 0.75,
    block_keys: int = 1 << 19,
    calibration_rows: int = 4000,
) -> Model:
    """The two models, from all labelled rows, and their calibration, from a bounded sample.

    Counts cover every row of ``rows`` whose ``positive`` (boolean) is not null, but for those that the calibration
    reads: about ``calibration_rows`` by hash of ``order`` and the text (a row that is there many times counts as
    one), and an eighth at most. All sequences and contexts that were counted are kept, with their whole keys, in a
    table; it is dealt into as many blocks as it takes for about ``block_keys`` each. The driver sees their number
    alone. Calibration is a logistic regression on the length-normalised ratios of the rows kept back.
    """
    usable = rows.where(F.col(positive).isNotNull() & F.col(text).isNotNull())
    n = usable.select(positive).count()
    share = min(1 / 8, calibration_rows / n) if n else 1 / 8
    # Null ids have a hash too.
    place = F.xxhash64(order, F.col(text), F.lit("calibration"))
    kept_back = F.pmod(place, F.lit(1 << 30)) < int(share * (1 << 30))
    counts = landed(counted(usable.where(~kept_back), text, positive), "sequence-counts")
    gains = gain_table(*model_rows(counts, discount))
    model = Model(gains, max(1, -(-gains.count() // block_keys)))

    def signs(texts: pa.Table, found: np.ndarray) -> pa.Table:
        return pa.table([*map(pa.array, found.T.copy()), texts.column("label")], [*"abcd", "label"])

    sample = usable.where(kept_back).select(F.col(text).alias("text"), F.col(positive).alias("label"), place.alias("place")).dropDuplicates(["place"])
    schema = "a double, b double, c double, d double, label boolean"
    table = _with_signs(sample.select("text", "label"), "text", model, signs, schema).orderBy(*"abcd").toArrow()
    x = np.stack([table.column(c).to_numpy() for c in "abcd"], 1)
    release_shuffles(gains.sparkSession)
    return Model(gains, model.blocks, _logistic(x, np.asarray(table.column("label")).astype(float)))


def gain_table(seen: DataFrame, contexts: DataFrame) -> DataFrame:
    """(place, whole, gain) of all sequences and contexts, written: where a byte's lookups are, the key with its kind, the log ratio."""

    def entries(part: DataFrame, context: int) -> DataFrame:
        before = part["key"] if context else F.shiftright("key", 8)
        place = F.shiftright((before.bitwiseAND(0xFFFFFF) * F.lit(_SPREAD).cast("long")).bitwiseAND((1 << 32) - 1), 8)
        kind = F.shiftleft((2 * F.col("length") + context).cast("long"), 56)
        return part.select(place.cast("int").alias("place"), F.col("key").bitwiseOR(kind).alias("whole"), F.col("gain").cast("float").alias("gain"))

    return landed(entries(seen, 0).unionAll(entries(contexts, 1)), "gains")


#: Bytes of text whose keys one cell of the lookup takes in, about.
_CELL = 64 << 20
_LEVEL = 3


#: Bytes of a shard that are gone through at a time, at most: a key and a place among them fit into 64 bits.
_STRETCH = 1 << 16


def _stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretch by stretch of a shard where it begins, its different keys in order, how often each occurs, and the places of all, key by key."""
    at = 0
    while at < len(data):
        # Whole texts, but of a very long one some of its bytes and the few before them.
        row = int(np.searchsorted(offsets, at, "right")) - 1
        if offsets[row + 1] - at > _STRETCH:
            end, begin = at + _STRETCH, max(int(offsets[row]), at - _ORDER)
            key = sequences(data[begin:end], np.array([0, end - begin]))[0][at - begin :]
        else:
            last = int(np.searchsorted(offsets, at + _STRETCH, "right")) - 1
            end = int(offsets[last])
            inner = offsets[row : last + 1].copy()
            inner[0] = max(inner[0], at - _ORDER)
            key = sequences(data[inner[0] : end], inner - inner[0])[0][at - inner[0] :]
        both = np.sort((key.view(np.uint64) << np.uint64(16)) | np.arange(len(key), dtype=np.uint64))
        key = (both >> np.uint64(16)).view(np.int64)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        yield at, key[first], np.diff(np.append(first, len(key))), (both & np.uint64(0xFFFF)).astype(np.int64)
        at = end


def _distinct(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The different keys of a shard, in order."""
    held: list[np.ndarray] = []
    for _, different, _, _ in _stretches(data, offsets):
        held.append(different)
        if sum(map(len, held)) > 1 << 22:
            held = [_merged(held)]
    return _merged(held)


def _merged(held: list[np.ndarray]) -> np.ndarray:
    keys = np.sort(np.concatenate(held)) if held else np.zeros(0, np.int64)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _by_block(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by block of keys that are in order, the blocks there are, and where they begin and end in it."""
    block = (_places(keys) * blocks) >> 24
    order = np.argsort(block, kind="stable")
    some, first = np.unique(block[order], return_index=True)
    return order, some, np.append(first, len(keys))


def _packed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, compressed; keys in order as steps."""
    if values.dtype == np.int64:
        values = np.diff(values, prepend=0)
    return zstandard.ZstdCompressor(_LEVEL).compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes())


def _unpacked(value: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    values = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(values) if kind is np.int64 else values


_FOUND = pa.schema([("shard", pa.int64()), ("block", pa.int32()), ("found", pa.binary())])


def _with_signs(
    docs: DataFrame,
    text_col: str,
    model: Model,
    made: Callable[[pa.Table, np.ndarray], pa.Table],
    schema: StructType | str,
    shard_bytes: int = 1 << 24,
) -> DataFrame:
    """What ``made`` makes of the rows of each shard of texts and their signs (texts x 4).

    Texts are dealt into shards. A shard asks for each different sequence in it once: its keys go, in order and
    packed, to the blocks of the model by their places, and come back with their gains. A block meets the keys of
    about ``_CELL`` bytes of text at a time, its rows being sent to as many such cells as the texts take. So no task
    holds more than one shard, or one block of the model and the keys of one cell, and the model never leaves the
    executors.
    """
    blocks = model.blocks
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    cells = total // (blocks * _CELL) + 1
    shards = laid_out(docs, text_col, shard_bytes, _LEVEL).select("shard", "payload").repartition("shard")

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, payload in zip(batch.column("shard").to_pylist(), batch.column("payload"), strict=True):
                data, offsets = packed_text(row_table(payload.as_buffer()).column(text_col))
                if not len(data):
                    continue
                keys = _distinct(data, offsets)
                order, some, edges = _by_block(keys, blocks)
                bodies = [_packed(keys[order[i:j]]) for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                n = len(some)
                cell = pa.array([shard % cells] * n, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), cell, pa.array([shard] * n), pa.array(bodies, pa.binary())],
                    ["block", "cell", "shard", "keys"],
                )

    def looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
        gains = Gains(*_tabled(right.column("whole").to_numpy(), right.column("gain").to_numpy()))
        found = [_packed(gains.of_keys(_unpacked(keys.as_py(), np.int64))) for keys in left.column("keys")]
        return pa.table([left.column("shard"), left.column("block"), pa.array(found, pa.binary())], schema=_FOUND)

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for payload in left.column("payload"):
            texts = row_table(payload.as_buffer())
            data, offsets = packed_text(texts.column(text_col))
            gain = np.zeros(len(data), np.float32)
            if len(data):
                keys = _distinct(data, offsets)
                order, some, edges = _by_block(keys, blocks)
                place = {block: (i, j) for block, i, j in zip(some.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)}
                of_key = np.full(len(keys), np.nan, np.float32)
                for block, found in zip(right.column("block").to_pylist(), right.column("found"), strict=True):
                    i, j = place[block]
                    of_key[order[i:j]] = _unpacked(found.as_py(), np.float32)
                for at, different, times, place in _stretches(data, offsets):
                    gain[at + place] = np.repeat(of_key[np.searchsorted(keys, different)], times)
            parts.append(made(texts, _signs_by_rows(gain, offsets)).cast(arrow))
        release_memory()
        return pa.concat_tables(parts) if parts else arrow.empty_table()

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    keys = shards.mapInArrow(releasing(asked), "block int, cell int, shard long, keys binary")
    block = F.shiftright(F.col("place").cast("long") * blocks, 24).cast("int")
    rows = model.gains.select(block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), "whole", "gain")
    found = keys.groupBy("block", "cell").cogroup(rows.groupBy("block", "cell")).applyInArrow(looked_up, "shard long, block int, found binary")
    return shards.groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(answered, schema)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> tuple[float, ...]:
    """Newton's method for a logistic regression with bias; without two classes, the bias alone of their shares."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return (float(np.log(share / (1 - share))), *[0.0] * x.shape[1])
    full = np.concatenate([np.ones((len(y), 1)), x], 1)
    scale = np.maximum(np.abs(full).max(0), 1e-9)
    full = full / scale
    w = np.zeros(full.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        gradient = full.T @ (p - y) + ridge * w
        hessian = (full * (p * (1 - p))[:, None]).T @ full + ridge * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return tuple(float(v) for v in w / scale)


def scored(docs: DataFrame, model: Model, text_col: str = "text", shard_bytes: int = 1 << 24) -> DataFrame:
    """All rows and columns of ``docs`` with TOXICITY, from 0 to 1; whole texts are read.

    Rows are put into shards of about ``shard_bytes`` of text, and at least one row. A null text counts as empty; an
    empty text has the score of the calibration's bias. Repeated rows score alike; an empty table stays empty.
    """

    # Without the table, which is no value that tasks could take along.
    calibration = Model(None, model.blocks, model.calibration)

    def made(texts: pa.Table, signs: np.ndarray) -> pa.Table:
        return texts.append_column(TOXICITY, pa.array(calibration.scores(signs)))

    schema = StructType([*docs.schema.fields, StructField(TOXICITY, DoubleType())])
    return _with_signs(docs, text_col, model, made, schema, shard_bytes)
