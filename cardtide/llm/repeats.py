"""Removal of byte strings that repeat across documents, by suffix arrays of content shards."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from cardtide.llm.common import HIDDEN, laid_out, landed, packed_text, release_memory, release_shuffles, releasing, row_table
from cardtide.llm.suffix import least_owner, words_at

N_BYTES, N_REMOVED, N_SPANS, KEPT = (f"{HIDDEN}{x}" for x in ("n_bytes", "n_removed", "n_spans", "kept"))

_LAST = np.iinfo(np.int64).max
_KEY_BITS = 48
#: Shards are written once and shuffled twice: worth more than the fastest compression.
_LEVEL = 5
#: A bundle has so many shards at most, and fewer while there would be less than so many bundles.
_BUNDLE, _BUNDLES = 4, 96
#: Bytes of runs that are packed together at most, but for those of one shard; rows that go to the JVM at once.
_HELD, _ROWS = 32 << 20, 256


def _packed(value: object) -> bytes:
    return zstandard.ZstdCompressor(_LEVEL).compress(pickle.dumps(value, 5))


def _unpacked(value: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(value))


def bundle_of(shard: Column, shards: int, parts: int, most: int = _BUNDLE) -> Column:
    """A number for each bundle of shards: neighbours of a part, and of several parts where these have few shards.

    What is sent between bundles and content shards is one row for each pair. Pairs of shards would be more
    and smaller as the square of the input.
    """
    size = min(most, max(1, shards // _BUNDLES))
    together = max(1, size * parts // max(shards, 1))
    part, number = F.shiftright(shard, 32), shard.bitwiseAND((1 << 32) - 1)
    return F.shiftleft(F.floor(part / together), 32) + F.floor(number / size)


def _in_order(bundle: pa.Table) -> Iterator[tuple[int, int, pa.Table]]:
    """Of each shard of a bundle its number, the place of its first byte among those of the bundle, and its rows."""
    base = 0
    for shard, size, payload in sorted(zip(*(bundle.column(c).to_pylist() for c in ("shard", "n_bytes", "payload")), strict=True)):
        yield shard, base, row_table(payload)
        base += size + 1


def _owners(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_LAST).to_numpy()


def runs_by_anchor(
    data: np.ndarray, offsets: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of ``length`` bytes inside documents, as runs that share an anchor.

    The anchor of a window is its ``gram`` bytes of least hash, the first of equal ones, so equal windows have
    equal anchors wherever they are. Gives, per run: first window, number of windows, document, and a 48-bit
    key of the anchor.
    """
    none = np.zeros(0, np.int64)
    sizes = np.diff(offsets)
    counts = np.maximum(sizes - length + 1, 0)
    if not counts.any():
        return none, none, none, none.astype(np.uint64)
    anchor = _anchors(data, length, gram)
    cuts = np.zeros(len(anchor) + 1, bool)
    cuts[1:-1] = anchor[1:] != anchor[:-1]
    cuts[offsets[:-1][counts > 0]] = True
    cuts[(offsets[:-1] + counts)[counts > 0]] = True
    first = np.flatnonzero(cuts)
    doc = np.searchsorted(offsets, first, "right") - 1
    number = np.diff(np.concatenate([first, [len(anchor)]]))
    inside = first + length <= offsets[doc + 1]
    first, number, doc = first[inside], number[inside], doc[inside]
    places = [*range(0, gram - 7, 8), *([gram - 8] if gram % 8 else [])]
    words = words_at(data)
    # Hashed once more: the least hashes of windows crowd at the lower end, where one key range would get most of them.
    key = _mixed([_mixed([words[anchor[first] + p] for p in places])])
    return first, number, doc, key >> np.uint64(64 - _KEY_BITS)


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of some words in place of the first of them."""
    out = parts[0].copy()
    for i, part in enumerate(parts):
        if i:
            out ^= part
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _anchors(data: np.ndarray, length: int, gram: int, block: int = 1 << 15) -> np.ndarray:
    """For every window of ``length`` bytes of ``data`` the place of its anchor, found a block in cache at a time."""
    n = len(data) - length + 1
    out = np.empty(n, np.int32)
    span = length - gram + 1
    places = [*range(0, gram - 7, 8), *([gram - 8] if gram % 8 else [])]
    bits = np.uint64((block + length).bit_length())
    for at in range(0, n, block):
        windows = min(block, n - at)
        grams = windows + span - 1
        words = words_at(data[at : at + windows + length - 1])
        least = _mixed([words[p : p + grams] for p in places])
        least >>= bits
        least <<= bits
        least |= np.arange(grams, dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        out[at : at + windows] = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int32) + at
    return out


def repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    shard_bytes: int = 4 << 20,
    gram: int = 24,
    hot: int = 4096,
    as_text: bool = False,
) -> DataFrame:
    """All rows and columns of ``docs`` with N_BYTES, N_REMOVED, N_SPANS (long) and KEPT (binary, or string ``as_text``).

    Removed is each byte of a text that is covered by a string of ``length`` bytes which also starts in a
    text of a smaller id; matches never cross texts and are judged on the input as it is.

    * Texts are laid out once in shards of about ``shard_bytes``. Every window of ``length`` bytes has an anchor
      of ``gram`` bytes. Sorted runs of anchors of all shards meet, by key range; only anchors of
      several texts go on.
    * Runs of windows at such anchors are sent by anchor to content shards, equal runs of a shard once.
      There a suffix array (Larsson-Sadakane) and common prefixes (Kasai) decide each window exactly. A
      content shard that is too large is cut into several arrays that are merged by binary search.
    * The runs of an anchor found over ``hot`` times are cut into single windows that are dealt by their
      content, so that a passage many texts share is not one task's work.

    ``as_text`` the other bytes of a character go too where a cut goes through it. A null text is empty; a null id counts as larger than any other; rows of equal id do not remove from each
    other. Texts shorter than ``length``, and empty tables, come back whole.
    """
    spark = docs.sparkSession
    shards = landed(laid_out(docs, text_col, shard_bytes, _LEVEL), "shards")
    total, count, parts = shards.agg(F.sum("n_bytes"), F.count("*"), F.countDistinct(F.shiftright("shard", 32))).first()
    total = total or 0
    bundle = bundle_of(F.col("shard"), count, parts)
    ranges = total // (16 << 20) + 1
    targets = total // (2 << 20) + 1

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, payload in zip(batch.column("shard").to_pylist(), batch.column("payload"), strict=True):
                data, offsets = packed_text(row_table(payload.as_buffer()).column(text_col))
                _, _, doc, key = runs_by_anchor(data, offsets, length, gram)
                if not len(key):
                    continue
                by = np.argsort(key)
                key, doc = key[by], doc[by]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
                times = np.diff(np.concatenate([first, [len(key)]]))
                weight = (np.minimum(np.ceil(np.log2(times)), 126) + 128 * several).astype(np.uint8)
                key = key[first]
                cuts = np.searchsorted(key, [(r << _KEY_BITS) // ranges for r in range(ranges + 1)])
                rows = [
                    (r, shard, key[i:j].view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes(), weight[i:j].tobytes())
                    for r, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                    if j > i
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KEYS.types, strict=True)], _KEYS.names
                )

    def met(part: pa.Table) -> pa.Table:
        sorted_runs, weights = [], []
        for keys, weight in zip(part.column("keys"), part.column("weights"), strict=True):
            weight = np.frombuffer(weight.as_buffer(), np.uint8)
            wide = np.zeros((len(weight), 8), np.uint8)
            wide[:, :6] = np.frombuffer(keys.as_buffer(), np.uint8).reshape(6, -1).T
            sorted_runs.append(wide.view("<u8").ravel())
            weights.append(weight)
        union = np.concatenate(sorted_runs)
        weight = np.concatenate(weights)
        by = np.argsort(union)
        union = union[by]
        first = np.flatnonzero(np.concatenate([[True], union[1:] != union[:-1]]))
        times = np.add.reduceat(np.exp2((weight & 127).astype(np.float32))[by], first)
        sizes = np.diff(np.concatenate([first, [len(union)]]))
        shared = (sizes > 1) | (np.maximum.reduceat(weight[by], first) >= 128)
        answer = np.empty((2, len(union)), bool)
        answer[0, by] = np.repeat(shared, sizes)
        answer[1, by] = np.repeat(shared & (times > hot), sizes)
        ends = np.cumsum([0, *map(len, sorted_runs)])
        out = [np.packbits(answer[:, i:j].ravel()).tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table([part.column("shard"), part.column("range"), pa.array(out, pa.binary())], _BITS.names)

    def sent(left: pa.Table, right: pa.Table) -> pa.Table:
        answers: dict[int, list[tuple[int, pa.BinaryScalar]]] = {}
        for shard, part, value in zip(right.column("shard").to_pylist(), right.column("range").to_pylist(), right.column("bits"), strict=True):
            answers.setdefault(shard, []).append((part, value))
        rows: list[tuple[int, int, bytes]] = []
        held: list[_Dealt] = []
        number = left.column("bundle")[0].as_py() if left.num_rows else 0
        for shard, base, texts in _in_order(left):
            if shard in answers:
                held.append(_dealt(texts, text_col, _owners(texts.column(id_col)), answers.pop(shard), base, length, gram, ranges, targets))
            if sum(len(x.body) + x.first.nbytes + x.unit.nbytes + x.owner.nbytes for x in held) > _HELD:
                rows += _by_target(held, number)
                held.clear()
        rows += _by_target(held, number)
        held.clear()
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + _ROWS], strict=True), _SENT.types, strict=True)], schema=_SENT)
            for i in range(0, len(rows), _ROWS)
        ]
        release_memory()
        return pa.Table.from_batches(batches, _SENT)

    def decided(part: pa.Table) -> pa.Table:
        found = _flagged(part.column("bundle").to_pylist(), part.column("runs"), length, shard_bytes)
        columns = zip(*found, strict=True) if found else [[], []]
        release_memory()
        return pa.table([pa.array(c, t) for c, t in zip(columns, _FLAGS.types, strict=True)], _FLAGS.names)

    schema = StructType(
        [*docs.schema.fields, *(StructField(c, LongType()) for c in (N_BYTES, N_REMOVED, N_SPANS)), StructField(KEPT, StringType() if as_text else BinaryType())]
    )

    def cleaned(left: pa.Table, right: pa.Table) -> pa.Table:
        first, size = (np.concatenate(x) for x in zip((_NONE, _NONE), *(_unpacked(v.as_py()) for v in right.column("windows")), strict=True))
        by = np.argsort(first)
        first, size = first[by], size[by]
        parts = []
        for _, base, texts in _in_order(left):
            data, offsets = packed_text(texts.column(text_col))
            i, j = np.searchsorted(first, [base, base + len(data) + 1])
            parts.append(_cleaned(texts, data, offsets, first[i:j] - base, size[i:j], length, as_text))
        release_memory()
        if not parts:
            return pa.table([pa.array([], f.type) for f in empty], [f.name for f in empty])
        return pa.concat_tables(parts)

    from pyspark.sql.pandas.types import to_arrow_schema

    empty = to_arrow_schema(schema)
    keys = shards.select("shard", "payload").mapInArrow(releasing(keys_of), "range long, shard long, keys binary, weights binary")
    bits = keys.groupBy("range").applyInArrow(met, "shard long, range long, bits binary")
    # What is written here needs no shuffle of before any more.
    bits = landed(bits, "anchors").withColumn("bundle", bundle)
    del keys
    release_shuffles(spark)
    shards = shards.withColumn("bundle", bundle)
    runs = (
        shards.groupBy("bundle").cogroup(bits.groupBy("bundle"))
        .applyInArrow(sent, "target long, bundle long, runs binary")
    )
    flags = landed(
        runs.groupBy("target").applyInArrow(decided, "bundle long, windows binary"), "repeats"
    )
    del bits, runs
    release_shuffles(spark)
    return shards.groupBy("bundle").cogroup(flags.groupBy("bundle")).applyInArrow(cleaned, schema)


_KEYS = pa.schema([("range", pa.int64()), ("shard", pa.int64()), ("keys", pa.binary()), ("weights", pa.binary())])
_BITS = pa.schema([("shard", pa.int64()), ("range", pa.int64()), ("bits", pa.binary())])
_SENT = pa.schema([("target", pa.int64()), ("bundle", pa.int64()), ("runs", pa.binary())])
_FLAGS = pa.schema([("bundle", pa.int64()), ("windows", pa.binary())])
_NONE = np.zeros(0, np.int64)


class _Dealt(NamedTuple):
    """The runs of a shard by target: where each has its first window, its owner and unit; and the different units."""

    target: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    unit: np.ndarray
    #: Of each unit its target, its windows, and the place of its bytes in ``body``, with one more at the end.
    unit_target: np.ndarray
    number: np.ndarray
    begin: np.ndarray
    body: bytes


def _dealt(
    texts: pa.Table,
    text_col: str,
    ids: np.ndarray,
    answers: list[tuple[int, pa.BinaryScalar]],
    base: int,
    length: int,
    gram: int,
    ranges: int,
    targets: int,
) -> _Dealt:
    """The runs of one shard at shared anchors by content shard, equal ones as one unit; ``base`` is added to places."""
    data, offsets = packed_text(texts.column(text_col))
    first, number, doc, key = runs_by_anchor(data, offsets, length, gram)
    by = np.argsort(key)
    kinds = key[by]
    new = np.concatenate([[True], kinds[1:] != kinds[:-1]])[: len(kinds)]
    kind = np.empty(len(key), np.int64)
    kind[by] = np.cumsum(new) - 1
    kinds = kinds[new]
    shared, heavy = np.zeros((2, len(kinds)), bool)
    for part, value in answers:
        i, j = np.searchsorted(kinds, [(part << _KEY_BITS) // ranges, ((part + 1) << _KEY_BITS) // ranges])
        both = np.unpackbits(np.frombuffer(value.as_buffer(), np.uint8)).astype(bool)
        shared[i:j], heavy[i:j] = both[: j - i], both[j - i : 2 * (j - i)]
    kept = shared[kind]
    first, number, doc, key, heavy = first[kept], number[kept], doc[kept], key[kept], heavy[kind[kept]]
    raw = data.tobytes()
    seen: dict[bytes, int] = {}
    ends = (first + number + (length - 1)).tolist()
    unit = np.array([seen.setdefault(raw[i:j], len(seen)) for i, j in zip(first.tolist(), ends, strict=True)], np.int64)
    strings = list(seen)
    target = (key % np.uint64(targets)).astype(np.int64)
    # Hot runs become single windows; those of equal runs are told apart once.
    hot = np.unique(unit[heavy])
    window: dict[bytes, int] = {}
    cut = [strings[u] for u in hot.tolist()]
    windows = np.array([window.setdefault(s[p : p + length], len(window)) for s in cut for p in range(len(s) - length + 1)], np.int64)
    begin = np.zeros(len(strings), np.int64)
    begin[hot] = np.cumsum([0, *(len(s) - length + 1 for s in cut)])[:-1]
    times = np.where(heavy, number, 1)
    place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    heavy = np.repeat(heavy, times)
    first = np.repeat(first, times) + place
    owner, unit, target = np.repeat(ids[doc], times), np.repeat(unit, times), np.repeat(target, times)
    at = windows[begin[unit[heavy]] + place[heavy]]
    target[heavy] = np.array([zlib.crc32(w) % targets for w in window], np.int64)[at]
    unit[heavy] = at + len(strings)
    strings += window
    order = np.lexsort((unit, target))
    first, unit, target, owner = first[order] + base, unit[order], target[order], owner[order]
    fresh = np.concatenate([[True], unit[1:] != unit[:-1]])[: len(unit)]
    units = [strings[u] for u in unit[fresh].tolist()]
    sizes = np.array([len(s) for s in units], np.int64)
    return _Dealt(
        target, first, owner, (np.cumsum(fresh) - 1).astype(np.int32),
        target[fresh], (sizes - (length - 1)).astype(np.int32), np.cumsum([0, *sizes]), b"".join(units),
    )


def _by_target(shards: list[_Dealt], bundle: int) -> list[tuple[int, int, bytes]]:
    """The runs of some shards of a bundle, one packed value for each target."""
    if not shards:
        return []
    wanted = np.unique(np.concatenate([x.unit_target for x in shards]))
    cuts = [
        (x, *(np.searchsorted(c, wanted, side).tolist() for c in (x.target, x.unit_target) for side in ("left", "right")))
        for x in shards
    ]
    compressor = zstandard.ZstdCompressor(_LEVEL)
    out = []
    for k, target in enumerate(wanted.tolist()):
        bodies, columns, units = [], [], 0
        for x, begins, ends, unit_begins, unit_ends in cuts:
            (i, j), (a, b) = (begins[k], ends[k]), (unit_begins[k], unit_ends[k])
            if j > i:
                bodies.append(x.body[x.begin[a] : x.begin[b]])
                columns.append((x.number[a:b], x.unit[i:j] + np.int32(units - a), x.first[i:j], x.owner[i:j]))
                units += b - a
        number, unit, first, owner = (np.concatenate(c) for c in zip(*columns, strict=True))
        if first.max() < 1 << 31:
            first = first.astype(np.int32)
        out.append((target, bundle, compressor.compress(pickle.dumps((b"".join(bodies), number, unit, first, owner), 5))))
    return out


def _flagged(bundles: list[int], values: pa.ChunkedArray, length: int, shard_bytes: int) -> list[tuple[int, bytes]]:
    """For one content shard: per value of a bundle, the first places of windows that start in a smaller document."""
    seen: dict[bytes, int] = {}
    number: list[int] = []
    place, owner, unit = [], [], []
    for value in values:
        body, sizes, local, first, owners = _unpacked(value.as_py())
        ends = np.cumsum(sizes + (length - 1))
        begins = (ends - sizes - (length - 1)).tolist()
        mine = np.array([seen.setdefault(body[a:b], len(seen)) for a, b in zip(begins, ends.tolist(), strict=True)])
        for u, size in zip(mine.tolist(), sizes.tolist(), strict=True):
            if u == len(number):
                number.append(size)
        place.append(first.astype(np.int64))
        owner.append(owners)
        unit.append(mine[local])
    data = np.frombuffer(b"".join(seen), np.uint8)
    sizes = np.array(number, np.int64)
    counts = [len(x) for x in place]
    place, owner, unit = (np.concatenate(x) for x in (place, owner, unit))
    low = np.full(len(sizes), _LAST)
    np.minimum.at(low, unit, owner)
    first = np.cumsum(sizes + (length - 1)) - sizes - (length - 1)
    window_of = np.cumsum(sizes) - sizes
    least = least_owner(data, first, sizes, low, length, shard_bytes)
    times = sizes[unit]
    row = np.repeat(np.arange(len(unit)), times)
    step = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    hit = least[window_of[unit[row]] + step] < owner[row]
    row, step = row[hit], step[hit]
    at = place[row] + step
    # Rows ascend, and so each value has a stretch of them.
    cuts = np.searchsorted(row, np.cumsum([0, *counts])).tolist()
    out = []
    for bundle, i, j in zip(bundles, cuts[:-1], cuts[1:], strict=True):
        if j > i:
            mine = np.sort(at[i:j])
            begin = np.flatnonzero(np.concatenate([[True], np.diff(mine) > 1]))
            size = np.diff(np.concatenate([begin, [len(mine)]]))
            first = mine[begin]
            out.append((bundle, _packed((first.astype(np.int32) if first[-1] < 1 << 31 else first, size.astype(np.int32)))))
    return out


def _cleaned(
    texts: pa.Table, data: np.ndarray, offsets: np.ndarray, first: np.ndarray, size: np.ndarray, length: int, as_text: bool
) -> pa.Table:
    n = len(data)
    change = np.zeros(n + 1, np.int64)
    # Runs of windows overlap, and so the strings that they cover are counted.
    np.add.at(change, first, 1)
    np.add.at(change, first + size + (length - 1), -1)
    gone = np.cumsum(change[:n]) > 0
    sizes = np.diff(offsets)
    total = np.concatenate([[0], np.cumsum(gone)])
    begins = gone & ~np.concatenate([[False], gone[:-1]])[:n]
    inner = offsets[:-1][sizes > 0]
    begins[inner] = gone[inner]
    spans = np.concatenate([[0], np.cumsum(begins)])
    removed = total[offsets[1:]] - total[offsets[:-1]]
    if as_text and gone.any():
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        gone = (np.bincount(character, gone) > 0)[character]
        total = np.concatenate([[0], np.cumsum(gone)])
    kept = data[~gone]
    new_offsets = offsets - total[offsets]
    kind = pa.large_string() if as_text else pa.large_binary()
    whole = pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(new_offsets.astype(np.int64)), pa.py_buffer(kept)])
    out = texts
    for name, value in (
        (N_BYTES, pa.array(sizes)),
        (N_REMOVED, pa.array(removed)),
        (N_SPANS, pa.array(spans[offsets[1:]] - spans[offsets[:-1]])),
        (KEPT, whole.cast(pa.string() if as_text else pa.binary())),
    ):
        out = out.append_column(name, value)
    return out
