"""A text classifier: averaged embeddings of hashed subwords under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from cardtide.llm.common import HIDDEN, packed_text, pieces, releasing
from cardtide.llm.suffix import words_at

LABEL, SCORE, ACCEPTED, POSTERIOR, TOKENS = (f"{HIDDEN}{x}" for x in ("label", "score", "accepted", "posterior", "tokens"))

#: What a text without letters, or without text, is said to be.
UNDETERMINED = "und"

_ORDERS = (2, 3, 4)


@dataclass(frozen=True)
class Subwords:
    """Labels in order, embeddings (bucket x width), softmax weights, bias, temperature, and the least accepted score."""

    labels: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def posteriors(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Class probabilities (texts x labels); a text too short for subwords gets those of the bias alone."""
        n = len(offsets) - 1
        # The mean goes through the weights: with few labels it is cheaper to look up each bucket's logits.
        look = self.embeddings
        if len(self.labels) <= look.shape[1]:
            look = (look @ self.weights).astype(np.float32)
        total, count = np.zeros((n, look.shape[1])), np.zeros(n)
        for order, bucket in buckets(data, len(self.embeddings)):
            begins, ends = offsets[:-1], np.maximum(offsets[1:] - order + 1, offsets[:-1])
            some = np.flatnonzero(ends > begins)
            if not len(some):
                continue
            edges = np.stack([begins[some], ends[some]], 1).ravel()
            for c in range(look.shape[1]):
                values = np.concatenate([look[:, c][bucket], [0]])
                total[some, c] += np.add.reduceat(values, edges, dtype=np.float64)[::2]
            count[some] += (ends - begins)[some]
        mean = total / np.maximum(count, 1)[:, None]
        logits = mean if look.shape[1] == len(self.labels) and look is not self.embeddings else mean @ self.weights
        return _softmax((logits + self.bias) / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    out = np.exp(logits - logits.max(-1, keepdims=True))
    return out / out.sum(-1, keepdims=True)


def buckets(data: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each subword length the bucket of the subword at every byte, with A-Z as a-z and all white space alike."""
    plain = _PLAIN[data]
    words = words_at(plain)[: len(plain)]
    for order in _ORDERS:
        key = words & np.uint64((1 << (8 * order)) - 1)
        key *= np.uint64(0x9E3779B97F4A7C15)
        yield order, (key >> np.uint64(40)).astype(np.int64) % count


_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[9, 10, 11, 12, 13]] = 32


def fitted(
    rows: DataFrame,
    text: str,
    label: str,
    order: Column,
    per_label: int = 1000,
    max_entries: int = 3 << 22,
    count: int = 1 << 16,
    width: int = 16,
    epochs: int = 4,
    precision: float = 0.99,
    max_labels: int = 1000,
) -> Subwords:
    """A classifier learned from a bounded sample of the labelled rows.

    Labels are those of all rows with a label and a text, however long; more than ``max_labels`` are an error. The
    bound: of each label about ``per_label`` rows, fewer where their texts are long, so that all of them together have
    about ``max_entries`` different subwords at most, counted text by text; and one row of each label at least. Rows
    are chosen by a hash of ``order`` and the text (the same rows on every run), so null and repeated ids choose
    nothing, and a row that is there many times counts as one. Texts are taken whole: executors reduce them to counts
    of subwords, at most ``count`` of each, and the driver gets those.

    Four fifths are learned from by stochastic gradient descent; on the others the temperature is fitted by
    likelihood, and the least score above which the accepted are right with ``precision``. Null labels and null texts
    are left out; without any label everything is UNDETERMINED.
    """
    place = F.xxhash64(order, F.col(text), F.lit("sample"))
    usable = rows.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("string").alias("label"), place.alias("place")
    )
    entries = F.least(F.octet_length("text").cast("long") * len(_ORDERS), F.lit(count)) + 1
    found = usable.groupBy("label").agg(F.count(F.lit(1)), F.sum(entries), F.min("place")).limit(max_labels + 1).collect()
    if len(found) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    if not found:
        return Subwords([UNDETERMINED], np.zeros((1, 1)), np.zeros((1, 1)), np.zeros(1), 1.0, 1.0)
    each = max_entries / len(found)
    shares = F.create_map(*[F.lit(x) for name, n, size, _ in found for x in (name, min(1.0, per_label / n, each / size))])
    least = F.create_map(*[F.lit(x) for name, _, _, first in found for x in (name, first)])
    unit = F.pmod("place", F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = usable.where((unit < shares[F.col("label")]) | (F.col("place") == least[F.col("label")])).dropDuplicates(["label", "place"])

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = packed_text(batch.column("text"))
            held = [bag(data[i:j], count) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            kinds, times = (pa.array([x[i] for x in held], pa.list_(pa.int32())) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("place"), kinds, times], ["label", "place", "kinds", "times"])

    sample = chosen.mapInArrow(releasing(bags), "label string, place long, kinds array<int>, times array<int>").toArrow()
    sample = sample.sort_by([("place", "ascending"), ("label", "ascending")]).combine_chunks()
    return train(sample, sorted(r[0] for r in found), count, width, epochs, precision)


def bag(data: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's subwords and how often each occurs."""
    total = np.zeros(0, np.int32)
    for at in range(0, max(len(data), 1), 1 << 22):
        # Subwords that begin in this stretch.
        piece = data[at : at + (1 << 22) + max(_ORDERS)]
        parts = [bucket[: max(0, min(len(piece) - order + 1, 1 << 22))] for order, bucket in buckets(piece, count)]
        here = np.bincount(np.concatenate(parts), minlength=count)
        total = here if not len(total) else total + here
    kinds = np.flatnonzero(total)
    return kinds.astype(np.int32), np.minimum(total[kinds], (1 << 31) - 1).astype(np.int32)


def train(sample: pa.Table, labels: list[str], count: int, width: int, epochs: int, precision: float) -> Subwords:
    """Stochastic gradient descent over the rows (label, place, kinds, times) of ``sample``, one text a step."""
    rng = np.random.default_rng(7)
    wanted = np.searchsorted(labels, sample.column("label").to_pylist())
    check = np.abs(sample.column("place").to_numpy()) % 5 == 4
    # A label whose few rows would all be kept back is learned from them.
    check &= np.isin(wanted, wanted[~check])
    bags = []
    for chunk in zip(sample.column("kinds").chunks, sample.column("times").chunks, strict=True):
        edges = chunk[0].offsets.to_numpy()
        kinds, times = (x.values.to_numpy() for x in chunk)
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            bags.append((kinds[i:j], (times[i:j] / max(times[i:j].sum(), 1)).astype(np.float32)))
    embeddings = rng.uniform(-1 / width, 1 / width, (count, width)).astype(np.float32)
    weights, bias = np.zeros((width, len(labels))), np.zeros(len(labels))
    learn = np.flatnonzero(~check)
    steps, done = max(1, epochs * len(learn)), 0
    for _ in range(epochs):
        for i in rng.permutation(learn):
            bucket, share = bags[i]
            rate = 0.5 * (1 - done / steps)
            done += 1
            if not len(bucket):
                continue
            hidden = share @ embeddings[bucket]
            error = _softmax(hidden @ weights + bias)
            error[wanted[i]] -= 1
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            bias -= rate * 0.1 * error
            # The mean's gradient is spread over the subwords of the text; scaled up, since each gets little of it.
            embeddings[bucket] -= (rate * 20 * share)[:, None] * back.astype(np.float32)
    model = Subwords(labels, embeddings, weights, bias, 1.0, 0.0)
    held = np.flatnonzero(check)
    if not len(held):
        return model
    logits = np.stack([(bags[i][1].astype(np.float64) @ embeddings[bags[i][0]]) @ weights + bias for i in held])
    true = wanted[held]
    grid = np.geomspace(0.25, 8, 41)
    losses = [-np.log(_softmax(logits / t)[np.arange(len(held)), true] + 1e-300).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    chance = _softmax(logits / temperature)
    best, right = chance.max(1), chance.argmax(1) == true
    by = np.argsort(-best)
    fine = np.flatnonzero(np.cumsum(right[by]) / np.arange(1, len(by) + 1) >= precision)
    threshold = float(best[by][fine[-1]]) if len(fine) else 1.0
    return Subwords(labels, embeddings, weights, bias, temperature, threshold)


def classified(docs: DataFrame, model: Subwords, text_col: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """All rows and columns of ``docs`` with LABEL, SCORE, ACCEPTED, POSTERIOR and TOKENS.

    The label is the likeliest one and the score its calibrated probability; it is accepted from the model's threshold
    on. A text that is null or has no letter is UNDETERMINED with score 0, not accepted, and with equal posteriors.
    Texts are read whole; TOKENS counts their runs without ASCII white space. An empty table stays empty.
    """
    schema = StructType(
        [
            *docs.schema.fields,
            StructField(LABEL, StringType()),
            StructField(SCORE, DoubleType()),
            StructField(ACCEPTED, BooleanType()),
            StructField(POSTERIOR, ArrayType(DoubleType(), False)),
            StructField(TOKENS, LongType()),
        ]
    )
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col, batch_bytes):
            column = batch.column(at)
            data, offsets = packed_text(column)
            chance = model.posteriors(data, offsets)
            lettered = np.array([any(map(str.isalpha, t.as_py() or "")) for t in column], bool)
            chance[~lettered] = 1 / len(model.labels)
            best = chance.argmax(1)
            score = np.where(lettered, chance[np.arange(len(best)), best], 0.0)
            labels = [model.labels[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(labels, pa.string()),
                    pa.array(score),
                    pa.array(lettered & (score >= model.threshold)),
                    pa.FixedSizeListArray.from_arrays(pa.array(chance.ravel()), chance.shape[1]).cast(pa.list_(pa.float64())),
                    pa.array(word_counts(data, offsets)),
                ],
                schema.names,
            )

    return docs.mapInArrow(releasing(run), schema)


def word_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of runs without ASCII white space of each text."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~space
    begins[1:] &= space[:-1]
    inner = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[inner] = ~space[inner]
    total = np.concatenate([[0], np.cumsum(begins)])
    return total[offsets[1:]] - total[offsets[:-1]]
