"""Document rates that bring the expected tokens of soft domains to target totals."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cardtide.llm.common import HIDDEN, releasing
from cardtide.llm.subwords import POSTERIOR, TOKENS

RATE, COPIES = f"{HIDDEN}rate", f"{HIDDEN}copies"

#: Targets count as out of reach when the residual, once past its height, has not fallen by a hundredth from so many passes to as many after.
_PATIENCE = 10
#: A guard against rounding that neither settles nor stalls; what is left then is told like any residual.
_PASSES = 500

#: A step: what each domain's excess costs a rate, and how far the next step leaps ahead. None starts without a leap again.
_Step = tuple[np.ndarray, float] | None


def _replayed(chance: np.ndarray, history: list[_Step], least: float) -> tuple[np.ndarray, np.ndarray]:
    """The rates after the steps so far, and the point ahead of them at which the next gradient is taken.

    Each step is a function of the rate before and of a few numbers, so rates are never stored.
    """
    rate = np.full(len(chance), max(1.0, least))
    ahead = rate
    for step in history:
        if step is None:
            ahead = rate
            continue
        cost, leap = step
        after = np.maximum(ahead - chance @ cost, least)
        ahead = after + leap * (after - rate)
        rate = after
    return rate, ahead


def _arrays(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    tokens = batch.column(TOKENS).fill_null(0).to_numpy(zero_copy_only=False).astype(float)
    return batch.column(POSTERIOR).flatten().to_numpy(zero_copy_only=False).reshape(-1, k), tokens


def targets_for(shares: np.ndarray, weights: Mapping[str, float] | None, labels: list[str], power: float) -> np.ndarray:
    """Target shares of the domains: the given weights, or the present shares to a power, which evens them out."""
    wanted = np.array([weights.get(label, 0.0) for label in labels]) if weights is not None else shares**power
    if not (wanted >= 0).all() or wanted.sum() <= 0:
        raise ValueError("target weights must be at least 0, and some above it")
    return wanted / wanted.sum()


def _stalled(errors: list[float]) -> bool:
    falling = errors[int(np.argmax(errors)) :]
    return len(falling) >= 2 * _PATIENCE and min(falling[-_PATIENCE:]) >= 0.99 * min(falling[-2 * _PATIENCE : -_PATIENCE])


def mixed_rates(
    rows: DataFrame,
    labels: list[str],
    weights: Mapping[str, float] | None = None,
    power: float = 0.7,
    least: float = 0.0,
    tolerance: float = 1e-3,
    steps: int = _PASSES,
) -> DataFrame:
    """All rows and columns with RATE: how often a row is to be taken, ``least`` or more.

    ``rows`` carry POSTERIOR (one probability per label) and TOKENS, and are read once per pass: pass a written table.
    Rates are fitted by projected gradient descent on the squared misses of the domains' expected tokens (rate x
    tokens x posterior): from the rate 1, each step moves a rate against the misses of its domains, and no further
    down than ``least``. A domain's miss is weighed by the inverse of its diagonal element in the products of the
    posteriors, so rare domains move as fast as common ones, and each gradient is taken ahead of the rates by a
    growing leap, which starts again when the misses have grown. A pass adds up the domains' totals where the rows
    are; no rate is gathered or stored, as it follows from the steps so far, a few numbers each. It ends when all
    totals are within ``tolerance`` of their targets, when they come no nearer, or after ``steps``.

    RATE's metadata give what is left: ``residuals`` by label, relative to the target (to all tokens where that is 0),
    and ``reached``. Where that is false a warning says so.

    Targets are ``weights`` by label (0 for others), or the present shares to ``power``, of the present tokens. With a
    ``least`` of 1 or more, tokens can only grow: each domain gets a factor that would bring its share there, the
    smallest being ``least``, and the target totals are those of rows taken as often as the factors of their domains
    say, weighed by their posteriors; so they are within reach. Rows without tokens weigh nothing and keep a rate by
    their posteriors; without any tokens all rates are max(1, least).
    """
    k = len(labels)

    def sums(history: list[_Step]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Totals of the domains at the rates and ahead of them; and the products of the posteriors."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((2 + k, k))
            for batch in batches:
                chance, tokens = _arrays(batch, k)
                for i, rate in enumerate(_replayed(chance, history, least)):
                    out[i] += (rate * tokens) @ chance
                if not history:
                    out[2:] += (chance * tokens[:, None]).T @ chance
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size), pa.int32()), pa.array(out.ravel())], ["i", "x"])

        found = rows.select(POSTERIOR, TOKENS).mapInArrow(releasing(run), "i int, x double").groupBy("i").agg(F.sum("x").alias("x"))
        out = np.zeros((2 + k) * k)
        for i, x in found.collect():
            out[i] = x
        out = out.reshape(2 + k, k)
        return out[0], out[1], out[2:]

    now, ahead, gram = sums([])
    present = now / max(1.0, least)
    history: list[_Step] = []
    left, reached = dict.fromkeys(labels, 0.0), True
    if now.sum() > 0:
        share = targets_for(present / present.sum(), weights, labels, power)
        goal = present.sum() * share
        if least >= 1:
            factor = np.where(present > 0, share / np.maximum(present, 1e-300), np.inf)
            factor = np.where(share > 0, factor, 0.0)
            wanted = factor[(share > 0) & (present > 0)]
            factor = np.where(np.isinf(factor), least, np.maximum(factor * least / wanted.min(), least)) if len(wanted) else np.full(k, least)
            goal = gram @ factor
        scale = np.where(goal > 0, goal, present.sum())
        weight = 1 / np.maximum(np.diag(gram), 1e-300)
        root = np.sqrt(np.where(np.diag(gram) > 0, weight, 0.0))
        bound = np.abs(np.linalg.eigvalsh(root[:, None] * gram * root)).max()
        errors, best, miss, pace = [], (np.inf, now, 0), np.inf, 1.0
        while True:
            errors.append(float(np.abs((now - goal) / scale).max()))
            if errors[-1] < best[0]:
                best = errors[-1], now, len(history)
            if errors[-1] <= tolerance or len(errors) > steps or _stalled(errors):
                break
            before, miss = miss, float((root**2 * (now - goal) ** 2).sum())
            if miss > before:
                history.append(None)
                ahead, pace = now, 1.0
            faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            history.append((root**2 * (ahead - goal) / bound, (pace - 1) / faster))
            pace = faster
            now, ahead, _ = sums(history)
        _, now, n = best
        history = history[:n]
        left = dict(zip(labels, ((now - goal) / scale).tolist(), strict=True))
        worst = max(left, key=lambda label: abs(left[label]))
        reached = abs(left[worst]) <= tolerance
        if not reached:
            warnings.warn(f"mixing targets are not reached: {worst!r} is {left[worst]:+.4f} of its target away", stacklevel=2)
    schema = StructType([*rows.schema.fields, StructField(RATE, DoubleType(), metadata={"residuals": left, "reached": reached})])

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate, _ = _replayed(_arrays(batch, k)[0], history, least)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], schema.names)

    return rows.mapInArrow(releasing(rated), schema)


def repeated(rows: DataFrame, *seed: str) -> DataFrame:
    """``rows`` with COPIES, whose expectation is RATE: its whole part, and one more by hash of the ``seed`` columns."""
    unit = F.pmod(F.xxhash64(*seed, F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    whole = F.floor(RATE)
    return rows.withColumn(COPIES, (whole + (unit < F.col(RATE) - whole).cast("long")).cast("long"))
