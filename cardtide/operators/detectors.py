"""Behavioural detectors for the three fraud patterns. None of them looks at the labels.

Every detector returns the flagged transactions, one row each, with all their columns. Rows are never paired
with each other, and no card is ever gathered in one task: what decides about a row is first reduced to a
summary of fixed size per card and time slice, by steps that combine map-side, and the rows then
meet that summary in a spread join. Every card takes that way, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardtide.functions.money import money_sum
from cardtide.operators.asof import as_of
from cardtide.operators.skew import join_spread
from cardtide.sources.dated import landed

_CENTS = 100
_SPREAD = ("transaction_id", "event_time")


def _seconds(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} SECONDS")


# -- high amount -------------------------------------------------------------------------------


def category_norms(transactions: DataFrame, min_amount: float = 5.0) -> DataFrame:
    """What is usual per category: number, sum, least and greatest of the amounts above ``min_amount``.

    Small charges stay out because probing bursts would pull the mean of their category down.
    """
    return category_norms_by(transactions, min_amount)


def category_norms_by(transactions: DataFrame, min_amount: float, *keys: Column) -> DataFrame:
    """The same for each category and ``keys``."""
    amount = F.col("amount")
    usual = transactions.where((amount > min_amount) & (amount < float("inf")))
    return usual.groupBy("category", *keys).agg(
        F.count(F.lit(1)).alias("n"),
        money_sum("amount", _CENTS).alias("sum_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )


def save_norms(norms: DataFrame, path: str) -> DataFrame:
    """Write the norms as a new table and return its scan; a table that is there is an error, as a stream may read it.

    A scan has a known size. The planner then broadcasts the norms while they are below its
    threshold, and otherwise shuffles and splits hot categories; nobody has to promise it anything.
    """
    norms.write.parquet(path)
    return norms.sparkSession.read.schema(norms.schema).parquet(path)


def high_amounts(transactions: DataFrame, norms: DataFrame, factor: float = 2.0) -> DataFrame:
    """Transactions above ``factor`` times the mean of their category.

    Works on a batch and, with norms from history, on a stream. Rows are flagged by ``amount x n > factor x sum`` in exact
    decimal arithmetic, so amounts finer than cents are judged as they are. Nearly all rows are far enough from
    their limit for a comparison of doubles to be certain; only the others pay for decimals.
    """
    met = transactions.join(amount_limits(norms, factor), "category")
    return met.where(above_limit()).select(*transactions.columns)


def amount_limits(norms: DataFrame, factor: float, *keys: str) -> DataFrame:
    """Per category what ``above_limit`` compares amounts with."""
    rough = F.col("sum_amount") / F.col("n") * F.lit(float(factor))
    slack = F.abs(rough) * 1e-9
    cents = F.rint(F.col("sum_amount") * _CENTS).try_cast("decimal(28,0)")
    return norms.select(
        "category",
        *keys,
        (rough - slack).alias("_low"),
        (rough + slack).alias("_high"),
        F.col("n").cast("decimal(18,0)").alias("_n"),
        (cents * F.lit(Decimal(str(factor)))).alias("_scaled"),
    )


def above_limit() -> Column:
    """Whether the amount of a row that met its limit is above it."""
    amount, low, high = F.col("amount"), F.col("_low"), F.col("_high")
    exact = (amount * F.lit(float(_CENTS))).try_cast("decimal(20,6)") * F.col("_n") > F.col("_scaled")
    # Without an exact form the limit itself is no more than a double.
    return F.when(amount > high, True).when(amount < low, False).otherwise(F.coalesce(exact, amount > (low + high) / 2))


def norm_versions(transactions: DataFrame, min_amount: float = 5.0) -> DataFrame:
    """Norms as they were known: per category and day the number and sum of the amounts of all days before, from ``valid_from`` on.

    Days are added up once each; the running sums go over days, not rows.
    """
    days = category_norms_by(transactions.where(F.col("event_time").isNotNull()), min_amount, F.to_date("event_time").alias("day"))
    upto = Window.partitionBy("category").orderBy("day")
    kind = transactions.schema["event_time"].dataType
    return days.select(
        "category",
        F.date_add("day", 1).cast(kind).alias("valid_from"),
        F.sum("n").over(upto).alias("n"),
        F.sum("sum_amount").over(upto).alias("sum_amount"),
    )


def high_amounts_in_force(transactions: DataFrame, versions: DataFrame, factor: float = 2.0) -> DataFrame:
    """Transactions above ``factor`` times the mean that was in force for their category at their time.

    Rows before the first version of their category are never flagged: nothing was known then.
    """
    limits = amount_limits(versions, factor, "valid_from")
    met = as_of(transactions, limits, ["category"])
    return met.where(F.col("valid_from").isNotNull() & above_limit()).select(*transactions.columns)


def amount_factors(transactions: DataFrame, norms: DataFrame) -> DataFrame:
    """All transactions with ``factor``: their amount in means of their category; null without a norm or an amount."""
    means = norms.select("category", (F.col("sum_amount") / F.col("n")).alias("_mean"))
    return transactions.join(means, "category", "left").withColumn("factor", F.col("amount") / F.col("_mean")).drop("_mean")


# -- card testing ------------------------------------------------------------------------------


def card_testing(
    transactions: DataFrame, *, max_amount: float = 5.0, min_count: int = 3, within_seconds: int = 60
) -> DataFrame:
    """Small charges that are at least the ``min_count``-th on their card within the trailing interval.

    Time is cut into slices as long as the interval. From the ``min_count``-th row of a slice on, all
    are flagged; only the few before it have to look back, and they only ever need the last few of
    the slice before. So each card and slice is first reduced to its earliest and latest
    ``min_count`` instants (a ranked limit, applied before the shuffle too).
    """
    placed = small_charges(transactions, max_amount).where(
        F.col("card_id").isNotNull() & F.col("event_time").isNotNull()
    )
    sliced, verdicts = testing_verdicts(placed, min_count, within_seconds)
    return (
        join_spread(sliced, verdicts, ["card_id", "_slice"], _SPREAD).where(tested()).select(*transactions.columns)
    )


def tested() -> Column:
    """Whether a row that met its verdict is flagged."""
    instant = F.col("event_time")
    return (instant >= F.col("_all_from")) | F.array_contains("_single", instant)


def _reaching(rows: DataFrame, key: list[str], min_count: int, seconds: int) -> DataFrame:
    """Rows with at least ``min_count - 1`` others of their key in the interval up to their instant."""
    in_order = Window.partitionBy(*key).orderBy("event_time")
    reached = F.lag("event_time", min_count - 1).over(in_order) >= F.col("event_time") - _seconds(seconds)
    # Rows of one instant share a verdict: that of the last of them.
    shared = F.max("_reached").over(Window.partitionBy(*key, "event_time"))
    return rows.withColumn("_reached", reached).withColumn("_shared", shared).where(F.col("_shared"))


def testing_verdicts(rows: DataFrame, min_count: int, seconds: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their slice, and per card and slice what decides about its rows."""
    instant = F.col("event_time")
    sliced = rows.withColumn("_slice", F.window("event_time", f"{int(seconds)} seconds")["start"])
    # Each instant counts among the first of its own slice, and among the last for the next one.
    never = F.lit(None).cast(sliced.schema["event_time"].dataType)
    own = F.struct("_slice", instant.alias("early"), never.alias("late"))
    past = F.struct((F.col("_slice") + _seconds(seconds)).alias("_slice"), never.alias("early"), instant.alias("late"))
    return sliced, _verdicts(sliced.select("card_id", F.inline(F.array(own, past))), min_count, seconds)


def _verdicts(points: DataFrame, min_count: int, seconds: int) -> DataFrame:
    """Verdicts per card and slice from its instants (``early``) and those of the slice before (``late``)."""
    key = ["card_id", "_slice"]
    from_ends = Window.partitionBy(*key, F.col("early").isNull()).orderBy("early", F.desc("late"))
    edges = (
        points.withColumn("rank", F.row_number().over(from_ends))
        .where(F.col("rank") <= min_count)
        .select(*key, F.coalesce("early", "late").alias("event_time"), F.when(F.col("early").isNotNull(), F.col("rank")).alias("rank"))
    )
    instant = F.col("event_time")
    return (
        _reaching(edges, key, min_count, seconds)
        .where(F.col("rank").isNotNull())
        .groupBy(*key)
        .agg(
            F.min(F.when(F.col("rank") == min_count, instant)).alias("_all_from"),
            # At most min_count - 1 instants.
            F.collect_set(F.when(F.col("rank") < min_count, instant)).alias("_single"),
        )
    )


#: (card, begin of the slice, first and last instants in it), all instants in microseconds.
_EDGES = "card_id string, slice_at long, firsts array<long>, lasts array<long>"


def probe_edges(
    charges: DataFrame, *, min_count: int = 3, within_seconds: int = 60, copies: int = 8, buckets: int = 256
) -> DataFrame:
    """A stream of the first and last ``min_count`` instants of small charges per card and slice, given out when the slice has closed.

    This is all that ``card_testing`` needs to know of a slice, so no row is ever held: the state of a card and slice
    is ``copies`` times twice ``min_count`` numbers at most, whatever happens on the card. A hot card is spread over
    ``copies`` parts, which are put together by ``card_testing_from``. ``charges`` are small charges with a
    watermark.

    A call of Python costs as much as thousands of rows, so cards are dealt into ``buckets`` by hash, and one call
    brings a slice of a bucket up to date for all cards at once: there are at most ``buckets`` calls per slice and
    batch, however many cards there are.
    """
    n, micros = int(min_count), int(within_seconds) * 1_000_000

    def ends(rows):
        rows = rows.sort_values(["card_id", "at"])
        of_card = rows.groupby("card_id", sort=False)
        return rows[(of_card.cumcount() < n) | (of_card.cumcount(ascending=False) < n)]

    def kept(key, frames, state):
        import pandas as pd

        begin = int(key[0])
        cards, instants = state.get if state.exists else ([], [])
        held = pd.DataFrame({"card_id": pd.Series(cards, dtype=object), "at": pd.Series(instants, dtype="int64")})
        if state.hasTimedOut:
            state.remove()
            instants_of = held.groupby("card_id", sort=False)["at"].agg(list)
            yield pd.DataFrame(
                {
                    "card_id": instants_of.index,
                    "slice_at": begin,
                    "firsts": [at[:n] for at in instants_of],
                    "lasts": [at[-n:] for at in instants_of],
                }
            )
            return
        # Many rows at a time are put in order, so that no more is held and each is sorted a few times at most.
        parts, fresh = [held], 0
        for frame in frames:
            parts, fresh = [*parts, frame[["card_id", "at"]]], fresh + len(frame)
            if fresh > len(parts[0]) + 100_000:
                parts, fresh = [ends(pd.concat(parts))], 0
        held = ends(pd.concat(parts))
        state.update((held["card_id"].tolist(), held["at"].tolist()))
        state.setTimeoutTimestamp((begin + micros) // 1000)

    at = F.unix_micros("event_time")
    slice_at = F.unix_micros(F.window("event_time", f"{int(within_seconds)} seconds")["start"])
    copy = F.pmod(F.xxhash64(*_SPREAD), F.lit(copies))
    bucket = F.pmod(F.xxhash64("card_id", copy), F.lit(buckets)).cast("int")
    known = charges.where(F.col("card_id").isNotNull())
    keyed = known.select(slice_at.alias("slice_at"), bucket.alias("bucket"), "card_id", at.alias("at"), "event_time")
    grouped = keyed.groupBy("slice_at", "bucket")
    return grouped.applyInPandasWithState(kept, _EDGES, "cards array<string>, instants array<long>", "append", "EventTimeTimeout")


def card_testing_from(
    transactions: DataFrame, edges: DataFrame, *, max_amount: float = 5.0, min_count: int = 3, within_seconds: int = 60
) -> DataFrame:
    """``card_testing`` of stored transactions by the ``edges`` a stream has given out: the flagged rows of closed slices.

    ``edges`` have the parameters of this call. Slices they do not hold, as they are still open, have no flagged rows
    yet. Transactions of other times than the edges' may be left out.
    """
    kind = transactions.schema["event_time"].dataType

    def points(field: str, shift: int, early: bool) -> DataFrame:
        instant, never = F.timestamp_micros("at").cast(kind), F.lit(None).cast(kind)
        slices = edges.select("card_id", (F.col("slice_at") + shift).alias("slice_at"), F.explode(field).alias("at"))
        ends = (instant, never) if early else (never, instant)
        return slices.select(
            "card_id", F.timestamp_micros("slice_at").cast(kind).alias("_slice"), ends[0].alias("early"), ends[1].alias("late")
        )

    both = points("firsts", 0, True).unionAll(points("lasts", int(within_seconds) * 1_000_000, False))
    verdicts = _verdicts(both, min_count, within_seconds)
    placed = small_charges(transactions, max_amount).where(F.col("card_id").isNotNull() & F.col("event_time").isNotNull())
    sliced = placed.withColumn("_slice", F.window("event_time", f"{int(within_seconds)} seconds")["start"])
    return join_spread(sliced, verdicts, ["card_id", "_slice"], _SPREAD).where(tested()).select(*transactions.columns)


def small_charges(transactions: DataFrame, max_amount: float = 5.0) -> DataFrame:
    return transactions.where(F.col("amount") <= max_amount)


def probe_sessions(charges: DataFrame, *, min_count: int = 3, gap_seconds: int = 60) -> DataFrame:
    """Streaming companion of ``card_testing``: sessions of small charges with no gap beyond the limit.

    Not the same result: it gives sessions, not transactions, and each only when it has closed.
    ``charges`` are the small charges alone, with the watermark set after they were picked out.
    """
    session = F.session_window("event_time", f"{int(gap_seconds)} seconds")
    return (
        charges.groupBy("card_id", session.alias("session"))
        .agg(F.count(F.lit(1)).alias("n_charges"), F.max("amount").alias("max_amount"))
        .where(F.col("n_charges") >= min_count)
        .select(
            "card_id",
            F.col("session.start").alias("session_start"),
            F.col("session.end").alias("session_end"),
            "n_charges",
            "max_amount",
        )
    )


# -- impossible travel -------------------------------------------------------------------------


def impossible_travel(
    transactions: DataFrame, *, within_seconds: int = 600, copies: int | None = None
) -> DataFrame:
    """Transactions preceded, on the same card and within the interval, by one in a different city.

    ``copies`` is the number of sub-keys over which the rows of one card, slice and city (on a stream, of one card and
    slice) are spread in a join (by default 4, and 16 on a stream). In batch adaptive execution splits a sub-key that
    is still too large; on a stream nothing does, so choose it by the share of rows the busiest card has there.

    A stream needs a watermark on ``event_time``; there, a flagged row comes out when the time slice it is in has
    closed, and rows are held until then. What it holds at once therefore depends on how far one micro-batch reaches
    ahead: limit the batches of a backlog, and read it in the order of time.
    """
    seconds = int(within_seconds)
    complete = transactions.where(F.col("card_id").isNotNull() & F.col("city").isNotNull())
    if transactions.isStreaming:
        found = _streamed_travel(complete, seconds, 16 if copies is None else copies)
    else:
        timed = complete.where(F.col("event_time").isNotNull())
        found = _meet(*_batch_bounds(timed, seconds), seconds, 4 if copies is None else copies)
    return found.select(*transactions.columns)


def _meet(rows: DataFrame, bounds: DataFrame, seconds: int, copies: int) -> DataFrame:
    """Rows flagged by the bounds of their card, slice and city."""
    verdicts = _travel_verdicts(bounds, seconds)
    return join_spread(rows, verdicts, ["card_id", "span", "city"], _SPREAD, copies).where(_travelled())


def _travel_verdicts(bounds: DataFrame, seconds: int) -> DataFrame:
    """Per card, slice and city with a flagged row: the instants that ``_travelled`` compares with.

    Time is cut into slices as long as the interval. A row is flagged if its slice has an earlier
    row in another city, or the slice before has one recent enough. So it is enough to know the first
    other city in the slice (rows after it are flagged) and the last other city in the slice before
    (rows up to one interval after it are flagged).
    """
    return (
        bounds.withColumn("_until", F.col("_until") + _seconds(seconds))
        .where((F.col("last_own") > F.col("_after")) | (F.col("first_own") <= F.col("_until")))
        .select("card_id", "span", "city", "_after", "_until")
    )


def _travelled() -> Column:
    instant = F.col("event_time")
    return (instant > F.col("_after")) | (instant <= F.col("_until"))


def _batch_bounds(transactions: DataFrame, seconds: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their slice, and per card, slice and city the bounds set by the other cities."""
    rows = transactions.withColumn("span", F.window("event_time", f"{seconds} seconds")["start"])
    visits = rows.groupBy("card_id", "span", "city").agg(
        F.min("event_time").alias("first_own"), F.max("event_time").alias("last_own")
    )
    # Each visit counts in its own slice, and as the past of the next one.
    never = F.lit(None).cast(visits.schema["last_own"].dataType)
    own = F.struct("span", "first_own", "last_own", never.alias("last_before"))
    past = F.struct(
        (F.col("span") + _seconds(seconds)).alias("span"),
        never.alias("first_own"),
        never.alias("last_own"),
        F.col("last_own").alias("last_before"),
    )
    both = visits.select("card_id", "city", F.inline(F.array(own, past)))
    # One partition here is the cities of one card in two slices.
    slice_ = Window.partitionBy("card_id", "span")
    city = F.col("city")

    def when_present(field: str, value: Column) -> Column:
        return F.when(F.col(field).isNotNull(), value)

    nearest = both.withColumns(
        {
            "first": F.min(when_present("first_own", F.struct("first_own", "city"))).over(slice_),
            "last": F.max(when_present("last_before", F.struct("last_before", "city"))).over(slice_),
        }
    ).withColumns(
        {
            "second": F.min(F.when(city != F.col("first.city"), F.col("first_own"))).over(slice_),
            "second_last": F.max(F.when(city != F.col("last.city"), F.col("last_before"))).over(slice_),
        }
    )
    bounds = nearest.where(F.col("first_own").isNotNull()).select(
        "card_id",
        "span",
        "city",
        "first_own",
        "last_own",
        F.when(city != F.col("first.city"), F.col("first.first_own")).otherwise(F.col("second")).alias("_after"),
        F.when(city != F.col("last.city"), F.col("last.last_before")).otherwise(F.col("second_last")).alias("_until"),
    )
    return rows, bounds


def _streamed_travel(transactions: DataFrame, seconds: int, copies: int) -> DataFrame:
    """The same for a stream, where a watermark has to reach every step and no step may hold more than a few values per card and slice.

    A sliding window of two slices pairs each slice (its second half) with the one before. Per card and window the
    first row of the slice and the last of the slice before are the best of all cities. The best of all other cities
    cannot be found in the same pass, as it depends on which city that is; so rows of windows with several cities meet
    those first two, and what is left of them is reduced to the best once more. All four are values of fixed size,
    however many cities a card has.
    """
    instant, city = F.col("event_time"), F.col("city")
    key = ["card_id", "span"]
    span = F.window(instant, f"{2 * seconds} seconds", f"{seconds} seconds")
    placed = transactions.withColumn("span", span)
    own = instant >= F.col("span.start") + _seconds(seconds)
    at = F.struct(instant.alias("at"), city.alias("city"))
    tops = (
        placed.groupBy(*key)
        .agg(F.min(F.when(own, at)).alias("first"), F.max(F.when(~own, at)).alias("last"), F.min("city").alias("low"), F.max("city").alias("high"))
        .where((F.col("low") != F.col("high")) & F.col("first").isNotNull())
        .select(*key, "first", "last")
    )
    # A join may know one event time per side only, and that has to be the window.
    rows = placed.withColumn("event_time", instant + _seconds(0))
    seen = rows.select(*key, "event_time", "city", "transaction_id")
    bounds = (
        join_spread(seen, tops, key, _SPREAD, copies)
        .groupBy(*key)
        .agg(
            # The same in all rows of a group.
            F.max("first").alias("first"),
            F.max("last").alias("last"),
            F.min(F.when(own & (city != F.col("first.city")), instant)).alias("second"),
            F.max(F.when(~own & (city != F.col("last.city")), instant)).alias("second_last"),
        )
    )
    after = F.when(city != F.col("first.city"), F.col("first.at")).otherwise(F.col("second"))
    until = F.when(city != F.col("last.city"), F.col("last.at")).otherwise(F.col("second_last"))
    met = join_spread(rows.where(own), bounds, key, _SPREAD, copies)
    return met.where((instant > after) | (instant <= until + _seconds(seconds)))


# -- profiles and scoring ----------------------------------------------------------------------


def card_home_city(transactions: DataFrame) -> DataFrame:
    """The most frequent city of each card; ties go to the first by name. Rows without a card or city are left out."""
    counts = (
        transactions.where(F.col("card_id").isNotNull() & F.col("city").isNotNull())
        .groupBy("card_id", "city")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("card_id").agg(F.min(F.struct((-F.col("n")).alias("less"), "city")).alias("best"))
    return best.select("card_id", F.col("best.city").alias("home_city"), (-F.col("best.less")).alias("n"))


def card_home_city_of_many(transactions: DataFrame, buckets: int = 64) -> DataFrame:
    """``card_home_city`` where cities are free text: the same rows, without a count for each city that a card was ever seen in.

    A card's cities are dealt into ``buckets`` by hash, and a first pass counts those alone: a summary of fixed size
    that adds up. The cities of the fullest bucket are counted exactly; the best of them bounds the home city from
    below, and a bucket that holds fewer rows cannot have a better or an equal one. Only cities of the buckets that
    are left are counted too. So ties are kept exactly, and what is counted city by city is a small part of a card,
    unless it has no usual city at all. Three scans, of the card and the city.
    """
    known = transactions.where(F.col("card_id").isNotNull() & F.col("city").isNotNull())
    bucket = F.pmod(F.xxhash64("city"), F.lit(buckets)).cast("int")
    placed = known.select("card_id", "city", bucket.alias("_bucket"), *[c for c in _SPREAD if c in known.columns])
    sizes = landed(placed.groupBy("card_id", "_bucket").agg(F.count(F.lit(1)).alias("rows")), "city-buckets")
    fullest = sizes.groupBy("card_id").agg(F.max(F.struct("rows", "_bucket")).getField("_bucket").alias("_bucket"))

    def best(candidates: DataFrame) -> DataFrame:
        met = join_spread(placed, candidates, ["card_id", "_bucket"], _SPREAD)
        counts = met.groupBy("card_id", "city").agg(F.count(F.lit(1)).alias("n"))
        return counts.groupBy("card_id").agg(F.min(F.struct((-F.col("n")).alias("less"), "city")).alias("best"))

    first = landed(best(fullest).join(fullest.withColumnRenamed("_bucket", "_full"), "card_id"), "fullest-buckets")
    left = sizes.join(first, "card_id").where((F.col("rows") >= -F.col("best.less")) & (F.col("_bucket") != F.col("_full")))
    both = first.select("card_id", "best").unionAll(best(left.select("card_id", "_bucket")))
    found = both.groupBy("card_id").agg(F.min("best").alias("best"))
    return found.select("card_id", F.col("best.city").alias("home_city"), (-F.col("best.less")).alias("n"))


def detector_flags(
    transactions: DataFrame,
    norms: DataFrame,
    *,
    factor: float = 2.0,
    max_amount: float = 5.0,
    min_count: int = 3,
    testing_seconds: int = 60,
    travel_seconds: int = 600,
) -> DataFrame:
    """All transactions (batch) with one BOOLEAN column per fraud type: the verdicts of the three detectors.

    The rows are read once for themselves and once for each of the two summaries they meet, and never matched
    with flagged copies of themselves.
    """
    keyed = F.col("card_id").isNotNull() & F.col("event_time").isNotNull()
    placed = small_charges(transactions, max_amount).where(keyed)
    _, tests = testing_verdicts(placed, min_count, testing_seconds)
    _, bounds = _batch_bounds(transactions.where(keyed & F.col("city").isNotNull()), int(travel_seconds))
    # A window leaves out rows without an event time; they stay here, and meet no verdict.
    kind = transactions.schema["event_time"].dataType
    some = F.coalesce("event_time", F.lit("1970-01-01 00:00:00").cast(kind))
    rows = transactions.join(amount_limits(norms, factor), "category", "left")
    rows = rows.withColumn("_slice", F.window(some, f"{int(testing_seconds)} seconds")["start"])
    rows = rows.withColumn("span", F.window(some, f"{int(travel_seconds)} seconds")["start"])
    rows = join_spread(rows, tests, ["card_id", "_slice"], _SPREAD, how="left")
    rows = join_spread(rows, _travel_verdicts(bounds, int(travel_seconds)), ["card_id", "span", "city"], _SPREAD, how="left")
    flags = {
        "high_amount": above_limit(),
        "card_testing": (F.col("amount") <= max_amount) & tested(),
        "impossible_travel": _travelled(),
    }
    return rows.select(*transactions.columns, *[F.coalesce(f, F.lit(False)).alias(n) for n, f in flags.items()])


def detector_confusion(flagged: DataFrame, detectors: Sequence[str]) -> DataFrame:
    """Score detectors against the labels: one row for each of ``detectors``, in one pass over the rows.

    ``flagged`` are transactions with a BOOLEAN column per detector, named like the fraud type it looks for. ``tp`` …
    ``tn`` compare with that very ``fraud_type``, ``any_tp`` … ``any_tn`` with ``is_fraud``.
    """
    def cells(hit: Column, true: Column, prefix: str) -> list[Column]:
        return [
            F.count_if(hit & true).alias(f"{prefix}tp"),
            F.count_if(hit & ~true).alias(f"{prefix}fp"),
            F.count_if(~hit & true).alias(f"{prefix}fn"),
            F.count_if(~hit & ~true).alias(f"{prefix}tn"),
        ]

    rows = [
        F.struct(
            F.lit(name).alias("detector"),
            *cells(F.col(name), F.coalesce(F.col("fraud_type") == name, F.lit(False)), ""),
            *cells(F.col(name), F.coalesce("is_fraud", F.lit(False)), "any_"),
        )
        for name in detectors
    ]
    return flagged.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
