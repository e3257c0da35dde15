"""Features from an entity's own past, never from the same instant or later.

All of them work on points, one row per (key, time): rows that share both are combined first, in
the map tasks. How many rows the busiest key has is counted before the plan is chosen. Where no key
holds more than a fair partition of the rows, a plain window per key does the work with one shuffle. Otherwise
time is cut into slices and windows run per (key, slice), so that a busy key is spread over its slices, and slice
summaries are scanned in blocks of their own (``scans``), never a whole key at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.columns import from_micros, micros, nan_as_null
from marlstone.operators.scans import FAN, block_of, carry_last, carry_sum

SECOND = 1_000_000
DAY = 86_400 * SECOND
# Rows of one key, or of one (key, slice), that a single window may hold at most,
WINDOW_ROWS = 2_000_000
# and how many it may hold even where a partition's fair share of all rows is less.
FEW_ROWS = 1_000
# Rows that a sliding frame may span: Spark adds a sliding frame up anew for every row.
FRAME_ROWS = 1_000
# Rows that a task sums up and sorts, on average: tables with more of them than the shuffle partitions hold get more partitions.
TASK_ROWS = 1_000_000


def _timed(df: DataFrame, key: str, ts: str) -> DataFrame:
    return df.where(F.col(ts).isNotNull()).select(F.col(key).alias("k"), micros(ts).alias("t"))


def busiest(df: DataFrame, key: str, ts: str, width: int | None = None) -> int:
    """Rows of the busiest key, or of the busiest key within one slice of ``width`` microseconds.

    Counts are combined in the map tasks and one number comes back.
    """
    groups = ["k"] if width is None else ["k", block_of("t", width)]
    return _timed(df, key, ts).groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def _fair(df: DataFrame, rows: int, window_rows: int) -> int:
    """Rows that a window may hold: a partition's share of ``rows``, but not fewer than ``FEW_ROWS`` nor more than ``window_rows``."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(ceil(rows / partitions), FEW_ROWS), window_rows)


def _placed(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, which has ``rows`` rows, dealt out by key so that a task's rows, and the memory it takes, do not grow with the table.

    A count that is named is not made smaller at run time, where only the bytes of the shuffle would be looked at.
    """
    if rows <= TASK_ROWS:
        return df.repartition(*keys)
    return df.repartition(max(ceil(rows / TASK_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def _load(df: DataFrame, key: str, ts: str, width: int = DAY) -> tuple[int, int, int]:
    """All rows with a time, those of the busiest key, and those of the busiest key within one slice; one pass."""
    slices = _timed(df, key, ts).groupBy("k", block_of("t", width)).agg(F.count(F.lit(1)).alias("n"))
    keys = slices.groupBy("k").agg(F.sum("n").alias("n"), F.max("n").alias("slice"))
    found = keys.agg(F.sum("n"), F.max("n"), F.max("slice")).first()
    return tuple(n or 0 for n in found)


def _slice_width(df, key, ts, window_rows):
    """Microseconds per slice: a day, or the part of a day that keeps the busiest slice in bounds.

    The narrower width is counted again, as rows need not be spread evenly over the day.
    """
    width = DAY
    while width > SECOND:
        rows = busiest(df, key, ts, width)
        if rows <= window_rows:
            break
        width = max(width // ceil(rows / max(window_rows, 1)), SECOND)
    return width


def rolling(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    span_seconds: int,
    prefix: str = "past",
    frame_rows: int = FRAME_ROWS,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Count, sum, mean, minimum and maximum of the key's values in [time - span, time).

    One row per (key, time). Where spans hold at most ``frame_rows`` rows and no key more than a fair partition, they are a plain
    sliding frame; else they are put together from slices, of which a span has enough to keep each below that and ``window_rows``.
    """
    span = span_seconds * SECOND
    values = df.where(F.col(ts).isNotNull()).select(F.col(key), micros(ts).alias("t"), nan_as_null(value).alias("v"))

    def combined(rows):
        return rows.groupBy(key, "t").agg(
            F.count("v").alias("n"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")
        )

    every, most, rows = _load(df, key, ts, span)
    limit = _fair(df, every, window_rows)
    if rows <= frame_rows and most <= limit:
        # Placed by key, the rows are combined and run through the window without another shuffle.
        points = combined(_placed(values, every, key))
        frame = Window.partitionBy(key).orderBy("t").rangeBetween(-span, -1)
        sums = points.select(
            key,
            "t",
            F.coalesce(F.sum("n").over(frame), F.lit(0)).alias("n"),
            F.coalesce(F.sum("s").over(frame), F.lit(0.0)).alias("s"),
            F.min("lo").over(frame).alias("lo"),
            F.max("hi").over(frame).alias("hi"),
        )
    else:
        # The slices of a span must fill it exactly; powers of two times 24 divide whole seconds well.
        slices = 24
        while rows / slices > limit and span % (2 * slices) == 0:
            slices *= 2
        while span % slices:
            slices -= 1
        sums = _rolling_by_slices(combined(values), key, span, slices)
    return sums.select(
        key,
        from_micros("t").alias(ts),
        F.col("n").alias(f"{prefix}_count"),
        F.col("s").alias(f"{prefix}_sum"),
        F.when(F.col("n") > 0, F.col("s") / F.col("n")).alias(f"{prefix}_mean"),
        F.col("lo").alias(f"{prefix}_min"),
        F.col("hi").alias(f"{prefix}_max"),
    )


def _rolling_by_slices(points, key, span, slices):
    """The past of each point from three disjoint pieces, in time linear in the points.

    They are the point's own slice up to the point, the whole slices before it, and the end of the oldest
    slice. For the last piece each point also appears shifted by the span: it then lies in the slice
    of the points that still reach it. Nothing is subtracted, so sums keep their precision.
    """
    width = span // slices
    # As a struct the key is never null, so the windows, the summary and the join share their shuffles.
    points = points.withColumn("entity", F.struct(key))
    point = F.struct("n", "s", "lo", "hi").alias("point")
    cut = points.select("entity", "t", point, block_of("t", width).alias("slice"))
    local = _head_and_tail(cut, "t", span, width)
    if slices > 1:
        totals = [F.sum("point.n").alias("n"), F.sum("point.s").alias("s"), F.min("point.lo").alias("lo"), F.max("point.hi").alias("hi")]
        summary = cut.groupBy("entity", "slice").agg(*totals).select("entity", "slice", point)
        # The whole slices between are the past of a slice number, put together in the same way: the span of ``slices - 1`` numbers
        # is the head of its own stretch of numbers and the tail of the one before.
        between = slices - 1
        whole = _head_and_tail(summary, "slice", between, between).select("entity", "slice", _added("head", "tail").alias("mid"))
        local = local.join(whole, ["entity", "slice"])
        past = _added("head", "mid", "tail")
    else:
        past = _added("head", "tail")
    return local.select(f"entity.{key}", "t", past.alias("past")).select(key, "t", "past.*")


def _added(*parts: str):
    """Structs of sums put together; a missing one is empty."""

    def total(name, zero):
        return sum((F.coalesce(F.col(f"{p}.{name}"), F.lit(zero)) for p in parts[1:]), F.coalesce(F.col(f"{parts[0]}.{name}"), F.lit(zero)))

    return F.struct(
        total("n", 0).alias("n"),
        total("s", 0.0).alias("s"),
        F.least(*[F.col(f"{p}.lo") for p in parts]).alias("lo"),
        F.greatest(*[F.col(f"{p}.hi") for p in parts]).alias("hi"),
    )


def _head_and_tail(rows, at, span, width):
    """``rows`` (entity, ``at``, point) with ``head``, what lies before in the row's own stretch of ``width``, and ``tail``, what of the last
    ``span`` lies in the stretch that it begins in.

    For the tail each row also appears moved on by the span: it then lies in the stretch of the rows that it still reaches.
    """
    names = [c for c in rows.columns if c not in ("entity", "point")]
    nothing = F.lit(None).cast("struct<n:bigint,s:double,lo:double,hi:double>")
    sides = F.array(
        F.struct(*[F.col(c).alias(c) for c in names], F.col(at).alias("_at"), F.col("point").alias("now"), nothing.alias("old")),
        F.struct(*[F.col(c).alias(c) for c in names], (F.col(at) + F.lit(span)).alias("_at"), nothing.alias("now"), F.col("point").alias("old")),
    )
    both = rows.select("entity", F.explode(sides).alias("e")).select("entity", "e.*")
    both = both.withColumn("_stretch", block_of("_at", width))

    def measures(source, frame):
        return F.struct(
            F.sum(f"{source}.n").over(frame).alias("n"),
            F.sum(f"{source}.s").over(frame).alias("s"),
            F.min(f"{source}.lo").over(frame).alias("lo"),
            F.max(f"{source}.hi").over(frame).alias("hi"),
        )

    inside = Window.partitionBy("entity", "_stretch")
    head = inside.orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    tail = inside.orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, 0)
    found = both.select("*", measures("now", head).alias("head"), measures("old", tail).alias("tail"))
    return found.where(F.col("now").isNotNull()).select("entity", *names, "head", "tail")


def lags(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    steps: int = 1,
    tie: str | None = None,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Per (key, time): the value, and for each step the earlier value, the change and the seconds since.

    Where a key has several rows at one time, the one with the largest ``tie`` stands for them
    (without ``tie``, the largest value).
    """
    if steps < 1:
        raise ValueError("steps must be at least 1")
    chosen = F.max_by(value, tie) if tie else F.max(value)
    values = df.where(F.col(ts).isNotNull()).select(
        key, micros(ts).alias("t"), value, *([tie] if tie and tie != value else [])
    )
    point = F.struct("t", "v")

    def earlier(window):
        return [F.lag(point, step).over(window).alias(f"e{step}") for step in range(1, steps + 1)]

    whole = Window.partitionBy(key).orderBy("t")
    every, most, _ = _load(df, key, ts)
    limit = _fair(df, every, window_rows)
    if most <= limit:
        # Placed by key, the rows are combined and run through the window without another shuffle.
        placed = _placed(values, every, key).groupBy(key, "t").agg(chosen.alias("v")).select("*", *earlier(whole))
    else:
        points = values.groupBy(key, "t").agg(chosen.alias("v"))
        width = _slice_width(df, key, ts, limit)
        placed = _lags_by_slices(points, key, steps, earlier, [width, width * FAN, width * FAN * FAN])

    columns = [key, from_micros("t").alias(ts), F.col("v").alias(value)]
    for step in range(1, steps + 1):
        columns += [
            F.col(f"e{step}.v").alias(f"{value}_lag{step}"),
            (F.col("v") - F.col(f"e{step}.v")).alias(f"{value}_change{step}"),
            ((F.col("t") - F.col(f"e{step}.t")) / SECOND).alias(f"seconds_since{step}"),
        ]
    return placed.select(*columns)


def _lags_by_slices(points, key, steps, earlier, widths):
    """Points deep inside a slice find their lags there. The first points of a slice find them among the first and last points of the key's
    slices, which is all that they can reach; these are cut into wider slices in turn.
    """
    if not widths:
        return points.select("*", *earlier(Window.partitionBy(key).orderBy("t")))
    inside = Window.partitionBy(key, "slice")
    sliced = points.withColumn("slice", block_of("t", widths[0])).select(
        "*",
        *earlier(inside.orderBy("t")),
        F.row_number().over(inside.orderBy("t")).alias("from_start"),
        F.row_number().over(inside.orderBy(F.desc("t"))).alias("from_end"),
    )
    named = [c for c in sliced.columns if c not in ("slice", "from_start", "from_end")]
    deep = sliced.where(F.col("from_start") > steps).select(*named)
    border = sliced.where((F.col("from_start") <= steps) | (F.col("from_end") <= steps))
    border = border.select(*points.columns, (F.col("from_start") <= steps).alias(f"first_{len(widths)}"))
    found = _lags_by_slices(border, key, steps, earlier, widths[1:])
    return deep.unionByName(found.where(f"first_{len(widths)}").select(*named))


def sessions(df: DataFrame, key: str, ts: str, gap_seconds: int, value: str | None = None) -> DataFrame:
    """Runs of a key's events in which no pause is longer than the gap.

    Events of one stretch of the gap's length can never be further apart than the gap, so a stretch is
    summed up first, in the map tasks, and only stretches are put in order, in blocks of a key's stretches. Gives the session
    number from 1, its start, end, events, length in seconds and, with ``value``, the sum.
    """
    gap = gap_seconds * SECOND
    amount = nan_as_null(value) if value else F.lit(0.0)
    stretches = (
        df.where(F.col(ts).isNotNull())
        .select(key, micros(ts).alias("t"), amount.alias("v"))
        .withColumn("stretch", block_of("t", gap))
        .groupBy(key, "stretch")
        .agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
    )
    before = carry_last(stretches, [key], "stretch", "last", "before")
    starts = before.withColumn("starts", F.when(F.col("first") - F.col("before") <= gap, 0).otherwise(1))
    numbered = carry_sum(starts, [key], "stretch", "starts", "started").withColumn("session", F.col("started") + F.col("starts"))
    result = numbered.groupBy(key, "session").agg(
        F.min("first").alias("t0"), F.max("last").alias("t1"), F.sum("n").alias("events"), F.sum("v").alias("v")
    )
    columns = [
        F.col(key),
        F.col("session"),
        from_micros("t0").alias("session_start"),
        from_micros("t1").alias("session_end"),
        F.col("events"),
        ((F.col("t1") - F.col("t0")) / SECOND).alias("seconds"),
    ]
    return result.select(*columns, *([F.col("v").alias(f"{value}_sum")] if value else []))


def asof(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    payload: Sequence[str],
    tie: str | None = None,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Each left row with the newest right row of its key strictly before the left time, else nulls.

    Where several right rows share key and time, the largest ``tie`` wins (without ``tie``, the largest
    payload). Rows without key or time find nothing.
    """
    kept = F.struct(*payload)
    usable = right.where(F.col(right_ts).isNotNull() & F.col(key).isNotNull())
    facts = usable.select(
        F.col(key).alias("_key"),
        micros(right_ts).alias("t"),
        F.struct(micros(right_ts).alias("t"), (F.col(tie) if tie else kept).alias("tie"), kept.alias("row")).alias("fact"),
    )
    loads = [_load(left, key, left_ts), _load(right, key, right_ts)]
    limit = _fair(left, sum(rows for rows, _, _ in loads), window_rows)
    if sum(most for _, most, _ in loads) <= limit:
        # One window over both sides, placed by key; the left rows travel through it whole.
        asks = left.select(F.col(key).alias("_key"), micros(left_ts).alias("t"), F.struct(*left.columns).alias("row"))
        both = asks.unionByName(facts, allowMissingColumns=True)
        past = Window.partitionBy("_key").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
        newest = F.max_by("fact", F.struct("fact.t", "fact.tie")).over(past)
        answered = both.select("_key", "t", "row", F.when(F.col("t").isNotNull(), newest).alias("found"))
        answered = answered.where("row is not null").select("row.*", "found")
    else:
        # The match is found once per distinct (key, time) and joined to the left rows afterwards.
        found = _asof_by_slices(left, right, facts, key, left_ts, right_ts, limit)
        answers = found.select(
            F.col("_key").alias(key), from_micros("t").cast(dict(left.dtypes)[left_ts]).alias(left_ts), "found"
        )
        answered = left.join(answers, [key, left_ts], "left").select(*left.columns, "found")
    return answered.select(
        *left.columns,
        from_micros("found.t").alias(f"asof_{right_ts}"),
        *[F.col(f"found.row.{c}").alias(f"asof_{c}") for c in payload],
    )


def _asof_by_slices(left, right, facts, key, left_ts, right_ts, window_rows):
    times = (
        left.where(F.col(left_ts).isNotNull() & F.col(key).isNotNull())
        .select(F.col(key).alias("_key"), micros(left_ts).alias("t"))
        .distinct()
        .select("_key", "t", F.lit(True).alias("asks"))
    )
    points = facts.groupBy("_key", "t").agg(F.max_by("fact", "fact.tie").alias("fact"))
    width = min(_slice_width(left, key, left_ts, window_rows), _slice_width(right, key, right_ts, window_rows))
    cut = times.unionByName(points, allowMissingColumns=True).withColumn("slice", block_of("t", width))
    newer = (Window.unboundedPreceding, -1)
    nearest = F.last("fact", ignorenulls=True)
    inside = Window.partitionBy("_key", "slice").orderBy("t").rangeBetween(*newer)
    local = cut.withColumn("near", nearest.over(inside)).where("asks")
    last = cut.groupBy("_key", "slice").agg(F.max_by("fact", "fact.t").alias("fact"))
    carried = carry_last(last, ["_key"], "slice", "fact", "far").drop("fact")
    return local.join(carried, ["_key", "slice"]).select("_key", "t", F.coalesce("near", "far").alias("found"))


def entity_aggregate(df: DataFrame, key: str, ts: str, value: str, as_of: str) -> DataFrame:
    """Recency, frequency, money and spread per entity, from rows strictly before a date.

    One conditional aggregate: entities without earlier rows keep a row, with zero counts.
    """
    limit = F.lit(as_of).cast("timestamp_ntz")
    past = F.col(ts) < limit
    amount = F.when(past, nan_as_null(value))
    recent = (F.col(ts) >= F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL '365' DAY")) & past
    return df.groupBy(key).agg(
        F.count(F.when(past, 1)).alias("n"),
        F.count(F.when(recent, 1)).alias("n_last_year"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("total"),
        F.avg(amount).alias("mean"),
        F.min(amount).alias("smallest"),
        F.max(amount).alias("largest"),
        F.stddev_samp(amount).alias("spread"),
        F.datediff(F.lit(as_of).cast("date"), F.max(F.when(past, F.col(ts)))).alias("days_since_last"),
    )


def calendar(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Add year, quarter, month, day, ISO day of week (Monday is 1), ISO week and hour."""
    at = F.col(ts)
    return df.select(
        "*",
        F.year(at).alias(f"{prefix}year"),
        F.quarter(at).alias(f"{prefix}quarter"),
        F.month(at).alias(f"{prefix}month"),
        F.dayofmonth(at).alias(f"{prefix}day"),
        (F.weekday(at) + 1).alias(f"{prefix}isodow"),
        F.weekofyear(at).alias(f"{prefix}isoweek"),
        F.hour(at).alias(f"{prefix}hour"),
    )
