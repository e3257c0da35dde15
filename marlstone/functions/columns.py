"""Small column expressions used by several operators. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_NUMBER_BITS = 28
EPOCH = "1970-01-01 00:00:00"
SMALL_TABLE_ROWS = 100_000


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def key_number(value: str | Column) -> Column:
    """A number in [0, 2**28) that depends only on the value's text.

    It is the first seven hex digits of the MD5 digest, so any engine can repeat it.
    """
    digest = F.md5(as_column(value).cast("string"))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint")


def micros(value: str | Column) -> Column:
    """Microseconds of a wall time since the start of 1970 as a bigint, in any session zone."""
    since = as_column(value).cast("timestamp_ntz") - F.lit(EPOCH).cast("timestamp_ntz")
    part = lambda field: F.extract(F.lit(field), since)
    minutes = (part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes.cast("bigint") * 60_000_000 + (part("SECOND") * 1_000_000).cast("bigint")


def from_micros(value: str | Column) -> Column:
    """The wall time of ``micros``."""
    zero = F.lit(0)
    seconds = (as_column(value).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def whole_vector(value: str | Column) -> Column:
    """True where an array of numbers is there and holds no null or NaN."""
    value = as_column(value)
    return F.coalesce(value.isNotNull() & ~F.exists(value, lambda x: x.isNull() | F.isnan(x.cast("double"))), F.lit(False))


def present(value: str | Column) -> Column:
    """True where the number is neither null nor NaN."""
    value = as_column(value)
    return value.isNotNull() & ~F.isnan(value)


def nan_as_null(value: str | Column) -> Column:
    value = as_column(value).cast("double")
    return F.when(~F.isnan(value), value)


def divide(numerator: Column, denominator: Column, empty: Column | None = None) -> Column:
    """Quotient as a double; ``empty`` (default null) where the denominator is zero."""
    quotient = F.when(denominator != 0, numerator.cast("double") / denominator)
    return quotient if empty is None else F.coalesce(quotient, empty)


def words(text: str | Column) -> Column:
    """Lower-case runs of letters of any script, in reading order."""
    parts = F.split(F.lower(as_column(text)), "[^\\p{L}]+")
    return F.filter(parts, lambda word: word != "")


def ngrams(text: str | Column, n: int) -> Column:
    """Runs of ``n`` words, joined by a blank."""
    if n < 1:
        raise ValueError("n must be at least 1")
    if n == 1:
        return words(text)

    def runs(tokens):
        starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - F.lit(n - 1)))
        return F.transform(starts, lambda start: F.array_join(F.slice(tokens, start, F.lit(n)), " "))

    # Going through a one-element array binds the words once; named directly inside the inner
    # function, the text would be split again for every run.
    found = F.transform(F.array(words(text)), lambda tokens: F.coalesce(runs(tokens), F.array().cast("array<string>")))
    return F.flatten(found)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; each key appears once, from the left.

    No hint is given: adaptive execution broadcasts the small side when it has seen its size
    and splits skewed partitions otherwise.
    """
    renamed = right.select([F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(
        lambda a, b: a & b, [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def join_small(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a fitted table to rows, null equal to null.

    The table is kept and counted first. Up to ``SMALL_TABLE_ROWS`` rows it goes to every task, so the rows stay
    where they are and popular keys do no harm; a larger one is shuffled, and adaptive execution splits
    skewed partitions.
    """
    kept = table.persist()
    return join_on(df, F.broadcast(kept) if kept.count() <= SMALL_TABLE_ROWS else kept, keys, how)


def rounded(df: DataFrame, places: int = 6, only: Iterable[str] | None = None, **other: int) -> DataFrame:
    """Round the double columns, or the ones named; ``other`` gives columns places of their own."""
    names = set(only) if only is not None else {name for name, kind in df.dtypes if kind in ("double", "float")}
    wanted = {**dict.fromkeys(names, places), **other}
    return df.select(
        [F.round(F.col(c).cast("double"), wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )
