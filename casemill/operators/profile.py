"""Column selection, data quality, distinct counts and exact medians."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

KINDS = {
    "number": (T.NumericType,),
    "category": (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType),
}

_BINS = 1 << 12  # per interval and pass of a median


def columns_of(df: DataFrame, kind: str, but: Sequence[str] = ()) -> list[str]:
    """The names of the columns of a kind (``KINDS``), in order, without those in ``but``."""
    types = dict(zip(df.columns, (field.dataType for field in df.schema.fields), strict=True))
    for name in but:
        types.pop(name, None)
    return [name for name, held in types.items() if isinstance(held, KINDS[kind])]


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, non_null) for every column, in one pass."""
    wide = df.agg(*(F.count(F.col(f"`{c}`")).alias(c) for c in columns))
    return wide.unpivot([], list(columns), "column_name", "non_null")


def with_values(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the columns that hold a value anywhere, in the given order; one pass for all."""
    if not columns:
        return []
    seen = F.array(*(F.bool_or(F.col(f"`{c}`").isNotNull()) for c in columns))
    return [name for name, found in zip(columns, df.agg(seen).first()[0], strict=True) if found]


def quality(
    df: DataFrame, columns: Sequence[str], key: Column | None = None, bad: Column | None = None
) -> DataFrame:
    """Null rate per column, duplicate rate of a key and rate of bad rows, as rows.

    The distinct count behind the duplicate rate is exact and distributed:
    copies of a key merge map-side before the shuffle. The rate is null where no key is.
    """
    rates = {f"null_rate_{c}": F.avg(F.col(f"`{c}`").isNull().cast("double")) for c in columns}
    if key is not None:
        rates["duplicate_key_rate"] = 1 - F.try_divide(F.count_distinct(key), F.count(key))
    if bad is not None:
        rates["bad_record_rate"] = F.avg(F.coalesce(bad, F.lit(False)).cast("double"))
    wide = df.agg(*(rate.alias(name) for name, rate in rates.items()))
    return wide.unpivot([], list(rates), "measure", "rate")


def distinct(df: DataFrame, column: str, *, approximate: bool = False) -> DataFrame:
    """How many different values a column holds."""
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(count.alias("distinct_values"))


#: Buckets of a sketch, as a power of two, and the relative error that estimates keep to
#: with a probability above 0.99: three times 1.04 / sqrt(2 ** 12).
SKETCH_SIZE = 12
SKETCH_ERROR = 0.05


def sketches(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """A sketch of the distinct values of each column, per value of ``keys``; a few kilobytes each."""
    made = df.groupBy(*keys).agg(*(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_SIZE)).alias(c) for c in columns))
    return made.unpivot(list(keys), list(columns), "column_name", "sketch")


def distinct_estimates(sketched: DataFrame) -> DataFrame:
    """(column_name, estimate) from the sketches of any number of batches, united."""
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketched.groupBy("column_name").agg(united.alias("estimate"))


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of all columns without gathering values in one place.

    Each pass counts the rows of the open intervals by ordered bins, which merge map-side,
    and narrows an interval to the extent of the bin that holds a middle rank, until that
    extent is a single value. All columns share the passes, and of each interval only the
    bins of the middle ranks reach the driver. The first bins follow the logarithm, so that
    the spread of the values does not matter; about five passes settle what doubles can tell
    apart, two or three do for 100,000 rows. The input is read once per pass: store it first
    if it is costly. Nulls and NaN are ignored.
    """
    numbers = df.select(*(F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)))
    numbers = numbers.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) for c in numbers.columns))
    spans = [Span(i) for i in range(len(columns))]
    found: list[set[tuple[int, float]]] = [set() for _ in columns]
    while spans:
        spans = _narrowed(numbers, spans, found)
    # Halved before they are added, as the sum of two values may be beyond a double.
    middles = [sorted(held) for held in found]
    return {c: sum(v / len(m) for _, v in m) if m else None for c, m in zip(columns, middles, strict=True)}


@dataclass(frozen=True)
class Span:
    """Values of one column that may be its median: all, or those between two with as many below them."""

    column: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    ranks: tuple[int, ...] = ()

    def bins(self, value: Column) -> Column:
        """Ordered bins: a 64th of the distance from zero wide at first, then all of one width."""
        if self.low is None:
            return F.signum(value) * F.floor(F.log1p(F.abs(value)) * 64)
        by = 1.0 if math.isfinite(self.high - self.low) else 0.5  # the width itself may be beyond a double
        width = F.lit(self.high * by) - F.lit(self.low * by)
        return F.floor((value * by - F.lit(self.low * by)) / width * _BINS)

    def holds(self, value: Column) -> Column:
        return value.isNotNull() if self.low is None else value.between(self.low, self.high)

    def wanted(self) -> Column:
        """The middle ranks, counted within the span."""
        if self.low is None:
            return F.array_distinct(F.array(F.expr("(total - 1) div 2"), F.expr("total div 2")))
        return F.array(*(F.lit(rank - self.below).cast("long") for rank in self.ranks))


def _narrowed(numbers: DataFrame, spans: list[Span], found: list[set[tuple[int, float]]]) -> list[Span]:
    """The spans of the next pass; ranks whose value is known go to ``found``, by column."""
    places = []
    for number, span in enumerate(spans):
        value = F.col(f"c{span.column}")
        place = F.struct(F.lit(number).alias("span"), span.bins(value).cast("double").alias("bin"), value.alias("v"))
        places.append(F.when(span.holds(value), place))
    counted = (
        numbers.select(F.inline(F.array_compact(F.array(*places))))
        .groupBy("span", "bin")
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    whole = Window.partitionBy("span")
    until = F.col("before") + F.col("n")
    held = (
        counted.withColumns({"before": F.sum("n").over(whole.orderBy("bin")) - F.col("n"), "total": F.sum("n").over(whole)})
        .withColumn("wanted", F.get(F.array(*(span.wanted() for span in spans)), F.col("span")))
        .withColumn("ranks", F.filter("wanted", lambda r: (r >= F.col("before")) & (r < until)))
        .where(F.size("ranks") > 0)
    )
    after = []
    for row in held.collect():
        span = spans[row["span"]]
        ranks = tuple(span.below + r for r in row["ranks"])
        if row["low"] == row["high"]:
            found[span.column] |= {(r, row["low"]) for r in ranks}
        else:
            after.append(Span(span.column, row["low"], row["high"], span.below + row["before"], ranks))
    return after


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by the column's exact median."""
    found = {c: m for c, m in exact_medians(df, columns).items() if m is not None}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in found.items()})
