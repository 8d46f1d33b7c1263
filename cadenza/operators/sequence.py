"""Ordered-sequence operators that don't put a whole sequence into one task.

``ordinal`` numbers the rows of each key from counts of (key, lane), where lanes cut the order into ranges (a
day of samples, say). With a number, windows of a few rows are taken within blocks of BLOCK rows that carry
their neighbours' edge rows with them, so that a key with a third of all rows is spread over many tasks.

Nulls: a null key is a key like others, a null in the order comes first, and rows with a null number are a
sequence of their own; no row is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.selection import broadcast_few, quantiles

BLOCK = 20_000


def same_key(df: DataFrame, other: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """``df`` with the other columns of ``other`` for the same key; nulls are equal."""
    other = other.select(*(F.col(k).alias(f"_k_{k}") for k in key), *(c for c in other.columns if c not in key))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    return df.join(other, on, how).drop(*(f"_k_{k}" for k in key))


def ordinal(df: DataFrame, key: list[str], order: list[str], lane: Column, name: str = "n") -> DataFrame:
    """A gapless number from 0 within each key, by ``order``; ``lane`` may not fall along that order."""
    df = df.withColumn("_lane", lane)
    counts = df.groupBy(*key, "_lane").agg(F.count("*").alias("_rows"))
    before = counts.withColumn("_before", F.sum("_rows").over(Window.partitionBy(*key).orderBy("_lane")) - F.col("_rows")).drop("_rows")
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key, "_lane").orderBy(*order)))
    return same_key(ranked, before, [*key, "_lane"]).withColumn(name, (F.col("_before") + F.col("_rank") - 1).cast("long")).drop("_lane", "_before", "_rank")


def windowed(df: DataFrame, key: list[str], n: str, before: int, after: int, columns: dict[str, object], block: int = BLOCK) -> DataFrame:
    """``columns``: name -> function of a window (ordered by ``n``) giving a column that looks at most ``before`` rows back and ``after`` ahead."""
    own = F.floor(F.col(n) / block)
    ends = F.array_distinct(F.array(own, F.floor((F.col(n) + before) / block), F.greatest(F.lit(0), F.floor((F.col(n) - after) / block))))
    ends = F.when(own.isNull(), F.array(own)).otherwise(ends)
    spread = df.withColumn("_own", own).withColumn("_block", F.explode(ends))
    w = Window.partitionBy(*key, "_block").orderBy(n)
    for name, make in columns.items():
        spread = spread.withColumn(name, make(w))
    return spread.where("_block <=> _own").drop("_block", "_own")


def smooth(df: DataFrame, key: list[str], n: str, columns: list[str], window: int, suffix: str = "_smooth") -> DataFrame:
    """Centred rolling means of ``window`` rows with what is there at the ends; columns that don't exist are left out; a window of 1 copies."""
    present = [c for c in columns if c in df.columns]
    if window <= 1:
        return df.withColumns({c + suffix: F.col(c) for c in present})
    back, ahead = window // 2, (window - 1) // 2
    return windowed(df, key, n, back, ahead, {c + suffix: (lambda w, c=c: F.avg(c).over(w.rowsBetween(-back, ahead))) for c in present})


def change(df: DataFrame, key: list[str], n: str, columns: dict[str, str]) -> DataFrame:
    """new name -> column: the difference to the row before, 0 for the first and where there is none (null or NaN)."""
    return windowed(df, key, n, 1, 0, {new: (lambda w, c=c: difference(c, w)) for new, c in columns.items()})


def difference(column: str, w: Window) -> Column:
    return F.coalesce(F.nanvl((F.col(column) - F.lag(column).over(w)).cast("double"), F.lit(0.0)), F.lit(0.0))


def shift_rate(df: DataFrame, key: list[str], n: str, x: str, y: str, name: str) -> DataFrame:
    """The distance that the point (x, y) moved since the row before."""
    moved = change(df, key, n, {"_dx": x, "_dy": y})
    return moved.withColumn(name, F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"))).drop("_dx", "_dy")


def quantile(df: DataFrame, key: list[str], column: str, q: float, name: str = "q") -> DataFrame:
    """key, name: the exact quantile (linear interpolation) of each key, by radix selection. Null and NaN values are left out."""
    return quantiles(df, key, column, {name: q})


def over_quantile(df: DataFrame, key: list[str], flags: dict[str, str], q: float = 0.75) -> DataFrame:
    """flag name -> column: whether the value is strictly over its key's quantile; NaN never is.

    All columns' quantiles come from one selection over their values. The rows are read twice, for the quantiles and for the
    flags; whoever finds them dear to make writes them first.
    """
    each = F.array(*(F.struct(F.lit(f).alias("_flag"), F.col(c).cast("double").alias("_value")) for f, c in flags.items()))
    values = df.select(*key, F.explode(each).alias("_s")).select(*key, "_s.*")
    rows = quantiles(values, [*key, "_flag"], "_value", {"_q": q})
    found = broadcast_few(rows.groupBy(*key).agg(*(F.max(F.when(F.col("_flag") == f, F.col("_q"))).alias(f"_q_{f}") for f in flags)))
    return same_key(df, found, key, "left").withColumns({f: (F.col(c) > F.col(f"_q_{f}")) & ~F.isnan(F.col(c).cast("double")) for f, c in flags.items()}).drop(*(f"_q_{f}" for f in flags))


def run_dedup(words: DataFrame, key: list[str], n: str, column: str) -> DataFrame:
    """The rows whose word differs from the row before; ``n`` numbers the rows that have a word."""
    return windowed(words, key, n, 1, 0, {"_last": lambda w: F.lag(column).over(w)}).where(F.col("_last").isNull() | (F.col("_last") != F.col(column))).drop("_last")
