"""Points enough to draw a series as it is, whatever its length (M4 aggregation, Jugel et al., 2014). Nothing is drawn here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.sequence import same_key


def plot_points(rows: DataFrame, key: list[str], x: str, y: str, columns: int) -> DataFrame:
    """key, x, y: of each column of pixels the first, last, lowest and highest point, four at most; a line through them covers the same pixels.

    The columns part the range of each key's x into equal widths. Ties are settled by the other coordinate. Rows with a null or NaN
    coordinate are left out. Two aggregations, of which the first gives a row a key.
    """
    if columns < 1:
        raise ValueError("at least one column of pixels")
    point = rows.select(*key, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("x is not null and y is not null and not isnan(x) and not isnan(y)")
    ends = point.groupBy(*key).agg(F.min("x").alias("_from"), F.max("x").alias("_to"))
    share = F.when(F.col("_to") > F.col("_from"), (F.col("x") - F.col("_from")) / (F.col("_to") - F.col("_from"))).otherwise(0.0)
    placed = same_key(point, ends, key).withColumn("_column", F.least(F.lit(columns - 1), F.floor(share * columns).cast("int")))
    by_x, by_y = F.struct("x", "y"), F.struct("y", "x")
    four = placed.groupBy(*key, "_column").agg(F.min(by_x).alias("a"), F.max(by_x).alias("b"), F.min(by_y).alias("c"), F.max(by_y).alias("d"))
    points = F.array_distinct(F.array(*(F.struct(F.col(f"{p}.x").alias("x"), F.col(f"{p}.y").alias("y")) for p in "abcd")))
    return four.select(*key, F.col("_column").alias("pixel"), F.explode(points).alias("_p")).select(*key, "pixel", "_p.x", "_p.y")
