"""Column functions over names, words and numbers as text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space at both ends (tabs and line ends too)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def without_extension(c: Column) -> Column:
    return F.regexp_replace(c, r"\.[^.]*$", "")


def snap(seconds: Column, interval: float = 0.2) -> Column:
    """The nearest multiple of the interval, halves to even."""
    return F.rint(seconds / F.lit(interval)) * F.lit(interval)


def whole_seconds(text: Column) -> Column:
    """A duration text cut to whole seconds; 0 for what is no number."""
    return F.coalesce(text.try_cast("double").cast("int"), F.lit(0))


def fixed(places: int):
    """Numbers as text with so many decimals, halves to even on the binary value; for sinks that need exact bytes."""

    @F.pandas_udf("string")
    def text(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if pd.isna(v) else f"{v:.{places}f}")

    return text
