"""Normalization of lines: composition, pairs, spacing, units, numbers, dates, times, in this order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: What a pattern counts as white space.
_WHITE = " \t\n\x0b\f\r"


def normalize(lines: DataFrame, text_col: str = "raw_text", compose: bool = True) -> DataFrame:
    """Adds normalized_text, numbers, pairs, units_found, dates, times and notes.

    Only texts with characters that may compose pay for the Arrow transfer that composition needs; compose=False asserts that texts are
    composed, and the whole stage is then projections, a column a step, so that no step is computed twice. Null and empty texts give
    empty results.
    """
    raw = F.coalesce(F.col(text_col), F.lit(""))
    df = lines.withColumn("_t0", X.nfc(raw) if compose else raw)
    df = X.unit_steps(X.spaced_steps(df, "_t0", "_t1", "notes"), "_t1", "_t2", "units_found")
    t = F.col("_t2")
    df = df.withColumn("_pairs", X.find_all(F.col("_t0"), rf"({X.PAIR})"))
    df = df.withColumns({"pairs": X.pair_structs(t, F.col("_pairs")), "numbers": X.find_all(t, r"(\d+)"), "dates": X.dates(t), "times": X.times(t), "normalized_text": F.rtrim(t, F.lit(_WHITE))})
    return df.drop("_t0", "_t1", "_t2", "_pairs")


def only(df: DataFrame, condition: str, *columns: str) -> DataFrame:
    """The columns of rows that meet a condition on them. The condition stays behind the row, so that costly columns are not computed for it once more."""
    return df.select(F.explode_outer(F.array(F.struct(*columns))).alias("_r")).select("_r.*").where(condition)
