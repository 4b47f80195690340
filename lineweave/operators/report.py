"""Reports: line statistics, gaps of a lexicon, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def line_stats(normalized: DataFrame, tokens: DataFrame) -> DataFrame:
    """One row: lines, tokens, tokens a line, pairs, numbers."""
    n0 = normalized.agg(F.count("*").alias("lines"), F.coalesce(F.sum(F.size("pairs")), F.lit(0)).alias("pairs"), F.coalesce(F.sum(F.size("numbers")), F.lit(0)).alias("numbers"))
    t1 = tokens.agg(F.count("*").alias("tokens"))
    return n0.crossJoin(t1).select("lines", "tokens", F.when(F.col("lines") > 0, F.round(F.col("tokens") / F.col("lines"), 6)).otherwise(F.lit(0.0)).alias("avg_tokens"), "pairs", "numbers")


def run_summary(normalized: DataFrame, tokens: DataFrame) -> DataFrame:
    """(nth, metric, value) rows of line_stats, as a run shows them at its end."""
    names = {"lines": "Lines Processed", "pairs": "Total Pairs Found", "numbers": "Total Numbers", "tokens": "Total Tokens"}
    shown = [F.struct(F.lit(n).alias("metric"), F.col(c).cast("string").alias("value")) for c, n in names.items()]
    shown.append(F.struct(F.lit("Avg Tokens/Line").alias("metric"), F.format_string("%.1f", "avg_tokens").alias("value")))
    return line_stats(normalized, tokens).select(F.posexplode(F.array(*shown)).alias("nth", "m")).select("nth", "m.*")


def lexicon_gap(entries: DataFrame, surfaces: DataFrame) -> DataFrame:
    """Entries whose label is no surface."""
    return entries.join(surfaces.select("surface"), F.lower(entries.label) == F.col("surface"), "left_anti")


def label_sample(entries: DataFrame, n: int = 5, seed: str = "sample") -> DataFrame:
    """n entries with labels of 4 to 25 characters, the same ones each time."""
    return entries.where(F.length("label").between(4, 25)).orderBy(F.md5(F.concat(F.lit(seed), "iri")), "iri").limit(n)
