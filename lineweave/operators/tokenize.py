"""Tokens with exact spans: one alternation scans the text, lengths add up to spans, white space is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


_PARTS = r"(\d+)\s*([/\\-])\s*(\d+)"
FIELDS = ["idx", "text", "kind", "script", "s", "e", "a", "b", "sep"]


def tokens(lines: DataFrame, keys: list[str], text_col: str = "normalized_text") -> DataFrame:
    """(keys, idx, text, kind, script, s, e, a, b, sep) of each token, without a shuffle: a line's spans are summed inside its own row."""
    placed = lines.select(*keys, F.posexplode_outer(X.pieces(F.col(text_col))).alias("idx", "t")).where("idx is not null").select(*keys, "idx", "t.*")
    t = F.col("text")
    part = lambda i: F.when(F.col("kind") == "pair", F.regexp_extract(t, _PARTS, i))
    out = placed.withColumns({"kind": X.token_kind(t), "script": X.token_script(t)})
    return out.select(*keys, "idx", "text", "kind", "script", "s", "e", part(1).alias("a"), part(3).alias("b"), part(2).alias("sep"))


def with_tokens(lines: DataFrame, text_col: str = "normalized_text") -> DataFrame:
    """Lines with `tokens`, an array in order (empty without any); nothing is joined back."""

    def whole(t, i):
        part = lambda k: F.when(X.token_kind(t["text"]) == "pair", F.regexp_extract(t["text"], _PARTS, k))
        return F.struct(i.alias("idx"), t["text"].alias("text"), X.token_kind(t["text"]).alias("kind"), X.token_script(t["text"]).alias("script"), t["s"].alias("s"), t["e"].alias("e"), part(1).alias("a"), part(3).alias("b"), part(2).alias("sep"))

    return lines.withColumn("tokens", F.transform(X.pieces(F.col(text_col)), whole))


def token_arrays(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, tokens): token rows gathered to an array a line."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*FIELDS))).alias("tokens"))


def of_kind(rows: DataFrame, *kinds: str) -> DataFrame:
    return rows.where(F.col("kind").isin(*kinds))


def neighbours(rows: DataFrame, keys: list[str], reach: int = 2) -> DataFrame:
    """Adds `context`: texts of tokens at most `reach` places away, in order, without the token itself."""
    w = Window.partitionBy(*keys).orderBy("idx").rangeBetween(-reach, reach)
    near = F.collect_list(F.struct("idx", "text")).over(w)
    return rows.withColumn("context", F.transform(F.filter(near, lambda n: n["idx"] != F.col("idx")), lambda n: n["text"]))
