"""The text stage as one lazy plan, and line-wise orchestration with assistants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import assist, review
from ..operators.normalize import normalize
from ..operators.tokenize import with_tokens


def run(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines (keys, raw_text) with everything of the text stage, tokens as an array (empty for empty lines); nothing is shuffled."""
    return with_tokens(normalize(lines))


def orchestrate(lines: DataFrame, keys: list[str], client: assist.Client, valid_fdi: list[str] | None = None) -> DataFrame:
    """Normalize, tokenize, let the client propose edits, validate, apply what is valid, and check digits.

    Adds answer, errors, valid, edited and digit_mismatch; lines whose edits fail keep their text.
    """
    empty = F.array().cast(review.OPS)
    asked = assist.refine(review.marked_view(run(lines, keys)), client)
    told = asked.withColumn("ops", F.coalesce(F.col("answer.ops"), empty)).withColumn("_fdi", F.flatten(F.transform(F.coalesce(F.col("answer.tooth_groups"), F.array().cast("array<struct<label_he:string,label_en:string,fdi:array<string>>>")), lambda g: g["fdi"])))
    checked = review.validate(told.withColumn("_terms", F.col("answer.canonical_terms")), terms_col="_terms", fdi_col="_fdi", valid_fdi=F.array(*map(F.lit, valid_fdi or [])).cast("array<string>"))
    done = review.apply_ops(checked.withColumn("ops", F.when(F.col("valid"), F.col("ops")).otherwise(empty)))
    return review.digit_check(done, "normalized_text", "edited").drop("_fdi", "_terms")
