"""The text stage on streams: lines are normalized and scanned as they come; windowed counts tolerate late ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.normalize import normalize


def read(spark: SparkSession, folder: str, schema: str, form: str = "parquet", files: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(form).load(folder)


def normalized(stream: DataFrame, text_col: str = "raw_text") -> DataFrame:
    """Stateless: the same projection as on a table."""
    return normalize(stream, text_col)


def scanned(stream: DataFrame, text_col: str = "normalized_text") -> DataFrame:
    """(all columns, piece): tokens without spans, which need no state and no shuffle."""
    return stream.withColumn("piece", F.explode(X.find_all(F.col(text_col), X.SCANNER))).where(~F.col("piece").rlike(r"^\s"))


def kind_counts(stream: DataFrame, time_col: str, text_col: str = "normalized_text", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window, kind, n) of tokens by event time; state older than the watermark is dropped."""
    rows = scanned(stream.withWatermark(time_col, late), text_col)
    return rows.groupBy(F.window(time_col, window).alias("window"), X.token_kind(F.col("piece")).alias("kind")).agg(F.count("*").alias("n"))
