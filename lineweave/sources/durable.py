"""Tables between stages: written to the folder that all machines share, so that no plan is computed twice and lost executors cost little."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder of our own, but only if all of Spark runs on this machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='lineweave-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _session(spark: SparkSession, conf: dict[str, str]) -> SparkSession:
    """A session of our own with the same settings and these."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    for k, v in conf.items():
        own.conf.set(k, v)
    return own


def measured(spark: SparkSession) -> SparkSession:
    """A session of our own with the same settings, in which AQE alone picks tables to broadcast, by the size it measures.

    Plans know only the size of files. Columns that compress well hold many times that in rows, which a driver has no room for.
    """
    limit = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) or spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return _session(spark, {"spark.sql.adaptive.autoBroadcastJoinThreshold": limit, "spark.sql.autoBroadcastJoinThreshold": "-1"})


def sparing(spark: SparkSession) -> SparkSession:
    """A session of our own with the same settings, in which shuffles go from the disk when what needs them has ended, and rows dealt by some keys of a
    join stay where they are."""
    return _session(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.requireAllClusterKeysForCoPartition": "false"})


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table."""
    path = f"{shared_folder(df.sparkSession)}/lineweave/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliced(df: DataFrame, keys: list[str], n: int, name: str) -> list[DataFrame]:
    """The same rows in n tables, rows of equal keys in one."""
    path = f"{shared_folder(df.sparkSession)}/lineweave/{name}-{uuid.uuid4().hex}"
    df.withColumn("_slice", F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")).write.partitionBy("_slice").option("compression", "zstd").parquet(path)
    whole = df.sparkSession.read.schema(T.StructType([*df.schema, T.StructField("_slice", T.IntegerType())])).parquet(path)
    return [whole.where(F.col("_slice") == k).drop("_slice") for k in range(n)]


def numbered(df: DataFrame, *order: str, name: str = "seq") -> DataFrame:
    """Adds the place of each row, from 0, in an order. Ranges are sorted apart; only their sizes, a row a range, reach the driver."""
    placed = stored(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "ordered")
    part, at = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes, before = {}, 0
    for r in sorted(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):
        sizes[r["part"]] = before
        before += r["n"]
    start = F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair))[part] if sizes else F.lit(0)
    return placed.withColumn(name, (start + at).cast("long")).drop("_id")
