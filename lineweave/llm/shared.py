"""Shared helpers of the training-data operators: durable tables and hashing in numpy."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spaces that separate words in every operator here: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, one of our own, but only if all of Spark runs here."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if spark.conf.get("spark.master", "local").split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='lineweave-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lineweave/{name}-{uuid.uuid4().hex}"


def publish(df: DataFrame, name: str, compression: str = "zstd", kind: str = "parquet") -> DataFrame:
    """Cuts the lineage: writes a table to the shared folder and reads it back, so that a lost executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.format(kind).option("compression", compression).save(path)
    return df.sparkSession.read.schema(df.schema).format(kind).load(path)


def publish_hashes(df: DataFrame, name: str) -> DataFrame:
    """publish() for arrays of hashes, which hardly shrink: ORC writes elements in a third of the time that Parquet takes."""
    return publish(df, name, "none", "orc")


def discard(df: DataFrame) -> None:
    """Deletes a published table that no later plan reads, and the shuffle files of the plans that made it."""
    spark = df.sparkSession
    paths = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    if any("/lineweave/" not in p for p in paths):
        raise ValueError("only published tables can be discarded")
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    free(spark)


def free(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that are done, as it does by itself when the driver's garbage is collected, which may take long."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowest_hashes(wanted: int, of: int) -> int:
    """A signed 64-bit hash below which about twice the wanted rows lie, so that no task offers more than its share of a sample."""
    return min(2**63 - 1, int((min(1.0, 2 * (wanted + 50) / max(of, 1)) - 0.5) * 2**64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, elementwise on uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components by repeated hooking to the smallest neighbour and edge contraction.

    edges: (u, v) of one comparable type. Returns (id, component): each id that has an edge with the smallest id it
    reaches. Rows with a null end or u = v add nothing. Every round writes its state to the shared folder; the number of rounds
    grows with the logarithm of the longest chain, and hubs pre-aggregate before each shuffle.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = publish(e, f"{name}-edges")
    label = None
    while not e.isEmpty():
        low = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = publish(low.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("p")), f"{name}-hook")
        up = low.select(F.col("x").alias("p"), F.col("p").alias("pp"))
        jump = publish(low.join(up, "p", "left").select("x", F.coalesce("pp", "p").alias("p")), f"{name}-jump")
        if label is None:
            label = jump.select(F.col("x").alias("id"), F.col("p").alias("component"))
        else:
            label = publish(label.join(jump.select(F.col("x").alias("component"), "p"), "component", "left").select("id", F.coalesce("p", "component").alias("component")), f"{name}-label")
        ju, jv = jump.select(F.col("x").alias("u"), F.col("p").alias("pu")), jump.select(F.col("x").alias("v"), F.col("p").alias("pv"))
        e = e.join(ju, "u").join(jv, "v").where("pu <> pv").select(F.greatest("pu", "pv").alias("u"), F.least("pu", "pv").alias("v")).distinct()
        e = publish(e, f"{name}-edges")
    return label if label is not None else e.select(F.col("u").alias("id"), F.col("v").alias("component"))
