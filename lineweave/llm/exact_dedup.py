"""Exact dedup: binary-fuse filters over an immutable snapshot screen a batch of incoming digests.

Digests are grouped first, so a text that fills a third of the table is one row afterwards. The snapshot's distinct
digests are dealt to hash buckets, and each bucket gets a static 3-wise binary fuse filter. Incoming digests, grouped among
themselves, meet only the filter of their bucket; positives are joined with the exact bucket. Every digest held by more than one
row then has its texts compared byte for byte, by grouping on (digest, normalised text).

Cases: null text counts as empty; empty texts are equal to each other; repeated rows each get a result row; a null id is
an id like any other and sorts first among ties; columns beyond id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import SPACE, mix64, publish, table

#: Digests that one filter bucket holds, about, and the least number of buckets.
BUCKET_KEYS, LEAST_BUCKETS = 50_000, 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


# --- binary fuse filter -------------------------------------------------------------------------------------------------


def _slots(keys: np.ndarray, seed: int, seg: int, n_seg: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key and its 8-bit fingerprint."""
    with np.errstate(over="ignore"):
        h = mix64(keys + np.uint64(seed))
    h0 = (((h >> np.uint64(32)) * np.uint64(seg * n_seg)) >> np.uint64(32)).astype(np.int64)
    low = (seg - 1)
    h1 = (h0 + seg) ^ ((h >> np.uint64(18)).astype(np.int64) & low)
    h2 = (h0 + 2 * seg) ^ (h.astype(np.int64) & low)
    return np.stack([h0, h1, h2]), ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) of distinct uint64 keys; peels all free slots of a round at once."""
    n = len(keys)
    seg = 1 << max(2, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    for attempt in range(1, 200):
        n_seg = max(1, int(np.ceil(n * factor * (1 + 0.02 * attempt) / seg)) - 2)
        seed = attempt * 0x9E3779B97F4A7C15 % 2**64
        slots, prints = _slots(keys, seed, seg, n_seg)
        size, alive, rounds = (n_seg + 2) * seg, np.arange(n), []
        while len(alive):
            flat = slots[:, alive].ravel()
            count = np.bincount(flat, minlength=size)
            owner = np.bincount(flat, weights=np.tile(alive, 3), minlength=size)
            free = np.flatnonzero(count == 1)
            if not len(free):
                break
            key, first = np.unique(owner[free].astype(np.int64), return_index=True)
            rounds.append((key, free[first]))
            left = np.ones(n, bool)
            left[key] = False
            alive = alive[left[alive]]
        if len(alive):
            continue
        cells = np.zeros(size, np.uint8)
        for key, slot in reversed(rounds):  # the own slot is still zero
            s = slots[:, key]
            cells[slot] = prints[key] ^ cells[s[0]] ^ cells[s[1]] ^ cells[s[2]]
        return seed, seg, n_seg, cells.tobytes()
    raise RuntimeError("binary fuse construction did not converge; are the keys distinct?")


def in_filter(keys: np.ndarray, seed: int, seg: int, n_seg: int, cells: bytes) -> np.ndarray:
    c = np.frombuffer(cells, np.uint8)
    s, prints = _slots(keys, seed, seg, n_seg)
    return c[s[0]] ^ c[s[1]] ^ c[s[2]] == prints


def _build(group: pa.Table) -> pa.Table:
    keys = np.unique(group["key"].to_numpy().view(np.uint64))
    seed, seg, n_seg, cells = build_filter(keys)
    return pa.table({"bucket": group["bucket"][:1], "seed": np.array([seed], np.uint64).view(np.int64), "seg": pa.array([seg], pa.int64()), "n_seg": pa.array([n_seg], pa.int64()), "cells": pa.array([cells], pa.binary())})


def _screen(batch: pa.Table, filters: pa.Table) -> pa.Table:
    if not batch.num_rows or not filters.num_rows:
        return batch.select(["digest"]).slice(0, 0)
    f = filters.to_pylist()[0]
    keys = batch["key"].to_numpy().view(np.uint64)
    return batch.select(["digest"]).filter(pa.array(in_filter(keys, f["seed"] % 2**64, f["seg"], f["n_seg"], f["cells"])))


# --- the operator -------------------------------------------------------------------------------------------------------


def snapshot_filters(groups: DataFrame) -> DataFrame:
    """One filter per bucket of a snapshot's (bucket, key) rows; static, so it is written once per snapshot."""
    return groups.select("bucket", "key").groupBy("bucket").applyInArrow(_build, "bucket long, seed long, seg long, n_seg long, cells binary")


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """The incoming (bucket, key, digest) rows that the snapshot may hold: no false negatives, about 1 in 256 false positives."""
    return incoming.select("bucket", "key", "digest").groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(_screen, "digest binary")


def exact_dedup(docs: DataFrame, incoming: Column, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) for each row of docs; rows where incoming holds are the new batch, others the snapshot.

    Of rows with equal normalised text, that with the most code points stays, then the smallest id. digest can be
    replaced (tests use a weak one, to see collisions resolved by the byte check).
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.length(text), F.lit(0)).alias("n"), normalised(text).alias("norm"), F.coalesce(incoming, F.lit(False)).alias("incoming"))
    fp = publish(rows.select("id", "n", "incoming", digest(F.col("norm")).alias("digest")), "exact-digests")
    buckets = max(LEAST_BUCKETS, fp.count() // BUCKET_KEYS)
    sides = fp.groupBy("digest").agg(F.count_if(~F.col("incoming")).alias("old"), F.count_if("incoming").alias("new"))
    sides = publish(sides.withColumn("key", F.xxhash64("digest")).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))), "exact-groups")
    old, new = sides.where("old > 0").select("bucket", "key", "digest", "old"), sides.where("new > 0").select("bucket", "key", "digest", "new")
    filters = publish(snapshot_filters(old), "exact-filters")
    positive = screen(new, filters).join(old.select("digest"), "digest")
    several = positive.unionByName(old.where("old > 1").select("digest")).unionByName(new.where("new > 1").select("digest")).distinct()
    several = publish(several, "exact-several")

    # Byte check. Ids of the rows in question are found on the small digest table, so the join with texts has no hot key.
    spread = F.xxhash64("id", "digest")
    asked = fp.join(several, "digest", "left_semi").select(F.col("id").alias("asked_id"), F.col("digest").alias("asked")).distinct()
    texts = rows.select("id", "n", "norm", digest(F.col("norm")).alias("digest"))
    texts = texts.join(asked, F.col("id").eqNullSafe(F.col("asked_id")) & (F.col("digest") == F.col("asked")), "left_semi")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id")))
    partly = texts.groupBy("digest", "norm", F.pmod(spread, F.lit(64)).alias("salt")).agg(best.alias("best"), F.count("*").alias("size"))
    classes = partly.groupBy("digest", "norm").agg(F.min("best").alias("best"), F.sum("size").alias("size"))
    classes = publish(classes.select("digest", "norm", F.col("best.id").alias("keep_id"), "size"), "exact-classes")
    clash = classes.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest")

    first = classes.join(clash, "digest", "left_anti").select("digest", "keep_id", "size", F.lit(False).alias("clash"))
    known = first.unionByName(clash.select("digest", F.lit(None).cast(dict(docs.dtypes)[id_col]).alias("keep_id"), F.lit(None).cast("long").alias("size"), F.lit(True).alias("clash")))
    out = fp.join(known, "digest", "left")
    alone = out.where("clash is null or not clash").select("id", F.when(F.col("clash").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("size", F.lit(1).cast("long")).alias("group_size"), "digest")
    if not clash.isEmpty():  # equal digests of unlike texts: the texts themselves are the key
        apart = rows.select("id", "norm", digest(F.col("norm")).alias("digest")).join(clash, "digest", "left_semi")
        apart = apart.join(classes, ["digest", "norm"]).select("id", "keep_id", F.col("size").alias("group_size"), "digest")
        alone = alone.unionByName(apart)
    return alone.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; half of them (by a hash of the id) play the snapshot, the others the incoming batch."""
    docs = table(spark, sf_dir, "documents")
    out = exact_dedup(docs, F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), k AS (
  SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM d GROUP BY text_sha256
)
SELECT d.doc_id, k.keep_id, k.group_size, d.doc_id = k.keep_id AS kept, d.text_sha256
FROM d JOIN k USING (text_sha256)
"""
