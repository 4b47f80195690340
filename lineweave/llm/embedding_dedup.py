"""Embedding near-dedup: spherical-cap filters decoded from structured random product codes.

Unit vectors are turned by random rotations; a rotation's coordinates fall into BLOCKS blocks, each with a random code
of unit vectors, and a filter is one code word of each block, together a direction in space. A vector passes the filters whose
direction it exceeds by a threshold; these are list-decoded block by block, with the best rest still possible as bound, and never enumerated.
Vectors of one label that share a filter are compared exactly. The threshold follows from the number of vectors, so that
a filter holds about PER_FILTER of them by chance, and the code is as large as the wanted recall needs; both move
with the input, and candidates grow about in proportion to it.

Equal vectors of a label are one class with a weight. A pair that shares several filters counts in the smallest one only, so each
filter returns, for each vector, its number of links and the smallest partner of its local group: no list of pairs is ever made. Filters
with many vectors are split into pairs of blocks.

Cases: null vectors, null labels, zero vectors, vectors with null or non-finite components link with nothing; vectors of another
length than most of their label's link with those of that length only; ids are integers, rows that repeat an id are vectors of their own
with links of their own; columns beyond those named are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import components, discard, publish, table

#: Least cosine of a link; rotations; blocks of a product code; vectors that share a filter by chance; shared filters that a pair at
#: the least cosine should have; rows of a block of a large filter; classes of many copies at most.
COSINE, ROTATIONS, BLOCKS, PER_FILTER, SHARED, BLOCK, HOT = 0.93, 16, 2, 24, 9.0, 1024, 1000


@dataclass(frozen=True)
class Code:
    """ROTATIONS product codes for vectors of one length; `cap` is the least inner product of a vector that passes."""

    dim: int
    words: int
    cap: float

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        return _parts(self.dim, self.words)


@lru_cache(maxsize=8)
def _parts(dim: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations, and code words of each rotation and block, scaled so that a filter's direction has length 1."""
    rng = np.random.default_rng([dim, words])
    width = -(-dim // BLOCKS)
    turn = np.stack([np.linalg.qr(rng.normal(size=(width * BLOCKS, width * BLOCKS)))[0][:dim] for _ in range(ROTATIONS)])
    code = rng.normal(size=(ROTATIONS, BLOCKS, words, width))
    code /= np.linalg.norm(code, axis=3, keepdims=True) * np.sqrt(BLOCKS)
    return turn, code


def _tail(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(s, P(inner product of two random unit vectors >= s)) on a grid that is fine near 1."""
    angle = np.linspace(0, np.pi, 40_001)
    density = np.sin(angle) ** (dim - 2) if dim > 1 else np.ones_like(angle)
    mass = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2)])
    return np.cos(angle), mass / mass[-1]


def design(n: int, dim: int, cosine: float = COSINE, per_filter: float = PER_FILTER, shared: float = SHARED) -> Code:
    """Code for about n vectors of a label: P(pass) = per_filter / n, and enough filters that pairs at the cosine share `shared` of them."""
    s, above = _tail(dim)
    rest, rest_above = _tail(max(dim - 1, 2))
    p, both = min(0.02, per_filter / max(n, 1)), 0.0
    while True:
        cap = float(np.interp(p, above, s))
        inner = s[s >= cap]  # of a direction with one vector that passes; the other's follows from it and a random rest
        mass = np.diff(above[: len(inner)], prepend=0.0)
        need = (cap - cosine * inner) / np.maximum(np.sqrt((1 - cosine**2) * (1 - inner**2)), 1e-12)
        both = float((mass * np.interp(np.clip(need, -1, 1), rest[::-1], rest_above[::-1])).sum())
        if both >= (0.2 if dim > 4 else 0.7) * p or p >= 0.4:
            break
        p *= 1.5  # in few dimensions a narrow cap has no room for two vectors at the cosine
    words = int(np.ceil((shared / max(both, 1e-12) / ROTATIONS) ** (1 / BLOCKS)))
    return Code(dim, max(2, words), cap)


def decode(x: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of each filter that unit vectors pass; the first block's word is the leading digit of a filter."""
    turn, words = code.parts()
    m, found = code.words, []
    for r in range(ROTATIONS):
        y = (x @ turn[r]).reshape(len(x), BLOCKS, -1)
        inner = np.einsum("nbw,bmw->nbm", y, words[r])
        rest = np.cumsum(inner.max(2)[:, ::-1], 1)[:, ::-1]  # the most that blocks from b on can add
        row, filt, total = np.arange(len(x)), np.full(len(x), r, np.int64), np.zeros(len(x))
        for b in range(BLOCKS):
            after = rest[row, b + 1] if b + 1 < BLOCKS else np.zeros(len(row))
            sums = total[:, None] + inner[row, b]
            i, j = np.nonzero(sums + after[:, None] >= code.cap)
            row, filt, total = row[i], filt[i] * m + j, sums[i, j]
        found.append((row, filt))
    row, filt = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((filt, row))
    return row[order], filt[order]


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _deal(codes: dict[int, Code], kind: str, narrow: str):
    """Distinct vectors to rows (label, filter, id, weight, vector, filters), one for each filter they pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                dims = np.array([len(b) // np.dtype(kind).itemsize for b in batch.column(3).to_pylist()])
                for dim in np.unique(dims).tolist():
                    rows = np.flatnonzero(dims == dim)
                    part = batch.take(pa.array(rows))
                    x = _unit(np.frombuffer(b"".join(part.column(3).to_pylist()), kind).reshape(-1, dim).astype(float))
                    row, filt = decode(x, codes[dim])
                    if not len(row):
                        continue
                    edge = np.searchsorted(row, np.arange(len(x) + 1))
                    short = filt.astype(narrow)
                    lists = [short[i:j].tobytes() for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                    of = pa.array(row)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(of), pa.array(np.full(len(row), dim, np.int32)), pa.array(filt), *(part.column(i).take(of) for i in (1, 2, 3)), pa.array(lists, pa.binary()).take(of)], names=["label", "dim", "filter", "id", "weight", "vector", "filters"])

    return run


def _compare(cosine: float, kind: str, narrow: str):
    def links(group: dict, i: np.ndarray, j: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows at or above the cosine whose first common filter is this one."""
        found = [], []
        for at in range(0, len(i), 512):
            rows = i[at : at + 512]
            hit = np.argwhere(group["x"][rows] @ group["x"][j].T >= cosine)
            a, b = rows[hit[:, 0]], j[hit[:, 1]]
            ok = (b > a) if same else np.ones(len(a), bool)
            a, b = a[ok], b[ok]
            sets = {k: set(np.frombuffer(group["filters"][k], narrow).tolist()) for k in {*a.tolist(), *b.tolist()}}
            first = np.fromiter((min(sets[p] & sets[q]) for p, q in zip(a.tolist(), b.tolist(), strict=True)), np.int64, len(a))
            found[0].append(a[first == group["filter"][a]])
            found[1].append(b[first == group["filter"][a]])
        return tuple(np.concatenate(f) if f else np.empty(0, np.int64) for f in found)

    def run(table_: pa.Table) -> pa.Table:
        key = np.stack([table_[c].to_numpy() for c in ("label", "dim", "filter", "i", "j")], 1)
        order = np.lexsort(key.T)
        key = key[order]
        ids, weight, block = (table_[c].to_numpy()[order] for c in ("id", "weight", "block"))
        vectors, lists = table_["vector"].to_pylist(), table_["filters"].to_pylist()
        edge = np.append(np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)]), len(key)).tolist()
        us, vs, ns = [], [], []
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if b - a < 2:
                continue
            at = order[a:b]
            group = {"x": _unit(np.frombuffer(b"".join(vectors[k] for k in at), kind).reshape(b - a, -1).astype(float)), "filters": [lists[k] for k in at], "filter": key[a:b, 2]}
            i, j = key[a, 3], key[a, 4]
            p, q = links(group, np.flatnonzero(block[a:b] == i), np.flatnonzero(block[a:b] == j), i == j)
            if not len(p):
                continue
            own, w = ids[a:b], weight[a:b]
            n = np.bincount(p, w[q], b - a) + np.bincount(q, w[p], b - a)
            low = np.arange(b - a)  # local groups: the smallest id spreads until nothing changes
            rank = np.argsort(np.argsort(own, kind="stable"), kind="stable")
            low = rank.copy()
            while True:
                new = low.copy()
                np.minimum.at(new, p, low[q])
                np.minimum.at(new, q, low[p])
                if (new == low).all():
                    break
                low = new
            linked = n > 0
            us.append(own[linked])
            vs.append(np.sort(own)[low[linked]])
            ns.append(n[linked].astype(np.int64))
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        return pa.table({"u": pa.array(join(us)), "v": pa.array(join(vs)), "n": pa.array(join(ns))})

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """(id, n_links, component_id) of each row."""
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    form = {"float": "<f4", "double": "<f8"}[kind]  # sent as they are, compared in double precision
    plain = F.transform(F.col(vector_col).cast(f"array<{kind}>"), lambda c: c + F.lit(0.0).cast(kind))  # no negative zeros
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(label_col)).alias("label"), F.col(label_col).isNotNull().alias("labelled"), plain.alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    good = F.coalesce(F.col("labelled") & finite & F.col("id").isNotNull(), F.lit(False))
    fine = rows.where(good).select("id", "label", "v")
    classes = fine.groupBy("label", "v", F.pmod(F.xxhash64("id"), F.lit(32)).alias("salt")).agg(F.min("id").alias("low"), F.count("*").alias("weight")).groupBy("label", "v").agg(F.min("low").alias("low"), F.sum("weight").alias("weight"))
    # a class is known by a number of its own, as unlike vectors may have one id
    classes = publish(classes.select(F.monotonically_increasing_id().alias("cid"), F.xxhash64("label", "v").alias("print"), "label", "low", "weight", "v", F.size("v").alias("dim")), "vector-classes")
    sizes = classes.groupBy("dim", "label").agg(F.count("*").alias("n")).groupBy("dim").agg(F.max("n").alias("n")).collect()  # one row a vector length
    codes = {r["dim"]: design(r["n"], r["dim"], cosine) for r in sizes}
    narrow = "<i4" if all(ROTATIONS * c.words**BLOCKS < 2**31 for c in codes.values()) else "<i8"
    packed = classes.select("label", "cid", "weight", "v").mapInArrow(_pack, "label long, cid long, weight long, vector binary")
    dealt = publish(packed.mapInArrow(_deal(codes, form, narrow), "label long, dim int, filter long, id long, weight long, vector binary, filters binary"), "vector-filters")
    held = dealt.groupBy("label", "dim", "filter").agg(F.count("*").alias("rows")).where("rows > 1").select("label", "dim", "filter", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    met = dealt.join(held, ["label", "dim", "filter"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")).withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o"))
    tasks = int(max(256, sum(r["n"] for r in sizes) // 200))
    met = met.withColumn("task", F.pmod(F.xxhash64("label", "filter", "i", "j"), F.lit(tasks))).drop("o", "blocks")
    part = publish(met.groupBy("task").applyInArrow(_compare(cosine, form, narrow), "u long, v long, n long"), "vector-links")
    discard(dealt)
    links = part.groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("near"))
    comp = components(part.select("u", "v"), "vectors").select(F.col("id").alias("cid"), "component")

    told = classes.select("cid", "print", "low", "weight").join(links, "cid", "left").join(comp, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    told = publish(told, "vector-told")
    least = told.groupBy("component").agg(F.min("low").alias("component_id"))  # a component's classes are numbered at will: its least vector is found last
    of = publish(told.join(least, "component").select("print", (F.coalesce("near", F.lit(0).cast("long")) + F.col("weight") - 1).alias("n_links"), "component_id", "weight"), "vector-classes-told")
    # rows are joined by a print of their vector, which is not sent; the classes of many rows, a bounded number of them, are broadcast
    hot = F.broadcast(of.where(F.col("weight") >= max(1000, fine.count() // HOT)).drop("weight"))
    ids = fine.select("id", F.xxhash64("label", "v").alias("print"))
    known = ids.join(hot, "print").unionByName(ids.join(hot.select("print"), "print", "left_anti").join(of.drop("weight"), "print")).drop("print")
    rest = rows.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return known.select("id", "n_links", "component_id").unionByName(rest)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        values = lists.flatten().to_numpy(zero_copy_only=False)
        edge = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        blobs = [values[i:j].tobytes() for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(blobs, pa.binary())], names=["label", "cid", "weight", "vector"])


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors: links at cosine 0.93 or more within a label."""
    out = near_vectors(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


OP10_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), c AS (
  SELECT vec_id AS id, vec_id AS c FROM embeddings
  UNION
  SELECT l.v, c.c FROM c JOIN l ON l.u = c.id
), n AS (
  SELECT u, count(*) AS n FROM l GROUP BY u
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN (SELECT id, min(c) AS component_id FROM c GROUP BY id) m ON id = vec_id LEFT JOIN n ON u = vec_id
"""
