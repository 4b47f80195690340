"""N-gram Jaccard join: documents whose sets of five-word shingles have a Jaccard similarity of 0.75 or more, exactly.

1. Shingle hashes are dealt, packed, to buckets by their leading bits; there each gets its document frequency. Shingles of one
   document only can't be shared, so only the others travel back to their documents.
2. A document needs ceil(0.75 n) shared shingles to have any partner. Those that have them keep their shared shingles, rarest
   first, and the prefix by which a partner must be met.
3. Equal sets are one class. Classes that agree in a minimum hash are checked against the smallest id only, and verified links
   are contracted, so groups of near copies cost a star and not all pairs.
4. Prefix postings that still join different components are indexed in R-trees, split by shingle: shingles are hashed to groups,
   the counts by group are a point, and sum(min(query, upper corner)) bounds the overlap with all below a node. Surviving pairs are
   verified on the shingles themselves. Large postings are split into pairs of blocks, each a task of its own.

Cases: null or empty text and text of white space have no shingles and no links; fewer than five words are one shingle; ids
are integers, rows that repeat an id are one document with the shingles of all of them, and rows with a null id get no component
but the size of their set; columns beyond id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import components, mix64, publish, table
from .shingles import chunks, shingle_sets

#: Similarity as a fraction; groups that shingles are hashed to; minimum hashes that propose stars; rows of a block and of a leaf.
NUM, DEN, GROUPS, STARS, BLOCK, LEAF = 75, 100, 64, 3, 2048, 32
#: Shingles of a bucket, about; powers of two that bound the number of buckets.
BUCKET_ROWS, LEAST_BITS, MOST_BITS = 1_000_000, 10, 20
_DOCS, _SETS = 0, 1


def _planes(x: np.ndarray, drop: int = 0) -> bytes:
    """Bytes by significance, so that equal leading bytes compress; without the `drop` leading ones."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : 8 - drop].T).tobytes()


def _unplanes(blob: bytes, drop: int = 0) -> np.ndarray:
    out = np.zeros((len(blob) // (8 - drop), 8), np.uint8)
    out[:, : 8 - drop] = np.frombuffer(blob, np.uint8).reshape(8 - drop, -1).T
    return out.view("<u8").ravel()


def _need(n: np.ndarray) -> np.ndarray:
    """Shared shingles that a set of n needs to have a partner."""
    return -(-NUM * n // DEN)


def _deal(bits: int, width: int):
    """Documents to rows (bucket, base, docs, hashes): negative buckets hold (document, size of its set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in chunks(np.fromiter((len(t) for t in texts), np.int64, len(texts))):
                own = ids[part]
                hashes, doc = shingle_sets(texts[part], width)
                base = int(own.min())
                rows = [(-1 - int(mix64(np.array([base, len(own)], np.int64).view(np.uint64))[0] >> np.uint64(64 - bits)), base, _planes(own - base), _planes(np.bincount(doc, minlength=len(own))))]
                edge = np.searchsorted(hashes >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                far = own[doc] - base
                rows += [(b, base, _planes(far[i:j]), _planes(hashes[i:j], 1)) for b, (i, j) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)) if j > i]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "base", "docs", "hashes"])

    return run


def _by_document(kind: int, doc: np.ndarray, more: list[np.ndarray], bits: int) -> pa.Table:
    """Rows (part, kind, docs, a, b), split by a hash of the document."""
    part = (mix64(doc.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, doc, more = part[order], doc[order], [x[order] for x in more]
    edge = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)).tolist()
    rows = [(int(part[i]), kind, doc[i:j].tobytes(), *(x[i:j].tobytes() for x in more)) for i, j in zip(edge[:-1], edge[1:], strict=True)]
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["part", "kind", "docs", "a", "b"])


def _frequencies(bits: int, part_bits: int):
    def run(group: pa.Table) -> pa.Table:
        bucket = group["bucket"][0].as_py()
        base, docs, hashes = group["base"].to_pylist(), group["docs"].to_pylist(), group["hashes"].to_pylist()
        doc = np.concatenate([_unplanes(d).view(np.int64) + b for b, d in zip(base, docs, strict=True)])
        if bucket < 0:
            size = np.concatenate([_unplanes(h) for h in hashes]).astype(np.int64)
            return _by_document(_DOCS, doc, [size, np.zeros(len(doc), np.int8)], part_bits)
        h = np.concatenate([_unplanes(x, 1) for x in hashes]) | (np.uint64(bucket >> (bits - 8)) << np.uint64(56))
        order = np.argsort(h)
        h, doc = h[order], doc[order]
        edge = np.append(np.flatnonzero(np.diff(h, prepend=h[0] ^ np.uint64(1))), len(h))
        df = np.repeat(np.diff(edge), np.diff(edge))
        many = df > 1
        return _by_document(_SETS, doc[many], [h[many], np.minimum(df[many], 2**32 - 1).astype("<u4")], part_bits)

    return run


def _gather(group: pa.Table) -> pa.Table:
    """(id, n, k, whole, shared): k of the shared shingles, rarest first, are in the prefix; whole is a key of sets wholly shared."""
    kind, docs, a, b = (group[c].to_pylist() for c in ("kind", "docs", "a", "b"))
    doc = np.concatenate([np.frombuffer(d, np.int64) for d, k in zip(docs, kind, strict=True) if k == _DOCS] or [np.empty(0, np.int64)])
    size = np.concatenate([np.frombuffer(x, np.int64) for x, k in zip(a, kind, strict=True) if k == _DOCS] or [np.empty(0, np.int64)])
    own = np.concatenate([np.frombuffer(d, np.int64) for d, k in zip(docs, kind, strict=True) if k == _SETS] or [np.empty(0, np.int64)])
    h = np.concatenate([np.frombuffer(x, np.uint64) for x, k in zip(a, kind, strict=True) if k == _SETS] or [np.empty(0, np.uint64)])
    df = np.concatenate([np.frombuffer(x, "<u4") for x, k in zip(b, kind, strict=True) if k == _SETS] or [np.empty(0, "<u4")])
    order = np.lexsort((h, df, own))
    own, h = own[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    doc, back = np.unique(doc, return_inverse=True)
    n = np.bincount(back, size, len(doc)).astype(np.int64)
    n -= np.bincount(np.searchsorted(doc, own[~new]), minlength=len(doc))  # an id that repeats: what its rows share counts once
    own, h = own[new], h[new]
    begin, end = np.searchsorted(own, doc, "left"), np.searchsorted(own, doc, "right")
    shared = end - begin
    k = np.where(shared >= np.maximum(_need(n), 1), n - _need(n) + 1 - (n - shared), 0)
    blobs = [h[i:j].tobytes() if m > 0 else None for i, j, m in zip(begin.tolist(), end.tolist(), k.tolist(), strict=True)]
    with np.errstate(over="ignore"):
        one, two = np.cumsum(np.append(np.uint64(0), mix64(h))), np.cumsum(np.append(np.uint64(0), mix64(~h)))
        key = np.stack([one[end] - one[begin], two[end] - two[begin]], 1)
    whole = [key[i].tobytes() if w else None for i, w in enumerate(((k > 0) & (shared == n)).tolist())]
    return pa.table([pa.array(doc), pa.array(n), pa.array(k), pa.array(whole, pa.binary()), pa.array(blobs, pa.binary())], names=["id", "n", "k", "whole", "shared"])


def _star_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salts = mix64(np.arange(1, STARS + 1, dtype=np.uint64))
    for batch in batches:
        ids, keys = batch.column(0), []
        for blob in batch.column(1).to_pylist():
            h = np.frombuffer(blob, np.uint64)
            keys += [int(mix64(h ^ s).min().view(np.int64)) for s in salts]
        rows = np.repeat(np.arange(batch.num_rows), STARS)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(np.tile(np.arange(STARS, dtype=np.int32), batch.num_rows)), pa.array(keys, pa.int64())], names=["id", "j", "key"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        u, v, nu, nv, su, sv = (batch.column(i) for i in range(6))
        keep = []
        for a, b, x, y in zip(nu.to_pylist(), nv.to_pylist(), su, sv, strict=True):
            both = np.sort(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)]))
            overlap = int((both[1:] == both[:-1]).sum())
            keep.append(DEN * overlap >= NUM * (a + b - overlap))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([u.filter(mask), v.filter(mask)], names=["u", "v"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (u, v) of pairs whose sets are similar."""
    s = sets.select("id", "n", "shared")
    left = s.select(F.col("id").alias("u"), F.col("n").alias("nu"), F.col("shared").alias("su"))
    right = s.select(F.col("id").alias("v"), F.col("n").alias("nv"), F.col("shared").alias("sv"))
    both = pairs.join(left, "u").join(right, "v").where(f"least(nu, nv) * {DEN} >= greatest(nu, nv) * {NUM}")
    return both.select("u", "v", "nu", "nv", "su", "sv").mapInArrow(_verify, "u long, v long")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blobs = [np.frombuffer(b, np.uint64) for b in batch.column(2).to_pylist()]
        k = np.array(batch.column(1).to_pylist(), np.int64)
        rows = pa.array(np.repeat(np.arange(len(k)), k))
        keys = np.concatenate([b[:m] for b, m in zip(blobs, k.tolist(), strict=True)] or [np.empty(0, np.uint64)])
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(0).take(rows), batch.column(3).take(rows)], names=["h", "id", "component"])


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = [np.bincount((np.frombuffer(b, np.uint64) >> np.uint64(20)).astype(np.int64) % GROUPS, minlength=GROUPS).astype("<u4").tobytes() for b in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(points, pa.binary())], names=["id", "n", "point"])


class RTree:
    """Bulk-loaded over count vectors: rows in order of set size, leaves of LEAF rows, LEAF leaves to a node."""

    def __init__(self, points: np.ndarray, n: np.ndarray):
        self.order = np.lexsort((points[:, 0], n))
        self.points, self.n = points[self.order], n[self.order]
        self.levels = []  # upper corners and least sizes, from leaves to the root's children
        upper, least, most = self.points, self.n, self.n
        while len(upper) > LEAF:
            cut = np.arange(0, len(upper), LEAF)
            upper, least, most = np.maximum.reduceat(upper, cut), np.minimum.reduceat(least, cut), np.maximum.reduceat(most, cut)
            self.levels.append((upper, least, most))

    def query(self, point: np.ndarray, n: int) -> np.ndarray:
        """Rows whose overlap with the query may suffice: sum of coordinate minima >= NUM / (NUM + DEN) * (sum of sizes)."""
        rows = np.arange(len(self.levels[-1][0]) if self.levels else len(self.n))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, least, most = self.levels[depth]
            rows = rows[self._may(upper[rows], np.maximum(least[rows], -(-NUM * n // DEN)), point, n) & (most[rows] * DEN >= NUM * n) & (least[rows] * NUM <= DEN * n)]
            below = len(self.levels[depth - 1][0]) if depth else len(self.n)
            rows = (rows[:, None] * LEAF + np.arange(LEAF)).ravel()
            rows = rows[rows < below]
        rows = rows[self._may(self.points[rows], self.n[rows], point, n)]
        return self.order[rows]

    @staticmethod
    def _may(upper: np.ndarray, size: np.ndarray, point: np.ndarray, n: int) -> np.ndarray:
        return (NUM + DEN) * np.minimum(upper, point).sum(1, dtype=np.int64) >= NUM * (size + n)


def _candidates(group: pa.Table) -> pa.Table:
    """Pairs (u < v) of different components, in one posting or block pair each, that the tree's bound lets pass."""
    key = np.stack([group[c].to_numpy() for c in ("h", "i", "j")], 1)
    order = np.lexsort(key.T)
    key = key[order]
    ids, comp, n, block = (group[c].to_numpy()[order] for c in ("id", "component", "n", "block"))
    points = np.frombuffer(b"".join(group["point"].to_pylist()), "<u4").reshape(-1, GROUPS)[order].astype(np.int32)
    edge = np.append(np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)]), len(key))
    us, vs = [], []

    def add(a: np.ndarray, b: np.ndarray) -> None:
        ok = comp[a] != comp[b]
        us.append(np.minimum(ids[a[ok]], ids[b[ok]]))
        vs.append(np.maximum(ids[a[ok]], ids[b[ok]]))

    two = edge[:-1][np.diff(edge) == 2]
    if len(two):
        add(two[ok := (NUM + DEN) * np.minimum(points[two], points[two + 1]).sum(1, dtype=np.int64) >= NUM * (n[two] + n[two + 1])], two[ok] + 1)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if b - a < 3:
            continue
        i, j = key[a, 1], key[a, 2]
        tree_rows = np.arange(a, b)[block[a:b] == j]
        tree = RTree(points[tree_rows], n[tree_rows])
        for q in range(a, b):
            if block[q] == i:
                hit = tree_rows[tree.query(points[q], int(n[q]))]
                hit = hit[hit > q] if i == j else hit
                add(np.full(len(hit), q), hit)
    u, v = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (us, vs))
    pairs = np.unique(np.stack([u, v], 1), axis=0)
    return pa.table({"u": pa.array(pairs[:, 0]), "v": pa.array(pairs[:, 1])})


def shingle_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """(id, n_shingles, component_id) of each document id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    bits = int(np.clip(np.ceil(np.log2(max(total, 1) / 5 / BUCKET_ROWS + 1)), LEAST_BITS, MOST_BITS))
    dealt = rows.where("id is not null").mapInArrow(_deal(bits, width), "bucket int, base long, docs binary, hashes binary")
    shared = dealt.groupBy("bucket").applyInArrow(_frequencies(bits, bits - 2), "part int, kind int, docs binary, a binary, b binary")
    sets = publish(shared.groupBy("part").applyInArrow(_gather, "id long, n long, k long, whole binary, shared binary"), "ngram-sets")

    able = sets.where("k > 0")
    equal = able.where("whole is not null").groupBy("whole", "n").agg(F.min("id").alias("low"), F.count("*").alias("copies")).where("copies > 1").select("whole", "n", "low")
    equal = publish(able.where("whole is not null").select("id", "whole", "n").join(equal, ["whole", "n"]).where("id <> low").select(F.col("id").alias("u"), F.col("low").alias("v")), "ngram-equal")
    able = publish(able.join(equal, able.id == equal.u, "left_anti").select("id", "n", "k", "shared"), "ngram-able")

    keys = publish(able.select("id", "shared").mapInArrow(_star_keys, "id long, j int, key long"), "ngram-stars")
    low = keys.groupBy("j", "key").agg(F.min("id").alias("low"), F.count("*").alias("members")).where("members > 1").select("j", "key", "low")
    stars = keys.join(low, ["j", "key"]).where("id <> low").select(F.col("low").alias("u"), F.col("id").alias("v")).distinct()
    links = publish(verified(stars, able), "ngram-star-links")
    comp = components(links, "ngram-star")
    placed = publish(able.join(comp, "id", "left").select("id", "n", "k", "shared", F.coalesce("component", "id").alias("component")), "ngram-placed")

    postings = publish(placed.select("id", "k", "shared", "component").mapInArrow(_postings, "h long, id long, component long"), "ngram-postings")
    live = postings.groupBy("h").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("rows")).where("a <> b")
    live = publish(live.select("h", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")), "ngram-live")
    points = placed.select("id", "n", "shared").mapInArrow(_points, "id long, n long, point binary")
    hits = postings.join(live, "h").join(points, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = hits.select("h", "id", "component", "n", "point", "block", F.explode(other).alias("o")).select("h", "id", "component", "n", "point", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    parts = 1 << (bits + 2)
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("h", "i", "j"), F.lit(parts)))
    pairs = publish(dealt.groupBy("task").applyInArrow(_candidates, "u long, v long").distinct(), "ngram-pairs")
    links = links.unionByName(equal).unionByName(verified(pairs, able))
    comp = components(links, "ngram-all")
    out = sets.join(comp, "id", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    if docs.where(F.col(id_col).isNull()).isEmpty():
        return out
    alone = rows.where("id is null").select("id", "text").mapInArrow(_sizes(width), "id long, n_shingles long, component_id long")
    return out.unionByName(alone)


def _sizes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(shingle_sets([t], width)[0]) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(n, pa.int64()), none], names=["id", "n_shingles", "component_id"])

    return run


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: size of the shingle set and the smallest doc_id that links reach."""
    return shingle_classes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


#: Brute force: every pair that shares a shingle is counted, and labels spread until none changes.
OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS sh FROM w
), e AS (
  SELECT doc_id, unnest(sh) AS g FROM s
), p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT u, v FROM p JOIN s x ON x.doc_id = u JOIN s y ON y.doc_id = v WHERE 100 * n >= 75 * (len(x.sh) + len(y.sh) - n)
), c AS (
  SELECT doc_id AS id, doc_id AS c FROM s
  UNION
  SELECT l.v, c.c FROM c JOIN l ON l.u = c.id
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m.component_id FROM s JOIN (SELECT id, min(c) AS component_id FROM c GROUP BY id) m ON m.id = s.doc_id
"""
