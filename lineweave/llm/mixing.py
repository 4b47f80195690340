"""Mixing sources to target weights: Pfair scheduling of source blocks, earliest deadline first. DataFrame functions only.

A source's documents, in an order by hash, fill blocks of block_chars characters. Block k (from 0) of a source that gets q of
period slots may not come before slot floor(k * period / q) and must come before slot ceil((k + 1) * period / q). Each slot goes to
the block that is released and has the earliest deadline; as shares add up to the whole, every window is met and no source is
ever a block ahead of its share or behind it, until the first source ends. The schedule repeats after `period` slots, so one period is computed, as
a fold over its slots, and any block's slot follows from its number. Cumulative sizes come from sums of hash ranges, so a source
of any size is spread over many tasks.

Cases: null sources are the source ''; null and empty texts count one character; null ids have a place like others, and
repeated rows follow each other; columns beyond id, text and source pass through as they are; names of added columns that clash
raise an error; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import publish, table

#: Slots of a period, so the unit of weights; characters of a block; power that turns volumes to weights.
PERIOD, BLOCK_CHARS, POWER = 1000, 20_000, 0.5
ADDED = ("start", "block", "release", "deadline", "slot")


def volume_weights(docs: DataFrame, source_col: str = "source", text_col: str = "text", power: float = POWER) -> DataFrame:
    """(source, weight): each source's characters to a power, the usual smoothing towards equal shares."""
    size = F.coalesce(F.length(text_col), F.lit(0)) + 1
    return docs.groupBy(F.coalesce(source_col, F.lit("")).alias("source")).agg(F.pow(F.sum(size).cast("double"), F.lit(power)).alias("weight"))


def shares(weights: DataFrame, period: int = PERIOD) -> DataFrame:
    """(source, nth, q): slots of a period, one at least, by largest remainder; nth numbers sources by name. Weights are a small table."""
    everything = Window.partitionBy(F.lit(0))
    w = weights.select("source", (F.col("weight") / F.sum("weight").over(everything) * (period - F.count("*").over(everything))).alias("x"), F.count("*").over(everything).alias("n"))
    rest = F.row_number().over(everything.orderBy(F.desc(F.round(F.col("x") - F.floor("x"), 9)), "source"))
    w = w.select("source", "x", "n", rest.alias("rest"), (F.lit(period) - F.col("n") - F.sum(F.floor("x")).over(everything)).alias("left"))
    q = F.lit(1) + F.floor("x") + (F.col("rest") <= F.col("left")).cast("long")
    return w.select("source", F.row_number().over(everything.orderBy("source")).alias("nth"), q.cast("int").alias("q"))


def period_slots(parts: DataFrame, period: int = PERIOD) -> DataFrame:
    """(source, q, slots): the slots that each source gets in a period, by earliest deadline first."""
    told = parts.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "q"))), lambda s: s["q"]).alias("qs"))
    # the fold carries blocks done by source and the winners so far; a slot's winner is found first, then both advance
    step = f"""
      aggregate(sequence(0, {period - 1}), named_struct('done', transform(qs, q -> 0), 'winners', cast(array() AS array<int>)),
        (s, t) -> transform(array(array_min(filter(transform(qs, (q, i) -> named_struct('late', cast(ceil((s.done[i] + 1) * {period} / q) AS int), 'i', i, 'ready', floor(s.done[i] * {period} / q) <= t)), x -> x.ready)).i),
          w -> named_struct('done', transform(s.done, (d, i) -> if(i = w, d + 1, d)), 'winners', concat(s.winners, array(w))))[0]).winners
    """
    won = told.select(F.posexplode(F.expr(step)).alias("slot", "won"))
    slots = won.groupBy((F.col("won") + 1).alias("nth")).agg(F.array_sort(F.collect_list("slot")).alias("slots"))
    return parts.join(slots, "nth").select("source", "q", "slots")


def schedule(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", period: int = PERIOD, block_chars: int = BLOCK_CHARS, seed: str = "mix") -> DataFrame:
    """docs with start (characters of its source before it), block, release, deadline and slot. Rows ordered by (slot, start) are the mix.

    weights: (source, weight) for the sources in docs; for more than period / 2 of them the period is a multiple of the given one. Sources
    that it lacks get no place and raise an error, as rows are never dropped.
    """
    if clash := set(ADDED) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} would be overwritten")
    weights = volume_weights(docs, source_col, text_col) if weights is None else weights
    weights = publish(weights.select("source", "weight"), "mix-weights")
    period *= max(1, -(-2 * weights.count() // period))  # two slots a source at least
    parts = publish(shares(weights, period), "mix-shares")
    plan = publish(period_slots(parts, period), "mix-period")  # period slots in all

    order = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = docs.withColumns({"_src": F.coalesce(F.col(source_col), F.lit("")), "_key": order, "_size": (F.coalesce(F.length(text_col), F.lit(0)) + 1).cast("long"), "_tie": F.xxhash64(text_col)})
    rows = rows.withColumn("_range", F.conv(F.substring("_key", 1, 2), 16, 10).cast("int"))
    sums = publish(rows.groupBy("_src", "_range").agg(F.sum("_size").alias("_sum")), "mix-sums")  # 256 rows a source at most
    before = Window.partitionBy("_src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_src", "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("_src", "_range").orderBy("_key", F.col(id_col), "_size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("_size").over(own), F.lit(0)))
    rows = rows.join(sums, ["_src", "_range"]).withColumn("start", F.col("start") + F.col("_base"))
    placed = rows.join(F.broadcast(plan.withColumnRenamed("source", "_src").withColumnRenamed("q", "_q").withColumnRenamed("slots", "_slots")), "_src", "left")
    block, q = F.col("block"), F.col("_q")
    placed = placed.withColumn("block", F.floor(F.col("start") / block_chars))
    placed = placed.withColumns({"release": F.floor(block * period / q), "deadline": F.ceil((block + 1) * period / q), "slot": F.when(q.isNull(), F.raise_error(F.concat(F.lit("no weight for source "), "_src"))).otherwise(F.floor(block / q) * period + F.get("_slots", (block % q).cast("int")))})
    return placed.select(*docs.columns, *ADDED)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """docs in the order of the mix: range-partitioned by slot and sorted, so files written from it follow it."""
    return schedule(docs, **options).repartitionByRange("slot", "start").sortWithinPartitions("slot", "start").select(*docs.columns)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their block, its window and its slot; weights are the square roots of the sources' volumes."""
    return schedule(table(spark, sf_dir, "documents")).select("doc_id", "source", *ADDED)


OP9_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(source, '') AS src, length(coalesce(text, '')) + 1 AS size, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents
), v AS (
  SELECT src, sqrt(sum(size)) AS weight FROM d GROUP BY src
), x AS (
  SELECT src, weight / sum(weight) OVER () * ({PERIOD} - count(*) OVER ()) AS x, count(*) OVER () AS n FROM v
), r AS (
  SELECT src, x, row_number() OVER (ORDER BY round(x - floor(x), 9) DESC, src) AS rest, {PERIOD} - n - sum(floor(x)) OVER () AS remaining FROM x
), q AS (
  SELECT src, row_number() OVER (ORDER BY src) AS nth, CAST(1 + floor(x) + CASE WHEN rest <= remaining THEN 1 ELSE 0 END AS BIGINT) AS q FROM r
), qs AS (
  SELECT list(q ORDER BY nth) AS qs FROM q
), s AS (
  SELECT 0 AS t, list_transform(qs, lambda a: 0) AS done, 0 AS won FROM qs
  UNION ALL
  SELECT t + 1, list_transform(done, lambda a, i: a + CASE WHEN i = w THEN 1 ELSE 0 END), w FROM (
    SELECT t, done, list_min(list_filter(list_transform(qs, lambda a, i: [CASE WHEN done[i] * {PERIOD} // a <= t THEN ((done[i] + 1) * {PERIOD} + a - 1) // a ELSE 1000000000 END, i]), lambda p: p[1] < 1000000000))[2] AS w
    FROM s, qs WHERE t < {PERIOD}
  )
), e AS (
  SELECT won AS nth, list(t - 1 ORDER BY t) AS slots FROM s WHERE t > 0 GROUP BY won
), c AS (
  SELECT doc_id, source, src, coalesce(sum(size) OVER (PARTITION BY src ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d
), b AS (
  SELECT *, CAST(start // {BLOCK_CHARS} AS BIGINT) AS block FROM c
)
SELECT doc_id, source, CAST(start AS BIGINT) AS start, block, CAST(block * {PERIOD} // q AS BIGINT) AS release, CAST(ceil((block + 1) * {PERIOD} / q) AS BIGINT) AS deadline,
  CAST(block // q * {PERIOD} + slots[block % q + 1] AS BIGINT) AS slot
FROM b JOIN q USING (src) JOIN e USING (nth)
"""
