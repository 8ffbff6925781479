"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

A source's target is cut into seats of ``block`` tokens.  Seats go to the highest
quotients ``target / (2 j - 1)``; with the number of seats that all targets' rounded blocks
make, that gives each source ``floor(target / block + 1/2)`` seats (the common divisor form), so no
list of seats is sorted.  Of the first ``h`` of ``H`` output shards every source has
``floor(target * h / (H * block) + 1/2)`` seats, again an apportionment of its own: the
differences are the integer quotas per shard, and they never fall below zero.

A source's documents stand in a seeded order; its blocks are stretches of the words in that
order.  Every block is taken ``seats // blocks`` times, and ``seats % blocks`` blocks in a
row from a seeded start once more.  So at most two documents of a source are cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewater.llm.common import bounded
from tidewater.session import written

#: Blocks that the smallest target has at least; it bounds the rounding error of a source to 1/128.
BLOCKS_PER_SOURCE = 128
#: Documents of one source in one part of the running sum, about.
PART_ROWS = 20_000
_BITS = 60


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    parts = F.split(F.concat(F.lit(" "), text, F.lit(" ")), r"[ \t-\r]+")
    return F.coalesce(F.size(parts).cast("long") - 2, F.lit(0).cast("long"))


def seeded(key: Column, seed: int) -> Column:
    """A number below 2**60 that follows from ``key`` and ``seed``."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f"/{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("long")


def capped_targets(sources: DataFrame, share: float, cap: float) -> DataFrame:
    """Add target: ``share`` of all sizes by weight, none above ``cap`` times its source's size.

    The excess is shared again by weight among those below; in the order of cap to
    weight the first source that a proportional share of the rest does not fill ends the
    capped ones, which is where repeated sharing settles.  ``sources`` has source, weight and
    source_size, one row a source: that list alone is put in order.
    """
    full = F.col("source_size") * cap
    order = W.orderBy((F.col("source_size") * cap / F.col("weight")).asc(), F.col("rank").asc())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    every = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap) / F.sum("weight").over(rest)
    ready = sources.withColumn("_level", level)
    ready = ready.withColumn("_level", F.min(F.when(F.col("_level") * F.col("weight") <= full, F.struct(F.col("source_size") * cap / F.col("weight"), F.col("rank"), F.col("_level").alias("at")))).over(every)["at"])
    return ready.withColumn("target", F.least(full.cast("double"), F.coalesce(F.col("_level") * F.col("weight"), full.cast("double")))).drop("_level")


def plan(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float, seed: int) -> DataFrame:
    """One row a source: source, source_size, weight, target, block, blocks, seats, start.

    Weights repeat over the sources in the order of their names by code point, null last.
    ``block`` is the smallest positive target over ``BLOCKS_PER_SOURCE``, one word at least.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ready = capped_targets(sources.withColumn("weight", weight), share, cap)
    every = W.partitionBy()
    block = F.greatest(F.floor(F.min(F.when(F.col("target") > 0, F.col("target"))).over(every) / BLOCKS_PER_SOURCE), F.lit(1).cast("long"))
    ready = ready.withColumn("block", F.coalesce(block, F.lit(1).cast("long")))
    ready = ready.withColumn("blocks", F.expr("(source_size + block - 1) div block")).withColumn("seats", F.floor(F.col("target") / F.col("block") + 0.5))
    return ready.withColumn("start", F.coalesce(F.when(F.col("blocks") > 0, seeded(F.col("source"), seed) % F.col("blocks")), F.lit(0).cast("long"))).drop("rank")


def quotas(sources: DataFrame, shards: int) -> DataFrame:
    """(source, shard, quota): seats of each source in each of ``shards`` output shards."""
    upto = lambda h: F.floor(F.col("target") * h / (F.col("block") * shards) + 0.5)
    each = sources.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return each.select("source", "shard", (upto(F.col("shard") + 1) - upto(F.col("shard"))).alias("quota"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1,), share: float = 1.0, cap: float = 2.0, seed: int = 7, shards: int = 64) -> tuple[DataFrame, DataFrame]:
    """(documents, sources): what the mix takes of every row, and the plan of every source.

    Documents: doc_id, source, key, size, source_size, target, taken, shard (of its first
    words taken, else null).  ``key`` is a hash of id, text and source for joining back.  Null text: size 0, nothing
    taken.  A null source is a source.  Repeated rows stand one by one.  An empty
    table gives empty results.

    The running sum of sizes is cut by the top bits of the seeded order, so that a source
    that holds a third of all rows is summed in many parts.
    """
    sizes = docs.select("doc_id", "source", F.xxhash64("doc_id", "text", "source").alias("key"), word_count(F.col("text")).alias("size"), seeded(F.col("doc_id"), seed).alias("_at"))
    sizes = written(sizes, "sizes")
    bits = min(30, max(0, math.ceil(math.log2(max(1, sizes.count()) / PART_ROWS))))
    sizes = sizes.withColumn("_part", F.shiftright("_at", _BITS - bits))
    parts = sizes.groupBy("source", "_part").agg(F.sum("size").alias("_sum"))
    before = W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("source", "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    sources = written(plan(sizes, weights, share, cap, seed), "sources")
    facts = parts.join(F.broadcast(sources) if sources.count() <= 100_000 else sources, parts.source.eqNullSafe(sources.source)).drop(sources.source)
    facts = written(facts, "parts")

    own = W.partitionBy("source", "_part").orderBy("_at", "doc_id", "size", "key").rowsBetween(W.unboundedPreceding, 0)
    at = sizes.withColumn("_end", F.sum("size").over(own))
    right = facts.withColumnsRenamed({"source": "_source", "_part": "_p"})
    df = at.join(bounded(right), at.source.eqNullSafe(right["_source"]) & (at["_part"] == right["_p"]))
    df = df.withColumn("_e", F.col("_before") + F.col("_end")).withColumn("_s", F.col("_e") - F.col("size"))
    once, more = F.expr("if(blocks > 0, seats div blocks, 0)"), F.expr("if(blocks > 0, seats % blocks, 0)")
    df = df.withColumn("_once", once).withColumn("_stop", F.col("start") + more)
    overlap = lambda lo, hi: F.greatest(F.lit(0).cast("long"), F.least("_e", hi * F.col("block")) - F.greatest("_s", lo * F.col("block")))
    df = df.withColumn("taken", F.col("_once") * F.col("size") + overlap(F.col("start"), F.least("_stop", "blocks")) + overlap(F.lit(0), F.col("_stop") - F.col("blocks")))
    seat = F.pmod(F.expr("_s div block") - F.col("start"), F.col("blocks"))
    shard = F.least(F.ceil((seat + 0.5) * F.col("block") * shards / F.col("target")) - 1, F.lit(shards - 1).cast("long"))
    out = df.select("doc_id", at.source, "key", "size", "source_size", "target", "taken", F.when(F.col("taken") > 0, shard).alias("shard"))
    return out, sources


def mixed(docs: DataFrame, **rules) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its words are taken, rounded; a row cut by half or more is left out.

    ``rules`` are those of ``mix``.  Rows that agree in id, text and source are counted together, and come as one of them.
    """
    taken, _ = mix(docs, **rules)
    per = taken.filter("size > 0").groupBy("key").agg(F.sum(F.floor(F.col("taken") / F.col("size") + 0.5)).alias("_times"), F.count("*").alias("_rows"))
    per = written(per.filter("_times > 0").withColumnRenamed("key", "_key"), "times")
    key = F.xxhash64("doc_id", "text", "source")
    more = per.filter("_rows > 1")
    out = docs.join(bounded(per.filter("_rows = 1").select("_key", "_times")), key == F.col("_key"))
    if not more.isEmpty():
        out = out.unionByName(docs.join(bounded(more.select("_key", "_times")), key == F.col("_key")).dropDuplicates(["_key"]))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select(*docs.columns)


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '/7'), 1, 15))::BIGINT AS at
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][(rank % 3 + 1)::INT] AS weight FROM s
), l AS (
  SELECT *, source_size * 2.0::DOUBLE / weight AS fill, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(source_size) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2.0::DOUBLE)
    / sum(weight) OVER (ORDER BY source_size * 2.0::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT *, least(source_size * 2.0::DOUBLE, coalesce((SELECT arg_min(level, (fill, rank)) FROM l WHERE level * weight <= source_size * 2.0::DOUBLE) * weight, source_size * 2.0::DOUBLE)) AS target FROM l
), b AS (
  SELECT *, greatest(floor((SELECT min(target) FROM t WHERE target > 0) / 128), 1)::BIGINT AS block FROM t
), p AS (
  SELECT *, (source_size + block - 1) // block AS blocks, floor(target / block + 0.5)::BIGINT AS seats FROM b
), a AS (
  SELECT *, CASE WHEN blocks > 0 THEN ('0x' || substr(md5(coalesce(source, 'null') || '/7'), 1, 15))::BIGINT % blocks ELSE 0 END AS start,
    CASE WHEN blocks > 0 THEN seats // blocks ELSE 0 END AS once, CASE WHEN blocks > 0 THEN seats % blocks ELSE 0 END AS more
  FROM p
), x AS (
  SELECT d.doc_id, d.size, d.source, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.at, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS e FROM d
), y AS (
  SELECT x.doc_id, x.size, x.e, x.e - x.size AS s, a.* EXCLUDE (source) FROM x JOIN a ON x.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, target,
  (once * size + greatest(0, least(e, least(start + more, blocks) * block) - greatest(s, start * block)) + greatest(0, least(e, (start + more - blocks) * block) - s))::BIGINT AS taken
FROM y
"""
