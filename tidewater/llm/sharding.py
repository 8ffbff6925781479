"""Sharding by extendible hashing: every shard fits its byte limit.

A row's key is a hash of its id and text.  The directory starts as one bucket and
only a bucket above the limit splits, on the next bit of the hash.  Sums of bytes are taken
once for fine cells of the hash range and added up level by level, so a split costs no
pass over the rows; cells that are too large still are refined from their own rows
alone.  Rows with one hash value (equal rows) cannot be parted by bits: their bucket is a
chain of pages, filled by the rows' places.  A single row above the limit is a shard by itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewater.llm.common import bounded
from tidewater.session import written

BITS = 60


def row_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of MD5 over id and text; nulls have a text of their own."""
    name = F.coalesce(doc_id.cast("string"), F.lit("null"))
    digest = F.md5(F.concat(name, F.coalesce(F.concat(F.lit("/"), text), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def _leaves(cells: DataFrame, low: int, high: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Of cells (cell of ``high`` bits, bytes, rows): (cell, depth, prefix, bytes, rows) that settle, and the cells that do not."""
    up = F.expr(f"shiftright(cell, {high} - depth)")
    each = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn("prefix", up)
    sums = each.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    fits = sums.filter(f"bytes <= {limit} or rows = 1")
    first = each.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"]).groupBy("cell").agg(F.min(F.struct("depth", "prefix", "bytes", "rows")).alias("s"))
    done = written(first.select("cell", "s.*"), "leaves")
    return done, cells.join(done, "cell", "left_anti")


def directory(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """[(bits, cells)]: cells (cell, depth, prefix, bytes, rows) say in which bucket a hash lies.

    ``rows`` is a written table of hash and bytes.  Each item of the list refines what the one before left.
    """
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    low, high = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + 3)
    out, left = [], rows
    while True:
        cells = left.groupBy(F.shiftright("hash", BITS - high).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
        done, large = _leaves(written(cells, "cells"), low, high, limit)
        out.append((high, done))
        large = written(large, "large")
        if large.isEmpty():
            return out
        if high == BITS:
            out.append((BITS, large.select("cell", F.lit(BITS + 1).alias("depth"), F.col("cell").alias("prefix"), "bytes", "rows")))
            return out
        left = written(left.join(bounded(large.select("cell")), F.shiftright("hash", BITS - high) == F.col("cell"), "left_semi"), "left")
        low, high = high + 1, min(BITS, high + 10)


def assign(rows: DataFrame, limit: int) -> DataFrame:
    """Add shard, depth, page and shard_bytes to rows that have hash and bytes.

    ``shard`` is ``2**depth + prefix``, one number for each bucket; shards are told apart by (shard, page),
    and page is 0 but for chains of equal rows.  ``rows`` must be cheap to read twice.
    """
    light = written(rows.select("hash", "bytes"), "hashes")
    found = directory(light, limit)
    chained = None
    if len(found) > 1 and found[-1][0] == found[-2][0] == BITS:
        chained = found.pop()[1]
    parts = []
    for bits, cells in found:
        cells = bounded(cells.select(F.col("cell").alias("_cell"), "depth", "prefix", F.col("bytes").alias("shard_bytes")))
        parts.append(rows.join(cells, F.shiftright("hash", BITS - bits) == F.col("_cell")).drop("_cell").withColumn("page", F.lit(0).cast("long")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("shard", F.expr("shiftleft(1L, depth) + prefix")).drop("prefix")
    if chained is None:
        return out
    own = rows.join(bounded(chained.select(F.col("cell").alias("hash"))), "hash", "left_semi")
    stored = written(own, "chains")
    cols = rows.columns
    at = stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_i"))
    counts = at.groupBy("hash", "_file").agg(F.count("*").alias("_n"))
    before = counts.select("hash", "_file", (F.sum("_n").over(W.partitionBy("hash").orderBy("_file")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(W.partitionBy("hash", "_file").orderBy("_i")) - 1 + F.col("_before")
    paged = at.join(before, ["hash", "_file"]).withColumn("page", F.expr(f"cast(greatest(1, {limit} div greatest(bytes, 1)) as bigint)")).withColumn("page", F.floor(place / F.col("page")))
    sums = paged.groupBy("hash", "page").agg(F.sum("bytes").alias("shard_bytes"))
    paged = paged.join(sums, ["hash", "page"]).select(*cols, F.lit(BITS).alias("depth"), "shard_bytes", "page", F.expr(f"shiftleft(1L, {BITS}) + hash").alias("shard"))
    return out.unionByName(paged)


def shard(docs: DataFrame, limit: int = 256 << 20) -> DataFrame:
    """``docs`` with shard, page, depth, shard_bytes and bytes, which are those of the text in UTF-8 (null: none).

    Columns of these five names that ``docs`` has are replaced, others of any name stay.  An empty table gives an empty result;
    texts are read where they lie and not shuffled while the directory may be broadcast.
    """
    own, docs = docs.columns, docs.drop("shard", "page", "depth", "shard_bytes", "bytes")
    # The hash has a name inside that a column of the documents may have, in any letter case.
    safe = {c: f"_own{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    rows = docs.withColumnsRenamed(safe)
    rows = rows.withColumn("hash", row_hash(F.col("doc_id"), F.col("text"))).withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    done = assign(rows, limit).drop("hash")
    return done.select(*(F.col(safe.get(c, c)).alias(c) for c in own if c in docs.columns), "bytes", *(c for c in done.columns if c in ("shard", "page", "depth", "shard_bytes")))


def shard_sql(limit: int) -> str:
    """The same in SQL, for tables without chains of equal rows."""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || coalesce('/' || text, '')), 1, 15))::BIGINT AS hash
  FROM documents
), e AS (SELECT rid, doc_id, bytes, g AS depth, hash >> ({BITS} - g)::INT AS prefix FROM d, range({BITS + 1}) r(g)
), s AS (SELECT *, sum(bytes) OVER (PARTITION BY depth, prefix)::BIGINT AS shard_bytes, count(*) OVER (PARTITION BY depth, prefix) AS n FROM e
), f AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY depth) AS k FROM s WHERE shard_bytes <= {limit} OR n = 1)
SELECT doc_id, bytes, (1::BIGINT << depth::INT) + prefix AS shard, 0::BIGINT AS page, depth::INT AS depth, shard_bytes FROM f WHERE k = 1
"""
