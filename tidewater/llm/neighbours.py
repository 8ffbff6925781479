"""Nearest neighbours by cosine: a block matrix join of int8 tiles with error bounds, made exact.

Vectors are scaled to length 1 and quantised to int8, each with a scale of its own and the length of what the quantisation left out.  A tile is
the product of a block of candidates and a panel of queries: exact whole numbers, which give every cosine up to a known error.
A pair whose upper bound is below the k-th best of the query cannot be among its nearest; all others, the survivors, are computed
again from the original vectors in double precision and go to the query's heap.  The result is exact.  A panel of queries meets every block.

Equal vectors are one candidate and one query: a vector that a third of all rows share makes one row of a tile.  Each candidate keeps its
least ids, as many as a query can need.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import bounded, small_batches
from tidewater.session import written

#: Distinct vectors of a candidate block and of a query panel, on average.
BLOCK, PANEL = 1024, 2048
#: Panels (about 1 MB each at 64 dimensions) that may be broadcast; beyond, blocks and panels are shuffled to meet.
PANELS = 16
#: Candidate blocks that share one copy of a panel, where panels are shuffled.
SHARED = 16
#: Survivors whose cosine is computed at a time.
SURVIVORS = 1 << 18


def usable(vector: Column) -> Column:
    """Not null, not empty, no component null, infinite or not a number, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, length of the codes' vector, length of the remainder) of the vectors at length 1."""
    # A power of two changes no digit and keeps squares in range.
    unit = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, initial=0.0))[1][:, None])
    unit /= np.sqrt((unit**2).sum(axis=1))[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None])
    near = codes * scale[:, None]
    return codes.astype(np.int8), scale, np.sqrt((near**2).sum(axis=1)), np.sqrt(((unit - near) ** 2).sum(axis=1))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with that of ``y``, in double precision; summed from the first component to the last."""
    x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, initial=0.0))[1][:, None]) for v in (x, y))
    dot, xx, yy = (np.zeros(len(x)) for _ in range(3))
    for d in range(x.shape[1]):
        dot += x[:, d] * y[:, d]
        xx += x[:, d] * x[:, d]
        yy += y[:, d] * y[:, d]
    return dot / (np.sqrt(xx) * np.sqrt(yy))


def _matrix(lists: pa.ListArray, dim: int) -> np.ndarray:
    return np.asarray(lists.flatten(), np.float64).reshape(-1, dim)


class _Rows:
    """Rows of a block or panel: their vectors and what the tile needs of them."""

    def __init__(self, rows: pa.StructArray, dim: int, ids: str):
        self.vectors = _matrix(rows.field("v"), dim)
        self.ids = rows.field(ids).to_pylist()
        self.codes, self.scale, self.length, self.rest = quantised(self.vectors)


def merge_tile(queries: _Rows, block: _Rows, heaps: list[list], k: int) -> None:
    """Add to each query's heap of (cosine, -id), the best ``k``, what the block's vectors can add."""
    # Products of int8 codes add up to whole numbers that the type holds exactly.
    exact = np.float32 if 127 * 127 * block.codes.shape[1] < 1 << 24 else np.float64
    about = (queries.codes.astype(exact) @ block.codes.astype(exact).T).astype(np.float64)
    about *= queries.scale[:, None] * block.scale
    slack = queries.rest[:, None] * block.length + block.rest + 1e-12
    least = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    if about.shape[1] >= k:
        kth = np.partition(about - slack, about.shape[1] - k, axis=1)[:, about.shape[1] - k]
        least = np.maximum(least, kth)
    query, found = np.nonzero(about + slack >= least[:, None] - 1e-12)
    for at in range(0, len(query), SURVIVORS):
        q, c = query[at : at + SURVIVORS], found[at : at + SURVIVORS]
        for i, j, score in zip(q.tolist(), c.tolist(), cosines(queries.vectors[q], block.vectors[c]).tolist()):
            heap = heaps[i]
            for own in block.ids[j]:
                entry = (score, -own)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                else:
                    break


def _tiles(k: int):
    """Arrow function: tiles of blocks and panels to the best of each query, of a task's tiles of a panel.

    Few panels are kept; what a panel has found goes out when it makes way for another.
    """

    def ready(queries: _Rows, heaps: list[list]) -> pa.RecordBatch:
        best = [[{"away": -score, "id": -i} for score, i in heap] for heap in heaps]
        kind = pa.list_(pa.struct([("away", pa.float64()), ("id", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array(queries.ids, pa.int64()), pa.array(best, kind)], ["query", "best"])

    def run(batches):
        panels: dict[tuple, tuple[_Rows, list[list]]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                key = dim, _ = batch.column("dim")[row].as_py(), batch.column("panel")[row].as_py()
                if key not in panels:
                    if len(panels) == PANELS:
                        yield ready(*panels.pop(next(iter(panels))))
                    queries = _Rows(batch.column("queries")[row].values, dim, "query")
                    panels[key] = queries, [[] for _ in queries.ids]
                merge_tile(panels[key][0], _Rows(batch.column("block")[row].values, dim, "ids"), panels[key][1], k)
        for panel in panels.values():
            yield ready(*panel)

    return run


def _dealt(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows with the number of a part of about ``size`` rows of one dimension, and how many parts there are."""
    parts = written(rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("long").alias(f"{name}s")), "parts")
    dealt = rows.join(bounded(parts), "dim")
    return dealt.withColumn(name, F.pmod(F.xxhash64("v"), F.col(f"{name}s")))


def nearest(vectors: DataFrame, is_query: Column, k: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of each query by cosine, exactly, ties to the smaller id.

    Every row with an id and a usable vector (see ``usable``) is a candidate for the queries of other ids; vectors of different length are not
    compared.  Repeated rows count once.  Rows of one id with different vectors are a candidate each, and a query each, answered one by one.
    A query with fewer candidates gets them all.  Rows with a null id and other columns, whatever their names, take no part.  A row for
    which ``is_query`` is null asks nothing.
    """
    rows = vectors.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"), is_query.alias("asks"))
    # Adding zero makes a negative zero positive, so that equal vectors are equal to any hash.
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("v", F.transform("v", lambda x: x + 0.0)).dropDuplicates(["id", "v"])
    rows = written(rows.withColumn("key", F.xxhash64("v")), "vectors")
    # A query loses the candidates of its own id: of each vector, k + 1 ids suffice.
    own = Window.partitionBy("key", "v").orderBy("id")
    fewest = rows.withColumn("place", F.row_number().over(own)).filter(F.col("place") <= k + 1)
    distinct = fewest.groupBy("key", "v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    candidates = written(distinct.select("ids", "v", F.size("v").alias("dim")), "candidates")
    asked = rows.filter("asks").select("key", "v").distinct()
    asked = written(asked.select("key", "v", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("query")), "queries")

    blocks = _dealt(candidates, BLOCK, "block").groupBy("dim", F.col("block").alias("number")).agg(F.collect_list(F.struct("ids", "v")).alias("block"))
    panels = _dealt(asked, PANEL, "panel")
    panels = written(panels.groupBy("dim", "panel", "panels").agg(F.collect_list(F.struct("query", "v")).alias("queries")), "panels")
    blocks = written(blocks.join(bounded(panels.select("dim", "panels").distinct()), "dim"), "blocks")
    blocks = blocks.withColumn("panel", F.explode(F.sequence(F.lit(0).cast("long"), F.col("panels") - 1))).drop("panels")
    panels = panels.drop("panels")
    if panels.count() <= PANELS:
        tiles = blocks.join(F.broadcast(panels), ["dim", "panel"])
    else:
        copies = blocks.agg(F.max(F.expr(f"number div {SHARED}"))).first()[0] or 0
        spread = panels.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies))))
        tiles = blocks.withColumn("share", F.expr(f"number div {SHARED}")).join(spread, ["dim", "panel", "share"])
    # Of a query's best, the vectors of its own id fall out: so many more are kept.
    most = k + (rows.filter("asks").groupBy("id").count().agg(F.max("count")).first()[0] or 0)
    found = small_batches(tiles).mapInArrow(_tiles(most), "query long, best array<struct<away:double,id:long>>")
    found = written(found, "best").select("query", F.inline("best"))
    rank = Window.partitionBy("query").orderBy("away", "id")
    found = found.withColumn("place", F.row_number().over(rank)).filter(F.col("place") <= most)
    found = found.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("away", "id"))).alias("best"))

    askers = rows.filter("asks").select(F.col("id").alias("query_id"), "key", "v").join(asked.select("key", "v", "query"), ["key", "v"])
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)
    best = askers.select("query", "query_id").join(found, "query").select("query_id", F.posexplode(others).alias("place", "near"))
    return best.select("query_id", (F.col("place") + 1).alias("rank"), F.col("near.id").alias("vec_id"), (0.0 - F.col("near.away")).alias("score"))


#: Every pair, for small tables.
NEAREST_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) / (sqrt(list_inner_product(q.v, q.v)) * sqrt(list_inner_product(c.v, c.v))) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM placed WHERE rank <= 5
"""
