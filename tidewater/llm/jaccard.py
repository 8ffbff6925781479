"""N-gram Jaccard join: documents whose sets of word shingles nearly agree.

The method is token-combination prefixes.  Tokens (shingle hashes) are put in one order,
rare ones first, and of each set only a prefix is indexed: rare tokens one by one,
frequent tokens in pairs, the prefix being extended until every set that overlaps enough
must share an entry.  Sets that meet in an entry are verified exactly.

Steps, each a Spark job over tables of the scratch folder:

1. *Classes.*  Equal sets form one class; only classes are joined.
2. *Thinning.*  Tokens of a fixed part of the hash range are counted over all documents.
   A token that only one document has cannot be shared, so a set of ``n`` tokens with
   more than ``(1 - t) n`` such tokens has no partner.  The test is exact; it
   leaves sets that share most of their tokens with others, which alone go on.
3. *Order.*  All tokens of the sets left are counted; the order is by count, then hash.
4. *Index.*  ``m = n - ceil(t n) + 1`` tokens must be covered.  A rare token (found in at
   most ``FREQUENT`` sets) covers one.  Frequent tokens are dealt by hash to a number
   of groups that follows from the size of the set; ``f`` tokens of a group cover
   ``f - 1`` and are indexed as all their pairs.  Sets of neighbouring size classes are
   indexed under both classes.  Of two sets that overlap enough, the one whose prefix ends first
   loses fewer tokens than it covers, so some entry is shared.
5. *Links.*  ``groups`` first ties every entry's sets to the one with the fewest unshared
   tokens, contracts what is verified, then verifies the remaining pairs that lie in one
   entry but in different components: no link between components is lost, and a group of
   thousands of near copies isn't expanded.  Pairs whose unshared tokens and parity marks
   already show too many differing tokens are dropped inside that join; the bound is exact.  ``links`` verifies all pairs.

A null text, or one without words, has an empty set and no links.  Null ids
are kept: such a row is joined by its text, and the component of a class is the least id
in it.  Repeated rows are members of one class.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded, small_batches
from tidewater.llm.components import connected_components
from tidewater.llm.words import blocks, mix, parity_marks, shingles
from tidewater.session import written

#: A token in more sets than this is indexed in pairs.
FREQUENT = 24


@dataclass(frozen=True)
class Join:
    """Shingle length in words and the least similarity in hundredths."""

    words: int = 5
    percent: int = 80

    @property
    def thin(self) -> int:
        """Hash range of the thinning step, in thousandths; any value gives the same links.

        It must be well above the share of tokens that partners may differ in, or few sets are ruled out.
        """
        return max(200, 15 * (100 - self.percent))


def _set_keys(tokens: np.ndarray) -> tuple[int, int]:
    total = lambda x: int(x.sum(dtype=np.uint64).astype(np.int64))
    return total(mix(tokens)), total(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)))


def _sets(batch: pa.RecordBatch, n: int):
    """(row, distinct sorted tokens) of each row of a batch."""
    for words in blocks(batch.column("text")):
        tokens, of = shingles(words.hash, words.row, n)
        ends = np.searchsorted(of, np.arange(words.first, words.last + 1))
        for row, a, b in zip(range(words.first, words.last), ends[:-1], ends[1:], strict=True):
            yield row, np.unique(tokens[a:b])


def _long_lists(parts: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, parts)]).astype(np.int32), flat)


def shingle_sets(docs: DataFrame, join: Join) -> DataFrame:
    """(doc_id, at, body, n, k1, k2, low): size and 128-bit name of each row's set, and its tokens of the thinning range."""
    limit = np.uint64((1 << 64) // 1000 * join.thin)

    def run(batches):
        for batch in batches:
            n, k1, k2, low = [], [], [], []
            for _, tokens in _sets(batch, join.words):
                a, b = _set_keys(tokens)
                n.append(len(tokens)), k1.append(a), k2.append(b)
                low.append(tokens[: np.searchsorted(tokens, limit)])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "at", "body")], pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), _long_lists(low)], ["doc_id", "at", "body", "n", "k1", "k2", "low"])

    schema = "doc_id long, at long, body long, n long, k1 long, k2 long, low array<long>"
    return _keyed(docs).mapInArrow(run, schema)


def _keyed(docs: DataFrame) -> DataFrame:
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *_row_key())


def _row_key() -> list[Column]:
    """``at``: the id, or a hash of the text where the id is null; ``body``: a hash of the text.  Only equal rows share both."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("at"), F.xxhash64("text").alias("body")]


@dataclass
class Index:
    """Tables that the join leaves: members (row's class), nodes (the classes), sets (tokens), entries."""

    members: DataFrame
    nodes: DataFrame
    sets: DataFrame
    entries: DataFrame


def index(docs: DataFrame, join: Join) -> Index:
    """Steps 1 to 4."""
    rows = written(shingle_sets(docs, join), "shingle-sets")
    members = rows.select("doc_id", "at", "body", "n", F.xxhash64("k1", "k2", "n").alias("node"))
    nodes = rows.filter("n > 0").groupBy(F.xxhash64("k1", "k2", "n").alias("node"), "k1", "k2", "n").agg(F.min("doc_id").alias("doc_id"), F.min("at").alias("at"))
    nodes = written(nodes, "nodes")

    # By class, as different texts may have one id.
    lone = rows.select(F.xxhash64("k1", "k2", "n").alias("node"), F.explode("low").alias("token")).groupBy("token").agg(F.count("*").alias("df"), F.min("node").alias("node")).filter("df = 1")
    lone = lone.groupBy("node").agg(F.count("*").alias("lone"))
    slack = F.expr(f"n * {100 - join.percent} div 100")
    # A set that has no room for one more token links to its equals alone; what is left out may lie in no larger set.
    able = nodes.filter(f"100 * n >= {join.percent} * (n + 1)").join(lone, "node", "left")
    able = written(able.filter(F.coalesce("lone", F.lit(0)) <= slack).select("node", "at", "k1", "k2", "n"), "able")

    sets = written(_full_sets(docs, able, join).dropDuplicates(["node"]), "sets")
    tokens = sets.select("node", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    order = tokens.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    order = order.join(sets.select("node", F.size("tokens").cast("long").alias("n")), "node").filter(F.size("shared") * 100 >= F.col("n") * join.percent)
    order = order.select("node", "n", F.col("shared.df").alias("df"), F.col("shared.token").alias("token"))
    return Index(members, nodes, sets, written(_entries(order, join), "entries"))


def _full_sets(docs: DataFrame, able: DataFrame, join: Join) -> DataFrame:
    def run(batches):
        for batch in batches:
            wanted = batch.column("node").to_pylist()
            node, found = [], []
            for row, tokens in _sets(batch, join.words):
                key = _set_keys(tokens) + (len(tokens),)
                if key == (batch.column("k1")[row].as_py(), batch.column("k2")[row].as_py(), batch.column("n")[row].as_py()):
                    node.append(wanted[row])
                    found.append(tokens)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), _long_lists(found)], ["node", "tokens"])

    return _keyed(docs).join(bounded(able), "at").select("text", "node", "k1", "k2", "n").mapInArrow(run, "node long, tokens array<long>")


def size_class(n: int, t: float) -> int:
    """Sets that can link lie in one class or in neighbouring ones."""
    return math.floor(math.log(n) / -math.log(t) + 1e-9)


def prefix_entries(n: int, df: list[int], tokens: np.ndarray, t: int, frequent: int = FREQUENT) -> dict[tuple, None]:
    """Entries of one set of ``n`` tokens; ``tokens``: those shared with others, in order, ``df`` in how many sets."""
    need = n - -(-n * t // 100) + 1 - (n - len(tokens))
    rare = sum(x <= frequent for x in df)
    out: dict[tuple, None] = {(0, int(x), 0): None for x in tokens[: min(rare, need)]}
    if rare >= need:
        return out
    home = size_class(n, t / 100)
    for c in (home, home + 1):
        groups = max(1, int((100 / t) ** c * (100 - t) / 100 / 6))
        held: dict[int, list[int]] = {}
        covered = rare
        for x in map(int, tokens[rare:]):
            own = held.setdefault((x >> 20) % groups, [])
            out.update({(c + 1, y, x): None for y in own})
            covered += bool(own)
            own.append(x)
            if covered >= need:
                break
    return out


#: Parity marks: each token flips one of 512 bits, so two sets differ in as many tokens as bits at least.
MARKS = [f"mark{k}" for k in range(8)]


def _entries(order: DataFrame, join: Join) -> DataFrame:
    def run(batches):
        for batch in batches:
            at = np.asarray(batch.column("token").offsets)
            flat = np.asarray(batch.column("token").values)
            counts = np.asarray(batch.column("df").values)
            nodes, sizes = (batch.column(c).to_pylist() for c in ("node", "n"))
            for row, (node, n) in enumerate(zip(nodes, sizes, strict=True)):
                tokens, df = flat[at[row] : at[row + 1]], counts[at[row] : at[row + 1]]
                found = np.array([*prefix_entries(n, df.tolist(), tokens, join.percent)], np.int64).reshape(-1, 3).view(np.uint64)
                key = mix(mix(mix(found[:, 0]) + found[:, 1]) + found[:, 2]).view(np.int64)
                k = len(key)
                same = [node, n, n - len(tokens), *parity_marks(tokens, 64 * len(MARKS))]
                yield pa.RecordBatch.from_arrays([pa.array(key), *[pa.array(np.full(k, x)) for x in same]], ["entry", "node", "n", "lone", *MARKS])

    return order.mapInArrow(run, "entry long, node long, n long, lone long, " + ", ".join(f"{m} long" for m in MARKS))


def _near_sizes(a: str, b: str, join: Join) -> str:
    return f"100 * least({a}, {b}) >= {join.percent} * greatest({a}, {b})"


def verified(pairs: DataFrame, ix: Index, join: Join) -> DataFrame:
    """(a, b, both) of the distinct ``pairs`` that link; ``both``: tokens in common."""
    one = pairs.join(ix.sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
    two = one.join(ix.sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
    counted = two.select("a", "b", F.size(F.array_intersect("ta", "tb")).cast("long").alias("both"), (F.size("ta") + F.size("tb")).cast("long").alias("total"))
    return counted.filter(f"100 * both >= {join.percent} * (total - both)").select("a", "b", "both")


def _may_link(join: Join) -> str:
    """Sets that link differ in few tokens; lone tokens and unequal marks are tokens that differ."""
    differ = " + ".join(["lone_a + lone_b", *[f"bit_count({m}_a ^ {m}_b)" for m in MARKS]])
    return f"{100 + join.percent} * ({differ}) <= {100 - join.percent} * (n_a + n_b)"


def _met(entries: DataFrame, join: Join, apart: str = "true") -> DataFrame:
    """Distinct pairs that meet in an entry."""
    x = entries.select("entry", *[F.col(c).alias(f"{c}_a") for c in entries.columns if c != "entry"])
    y = entries.select("entry", *[F.col(c).alias(f"{c}_b") for c in entries.columns if c != "entry"])
    pairs = x.join(y, "entry").filter(f"node_a < node_b and {apart} and {_near_sizes('n_a', 'n_b', join)} and {_may_link(join)}")
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def links(ix: Index, join: Join) -> DataFrame:
    """(a, b, both): every link between two classes, ``a < b``; see ``Index.members`` for who is in a class."""
    return verified(_met(ix.entries, join), ix, join)


def groups(ix: Index, join: Join) -> DataFrame:
    """(node, component) of the classes that are linked; components are named by a node."""
    middles = ix.entries.groupBy("entry").agg(F.count("*").alias("size"), F.min(F.struct("lone", "node", "n")).alias("m")).filter("size > 1")
    middles = written(middles.select("entry", F.col("m.node").alias("m"), F.col("m.n").alias("m_n")), "middles")
    met = ix.entries.join(middles, "entry")
    spokes = met.filter(f"node <> m and {_near_sizes('n', 'm_n', join)}").select(F.least("node", "m").alias("a"), F.greatest("node", "m").alias("b")).distinct()
    spokes = written(spokes, "spokes")
    first = written(verified(spokes, ix, join), "links")
    parts = written(connected_components(first), "parts")

    named = ix.entries.join(middles.select("entry"), "entry", "left_semi").join(parts, "node", "left")
    named = written(named.select("entry", "node", "n", "lone", *MARKS, F.coalesce("component", "node").alias("part")), "named")
    mixed = named.groupBy("entry").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q")
    rest = _met(named.join(mixed, "entry", "left_semi"), join, "part_a <> part_b").join(spokes, ["a", "b"], "left_anti")
    more = written(verified(rest, ix, join), "links")
    return connected_components(first.select("a", "b").union(more.select("a", "b")))


def _components(ix: Index, join: Join) -> DataFrame:
    """(node, doc_id, component) of every class; doc_id is its least."""
    names = ix.nodes.select("node", "doc_id").join(groups(ix, join), "node", "left")
    return written(names.select("node", "doc_id", F.coalesce("component", "node").alias("component")), "names")


def representatives(docs: DataFrame, join: Join) -> DataFrame:
    """``docs`` with one row of each component: that of the least id, null ids last; equal rows count once.

    Rows without words are all kept.  The rows to drop are found by id and a hash of the text, so no
    text is shuffled while their list may be broadcast.
    """
    ix = index(docs, join)
    rows = written(ix.members.filter("n > 0").groupBy("at", "body", "node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows")), "rows")
    found = rows.join(_components(ix, join).select("node", "component"), "node")
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at", "body")).alias("b"))
    best = written(best.select(F.col("b.at").alias("at"), F.col("b.body").alias("body")), "best")
    drop = written(rows.select("at", "body").join(best, ["at", "body"], "left_anti").select(F.col("at").alias("_at"), F.col("body").alias("_body")), "dropped")
    again = written(rows.filter("rows > 1").select("at", "body").join(best, ["at", "body"], "left_semi").select(F.col("at").alias("_at"), F.col("body").alias("_body")), "again")
    at, body = _row_key()
    same = (at == F.col("_at")) & (body == F.col("_body"))
    kept = docs.join(bounded(drop), same, "left_anti")
    if again.isEmpty():
        return kept
    twice = kept.join(bounded(again), same, "left_semi").withColumn("_at", at).withColumn("_body", body).dropDuplicates(["_at", "_body"]).drop("_at", "_body")
    return kept.join(bounded(again), same, "left_anti").unionByName(twice)


def link_components(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least id reachable by links, its own included.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  An empty table
    gives an empty result.  A null id stays null, with the least id of its component, if any.
    """
    ix = index(docs, join)
    names = _components(ix, join)
    least = names.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = written(names.join(least, "component").select("node", "component_id"), "of-node")
    out = ix.members.join(of_node, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
