"""Merkle manifest of a dataset: a SHA-256 tree whose parents keep their hash states.

A node's value is the SHA-256 of its children's values as hex text, in order; while a group has several nodes, every
``arity`` consecutive ones get a parent (the last run may have fewer, even one).  The values that the groups end in, in
the order of their group, are the leaves of one more tree, which ends in the root of the dataset.

A parent keeps a copy of its hash state before each child slot.  Folding a changed leaf into the root resumes, level by level,
the state before the changed child with the new value and the children to its right: no value to its left is read.

A tree is built in pieces of ``CHUNK`` nodes: one task makes a piece's subtree, the pieces' tops are the next round's nodes.
Pieces are cut by position, so a group with most of the rows is spread over as many tasks as it has pieces.  Every round is a written
table: it is the manifest, and what a lost executor costs.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm import midstates as sha
from tidewater.llm.common import bounded, small_batches
from tidewater.session import written

#: Nodes of a piece, at most.
CHUNK = 4096
#: Paths to the root that may be broadcast, at about 2 KB each.
PATHS = 16_384
RESULTS = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


class Manifest(NamedTuple):
    """Rounds of the groups' trees and of the tree above them, leaves first.

    A round's row is a piece: ``g``, ``piece``, ``m`` (nodes of the group in this round), ``nodes`` (their place, value and what
    the leaves carry), ``inner`` (values above them, level by level), ``states`` (kept by the parents, by level and slot), ``top``.
    """

    arity: int
    carried: list[str]
    groups: list[DataFrame]
    above: list[DataFrame]
    root: str | None


def leaf(*columns: Column | str) -> Column:
    """Hex SHA-256 of a record: each value as UTF-8 byte count, ``:`` and the value, or ``-`` where it is null."""

    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*(part(F.col(c) if isinstance(c, str) else c) for c in columns)).cast("binary"), 256)


def _levels(m: int, arity: int, most: int) -> int:
    """Levels above ``m`` nodes, up to ``most``."""
    levels = 0
    while m > 1 and levels < most:
        m, levels = -(-m // arity), levels + 1
    return levels


def _piece_levels(arity: int) -> int:
    levels = 1
    while arity ** (levels + 1) <= CHUNK:
        levels += 1
    return levels


def _placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """(g, pos, m, value, kept): place of each node in its group, and the group's size.

    Rows are ranged over tasks by group and order; a task's rows of a group have consecutive places, so counts by task and group are
    all that is added up.  Equal rows may go to several tasks: their number in the stored table ends the order.
    """
    ranked = ["g", *order, "value", "number"]
    stored = written(nodes.withColumn("number", F.monotonically_increasing_id()), "nodes")
    ranged = stored.repartitionByRange(*ranked).sortWithinPartitions(*ranked)
    ranged = written(ranged.select("g", "value", "kept", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "ranked")
    runs = ranged.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("g")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = written(runs.select("g", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("m")), "runs")
    return ranged.join(bounded(runs), ["g", "part"]).select("g", (F.col("at") + F.col("shift")).alias("pos"), "m", "value", "kept")


def _pieces(arity: int, most: int):
    """Arrow function: pieces with the subtree above their nodes."""

    def run(batches):
        for batch in batches:
            inner, states, tops = [], [], []
            for m, nodes in zip(batch.column("m").to_pylist(), batch.column("nodes"), strict=True):
                level = _values(nodes.values)
                values, kept = [], []
                for _ in range(_levels(m, arity, most)):
                    n = level.shape[1]
                    runs = -(-n // arity)
                    state = sha.starts(runs)
                    for slot in range(arity):
                        if slot:
                            kept.append(state.copy())
                        own = level[:, slot::arity]
                        state[:, : own.shape[1]] = sha.absorb(state[:, : own.shape[1]], own)
                    level = sha.finish(state, np.minimum(arity, n - arity * np.arange(runs)))
                    values.append(level)
                inner.append(b"".join(map(sha.packed, values)))
                states.append(b"".join(map(sha.packed, kept)))
                tops.append(sha.packed(level))
            columns = [batch.column(c) for c in ("g", "piece", "m", "nodes")] + [pa.array(c, pa.binary()) for c in (inner, states, tops)]
            yield pa.RecordBatch.from_arrays(columns, ["g", "piece", "m", "nodes", "inner", "states", "top"])

    return run


def _values(nodes: pa.StructArray) -> np.ndarray:
    """Values of a piece's nodes in the order of their places."""
    order = np.argsort(nodes.field("pos").to_numpy(zero_copy_only=False))
    return sha.unpacked(b"".join(nodes.field("value").to_pylist()))[:, order]


def _rounds(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """Rounds of trees over (g, pos, m, value, kept), until each group is one node."""
    levels = _piece_levels(arity)
    size = arity**levels
    most = nodes.agg(F.max("m")).first()[0] or 1
    rounds = []
    while True:
        members = F.collect_list(F.struct("pos", "value", *(["kept"] if not rounds else [])))
        pieces = nodes.groupBy("g", F.expr(f"pos div {size}").alias("piece"), "m").agg(members.alias("nodes"))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", inner binary, states binary, top binary"
        rounds.append(written(small_batches(pieces).mapInArrow(_pieces(arity, levels), schema), "merkle"))
        if most <= size:
            return rounds
        most = -(-most // size)
        # A group of one piece has its top already; it goes along as a tree of one node.
        nodes = rounds[-1].select("g", F.col("piece").alias("pos"), F.expr(f"(m + {size - 1}) div {size}").alias("m"), F.col("top").alias("value"))


def build(rows: DataFrame, group: str, order: Sequence[str], leaf: str, carry: Sequence[str] = (), arity: int = 2) -> Manifest:
    """Manifest of ``rows``: a tree for each value of ``group`` over its rows by ``order``, and the tree above them.

    ``leaf`` names the rows' hex digests.  ``carry`` columns stay with the leaves, for ``fold``.  Nulls come first, in groups as in the
    order; groups are ordered by the bytes of their text.  Rows that are equal by the order are ordered by digest; equal rows are a leaf
    each.  No rows: the root is None.  Other columns of ``rows``, whatever their names, take no part.
    """
    if not 2 <= arity <= 255:
        raise ValueError("a parent has 2 to 255 children")
    if clash := set(carry) & {*RESULTS}:
        raise ValueError(f"names of the result: {sorted(clash)}")
    by = [f"o{k}" for k in range(len(order))]
    text = F.col(f"`{group}`").cast("string")
    nodes = rows.select(
        F.coalesce(F.concat(F.lit("="), text), F.lit("")).alias("g"),
        *(F.col(f"`{c}`").alias(o) for c, o in zip(order, by, strict=True)),
        F.unhex(F.col(f"`{leaf}`")).alias("value"),
        F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`").alias(c) for c in carry)).alias("kept"),
    )
    groups = _rounds(_placed(nodes, by), arity)
    tops = groups[-1].select(F.lit("").alias("g"), F.col("g").alias("o0"), F.col("top").alias("value"), F.struct("g").alias("kept"))
    above = _rounds(_placed(tops, ["o0"]), arity)
    last = above[-1].select(F.lower(F.hex("top"))).first()
    return Manifest(arity, list(carry), groups, above, last[0] if last else None)


class _Piece(NamedTuple):
    """A piece's levels of values (its nodes first), and its parents' states by level and slot."""

    values: list[np.ndarray]
    states: list[list[np.ndarray]]


def _read_piece(nodes: pa.StructArray, inner: bytes, states: bytes, arity: int) -> _Piece:
    values = [_values(nodes)]
    inner_words, state_words = sha.unpacked(inner), sha.unpacked(states)
    kept: list[list[np.ndarray]] = []
    at = state_at = 0
    while at < inner_words.shape[1]:
        runs = -(-values[-1].shape[1] // arity)
        values.append(inner_words[:, at : at + runs])
        slots = [sha.starts(runs)]
        for _ in range(1, arity):
            slots.append(state_words[:, state_at : state_at + runs])
            state_at += runs
        kept.append(slots)
        at += runs
    return _Piece(values, kept)


def _paths(arity: int, leaves: bool):
    """Arrow function: the path of every node of a piece, from its own parent to the root.

    A step of a path is the slot, the number of children, the parent's state before the slot and the values of the other children.
    """

    def run(batches):
        for batch in batches:
            keys, places, paths, subroots = [], [], [], []
            for row in range(batch.num_rows):
                nodes = batch.column("nodes")[row].values
                piece = _read_piece(nodes, batch.column("inner")[row].as_py(), batch.column("states")[row].as_py(), arity)
                rest = batch.column("path")[row].as_py()
                pos = np.sort(nodes.field("pos").to_numpy(zero_copy_only=False))
                values = [sha.packed(v) for v in piece.values]
                states = [[sha.packed(s) for s in slots] for slots in piece.states]
                for k in range(len(pos)):
                    path, i = [], k
                    for level, slots in enumerate(states):
                        run_of, slot = divmod(i, arity)
                        first, size = run_of * arity, len(values[level]) // 32
                        others = [values[level][32 * j : 32 * j + 32] for j in range(first, min(first + arity, size)) if j != i]
                        path.append(bytes([slot, len(others) + 1]) + slots[slot][32 * run_of : 32 * run_of + 32] + b"".join(others))
                        i = run_of
                    paths.append(path + rest)
                places.extend(pos.tolist())
                if leaves:
                    kept = sorted(zip(nodes.field("pos").to_pylist(), nodes.field("kept").to_pylist(), strict=True), key=lambda x: x[0])
                    keys.extend(x["g"] for _, x in kept)
                    subroots.extend(values[0][32 * k : 32 * k + 32] for k in range(len(pos)))
                else:
                    keys.extend([batch.column("g")[row].as_py()] * len(pos))
                    subroots.extend([batch.column("subroot")[row].as_py()] * len(pos))
            out = [pa.array(keys, pa.string()), pa.array([0] * len(keys) if leaves else places, pa.int64())]
            out += [pa.array(paths, pa.list_(pa.binary())), pa.array(subroots, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["g", "piece", "path", "subroot"])

    return run


def _fold_piece(piece: _Piece, path: list[bytes], value: np.ndarray, arity: int) -> tuple[np.ndarray, np.ndarray]:
    """(root, digest of the siblings) for each leaf of a piece, with ``value`` in its place."""
    n = value.shape[1]
    proof, blocks = sha.starts(n), np.zeros(n, np.int64)
    node = np.arange(n)
    for values, slots in zip(piece.values, piece.states):
        run_of, slot = np.divmod(node, arity)
        count = np.minimum(arity, values.shape[1] - run_of * arity)
        state = np.empty((8, n), np.uint32)
        for s in range(arity):
            own = slot == s
            state[:, own] = slots[s][:, run_of[own]]
        state = sha.absorb(state, value)
        for s in range(arity):
            # What is to the right of the changed child goes on with the state; proofs take all others.
            other = np.flatnonzero((slot != s) & (s < count))
            right = other[slot[other] < s]
            both = np.concatenate([other, right])
            after = sha.absorb(np.concatenate([proof[:, other], state[:, right]], axis=1), values[:, run_of[both] * arity + s])
            proof[:, other], state[:, right] = after[:, : len(other)], after[:, len(other) :]
            blocks[other] += 1
        value, node = sha.finish(state, count), run_of
    for step in path:
        slot, count = step[0], step[1]
        others = sha.unpacked(step[34:])
        state = sha.absorb(np.repeat(sha.unpacked(step[2:34]), n, axis=1), value)
        for s in range(count - 1):
            # The siblings are the same for all leaves of the piece.
            both = np.concatenate([proof, state], axis=1) if s >= slot else proof
            after = sha.absorb(both, np.repeat(others[:, s : s + 1], both.shape[1], axis=1))
            proof, state = after[:, :n], after[:, n:] if s >= slot else state
        blocks += count - 1
        value = sha.finish(state, count)
    return value, sha.finish(proof, blocks)


def _hex(words: np.ndarray) -> list[str]:
    text = sha.packed(words).hex()
    return [text[64 * k : 64 * k + 64] for k in range(len(text) // 64)]


def _folds(arity: int, root: bytes, changed: str | None):
    def run(batches):
        for batch in batches:
            kept, out = [], [[] for _ in RESULTS]
            for row in range(batch.num_rows):
                nodes = batch.column("nodes")[row].values
                piece = _read_piece(nodes, batch.column("inner")[row].as_py(), batch.column("states")[row].as_py(), arity)
                order = np.argsort(nodes.field("pos").to_numpy(zero_copy_only=False))
                carried = nodes.field("kept").take(pa.array(order))
                own, value = piece.values[0], piece.values[0].copy()
                if changed:
                    new = carried.field(changed)
                    at = np.flatnonzero(~np.asarray(new.is_null()))
                    if len(at):
                        value[:, at] = sha.unpacked(bytes.fromhex("".join(new.drop_null().to_pylist())))
                folded, proof = _fold_piece(piece, batch.column("path")[row].as_py(), value, arity)
                n = own.shape[1]
                kept.append(carried)
                columns = [_hex(own), [batch.column("subroot")[row].as_py().hex()] * n, [root.hex()] * n, _hex(proof), _hex(folded)]
                columns.append([x == root.hex() for x in columns[-1]])
                for all_of, some in zip(out, columns, strict=True):
                    all_of.extend(some)
            if not kept:
                continue
            types = [pa.string()] * 5 + [pa.bool_()]
            arrays = [pa.concat_arrays(kept), *(pa.array(c, t) for c, t in zip(out, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["kept", *RESULTS])

    return run


def fold(manifest: Manifest, changed: str | None = None) -> DataFrame:
    """Carried columns, leaf, subroot, root, proof_sha256, folded_root, verified: each leaf folded into the root by itself.

    ``changed`` names a carried column with the hex digest to fold in instead of the leaf; null leaves it as it is.  ``proof_sha256`` is
    the digest of the siblings' values, from the leaf's run up to the root's, left to right in a run.  The other leaves
    are the manifest's: each row shows what a change of this one row alone would do.
    """
    spark, arity = manifest.groups[0].sparkSession, manifest.arity
    schema = "g string, piece long, path array<binary>, subroot binary"
    paths = spark.createDataFrame([("", 0, [], None)], schema)
    for rounds, leaves in ((manifest.above, True), (manifest.groups[1:], False)):
        for k in reversed(range(len(rounds))):
            joined = rounds[k].join(bounded(paths, PATHS), ["g", "piece"])
            paths = written(small_batches(joined).mapInArrow(_paths(arity, leaves and k == 0), schema), "paths")
    pieces = manifest.groups[0].join(bounded(paths, PATHS), ["g", "piece"])
    nodes = pieces.schema["nodes"].dataType.elementType
    schema = f"kept {nodes['kept'].dataType.simpleString()}, " + ", ".join(f"{c} {'boolean' if c == 'verified' else 'string'}" for c in RESULTS)
    root = bytes.fromhex(manifest.root or "")
    folded = small_batches(pieces).mapInArrow(_folds(arity, root, changed), schema)
    return folded.select(*(F.col(f"kept.`{c}`").alias(c) for c in manifest.carried), *RESULTS)


#: Levels that the SQL follows: groups of up to 2**24 rows, 2**10 groups.
SQL_LEVELS, SQL_TOP = 24, 10


def _tree_sql(name: str, source: str, levels: int) -> str:
    """Tables ``name``0 and up: (g, i, n, d), the nodes of each level; ``n`` is the group's size at the bottom."""
    tables = [f"{name}0 AS MATERIALIZED ({source})"]
    for k in range(levels):
        one = f"(n + {2**k - 1}) // {2**k} = 1"
        tables.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT g, i // 2 AS i, n, CASE WHEN {one} THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d"
            f" FROM {name}{k} GROUP BY g, i // 2, n)"
        )
    return ",\n".join(tables)


def _walk_sql(name: str, tree: str, source: str, levels: int) -> str:
    """Tables ``name``0 and up: (doc_id, leaf, lang_key, g, i, n, f, proof), every leaf's value and siblings on its way up."""
    tables = [f"{name}0 AS ({source})"]
    for k in range(levels):
        one = f"(w.n + {2**k - 1}) // {2**k} = 1"
        tables.append(
            f"{name}{k + 1} AS (SELECT w.* REPLACE (w.i // 2 AS i, CASE WHEN {one} THEN w.f WHEN s.d IS NULL THEN sha256(w.f)"
            f" WHEN w.i % 2 = 0 THEN sha256(w.f || s.d) ELSE sha256(s.d || w.f) END AS f, w.proof || CASE WHEN {one} THEN '' ELSE coalesce(s.d, '') END AS proof)"
            f" FROM {name}{k} w LEFT JOIN {tree}{k} s ON s.g = w.g AND s.i = xor(w.i, 1))"
        )
    return ",\n".join(tables)


def _leaf_sql(n_chars: str) -> str:
    def part(c: str) -> str:
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"

    return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: The standard CRC-32 by its table, over the digits of an id.
MANIFEST_SQL = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, j: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf_sql("n_chars")} AS leaf,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295) % 7 = 0 AS hit,
    {_leaf_sql("(n_chars + 1)")} AS other
  FROM documents, crc_table),
placed AS MATERIALIZED (
  SELECT doc_id, g, leaf, CASE WHEN hit THEN other ELSE leaf END AS f,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n
  FROM leaves),
{_tree_sql("t", "SELECT g, i, n, leaf AS d FROM placed", SQL_LEVELS)},
{_tree_sql("u", f"SELECT '' AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n, d FROM t{SQL_LEVELS}", SQL_TOP)},
tops AS (SELECT g, d, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM t{SQL_LEVELS}),
{_walk_sql("w", "t", "SELECT doc_id, leaf, g AS own, g, i, n, f, '' AS proof FROM placed", SQL_LEVELS)},
{_walk_sql("v", "u", f"SELECT w.* REPLACE ('' AS g, tops.i AS i, tops.n AS n) FROM w{SQL_LEVELS} w JOIN tops ON tops.g = w.own", SQL_TOP)}
SELECT v.doc_id, v.leaf, tops.d AS subroot, u.d AS root, sha256(v.proof) AS proof_sha256, v.f AS folded_root, v.f = u.d AS verified
FROM v{SQL_TOP} v JOIN tops ON tops.g = v.own CROSS JOIN u{SQL_TOP} u
"""
