"""Repeated passages by paragraph MinHash banding.

A paragraph is a stretch of text between sentence or line ends with at least ``min_words``
words.  Paragraphs that small are found again wherever a passage was pasted, also in the middle of a line.
A shorter stretch is compared word for word together with its neighbours: with the fewest that follow, and the
fewest that precede it, so that ``min_words`` are reached.  So each stretch of a pasted passage lies in such a unit inside the passage.
A stretch of over ``long_words`` words is cut by content: after every word whose hash is the least of some ``cut_words`` words in a row.  A
passage without any sentence end, pasted into the middle of other sentences, is cut alike wherever it stands, but for ``cut_words - 1`` words at its edges.
Its set of five-word shingles gets MinHash values, and bands of them are the keys of a join.
Colliding paragraphs of different wording are verified by the exact Jaccard similarity, and components
of the links are the clusters; of each cluster the first paragraph (least id, then place) is kept.
Equal paragraphs are one node from the start, so a passage in thousands of documents is one row.

All tables hold hashes; texts are read again for what is reported.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewater.llm.common import bounded, small_batches
from tidewater.llm.components import connected_components
from tidewater.llm.words import blocks, mix, parity_marks, shingles
from tidewater.session import written


def tune_bands(percent: int, recall: float, most: int = 40) -> tuple[int, int]:
    """(bands, rows) with the fewest bands whose chance to find a pair of the given similarity is at least ``recall``; of those, the most rows."""
    t = percent / 100
    for bands in range(1, most + 1):
        rows = [r for r in range(1, 9) if 1 - (1 - t**r) ** bands >= recall]
        if rows and max(rows) >= 2:
            return bands, max(rows)
    raise ValueError("no such bands")


@dataclass(frozen=True)
class Rule:
    words: int = 5
    percent: int = 80
    recall: float = 0.95
    #: Words of the least paragraph, and of the least passage that is reported.
    min_words: int = 8
    min_passage: int = 20
    #: Stretches of more words are cut by content, at least once in so many words.
    long_words: int = 40
    cut_words: int = 10


def content_cuts(hashes: np.ndarray, group: np.ndarray, chosen: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the words that are least among some ``width`` words in a row of one chosen group: the last of equal ones.

    ``chosen`` tells for each word whether its group is cut.
    """
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    # Two words in a row: a frequent word alone would be least too often, or never.
    pair = mix(hashes ^ mix(np.append(hashes[:1], hashes[:-1])))
    at = np.flatnonzero(chosen[: len(hashes) - width + 1] & (group[: len(hashes) - width + 1] == group[width - 1 :]))
    # The first pair of a group has a word of another one: it is never least.
    pair[np.flatnonzero(np.append(True, group[1:] != group[:-1]))] = np.iinfo(np.uint64).max
    least = np.lib.stride_tricks.sliding_window_view(pair, width)[at][:, ::-1].argmin(axis=1)
    return np.unique(at + width - 1 - least)


def _paragraphs(column: pa.Array, rule: Rule):
    """For each block of rows: row, number, start, end (bytes), n_words, content hash, shingles and the paragraph each belongs to.

    Letter case of A-Z does not count.
    """
    for words in blocks(column):
        if not len(words.hash):
            continue
        last = np.append(words.row[1:] != words.row[:-1], True)
        ends = words.ends_sentence | last
        group = np.cumsum(np.append(0, ends[:-1].astype(np.int64)))
        head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(head, len(group)))
        if (size > rule.long_words).any():
            ends = ends.copy()
            ends[content_cuts(words.hash, group, np.repeat(size > rule.long_words, size), rule.cut_words)] = True
            group = np.cumsum(np.append(0, ends[:-1].astype(np.int64)))
            head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            size = np.diff(np.append(head, len(group)))
        tokens, of = shingles(words.hash, group, rule.words)
        at = np.searchsorted(of, np.arange(len(head) + 1))
        shaped = mix(words.hash + mix((np.arange(len(group)) - np.repeat(head, size)).astype(np.uint64)))
        content = mix(np.add.reduceat(shaped, head) + size.astype(np.uint64))
        tail = head + size - 1
        yield words.row[head], words.start[head], words.end[tail], size, content, tokens, at


def _units(row: np.ndarray, size: np.ndarray, content: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, key) of the units around stretches under ``min_words`` words; each range of stretches once."""
    short = np.flatnonzero(size < rule.min_words)
    sums = np.append(0, np.cumsum(size))
    last = np.searchsorted(sums, sums[short] + rule.min_words) - 1
    first = np.searchsorted(sums, sums[short + 1] - rule.min_words, "right") - 1
    lo, hi = np.concatenate([short, first]), np.concatenate([last, short])
    fits = (lo >= 0) & (hi < len(size))
    lo, hi = lo[fits], hi[fits]
    same = row[lo] == row[hi]
    pairs = np.unique(lo[same] * (len(size) + 1) + hi[same])
    lo, hi = pairs // (len(size) + 1), pairs % (len(size) + 1)
    key = mix((hi - lo + 1).astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
    for k in range(rule.min_words):  # a unit has a word of each stretch at least
        on = lo + k <= hi
        key[on] = mix(key[on] * np.uint64(3) + content[lo[on] + k])
    return lo, hi, key


def _char_places(text: str, places: np.ndarray) -> np.ndarray:
    """Code point offsets of byte offsets of a text."""
    data = np.frombuffer(text.encode(), np.uint8)
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[places]


def band_keys(docs: DataFrame, rule: Rule) -> DataFrame:
    """(key, content) of every paragraph: its bands, and its content hash as a band of its own; of a unit its key alone."""
    bands, rows = tune_bands(rule.percent, rule.recall)
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches):
        for batch in batches:
            for row, _, _, size, content, tokens, at in _paragraphs(batch.column("text"), rule):
                use = np.flatnonzero(size >= rule.min_words)
                unit = pa.array(_units(row, size, content, rule)[2].view(np.int64))
                if len(unit):
                    yield pa.RecordBatch.from_arrays([unit, unit], ["key", "content"])
                if not len(use):
                    continue
                keys = [content[use]]
                low = [np.minimum.reduceat(tokens * s ^ (tokens * s >> np.uint64(29)), at[:-1])[use] for s in seeds]
                for b in range(bands):
                    key = np.full(len(use), b + 1, np.uint64)
                    for r in range(rows):
                        key = mix(key * np.uint64(3) + low[b * rows + r])
                    keys.append(key)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(content[use], len(keys)).view(np.int64))], ["key", "content"])

    return small_batches(docs).select("text").mapInArrow(run, "key long, content long")


#: Parity marks of a paragraph's shingles: a lower bound of the shingles in which two of them differ.
MARKS = [f"mark{k}" for k in range(4)]


def _contents(docs: DataFrame, rule: Rule, wanted: DataFrame) -> DataFrame:
    """(content, tokens, marks) of the wanted contents.

    Shingles are listed as they come; only what is wanted is made a set and marked.
    """

    def listed(batches):
        for batch in batches:
            for _, _, _, size, content, tokens, at in _paragraphs(batch.column("text"), rule):
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(tokens.view(np.int64)))
                use = pa.array(np.flatnonzero(size >= rule.min_words))
                yield pa.RecordBatch.from_arrays([pa.array(content.view(np.int64)).take(use), lists.take(use)], ["content", "tokens"])

    def marked(batches):
        for batch in batches:
            kept = [np.unique(np.asarray(x.values)) for x in batch.column("tokens")]
            flat = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, kept)]).astype(np.int32), flat)
            marks = np.array([parity_marks(x, 64 * len(MARKS)) for x in kept], np.int64).reshape(-1, len(MARKS))
            yield pa.RecordBatch.from_arrays([batch.column("content"), lists, *map(pa.array, marks.T.copy())], ["content", "tokens", *MARKS])

    found = small_batches(docs).select("text").mapInArrow(listed, "content long, tokens array<long>")
    found = found.join(bounded(wanted), "content", "left_semi").dropDuplicates(["content"])
    return found.mapInArrow(marked, "content long, tokens array<long>, " + ", ".join(f"{m} long" for m in MARKS))


def near_links(docs: DataFrame, rule: Rule, mixed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, parts) between contents that share a key of ``mixed``: verified links (a, b), and the components they make.

    First every bucket's contents are compared with its least one; what is still in different
    components and one bucket is compared after that, so no component misses a link; pairs whose parity
    marks already show too many differing shingles are dropped inside that join.
    """
    keys = band_keys(docs, rule).join(bounded(mixed), "key", "left_semi").distinct()
    keys = written(keys, "band-keys")
    wanted = written(keys.select("content").distinct(), "wanted")
    sets = written(_contents(docs, rule, wanted), "contents")
    marked = sets.select("content", F.size("tokens").alias("n"), *MARKS)
    keys = written(keys.join(marked, "content"), "band-keys")

    def verified(pairs: DataFrame) -> DataFrame:
        one = pairs.join(sets.select(F.col("content").alias("a"), F.col("tokens").alias("ta")), "a")
        two = one.join(sets.select(F.col("content").alias("b"), F.col("tokens").alias("tb")), "b")
        both = F.size(F.array_intersect("ta", "tb"))
        return two.filter(both * 100 >= (F.size("ta") + F.size("tb") - both) * rule.percent).select("a", "b")

    def sizes(x: str, y: str) -> str:
        return f"100 * least({x}, {y}) >= {rule.percent} * greatest({x}, {y})"

    least = keys.groupBy("key").agg(F.min(F.struct("content", "n")).alias("m")).select("key", F.col("m.content").alias("a"), F.col("m.n").alias("n_a"))
    spokes = keys.join(least, "key").filter(f"content <> a and {sizes('n', 'n_a')}").select("a", F.col("content").alias("b")).distinct()
    spokes = written(spokes, "spokes")
    first = written(verified(spokes), "links")
    parts = written(connected_components(first), "parts")
    named = keys.join(parts, F.col("content") == F.col("node"), "left").select("key", "content", "n", *MARKS, F.coalesce("component", "content").alias("part"))
    named = written(named, "named")
    apart = named.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("key")
    open_ = named.join(apart, "key", "left_semi")
    x, y = (open_.select("key", F.col("content").alias(c), F.col("n").alias(f"n_{c}"), F.col("part").alias(f"p_{c}"), *[F.col(m).alias(f"{m}_{c}") for m in MARKS]) for c in "ab")
    differ = " + ".join(f"bit_count({m}_a ^ {m}_b)" for m in MARKS)
    few = f"{100 + rule.percent} * ({differ}) <= {100 - rule.percent} * (n_a + n_b)"
    rest = x.join(y, "key").filter(f"a < b and p_a <> p_b and {sizes('n_a', 'n_b')} and {few}").select("a", "b").distinct().join(spokes, ["a", "b"], "left_anti")
    links = written(first.union(verified(rest)), "links")
    return links, written(connected_components(links), "parts")


def repeated_paragraphs(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, start, end, n_words, cluster, passage_words, removed): paragraphs, and shorter stretches, that repeat.

    ``start`` and ``end`` are code points, end exclusive; ``cluster`` names the component;
    ``passage_words`` counts the words of the repeated paragraphs that stand together, of which at least
    ``rule.min_passage`` are asked for; ``removed`` is false for the first paragraph of its cluster (least id, null last, then
    place).  A stretch of under ``rule.min_words`` words repeats if one of its units does; its cluster is its place in the
    unit that is found first of all, and it stays where any of its units is the first of its kind.  Documents without repeats don't appear.  A null text has no paragraph; null ids are kept;
    repeated rows repeat each other.  An empty table gives an empty result.
    """
    counted = band_keys(docs, rule).groupBy("key").agg(F.count("*").alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi")).filter("n > 1")
    counted = written(counted, "buckets")
    mixed = written(counted.filter("lo <> hi").select("key"), "mixed")
    _, parts = near_links(docs, rule, mixed)
    equal = counted.filter("key = lo and lo = hi").select(F.col("lo").alias("node"))
    known = parts.select("node", "component").unionByName(equal.join(parts, "node", "left_anti").withColumn("component", F.col("node")))
    known = written(known, "clusters")

    def run(batches):
        seen = 0
        for batch in batches:
            ids = batch.column("doc_id")
            texts = batch.column("text")
            for row, start, end, size, content, _, _ in _paragraphs(texts, rule):
                start, end = start.copy(), end.copy()
                edges = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                for a, b in zip(edges, np.append(edges[1:], len(row)), strict=True):
                    text = texts[int(row[a])].as_py()
                    if not text.isascii():
                        start[a:b], end[a:b] = _char_places(text, start[a:b]), _char_places(text, end[a:b])
                lo, hi, key = _units(row, size, content, rule)
                little = size < rule.min_words
                long = np.flatnonzero(~little)
                # The short stretches of a unit stand together: a long one ends it, or begins it.
                lead = (~little[lo]).astype(np.int64)
                first, last = np.concatenate([long, lo + lead]), np.concatenate([long, hi - ~little[hi]])
                many = last - first + 1
                at = np.concatenate([[0], np.cumsum(many)])
                part = np.repeat(first - at[:-1], many) + np.arange(at[-1])
                # Words of short stretches up to here, and long stretches up to here.
                words = np.append(0, np.cumsum(np.where(little, size, 0)))
                rank = np.cumsum(~little)
                lists = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x[part].astype(np.int32))) for x in (start, end, size)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(row[first])), pa.array(row[first] + seen), pa.array(rank[first]), pa.array(start[first]), pa.array(words[first]), pa.array(words[last + 1]), *lists,
                        pa.array(np.concatenate([content[long], key]).view(np.int64)), pa.array(np.concatenate([np.full(len(long), -1), lead])),
                    ],
                    ["doc_id", "row", "rank", "first", "before", "upto", "starts", "ends", "sizes", "content", "place"],
                )
            seen += len(texts)

    columns = "doc_id long, row long, rank long, first long, before long, upto long, starts array<int>, ends array<int>, sizes array<int>, content long, place long"
    found = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, columns)
    # One number for a row of the table: its task, and its place among the rows of that.
    found = found.withColumn("row", F.shiftleft(F.spark_partition_id().cast("long"), 40) + F.col("row"))
    hits = found.join(bounded(known), F.col("content") == F.col("node")).drop("content", "node")
    return _passages(hits, rule)


def _passages(hits: DataFrame, rule: Rule) -> DataFrame:
    """``hits`` has a row for each repeated long paragraph (``place`` -1) and for each repeated unit, with lists of its short stretches."""
    # Between repeats of one passage no long paragraph is left out: the long ones up to here less the repeated ones stay
    # the same.  A short stretch may stand in several units; its words count once, where the first of them has it.
    own = W.partitionBy("row").orderBy("first")
    seen = F.max(F.when(F.col("place") >= 0, F.col("upto"))).over(own.rowsBetween(W.unboundedPreceding, -1))
    more = F.greatest(F.lit(0), F.col("upto") - F.greatest("before", F.coalesce(seen, "before")))
    runs = hits.withColumn("words", F.when(F.col("place") < 0, F.col("sizes")[0]).otherwise(more))
    runs = runs.withColumn("run", F.col("rank") - F.sum((F.col("place") < 0).cast("long")).over(own.rowsBetween(W.unboundedPreceding, W.currentRow)))
    runs = runs.withColumn("passage_words", F.sum("words").over(W.partitionBy("row", "run"))).filter(f"passage_words >= {rule.min_passage}")
    runs = written(runs.select("doc_id", "row", "starts", "ends", "sizes", "place", "component", "passage_words"), "passages")
    first = runs.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "starts", "row")).alias("f"), F.count("*").alias("n")).filter("n > 1")
    first = written(first.select("component", F.col("f.doc_id").alias("f_doc_id"), F.col("f.starts").alias("f_starts"), F.col("f.row").alias("f_row")), "firsts")
    # Rows too wide and too many to broadcast: every repeated stretch has one.
    out = runs.join(first, "component")
    kept = (F.col("row") == F.col("f_row")) & (F.col("starts") == F.col("f_starts"))
    columns = ["doc_id", "start", "end", "n_words", "cluster", "passage_words", "removed"]

    def stretches(rows: DataFrame, *columns: Column) -> DataFrame:
        return rows.select("doc_id", *columns, *(F.col(f"s.{k}").cast("long").alias(v) for k, v in (("starts", "start"), ("ends", "end"), ("sizes", "n_words"))), "passage_words", (~kept).alias("removed"))

    listed = F.arrays_zip("starts", "ends", "sizes")
    long = stretches(out.filter("place < 0").withColumn("s", listed[0]), F.col("component").alias("cluster"))
    # A unit goes back to its document as one row; there its stretches are parted.
    units = out.filter("place >= 0").repartition("row").select("*", F.posexplode(listed).alias("k", "s"))
    where = F.struct(F.col("f_doc_id").isNull(), "f_doc_id", F.col("f_starts")[F.col("k")], "f_row", F.xxhash64("component", F.col("place") + F.col("k")).alias("cluster"))
    short = stretches(units, F.col("row"), where.alias("c"))
    short = short.groupBy("row", "start").agg(F.min("c").alias("c"), F.min("removed").alias("removed"), *(F.first(x).alias(x) for x in ("doc_id", "end", "n_words", "passage_words")))
    return long.select(*columns).unionByName(short.withColumn("cluster", F.col("c.cluster")).select(*columns))
