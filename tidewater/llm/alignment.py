"""Alignment of two tokenizers over the same texts, by divide and conquer at shared cuts.

Both tokenizers cut the bytes of a blank and the text.  Where a token of each ends at the same byte is a shared cut.  A stretch between
two shared cuts is divided: the token end of the first tokenizer nearest its middle that the second has too, looked up by bisection, cuts it in
two, and both halves are divided in turn; a stretch without an inner shared cut is a group.  The stretches of all texts of a block
are divided at once, level by level.

A link is a pair of token occurrences, one of each tokenizer, whose bytes overlap; a corpus-wide count of the linked pairs of ids
tells how usual a link is.
"""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BROADCAST_ROWS, bounded, small_batches
from tidewater.llm.tokens import _pieces
from tidewater.session import written

#: Bytes of text that are divided together.
BLOCK = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies write for bytes: printable ones stand for themselves, the others for 256 and up in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE vocabulary file (JSON with vocab and merges).  Strings of special tokens are plain text.

    Where ids follow the order of the merges, as they do where a vocabulary is written in the order it was learned, an id is its merge's
    rank and the ranked encoder is used, which is several times faster; else the file's own encoder is.
    """

    def __init__(self, path: str, pattern: str):
        self.text, self.pattern = Path(path).read_text("utf-8"), pattern

    def open(self):
        """(function from a text to the ids of a blank and the text, bytes of each id)."""
        data, alphabet = json.loads(self.text), byte_alphabet()
        vocab = data["model"]["vocab"]
        entries = [b""] * (max([*vocab.values(), *(t["id"] for t in data["added_tokens"])]) + 1)
        for token, i in vocab.items():
            entries[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        special = {t["content"] for t in data["added_tokens"]}
        if [vocab.get(a + b) for a, b in merges] == [*range(256, 256 + len(merges))]:
            import tiktoken

            ranks = {entries[i]: i for token, i in vocab.items() if token not in special}
            encoding = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
            return lambda text: encoding.encode_to_numpy(" " + text, disallowed_special=()), entries
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(self.text)
        tokenizer.encode_special_tokens = True
        return lambda text: tokenizer.encode(" " + text, add_special_tokens=False).ids, entries


class Pieces:
    """A sentence-piece model file.  It adds the blank before the text by itself."""

    def __init__(self, path: str):
        self.model = Path(path).read_bytes()

    def open(self):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=self.model)

        def entry(i: int) -> bytes:
            piece = model.id_to_piece(i)
            return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

        return lambda text: model.encode(text, num_threads=1), [entry(i) for i in range(model.get_piece_size())]


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Numbers of the first tokenizer's tokens that end where one of the second ends, in order.

    ``ends_a`` and ``ends_b`` increase; each stretch ``lo`` to ``hi`` of the first's tokens starts and ends at shared cuts.
    """
    cuts = [hi - 1]
    while len(lo):
        inner = hi - lo > 1
        lo, hi = lo[inner], hi[inner]
        middle = (lo + hi - 2) // 2
        found = np.full(len(lo), -1)
        active, distance = np.arange(len(lo)), 0
        while len(active):
            for way in (-1, 1) if distance else (1,):
                at = middle[active] + way * distance
                inside = (at >= lo[active]) & (at < hi[active] - 1) & (found[active] < 0)
                own, end = active[inside], ends_a[at[inside]]
                # The last ends are shared, so that there is always an end at or after this one.
                hit = ends_b[np.searchsorted(ends_b, end)] == end
                found[own[hit]] = at[inside][hit]
            distance += 1
            left = (middle[active] - distance >= lo[active]) | (middle[active] + distance < hi[active] - 1)
            active = active[left & (found[active] < 0)]
        divided = found >= 0
        lo, hi, at = lo[divided], hi[divided], found[divided]
        cuts.append(at)
        lo, hi = np.concatenate([lo, at + 1]), np.concatenate([at + 1, hi])
    return np.sort(np.concatenate(cuts))


class _Side:
    """Tokens of one tokenizer in a block of texts."""

    def __init__(self, encode, entries: list[bytes]):
        self.encode, self.entries = encode, entries
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.spelling, self.offsets = np.frombuffer(b"".join(entries), np.uint8), np.cumsum(self.lengths) - self.lengths
        # What is written for a token before another of its own, before the other side, and at the end of a group.
        self.written = [f"{i}{mark}" for i in range(len(entries)) for mark in ",|;"]

    def ids(self, text: str, data: np.ndarray) -> np.ndarray | None:
        """Ids of a blank and the text; None if the tokens do not spell its bytes."""
        # Pieces after the first begin with a blank of their own, which the encoder adds.
        found = [np.asarray(self.encode(piece[1:] if k else piece), np.int64) for k, piece in enumerate(_pieces(text))]
        ids = found[0] if len(found) == 1 else np.concatenate(found)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids) or ends[-1] != len(data):
            return None
        spelt = self.spelling[np.repeat(self.offsets[ids] - ends + lengths, lengths) + np.arange(len(data))]
        return ids if (spelt == data).all() else None


def align_block(texts: list[str], a: _Side, b: _Side) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text; pairs are ids of a times 2**32 plus ids of b."""
    out: list[tuple] = [(0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
    rows, ids_a, ids_b = [], [], []
    for k, text in enumerate(texts):
        if text:
            data = np.frombuffer((" " + text).encode("utf-8", "surrogatepass"), np.uint8)
            own_a = a.ids(text, data)
            own_b = b.ids(text, data) if own_a is not None else None
            if own_b is not None:
                rows.append(k), ids_a.append(own_a), ids_b.append(own_b)
    if not rows:
        return out
    n_a, n_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
    all_a, all_b = np.concatenate(ids_a), np.concatenate(ids_b)
    ends_a, ends_b = np.cumsum(a.lengths[all_a]), np.cumsum(b.lengths[all_b])
    stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
    cuts = shared_cuts(ends_a, ends_b, stop_a - n_a, stop_a.copy())
    cuts_b = np.searchsorted(ends_b, ends_a[cuts])
    mark_a, mark_b = np.zeros(len(all_a), np.int64), np.zeros(len(all_b), np.int64)
    mark_a[cuts], mark_b[cuts_b] = 1, 2
    # Every stretch between neighbouring ends of any side is one link: ends in order, with how many of each side came before.
    every = np.concatenate([ends_a, ends_b[mark_b == 0]])
    order = np.argsort(every, kind="stable")
    every, of_a = every[order], order < len(ends_a)
    of_b = np.append(mark_a == 1, np.ones(len(every) - len(ends_a), bool))[order]
    pairs = all_a[np.cumsum(of_a) - of_a] << 32 | all_b[np.cumsum(of_b) - of_b]
    # Text of the groups: tokens in order of group, then side.
    group_a, group_b = np.cumsum(mark_a) - mark_a, (np.cumsum(mark_b) - mark_b) // 2
    codes = np.concatenate([all_a * 3 + mark_a, all_b * 3 + mark_b + 3 * len(a.entries)])
    order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
    table = a.written + b.written
    marked = codes[order].tolist()
    last_group = np.searchsorted(cuts, stop_a - 1)
    ends = ends_a[stop_a - 1]
    last_link = np.searchsorted(every, ends)
    token = group = link = 0
    for r, k in enumerate(rows):
        stop = int(stop_a[r] + stop_b[r])
        groups = "".join(map(table.__getitem__, marked[token:stop]))[:-1]
        own, times = np.unique(pairs[link : last_link[r] + 1], return_counts=True)
        out[k] = (int(n_a[r]), int(n_b[r]), int(last_group[r] + 1 - group), int(last_link[r] + 1 - link), groups, own, times)
        token, group, link = stop, int(last_group[r] + 1), int(last_link[r] + 1)
    return out


def align(docs: DataFrame, first: ByteLevel | Pieces, second: ByteLevel | Pieces) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs): the alignment of each text.

    ``docs`` has doc_id and text; other columns take no part.  ``groups`` reads ``a1,a2|b1;a3|b2,b3``: ids of both sides, group by group.  ``pairs`` are (a, b,
    times): how many of the text's links join these ids.  A null or empty text, and one whose tokens of either side do not spell a blank and the text, has no
    tokens: zeros and ''.  Null ids are kept, repeated rows are a row each.  Very long texts are encoded piece by piece, cut only where both
    tokenizers begin a token in any case: before a single blank between two other characters.
    """
    sent = docs.sparkSession.sparkContext.broadcast((first, second))

    def run(batches):
        a, b = (_Side(*tokenizer.open()) for tokenizer in sent.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids, done = batch.column("doc_id"), 0
            while done < len(texts):
                stop, size = done, 0
                while stop < len(texts) and (size < BLOCK or stop == done):
                    size, stop = size + len(texts[stop] or ""), stop + 1
                found = align_block(texts[done:stop], a, b)
                counts = [pa.array([f[k] for f in found], pa.int64()) for k in range(4)]
                offsets = np.append(0, np.cumsum([len(f[5]) for f in found])).astype(np.int32)
                codes = np.concatenate([f[5] for f in found])
                parts = [codes >> 32, codes & 0xFFFFFFFF, np.concatenate([f[6] for f in found])]
                pairs = pa.StructArray.from_arrays([pa.array(p, pa.int64()) for p in parts], ["a", "b", "times"])
                columns = [ids.slice(done, stop - done), *counts, pa.array([f[4] for f in found], pa.string()), pa.ListArray.from_arrays(pa.array(offsets), pairs)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"])
                done = stop

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<struct<a:long,b:long,times:long>>"
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): links of each pair of ids in the whole corpus; ``best`` where no other ``a`` is linked with ``b`` more often.

    Links are counted by document, then by task, before they are shuffled.  A written table.
    """
    counts = aligned.select(F.inline("pairs")).groupBy("a", "b").agg(F.sum("times").alias("n"))
    counts = written(counts, "pair-counts")
    # One row for each id of the second vocabulary.
    most = written(counts.groupBy("b").agg(F.max("n").alias("most")), "most")
    return written(counts.join(bounded(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def usual_links(aligned: DataFrame, row: str, counts: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) of the rows that have links: links whose pair is its second id's most frequent, and the sum of the links' counts.

    Pairs of the corpus are few and links many: the most frequent pairs, as many as may be broadcast, are looked up where the
    links are; only links of rarer pairs, whose every pair is rare, are shuffled.
    """
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).count().orderBy(F.desc("power")).collect()
    power, rows = None, 0
    for size in sizes:
        rows += size["count"]
        if rows > BROADCAST_ROWS:
            break
        power = size["power"]
    frequent = F.floor(F.log2("n")) >= power if power is not None else F.lit(False)
    links = aligned.select(row, F.inline("pairs"))
    found = links.join(F.broadcast(counts.filter(frequent)), ["a", "b"], "left")
    known = found.filter("n is not null")
    if rows > BROADCAST_ROWS:
        rare = found.filter("n is null").select(row, "a", "b", "times").join(counts.filter(~frequent), ["a", "b"])
        known = known.unionByName(rare)
    return known.groupBy(row).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
