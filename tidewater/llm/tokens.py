"""Token counts by offset-mapped attribution.

A document is encoded once, as a whole.  Each token's span in code points follows from the
lengths of the tokens in bytes; an interval join puts the tokens into the document's sections (fields or lines), and
a token that crosses a boundary is allocated by a stated rule.

Rules: ``first``: to the section of its first character; ``most``: to the one with most of its characters, the earlier on a
tie; ``share``: to each by its share of the characters.  A token of which only some bytes of a character are its own
covers that whole character.
"""

from __future__ import annotations

import base64
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches

RULES = ("first", "most", "share")
#: Characters encoded at a time; cuts are made only where the tokenizer must begin a new piece.
PIECE = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file of a byte-level tokenizer: a base-64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in Path(path).read_bytes().splitlines() if line)}


def _pieces(text: str):
    """``text`` cut before single blanks between two other characters, where a new piece begins in any case."""
    start = 0
    while len(text) - start > PIECE:
        at = start + PIECE
        while (at := text.find(" ", at)) >= 0 and (at + 1 >= len(text) or text[at - 1].isspace() or text[at + 1].isspace()):
            at += 1
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def token_spans(text: str, encoding, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last code point of each token of ``text``."""
    starts, ends, at = [], [], 0
    for piece in _pieces(text):
        ids = np.array(encoding.encode_ordinary(piece), np.int64)
        stop = np.cumsum(lengths[ids])
        lead = stop - lengths[ids]
        data = np.frombuffer(piece.encode("utf-8", "surrogatepass"), np.uint8)
        if len(data) == len(piece):
            starts.append(lead + at), ends.append(stop + at)
        else:
            char = np.cumsum((data & 0xC0) != 0x80) - 1
            starts.append(char[lead] + at), ends.append(char[stop - 1] + 1 + at)
        at += len(piece)
    return np.concatenate(starts), np.concatenate(ends)


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines as sections; each has its line feed, so they tile the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(codes == 10) + 1
    if not len(ends) or ends[-1] < len(codes):
        ends = np.append(ends, len(codes))
    return np.append(0, ends[:-1]), ends


def allocate(starts: np.ndarray, ends: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, float]:
    """(tokens of each section, tokens that touch it and cross its edge, tokens of no section).

    Sections are sorted and do not overlap; they need not tile the text.
    """
    first = np.searchsorted(hi, starts, "right")  # sections that a token touches: first to last - 1
    last = np.searchsorted(lo, ends, "left")
    touched = np.maximum(last - first, 0)
    token = np.repeat(np.arange(len(starts)), touched)
    section = np.repeat(first, touched) + np.arange(len(token)) - np.repeat(np.cumsum(touched) - touched, touched)
    common = np.minimum(ends[token], hi[section]) - np.maximum(starts[token], lo[section])
    real = common > 0
    token, section, common = token[real], section[real], common[real]
    whole = (ends - starts)[token]
    crossing = np.bincount(section[common < whole], minlength=len(lo))
    if rule == "share":
        counts = np.bincount(section, common / whole, minlength=len(lo))
    else:
        if rule == "first":
            chosen = starts[token] >= lo[section]
        else:
            order = np.lexsort((section, -common, token))
            head = np.append(True, token[order][1:] != token[order][:-1]) if len(order) else np.zeros(0, bool)
            chosen = np.zeros(len(token), bool)
            chosen[order[head]] = True
        counts = np.bincount(section[chosen], minlength=len(lo)).astype(float)
    return counts, crossing, float(len(starts) - counts.sum())


def attribute(docs: DataFrame, vocabulary: str, pattern: str, rule: str = "first", sections: str | None = None) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing, doc_tokens): tokens of each section of each document.

    ``docs`` has doc_id and text; ``sections`` names a column of structs (start, end) in code
    points, sorted and without overlap; without it the lines are taken.  ``vocabulary`` is a local file of
    the driver; it is sent to the executors.  ``n_tokens`` is fractional under ``share`` alone.  Tokens of
    no section are in a row with section -1 and null bounds, if there are any.  A null or empty text gives one row of section 0 from 0 to
    0 without tokens.  Null ids are kept; repeated rows are counted each.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    sent = docs.sparkSession.sparkContext.broadcast((read_ranks(vocabulary), pattern))
    columns = [F.col("doc_id").cast("long").alias("doc_id"), "text", *([F.col(sections).alias("sections")] if sections else [])]

    def run(batches):
        import tiktoken

        ranks, split = sent.value
        encoding = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            ids = batch.column("doc_id").to_pylist()
            for k, (doc_id, value) in enumerate(zip(ids, batch.column("text"), strict=True)):
                text = value.as_py() or ""
                if sections:
                    own = batch.column("sections")[k].as_py() or []
                    lo, hi = np.array([s["start"] for s in own], np.int64), np.array([s["end"] for s in own], np.int64)
                else:
                    lo, hi = line_sections(text)
                starts, ends = token_spans(text, encoding, lengths) if text else (np.zeros(0, np.int64),) * 2
                counts, crossing, rest = allocate(starts, ends, lo, hi, rule)
                rows = [range(len(lo)), lo.tolist(), hi.tolist(), counts.tolist(), crossing.tolist()]
                if rest > 1e-9:
                    rows = [[*x, y] for x, y in zip(rows, (-1, None, None, rest, 0), strict=True)]
                n = len(rows[1])
                for column, values in zip(out, [[doc_id] * n, *rows, [len(starts)] * n], strict=True):
                    column.extend(values)
            kinds = [pa.int64()] * 4 + [pa.float64()] + [pa.int64()] * 2
            names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return small_batches(docs).select(*columns).mapInArrow(run, "doc_id long, section long, start long, end long, n_tokens double, n_crossing long, doc_tokens long")
