"""Language identification by mixture inference.

Each language is a multinomial over hashed letter trigrams, learned from labelled documents.
A document is a mixture of languages: expectation-maximisation estimates the
shares from the trigrams' likelihoods.  The set of languages is chosen by penalised
likelihood: from the best single language on, a language is added while the
log likelihood gains more than ``log(n) + 1`` for ``n`` trigrams.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches

UNKNOWN = "und"
_BITS = 16


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: Log probability of each trigram bucket, one row a language.
    log_p: np.ndarray


def _letters() -> np.ndarray:
    """Whether each code point of the basic plane is a letter; those beyond are looked up one by one."""
    return np.array([chr(c).isalpha() for c in range(1 << 16)])


def trigrams(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams around each letter; what is not a letter counts as a blank."""
    if not text:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    low = codes < 1 << 16
    is_letter = letters[np.where(low, codes, 0)]
    if not low.all():
        is_letter |= np.array([c >= 1 << 16 and chr(c).isalpha() for c in codes])
    codes = np.where(is_letter, codes, 0)
    mixed = codes[:-2] * np.uint32(0x9E3779B1) ^ codes[1:-1] * np.uint32(0x85EBCA77) ^ codes[2:] * np.uint32(0xC2B2AE3D)
    return (((mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - _BITS))[is_letter[1:-1]].astype(np.int64)


#: Parts that rows are thinned by.
_PARTS = 1_000_003


def held_out(doc_id: Column) -> Column:
    """CRC-32 of the id as text, modulo 4, is 2; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(labelled: DataFrame, sample: int = 4000) -> Model | None:
    """Learn from text and lang of ``labelled`` rows; about ``sample`` rows of a language at most.

    A language with more rows is thinned by a hash of all columns, id included, so that copies of one text are thinned like other rows; the row
    with the least hash always stays.  Only trigram counts come to
    the driver: 65,536 a language at most.  Rows with a null text or language teach nothing; without
    any row there is no model.
    """
    rows = labelled.filter("text is not null and lang is not null")
    rows = rows.select("text", "lang", F.pmod(F.xxhash64(*labelled.columns), F.lit(_PARTS)).alias("_part"))
    counts = {r.lang: r for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("_part").alias("least")).collect()}
    if not counts:
        return None
    part = F.create_map(*[F.lit(x) for lang, r in counts.items() for x in (lang, max(sample * _PARTS // r.n, r.least))])
    chosen = rows.filter(F.col("_part") <= F.element_at(part, F.col("lang"))).select("text", "lang")

    def run(batches):
        letters = _letters()
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                own = sums.setdefault(lang, np.zeros(1 << _BITS, np.int64))
                own += np.bincount(trigrams(text, letters), minlength=1 << _BITS)
            for lang, own in sums.items():
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])], ["lang", "gram", "n"])

    found = small_batches(chosen).mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = tuple(sorted(counts))
    sums = np.zeros((len(languages), 1 << _BITS))
    place = {lang: k for k, lang in enumerate(languages)}
    sums[[place[x] for x in found.column("lang").to_pylist()], found.column("gram").to_numpy()] = found.column("n").to_numpy()
    sums += 0.05
    return Model(languages, np.log(sums / sums.sum(1, keepdims=True)))


def _shares(p: np.ndarray, n: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Expectation-maximisation: shares of the languages (rows of ``p``) and the log likelihood."""
    share = np.full(len(p), 1 / len(p))
    total = n.sum()
    for _ in range(rounds):
        mixed = share @ p
        new = share * (p @ (n / mixed)) / total
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return share, float(n @ np.log(share @ p))


def _bound(p: np.ndarray, n: np.ndarray, rounds: int = 8) -> float:
    """A log likelihood that no shares of these languages exceed.

    The likelihood is concave in the shares, so its tangent at any shares bounds it; after a few rounds the tangent is near.
    """
    share, likelihood = _shares(p, n, rounds)
    return likelihood + float((p @ (n / (share @ p))).max() - n.sum())


def infer(model: Model, grams: np.ndarray) -> tuple[list[tuple[str, float]], float]:
    """[(language, share)] by falling share, then name, and the gain per trigram over chance in nats.

    ``grams`` must not be empty.
    """
    at, n = np.unique(grams, return_counts=True)
    logs = model.log_p[:, at]
    single = logs @ n
    chosen = [int(single.argmax())]
    best, share = float(single[chosen[0]]), np.ones(1)
    penalty = np.log(n.sum()) + 1
    if len(single) > 1:
        scaled = np.exp(logs - logs.max(0))
        base = float(n @ logs.max(0))
        bound = _bound(scaled, n)
        # No set of languages is worth a penalty more if all of them together are not.
        while len(chosen) < len(single) and bound + base - best > penalty:
            tries = [(_shares(scaled[[*chosen, k]], n), k) for k in range(len(single)) if k not in chosen]
            (new, likelihood), k = max(tries, key=lambda x: x[0][1])
            if likelihood + base - best <= penalty:
                break
            chosen, share, best = [*chosen, k], new, likelihood + base
    found = sorted(((model.languages[k], float(s)) for k, s in zip(chosen, share, strict=True)), key=lambda x: (-x[1], x[0]))
    return found, best / int(n.sum()) + _BITS * float(np.log(2))


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, lang_pred, score, gain and languages (lang, share) of every row.

    ``score`` is the share of the language found; ``gain`` how much better than chance the mixture gives a
    trigram, in nats.  A null text, or one without a letter, is ``und`` with score 0, gain 0 and no
    languages; so is all without a model.  Columns of these names cannot be kept and are refused.  Whole texts are read; a text is one task's memory at most.
    """
    if clash := {*keep} & {"lang_pred", "score", "gain", "languages", "_text"}:
        raise ValueError(f"names of the result: {sorted(clash)}")
    sent = docs.sparkSession.sparkContext.broadcast(model and (model.languages, model.log_p))
    kept = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches):
        letters, m = _letters(), sent.value and Model(*sent.value)
        for batch in batches:
            out: dict[str, list] = {"lang_pred": [], "score": [], "gain": [], "languages": []}
            for text in batch.column("_text"):
                grams = trigrams(text.as_py(), letters)
                found, gain = infer(m, grams) if m is not None and len(grams) else ([], 0.0)
                out["lang_pred"].append(found[0][0] if found else UNKNOWN)
                out["score"].append(min(1.0, found[0][1]) if found else 0.0)
                out["gain"].append(gain)
                out["languages"].append([{"lang": x, "share": s} for x, s in found])
            kinds = {"lang_pred": pa.string(), "score": pa.float64(), "gain": pa.float64(), "languages": pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))}
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(out[c], kinds[c]) for c in kinds]], [*keep, *kinds])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "_text")
    return small_batches(kept).mapInArrow(run, f"{schema}, lang_pred string, score double, gain double, languages array<struct<lang string, share double>>")
