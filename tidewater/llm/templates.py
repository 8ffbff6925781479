"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, and a run of names or of numbers one placeholder, so that a question asked again with
other numbers or names has the same template.  Windows of template words, at every word of items and documents, meet in a hash
join.  An item's windows are no longer than the run that any one changed, added or missing word must leave whole, which is half of the item: seven words, of short items four.
From where a window agrees, item and document are aligned in both directions, a few words more or fewer allowed, and the item is found where
enough of its words agree in order and its slots are consistent: one value of the item is always replaced by one and the same value of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded
from tidewater.session import written

#: Words of the windows of items that have twice as many, and of shorter ones.  Each length costs a pass over the documents' words.
LONG, SHORT = 7, 4
WINDOW = 8
#: Items of fewer words stand in any text; those of fewer than ``WINDOW`` words are looked for word for word, values included.
LEAST_ITEM = 4
#: So many words may be added or missing before or after the window that agrees.
DRIFT = 4
#: Words that are units where they follow a number.
UNITS = (
    "mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons "
    "ml cl l liter liters litre litres s sec ms min h hr second seconds minute minutes hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars euro euros cent cents pound pounds percent degrees celsius fahrenheit kmh mph hz kw kwh w v a"
).split()
_SLOT, _JOIN = "\x01", "\x02"


def with_words(df: DataFrame, text: str = "text", values: bool = True) -> DataFrame:
    """Add words: in lower case without punctuation; a slot is marked by its type, and keeps its value if ``values``.

    A name is a capitalised word that does not begin a sentence; a number is a run of digits
    with inner points or commas; a unit is a word of ``UNITS`` after a number.  Names, and numbers, that follow each other are one word.
    """
    steps = [
        F.regexp_replace(F.translate(F.coalesce(F.col(text), F.lit("")), _SLOT + _JOIN, ""), r"(?<=[^.!?:\s]\s)(\p{Lu}\p{Ll}+)", rf"{_SLOT}n$1"),
        F.lower("_t"),
        F.when(F.col("_t").rlike(r"\p{N}"), F.regexp_replace("_t", r"(?<![\p{L}\p{N}])\p{N}+(?:[.,]\p{N}+)*", rf"{_SLOT}d$0")).otherwise(F.col("_t")),
        F.regexp_replace("_t", rf"(?:[^\p{{L}}\p{{N}}\s{_SLOT}.]|\.(?!\p{{N}}))+", ""),
        F.when(F.col("_t").contains(f"{_SLOT}d"), F.regexp_replace("_t", rf"({_SLOT}d\S+\s+)({'|'.join(UNITS)})(?!\S)", rf"$1{_SLOT}u$2")).otherwise(F.col("_t")),
        F.when(F.col("_t").contains(_SLOT), F.regexp_replace("_t", rf"({_SLOT}([nd])\S*)\s+(?={_SLOT}\2)", f"$1{_JOIN}")).otherwise(F.col("_t")),
    ]
    for step in steps:
        df = df.withColumn("_t", step)
    if not values:
        df = df.withColumn("_t", F.when(F.col("_t").contains(_SLOT), F.regexp_replace("_t", rf"{_SLOT}(.)\S*", rf"{_SLOT}$1")).otherwise(F.col("_t")))
    return df.withColumn("words", F.filter(F.split("_t", r"\s+"), lambda w: w != "")).drop("_t")


def _template(word: Column) -> Column:
    return F.when(word.startswith(_SLOT), F.substring(word, 1, 2)).otherwise(word)


def window_length(n: Column) -> Column:
    """Words of an item's windows: a run that is left whole by any one change; items of under ``WINDOW`` words are a window themselves."""
    return F.when(n < WINDOW, n).when(n < 2 * LONG, SHORT).otherwise(LONG)


def _grams(df: DataFrame, longest: int) -> DataFrame:
    """Add g1, g2 and g4, hashes of so many words from each word on, as far as windows of ``longest`` words need them."""
    df = df.withColumn("g1", F.transform("words", lambda w: F.xxhash64(w)))
    for size in (1, 2):
        if longest > size:
            df = df.withColumn(f"g{2 * size}", _joined(f"g{size}", size))
    return df


def _joined(grams: str, by: int) -> Column:
    """Hashes of every gram and the one ``by`` words after it."""
    n = F.greatest(F.size(grams) - by, F.lit(0))
    return F.zip_with(F.slice(grams, F.lit(1), n), F.slice(grams, F.lit(1 + by), n), lambda a, b: F.xxhash64(a, b))


def _of_length(length: int) -> Column:
    """Hashes of the windows of so many words: two grams that overlap or touch."""
    size = max(s for s in (1, 2, 4) if s <= length)
    return F.col(f"g{size}") if size == length else _joined(f"g{size}", length - size)


def windows(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Rows of ``df`` (whose words have no values) with at, length and window, for windows of these lengths at every word."""
    kept = [c for c in df.columns if c != "words"]
    if not lengths:
        return df.select(*kept, F.lit(0).alias("at"), F.lit(0).alias("length"), F.lit(0).cast("long").alias("window")).limit(0)
    df = _grams(df, max(lengths))
    # The outer form, as the optimizer would make the list once more to see whether it is empty.
    df = df.select(*kept, F.size("words").alias("_n"), F.posexplode_outer(F.concat(*map(_of_length, lengths))).alias("_i", "window")).filter("_i is not null")
    at, length, start = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    places = []
    for size in lengths:
        places.append((size, start))
        start = start + F.greatest(F.col("_n") - (size - 1), F.lit(0))
    for size, first in places:
        at, length = F.when(F.col("_i") >= first, F.col("_i") - first).otherwise(at), F.when(F.col("_i") >= first, size).otherwise(length)
    return df.select(*kept, at.alias("at"), length.alias("length"), "window")


def _aligned(item: str, mine: str, off: str) -> Column:
    """(agree, same, slots): the most words of the item that agree with the document in order, from ``DRIFT`` words before to as many after the place ``off``.

    ``slots`` are the values of the item and of the document where both have one; of alignments that agree in as many words the one with
    more equal values counts.  A word agrees with its own value in a slot: names may be written small.
    """
    width = 2 * DRIFT + 1
    none = F.array().cast("array<struct<a:string,b:string>>")
    state = lambda agree, same, slots: F.struct(agree.alias("agree"), same.alias("same"), slots.alias("slots"))
    zero = F.array_repeat(state(F.lit(0), F.lit(0), none), width)

    def step(known: Column, place: Column) -> Column:
        a = F.get(F.col(item), place)

        def over(k: Column) -> Column:
            b = F.coalesce(F.get(F.col(mine), F.when((at := place + F.col(off) + k - DRIFT) >= 0, at)), F.lit(""))
            straight = F.get(known, k)
            slot = a.startswith(_SLOT) & (_template(a) == _template(b))
            equal = (a == b) | (a.startswith(_SLOT) & (F.substr(a, F.lit(3)) == b)) | (b.startswith(_SLOT) & (F.substr(b, F.lit(3)) == a))
            pair = F.array(F.struct(a.alias("a"), b.alias("b")))
            further = state(straight["agree"] + 1, straight["same"] + F.when(a == b, 1).otherwise(0), F.when(slot, F.concat(straight["slots"], pair)).otherwise(straight["slots"]))
            # A word of the item that the document lacks: the next one stands one place nearer.
            missing = F.coalesce(F.get(known, k + 1), straight)
            return F.greatest(F.when(slot | equal, further).otherwise(straight), missing)

        best = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), over)
        # Words that the document has more are passed over: the best up to each place.
        so_far = lambda row, x: F.concat(row, F.array(F.greatest(x, F.get(row, F.size(row) - 1))))
        return F.aggregate(best, F.slice(zero, F.lit(1), F.lit(0)), so_far)

    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), zero, step, F.array_max)


def _once(value: Column) -> Column:
    """``value`` as the output of a generator, so that it is not made anew for each of its uses."""
    return F.explode(F.array(value))


def matches(docs: DataFrame, items: DataFrame, least: int = 70) -> DataFrame:
    """(doc_id, item_id, n_hits, n_words, n_slots, changed): documents that hold an item, with the best occurrence of each.

    ``least``: percent of the item's words that must agree in order.  ``changed``:
    slots whose value differs, so 0 for a plain copy.  ``docs`` has doc_id and text, ``items``
    item_id and text.  An item of 8 words or more is found if one word is changed, added or left out anywhere, or slots have other values of any number of words; with more
    changes, if seven words in a row agree (four where it has under 14) and enough words in all.  Items of 4 to 7 words are found word for word; items
    of fewer are ordinary phrases and are not looked for.  Null texts match nothing; null ids are
    kept; repeated rows give one result; other columns take no part.  Either table may be empty.
    """
    bank = items.select("item_id", "text", F.xxhash64("item_id", "text").alias("item")).dropDuplicates(["item"])
    bank = written(with_words(bank).select("item_id", "item", "words"), "items").filter(f"size(words) >= {LEAST_ITEM}")
    plain = bank.select("item", window_length(F.size("words")).alias("w"), F.transform("words", _template).alias("words"))
    lengths = sorted(r[0] for r in plain.select("w").distinct().collect())  # six lengths at most
    wanted = written(windows(plain, lengths).filter("length = w").drop("w"), "windows")
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("doc"))
    texts = with_words(keyed.select("doc", "text"), values=False).select("doc", "words")
    hits = windows(texts, lengths).withColumnRenamed("at", "pos").join(bounded(wanted), ["length", "window"])
    lines = written(hits.select("doc", "item", (F.col("pos") - F.col("at")).alias("off")).distinct(), "lines")

    own = written(lines.select("doc").distinct(), "own")
    held = with_words(keyed.join(bounded(own), "doc", "left_semi").dropDuplicates(["doc"])).select("doc", "doc_id", F.col("words").alias("mine"))
    both = lines.join(bounded(bank), "item").join(held, "doc")
    # Only the part of a document that the item can lie in is carried along.
    first = F.greatest(F.col("off") - DRIFT, F.lit(0))
    part = F.slice("mine", first + 1, F.size("words") + 2 * DRIFT + F.least(F.col("off") - DRIFT, F.lit(0)))
    both = both.select("doc", "item", "doc_id", "item_id", "words", "off", _once(part).alias("part"), (F.col("off") - first).alias("_off"))
    both = both.select("*", _once(_aligned("words", "part", "_off")).alias("z"))
    both = both.withColumns({"n_hits": F.col("z.agree").cast("long"), "n_words": F.size("words").cast("long"), "_d": F.array_distinct("z.slots")})
    changed = F.size(F.filter("z.slots", lambda z: z["a"] != z["b"])).cast("long")
    both = both.withColumns({"n_slots": F.size("z.slots").cast("long"), "changed": changed})
    both = both.filter((100 * F.col("n_hits") >= least * F.col("n_words")) & ((F.col("n_words") >= WINDOW) | (F.col("z.same") == F.col("n_words"))))
    both = both.filter(F.size("_d") == F.size(F.array_distinct(F.transform("_d", lambda z: z["a"]))))
    best = both.groupBy("doc", "item").agg(F.max(F.struct("n_hits", -F.col("changed"), -F.col("off"), "doc_id", "item_id", "n_words", "n_slots", "changed")).alias("s"))
    return best.select("s.doc_id", "s.item_id", "s.n_hits", "s.n_words", "s.n_slots", "s.changed")


def clean(docs: DataFrame, items: DataFrame, least: int = 70) -> DataFrame:
    """``docs`` without the rows whose text holds an item; a null text stays."""
    found = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    bad = written(matches(found, items, least).select(F.col("doc_id").alias("_bad")).distinct(), "leaks")
    return docs.join(bounded(bad), F.xxhash64("text") == F.col("_bad"), "left_anti")
