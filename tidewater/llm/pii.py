"""Personal data by weak supervision.

Candidates are all spans that a wide pattern of some kind finds.  Labelers vote on each: its form (the strict
rule where there is one, else the checks that the kind allows), a gazetteer and the words before it.  For each kind, and for strict and wide candidates apart,
expectation-maximisation over the table
of vote patterns estimates how reliable each labeler is and, for each pattern, how likely the candidate is personal
data: labelers differ from kind to kind, and so do the shares of real candidates.  Those likelihoods train a span classifier over plain features; its score decides about
candidates that the strict rules do not settle.  What the strict rules accept stays.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewater.llm.common import bounded, sha256_hex
from tidewater.session import written

KINDS = ("email", "ip", "card", "phone", "ssn", "handle", "secret")
#: Possessive forms of the strict patterns: the same leftmost matches, in linear time.  ``\G`` lets a match begin where the last one ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wide patterns: what might be of the kind.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[\[(] ?at ?[\])] ?| at )[A-Za-z0-9-]{1,63}+(?: ?[\[(] ?dot ?[\])] ?| dot )[A-Za-z]{2,12}(?![A-Za-z])",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9.-])",
    "handle": r"(?<![A-Za-z0-9._%+@-])@[A-Za-z][A-Za-z0-9_]{2,30}(?![A-Za-z0-9_.@-])",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]{0,80}[0-9])(?=[0-9_+/=-]{0,80}[A-Za-z])[A-Za-z0-9_+/=-]{20,256}+(?![A-Za-z0-9_+/=@-])",
}
#: Cheap tests without which a pattern cannot match.
NEEDS = {
    "email": "contains(t, '@')", "ip": r"t rlike '[0-9]\\.[0-9]'", "card": "t rlike '[0-9]'", "phone": r"t rlike '\\+[0-9]'",
    "wide_email": "contains(t, ' dot ') or contains(t, 'dot]') or contains(t, 'dot)') or contains(t, 'dot ]') or contains(t, 'dot )')", "wide_ip": "contains(t, ':') and t rlike '[0-9A-Fa-f]:[0-9A-Fa-f]'", "wide_ssn": "t rlike '[0-9]-[0-9]'",
    "wide_phone": r"t rlike '[0-9]\\)? ?[-. ]?[0-9]{3}[-. ][0-9]'", "wide_handle": "contains(t, '@')",
    "wide_secret": "t rlike '[A-Za-z0-9_+/=-]{20}'",
}
#: Words that announce a kind, looked for in the 32 characters before a span.
CUES = {"email": "mail|contact|write|reach", "ip": "ip|host|server|addr|login", "card": "card|visa|credit|pay|account", "ssn": "ssn|social|security|tax", "phone": "tel|phone|call|fax|mobile|cell|contact", "handle": "follow|twitter|user|handle|insta|account", "secret": "token|secret|passw|passphrase|credential|bearer|auth|api|access|private|key"}
#: Gazetteer: endings of mail domains and first digits of card issuers and well-known prefixes.
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[ \])]*)(?:com|org|net|edu|gov|io|de|fr|es|it|uk|eu|ch|at|us|ca|info)$",
    "ip": r"^(?:10|127|172|192|8|1|[0-9a-fA-F]{4}:)",
    "card": r"^[3-6]",
    "phone": r"^\+?\(?[1-9]",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "secret": r"^(?:sk-|ghp_|gho_|xox[abp]-|AKIA|AIza|eyJ)|^(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{128})$",
}
#: Form of a wide candidate, for kinds whose form says something: what speaks for it, and whether anything else speaks against it.
FORM = {
    "email": (r"[\[(] ?(?:at|dot) ?[\])]", False),
    "ip": (r"[A-Fa-f]", False),
    "phone": (r"^\(?[2-9][0-9]{2}\)?[-. ]?[2-9]", True),
    "ssn": (r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", True),
    "handle": (r"[0-9_]|[a-z][A-Z]", False),
    "secret": (r"^(?=.*[0-9].*[0-9].*[0-9])(?=.*[A-Za-z].*[A-Za-z].*[A-Za-z])(?!.*(.)\1{5})", True),
}
#: Kinds that stand in ordinary text too: without a word that announces them, the context speaks against them.
ANNOUNCED = ("handle", "secret")
_LEFT = 32


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn test."""
    xs = F.reverse(F.split(digits, ""))
    xs = F.filter(xs, lambda x: x != "")
    worth = F.transform(xs, lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise((x.cast("int") * 2) % 10 + F.floor(x.cast("int") / 5)))
    return F.aggregate(worth, F.lit(0).cast("long"), lambda s, x: s + x) % 10 == 0


def accepted(kind: str, found: Column) -> Column:
    """What a strict match must satisfy beyond its pattern."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        parts = F.transform(F.split(found, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    return F.length(digits).between(8, 15) if kind == "phone" else F.lit(True)


def _spans(kind: str, wide: bool) -> Column:
    """All matches of a kind in ``t``: kind, strict, start and end in code points, found, left."""
    pattern = F.lit((WIDE if wide else BASE)[kind])
    found, between = F.regexp_extract_all("t", pattern, F.lit(0)), F.split("t", pattern.cast("string"), -1)
    sizes = F.zip_with(between, found, lambda b, f: F.struct(b.alias("b"), f.alias("f")))
    empty = F.array().cast("array<struct<kind:string,strict:boolean,start:bigint,end:bigint,found:string,left:string>>")

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["b"])
        end = start + F.length(x["f"])
        one = F.struct(F.lit(kind).alias("kind"), F.lit(not wide).alias("strict"), start.alias("start"), end.alias("end"), x["f"].alias("found"), F.right(x["b"], F.lit(_LEFT)).alias("left"))
        return F.struct(F.coalesce(end, start).alias("at"), F.when(x["f"].isNotNull(), F.concat(s["spans"], F.array(one))).otherwise(s["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))
    need = NEEDS[f"wide_{kind}" if wide else kind]
    return F.when(F.expr(need), F.aggregate(sizes, zero, step, lambda s: s["spans"])).otherwise(empty)


def candidates(docs: DataFrame) -> DataFrame:
    """(row, kind, strict, start, end, found, left, base) of every candidate; ``strict``: a strict pattern found it, ``base``: it also holds.

    ``docs`` has row and text.  Whole texts are searched.
    """
    df = docs.select("row", F.coalesce("text", F.lit("")).alias("t"))
    every = F.concat(*[_spans(k, False) for k in BASE], *[_spans(k, True) for k in WIDE])
    # The outer form, as the optimizer would search all texts once more to see whether a list is empty.
    df = df.select("row", F.explode_outer(every).alias("s")).filter("s is not null").select("row", "s.*")
    ok = F.lit(False)
    for k in BASE:
        ok = F.when((F.col("kind") == k) & F.col("strict"), accepted(k, F.col("found"))).otherwise(ok)
    return df.withColumn("base", ok).filter("kind <> 'card' or base or not strict or length(regexp_replace(found, '[^0-9]', '')) >= 12")


def votes(spans: DataFrame) -> DataFrame:
    """Add v_regex, v_gazetteer and v_context: 1 for, -1 against, 0 no opinion.

    ``v_regex`` is the strict rule's verdict, and for what only a wide pattern finds that of the kind's form.
    """
    form, listed, cue = F.lit(0), F.lit(0), F.lit(False)
    for k, (pattern, against) in FORM.items():
        form = F.when(F.col("kind") == k, F.when(F.col("found").rlike(pattern), 1).otherwise(-1 if against else 0)).otherwise(form)
    for k, pattern in GAZETTEER.items():
        listed = F.when(F.col("kind") == k, F.when(F.col("found").rlike(pattern), 1).otherwise(-1)).otherwise(listed)
    for k in KINDS:
        cue = F.when(F.col("kind") == k, F.lower("left").rlike(rf"(?:{CUES[k]})[^.!?]*$")).otherwise(cue)
    glued = F.col("left").rlike(r"[\p{L}\p{N}_]$")
    return spans.withColumns(
        {
            "v_regex": F.when(F.col("base"), 1).when(F.col("strict"), -1).otherwise(form),
            "v_gazetteer": listed,
            "v_context": F.when(cue, 1).otherwise(F.when(glued | F.col("kind").isin(*ANNOUNCED), -1).otherwise(0)),
        }
    )


VOTES = ("v_regex", "v_gazetteer", "v_context")
_STATES = (-1, 0, 1)


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[dict[tuple[int, ...], float], list[dict[int, tuple[float, float]]]]:
    """Expectation-maximisation for independent labelers over (votes, count) rows.

    Returns the probability that a pattern's candidates are real, and for each labeler and vote its
    probability among real and among false candidates.  A table has 27 rows at most, however many candidates there are.
    """
    true = {p: 1 / (1 + math.exp(-1.5 * sum(p))) for p, _ in patterns}
    tables: list[dict[int, tuple[float, float]]] = []
    for _ in range(rounds):
        yes = sum(n * true[p] for p, n in patterns)
        all_ = sum(n for _, n in patterns)
        prior = (yes + 1) / (all_ + 2)
        tables = []
        for k in range(len(VOTES)):
            a = {s: 1.0 + (2.0 if s == 1 else 0.0) for s in _STATES}
            b = {s: 1.0 + (2.0 if s == -1 else 0.0) for s in _STATES}
            for p, n in patterns:
                a[p[k]] += n * true[p]
                b[p[k]] += n * (1 - true[p])
            tables.append({s: (a[s] / sum(a.values()), b[s] / sum(b.values())) for s in _STATES})
        new = {}
        for p, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(t[v][0] / t[v][1]) for t, v in zip(tables, p, strict=True))
            new[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        moved = max((abs(new[p] - true[p]) for p in new), default=0.0)
        true = new
        if moved < 1e-6:
            break
    return true, tables


def features(spans: DataFrame) -> DataFrame:
    """Add class, kind and whether a strict pattern found it, and f_*: small categorical features of a span, told apart by class."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("found", r"\p{L}+", "a"), "[0-9]+", "9"), r"\s+", " ")
    left = F.right("left", F.lit(1))
    side = F.when(left == "", "none").when(left.rlike(r"\s"), "blank").when(left.rlike(r"\p{L}"), "letter").when(left.rlike("[0-9]"), "digit").otherwise("mark")
    values = {
        "f_state": F.when(F.col("base"), "holds").when(F.col("strict"), "fails").otherwise("wide"),
        "f_shape": F.when(F.length(shape) <= 12, shape).otherwise("long"),
        "f_size": F.least(F.floor(F.col("end") - F.col("start")) / 4, F.lit(12)).cast("int").cast("string"),
        "f_left": side,
        "f_cue": F.col("v_context").cast("string"),
    }
    spans = spans.withColumn("class", F.concat("kind", F.when(F.col("strict"), "/strict").otherwise("/wide")))
    return spans.withColumns({name: F.concat("class", F.lit("/"), value) for name, value in values.items()})


FEATURES = ("f_state", "f_shape", "f_size", "f_left", "f_cue")


def log_odds(yes: float, n: float) -> float:
    """Smoothed log odds of ``yes`` of ``n``."""
    return math.log((yes + 1) / (n - yes + 1))


def train(spans: DataFrame, bias: dict[str, float]) -> DataFrame:
    """(feature, value, weight): log odds of each value of a feature under the soft labels ``p`` against those of its class: a naive Bayes classifier.

    Shapes are as many as the texts have, so the weights stay a table.
    """
    each = spans.select("p", "class", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES])).alias("x")).select("p", "class", "x.*")
    sums = each.groupBy("class", "feature", "value").agg(F.sum("p").alias("yes"), F.count("*").alias("n"))
    own = F.log((F.col("yes") + 1) / (F.col("n") - F.col("yes") + 1))
    return sums.select("feature", "value", ((own - _by_class(bias)) / 2).alias("weight"))


def _by_class(values: dict[str, float]) -> Column:
    listed = F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair]) if values else F.lit(None).cast("map<string,double>")
    return F.coalesce(F.element_at(listed, F.col("class")), F.lit(0.0))


def find(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """(row, kind, start, end, found, base, p, score): personal data in rows (row, text).

    Strict spans always stay.  Another candidate is added if the classifier's score is at least ``least`` and it does
    not overlap a span of the strict rules.  Without candidates the result is empty.
    """
    spans = written(features(votes(candidates(docs))), "spans")
    # At most 27 vote patterns of each kind, strict and wide.
    tables: dict[tuple[str, bool], list] = {}
    for r in spans.groupBy("kind", "strict", *VOTES).agg(F.count("*").alias("n")).collect():
        tables.setdefault((r.kind, r.strict), []).append((tuple(r[v] for v in VOTES), r.n))
    pattern = F.concat_ws("/", "kind", F.col("strict").cast("string"), *[F.col(v).cast("string") for v in VOTES])
    known = {}
    for (kind, strict), table in sorted(tables.items()):
        for votes_, value in reliabilities(sorted(table))[0].items():
            known["/".join([kind, str(strict).lower(), *map(str, votes_)])] = value
    listed = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else F.lit(None).cast("map<string,double>")
    spans = spans.withColumn("p", F.coalesce(F.element_at(listed, pattern), F.lit(0.5)))
    totals = spans.groupBy("class").agg(F.sum("p").alias("yes"), F.count("*").alias("n")).collect()  # two classes a kind
    bias = {r["class"]: log_odds(r.yes, r.n) for r in totals}
    weights = written(train(spans, bias), "weights")
    score = _by_class(bias)
    for f in FEATURES:
        own = bounded(weights.filter(F.col("feature") == f).select(F.col("value").alias(f), F.col("weight").alias(f"_{f}")))
        spans = spans.join(own, f, "left")
        score = score + F.coalesce(f"_{f}", F.lit(0.0))
    spans = written(spans.withColumn("score", 1 / (1 + F.exp(-score))).select("row", "kind", "start", "end", "found", "base", "p", "score"), "scored")
    before = W.partitionBy("row").orderBy("start").rangeBetween(W.unboundedPreceding, W.currentRow)
    after = W.partitionBy("row").orderBy("start").rangeBetween(1, W.unboundedFollowing)
    met = (F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(before), F.lit(0)) > F.col("start")) | (F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(after), F.col("end")) < F.col("end"))
    return spans.withColumn("_met", met).filter((F.col("base")) | (~F.col("_met") & (F.col("score") >= least))).drop("_met")


def _listed(only: Column) -> Column:
    """kind:start:end of the spans of a document for which ``only`` holds, in order."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = F.sort_array(F.collect_list(F.when(only, F.struct(rank.alias("k"), F.col("start").alias("s"), F.col("end").alias("e"), F.col("kind").alias("kind")))))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def document_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row of ``docs``.

    A null text is empty.  Rows of one id and text are answered alike; a null id is kept.  An empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    found = find(rows).dropDuplicates(["row", "kind", "start", "end"])
    count = lambda k: F.sum(F.expr(f"cast(base and kind = '{k}' as bigint)")).alias(f"n_{k}")
    per = written(found.groupBy("row").agg(*[count(k) for k in BASE], _listed(F.col("base")).alias("base"), _listed(F.lit(True)).alias("spans")), "found")
    out = rows.select("doc_id", "row").join(per, "row", "left")
    none = F.lit(0).cast("long")
    return out.select("doc_id", *[F.coalesce(f"n_{k}", none).alias(f"n_{k}") for k in BASE], sha256_hex(F.coalesce("base", F.lit(""))).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
