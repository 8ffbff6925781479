"""Quality rules whose failures are judged per host as well as per document.

Every rule is a condition on one document.  Failures are summed by host; a host's rate
is shrunk towards all hosts' rate by an empirical beta prior, so that a host of three
documents isn't condemned by two of them; a host whose shrunk rate of any rule passes
that rule's limit fails, and its verdict is joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded, word_list
from tidewater.session import written

WINDOW = 8


def _shifted(xs: str, by: int) -> Column:
    """Hash of each element with the one ``by`` places on."""
    n = F.greatest(F.size(xs) - by, F.lit(0))
    return F.zip_with(F.slice(xs, F.lit(1), n), F.slice(xs, F.lit(1 + by), n), lambda a, b: F.xxhash64(a, b))


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long) of the whole text.

    Windows of eight words are compared by 64-bit hashes within one text.  Work is linear in
    the text's length, but for a sort of the windows where some repeat.  A null text counts
    as empty.  Columns of these names that ``docs`` has are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))
    df = docs.withColumn("_h", F.transform(word_list(F.col(text)), lambda w: F.xxhash64(w))).withColumn("_lines", lines)
    df = df.withColumns(
        {
            "n_words": F.size("_h").cast("long"),
            "word_chars": F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    df = df.withColumn("_h", _shifted("_h", 1)).withColumn("_h", _shifted("_h", 2)).withColumn("_h", _shifted("_h", 4))
    df = df.withColumn("_w", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    same = F.zip_with(F.slice("_w", F.lit(1), F.size("_w") - 1), F.slice("_w", F.lit(2), F.size("_w") - 1), lambda a, b: a["x"] == b["x"])
    df = df.withColumn("_s", same)
    twice = F.zip_with(F.concat(F.array(F.lit(False)), "_s"), F.concat("_s", F.array(F.lit(False))), lambda a, b: a | b)
    at = F.filter(F.zip_with("_w", twice, lambda w, t: F.when(t, w["i"])), lambda i: i.isNotNull())
    df = df.withColumn("_at", F.sort_array(at))
    gaps = F.zip_with("_at", F.slice("_at", F.lit(2), F.size("_at") - 1), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)
    return df.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_w").isNotNull(), covered), F.lit(0)).cast("long")).drop("_h", "_lines", "_w", "_s", "_at")


def host_rates(failures: DataFrame, host: str, rules: Mapping[str, float]) -> DataFrame:
    """(host, rule, n, k, rate): documents, failures and shrunk failure rate of every host and rule.

    ``failures`` has a boolean column per rule.  The prior of a rule has the mean of the host
    rates and a strength by the method of moments: the rates' variance less what chance
    alone gives.  Where nothing is left of it all hosts are taken to be alike.  Rows
    with a null host count for no host; a host's documents are summed map-side.
    """
    sums = failures.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in rules])
    each = sums.select("host", "n", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("k")) for r in rules])).alias("r")).select("host", "n", "r.rule", "r.k")
    p = F.col("k") / F.col("n")
    prior = each.groupBy("rule").agg(F.avg(p).alias("m"), F.var_pop(p).alias("v"), F.avg(1 / F.col("n")).alias("c"))
    spread = F.expr("v - m * (1 - m) * c")
    prior = prior.select("rule", "m", F.when(spread > 0, F.greatest(F.expr("m * (1 - m)") / spread - 1, F.lit(1.0))).alias("strength"))
    rate = F.when(F.col("strength").isNull(), F.col("m")).otherwise(F.expr("(k + m * strength) / (n + strength)"))
    return each.join(F.broadcast(prior), "rule").select("host", "rule", "n", "k", rate.alias("rate"))


def judge(failures: DataFrame, host: str, rules: Mapping[str, float]) -> DataFrame:
    """Add host_failed: some rule's shrunk rate of the row's host is above the rule's limit.

    A row with a null host gets false.  ``failures`` should be a written table: it is read twice.
    """
    limit = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    rates = host_rates(failures, host, rules)
    bad = rates.groupBy("host").agg(F.max(F.col("rate") > F.element_at(limit, F.col("rule"))).alias("host_failed")).filter("host_failed")
    bad = written(bad.withColumnRenamed("host", "_host"), "failed-hosts")
    return failures.join(bounded(bad), F.col(host) == F.col("_host"), "left").withColumn("host_failed", F.coalesce("host_failed", F.lit(False))).drop("_host")


#: Rules of a document and the share of a host's documents that may fail them.
LIMITS = {"base_failed": 0.5, "symbols_failed": 0.5, "lines_failed": 0.5}


def document_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, the five counts, the rules' results, host_failed and kept of every document.

    Base rule: under 20 words, or over 30 % of the words in repeated windows.  The others only
    count for the host: symbols over a tenth of the word characters, or duplicates over 30 % of the words' lines.
    An empty table gives an empty result; repeated rows are judged one by one.
    """
    counts = text_counts(docs.select("doc_id", F.col(host).alias("host"), "text"))
    rules = counts.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words").alias("base_failed"),
        F.expr("10 * n_symbols > word_chars").alias("symbols_failed"),
        F.expr("20 * n_dup_lines > n_words").alias("lines_failed"),
    )
    judged = judge(written(rules, "rules"), "host", LIMITS)
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


HOST_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, host, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c
  FROM (SELECT rid, i, array_to_string(ws[i:i+7], ' ') AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8))
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM win WHERE c > 1) GROUP BY rid
), f AS (
  SELECT doc_id, host, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)
), r AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, 10 * n_symbols > word_chars AS symbols_failed, 20 * n_dup_lines > n_words AS lines_failed FROM f
), e AS (
  SELECT host, rule, count(*) AS n, sum(bad::INT) AS k FROM (
    SELECT host, 'b' AS rule, base_failed AS bad FROM r UNION ALL SELECT host, 's', symbols_failed FROM r UNION ALL SELECT host, 'l', lines_failed FROM r)
  WHERE host IS NOT NULL GROUP BY host, rule
), p AS (
  SELECT rule, avg(k / n) AS m, var_pop(k / n) AS v, avg(1 / n) AS c FROM e GROUP BY rule
), s AS (
  SELECT rule, m, CASE WHEN v - m * (1 - m) * c > 0 THEN greatest(m * (1 - m) / (v - m * (1 - m) * c) - 1, 1.0) END AS strength FROM p
), bad AS (
  SELECT DISTINCT host FROM e JOIN s USING (rule)
  WHERE CASE WHEN strength IS NULL THEN m ELSE (k + m * strength) / (n + strength) END > 0.5
)
SELECT doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, symbols_failed, lines_failed,
  bad.host IS NOT NULL AS host_failed, NOT base_failed AND bad.host IS NULL AS kept
FROM r LEFT JOIN bad USING (host)
"""
