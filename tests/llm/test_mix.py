"""Mixing, sharding, the pipeline, and every query that has SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from tidewater.llm import jaccard, mixing, queries, sharding, templates

SF = "/root/testdata/sf0.001"


def plain(value):
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), duck.sql(queries.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted([plain(r[c]) for c in columns] for r in got.collect())
    assert rows and rows == sorted([plain(r[want.columns.index(c)]) for c in columns] for r in want.fetchall())


def documents(spark, sizes):
    """One document of each (source, words)."""
    rows = [(i, s, " ".join(["w"] * n) if n is not None else None, "k") for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, key string")


def water(sizes, weights, total):
    """Targets by repeated sharing of the excess."""
    target, capped = dict.fromkeys(sizes, 0.0), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        open_ = [s for s in sizes if s not in capped]
        for s in open_:
            target[s] = rest * weights[s] / sum(weights[x] for x in open_)
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            return target | {s: 2.0 * sizes[s] for s in capped}
        capped |= over


def test_targets_and_words_taken(spark):
    rng = random.Random(1)
    sizes = [(rng.choice(["a", "b", "c", "é", None, "big"]), rng.randrange(0, 300)) for _ in range(200)] + [("big", 9000), ("one", 7), ("nil", 0), ("nil", None)]
    taken, sources = mixing.mix(documents(spark, sizes), weights=(3, 1, 2), share=1.5)
    rows = taken.collect()
    assert len(rows) == len(sizes)
    totals = defaultdict(int)
    for s, n in sizes:
        totals[s] += n or 0
    order = sorted((s for s in totals if s is not None)) + [None]
    want = water(totals, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(totals.values()))
    got = defaultdict(int)
    for r in rows:
        assert r.size == (sizes[r.doc_id][1] or 0) and r.source_size == totals[r.source] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(want[r.source])
        got[r.source] += r.taken
    for s in totals:
        assert abs(got[s] - want[s]) <= max(2, 0.02 * want[s]), s
    again = {(r.doc_id, r.taken) for r in mixing.mix(documents(spark, sizes).repartition(5), weights=(3, 1, 2), share=1.5)[0].collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}
    copies = mixing.mixed(documents(spark, sizes), weights=(3, 1, 2), share=1.5)
    assert copies.columns == ["doc_id", "source", "text", "key"]
    times = Counter(r.doc_id for r in copies.collect())
    assert times == Counter({r.doc_id: int(r.taken / r.size + 0.5) for r in rows if r.size and int(r.taken / r.size + 0.5)})


def test_quotas_are_highest_quotients(spark):
    sizes = [(s, 40 + 7 * k) for s in "abcdef" for k in range(ord(s) - 90)]
    _, sources = mixing.mix(documents(spark, sizes), weights=(3, 1, 2), share=1.5)
    plan = sources.collect()
    quotients = sorted(((r.target / (2 * j - 1), r.source) for r in plan for j in range(1, r.seats + 50)), reverse=True)
    seats = Counter(s for _, s in quotients[: sum(r.seats for r in plan)])
    assert seats == Counter({r.source: r.seats for r in plan})
    shards = mixing.quotas(sources, 7).collect()
    assert all(r.quota >= 0 for r in shards)
    assert {s: sum(r.quota for r in shards if r.source == s) for s in seats} == dict(seats)


def test_mix_of_nothing_and_of_equal_rows(spark):
    empty = documents(spark, []).limit(0)
    assert mixing.mix(empty)[0].collect() == [] and mixing.mixed(empty).collect() == []
    assert [(r.taken, r.target) for r in mixing.mix(documents(spark, [(None, None), ("a", 0)]))[0].collect()] == [(0, 0.0)] * 2
    same = spark.createDataFrame([(1, "a", "x y z")] * 6 + [(None, "a", "q")], "doc_id long, source string, text string")
    assert mixing.mixed(same, share=2.0).count() == 14


def check_shards(rows, limit):
    sums, count = Counter(), Counter()
    for r in rows:
        sums[r.shard, r.page] += r.bytes
        count[r.shard, r.page] += 1
    assert all(sums[r.shard, r.page] == r.shard_bytes for r in rows)
    assert all(sums[k] <= limit or count[k] == 1 for k in sums)
    return sums, count


def test_shards_fit_and_split_only_when_they_must(spark):
    rng = random.Random(9)
    rows = [(i, "x" * rng.choice([0, 10, 100, 400, 3000]), 5) for i in range(600)] + [(7, None, 5), (None, "n" * 50, 5)] + [(-1, "s" * 90, 5)] * 300 + [(-2, "h" * 5000, 5)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard long")
    limit = 2500
    got = sharding.shard(docs, limit).collect()
    assert len(got) == len(rows) and Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for i, t, _ in rows)
    sums, count = check_shards(got, limit)
    # The parent of a bucket is over the limit, else it would not have split.
    parents, members = Counter(), Counter()
    for r in got:
        for d in range(r.depth):
            parents[(r.shard >> (r.depth - d)) if r.page == 0 or r.depth == 60 else None] += r.bytes
            members[(r.shard >> (r.depth - d)) if r.page == 0 or r.depth == 60 else None] += 1
    assert all(parents[r.shard >> 1] > limit and members[r.shard >> 1] > 1 for r in got if r.depth > 0 and r.page == 0)
    pages = {r.page for r in got if r.doc_id == -1}
    assert len(pages) == -(-300 // (limit // 90))
    assert sharding.shard(docs.limit(0), limit).collect() == []
    assert {r.depth for r in sharding.shard(docs, 1 << 30).collect()} == {0}


def test_pipeline_stages_take_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(90_000, "12 34", None, "src1", 5), (90_001, None, None, None, None), (90_002, "", None, "src1", 0)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.filter("doc_id = 3"))
    before = {r.doc_id: r.text for r in docs.collect()}
    one, two, three, four, five = (f for _, f in corpus_pipeline.STAGES)

    first = one(spark, docs, SF)
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == set(before) - {90_000, 90_001, 90_002}
    second = two(spark, first, SF)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    sets = {i: {tuple(words(t)[k : k + 5]) for k in range(max(1, len(words(t)) - 4))} for i, t in before.items() if i < 90_000}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    kept = sorted(r.doc_id for r in second.collect())
    assert second.columns == docs.columns and kept == sorted({root(i) for i in sets}) and len(kept) < len(sets)
    third = three(spark, second, SF)
    leaked = {r.doc_id for r in queries.op8(spark, SF).collect()}
    clean = sorted(r.doc_id for r in third.collect())
    assert third.columns == docs.columns and clean == [i for i in kept if i not in leaked] and len(clean) < len(kept)
    fourth = four(spark, third, SF)
    times = Counter(r.doc_id for r in fourth.collect())
    taken = {r.doc_id: int(r.taken / r.size + 0.5) for r in mixing.mix(third, weights=(3, 1, 2), share=1.5, cap=2.0)[0].collect()}
    assert fourth.columns == docs.columns and times == Counter({i: n for i, n in taken.items() if n})
    fifth = five(spark, fourth, SF)
    rows = fifth.collect()
    check_shards(rows, corpus_pipeline.SHARD_BYTES)
    assert Counter(r.doc_id for r in rows) == times
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_every_dealt_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert jaccard and templates
