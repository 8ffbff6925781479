"""Joins and near copies against brute force."""

import random
import re
from itertools import combinations

import pytest

from tidewater.llm import jaccard, paragraphs
from tidewater.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, node long, n string, at string, key string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def groups(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def corpus(seed, n=160):
    """Random texts, edited copies of a few of them (one much copied), copies, short texts and odd blanks."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ärger", "ÉTÉ", "naïve", "漢字"]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([12, 40, 90, 200]))] for _ in range(12)]
    texts = []
    for k in range(n):
        w = list(base[0] if k % 3 == 0 else rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if k % 17 == 0:
            w = w[: rng.randrange(4)]
        texts.append(rng.choice([" ", "  ", "\n", "\t", "\x0b"]).join(w).upper() if k % 5 == 0 else " ".join(w))
    return texts


@pytest.mark.parametrize(("size", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (1, 70, 3)])
def test_components_and_links_equal_brute_force(spark, size, percent, seed):
    texts = corpus(seed)
    rows = [(i, t, 1, "x", "y", "z") for i, t in enumerate(texts)] + [(900, "", 1, "", "", ""), (901, None, 1, "", "", ""), (3, texts[3], 1, "", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    sets = {i: shingles(t, size) for i, t, *_ in rows}
    linked = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    wanted = groups(sets, linked)
    join = jaccard.Join(size, percent)
    got = jaccard.link_components(docs, join).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, len(sets[i]), wanted[i]) for i, *_ in rows)

    ix = jaccard.index(docs, join)
    names = {r.node: r.doc_id for r in ix.nodes.collect()}
    pairs = {tuple(sorted((names[r.a], names[r.b]))) for r in jaccard.links(ix, join).collect()}
    first = {frozenset(s): min(i for i in sets if sets[i] == s) for s in sets.values()}
    assert pairs == {(a, b) for a, b in linked if first[frozenset(sets[a])] == a and first[frozenset(sets[b])] == b and sets[a] != sets[b]}

    kept = jaccard.representatives(docs, join)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({wanted[i] for i in sets if sets[i]} | {i for i in sets if not sets[i]})


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 66)])
def test_sets_inside_sets_of_one_more_token_link(spark, size, percent):
    texts = []
    for n in range(2, 16):
        for many in (1, 40):  # 40 other texts make the tokens frequent
            w = [f"{many}x{n}x{k}" for k in range(n)]
            texts += [" ".join(w), " ".join(w[1:]), " ".join(w[:-1])]
            texts += [" ".join([*w, f"{many}y{n}y{k}", *w[:2]]) for k in range(many - 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {i: shingles(t, size) for i, t in enumerate(texts)}
    linked = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    wanted = groups(sets, linked)
    join = jaccard.Join(size, percent)
    assert {r.doc_id: r.component_id for r in jaccard.link_components(docs, join).collect()} == wanted
    assert {r.doc_id for r in jaccard.representatives(docs, join).collect()} == {wanted[i] for i in sets if sets[i]} | {i for i in sets if not sets[i]}


def test_lone_tokens_of_a_namesake_do_not_count(spark):
    one, other = ([f"{c}{k}" for k in range(100)] for c in "ab")
    docs = spark.createDataFrame([(1, " ".join(one)), (1, " ".join(other)), (2, " ".join(one[1:]))], "doc_id long, text string")
    join = jaccard.Join(3, 90)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_components(docs, join).collect()) == [(1, 98, 1), (1, 98, 1), (2, 97, 1)]
    assert sorted(r.text for r in jaccard.representatives(docs, join).collect()) == sorted([" ".join(one), " ".join(other)])


def test_join_of_nulls_long_texts_and_nothing(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    docs = spark.createDataFrame([(None, "a b c d e f g"), (7, "A B C D E F G"), (None, "q r s t u"), (5, long), (6, long + " y")], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_components(docs, jaccard.Join(3, 90)).collect()}
    assert got == {(None, 5, 7), (7, 5, 7), (None, 3, None), (5, 59_998, 5), (6, 59_999, 5)}
    assert {r.doc_id for r in jaccard.representatives(docs, jaccard.Join(3, 90)).collect()} == {7, None, 5}
    assert jaccard.link_components(docs.limit(0), jaccard.Join()).collect() == []
    assert jaccard.representatives(docs.limit(0), jaccard.Join()).collect() == []


def test_every_pair_that_overlaps_enough_shares_an_entry():
    import numpy as np

    rng = random.Random(5)
    for _ in range(300):
        n = rng.randrange(10, 150)
        t = rng.choice([70, 80, 90])
        order = list(range(1, 400))
        rare = {x for x in order if x < rng.choice([1, 60, 200])}
        a = set(rng.sample(order, n))
        b = set(a)
        for _ in range(rng.randrange(0, max(1, n // 5))):
            b.discard(rng.choice(sorted(b)))
            b.add(rng.choice(order))
        if 100 * len(a & b) < t * len(a | b):
            continue
        df = lambda x: 2 if x in rare else 1000
        name = {x: x * 0x9E3779B97F4A7C15 % (1 << 63) for x in order}
        entries = []
        for s in (a, b):
            tokens = sorted(s, key=lambda x: (df(x), name[x]))
            entries.append(set(jaccard.prefix_entries(len(s), [df(x) for x in tokens], np.array([name[x] for x in tokens]), t)))
        assert entries[0] & entries[1] or a == b


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 3), (2, 1)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {k: 100 for k in range(100, 160)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def sentence(rng, n, names="abcdefghijklmnop"):
    return " ".join("".join(rng.choice(names) for _ in range(5)) for _ in range(n)) + "."


def brute_paragraphs(text, least):
    """(start, end, words) between sentence or line ends."""
    found, open_ = [], []
    spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
    for k, (s, e) in enumerate(spans):
        open_.append((s, e))
        following = spans[k + 1][0] if k + 1 < len(spans) else len(text)
        if (text[e - 1] in ".!?" and text[e - 2 : e - 1] not in (".", "!", "?")) or "\n" in text[e:following] or k + 1 == len(spans):
            if len(open_) >= least:
                found.append((open_[0][0], e, words(text[open_[0][0] : e])))
            open_ = []
    return found


def test_repeated_paragraphs_equal_brute_force(spark):
    rng = random.Random(8)
    shared = [" ".join(sentence(rng, rng.randrange(9, 16)) for _ in range(5)) for _ in range(4)]
    near = shared[0].split(" ")
    near[3] = "changed"  # one word in a long passage: some sentences stay, one is near
    docs = [(i, f"{sentence(rng, 30, 'qrstuvé')}\n{sentence(rng, 12, 'xyz')}") for i in range(30)]
    for i in range(0, 12, 2):
        docs[i] = (i, docs[i][1][:40] + shared[i % 4] + docs[i][1][40:])
    docs += [(40, " ".join(near)), (41, docs[0][1]), (41, docs[0][1]), (42, None), (None, shared[1] + "\n" + sentence(rng, 25, "kl")), (43, "")]
    shout = "!! ".join(sentence(rng, 30, "mnop")[:-1].split(" ")) + "!!"
    docs += [(50, shout), (51, "Other words. " + shout.upper())]
    rule = paragraphs.Rule()
    got = paragraphs.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string"), rule).collect()

    every = [(k, i, s, e, w) for k, (i, t) in enumerate(docs) for s, e, w in brute_paragraphs(t, rule.min_words)]
    sets = [shingles(" ".join(x[4]), 5) for x in every]
    links = [(a, b) for a, b in combinations(range(len(every)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    part = groups(range(len(every)), links)
    size = {}
    for k in part.values():
        size[k] = size.get(k, 0) + 1
    wanted, run, last = [], [], None
    for k, x in [*enumerate(every), (None, (None,) * 5)]:
        if k is None or x[0] != last or size[part[k]] < 2:
            if sum(len(every[j][4]) for j in run) >= rule.min_passage:
                wanted += run
            run = []
        last = x[0]
        if k is not None and size[part[k]] > 1:
            run.append(k)
    assert sorted((repr(r.doc_id), r.start, r.end, r.n_words) for r in got) == sorted((repr(every[k][1]), every[k][2], every[k][3], len(every[k][4])) for k in wanted)
    clusters = {}
    for r in got:
        clusters.setdefault(r.cluster, []).append(r.removed)
    assert sorted(len(x) for x in clusters.values()) == sorted(n for n in ([sum(part[k] == p for k in wanted) for p in set(part[k] for k in wanted)]))
    assert all(sum(not x for x in c) == 1 for c in clusters.values())
    assert paragraphs.repeated_paragraphs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_passages_of_short_sentences_and_lines_repeat_whole(spark):
    rng = random.Random(4)
    host = lambda: sentence(rng, 30, "qrstuvé")
    bits = [sentence(rng, rng.choice([1, 3, 5, 7, 10])) for _ in range(24)]
    passages = [" ".join(bits[:14]), "\n".join(x[:-1] for x in bits[14:])]
    docs = [(i, f"{host()} {sentence(rng, 3, 'xyz')}\n{passages[i % 2]}\n{sentence(rng, 2, 'xyz')} {host()}") for i in range(6)]
    docs += [(6, f"{host()} {bits[0]} {host()} {bits[1]}"), (7, "No. Yes. " * 3)]
    got = paragraphs.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    for i, text in docs:
        mine = sorted((r.start, r.end) for r in got if r.doc_id == i)
        if i > 5:
            assert not mine
            continue
        at = text.index(passages[i % 2])
        assert [text[s:e] for s, e in mine] == [x.rstrip(".") if i % 2 else x for x in (bits[14:] if i % 2 else bits[:14])]
        assert mine[0][0] == at and mine[-1][1] == at + len(passages[i % 2])
        assert {r.passage_words for r in got if r.doc_id == i} == {len(passages[i % 2].split())}
        assert {r.removed for r in got if r.doc_id == i} == {i > 1}


def test_a_unit_of_short_stretches_is_one_row_until_its_document_is_reported(spark, monkeypatch):
    rng = random.Random(14)
    bits = [sentence(rng, 2) for _ in range(40)]
    docs = [(1, " ".join(bits)), (2, " ".join(bits)), (2, "  ".join(bits))]
    stored = {}

    def kept(rows, purpose, store=paragraphs.written):
        stored[purpose] = store(rows, purpose)
        return stored[purpose]

    monkeypatch.setattr(paragraphs, "written", kept)
    got = paragraphs.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string"))
    # Four sentences make a unit: 37 in a text, of which a sentence in the middle stands in four.
    assert stored["passages"].count() == 3 * 37 and stored["firsts"].count() == 37
    got = got.collect()
    assert len(got) == 3 * 40 and {r.passage_words for r in got} == {80}
    assert sorted(r.start for r in got if not r.removed) == sorted(r.start for r in got if r.doc_id == 1)
    assert all(docs[0][1][r.start : r.end] in bits and r.n_words == 2 for r in got if r.doc_id == 1)
    assert len({r.cluster for r in got}) == 40


def test_passages_without_a_sentence_end_are_found_in_the_middle_of_others(spark):
    """Against brute force on equal windows of 50 words, not on the splitter: each such window has reported words in both documents."""
    rng = random.Random(6)
    word = lambda names: "".join(rng.choice(names) for _ in range(5))
    passages = [" ".join(word("abcdefghi") for _ in range(n)) for n in (50, 55, 60, 90, 60)]
    docs = []
    for i in range(40):
        before, after = (" ".join(word("qrstuv") for _ in range(rng.randrange(3, 60))) for _ in range(2))
        docs.append((i, f"{sentence(rng, 9, 'xyz')} {before} {passages[i % 5]} {after}. {sentence(rng, 12, 'xyz')}"))
    docs += [(100 + i, " ".join(word("jklmnop") for _ in range(rng.randrange(41, 300)))) for i in range(10)]
    got = paragraphs.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    seen = {}
    for i, text in docs:
        spans = [m.span() for m in re.finditer(r"\S+", text)]
        for k in range(len(spans) - 49):
            seen.setdefault(text[spans[k][0] : spans[k + 49][1]], []).append((i, spans[k][0], spans[k + 49][1]))
    shared = [places for places in seen.values() if len(places) > 1]
    assert sum(map(len, shared)) >= 40
    for places in shared:
        for doc, start, end in places:
            own = [r for r in got if r.doc_id == doc and r.start >= start and r.end <= end]
            assert sum(r.n_words for r in own) >= 30, (doc, start, end)
    assert all(r.doc_id < 100 for r in got)
    for i, text in docs[:40]:
        at = text.index(passages[i % 5])
        # A stretch at an edge may be 80% alike with a word of its host.
        assert all(min(r.end, at + len(passages[i % 5])) - max(r.start, at) >= 0.7 * (r.end - r.start) for r in got if r.doc_id == i)
    # One of each passage stays whole; elsewhere it goes, but for stretches at its edges that not all hosts cut alike.
    for i, _ in docs[:40]:
        assert (sum(r.n_words for r in got if r.doc_id == i and r.removed) >= 30) == (i >= 5)


def test_recall_of_the_bands_on_pairs_of_paragraphs(spark):
    """Measured: pairs of similarity 0.8 to 0.9 that end in one cluster."""
    rng = random.Random(12)
    docs, wanted = [], []
    for k in range(400):
        one = sentence(rng, 60, "abcdefghijklmnop")[:-1].split(" ")[: rng.randrange(26, 39)]
        two = list(one)
        two[rng.choice([0, 1, len(two) - 1, len(two) // 2])] = "changed"
        sets = [shingles(" ".join(x), 5) for x in (one, two)]
        likeness = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        docs += [(2 * k, " ".join(one)), (2 * k + 1, " ".join(two))]
        if 0.8 <= likeness <= 0.95:
            wanted.append(k)
    cluster = {r.doc_id: r.cluster for r in paragraphs.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(wanted) > 150
    assert sum(2 * k in cluster and cluster[2 * k] == cluster.get(2 * k + 1) for k in wanted) >= 0.95 * len(wanted)


def test_bands_reach_the_recall():
    bands, rows = paragraphs.tune_bands(80, 0.95)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.95
