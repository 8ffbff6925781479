"""Manifest, tokenizer alignment and nearest neighbours against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import alignment, merkle, midstates, neighbours, queries

FIRST, SECOND = f"{queries.TOKENIZERS}/byte_bpe_50k.json", f"{queries.TOKENIZERS}/piece_bpe_32k.model"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# -- hash states --------------------------------------------------------------


def test_states_give_the_standard_digest():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 1 << 32, (3, 8, midstates.LANES + 5), dtype=np.uint32)
    state = midstates.starts(digests.shape[2])
    for d in digests:
        state = midstates.absorb(state, d)
    got = midstates.packed(midstates.finish(state, 3)).hex()
    for k in (0, 1, midstates.LANES, midstates.LANES + 4):
        assert got[64 * k : 64 * k + 64] == h(*(midstates.packed(d[:, k : k + 1]).hex() for d in digests))


# -- manifest -----------------------------------------------------------------


def levels(nodes, arity):
    out = [list(nodes)]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def walk(tree, i, value, siblings, arity):
    for level in tree[:-1]:
        first = i // arity * arity
        run = level[first : first + arity]
        siblings += run[: i - first] + run[i - first + 1 :]
        run[i - first] = value
        value, i = h(*run), i // arity
    return value


def brute_manifest(rows, arity):
    """rows of (group, order, leaf, changed or None), to the multiset of results."""
    by = defaultdict(list)
    for g, o, leaf, changed in rows:
        by[g].append(((o is not None, o or 0, leaf), leaf, changed))
    groups = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[1] for x in sorted(by[g], key=lambda x: x[0])], arity) for g in groups}
    above = levels([trees[g][-1][0] for g in groups], arity)
    root = above[-1][0]
    out = Counter()
    for k, g in enumerate(groups):
        for i, ((_, _, _), leaf, changed) in enumerate(sorted(by[g], key=lambda x: x[0])):
            siblings = []
            value = walk(above, k, walk(trees[g], i, changed or leaf, siblings, arity), siblings, arity)
            out[leaf, trees[g][-1][0], root, h(*siblings), value, value == root] += 1
    return out


@pytest.mark.parametrize(("arity", "chunk"), [(2, 8), (3, 4096), (5, 25)])
def test_manifest_and_folds(spark, monkeypatch, arity, chunk):
    monkeypatch.setattr(merkle, "CHUNK", chunk)
    rng = random.Random(arity)
    rows = [("big", k, h(str(k)), h("x") if k % 5 == 0 else None) for k in range(70)]
    rows += [(rng.choice([None, "", "é", "=", "Z", "a"]), rng.choice([None, *range(9)]), h(str(rng.randrange(30))), None) for _ in range(60)]
    rows += [("alone", 1, h("alone"), h("other"))]
    # Columns of the same names as those inside take no part.
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "lang string, id long, digest string, new string, g int, value int, kept int")
    manifest = merkle.build(frame, "lang", ["id"], "digest", ["new"], arity)
    got = merkle.fold(manifest, "new").collect()
    # Equal rows are interchangeable: changed ones have leaves of their own here.
    assert Counter(tuple(r[c] for c in merkle.RESULTS) for r in got) == brute_manifest(rows, arity)
    assert {r.root for r in got} == {manifest.root}


def test_manifest_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], "lang string, id long, digest string")
    manifest = merkle.build(none, "lang", ["id"], "digest")
    assert manifest.root is None and merkle.fold(manifest).collect() == []
    one = merkle.build(spark.createDataFrame([(None, None, h("a"))], none.schema), "lang", ["id"], "digest")
    (row,) = merkle.fold(one).collect()
    assert (row.leaf, row.root, row.proof_sha256, row.verified) == (h("a"), h("a"), h(), True)
    with pytest.raises(ValueError, match="result"):
        merkle.build(none.withColumn("root", F.lit(1)), "lang", ["id"], "digest", ["root"])


def test_leaf_of_nulls_and_wide_characters(spark):
    row = spark.createDataFrame([(1, None, "é🙂", "")], "a long, b string, c string, d string")
    assert row.select(merkle.leaf("a", "b", "c", "d")).first()[0] == h("1:1-6:é🙂0:")


# -- alignment ----------------------------------------------------------------


@pytest.fixture(scope="module")
def sides():
    return alignment._Side(*alignment.ByteLevel(FIRST, queries.PIECES).open()), alignment._Side(*alignment.Pieces(SECOND).open())


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(FIRST)
    own.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    return lambda text: own.encode(" " + text, add_special_tokens=False).ids, pieces.encode


def brute_alignment(text, sides, encoders):
    """(n_a, n_b, groups, links as pairs of ids)."""
    a, b = (f(text or "") for f in encoders)
    spelt = [[side.entries[i] for i in ids] for side, ids in zip(sides, (a, b))]
    if not text or any(b"".join(s) != (" " + text).encode() for s in spelt):
        return 0, 0, [], []
    spans = [[(sum(map(len, s[:k])), sum(map(len, s[: k + 1]))) for k in range(len(s))] for s in spelt]
    links = [(i, j) for i, x in zip(a, spans[0]) for j, y in zip(b, spans[1]) if max(x[0], y[0]) < min(x[1], y[1])]
    cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
    groups, start = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for i, x in zip(ids, own) if start < x[1] <= cut) for ids, own in zip((a, b), spans)))
        start = cut
    return len(a), len(b), groups, links


TEXTS = [None, "", " ", "a", "\n", "</s>", "<|endoftext|> x", "▁", "a ▁b", "naïve  café\t漢字 🙂🙂 <0x41>", "the cat sat. the cat ran!", "x" * 300, "1234567 890 ...", "\x00 a"]


def fuzz(n, seed=3):
    rng = random.Random(seed)
    alphabet = ["a", "the", " ", "  ", "\n", "é", "ß", "漢", "🙂", "'s", "...", "23", "́", " ", "Ａ", "ﬁ", "</s>"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(n)]


def test_blocks_of_texts_equal_brute_force(sides, encoders):
    texts = TEXTS + fuzz(400)
    for text, got in zip(texts, alignment.align_block(texts, *sides), strict=True):
        n_a, n_b, groups, links = brute_alignment(text, sides, encoders)
        assert got[:5] == (n_a, n_b, len(groups), len(links), ";".join(groups)), text
        assert dict(zip(got[5].tolist(), got[6].tolist())) == {i << 32 | j: n for (i, j), n in Counter(links).items()}


def test_very_long_text_is_cut_where_both_begin_a_token(sides, encoders):
    rng = random.Random(8)
    text = "".join(rng.choice(["word", "漢字", "x", " y", " ", " z\n", "́"]) + " " for _ in range(60_000))
    assert len(text) > 2 * (1 << 16)
    ((n_a, n_b, *_),) = alignment.align_block([text], *sides)
    assert (n_a, n_b) == tuple(len(f(text)) for f in encoders)


def test_cuts_are_the_common_ends():
    rng = np.random.default_rng(2)
    for size in (1, 2, 7, 400):
        a, b = (np.unique(np.append(rng.integers(1, 3 * size, size), 3 * size)) for _ in range(2))
        cuts = alignment.shared_cuts(a, b, np.array([0]), np.array([len(a)]))
        assert a[cuts].tolist() == np.intersect1d(a, b).tolist()


@pytest.mark.parametrize("most", [2_000_000, 5])
def test_usual_links_in_the_corpus(spark, monkeypatch, sides, encoders, most):
    monkeypatch.setattr(alignment, "BROADCAST_ROWS", most)  # the few most frequent pairs, or all
    texts = TEXTS + fuzz(30) + ["the cat sat. the cat ran!"] * 3
    docs = spark.createDataFrame([(k if k else None, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, n_a string")
    aligned = alignment.align(docs, alignment.ByteLevel(FIRST, queries.PIECES), alignment.Pieces(SECOND)).withColumn("row", F.coalesce("doc_id", F.lit(0)))
    got = {r.row: (r.n_best, r.count_sum) for r in alignment.usual_links(aligned, "row", alignment.pair_counts(aligned)).collect()}
    links = [brute_alignment(t, sides, encoders)[3] for t in texts]
    count = Counter(pair for own in links for pair in own)
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    for k, own in enumerate(links):
        want = (sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own))
        assert got.get(k, (0, 0)) == want


def test_alignment_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    aligned = alignment.align(docs, alignment.ByteLevel(FIRST, queries.PIECES), alignment.Pieces(SECOND)).withColumn("row", F.lit(1))
    assert aligned.count() == 0 and alignment.usual_links(aligned, "row", alignment.pair_counts(aligned)).collect() == []


# -- neighbours ---------------------------------------------------------------


def brute_neighbours(rows, asks, k):
    def good(v):
        return v is not None and any(v) and all(x is not None and math.isfinite(x) for x in v)

    usable = sorted({(i, tuple(float(x) + 0.0 for x in v)) for i, v in rows if i is not None and good(v)})
    out = []
    for q, x in usable:
        if not asks(q):
            continue
        near = [(-neighbours.cosines(np.array([x]), np.array([y]))[0], i) for i, y in usable if i != q and len(y) == len(x)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(near)[:k])]
    return sorted(out)


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = [(k, rng.normal(size=8).round(1).tolist()) for k in range(150)]
    rows += [(200 + k, [1.0, 2.0, -1.0, 0.5, 0.0, 0.0, 3.0, 1.0]) for k in range(60)]  # a third of all rows
    rows += [(300 + k, rng.normal(size=3).tolist()) for k in range(12)]
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [float("nan")] + [1.0] * 7), (404, [float("inf")] * 8), (405, [None] + [1.0] * 7), (None, [1.0] * 8)]
    rows += [(406, [-0.0, 1.0] + [0.0] * 6), (407, [0.0, 1.0] + [0.0] * 6), (410, [1e300] * 8), (411, [1e-300] * 8)]
    rows += [(20, rows[20][1]), (21, rows[22][1]), (30, rows[31][1])]  # a repeated row; ids with two vectors
    return rows


@pytest.mark.parametrize(("block", "panel", "panels"), [(1024, 2048, 16), (16, 4, 16), (16, 4, 2)])
def test_neighbours_equal_brute_force(spark, monkeypatch, block, panel, panels):
    for name, value in (("BLOCK", block), ("PANEL", panel), ("PANELS", panels), ("SHARED", 2)):
        monkeypatch.setattr(neighbours, name, value)
    rows = vectors(panel)
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int")
    got = neighbours.nearest(frame, F.col("vec_id") % 10 == 0, 5).collect()
    assert got and sorted(map(tuple, got)) == brute_neighbours(rows, lambda i: i % 10 == 0, 5)


def test_neighbours_of_few_and_of_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.nearest(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0, 5).collect() == []
    two = spark.createDataFrame([(50, [1.0, 0.0]), (51, [1.0, 1.0])], schema)
    assert [tuple(r)[:3] for r in neighbours.nearest(two, F.col("vec_id") % 50 == 0, 5).collect()] == [(50, 1, 51)]
    assert neighbours.nearest(two, F.col("vec_id") == 1, 5).collect() == []


def test_error_bounds_hold():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(200, 32)), rng.normal(size=(300, 32)) * 10.0 ** rng.integers(-5, 5, (300, 1))
    (cx, sx, _, rx), (cy, sy, ly, ry) = neighbours.quantised(x), neighbours.quantised(y)
    about = (cx.astype(float) @ cy.astype(float).T) * sx[:, None] * sy
    exact = neighbours.cosines(np.repeat(x, 300, 0), np.tile(y, (200, 1))).reshape(200, 300)
    assert (np.abs(about - exact) <= rx[:, None] * ly + ry + 1e-12).all()
