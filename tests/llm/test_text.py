"""Operators on single texts against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import chat, hosts, language, pii, queries, templates, tokens

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, "a", "Über café 漢字 😀 naïve.\nZwei  Zeilen\r\n\n", "x" * 5000, " \t\n", "one two " * 4000, "don't 12,5 [x] </s>"]


def encoding():
    import tiktoken

    ranks = tokens.read_ranks(f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken")
    lengths = np.zeros(len(ranks), np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=queries.PIECES, mergeable_ranks=ranks, special_tokens={}), lengths


def test_token_spans_are_the_tokenizers_own(monkeypatch):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(f"{queries.TOKENIZERS}/byte_bpe_50k.json")
    own.encode_special_tokens = True
    enc, lengths = encoding()
    monkeypatch.setattr(tokens, "PIECE", 64)
    for text in filter(None, TEXTS):
        starts, ends = tokens.token_spans(text, enc, lengths)
        wanted = own.encode(text, add_special_tokens=False)
        assert len(starts) == len(wanted.ids)
        if text.isascii():
            # The other library leaves the blank out of a token's span.
            assert [b for _, b in wanted.offsets] == ends.tolist()
        assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] <= ends[:-1]).all()


@pytest.mark.parametrize("rule", tokens.RULES)
def test_allocation_equals_brute_force(rule):
    rng = random.Random(4)
    for _ in range(200):
        cuts = sorted(rng.sample(range(1, 60), rng.randrange(2, 12)))
        sections = [(a, b) for a, b in zip([0, *cuts], cuts, strict=False) if rng.random() < 0.8]
        edges = sorted(rng.sample(range(1, 60), rng.randrange(1, 15)))
        spans = list(zip([0, *edges], edges, strict=False))
        counts, crossing, rest = [0.0] * len(sections), [0] * len(sections), len(spans)
        for s, e in spans:
            common = [max(0, min(e, b) - max(s, a)) for a, b in sections]
            for k, c in enumerate(common):
                crossing[k] += 0 < c < e - s
            if rule == "share":
                for k, c in enumerate(common):
                    counts[k] += c / (e - s)
                rest -= sum(common) / (e - s)
            else:
                own = [k for k, (a, b) in enumerate(sections) if a <= s < b] if rule == "first" else [k for k, c in enumerate(common) if c and c == max(common)]
                if own:
                    counts[own[0]] += 1
                    rest -= 1
        lo, hi = (np.array([x[k] for x in sections], np.int64) for k in (0, 1))
        got = tokens.allocate(*(np.array([x[k] for x in spans]) for k in (0, 1)), lo, hi, rule)
        assert np.allclose(got[0], counts) and got[1].tolist() == crossing and abs(got[2] - rest) < 1e-9


def test_line_tokens_add_up(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "a\nb", "x")], "doc_id long, text string, section string")
    rows = tokens.attribute(docs, f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken", queries.PIECES).collect()
    enc, _ = encoding()
    for i, t in enumerate(TEXTS):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.section)
        assert sum(r.n_tokens for r in own) == len(enc.encode_ordinary(t or "")) == own[0].doc_tokens
        assert [(t or "")[r.start : r.end] for r in own] == ((t or "").splitlines(keepends=True) if "\r" not in (t or "") else re.findall(r"[^\n]*\n|[^\n]+$", t)) or not t
    assert tokens.attribute(docs.limit(0), f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken", queries.PIECES).collect() == []
    some = docs.filter("doc_id = 3").withColumn("s", F.expr("array(named_struct('start', 0L, 'end', 2L))"))
    got = tokens.attribute(some, f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken", queries.PIECES, "share", "s").collect()
    assert {r.section for r in got} == {0, -1} and sum(r.n_tokens for r in got) == pytest.approx(got[0].doc_tokens)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = queries.op3(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in out) / len(out) > 0.99


def test_mixtures_and_odd_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    long = {r.lang: r.text for r in docs.filter("length(text) between 1500 and 4000").select("lang", "text").collect()}
    odd = [(1, long["en"][:1000] + long["fr"][:500]), (2, None), (3, ""), (4, "12 34 !?"), (5, "漢字漢字"), (6, "é"), (None, long["de"]), (7, long["es"] * 200)]
    got = language.identify(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    by = {r.doc_id: r for r in got}
    shares = {x.lang: x.share for x in by[1].languages}
    assert set(shares) == {"en", "fr"} and by[1].lang_pred == "en" and 0.5 < shares["en"] < 0.8
    assert [by[k].lang_pred for k in (2, 3, 4)] == ["und"] * 3 and by[2].score == 0
    assert by[5].lang_pred in model.languages and by[None].lang_pred == "de" and by[7].lang_pred == "es"
    empty = docs.limit(0)
    assert language.fit(empty) is None
    assert {r.lang_pred for r in language.identify(docs.limit(3), None).collect()} == {"und"}
    assert language.identify(empty, model).collect() == []


def brute_counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = {x for x in windows if windows.count(x) > 1}
    repeat = {k for i, x in enumerate(windows) if x in often for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeat)


def test_text_counts_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [t for t in TEXTS if not t or len(t) < 6000] + ["a b c d e f g h " * 3, "l\nl\n\nl\n \n"]
    for _ in range(60):
        block = [rng.choice("abcd") + rng.choice(["", "#", "é", "\n", "\x0b"]) for _ in range(rng.randrange(1, 40))]
        texts.append(" ".join(block * rng.choice([1, 1, 2]) + [rng.choice("xyz")] * rng.randrange(12)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = hosts.text_counts(docs.withColumn("n_words", F.lit("clash"))).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(texts[r.doc_id]), texts[r.doc_id]


def test_host_verdicts_are_shrunk(spark):
    good, bad = "a quick word of plain text that goes on " * 1 + " ".join(f"w{i}" for i in range(30)), "too short"
    rows = [("big", good)] * 200 + [("poor", bad)] * 60 + [("poor", good)] * 5 + [("tiny", bad)] + [("tiny", good)] + [(None, good), (None, bad), ("null", None)]
    rows += [(f"h{k}", good) for k in range(30)] * 10
    docs = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)], "doc_id long, source string, text string")
    got = hosts.document_rules(docs).collect()
    failed = {r.host for r in got if r.host_failed}
    assert "poor" in failed and not failed & {"big", "tiny", None}
    assert all(not r.kept for r in got if r.host == "poor") and [r.kept for r in got if r.host is None] == [True, False]
    assert hosts.document_rules(docs.limit(0)).collect() == []


def test_chat_round_trip(spark):
    odd = ["", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nx", "␛1␛0<␛1s>", "<|im_start|" + "<|im_start|>>", "\n", "a\x00\x01b", '{"role": 1}', "é漢😀", "<s><s>"]
    rng = random.Random(3)
    rows, want = [], {}
    for c in range(60):
        n = rng.randrange(1, 6)
        turns = [(rng.choice(["user", "assistant", "system", "odd\nrole", ""]), rng.choice(odd) + rng.choice(odd)) for _ in range(n)]
        if c % 3 == 0:
            turns = [("user", rng.choice(odd)), ("assistant", rng.choice(odd))]
        want[c] = turns
        rows += [(c, k, r, t, "x") for k, (r, t) in enumerate(turns)]
    rows += [(100, None, None, None, "x"), (None, 0, "user", "hi", "x")]
    want |= {100: [("", "")], None: [("user", "hi")]}
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, layout string")
    back = chat.read_back(chat.formatted(chat.canonical_turns(chat.turn_records(docs)))).collect()
    assert len(back) == len(want)
    for r in back:
        assert [(t.role, t.text) for t in r.turns_read] == want[r.conv_id]
        assert r.loss_read == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        spans = [(s.start, s.end) for s in r.loss]
        assert len(spans) == sum(role == "assistant" for role, _ in want[r.conv_id])
        for control in chat.CONTROLS:
            assert r.formatted.count(control) == (len(r.turns) if control in ("<|im_start|>", "<|im_end|>") else 0)
    sums = {r.conv_id: r for r in chat.digests(chat.read_back(chat.formatted(chat.canonical_turns(chat.turn_records(docs))))).collect()}
    text = "".join(f"{role}\n{t}\n" for role, t in want[0])
    assert sums[0].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert chat.turn_records(docs.limit(0)).collect() == []


def test_layouts_are_known_by_their_paths(spark):
    records = [
        (1, '{"messages":[{"content":"q","role":"user"},{"role":"assistant","content":null}]}'),
        (2, '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}'),
        (3, '{"completion":"a","prompt":"q"}'),
        (4, '{"instruction":"q","output":7}'),
        (5, '{"messages":[{"role":"user","content":"q","weight":1}]}'),
        (6, "no json"),
        (7, None),
        (8, '{"messages":[]}'),
    ]
    got = {r.id: r for r in chat.canonical_turns(spark.createDataFrame(records, "id long, record string")).collect()}
    assert [got[k].layout for k in range(1, 9)] == ["messages", "from_value", "prompt_completion", "instruction_output", None, None, None, "messages"]
    turns = lambda k: [(t.role, t.text) for t in got[k].turns]
    assert turns(1) == [("user", "q"), ("assistant", "")] and turns(2) == turns(3) == [("user", "q"), ("assistant", "a")] and turns(4)[1] == ("assistant", "7")
    assert turns(5) == turns(8) == [] and got[5].fingerprint and got[5].fingerprint != got[1].fingerprint


ITEM = "In 1990 the town of Brest had 500 km of roads and 500 km of rails beside the sea and hills"


def test_conversations_of_any_length_are_formatted(spark):
    """Texts beyond what a JSON reader takes, and text that looks like the references inside."""
    giant = "Ab </s> é\n" * 2_100_000
    rows = [(1, 0, "user", giant), (1, 1, "assistant", "0"), (2, 0, "user", "1"), (2, 1, "tool", "x"), (2, 2, "assistant", giant[:100])]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.read_back(chat.formatted(chat.canonical_turns(chat.turn_records(frame))))).collect()}
    for conv, layout in ((1, "prompt_completion"), (2, "messages")):
        own = [r for r in rows if r[0] == conv]
        loss = "".join(t for _, _, role, t in own if role == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want = (layout, len(own), sha("".join(f"{role}\n{t}\n" for _, _, role, t in own)), len(loss), sha(loss))
        assert (got[conv].layout, got[conv].n_turns, got[conv].turns_sha256, got[conv].loss_chars, got[conv].loss_sha256) == want


def test_leaks_of_templates(spark):
    filler = "Some other words that nobody asked for came before it, and"
    docs = [
        (1, f"{filler} {ITEM.lower()} {filler}"),
        (2, f"{filler}. {ITEM.replace('1990', '2003').replace('Brest', 'Lille').replace('500', '70')}."),
        (3, f"{filler}. {ITEM.replace('500 km of rails', '71 km of rails').replace('Brest', 'Lille')}"),
        (4, filler * 5),
        (5, None),
        (6, ""),
        (None, ITEM.upper()),
        (7, "seven plain words stand in this line nicely together"),
        (7, "seven plain words stand in this line nicely together"),
        (8, ITEM[:30]),
        (9, "x " * 50_000 + ITEM + " y" * 50_000),
    ]
    items = spark.createDataFrame([(10, ITEM), (11, "seven plain words stand in this line nicely"), (12, "too short"), (13, None)], "item_id long, text string")
    frame = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, words string")
    got = sorted(((r.doc_id or -1, r.item_id, r.changed) for r in templates.matches(frame, items).collect()))
    assert got == [(-1, 10, 0), (1, 10, 0), (2, 10, 4), (7, 11, 0), (9, 10, 0)]
    kept = templates.clean(frame, items)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 8]
    assert templates.matches(frame.limit(0), items).collect() == [] and kept.sparkSession is not None
    assert templates.matches(frame, items.limit(0)).collect() == [] and templates.clean(frame, items.limit(0)).count() == len(docs)


LONG = "In the spring of 1990 a ship of the Brest line carried 500 km of rails to the new port and its crew went home on foot afterwards"
MIDDLE = "the plain people of this quiet harbour town have never once asked for any such ship"  # 16 words
SMALL = "our old harbour clock was always seven minutes slow on cold winter mornings"  # 13 words


@pytest.mark.parametrize("host", ["before it came words ", ""])
def test_items_with_one_change_anywhere_are_found(spark, host):
    """One word changed, added or left out, at every place of items of several lengths, and at every place of the document."""
    docs, wanted = [], {}
    items = {1: LONG, 2: MIDDLE, 3: SMALL, 4: "seven plain words stand in this line", 5: "nine of ten sailors like the sea"}
    for k, item in items.items():
        words = item.split()
        for at in range(1, len(words)) if k <= 3 else ():
            for changed in (words[:at] + ["zzz"] + words[at + 1 :], words[:at] + ["zzz"] + words[at:], words[:at] + words[at + 1 :]):
                docs.append((len(docs), f"{host * (at % 5)}so {' '.join(changed)} and more"))
                wanted[len(docs) - 1] = k
        docs.append((len(docs), f"{host}so {item} and more"))
        wanted[len(docs) - 1] = k
    for text in (LONG.replace("Brest", "New York"), LONG.replace("1990", "19 000").replace("500 km", "7 miles"), LONG.replace("Brest", "Rio Grande Do Sul"), LONG.lower(), LONG.upper()):
        docs.append((len(docs), f"{host}so {text} and more"))
        wanted[len(docs) - 1] = 1
    clean = len(docs)
    docs += [(clean, "seven plain ships stand in this line"), (clean + 1, " ".join(LONG.split()[:12]) + " and then something else went on"), (clean + 2, host * 30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bank = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {r.doc_id: r.item_id for r in templates.matches(frame, bank).collect()}
    assert got == wanted


def test_slots_must_be_consistent_under_drift(spark):
    item = "Then Anna met Boris and later Anna left while 20 people and another 20 people stayed on the pier"
    same = item.replace("Anna", "Maria Luisa").replace("20", "35")
    mixed = same.replace("Maria Luisa left", "Clara left")
    docs = spark.createDataFrame([(1, "So. " + same), (2, "So. " + mixed)], "doc_id long, text string")
    got = [(r.doc_id, r.n_slots, r.changed) for r in templates.matches(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()]
    assert got == [(1, 5, 4)]


def brute_leaks(docs, items):
    """Plain copies: items whose words, without marks and letter case, stand in a row in a document, but for the first."""
    plain = lambda t: [x for x in (re.sub(r"[^\w]+", "", w.lower()) for w in (t or "").split()) if x]
    found = set()
    for i, t in docs:
        text = " " + " ".join(plain(t)) + " "
        for k, q in items:
            if len(plain(q)) >= 8 and f" {' '.join(plain(q)[1:])} " in text:
                found.add((i, k))
    return found


def test_leaks_of_the_given_benchmark_equal_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    wanted = brute_leaks(docs.select("doc_id", "text").collect(), items.collect())
    got = {(r.doc_id, r.item_id) for r in queries.op8(spark, SF).collect()}
    assert wanted and got == wanted


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
    return 8 <= len(digits) <= 15 if kind == "phone" else True


def test_strict_spans_equal_brute_force(spark):
    rng = random.Random(6)
    bits = ["a.b@c.de", "x_y@z", "@q.r", "f@g.h_i@j.kl", "1.2.3.4.5.6.7.8", "300.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+12", "+1 234", "é漢😀", ".", " ", "-", "\n", "12", "@", "word", "%", "42.144.35.254"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 12))) for _ in range(300)] + [None, "", "a" * 30_000 + "@", "1." * 20_000, "a@b" + ".c" * 20_000, "+" + "(" * 20_000, "jo at mail dot com"]
    docs = spark.createDataFrame([(i, t, "r") for i, t in enumerate(texts)] + [(None, "x@y.z", "r"), (0, texts[0], "r")], "doc_id long, text string, row string")
    got = pii.document_spans(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = "x@y.z" if r.doc_id is None else texts[r.doc_id] or ""
        spans = {k: [(m.start(), m.end()) for m in re.finditer(p, text) if passes(k, m.group())] for k, p in PLAIN.items()}
        listed = [f"{k}:{a}:{b}" for k in PLAIN for a, b in spans[k]]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(spans[k]) for k in PLAIN]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest(), text[:100]
        assert set(listed) <= set(r.spans.split(","))
    assert pii.document_spans(docs.limit(0)).collect() == []


def test_labelers_add_what_strict_rules_miss(spark):
    texts = [f"Please mail jo{k}@mail{k}.com or call +1 (988) 555-{k:04d} today." for k in range(60)] + [f"word {k} only" for k in range(40)]
    texts += ["Reach me by mail: jane at mail dot com", "Our phone: (212) 555-0187 all day"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row long, text string")
    more = [r for r in pii.find(rows).collect() if not r.base]
    assert {r.found for r in more} >= {"(212) 555-0187"}
    true, tables = pii.reliabilities([((1, 1, 1), 50), ((1, 1, 0), 30), ((0, -1, 0), 40), ((-1, -1, -1), 20)])
    assert true[(1, 1, 1)] > 0.9 > 0.1 > true[(-1, -1, -1)] and tables[0][1][0] > tables[0][1][1]


ANNOUNCED = {
    "ssn": "The social security number on file is 219-09-9999 since May",
    "handle": "Please follow @harbour_clock for more",
    "ip": "The server address was 2001:0db8:85a3:0000:0000:8a2e:0370:7334 last year",
    "email": "Reach me by mail: jane at mail dot com if you like",
    "phone": "Our phone: (212) 555-0187 all day",
    "secret": 'then token = "9233A8ECF7C5B09FE1236B6B82BC439E9329B55A" was set',
}
PLAIN_TEXTS = ["We meet at 12:30:15 and pay 219-09-99 then", "look @ this and @that", "A word_of_many_parts_and_more stands here", "Version 2001-02-03 and 555-1234", "serial AAAAAAAAAAAAAAAAAAAAAAAA1 on the box", "the commit of may 1990"]


@pytest.mark.parametrize("alone", [True, False])
def test_every_kind_is_found_where_a_word_announces_it(spark, alone):
    """Each kind by itself, and all of them among strict ones and plain texts, which stay untouched."""
    common = [] if alone else [f"Please mail jo{k}@mail{k}.com or call +1 (988) 555-{k:04d} today." for k in range(60)] + [f"words {k} only" for k in range(40)]
    for kinds in ([k] for k in ANNOUNCED) if alone else [list(ANNOUNCED)]:
        texts = [*common, *PLAIN_TEXTS, *(ANNOUNCED[k] for k in kinds)]
        rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
        more = [(r.row, r.kind) for r in pii.find(rows).collect() if not r.base]
        assert sorted(more) == sorted((texts.index(ANNOUNCED[k]), k) for k in kinds)


def test_planted_secrets_are_found(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    wanted = {r.doc_id for r in docs.collect() if re.search(r'token = "[0-9a-f]{40}"', r.text or "", re.I)}
    got = {r.doc_id for r in pii.document_spans(docs).collect() if "secret:" in r.spans}
    assert wanted and got == wanted
