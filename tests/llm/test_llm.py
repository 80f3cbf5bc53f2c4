"""Small cases of the dealt operators: nulls, empty and long texts, ties, repeats, extra columns."""

import collections
import hashlib
import importlib.util
import itertools
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
pytest.importorskip("terrier.llm")

import public_tokenizers as vocabularies  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from terrier.llm import bpe, dedup, licenses, lm, packing, pii, quality, rules, search, urls, wordpieces  # noqa: E402
from terrier.llm.blocks import Block, blocks  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


def strange_texts(n, seed):
    make = random.Random(seed)
    letters = [*"ab 's\n\t'!?.  1²é 　漢字ñ́Th\x1c\x85ΣİẞÀ×<|", "'re", "'ll", " the", "<|endoftext|>", "<|startoftext|>", "\n\n", "   "]
    return ["".join(make.choices(letters, k=make.randint(0, 50))) for _ in range(n)] + ["", None, "a" * 4000, " " * 300]


@pytest.fixture(scope="module")
def docs(spark):
    make = random.Random(5)
    words = ["".join(make.choices("abcdefgh", k=make.randint(2, 6))) for _ in range(400)]
    rows = [(i, " ".join(make.choices(words, k=60)), "x", i) for i in range(60)]
    rows += [(60, rows[0][1], "y", 0), (61, rows[0][1] + " end", "y", 0), (62, None, None, None), (63, "", "", 1), (64, " \n ", "", 1),
             (65, "w " * 30_000, "z", 2), (66, "mail a.b@c.org or 4111 1111 1111 1111 now +1 (437) 555-0689", "z", 2), (66, "mail a.b@c.org or 4111 1111 1111 1111 now +1 (437) 555-0689", "z", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, ids long")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)] + [(41, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name, make", [("byte_bpe_50k.json", bpe.Vocabulary), ("word_bpe_49k.json", wordpieces.WordVocabulary)])
def test_ids_equal_the_library(name, make):
    path = vocabularies.path(name)
    own, library = make(path), Tokenizer.from_file(path)
    for block in blocks([batch(strange_texts(1500, 3))], "text", 20_000):
        ids, counts = own.encode(block)
        ends = np.cumsum(counts)
        for i in range(block.count):
            text = block.text(i).decode()
            want = library.encode(text, add_special_tokens=False).ids
            assert ids[ends[i] - counts[i]: ends[i]].tolist() == want, repr(text)
            if make is bpe.Vocabulary:
                assert own.decode(np.array(want, int)).decode() == library.decode(want, skip_special_tokens=False) == text


def test_encode_decode_rows(docs):
    rows = bpe.encode_decode(docs, vocabularies.path("byte_bpe_50k.json")).collect()
    texts = collections.defaultdict(set)
    for r in docs.collect():
        texts[r.doc_id].add(hashlib.sha256((r.text or "").encode()).hexdigest())
    assert len(rows) == docs.count() and all(r.decoded_sha256 in texts[r.doc_id] for r in rows)


def test_every_id_is_packed_once(spark, docs):
    path = vocabularies.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    pieces = packing.pack(docs.repartition(5), path, windows=3, fan_in=2).collect()
    want = collections.Counter()
    for r in docs.collect():
        want[(r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids) + 1)] += 1
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append([*library.encode(r.text or "", add_special_tokens=False).ids, 1])
    got = collections.Counter()
    for p in pieces:
        got[(p.doc_id, p.doc_tokens)] += p.length
        assert p.ids_crc32 in {zlib.crc32(np.array(ids[p.start: p.start + p.length], "<u4").tobytes()) for ids in texts[p.doc_id]}
    assert got == collections.Counter({k: k[1] * n for k, n in want.items()})
    rows = collections.defaultdict(list)
    for p in pieces:
        rows[p.sequence_id].append((p.offset, p.length))
    for parts in rows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    assert packing.pack(docs.limit(0), path).count() == 0


def test_counts_of_rules(docs, labels):
    fitted = rules.fit(docs, labels)
    for r in rules.judge(docs, fitted).collect():
        text = r.text or ""
        words = WORD.findall(text)
        windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        covered = {k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
        seen, repeats = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                repeats += line in seen
                seen.add(line)
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), repeats, len(covered))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (r.kept and r.base_failed)
    assert rules.judge(docs.limit(0), fitted).count() == 0


def test_quality_scores(docs, labels):
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(docs, quality.fit(docs, labels.limit(0))).count() == docs.count()
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_quality_learns_held_out(spark):
    make = random.Random(9)
    words = ["".join(make.choices("abcdefgh", k=4)) for _ in range(300)]
    good = lambda: " ".join(make.choices(words, k=40))
    rows = [(i, good() if i % 2 else " ".join(w + "***" for w in good().split())) for i in range(400)]
    every = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    model = quality.fit(every.where("doc_id < 300"), marks)
    for r in quality.score(every.where("doc_id >= 300"), model).collect():
        assert (r.score > 0.5) == (r.doc_id % 2 == 1)
    fitted = rules.fit(every.where("doc_id < 300"), marks)
    for r in rules.judge(every.where("doc_id >= 300"), fitted).collect():
        assert (r.probability > 0.5) == (r.doc_id % 2 == 1)


def test_word_vectors_cover_documents_without_labels(spark):
    rows = [(i, f"seen{i} among words") for i in range(20)] + [(20 + i, f"common unseen{i} neighbour") for i in range(200)]
    model = quality.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int"))
    index, want = quality.index_vectors(), np.zeros_like(model.vectors)
    for block in blocks([pa.RecordBatch.from_arrays([pa.array([t for _, t in rows])], names=["text"])], "text"):
        words, _, owner = quality.tokens(block)
        quality.contexts(words, owner, index, want)
    assert np.allclose(model.vectors, quality.unit(want), atol=1e-4)


def test_language_model(docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, held = collections.Counter(), lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [(r.doc_id, WORD.findall((r.text or "").translate(lower)) + [""]) for r in docs.collect()]
    for i, t in tokens:
        if not held(i):
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, t in tokens:
        want[(i, held(i), len(t), sum(counts[x] > 0 for x in t), n, round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), 4))] += 1
    rows = lm.score(docs.repartition(3)).collect()
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert lm.score(docs.limit(0)).count() == 0


def test_feature_table_is_not_halved():
    assert lm.BUCKETS >= 1 << 13


def test_probabilities_sum_to_one():
    p = lm.softmax(np.random.default_rng(1).normal(size=(lm._FEATURES, lm.CLASSES)).astype(np.float32), np.array([[1, lm.BUCKETS, 2 * lm.BUCKETS]]))
    assert abs(float(p.sum()) - 1) < 1e-5


@pytest.mark.parametrize("chunk, heads, copies", [(512, 32, 8), (6, 3, 25)])
def test_classes_equal_brute_force(spark, monkeypatch, chunk, heads, copies):
    """Also with small chunks and turns of heads, which large groups meet."""
    monkeypatch.setattr(dedup, "CHUNK", chunk)
    monkeypatch.setattr(dedup, "MEMBERS", chunk)
    monkeypatch.setattr(dedup, "WORDS", chunk * 300)
    monkeypatch.setattr(dedup, "HEADS", heads)
    make = random.Random(4)
    words = ["".join(make.choices("abcdefgh", k=make.randint(2, 6))) for _ in range(400)]
    rows, n = [], 0
    for _ in range(25):
        base = make.choices(words, k=make.randint(3, 200))
        for _ in range(make.randint(1, copies)):
            copy = list(base)
            for _ in range(make.randint(0, 3)):
                copy[make.randrange(len(copy))] = make.choice(words)
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "same"), (n + 4, "same"), (n + 4, "same")]
    sets = {i: frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if (w := (t or "").split()) else frozenset() for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and (sets[a] == sets[b] or both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == len(rows) and {r.doc_id: r.class_id for r in got} == {i: root(i) for i in sets}
    assert dedup.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeats_and_moved_paragraphs_are_linked(spark):
    make = random.Random(6)
    words = lambda n: ["".join(make.choices("abcdefgh", k=5)) for _ in range(n)]
    rows = []
    for k in range(12):
        if k % 2:
            passage = words(30)
            texts = [passage * 100, passage * (30 if k % 3 else 10)]
        else:
            parts = [words(80) for _ in range(40)]
            texts = [sum(parts, []), sum(make.sample(parts, 40), [])]
        rows += [(2 * k + i, " ".join(t)) for i, t in enumerate(texts)]
    sets = {i: frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) for i, w in ((i, t.split()) for i, t in rows)}
    near = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert near == {(i, i + 1) for i in range(0, 24, 2)}
    got = {r.doc_id: r.class_id for r in dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(a, b) for a in got for b in got if a < b and got[a] == got[b]} == near


def test_large_buckets_meet_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "CHUNK", 4)
    monkeypatch.setattr(dedup, "MEMBERS", 4)
    monkeypatch.setattr(dedup, "WORDS", 4 * 200)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base[:i], f"q{i}", *base[i + 1:]])) for i in range(30)]
    got = dedup.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.class_id for r in got.collect()} == {0}


def every_shingle_once(letters, seed):
    """A text in which each sequence of five of the letters stands once, in an order of the seed."""
    make, ways, path, out = random.Random(seed), {}, [(letters[0],) * 4], []
    while path:
        after = ways.setdefault(path[-1], make.sample(letters, len(letters)))
        if after:
            path.append((*path[-1][1:], after.pop()))
        else:
            out.append(path.pop()[-1])
    return [letters[0]] * 3 + out[::-1]


def test_alignment_decides(spark):
    letters = list("vwxyz")
    one, two = every_shingle_once(letters, 1), every_shingle_once(letters, 2)
    cut = lambda w: {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    assert cut(one) == cut(two) and len(cut(one)) == 5**5
    edited = one[:1000] + ["new"] + one[1000:]
    rows = [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(edited)), (4, " ".join(two[1500:] + two[:1500]))]
    got = {r.doc_id: r.class_id for r in dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 2}


def test_long_chains_of_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r["class"] for r in dedup.components(links).collect()} == {0}


def test_keep_first_keeps_columns(docs):
    kept = dedup.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 0 in ids and 60 not in ids and 61 not in ids


def test_personal_data(docs):
    rows = pii.digest(pii.detect(docs.select("doc_id", "text"))).collect()
    assert len(rows) == docs.count()
    found = next(r for r in rows if r.doc_id == 66)
    assert (found.n_email, found.n_ip, found.n_card, found.n_phone) == (1, 0, 1, 1)
    assert found.spans == "email:5:14,card:18:37,phone:42:59"
    assert found.base_sha256 == hashlib.sha256(found.spans.encode()).hexdigest()
    clean = next(r for r in pii.masked(docs).collect() if r.doc_id == 66)
    assert clean.text == "mail [email] or [card] now [phone]" and pii.masked(docs).columns == docs.columns


def test_base_spans():
    assert pii.base_spans("x 1.2.3.4 999.1.1.1 " + "0" * 6000 + ".1.1.1") == [("ip", 2, 9), ("ip", 20, 6026)]
    assert pii.base_spans("a@b a@b.c@d.e") == [("email", 4, 9)]


def test_spans_equal_the_plain_patterns():
    make = random.Random(8)
    plain = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(20_000):
        text = "".join(make.choices("ab1.@@-_% é2", k=make.randint(0, 40)))
        assert pii.emails(text) == [("email", *m.span()) for m in pii.EMAIL.finditer(text)], text
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in plain.finditer(text)], text


def test_long_runs_take_linear_time():
    n = 400_000
    text = "a" * n + " @ " + "1" * n + " " + "-" * n + "1 x@y.z"
    assert [s[0] for s in pii.base_spans(text)] == ["email"]
    assert not list(pii._SECRET.finditer("_" * n + " 1"))
    found = licenses.detect("mit license, " * 20_000)
    assert len(found) == 20_000


def test_licenses():
    found = {}
    texts = ["MIT License and the Apache-License; not mitlicense", "GNU General Public License, version 3", None, "", "licensed under the Apache License, Version 2.0", "nothing émit license"]
    for block in blocks([batch(texts)], "text", lower=True):
        starts, _ = block.split(licenses.OUTSIDE)
        found = {i: licenses.judge(block, i, starts) for i in range(block.count)}
    assert found[0][:4] == (2, 0, 4, "apache,mit") and found[1][:4] == (1, 1, 1, "gpl") and found[2][0] == 0
    assert found[4][4] == "apache" and found[5][0] == 0 and len(licenses.rules()) > 200


def test_wrapped_headers_meet_their_rules():
    make = random.Random(3)
    phrases = [t for texts in licenses.SENTENCES.values() for t in texts]
    for names, stems, versions in licenses.LICENSES.values():
        phrases += [f"{n} license" for n in names] + [f"released under the {n}" for n in names] + [f"{n} license, version {v}" for n in names for v in versions]
        phrases += [f"spdx-license-identifier: {x}" for x in stems] + [f"{x}-{v}" for x in stems for v in versions]
    wraps = [" ", "\n", "\n * ", "\n# ", "\n// ", "  ", "\u00a0", "\t"]
    lost = []
    for phrase in phrases:
        for text in ("".join(w + make.choice(wraps) for w in phrase.split()), phrase.replace(" ", "\n# "), phrase):
            every = licenses.settle([(m.start(), m.end(), x) for x in licenses.rules() for m in x.pattern.finditer(text)])
            lost += [text] * (licenses.detect(text) != every)
    assert not lost
    for text in ("all rights\n * reserved", "mozilla\n# public license, version 2.0", "permission is\nhereby granted, free of charge, to any person obtaining a copy"):
        block = next(blocks([batch(["other", text])], "text", lower=True))
        assert licenses.suspects(block, licenses.prefilter()[1]) == [1] and licenses.detect(text)


def test_license_rows(docs):
    rows = licenses.scan(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)


def test_urls(spark, labels):
    pages = spark.createDataFrame([
        (1, "https://WWW.example.com/en/1"), (2, "http://m.example.com/en/2?x=1"), (3, "a.net/es/"), (4, None), (5, "ftp://b.net/es/#://c.com/"),
        (5, "ftp://b.net/es/#://c.com/"), (6, "x://com"), (7, "x://telecom/"), (8, "x://b.org/q")], "page_id long, url string").selectExpr("*", "url AS tokens")
    got = collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, labels).collect())
    want = {(1, "www.example.com", "/en/1", "www.example.com/en/", "allow"): 1, (2, "m.example.com", "/en/2", "example.com/en/", "block"): 1,
            (3, "", "", None, "allow"): 1, (4, "", "", None, "allow"): 1, (5, "b.net", "/es/", "net/es/", "block"): 2}
    assert all(got[k] == n for k, n in want.items())
    assert sorted(k[3] or "" for k in got if k[0] > 5) == ["", "", ""]


def test_mined_rules_block(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 4 == 0 else 'good'}{i % 2}.org/p/{i}") for i in range(400)], "page_id long, url string")
    marks = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    for r in urls.judge(pages, marks).collect():
        assert r.verdict == ("block" if r.host.startswith("bad") else "allow")


def test_rare_blocked_hosts_become_rules(spark):
    host = lambda i: "spam.farm" if i % 600 == 0 else "twin.page/a/b/c/d/e/f/g/h/i/j/k/l/m/n/o/p/q/r/s/t/u/v/w/x/y/z" if i % 600 == 1 else f"good{i % 7}.org"
    pages = spark.createDataFrame([(i, f"http://{host(i)}/p/{i}") for i in range(6000)], "page_id long, url string")
    marks = spark.createDataFrame([(i, int(i % 600 > 1 and i % 10 != 3), 0) for i in range(3000)], "doc_id long, quality int, toxic int")
    for r in urls.judge(pages, marks).collect():
        assert r.verdict == ("allow" if r.host.startswith("good") else "block")


def test_chance_is_no_url_rule(spark):
    # Each host has 3 of 5 rows blocked, which is also the share of all rows.
    pages = spark.createDataFrame([(i, f"http://h{i // 5}.org/p/") for i in range(1000)], "page_id long, url string")
    marks = spark.createDataFrame([(i, int(i % 5 > 2), 0) for i in range(1000)], "doc_id long, quality int, toxic int")
    assert {r.verdict for r in urls.judge(pages, marks).collect()} == {"allow"}


def all_rules(rows, least, confidence):
    """Rules from all combinations of tokens: (tokens, share of blocked rows)."""
    bound = lambda h, n: (h / n + 1.645**2 / (2 * n) - 1.645 * math.sqrt(h / n * (1 - h / n) / n + 1.645**2 / (4 * n * n))) / (1 + 1.645**2 / n)
    every = {frozenset(c) for t, b in rows if b for k in range(1, len(t) + 1) for c in itertools.combinations(sorted(t), k)}
    found = {}
    for c in every:
        has = [b for t, b in rows if c <= t]
        if sum(has) >= least and sum(has) / len(has) >= confidence and bound(sum(has), len(has)) > sum(b for _, b in rows) / len(rows):
            found[c] = sum(has) / len(has)
    return {c: x for c, x in found.items() if not any(d < c and found[d] >= x for d in found)}


@pytest.mark.parametrize("longest", [12, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_url_rules_equal_all_combinations(spark, monkeypatch, longest, seed):
    monkeypatch.setattr(urls, "LONGEST", longest)
    make = random.Random(seed)
    rows = []
    for _ in range(300):
        tokens = frozenset(make.sample("abcdefgh", make.randint(0, 5)))
        rows.append((tokens, make.random() < (0.9 if {"a", "b"} <= tokens or {"c", "d", "e"} <= tokens else 0.15)))
    rows += [(frozenset("xyz"), True)] * 4 + [(frozenset("xyw"), True)] * 2 + [(frozenset("x"), False)] * 2
    rows = [(t, b) for t, b in rows if t]
    frame = spark.createDataFrame([(sorted(t), b) for t, b in rows], "tokens array<string>, blocked boolean")
    got = urls.mine(frame, 3, 0.6).collect()
    want = all_rules(rows, 3, 0.6)
    assert len(want) >= 3
    assert {frozenset(p for part in r.need for p in part): round(r.confidence, 9) for r in got} == {c: round(x, 9) for c, x in want.items()}


def test_long_url_of_common_tokens(spark):
    long = [f"t{i}" for i in range(40)]
    rows = [(long, True)] * 3 + [([t, f"own{t}"], False) for t in long] + [(["other"], False)] * 200
    got = urls.mine(spark.createDataFrame(rows, "tokens array<string>, blocked boolean"), 3, 0.6).collect()
    assert {tuple(sorted(p for part in r.need for p in part)) for r in got} == {
        c for k in (1, 2) for c in itertools.combinations(sorted(long), k)}         # 3 of 4 rows, then 3 of 3
    pages = spark.createDataFrame([(i, "http://bad.org/" + "/".join("abcdefghijklmnopqrstuvwxyz")) for i in range(4)], "page_id long, url string")
    assert {r.verdict for r in urls.judge(pages, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()} == {"allow"}
    assert urls.judge(pages.limit(0), spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")).count() == 0


def test_search_equals_brute_force(spark):
    make = np.random.default_rng(3)
    rows = [(i, make.normal(size=8).round(1).tolist()) for i in range(300)]
    rows += [(300, None), (350, [1.0] * 8), (351, [float("nan")] * 8), (352, [1.0, None] * 4), (353, [1.0] * 3), (100, rows[100][1])]
    got = collections.defaultdict(list)
    for r in search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard=40, block=3).orderBy("rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    good = [(i, np.floor(256 * np.array(v))) for i, v in rows if v and len(v) == 8 and None not in v and np.isfinite(v).all()]
    for q, x in dict((i, v) for i, v in good if i % 50 == 0 and i != 100).items():
        want = sorted(((-int(x @ v), i) for i, v in good if i != q))[:5]
        assert got[q] == [(i, -s) for s, i in want]
    assert search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
def test_stages_keep_columns(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, data)
        assert after.columns == docs.columns and 0 < after.count() <= docs.count()
        if name == "quality_classifier":
            assert set(after.select("doc_id").toPandas()["doc_id"]) <= set(range(10**6))


def test_empty_tables(docs, labels):
    none = docs.limit(0)
    assert pii.digest(pii.detect(none.select("doc_id", "text"))).count() == 0 and pii.masked(none).count() == 0
    assert licenses.scan(none).count() == 0
    assert quality.keep_good(none, labels).count() == 0
