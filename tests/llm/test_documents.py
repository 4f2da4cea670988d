"""Operators on documents against plain Python, on rows with nulls, empty and long texts, copies and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from martlet.llm import license_rules, line_templates, mixing, ngram_join, repetition, simhash, window_dedup

SPACE = "[ \t-\r]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def make_texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["Äther", "ß", "naïve", "#", "a|b"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = prose(120), prose(60)
    texts = [None, "", " \n\t ", "one", "One  two\nTHREE four", base, base, base.upper(), prose(3000)]
    for i in range(12):  # near copies
        parts = base.split()
        parts[10 * i] = f"edit{i}"
        texts.append(" ".join(parts))
    texts += [f"{prose(30)} {passage}\n{prose(25)}" for _ in range(6)]
    texts += [("To " * 40).strip(), "same line here now\n" * 8, "x" * 50_000, passage + " " + passage]
    texts += [f"user {i} logged in from host{i}\n{prose(15)}\nPage {i} of 30" for i in range(14)]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{i % 4}", 5, "clash", i) for i, t in enumerate(make_texts())]
    rows += [rows[6], rows[9], (None, make_texts()[5], None, None, None, "clash", 0), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, k string, leaf long").repartition(3)


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


def empty(docs):
    return docs.limit(0)


def answers(df, *keys):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_repetition(docs, rows):
    expected = []
    for r in rows:
        w, text = words(r.text), r.text or ""
        def repeated(size):
            windows = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
            times = Counter(windows)
            return [i for i, x in enumerate(windows) if times[x] > 1]

        twice = {j for i in repeated(5) for j in range(i, i + 5)}
        covered = {j for i in repeated(repetition.MIN_REPEAT) for j in range(i, i + repetition.MIN_REPEAT)}
        top = 0
        while repeated(top + 1):
            top += 1
        lines = [x for x in text.split("\n") if words(x)]
        failed = len(w) < 10 or 100 * len(twice) > 20 * len(w)
        kept = not failed and 100 * len(covered) <= repetition.MAX_COVERED * len(w) and top <= repetition.MAX_LONGEST
        symbols = len(re.findall("[#*$%&|<>]", text))
        expected.append((r.doc_id, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(twice), len(covered), top, failed, kept))
    assert answers(repetition.judge_documents(docs)) == sorted(expected, key=str)
    kept = repetition.keep_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(e[-1] for e in expected)
    assert repetition.keep_documents(empty(docs)).count() == 0 == repetition.judge_documents(empty(docs)).count()


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components_of(rows):
    sets = [shingles(r.text) for r in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return sets, group


@pytest.mark.parametrize("bucket", [None, 400])
def test_ngram_join(docs, rows, bucket, monkeypatch):
    if bucket:  # several buckets, and several parts that they send back to
        monkeypatch.setattr(ngram_join, "BUCKET_SHINGLES", bucket)
    sets, group = components_of(rows)
    expected = []
    for r, s, g in zip(rows, sets, group):
        ids = [x.doc_id for x, h in zip(rows, group) if h == g and x.doc_id is not None]
        expected.append((r.doc_id, len(s), (min(ids) if ids else None) if s else r.doc_id))
    assert answers(ngram_join.link_documents(docs)) == sorted(expected, key=str)
    assert ngram_join.link_documents(empty(docs)).count() == 0


def test_a_class_sends_its_key_once(spark, monkeypatch):
    texts = [" ".join(f"w{(i * 7919 + j * 31) % 100003}" for j in range(60)) for i in range(200)]
    # each text twice or more in its task, five of them in both
    rows = list(enumerate(texts[:100] * 2 + texts[:5] + texts[100:] * 2 + texts[:5]))
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    sets = ngram_join.document_sets(docs)
    bitmap = ngram_join.repeated_keys(sets.dropDuplicates(["set_key"]), 410)
    assert not bitmap.any() and ngram_join.repeated_keys(sets, 410).any()
    sent = ngram_join._send_shingles(docs, 40, bitmap).collect()
    # the rest are numbers, of which the high bytes compress; a bucket has some runs of all classes
    assert len(sent) == 80 and sum(len(r.set_keys) for r in sent) == ngram_join.KEY_BYTES * 205
    assert sum(len(zlib.compress(r.ids)) for r in sent) < 3 * sum(len(r.counts) // 4 for r in sent)
    expected = answers(ngram_join.link_documents(docs))
    assert len({r[2] for r in expected}) < len(rows)
    # the bitmap decides how classes are named, not what is found
    for byte in (0, 255):
        monkeypatch.setattr(ngram_join, "repeated_keys", lambda *_, b=byte: np.full(1 << 12, b, np.uint8))
        monkeypatch.setattr(ngram_join, "BUCKET_SHINGLES", 1000)
        assert answers(ngram_join.link_documents(docs)) == expected


def test_keep_one(docs, rows):
    sets, group = components_of(rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(str(r.doc_id) for r in kept.collect())
    expected = [str(r.doc_id) for r, s in zip(rows, sets) if not s]
    for g in {g for g, s in zip(group, sets) if s}:
        ids = [r.doc_id for r, h in zip(rows, group) if h == g]
        expected.append(str(min((i for i in ids if i is not None), default=None)))
    assert got == sorted(expected)


def test_filters_lose_no_pair():
    for n in range(1, 60):
        for m in range(1, 60):
            need = ngram_join.needed_overlap(n, m)
            assert all((100 * k >= 75 * (n + m - k)) == (k >= need) for k in range(min(n, m) + 1))
        assert ngram_join.prefix_length(n) == n - -(-3 * n // 4) + 1


@pytest.mark.parametrize("bytes_per_cell", [None, 0.005])
def test_window_dedup(docs, rows, bytes_per_cell, monkeypatch):
    if bytes_per_cell:  # several chunks
        monkeypatch.setattr(window_dedup, "BYTES_PER_CELL", bytes_per_cell)
    order = sorted(range(len(rows)), key=lambda i: (rows[i].doc_id is None, rows[i].doc_id or 0))
    first, expected = {}, []
    for i in order:
        w = words(rows[i].text)
        for s in range(len(w) - 19):
            first.setdefault(tuple(w[s : s + 20]), (rows[i].doc_id, rows[i].text, s))
    for r in rows:
        w = words(r.text)
        gone = {j for s in range(len(w) - 19) if first[tuple(w[s : s + 20])] != (r.doc_id, r.text, s) for j in range(s, s + 20)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        expected.append((r.doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert answers(window_dedup.remove_repeats(docs)) == sorted(expected, key=str)
    assert window_dedup.remove_repeats(empty(docs)).count() == 0


def fingerprint(text):
    votes = [0] * 64
    terms = list(dict.fromkeys(words(text)))
    for t in terms:
        h = xxhash.xxh64_intdigest(t.encode(), seed=42)
        votes = [v + (len(t) if h >> i & 1 else 0) for i, v in enumerate(votes)]
    return sum(1 << i for i, v in enumerate(votes) if 2 * v > sum(map(len, terms)))


def test_simhash(spark, docs):
    unique = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = sorted(unique.collect(), key=lambda r: -r.doc_id)
    texts = [r.text or "" for r in rows]
    prints = [fingerprint(t) for t in texts]
    expected = []
    for i, r in enumerate(rows):
        n, j = len(texts[i]), (i + 1) % len(rows)
        edited = texts[i][: n - n // 3] + texts[j][: n // 3]
        e = fingerprint(edited)
        like = lambda a, b: 1 - (a ^ b).bit_count() / 64
        near = sum((p ^ prints[i]).bit_count() <= simhash.RADIUS for p in prints) if r.doc_id % 20 == 0 else None
        digest = hashlib.sha256(edited.encode()).hexdigest()
        expected.append((r.doc_id, n, digest, f"{prints[i]:016x}", f"{e:016x}", like(prints[i], e), like(prints[i], prints[j]), near))
    assert answers(simhash.compare_edits(unique)) == sorted(expected, key=str)
    # with repeated rows and null ids every row still has one result, and equal rows equal ones
    whole = simhash.compare_edits(docs)
    assert whole.count() == docs.count()
    assert simhash.compare_edits(empty(docs)).count() == 0


def test_radius_search(spark):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(40)]
    values += [v ^ sum(1 << b for b in rng.sample(range(64), k)) for v in values for k in (1, 2, 3, 4, 5)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed + signed[:9] + [None]], "fingerprint long")
    got = {tuple(r) for r in simhash.within_radius(frame.limit(60), frame).collect()}
    asked = {r.fingerprint for r in frame.limit(60).collect()}
    distance = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    assert got == {(a, b, distance(a, b)) for a in asked for b in signed if distance(a, b) <= simhash.RADIUS}


def tokens_of(line):
    return ["<*>" if re.search("[0-9]", t) else t for t in re.split("[ \t\x0b\f\r]+", line) if t]


@pytest.mark.parametrize("at_least", [3, 10])
def test_line_templates(docs, rows, at_least):
    texts = {}
    for r in rows:
        if r.text is not None:
            texts.setdefault(r.text, []).append(r.doc_id)
    first = {t: min(((i is None, i or 0) for i in ids)) for t, ids in texts.items()}
    lines = [(t, n, tuple(tokens_of(x))) for t in texts for n, x in enumerate(t.split("\n"))]
    holders, keeper = {}, {}
    for t, n, k in lines:
        holders.setdefault(k, set()).add(t)
    exact = {k for k, s in holders.items() if k and len(s) >= at_least}
    leaves = {}
    for t, n, k in lines:
        if k in exact:
            keeper[t, n] = min(first[x] for x in holders[k])
        elif k:
            leaves.setdefault((len(k), k[:3]), []).append((t, n, k))
    for group in leaves.values():
        if len({t for t, _, _ in group}) < at_least:
            continue
        fixed = []
        for p in range(len(group[0][2])):
            column = [k[p] for _, _, k in group]
            token = min(set(column), key=lambda x: (-column.count(x), x))
            fixed.append(token if 2 * column.count(token) >= len(group) else None)
        held = sum(f is not None for f in fixed)
        fit = [(t, n) for t, n, k in group if 4 * sum(a == b for a, b in zip(k, fixed)) >= 3 * held]
        if 2 * held >= len(fixed) and len({t for t, _ in fit}) >= at_least:
            keeper |= {x: min(first[t] for t, _ in fit) for x in fit}
    expected = []
    for r in rows:
        if r.text is None:
            expected.append(None)
        else:
            own = (r.doc_id is None, r.doc_id or 0)
            expected.append("\n".join(x for n, x in enumerate(r.text.split("\n")) if keeper.get((r.text, n), own) == own))
    got = line_templates.drop_templates(docs, at_least)
    assert got.columns == docs.columns and keeper
    got = got.collect()
    assert sorted((str(r.doc_id), r.text) for r in got if r.text is not None) == sorted((str(r.doc_id), e) for r, e in zip(rows, expected) if e is not None)
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) and r.k in ("clash", None) for r in got)
    assert line_templates.drop_templates(empty(docs)).count() == 0 == line_templates.summary(empty(docs)).count()


def test_license_scan(spark):
    texts = [
        None, "", "MIT License", "the mit-license, mit  license; Mit licenses", "CC BY 4.0 and CC-BY-NC 4.0",
        "Licensed under the Apache License, Version 2.0.\nSPDX-License-Identifier: MIT", "gnu general public license, version 3 x",
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software", "no word of it", "ccby apachelicense",
        "Ä MIT License ü " * 300, "all rights reserved", "CC BY",
    ]
    docs = spark.createDataFrame([(i % 9, t, "x", "y") for i, t in enumerate(texts + texts[:5])], "doc_id long, text string, labels string, rule string")
    expected = []
    for i, t in enumerate(texts + texts[:5]):
        lower = (t or "").lower()
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
        places = [(at, label) for label, p in license_rules.PHRASES.items() for at in range(len(w)) if w[at : at + len(p.split())] == p.split()]
        found = []
        for order, label, priority, weight, keyword, pattern in license_rules.build_signatures():
            if keyword in lower:
                found += [(m.start(), m.end(), order, label, priority, weight) for m in re.finditer(pattern, lower)]
        # suppressed by a container of higher priority, or of the same and longer or earlier in order
        left = [
            d for d in found
            if not any(e[0] <= d[0] and d[1] <= e[1] and (e[4] > d[4] or e[4] == d[4] and ((e[0], e[1]) != (d[0], d[1]) or e[2] < d[2])) for e in found if e != d)
        ]
        base = sorted({label for _, label in places})
        labels = sorted({d[3] for d in left} | set(base))
        score = max([d[5] for d in left] + [0.9] * bool(base), default=0.0)
        ats = [at for at, _ in places]
        expected.append((i % 9, len(w), len(ats), min(ats, default=None), max(ats, default=None), ",".join(base), ",".join(labels), len(left), score))
    assert answers(license_rules.scan(docs)) == sorted(expected, key=str)
    assert license_rules.scan(docs.limit(0)).count() == 0
    assert len(license_rules.build_signatures()) >= 200


def examples(parsed):
    """Texts that a parsed regular expression matches: the fewest repeats, each alternative once."""
    out = [""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            more = [chr(value)]
        elif name == "IN":
            more = [next((chr(v if str(k) == "LITERAL" else v[0]) for k, v in value if str(k) in ("LITERAL", "RANGE")), " " if "SPACE" in str(value) and "NOT" not in str(value) else "x")]
        elif name == "ANY":
            more = ["x"]
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            more = [x * value[0] for x in examples(value[2])]
        elif name == "BRANCH":
            more = [x for v in value[1] for x in examples(v)]
        elif name == "SUBPATTERN":
            more = examples(value[3])
        else:  # borders and looking ahead
            more = [""]
        out = [a + b for a in out for b in more]
    return out


def test_every_signature_passes_its_gates():
    for _, label, _, _, keyword, pattern in license_rules.build_signatures():
        for text in examples(re._parser.parse(pattern)):
            assert re.search(pattern, text) and keyword.strip() in text, (label, text)
            assert re.search(license_rules.GATE_PATTERN, text), (label, text)
    for text in examples(re._parser.parse(license_rules.GATE_PATTERN)):
        assert any(w in text for w in license_rules.GATE_WORDS) or re.search(r"\bcc[0 -]", text), text


def test_mixture(docs, rows):
    plan = mixing.mixture_plan(docs, budget_percent=100, max_epochs=2)
    got = plan.collect()
    assert len(got) == len(rows)
    assert all(r.n_tokens == len(words(next(x.text for x in rows if x.doc_id == r.doc_id))) for r in got if r.doc_id is not None)
    total = sum(r.n_tokens for r in got)
    taken = sum(r.epochs * r.n_tokens + r.prefix_tokens for r in got)
    assert total - 5 <= taken <= total  # rows that tie share what is left, rounded down
    leaves = {}
    for r in got:
        leaves.setdefault((r.domain, r.lang, r.source), []).append(r)
    for leaf in leaves.values():
        assert len({r.epochs for r in leaf}) == 1 and leaf[0].epochs <= 2
        assert sum(0 < r.prefix_tokens < r.n_tokens for r in leaf) <= 2
    mixed = mixing.mix_documents(docs, budget_percent=100, max_epochs=2)
    assert mixed.columns == docs.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == taken
    assert mixing.mix_documents(empty(docs)).count() == 0 == mixing.mixture_plan(empty(docs)).count()


def test_budgets_fall_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("crawl", "en", "a", 10), ("crawl", "en", "b", 1000), ("crawl", "de", "c", 1000), ("curated", "en", "d", 50), ("community", "x", "e", 0)],
        "domain string, lang string, source string, available long",
    )
    weights = {("crawl",): 1, ("curated",): 1, ("community",): 1}
    got = {r.source: r.budget for r in mixing.leaf_budgets(leaves, weights, 20, 1).collect()}
    # 412 in all: curated holds 50 and community nothing, so crawl gets 362, half for each language; a is short
    assert got == {"a": 10, "b": 171, "c": 181, "d": 50, "e": 0}
