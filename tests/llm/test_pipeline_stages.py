"""Each pipeline stage against a plain version on what the stage before it kept."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from martlet.llm import line_templates, mixing, repetition, sentencepiece_sampling
from tests.conftest import SF_DIR
from tests.llm.test_documents import LOWER, words


@pytest.fixture(scope="module")
def states(spark, tmp_path_factory):
    """The documents before each stage and after the last one."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality_rules(states):
    def kept(text):
        w = words(text)

        def covered(size):
            windows = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
            times = Counter(windows)
            return len({j for i, x in enumerate(windows) if times[x] > 1 for j in range(i, i + size)})

        failed = len(w) < 10 or 100 * covered(5) > 20 * len(w)
        return not failed and 100 * covered(repetition.MIN_REPEAT) <= repetition.MAX_COVERED * len(w) and not covered(repetition.MAX_LONGEST + 1)

    before, after = texts(states[0]), texts(states[1])
    assert set(after) == {d for d, r in before.items() if kept(r.text)} and len(after) < len(before)
    assert all(before[d] == r for d, r in after.items())


def test_line_dedup(states):
    before, after = texts(states[1]), texts(states[2])
    assert set(before) == set(after)

    def mask(line):
        return " ".join("<*>" if re.search("[0-9]", t) else t for t in re.split("[ \t\x0b\f\r]+", line.strip(" \t\x0b\f\r")))

    seen = defaultdict(set)
    for r in before.values():
        for line in r.text.split("\n"):
            if mask(line):
                seen[mask(line)].add(r.text)
    first = {}
    for d in sorted(before):
        for line in before[d].text.split("\n"):
            first.setdefault(mask(line), d)
    dropped = 0
    for d, r in after.items():
        assert r.n_chars == (before[d].n_chars if r.text == before[d].text else len(r.text))
        left = Counter(r.text.split("\n"))
        for line, n in Counter(before[d].text.split("\n")).items():
            m = mask(line)
            if not m or not line_templates.MIN_DOCUMENTS <= len(seen[m]):
                continue  # blank, or a matter of the templates of a leaf (tests/llm/test_templates.py)
            assert left[line] == (n if first[m] == d else 0), line
            dropped += n - left[line]
    assert dropped > 0


def test_near_duplicates(states):
    before, after = texts(states[2]), texts(states[3])

    def shingles(text):
        w = words((text or "").translate(LOWER))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {d: shingles(r.text) for d, r in before.items()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    groups = defaultdict(list)
    for d in ids:
        groups[find(d)].append(d)
    assert len(after) == len(groups) < len(before)
    assert all(sum(d in after for d in g) == 1 for g in groups.values())
    assert all(before[d] == r for d, r in after.items())


def test_source_mixture(states):
    con = duckdb.connect()
    con.register("documents", states[3].toArrow())
    cursor = con.execute(mixing.ORACLE)
    at = {d[0]: i for i, d in enumerate(cursor.description)}
    before, expected = texts(states[3]), Counter()
    for row in cursor.fetchall():
        text = before[row[at["doc_id"]]].text
        expected[row[at["doc_id"]], text] += row[at["epochs"]]
        if n := row[at["prefix_tokens"]]:
            ends = [m.end() for m in re.finditer("[^ \t-\r]+", text)]
            expected[row[at["doc_id"]], text if n == len(ends) else text[: ends[n - 1]]] += 1
    assert Counter((r.doc_id, r.text) for r in states[4].collect()) == +expected


def test_samples(states):
    before = Counter((r.doc_id, r.text) for r in states[4].collect())
    rows = sentencepiece_sampling.decode(states[5]).collect()
    assert Counter((r.doc_id, r.decoded) for r in rows if r.sample == 1) == before
    pairs = defaultdict(set)
    for r in rows:
        assert 0 < r.inclusion <= 1 and r.n_pieces == len(r.ids)
        pairs[r.doc_id, r.decoded].add(tuple(r.ids))
    # copies of a row draw alike, so a document's two samples are all there is of it
    assert {len(x) for x in pairs.values()} == {2}
