"""Archives, URL rules, segmentations and the queries as a whole."""

from __future__ import annotations

import hashlib
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from checks.compare import difference
from martlet.llm import sentencepiece_sampling, url_rules, warc_store
from martlet.llm.components import components
from martlet.llm.queries import ORACLE, QUERIES
from martlet.session import scratch_dir
from tests.conftest import SF_DIR


# the SQL of the repetition rules takes minutes; the plain Python version covers it
@pytest.mark.parametrize("name", [n for n in ORACLE if n != "op9_repetition_quality"])
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


@pytest.fixture(scope="module")
def pages(spark):
    body = "<p>" + "x" * 200 + "</p>\r\n\r\nWARC/1.1\r\nend"
    rows = [
        (5, "http://a.Example.org/es/x?q#f", body, "n"), (3, "https://example.org/en/12", body, "n"), (3, "https://example.org/en/12", body, "n"),
        (9, None, body, "n"), (None, "no scheme", body, None), (7, "x://y://com/fr/", "small", "n"), (8, "http://shop.com/de/1", "small", "n"),
        (10, "http://", None, "n"), (11, "http://org", "", "n"), (12, "a\r\nb://com/fr/\n", "ü" * 60, "n"), (13, "http://notexample.org/es/", "ü" * 60, "n"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, header string").repartition(2)


def test_archive_round_trip(spark, pages):
    path = scratch_dir(spark, "warc-test")
    warc_store.write_archive(pages, path)
    got = warc_store.parse_records(warc_store.read_archive(spark, path)).collect()
    rows = pages.collect()
    payloads = [(r.page_id, (r.html or "").encode()) for r in rows]
    first = {}
    for i, p in payloads:
        if i is not None:
            first[p] = min(first.get(p, i), i)
    expected = []
    for i, p in payloads:
        again = len(p) >= 100 and i != first.get(p)
        expected.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first[p] if again else None))
    assert sorted(map(str, [tuple(r)[:5] for r in got])) == sorted(map(str, expected))
    assert spark.read.parquet(f"{path}/payloads").count() == len({p for _, p in payloads})
    records = warc_store.read_archive(spark, path)
    whole = records.select(warc_store.record_bytes(records.header, records.payload).alias("r")).collect()
    assert all(r.r.startswith(b"WARC/1.1\r\n") and r.r.endswith(b"\r\n\r\n") for r in whole)


def test_damaged_archive_raises(spark, pages):
    path = scratch_dir(spark, "warc-damaged")
    warc_store.write_archive(pages, path)
    spark.read.parquet(f"{path}/payloads").selectExpr("digest", "encode('other', 'UTF-8') AS payload").write.parquet(f"{path}/x/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}/x/headers")
    with pytest.raises(Exception, match="payload missing or damaged"):
        warc_store.read_archive(spark, f"{path}/x").collect()
    warc_store.write_archive(pages.limit(0), f"{path}/empty")
    assert warc_store.read_archive(spark, f"{path}/empty").count() == 0


def test_url_rules(spark, pages):
    got = url_rules.judge_urls(pages, url_rules.base_rules(spark)).collect()
    expected = []
    for r in pages.collect():
        host = path = ""
        if r.url and "://" in r.url:
            rest = r.url.split("://", 1)[1]
            cut = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
            rest = rest[:cut]
            at = rest.index("/") if "/" in rest else len(rest)
            host, path = rest[:at].lower(), rest[at:]
        fits = [(len(h + p), len(h), v, h + p) for h, p, v in url_rules.BASE_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        expected.append((r.page_id, host, path, best and best[3], best[2] if best else "allow"))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert url_rules.judge_urls(pages.limit(0), url_rules.base_rules(spark)).count() == 0
    none = url_rules.judge_urls(pages, url_rules.base_rules(spark).limit(0), "block").collect()
    assert len(none) == pages.count() and {r.verdict for r in none} == {"block"}


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101), (7, 7), (200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


MODEL = sentencepiece_sampling.default_model()


def segmentations(s):
    return [tuple(s.ids[a:b].tolist()) for a, b in zip(s.borders[:-1], s.borders[1:])]


def test_sampling_without_replacement_has_the_right_odds():
    n = 20_000
    s = sentencepiece_sampling.sample_texts(["the cat"] * n, np.arange(n), 2, MODEL)
    ids = segmentations(s)
    p = {i: np.exp(x) for i, x in zip(ids, s.log_prob)}
    by_text = defaultdict(list)
    for t, i in zip(s.text, ids):
        by_text[t].append(i)
    first, second = Counter(x[0] for x in by_text.values()), Counter(x[1] for x in by_text.values())
    assert all(x[0] != x[1] for x in by_text.values())
    for i, q in p.items():
        then = sum(p[a] * q / (1 - p[a]) for a in p if a != i)
        assert abs(first[i] / n - q) < 0.02 and abs(second[i] / n - then) < 0.02
    # Horvitz-Thompson: 1 / inclusion weighs each sample, so indicators average to probabilities
    top = max(p, key=p.get)
    weighed = sum(q / w for i, q, w in zip(ids, np.exp(s.log_prob), s.inclusion) if i == top) / n
    assert abs(weighed - p[top]) < 0.02


@pytest.mark.parametrize("word", ["IllegalArgumentException", "IllegalArgumentExecutionContext", "representativesExecutionContextaddEventListener", "international"])
def test_long_words_take_milliseconds(word):
    sentencepiece_sampling.sample_texts([word], np.array([0]), 2, MODEL)
    began = time.perf_counter()
    s = sentencepiece_sampling.sample_texts([word] * 40, np.arange(40), 4, MODEL)
    assert time.perf_counter() - began < 0.4
    for t in range(40):
        own = [i for i, x in zip(segmentations(s), s.text) if x == t]
        assert len(set(own)) == len(own) == 4


def every_path(lat, at, end):
    if at == end:
        return [(0.0, ())]
    edges = range(int(lat.first[at]), int(lat.first[at] + lat.degree[at]))
    return [(float(lat.log_p[e]) + p, (e, *path)) for e in edges for p, path in every_path(lat, at + int(lat.length[e]), end)]


@pytest.mark.parametrize("used", [1, 2, 3])
def test_what_is_left_after_near_certain_choices(used):
    """Draws beside used choices of nearly all the probability follow the others' own odds, also for one path of over 0.999."""
    m = sentencepiece_sampling._matcher(MODEL)
    search = sentencepiece_sampling._Search(["inter"], np.array([1], np.uint64), m)
    lat = search.lat
    lat.log_p[lat.first[0]] = 0.0  # one choice of the first node has all but some 1e-18
    lat.log_p[lat.first[0] + 1 : lat.first[0] + lat.degree[0]] = np.log(np.arange(1, lat.degree[0]) * 1e-18)
    paths = sorted(every_path(lat, 0, 6), reverse=True)
    assert len(paths) > used + 8
    gone = [list(p) for _, p in paths[:used]]
    tree = sentencepiece_sampling._Used(lat, 0, gone)
    odds = {p: np.exp(x) for x, p in paths[used:]}
    total = sum(odds.values())
    assert abs(tree.left[0] / total - 1) < 1e-9
    rng = np.random.default_rng(used)
    n = 20_000
    drawn = Counter(tuple(tree.draw(rng.random(6).tolist())[0]) for _ in range(n))
    assert set(drawn) <= set(odds)
    assert all(abs(drawn[p] / n - q / total) < 0.015 for p, q in odds.items())
    assert sentencepiece_sampling._Used(lat, 0, [list(p) for _, p in paths]).left[0] == 0


def test_few_segmentations_are_all_drawn():
    s = sentencepiece_sampling.sample_texts(["", "a", "xa"], np.array([1, 2, 3]), 50, MODEL)
    ids = segmentations(s)
    for t in range(3):
        own = [i for i, x in zip(ids, s.text) if x == t]
        total = sum(np.exp(lp) for lp, x in zip(s.log_prob, s.text) if x == t)
        assert len(own) == len(set(own)) and abs(total - 1) < 1e-6
    assert ids[0] == () and np.allclose(s.inclusion, 1)
    assert all(a >= b or x != y for a, b, x, y in zip(s.perturbed, s.perturbed[1:], s.text, s.text[1:]))


def test_texts_decode_to_themselves(spark):
    texts = ["plain words", "  two  spaces ", "literal ▁ and \U0001f600 \x00 line\n\ttab", "", None, "ünï ひらがな 漢字", "y" * 3000, "a b " * 2000]
    docs = spark.createDataFrame([(i % 6, t, "c") for i, t in enumerate(texts)] + [(None, "null id", "c"), (0, texts[0], "c")], "doc_id long, text string, ids string")
    encoded = sentencepiece_sampling.encode_samples(docs, 3)
    back = sentencepiece_sampling.decode(encoded).collect()
    assert {(r.doc_id, r.decoded) for r in back} == {(r.doc_id, r.text or "") for r in docs.collect()}
    per = Counter((r.doc_id, r.sample) for r in back)
    assert per[0, 1] == 3 and per[None, 1] == 1 and per[3, 1] == 1
    digests = sentencepiece_sampling.sample_digests(docs, 3).collect()
    expected = {hashlib.sha256((t or "").encode()).hexdigest() for t in [*texts, "null id"]}
    assert {r.decoded_sha256 for r in digests} == expected
    # a row's sample does not depend on where it runs
    again = sentencepiece_sampling.sample_digests(docs.repartition(5), 3).collect()
    assert sorted(r.ids_sha256 for r in digests) == sorted(r.ids_sha256 for r in again)
    assert sentencepiece_sampling.encode_samples(docs.limit(0)).count() == 0


def test_every_query_is_registered():
    from __spark_entry__ import oracle_sql, queries

    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(str(Path(tmp_path, str(i))))
        docs = stage(spark, spark.read.parquet(str(Path(tmp_path, str(i)))), SF_DIR)
        if i < 4:
            assert docs.columns == columns
        if name in ("quality rules", "n-gram Jaccard join"):
            assert docs.count() < left
            left = docs.count()
        elif name == "line dedup":
            assert docs.count() == left
    out = docs.collect()
    assert out and {r.sample for r in out} == {1, 2}
    assert sorted(map(str, out)) == sorted(map(str, corpus_pipeline.run(spark, SF_DIR).collect()))
