"""Chat formatting, Merkle manifest and periodic runs against plain Python and SQL."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import pytest
from hypothesis import given
from hypothesis import strategies as st

from checks.compare import duck
from martlet.llm import chat_format, merkle_manifest, periodic_runs
from martlet.llm.queries import op11_chat_format, op12_merkle_manifest, op13_periodic_runs
from tests.conftest import SF_DIR

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def same(df, sql, con):
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    return sorted(map(str, got.fetchall())) == sorted(str(tuple(r)) for r in df.select(*names).collect())


@pytest.fixture(scope="module")
def tables():
    return duck(SF_DIR)


# --- chats


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<s>"]), st.text(st.sampled_from("<[/\\s>INST]ROLEYX "), max_size=25)), max_size=6))
def test_formats_read_back(turns):
    formatted, loss = chat_format.format_turns(turns)
    assert chat_format.parse_turns(formatted) == turns
    assert [chat_format.unescape(formatted[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]


@given(st.text(st.sampled_from("<[/\\s>INST]SYROLEX"), max_size=30))
def test_escaped_texts_hold_no_control_string(text):
    inside = chat_format.escape(text)
    assert chat_format.unescape(inside) == text and not any(c in inside for c in chat_format.CONTROLS)


def test_layouts_become_the_same_turns(spark):
    said = [("user", "a\n\nb"), ("assistant", "c")]
    records = [
        {"messages": [{"role": r, "content": t} for r, t in said], "id": 7},
        {"messages": [{"role": r, "content": [{"type": "text", "text": t}]} for r, t in said]},
        {"conversations": [{"from": "human", "value": "a\n\nb"}, {"from": "gpt", "value": "c"}], "meta": {"k": [1]}},
        {"dialog": {"turns": [{"speaker": {"role": r}, "utterance": t} for r, t in said]}},
        {"prompt": "a\n\nb", "completion": "c"},
        {"instruction": "a", "input": "b", "output": "c"},
        {"history": [], "question": "a\n\nb", "answer": "c"},
    ]
    known = chat_format.mappings(chat_format.LAYOUTS)
    names = []
    for record in records:
        layout = known[chat_format.fingerprint(chat_format.field_paths(record))]
        assert chat_format.canonical_turns(record, layout) == said
        names.append(layout.name)
    assert names == [x.name for x in chat_format.LAYOUTS]
    two = {"history": [{"question": "1", "answer": "2"}], "question": "3", "answer": None}
    assert chat_format.canonical_turns(two, chat_format.LAYOUTS[-1]) == [("user", "1"), ("assistant", "2"), ("user", "3"), ("assistant", "")]
    texts = [json.dumps(records[0]), '{"odd": 1}', "[1]", "no json", None, '{"messages": []}', "{}"]
    rows = spark.createDataFrame([(i, 0, t, "x") for i, t in enumerate(texts)], "conv_id long, part long, record string, layout string")
    got = {r.conv_id: r for r in chat_format.format_records(rows).collect()}
    assert got[0].layout == "messages" and got[0].formatted == "[INST]a\n\nb[/INST]<s>c</s>" and [tuple(x) for x in got[0].loss] == [(20, 21)]
    assert got[1].fingerprint and got[1].formatted is None and got[2].fingerprint is None and got[4].formatted is None
    assert got[5].formatted == "" and got[6].layout is None
    assert chat_format.format_records(rows.limit(0)).count() == 0


def test_odd_conversations(spark):
    rows = [(1, 0, "user", "hi", "x"), (1, 0, "user", "hi", "x"), (1, None, None, None, "x"), (2, 5, "tool", "[INST]", "x"), (2, 5, "assistant", "<\\s>", "x")]
    rows += [(None, 1, "assistant", "n" * 200_000, "x"), (None, None, None, "first", "x")]
    rows += [(3, i, ("user", "assistant")[i % 2], f"turn {i}", "x") for i in range(1000)]  # more than a part holds
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string").repartition(3)
    groups = defaultdict(list)
    for r in df.collect():
        groups[r.conv_id].append(((r.turn is not None, r.turn or 0), (r.role is not None, r.role or ""), (r.text is not None, r.text or "")))
    expected = []
    for conv, turns in groups.items():
        turns = [(r[1], t[1]) for _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        expected.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    packed = chat_format.pack_records(df)
    got = chat_format.conversation_digests(chat_format.format_records(packed)).drop("formatted_chars")
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in got.collect())
    assert packed.where("conv_id = 3").count() == -(-1000 // chat_format.TURNS)
    assert chat_format.conversation_digests(chat_format.format_records(chat_format.pack_records(df.limit(0)))).count() == 0


def test_chats_equal_sql_and_use_all_layouts(spark, tables):
    assert same(op11_chat_format(spark, SF_DIR), chat_format.ORACLE, tables)
    packed = chat_format.pack_records(spark.read.parquet("/root/testdata/sf0.1/conversations.parquet"))
    used = {r.layout for r in chat_format.format_records(packed).select("layout").distinct().collect()}
    assert used == {x.name for x in chat_format.LAYOUTS}


# --- manifest


def levels_of(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        levels.append(nodes)
    return levels


def path_of(levels, i):
    path = []
    for level in levels[:-1]:
        first = i - i % 8
        path.append((level[first:i], level[i + 1 : first + 8]))
        i //= 8
    return path


def plain_manifest(rows):
    def leaf(*fields):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    trees = defaultdict(list)
    for d, text, lang, source, n in rows:
        own = leaf(d, source, lang, n, text)
        claimed = None
        if d is not None and zlib.crc32(str(d).encode()) % 3 == 0:
            claimed = leaf(d, source, lang, n, text and text.translate(LOWER))
        trees[lang].append((d is not None, d or 0, own, claimed or "", d))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {}
    for lang in langs:
        trees[lang].sort(key=lambda x: x[:4])
        levels[lang] = levels_of([x[2] for x in trees[lang]])
    top = levels_of([levels[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (_, _, own, claimed, d) in enumerate(trees[lang]):
            path, node = path_of(levels[lang], i) + path_of(top, k), claimed or own
            for left, right in path:
                node = sha("".join([*left, node, *right]))
            root = top[-1][0]
            out.append((d, own, levels[lang][-1][0], root, sha("".join(s for a, b in path for s in a + b)), node, node == root))
    return out


@pytest.mark.parametrize("n", [0, 1, 8, 9, 513, 4200])
def test_manifest_equals_plain_trees(spark, n):
    """4200 rows of one language are more than 8 superblocks, so three levels of them; some dozen languages of few rows beside."""
    rng = random.Random(n)
    rows = [(rng.choice([i, 10**15 + i]), f"Text {i}", "en", None if i % 7 else "s", i) for i in range(n)]
    if n == 513:
        rows += [(None, None, None, None, None), (None, "A", None, "é", 3), rows[5], rows[5], (10**18 + 1, "", "ab", "s", 0)]
        rows += [(-i, "x" * i, f"l{i % 13}", "s", 1) for i in range(60)] + [(99, "Long " * 200_000, "Ä", "s", 1)]
    docs = spark.createDataFrame([(*r, "c", "c") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, tree string, leaf string")
    got = merkle_manifest.manifest(merkle_manifest.document_leaves(docs.repartition(3), tamper=True))
    assert sorted(map(str, plain_manifest(rows))) == sorted(str(tuple(r)) for r in got.collect())


def test_manifest_equals_sql_and_finds_changes(spark, tables):
    df = op12_merkle_manifest(spark, SF_DIR)
    assert same(df, merkle_manifest.ORACLE, tables)
    honest = merkle_manifest.manifest(merkle_manifest.document_leaves(spark.read.parquet(f"{SF_DIR}/documents.parquet")))
    assert honest.where("verified").count() == honest.count() > df.where("verified").count() > 0


# --- runs


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - start + q
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return [x for x in re.split("[ \t-\r]+", text or "") if x]


def plain_digests(doc_id, w):
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, milli, sha(listed), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_runs_equal_all_periods(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t ", "a", "a " * 5, "a a\na\ta a a", "To " * 3000, ("a a b " * 7 + "c ") * 20, "x" * 100_000, "é ß " * 9]
    for _ in range(600):
        t = [rng.choice("abcdefgh"[: rng.choice([1, 2, 3, 8])]) for _ in range(rng.choice([0, 5, 20, 80]))]
        for _ in range(rng.choice([0, 1, 2])):
            unit = [rng.choice("abxyz") for _ in range(rng.choice([1, 2, 3, 5, 9]))]
            at = rng.randrange(len(t) + 1)
            t[at:at] = (unit * rng.choice([3, 4, 5, 9]))[: rng.choice([11, 30, 60])]
        texts.append("  ".join(t))
    rows = [(i, t, "c", "c") for i, t in enumerate(texts)] + [(None, texts[7], "c", "c"), (3, texts[3], "c", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, start string").repartition(3)
    got = periodic_runs.run_digests(periodic_runs.find_runs(docs))
    assert sorted(map(str, [plain_digests(r[0], words_of(r[1])) for r in rows])) == sorted(str(tuple(r)) for r in got.collect())
    runs = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs.find_runs(docs).where("doc_id < 10").collect()}
    assert runs[6] == [(0, 3000, 1)] and runs[5] == [(0, 6, 1)] and not runs[4]
    assert periodic_runs.run_digests(periodic_runs.find_runs(docs.limit(0))).count() == 0
    planted_docs = periodic_runs.plant_periods(docs)
    assert planted_docs.columns == docs.columns
    got = periodic_runs.run_digests(periodic_runs.find_runs(planted_docs))
    assert sorted(map(str, [plain_digests(r[0], planted(r[0], words_of(r[1]))) for r in rows])) == sorted(str(tuple(r)) for r in got.collect())


def test_run_query_equals_plain_search(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    docs = [d for d in docs if len(words_of(d.text)) < 1500]
    ids = {d.doc_id for d in docs}
    got = [tuple(r) for r in op13_periodic_runs(spark, SF_DIR).collect() if r.doc_id in ids]
    assert sorted(map(str, got)) == sorted(str(plain_digests(d.doc_id, planted(d.doc_id, words_of(d.text)))) for d in docs)


def test_long_text_with_very_many_runs(spark):
    text = " ".join(f"* * * * * * * w{i}" for i in range(20_000))
    got = periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in got.runs] == [(8 * i, 7, 1) for i in range(20_000)]
