"""Quality rules on repetition: a suffix array over the words of each text.

The suffixes of a text are sorted by prefix doubling; the longest common prefix (LCP) of each
suffix with its two neighbours follows from the ranks of the rounds. An interval of the suffix
array whose LCPs are at least l is a repeated substring of l words, and the longest one that
starts at a word is the larger LCP of that suffix with its neighbours. So the spans
[word, word + larger LCP) of at least ``MIN_REPEAT`` words are the maximal repeated substrings; their union over the
text is the covered part, their longest the longest repeat. All texts of a piece of an Arrow batch
are sorted together, ranks being told apart by text, so nothing is shuffled.

A text is kept unless a base rule fails (under 10 words, or over 20 % of the words in 5-word
windows that occur twice), maximal repeats cover more than ``MAX_COVERED`` percent of its words or its longest repeat
has more than ``MAX_LONGEST`` words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martlet.llm.bytes_text import Piece, _SPACE, mix, prefix_sums, span_hashes, text_pieces

MIN_WORDS = 10
BASE_WINDOW = 5
BASE_PERCENT = 20
MIN_REPEAT = 10
MAX_COVERED = 20
MAX_LONGEST = 100

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def longest_repeats(symbols: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """For each symbol the length of the longest repeat within its text that starts there.

    ``symbols`` are 64-bit hashes of the words of several texts, text t those in
    [borders[t], borders[t + 1]).
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    sizes = np.diff(borders)
    text = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(borders[1:], sizes)
    keys = mix(symbols ^ mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    slot = np.arange(n)
    head = np.ones(n, bool)
    head[1:] = keys[order][1:] != keys[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, slot, 0))
    rounds, step = [rank], 1
    # ranks are first slots of groups, so those of suffixes that are already alone stay as they are
    open_ = slot[~(head & np.append(head[1:], True))]
    while len(open_):
        at = order[open_]
        then = np.where(at + step < end[at], rank[np.minimum(at + step, n - 1)], -1)
        key = rank[at] * (n + 1) + then + 1
        sort = np.argsort(key, kind="stable")
        at, key = at[sort], key[sort]
        order[open_] = at
        head = np.ones(len(at), bool)
        head[1:] = key[1:] != key[:-1]
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(head, open_, 0))
        rounds.append(rank)
        open_ = open_[~(head & np.append(head[1:], True))]
        step *= 2
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(rounds[0][a] == rounds[0][b])
    a, b = a[near], b[near]
    common = np.zeros(len(near), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        x, y = a + common, b + common
        ok = (x < end[a]) & (y < end[b])
        same = ok & (rounds[k][np.minimum(x, n - 1)] == rounds[k][np.minimum(y, n - 1)])
        common[same] += 1 << k
    out = np.zeros(n, np.int64)
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def _union(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in one of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change)[:-1] > 0


def _duplicate_lines(piece: Piece) -> np.ndarray:
    """Per text the lines with a word that equal an earlier line."""
    n = len(piece.data)
    breaks = np.flatnonzero(piece.data == 10)
    starts = np.unique(np.concatenate([piece.offsets[:-1][np.diff(piece.offsets) > 0], breaks + 1]))
    starts = starts[starts < n]
    ends = np.minimum(np.append(starts[1:], n), n)
    # a line ends before its line feed, or where its text ends
    ends = ends - (piece.data[np.maximum(ends - 1, 0)] == 10)
    words = np.searchsorted(piece.starts, ends) - np.searchsorted(piece.starts, starts)
    starts, ends = starts[words > 0], ends[words > 0]
    text = np.searchsorted(piece.offsets, starts, "right") - 1
    hashes = span_hashes(prefix_sums(piece.data.astype(np.uint16) + np.uint16(1)), starts, ends)
    keys = mix(hashes ^ mix(text.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(keys, return_index=True)
    lines = np.bincount(text, minlength=piece.n)
    return lines - np.bincount(text[first], minlength=piece.n)


def measure(piece: Piece) -> dict[str, np.ndarray]:
    """The figures of ``MEASURES`` for each text of the piece."""
    repeats = longest_repeats(piece.hashes, piece.words_at)
    n = len(repeats)
    twice = np.flatnonzero(repeats >= BASE_WINDOW)
    long = np.flatnonzero(repeats >= MIN_REPEAT)
    longest = np.zeros(piece.n, np.int64)
    np.maximum.at(longest, piece.word_text(), repeats)
    characters = ~_SPACE[piece.data] & ((piece.data & 0xC0) != 0x80)
    return {
        "n_words": np.diff(piece.words_at),
        "word_chars": piece.per_text(characters, piece.offsets),
        "n_symbols": piece.per_text(_SYMBOL[piece.data], piece.offsets),
        "n_dup_lines": _duplicate_lines(piece),
        "n_repeat_words": piece.per_text(_union(twice, np.full(len(twice), BASE_WINDOW), n), piece.words_at),
        "covered_words": piece.per_text(_union(long, repeats[long], n), piece.words_at),
        "longest_repeat": longest,
    }


def verdicts(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base rule failed, kept)."""
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * m["n_words"])
    kept = ~failed & (100 * m["covered_words"] <= MAX_COVERED * m["n_words"]) & (m["longest_repeat"] <= MAX_LONGEST)
    return failed, kept


def judge_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the figures of ``MEASURES``, base_failed and kept.

    Null and empty texts have no words and are not kept; repeated rows are judged each; other
    columns are ignored; an empty table gives no rows.
    """
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
    fields += [T.StructField(k, T.LongType()) for k in MEASURES]
    fields += [T.StructField(k, T.BooleanType()) for k in ("base_failed", "kept")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch.column(1)):
                m = measure(piece)
                failed, kept = verdicts(m)
                ids = batch.column(0).slice(piece.first, piece.n)
                arrays = [ids, *[pa.array(m[k].astype(np.int64)) for k in MEASURES], pa.array(failed), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return docs.select("doc_id", "text").mapInArrow(judge, T.StructType(fields))


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the rules, with all their columns as they are."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [verdicts(measure(piece))[1] for piece in text_pieces(batch.column(at))]
            if masks:
                yield batch.filter(pa.array(np.concatenate(masks)))

    return docs.mapInArrow(keep, docs.schema)


ORACLE = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents
), lines AS (
  SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines FROM (
    SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL) GROUP BY doc_id
), k AS (SELECT unnest([{BASE_WINDOW}, {MIN_REPEAT}, {MAX_LONGEST + 1}]) AS size
), win AS (
  SELECT doc_id, size, unnest(range(1, len(words) - size + 2)) AS i, len(words) AS n, words FROM w, k WHERE len(words) >= size
), hashed AS (
  SELECT doc_id, size, i, count(*) OVER (PARTITION BY doc_id, size, md5(array_to_string(words[i:i + size - 1], ' '))) AS times FROM win
), spans AS (SELECT doc_id, size, i FROM hashed WHERE times > 1
), covered AS (
  SELECT doc_id, size, sum(least(size, coalesce(after - i, size)))::BIGINT AS n FROM (
    SELECT *, lead(i) OVER (PARTITION BY doc_id, size ORDER BY i) AS after FROM spans) GROUP BY doc_id, size
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce((SELECT n FROM covered c WHERE c.doc_id = w.doc_id AND size = {BASE_WINDOW}), 0)::BIGINT AS n_repeat_words,
         coalesce((SELECT n FROM covered c WHERE c.doc_id = w.doc_id AND size = {MIN_REPEAT}), 0)::BIGINT AS covered_words,
         EXISTS (SELECT 1 FROM spans s WHERE s.doc_id = w.doc_id AND size = {MAX_LONGEST + 1}) AS too_long
  FROM w LEFT JOIN lines USING (doc_id)
), f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {BASE_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words, base_failed,
       NOT base_failed AND 100 * covered_words <= {MAX_COVERED} * n_words AND NOT too_long AS kept FROM f
"""
