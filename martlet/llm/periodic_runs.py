"""Periodic runs of words, found as maximal pairs.

A run is a longest stretch of words in which words a period q apart are identical, with q the smallest such
period and at least max(6, 4 q) words. Two places i < j of a text are a maximal pair of length l if the same l words start
there, the words before differ (or i is the text's first word) and so do the words after. The pair's distance d = j - i is
then a period of the stretch of l + d words at i, and that stretch cannot be extended: so the maximal pairs with
l >= max(6 - d, 3 d) are exactly the runs, once for each multiple of q that still fits; the smallest distance of a stretch is its q.

The pairs come bottom-up from the tree of LCP intervals: suffixes are sorted by prefix doubling, and neighbours of the
suffix array have their longest common prefix (LCP) from span hashes. A pair belongs to the node whose depth l is the LCP of
its two suffixes. As children of a node are merged, each place of the smaller list looks into the larger one. A node's list is
ordered by place and falls into stretches of one left-word class (equal words before). Occurrences of a node's l words within
l / 3 words of each other lie in one run, so their classes are equal but for the first one's: one look at the next place and one at the
first place in reach skip whole stretches, and a node costs n log n looks plus its pairs.

Suffixes that cannot be in such a pair leave before the tree is built: those without a repeat of 5 words, and
those whose nearest repeat is farther than a third of their longest LCP. All texts of a piece of an Arrow batch are
sorted together and nothing is shuffled. A text is never cut; the longest one takes some 120 bytes a word besides its own.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.bytes_text import Piece, mix, prefix_sums, span_hashes, text_pieces

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: of the pair in the shortest run of period 1; pairs of longer periods are longer
_LEAST_LCP = MIN_LENGTH - 1
_PER_PERIOD = MIN_EXPONENT - 1

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def suffix_order(symbols: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """The places of all texts, so ordered that suffixes of a text with a common prefix of any length stand together."""
    n = len(symbols)
    sizes = np.diff(borders)
    text = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(borders[1:], sizes)
    keys = mix(symbols ^ mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    head = np.ones(n, bool)
    head[1:] = keys[order][1:] != keys[order][:-1]
    slot = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, slot, 0))
    # ranks are first slots of groups, so a suffix that is alone in its group is placed for good
    open_ = slot[~(head & np.append(head[1:], True))]
    step = 1
    while len(open_):
        at = order[open_]
        then = np.where(at + step < end[at], rank[np.minimum(at + step, n - 1)], -1)
        key = rank[at] * (n + 1) + then + 1
        sort = np.argsort(key, kind="stable")
        at, key = at[sort], key[sort]
        order[open_] = at
        head = np.ones(len(at), bool)
        head[1:] = key[1:] != key[:-1]
        rank[at] = np.maximum.accumulate(np.where(head, open_, 0))
        open_ = open_[~(head & np.append(head[1:], True))]
        step *= 2
    return order


def common_prefixes(sums: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The LCP of each pair of suffixes, of ``most`` words at most."""
    got = np.zeros(len(a), np.int64)
    for k in range(int(most.max()).bit_length() - 1 if len(most) else -1, -1, -1):
        at = np.flatnonzero(got + (1 << k) <= most)
        x, y = a[at] + got[at], b[at] + got[at]
        same = span_hashes(sums, x, x + (1 << k)) == span_hashes(sums, y, y + (1 << k))
        got[at[same]] += 1 << k
    return got


def _repeating_texts(piece: Piece) -> np.ndarray:
    """The texts with a 5-word window that occurs again within a quarter of the text."""
    at = piece.windows(_LEAST_LCP)
    text = np.searchsorted(piece.words_at, at, "right") - 1
    keys = mix(piece.window_hashes(at, _LEAST_LCP) ^ mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    again = keys[order][1:] == keys[order][:-1]
    gap = np.diff(at[order])[again]
    text = text[order][1:][again]
    return np.unique(text[MIN_EXPONENT * gap <= np.diff(piece.words_at)[text]])


def _reaching(place: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes (in suffix order, with the LCP of each and the next) that may be in a pair of a run."""
    while len(place):
        inner = lcp >= _LEAST_LCP
        before = np.append(0, np.where(inner, lcp, 0)[:-1])
        longest = np.maximum(before, np.where(inner, lcp, 0))
        group = np.cumsum(before == 0)
        order = np.lexsort((place, group))
        gap = np.where(np.diff(group[order]) == 0, np.diff(place[order]), np.iinfo(np.int64).max // 8)
        nearest = np.empty(len(place), np.int64)
        nearest[order] = np.minimum(np.append(gap[:1], gap) if len(gap) else np.iinfo(np.int64).max // 8, np.append(gap, np.iinfo(np.int64).max // 8))
        stay = np.flatnonzero(_PER_PERIOD * nearest <= longest)
        if len(stay) == len(place):
            break
        if len(stay):
            lcp = np.minimum.reduceat(lcp, stay)
        place = place[stay]
    return place, lcp


def _merged(depth: int, one: list[int], two: list[int], left: dict[int, int], pairs: list[tuple[int, int, int]]) -> list[int]:
    """The union of two children's lists; adds (place, distance, depth) of the pairs between them."""
    large, small = (one, two) if len(one) >= len(two) else (two, one)
    reach = depth // _PER_PERIOD
    for i in small:
        word = left[i]
        k = bisect_right(large, i)
        if k < len(large) and large[k] - i <= reach and left[large[k]] != word:
            for j in large[k : bisect_right(large, i + reach, k)]:
                pairs.append((i, j - i, depth))
        k = bisect_left(large, i - reach)
        if k < len(large) and large[k] < i and left[large[k]] != word:
            pairs.append((large[k], i - large[k], depth))
    if len(small) == 1:
        insort(large, small[0])
    else:
        large += small
        large.sort()
    return large


def maximal_pairs(place: np.ndarray, lcp: np.ndarray, left: dict[int, int]) -> list[tuple[int, int, int]]:
    """(first place, distance, length) of the maximal pairs with length >= 3 * distance, bottom-up over the LCP intervals."""
    pairs: list[tuple[int, int, int]] = []
    stack: list[tuple[int, list[int]]] = []
    for i, depth in zip(place.tolist(), lcp.tolist()):
        node = [i]
        while True:
            top = stack[-1][0] if stack else 0
            if top < depth:
                stack.append((depth, node))
                break
            if not stack:  # nothing in common with the next suffix
                break
            node = _merged(top, stack.pop()[1], node, left, pairs)
            if top == depth:
                stack.append((depth, node))
                break
    return pairs


def runs_of(piece: Piece) -> np.ndarray:
    """(start, length, period) of the runs of all texts of the piece, by start and period; starts count the piece's words."""
    texts = _repeating_texts(piece)
    sizes = np.diff(piece.words_at)[texts]
    borders = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    origin = np.arange(borders[-1]) + np.repeat(piece.words_at[:-1][texts] - borders[:-1], sizes)
    symbols = piece.hashes[origin]
    order = suffix_order(symbols, borders)
    end = np.repeat(borders[1:], sizes)
    sums = prefix_sums(symbols)
    a, b = order[:-1], order[1:]
    most = np.minimum(end[a] - a, end[b] - b)
    lcp = np.zeros(len(order), np.int64)
    near = np.flatnonzero((end[a] == end[b]) & (most >= _LEAST_LCP))
    near = near[span_hashes(sums, a[near], a[near] + _LEAST_LCP) == span_hashes(sums, b[near], b[near] + _LEAST_LCP)]
    lcp[near] = common_prefixes(sums, a[near], b[near], most[near])
    place, lcp = _reaching(order, lcp)
    lcp = np.where(lcp >= _LEAST_LCP, lcp, 0)
    lcp[-1:] = 0
    words = symbols[place - 1].astype(np.int64).tolist()
    # a text's first word has a class of its own
    first = np.isin(place, borders).tolist()
    left = {p: (None if f else w) for p, f, w in zip(place.tolist(), first, words)}
    pairs = np.array(maximal_pairs(place, lcp, left), np.int64).reshape(-1, 3)
    start, period, length = pairs[:, 0], pairs[:, 1], pairs[:, 2] + pairs[:, 1]
    ok = (length >= MIN_LENGTH) & (length >= MIN_EXPONENT * period)
    start, period, length = origin[start[ok]], period[ok], length[ok]
    sort = np.lexsort((period, length, start))
    start, period, length = start[sort], period[sort], length[sort]
    # the smallest distance of a stretch is its period
    new = np.append(True, (np.diff(start) != 0) | (np.diff(length) != 0))[: len(start)]
    runs = np.stack([start[new], length[new], period[new]], axis=1)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(piece: Piece, runs: np.ndarray) -> pa.Array:
    """Each text's words, without those that a run has after its first period, joined by one space."""
    n = len(piece.starts)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    keep = np.flatnonzero(np.cumsum(change)[:-1] == 0)
    size = piece.ends[keep] - piece.starts[keep] + 1
    to = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(to[-1]) + np.repeat(piece.starts[keep] - to[:-1], size)
    out = np.append(piece.data, np.uint8(0x20))[source]
    out[to[1:] - 1] = 0x20
    # the space after a text's last word goes
    last = np.searchsorted(keep, piece.words_at)
    cut = to[last[1:][np.diff(last) > 0]] - 1
    offsets = to[last] - np.searchsorted(cut, to[last])
    out = np.delete(out, cut)
    texts = pa.LargeStringArray.from_buffers(piece.n, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out))
    return texts.cast(pa.string())


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed) of each document: its runs by start and period, and its words without the repeats.

    ``runs`` is an array of (start, length, period) in words from 0. Words are ``[^\\x20\\x09-\\x0D]+``. ``collapsed`` has the kept words
    joined by one space; null and empty texts and texts of white space have no runs and are empty. Repeated
    rows are searched each, a null doc_id stays null, other columns are ignored, an empty table gives no rows.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch.column(1)):
                runs = runs_of(piece)
                borders = np.searchsorted(runs[:, 0], piece.words_at)
                text = np.repeat(np.arange(piece.n), np.diff(borders))
                fields = [pa.array(runs[:, 0] - piece.words_at[text]), pa.array(runs[:, 1]), pa.array(runs[:, 2])]
                lists = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.StructArray.from_arrays(fields, RUN.names))
                ids = batch.column(0).slice(piece.first, piece.n)
                yield pa.RecordBatch.from_arrays([ids, lists, _collapsed(piece, runs)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(search, schema)


def plant_periods(docs: DataFrame) -> DataFrame:
    """The documents with a tenth of the texts made periodic from some word on: known runs to look for.

    With h = crc32 of the decimal doc_id and g = floor(h / 10), a text of n > 0 words with h % 10 = 0 gets as word i >= a the word
    a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)); its words are then joined by one space. Other rows,
    those without doc_id included, stay as they are.
    """
    words = F.filter(F.split("text", "[ \\x09-\\x0D]+"), lambda w: w != "")
    n, a, p = F.col("_n"), F.col("_a"), F.col("_p")
    out = docs.withColumn("_h", F.crc32(F.col("doc_id").cast("string")))
    out = out.withColumn("_g", F.expr("_h div 10"))
    out = out.withColumn("_words", F.when(F.col("_h") % 10 == 0, words)).withColumn("_n", F.size("_words"))
    out = out.withColumn("_a", F.when(n > 0, F.col("_g") % n)).withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))

    def part(array: str | Column, start: Column, length: Column) -> Column:
        return F.slice(array, start.cast("int"), length.cast("int"))

    unit = F.flatten(F.array_repeat(part("_words", a + 1, p), F.expr("int((_n - _a + _p - 1) div _p)")))
    edited = F.array_join(F.concat(part("_words", F.lit(1), a), part(unit, F.lit(1), n - a)), " ")
    return out.withColumn("text", F.when(n > 0, edited).otherwise(F.col("text"))).select(*docs.columns)


def run_digests(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the run of greatest exponent and digests of all runs and of the collapsed text."""
    best = F.get(
        F.expr(
            "array_sort(runs, (a, b) -> CASE WHEN a.length * b.period <> b.length * a.period THEN sign(b.length * a.period - a.length * b.period)"
            " WHEN a.start <> b.start THEN sign(a.start - b.start) ELSE sign(a.period - b.period) END :: int)"
        ),
        F.lit(0),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    top = F.col("_best")
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top.start.alias("start"),
        top.length.alias("length"),
        top.period.alias("period"),
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
