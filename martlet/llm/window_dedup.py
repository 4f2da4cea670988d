"""Substring dedup: count-min sketches pick the windows that may repeat, exact groups decide.

A window is 20 consecutive words of one document. It is counted by its anchor: of its 16 groups
of 5 words the one with the smallest hash, the leftmost of equal ones. Equal windows have equal anchors at equal
places, and neighbouring windows mostly share theirs, so there are some eight times fewer anchors than windows.

1. Each partition adds its anchors to a count-min sketch of two rows; the sketches are cut into chunks of
   the hash space and merged chunk by chunk. Counts stop at 2. A sketch never undercounts, and an anchor occurs at least
   as often as each of its windows, so a window whose anchor is estimated at 1 is unique.
2. A second pass looks its anchors up, chunk by chunk; those estimated repeated go back to their documents.
   Exact copies of a document need no windows: all of theirs start earlier in the first copy.
3. Exact groups, by 96-bit hashes: first of whole contexts, the 15 words before an anchor and the
   20 from it on, which hold all of its windows. All windows of a context but the first of its group are repeats. Two
   different contexts share a window only if they share the anchor with the 8 words before it (windows that start 8
   to 15 words before the anchor) or the 8 after it (the others); only such windows of the first of
   each context are then grouped themselves. The first of a group is a minimum
   that combines before the shuffle, and the others find it by a join, so no task holds a group.

The number of cells follows the size of the texts, so the share of anchors sent for nothing stays the same at any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.bytes_text import _BASE, Piece, from_planes, mix, planes, text_pieces
from martlet.llm.shared import stored

WINDOW = 20
ANCHOR = 5
SPAN = WINDOW - ANCHOR + 1  # a power of two
ROW_CELLS = 1 << 19  # of each of the two rows of a chunk
BYTES_PER_CELL = 6  # of text; about 4 cells in each row for an anchor
FLUSH_ANCHORS = 1_000_000
SIDE = SPAN // 2
_SECOND_BASE = 0xC2B2AE3D27D4EB4F


def anchored_windows(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, anchors, hashes): first words of all windows, first words of their anchors, and the hash of the group at each word."""
    at = piece.windows(WINDOW)
    groups = piece.windows(ANCHOR)
    hashes = np.full(len(piece.starts), np.iinfo(np.uint64).max, np.uint64)
    hashes[groups] = piece.window_hashes(groups, ANCHOR)
    best = np.arange(len(hashes))
    step = 1
    while step < SPAN:
        other = np.append(best[step:], np.full(min(step, len(best)), len(best) - 1 if len(best) else 0, best.dtype))
        best = np.where(hashes[best] <= hashes[other], best, other)
        step *= 2
    return at, best[at], hashes


def _cells(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each row within the chunk."""
    first = hashes & np.uint64(ROW_CELLS - 1)
    second = (hashes >> np.uint64(20)) & np.uint64(ROW_CELLS - 1)
    return first.astype(np.int64), second.astype(np.int64) + ROW_CELLS


def _chunk(hashes: np.ndarray, chunks: int) -> np.ndarray:
    return ((mix(hashes) >> np.uint64(24)) % np.uint64(chunks)).astype(np.int64)


def _anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """For each piece the hash and text of every anchor occurrence, its word within the text, and the piece's keys."""
    for batch in batches:
        for piece in text_pieces(batch.column(1)):
            _, anchors, hashes = anchored_windows(piece)
            anchors = np.unique(anchors)
            text = np.searchsorted(piece.words_at, anchors, "right") - 1
            yield hashes[anchors], text, anchors - piece.words_at[text], batch.column(0).slice(piece.first, piece.n)


def _partition_sketches(docs: DataFrame, chunks: int) -> DataFrame:
    """(chunk, cells, counts): what a partition counted, only cells that are not 0, counts up to 2."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.concatenate(held)
        chunk = _chunk(hashes, chunks)
        first, second = _cells(hashes)
        key = np.concatenate([chunk, chunk]) * (2 * ROW_CELLS) + np.concatenate([first, second])
        cell, count = np.unique(key, return_counts=True)
        count = np.minimum(count, 2).astype(np.uint8)
        borders = np.searchsorted(cell, np.arange(chunks + 1) * (2 * ROW_CELLS))
        some = np.flatnonzero(np.diff(borders))
        low = (cell % (2 * ROW_CELLS)).astype(np.uint32)
        columns = [
            pa.array(some.astype(np.int32)),
            pa.array([low[borders[c] : borders[c + 1]].tobytes() for c in some], pa.binary()),
            pa.array([count[borders[c] : borders[c + 1]].tobytes() for c in some], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "cells", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for hashes, *_ in _anchors_of(batches):
            held.append(hashes)
            n += len(hashes)
            if n >= FLUSH_ANCHORS:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    return docs.select("k", "text").mapInArrow(run, "chunk int, cells binary, counts binary")


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(2 * ROW_CELLS, np.uint8)
    for cells, counts in zip(pdf["cells"], pdf["counts"]):
        at = np.frombuffer(cells, np.uint32)
        total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), 2)
    return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "repeated": [np.packbits(total == 2).tobytes()]})


def _partition_anchors(docs: DataFrame, chunks: int) -> DataFrame:
    """(chunk, hashes, places, keys, counts): the anchors of a partition, runs of anchors of one document."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        hashes, places, keys = (np.concatenate(x) for x in zip(*held))
        chunk = _chunk(hashes, chunks)
        order = np.argsort(chunk, kind="stable")
        chunk, keys, places = chunk[order], keys[order], places[order].astype(np.int32)
        first, second = _cells(hashes[order])
        cells = (first + second * (2 * ROW_CELLS)).astype(np.uint64)
        borders = np.searchsorted(chunk, np.arange(chunks + 1))
        rows = []
        for c in np.flatnonzero(np.diff(borders)):
            part = slice(borders[c], borders[c + 1])
            run = np.flatnonzero(np.append(True, keys[part][1:] != keys[part][:-1]))
            count = np.diff(np.append(run, part.stop - part.start)).astype(np.int32)
            rows.append((int(c), planes(cells[part]), planes(places[part]), keys[part][run].tobytes(), count.tobytes()))
        names = ["chunk", "cells", "places", "keys", "counts"]
        kinds = [pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for hashes, text, places, keys in _anchors_of(batches):
            held.append((hashes, places, keys.to_numpy(zero_copy_only=False)[text]))
            n += len(hashes)
            if n >= FLUSH_ANCHORS:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    return docs.select("k", "text").mapInArrow(run, "chunk int, cells binary, places binary, keys binary, counts binary")


def _look_up(anchors: pd.DataFrame, sketch: pd.DataFrame) -> pd.DataFrame:
    """The anchors estimated repeated, by document: (k, places)."""
    found = []
    if len(anchors) and len(sketch):
        repeated = np.unpackbits(np.frombuffer(sketch["repeated"].iloc[0], np.uint8)).astype(bool)
        for cells, places, keys, counts in zip(anchors["cells"], anchors["places"], anchors["keys"], anchors["counts"]):
            cells = from_planes(cells, np.uint64).astype(np.int64)
            again = repeated[cells % (2 * ROW_CELLS)] & repeated[cells // (2 * ROW_CELLS)]
            counts = np.frombuffer(counts, np.int32)
            owner = np.repeat(np.arange(len(counts)), counts)[again]
            places = from_planes(places, np.int32)[again]
            keys = np.frombuffer(keys, np.int64)
            borders = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else []
            for a, b in zip(borders, [*borders[1:], len(owner)]):
                found.append((keys[owner[a]], places[a:b].tobytes()))
    return pd.DataFrame(found, columns=["k", "places"])


def _chosen(piece: Piece, lists: list) -> tuple[np.ndarray, np.ndarray]:
    """(windows, anchors) of the piece whose anchor is in its document's list of places."""
    at, anchors, _ = anchored_windows(piece)
    wanted = np.zeros(len(piece.starts), bool)
    for t in range(piece.n):
        places = piece.words_at[t] + np.asarray(lists[piece.first + t], np.int64)
        wanted[places[places < piece.words_at[t + 1]]] = True
    chosen = wanted[anchors]
    return at[chosen], anchors[chosen]


def _hash_pair(piece: Piece, at: np.ndarray, size: int | np.ndarray) -> list[pa.Array]:
    second = piece.window_hashes(at, size, _SECOND_BASE) >> np.uint64(32)
    return [pa.array(piece.window_hashes(at, size).view(np.int64)), pa.array(second.astype(np.uint32).view(np.int32))]


def _suspect_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, doc_id, k, place, low, high, left, right): the context of a suspected anchor and the windows that it stands for.

    left and right hash the anchor with the 8 words on that side; null if no window reaches so far.
    """
    for batch in batches:
        lists = [np.frombuffer(b"".join(x), np.int32) for x in batch.column("places").to_pylist()]
        for piece in text_pieces(batch.column("text")):
            at, anchors = _chosen(piece, lists)
            # the anchors of one text ascend with its windows
            new = np.flatnonzero(np.append(True, np.diff(anchors) != 0)) if len(anchors) else np.zeros(0, int)
            low, high, anchor = at[new], at[np.append(new[1:], len(at)) - 1] if len(at) else at, anchors[new]
            text = np.searchsorted(piece.words_at, anchor, "right") - 1
            begin = np.maximum(anchor - (SPAN - 1), piece.words_at[text])
            end = np.minimum(anchor + WINDOW, piece.words_at[text + 1])
            no_left, no_right = anchor - low < SIDE, anchor - high >= SIDE
            left = piece.window_hashes(np.where(no_left, low, anchor - SIDE), ANCHOR + SIDE)
            right = piece.window_hashes(np.where(no_right, low, anchor), ANCHOR + SIDE)
            rows = pa.array(text + piece.first)
            base = piece.words_at[text]
            columns = [*_hash_pair(piece, begin, end - begin), batch.column("doc_id").take(rows), batch.column("k").take(rows)]
            columns += [pa.array((x - base).astype(np.int32)) for x in (anchor, low, high)]
            columns += [pa.array(left.view(np.int64), mask=no_left), pa.array(right.view(np.int64), mask=no_right)]
            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "doc_id", "k", "place", "low", "high", "left", "right"])


def _windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, doc_id, k, place) of the windows on the listed sides of the listed anchors; the place is the window's first word."""
    for batch in batches:
        lists = batch.column("places").to_pylist()
        sides = [[[x["place"] for x in y if x["left"] == side] for y in lists] for side in (True, False)]
        for piece in text_pieces(batch.column("text")):
            found = []
            for left, chosen in zip((True, False), sides):
                at, anchors = _chosen(piece, chosen)
                found.append(at[(anchors - at >= SIDE) == left])
            at = np.sort(np.concatenate(found))
            text = np.searchsorted(piece.words_at, at, "right") - 1
            rows = pa.array(text + piece.first)
            columns = [*_hash_pair(piece, at, WINDOW), batch.column("doc_id").take(rows), batch.column("k").take(rows)]
            columns.append(pa.array((at - piece.words_at[text]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "doc_id", "k", "place"])


def _kept_digests(piece: Piece, removed: np.ndarray) -> list[str]:
    """SHA-256 of each text's kept words joined by one space."""
    text_end = np.repeat(piece.offsets[1:], np.diff(piece.words_at))
    data = np.append(piece.data, np.uint8(0))
    inner = piece.ends < text_end
    data[piece.ends[inner]] = 0x20
    change = np.zeros(len(data) + 1, np.int32)
    kept = ~removed
    np.add.at(change, piece.starts[kept], 1)
    np.add.at(change, (piece.ends + inner)[kept], -1)
    inside = np.cumsum(change)[: len(piece.data)] > 0
    joined = data[:-1][inside].tobytes()
    sizes = piece.per_text(inside, piece.offsets)
    ends = np.cumsum(sizes)
    return [hashlib.sha256(joined[e - s : e].removesuffix(b" ")).hexdigest() for s, e in zip(sizes.tolist(), ends.tolist())]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("spans").to_pylist()
        for piece in text_pieces(batch.column("text")):
            change = np.zeros(len(piece.starts) + 1, np.int32)
            for t in range(piece.n):
                if lists[piece.first + t]:
                    low, high = np.array([(x["low"], x["high"]) for x in lists[piece.first + t]], np.int64).T
                    high = np.minimum(high + WINDOW, piece.words_at[t + 1] - piece.words_at[t])
                    real = high - low >= WINDOW
                    np.add.at(change, piece.words_at[t] + low[real], 1)
                    np.add.at(change, piece.words_at[t] + high[real], -1)
            removed = np.cumsum(change)[:-1] > 0
            columns = [
                batch.column("doc_id").slice(piece.first, piece.n),
                pa.array(np.diff(piece.words_at)),
                pa.array(piece.per_text(removed, piece.words_at)),
                pa.array(_kept_digests(piece, removed), pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _place(last: str = "place"):
    """What orders the starts of windows: the document, null after all others, its key, and the word."""
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k", last)


def later_copies(docs: DataFrame) -> DataFrame:
    """(k, doc_id) of the documents whose whole text an earlier document has."""
    named = docs.select("k", "doc_id", F.sha2("text", 256).alias("digest")).filter("digest IS NOT NULL")
    named = named.withColumn("place", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k"))
    firsts = named.groupBy(F.col("digest").alias("d")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return named.join(firsts, (F.col("digest") == F.col("d")) & (F.col("first") < F.col("place"))).select("k", "doc_id").distinct()


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, k, low, high): runs of windows, by their first words, that also start earlier.

    ``docs`` has doc_id, text and the key k. Earlier means a smaller doc_id (null after all others), then a
    smaller key, then an earlier start.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, int(-(-int(size) // (BYTES_PER_CELL * ROW_CELLS))))
    merged = _partition_sketches(docs, chunks).groupBy("chunk").applyInPandas(_merge, "chunk int, repeated binary")
    sketch = stored(merged, "sketch")
    looked_up = _partition_anchors(docs, chunks).groupBy("chunk").cogroup(sketch.groupBy("chunk"))
    found = looked_up.applyInPandas(_look_up, "k long, places binary")
    copies = stored(later_copies(docs), "copies")
    suspects = stored(found.join(copies.select("k"), "k", "left_anti"), "suspects")
    lists = suspects.groupBy(F.col("k").alias("key")).agg(F.collect_list("places").alias("places"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # the joins with the texts have one key, so that they share one shuffle of the texts
    contexts = (
        docs.join(lists, F.col("k") == F.col("key"))
        .select("doc_id", "k", "text", "places")
        .mapInArrow(_suspect_contexts, f"h1 long, h2 int, doc_id {kind}, k long, place int, low int, high int, left long, right long")
    )
    firsts = contexts.groupBy("h1", "h2").agg(
        F.min(_place()).alias("first"), F.count(F.lit(1)).alias("times"), F.first("left").alias("left"), F.first("right").alias("right")
    )
    again = firsts.filter("times > 1").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first")
    same = (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("first") < _place())
    by_context = contexts.join(again, same).select("doc_id", "k", "low", "high")

    sides = firsts.select(
        F.col("first.k").alias("key"),
        F.col("first.place").alias("place"),
        F.explode(F.array(F.struct(F.col("left").alias("h"), F.lit(True).alias("left")), F.struct(F.col("right").alias("h"), F.lit(False).alias("left")))).alias("side"),
    ).filter("side.h IS NOT NULL")
    sides = sides.select("key", "place", "side.h", "side.left")
    several = sides.groupBy(F.col("h").alias("b"), F.col("left").alias("b_left")).agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1")
    open_ = sides.join(several, (F.col("h") == F.col("b")) & (F.col("left") == F.col("b_left")))
    lists = open_.groupBy("key").agg(F.collect_list(F.struct("place", "left")).alias("places"))
    windows = (
        docs.join(lists, F.col("k") == F.col("key"))
        .select("doc_id", "k", "text", "places")
        .mapInArrow(_windows_of, f"h1 long, h2 int, doc_id {kind}, k long, place int")
    )
    firsts = windows.groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2")).agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("times"))
    same = (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("first") < _place())
    by_window = windows.join(firsts.filter("times > 1"), same).select("doc_id", "k", F.col("place").alias("low"), F.col("place").alias("high"))
    whole = copies.select("doc_id", "k", F.lit(0).alias("low"), F.lit((1 << 31) - 1).alias("high"))
    return by_context.unionByName(by_window).unionByName(whole)


def remove_repeats(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    Words covered by a window that also starts earlier go. Null and empty texts and those of fewer than 20 words lose nothing.
    Rows equal in doc_id and text are one document written twice: they get equal results and do not repeat each other.
    Rows that share only the doc_id are ordered by a hash of id and text. Other columns are ignored; an empty table gives no rows.
    """
    docs = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"))
    spans = repeated_windows(docs).groupBy(F.col("k").alias("key")).agg(F.collect_list(F.struct("doc_id", "low", "high")).alias("all"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    own = F.filter("all", lambda s: s["doc_id"].eqNullSafe(F.col("doc_id")))
    return (
        docs.join(spans, F.col("k") == F.col("key"), "left")
        .select("doc_id", "text", own.alias("spans"))
        .mapInArrow(_remove, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
    )
