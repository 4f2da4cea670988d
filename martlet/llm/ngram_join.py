"""Similarity join of documents on word shingles: rare-first prefix filtering.

A document is the set of its distinct 5-word shingles, lower-cased A-Z; two documents link when
the Jaccard similarity of their sets is at least 0.75. Equal sets form a class; a class links to itself
and joins as one.

1. Every class sends its shingles to buckets of the hash space, packed as bytes (5 a shingle, some 2 a
   class and bucket), and the bucket counts in how many classes each occurs. In the buckets a class goes by its number
   in the task that sent it. Only classes that may have copies in other tasks, as a bitmap over the hashes of repeated
   keys tells, go by 63 bits of their key, so that copies count once. A shingle of one class can't be in
   an intersection, so only the others go back to their class.
2. A class orders its shingles by that count, rarest first, ties by hash. Two linked sets share
   a shingle within the first n - ceil(0.75 n) + 1 of each (the prefix). A class whose prefix holds only shingles
   of its own has no partner and leaves; the others send the shared part of their prefix.
3. Classes that meet in a prefix shingle are candidates if their sizes (length filter) and the
   place of the shingle (positional filter) still allow the overlap that 0.75 needs. The suffix filter then halves both sets
   at a shingle, twice, for a tighter bound, and the intersection decides. A pair is verified once.
4. So that thousands of near copies are not compared pair by pair, each class is first compared with one other:
   the class with the fewest shingles of its own that it meets, the likeliest centre of the copies (two rounds). Classes found linked are in one component; after that only pairs of
   different components that share a prefix shingle are compared, all of them. Components only grow, so a shingle in which
   one component alone meets is left out of all later rounds.

Shingles are 64-bit hashes; within a bucket 40 bits tell them apart.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.bytes_text import Piece, from_planes, mix, planes, text_pieces
from martlet.llm.components import components
from martlet.llm.shared import stored

SHINGLE = 5
SIMILAR = (3, 4)  # 0.75 as a fraction
KEY_BYTES = 10  # of a class's key
BUCKET_SHINGLES = 2_500_000  # about 120 MB in the task that counts them
FLUSH_SHINGLES = 1_000_000
FILTER_BITS = (1 << 15, 1 << 27)  # of the bitmap, least and most: 16 MB; a bit set in vain costs a class some bytes and nothing else
STAR_ROUNDS = 2
LOW_BYTES = 5  # of a shingle within its bucket
_LOW = np.uint64((1 << 8 * LOW_BYTES) - 1)
_COPIED = np.uint64(1 << 63)


def prefix_length(n):
    """How many of a set's first shingles hold one of any linked set's first."""
    return n - (SIMILAR[0] * n + SIMILAR[1] - 1) // SIMILAR[1] + 1


def needed_overlap(n, m):
    """The smallest intersection of linked sets of these sizes: s * (n + m) / (1 + s), rounded up."""
    a, b = SIMILAR
    return -((-a * (n + m)) // (a + b))


def shingle_sets(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """(borders, hashes): the sorted distinct shingle hashes of each text of the piece.

    A text of fewer words than a shingle has its whole word sequence as the only one.
    """
    words = np.diff(piece.words_at)
    at = piece.windows(SHINGLE)
    text = piece.word_text()
    short = np.flatnonzero((words > 0) & (words < SHINGLE))
    starts = np.concatenate([at, piece.words_at[short]])
    sizes = np.concatenate([np.full(len(at), SHINGLE), words[short]])
    owner = np.concatenate([text[at], short])
    hashes = piece.window_hashes(starts, sizes)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return np.searchsorted(owner, np.arange(piece.n + 1)), hashes


def set_keys(borders: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """80 bits for each set, as an (n, KEY_BYTES) array of bytes: sums of the mixed hashes, so the order does not matter."""
    keys = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes ^ np.uint64(salt)), out=sums[1:])
        keys.append(mix(sums[borders[1:]] - sums[borders[:-1]]))
    return np.ascontiguousarray(np.stack(keys, axis=1).view(np.uint8)[:, :KEY_BYTES])


def _binary_keys(keys: np.ndarray) -> pa.Array:
    n = len(keys)
    offsets = np.arange(n + 1, dtype=np.int32) * KEY_BYTES
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(keys.tobytes())])


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, k, n_shingles, set_key) of every document; without words the size is 0; k is a hash of doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch.column(2), lower=True):
                borders, hashes = shingle_sets(piece)
                ids = [batch.column(i).slice(piece.first, piece.n) for i in range(2)]
                yield pa.RecordBatch.from_arrays(
                    [*ids, pa.array(np.diff(borders)), _binary_keys(set_keys(borders, hashes))], names=["doc_id", "k", "n_shingles", "set_key"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), "text")
    return named.mapInArrow(run, f"doc_id {kind}, k long, n_shingles long, set_key binary")


def _number(keys: np.ndarray) -> np.ndarray:
    """63 bits of each key, below a set bit that tells them from the numbers of classes without copies."""
    wide = np.zeros((len(keys), 16), np.uint8)
    wide[:, :KEY_BYTES] = keys
    wide = wide.view(np.uint64)
    return wide[:, 0] ^ mix(wide[:, 1]) | _COPIED


def _low_bytes(low: np.ndarray) -> np.ndarray:
    return low.view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES]


def _from_low_bytes(data: bytes) -> np.ndarray:
    low = np.zeros((len(data) // LOW_BYTES, 8), np.uint8)
    low[:, :LOW_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, LOW_BYTES)
    return low.view(np.uint64).ravel()


def repeated_keys(sets: DataFrame, documents: int) -> np.ndarray:
    """A bitmap, as bytes, over the first bytes of the keys that two or more documents have; it comes to the driver, 16 MB at most."""
    size = min(max(FILTER_BITS[0], 1 << (8 * documents).bit_length()), FILTER_BITS[1])
    repeated = sets.filter("n_shingles > 0").groupBy("set_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Spark's bitmaps count from 1
    place = F.conv(F.hex(F.substring("set_key", 1, 4)), 16, 10).cast("long") % size + 1
    marked = repeated.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("at"))
    out = np.zeros((size // FILTER_BITS[0], FILTER_BITS[0] // 8), np.uint8)
    for b, bits in marked.groupBy("b").agg(F.bitmap_construct_agg("at")).collect():
        out[b - 1] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def _marked(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.ascontiguousarray(keys[:, :4]).view(">u4").ravel().astype(np.int64) % (8 * len(bitmap))
    return bitmap[at >> 3] >> (at & 7) & 1 == 1


def _packed(buckets: int, bucket: np.ndarray, low: np.ndarray, owner: np.ndarray, ids: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """One row per bucket: its shingles' low bits, and runs of shingles of one class; a class's first run has its size and key, others 0 and none."""
    order = np.argsort(bucket, kind="stable")
    at_first = np.append(True, owner[1:] != owner[:-1])[order]  # owners come in order, so this is a class's first shingle
    bucket, low, owner = bucket[order], low[order], owner[order]
    borders = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(borders)):
        part = slice(borders[b], borders[b + 1])
        run = np.flatnonzero(np.append(True, owner[part][1:] != owner[part][:-1]))
        who = owner[part][run]
        count = np.diff(np.append(run, part.stop - part.start)).astype(np.int32)
        first = np.logical_or.reduceat(at_first[part], run)
        size = np.where(first, sizes[who], 0).astype(np.int32)
        rows.append((int(b), _low_bytes(low[part]).tobytes(), planes(ids[who]), planes(count), planes(size), keys[who[first]].tobytes()))
    names = ["bucket", "low", "ids", "counts", "sizes", "set_keys"]
    kinds = [pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _send_shingles(docs: DataFrame, buckets: int, bitmap: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies within a task are sent once
        held: list[tuple[np.ndarray, np.ndarray]] = []
        numbers = itertools.count(TaskContext.get().partitionId() << 40)  # 2^40 classes a task, 2^23 tasks

        def flush() -> pa.RecordBatch:
            copied = _marked(bitmap, np.stack([k for k, _ in held]))
            # numbers first, so that their equal high bytes lie together
            chosen = [held[i] for i in np.argsort(copied, kind="stable")]
            keys = np.stack([k for k, _ in chosen])
            ids = _number(keys)
            plain = len(held) - int(copied.sum())
            ids[:plain] = list(itertools.islice(numbers, plain))
            sizes = np.array([len(h) for _, h in chosen])
            hashes = np.concatenate([h for _, h in chosen])
            owner = np.repeat(np.arange(len(chosen)), sizes)
            return _packed(buckets, (hashes >> np.uint64(40)) % np.uint64(buckets), hashes & _LOW, owner, ids, keys, sizes)

        waiting = 0
        for batch in batches:
            for piece in text_pieces(batch.column(0), lower=True):
                borders, hashes = shingle_sets(piece)
                keys = set_keys(borders, hashes)
                for t in np.flatnonzero(np.diff(borders)):
                    name = keys[t].tobytes()
                    if name not in seen:
                        seen.add(name)
                        held.append((keys[t], hashes[borders[t] : borders[t + 1]]))
                        waiting += borders[t + 1] - borders[t]
                if waiting >= FLUSH_SHINGLES:
                    yield flush()
                    held.clear()
                    waiting = 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "bucket int, low binary, ids binary, counts binary, sizes binary, set_keys binary")


_BACK = "part int, bucket int, ids binary, set_keys binary, sizes binary, lengths binary, low binary, counts binary"


def _count_bucket(pdf: pd.DataFrame, parts: int) -> pd.DataFrame:
    """The shingles of one bucket that occur in two or more classes, with their counts, packed by part of the classes."""
    low = _from_low_bytes(b"".join(pdf["low"]))
    runs = np.concatenate([from_planes(x, np.int32) for x in pdf["counts"]])
    ids = np.concatenate([from_planes(x, np.uint64) for x in pdf["ids"]])
    keys = np.frombuffer(b"".join(pdf["set_keys"]), np.uint8).reshape(-1, KEY_BYTES)
    sizes = np.concatenate([from_planes(x, np.int32) for x in pdf["sizes"]])
    # a class whose copies lie in several tasks was sent by each of them: its first run stays
    copied = np.flatnonzero(ids >= _COPIED)
    one = ids < _COPIED
    one[copied[np.unique(ids[copied], return_index=True)[1]]] = True
    low = low[np.repeat(one, runs)]
    keys = keys[one[sizes > 0]]
    runs, ids, sizes = runs[one], ids[one], sizes[one]
    order = np.argsort(low)
    new = np.flatnonzero(np.append(True, np.diff(low[order]) != 0)) if len(low) else np.zeros(0, int)
    times = np.diff(np.append(new, len(low))).astype(np.int32)
    count = np.empty(len(low), np.int32)
    count[order] = np.repeat(times, times)
    del order
    shared = count > 1
    held = np.zeros(len(low) + 1, np.int64)
    np.cumsum(shared, out=held[1:])
    ends = np.cumsum(runs)
    lengths = (held[ends] - held[ends - runs]).astype(np.int32)
    low, count = low[shared], count[shared]
    part = (mix(ids) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((ids, part))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    in_order = np.argsort(np.repeat(rank, lengths), kind="stable")
    low, count = low[in_order], count[in_order]
    key_at = np.cumsum(sizes > 0) - 1
    order = order[(lengths[order] > 0) | (sizes[order] > 0)]
    borders = np.searchsorted(part[order], np.arange(parts + 1))
    at = np.concatenate([[0], np.cumsum(lengths[order])])
    bucket = int(pdf["bucket"].iloc[0])
    rows = []
    for p in np.flatnonzero(np.diff(borders)):
        who = order[borders[p] : borders[p + 1]]
        tokens = slice(at[borders[p]], at[borders[p + 1]])
        first = who[sizes[who] > 0]
        rows.append(
            (p, bucket, planes(ids[who]), keys[key_at[first]].tobytes(), planes(sizes[who]), planes(lengths[who]), _low_bytes(low[tokens]).tobytes(), planes(count[tokens]))
        )
    return pd.DataFrame(rows, columns=["part", "bucket", "ids", "set_keys", "sizes", "lengths", "low", "counts"])


def _order_rare_first(pdf: pd.DataFrame) -> pd.DataFrame:
    """The classes of one part whose prefix has a shared shingle, with their shared shingles, rarest first."""
    ids = np.concatenate([from_planes(x, np.uint64) for x in pdf["ids"]])
    sizes = np.concatenate([from_planes(x, np.int32) for x in pdf["sizes"]])
    lengths = np.concatenate([from_planes(x, np.int32) for x in pdf["lengths"]])
    buckets = np.repeat(mix(pdf["bucket"].to_numpy()), [len(x) // LOW_BYTES for x in pdf["low"]])
    shingles = mix(_from_low_bytes(b"".join(pdf["low"])) ^ buckets)
    counts = np.concatenate([from_planes(x, np.int32) for x in pdf["counts"]])
    ids, code = np.unique(ids, return_inverse=True)
    # one of a class's entries has its size and key
    keys = np.empty((len(ids), KEY_BYTES), np.uint8)
    keys[code[sizes > 0]] = np.frombuffer(b"".join(pdf["set_keys"]), np.uint8).reshape(-1, KEY_BYTES)
    sizes = np.bincount(code, sizes, len(ids)).astype(np.int64)
    shared = np.bincount(code, lengths, len(ids)).astype(np.int64)
    own = sizes - shared
    some = own < prefix_length(sizes)
    owner = np.repeat(code, lengths)
    kept = some[owner]
    shingles, counts, owner = shingles[kept], counts[kept], owner[kept]
    shingles = shingles[np.lexsort((shingles, counts, owner))]
    ends = np.cumsum(np.where(some, shared, 0))
    who = np.flatnonzero(some)
    return pd.DataFrame(
        {
            "id": ids[who].view(np.int64),
            "set_key": [keys[i].tobytes() for i in who],
            "n": sizes[who],
            "own": own[who],
            "shingles": [shingles[ends[i] - shared[i] : ends[i]].tobytes() for i in who],
        }
    )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        for i, (n, own, blob) in enumerate(zip(*[batch.column(k).to_pylist() for k in ("n", "own", "shingles")])):
            tokens = np.frombuffer(blob, np.int64)[: prefix_length(n) - own]
            parts.append((np.full(len(tokens), i), tokens, np.full(len(tokens), n, np.int32), own + np.arange(len(tokens), dtype=np.int32), np.full(len(tokens), own, np.int32)))
        if parts:
            who, tokens, *rest = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), batch.column("id").take(pa.array(who)), *map(pa.array, rest)], names=["shingle", "id", "n", "place", "own"]
            )


def _overlap_at_least(x: np.ndarray, y: np.ndarray, need: int) -> bool:
    """Whether two sorted sets share ``need`` elements; halving them bounds the overlap first."""
    parts = [(x, y)]
    for _ in range(2):
        halves = []
        for a, b in parts:
            if len(a) and len(b):
                pivot = b[len(b) // 2]
                i, j = np.searchsorted(a, pivot), len(b) // 2
                halves += [(a[:i], b[:j]), (a[i:], b[j:])]
        parts = halves
        if sum(min(len(a), len(b)) for a, b in parts) < need:
            return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= need


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left = [np.sort(np.frombuffer(b, np.uint64)) for b in batch.column("x").to_pylist()]
        right = [np.sort(np.frombuffer(b, np.uint64)) for b in batch.column("y").to_pylist()]
        need = needed_overlap(batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64), batch.column("m").to_numpy(zero_copy_only=False).astype(np.int64))
        ok = [_overlap_at_least(x, y, k) for x, y, k in zip(left, right, need.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _possible(n: str, p: str, m: str, q: str):
    """Length and positional filters as a condition on two rows' sizes and places."""
    a, b = SIMILAR
    n, p, m, q = (F.col(c).cast("long") for c in (n, p, m, q))
    length = (b * n >= a * m) & (b * m >= a * n)
    # Two linked sets meet at their first common shingle too, and there nothing before it is common: their overlap is
    # that shingle and at most what follows it in the shorter rest. Where they meet later the bound may be too
    # low, which loses nothing, as one meeting is enough.
    most = 1 + F.least(n - p - 1, m - q - 1)
    return length & ((a + b) * most >= a * (n + m))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    x = sets.select(F.col("id").alias("kx"), F.col("shingles").alias("x"), "n")
    y = sets.select(F.col("id").alias("ky"), F.col("shingles").alias("y"), F.col("n").alias("m"))
    both = pairs.join(x, F.col("a") == F.col("kx")).join(y, F.col("b") == F.col("ky"))
    return both.select("a", "b", "x", "y", "n", "m").mapInArrow(_verify, "a long, b long")


def class_links(docs: DataFrame, total_shingles: int, bitmap: np.ndarray) -> DataFrame:
    """(node, component) of all classes with a link to another class: their keys."""
    buckets = max(1, -(-total_shingles // BUCKET_SHINGLES))
    counted = _send_shingles(docs, buckets, bitmap).groupBy("bucket").applyInPandas(lambda pdf: _count_bucket(pdf, buckets), _BACK)
    sets = stored(counted.groupBy("part").applyInPandas(_order_rare_first, "id long, set_key binary, n int, own int, shingles binary"), "rare-first")
    prefixes = stored(sets.mapInArrow(_prefixes, "shingle long, id long, n int, place int, own int"), "prefixes")
    columns = prefixes.columns
    found = docs.sparkSession.createDataFrame([], "node long, component long")
    links = verified = None
    for turn in range(STAR_ROUNDS + 1):
        placed = prefixes.withColumn("c", F.col("id"))
        if links is not None:
            placed = prefixes.join(found, F.col("id") == F.col("node"), "left").select(
                "shingle", "id", "n", "place", "own", F.coalesce("component", "id").alias("c")
            )
        # only shingles in which different components meet
        centre = F.min(F.struct("own", "id", "c", "n", "place")).alias("first")
        mixed = placed.groupBy(F.col("shingle").alias("s")).agg(centre, F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high")
        possible = (F.col("c") != F.col("c2")) & _possible("n", "place", "m", "q")
        if turn < STAR_ROUNDS:
            other = mixed.select("s", F.col("first.c").alias("c2"), F.col("first.id").alias("k2"), F.col("first.n").alias("m"), F.col("first.place").alias("q"), F.col("first.own").alias("own2"))
            met = stored(placed.join(other, F.col("shingle") == F.col("s")).drop("s"), "met")
            pairs = met.filter(possible).groupBy("id").agg(F.min(F.struct("own2", "k2")).alias("with")).select("id", "with.k2")
            prefixes = met.select(*columns)
        else:
            met = stored(placed.join(mixed.select("s"), F.col("shingle") == F.col("s"), "left_semi"), "met")
            other = met.select(F.col("shingle").alias("s"), F.col("c").alias("c2"), F.col("id").alias("k2"), F.col("n").alias("m"), F.col("place").alias("q"))
            pairs = met.join(other, (F.col("shingle") == F.col("s")) & possible & (F.col("id") < F.col("k2")))
        pairs = pairs.select(F.least("id", "k2").alias("a"), F.greatest("id", "k2").alias("b")).distinct()
        if verified is not None:
            pairs = pairs.join(verified, ["a", "b"], "left_anti")
        pairs = stored(pairs, "candidates")
        if pairs.isEmpty():
            continue
        verified = pairs if verified is None else verified.unionByName(pairs)
        new = stored(_verified(pairs, sets), "links")
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            found = components(links)
    node, component = (sets.select(F.col("id").alias(f"{c}_id"), F.col("set_key").alias(f"{c}_key")) for c in found.columns)
    named = found.join(node, F.col("node") == F.col("node_id")).join(component, F.col("component") == F.col("component_id"))
    return named.select(F.col("node_key").alias("node"), F.col("component_key").alias("component")).distinct()


def _placed(docs: DataFrame) -> DataFrame:
    """(doc_id, k, n_shingles, c) with the component of each document, null for empty sets."""
    sets = stored(document_sets(docs), "sets")
    total, documents = sets.agg(F.sum("n_shingles"), F.count(F.lit(1))).first()
    found = class_links(docs, int(total or 0), repeated_keys(sets, documents))
    full = F.col("n_shingles") > 0
    return sets.join(found, (F.col("set_key") == F.col("node")) & full, "left").select(
        "doc_id", "k", "n_shingles", F.when(full, F.coalesce("component", "set_key")).alias("c")
    )


def link_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id.

    component_id is the smallest doc_id that the document reaches by links, itself included; null ids count
    only where a component has no other. Null and empty texts and those of white space have size 0 and
    are linked with nothing. Repeated rows have equal sets, hence one component. Other columns are ignored; an empty
    table gives no rows.
    """
    placed = _placed(docs)
    least = placed.filter("c IS NOT NULL").groupBy(F.col("c").alias("least_c")).agg(F.min("doc_id").alias("least"))
    return placed.join(least, F.col("c") == F.col("least_c"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, of one document of each component: that with the smallest doc_id.

    Null ids come last; of rows that share the smallest doc_id the one with the smallest hash of id and text stays.
    Rows equal in doc_id and text are one document and become one row. Documents without words all stay.
    """
    placed = stored(_placed(docs), "placed")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k")
    first = placed.filter("c IS NOT NULL").groupBy(F.col("c").alias("first_c")).agg(F.min(order).alias("first"))
    gone = placed.join(first, (F.col("c") == F.col("first_c")) & (F.col("first") < order)).select(F.col("k").alias("gone")).distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("k", F.xxhash64("row.doc_id", "row.text"))
    left = row.join(gone, F.col("k") == F.col("gone"), "left_anti")
    # rows without words are told apart, so that they all stay
    empty = F.coalesce(~F.col("row.text").rlike(r"[^ \t-\r]"), F.lit(True))
    left = left.withColumn("n", F.when(empty, F.monotonically_increasing_id()).otherwise(0)).dropDuplicates(["k", "n"])
    return left.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
