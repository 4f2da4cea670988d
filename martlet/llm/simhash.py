"""SimHash fingerprints and a search by Hamming radius in permuted block tables.

The terms of a text are its distinct words ``[^\\x20\\x09-\\x0D]+``; each weighs as many votes as it has
characters. The 64 bits of a term's hash (xxHash64) vote for or against the bits of the fingerprint, and a bit is set if
more votes are for it than against. Words are exploded and the votes added by document; nothing
but built-in functions runs.

The search cuts a fingerprint into ``BLOCKS`` blocks, each with a table keyed by its bits. Two fingerprints that differ in at
most ``RADIUS`` bits differ in some block by no more than that block's share of the radius (the shares and one for each block
but the first add up to the radius), so a query looks up every value of a block within its share. Every pair within the radius
meets in a table, once in each, and counts only in the first in which it meets.
Only distinct fingerprints enter the tables, with the number of their documents.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.shared import stored

BITS = 64
RADIUS = 10
BLOCKS = 4


def words(text: Column) -> Column:
    """The distinct words of a text."""
    return F.array_distinct(F.array_remove(F.split(text, "[ \\t-\\r]+"), ""))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, copies, fingerprint): one row for each distinct combination of the key columns.

    ``keys`` must determine the text; ``copies`` counts the rows that had them. Copies add equal votes, which
    leaves the signs as they are. A text without words has the fingerprint 0.
    """
    voted = texts.select(*keys, F.posexplode_outer(words(F.coalesce(text, F.lit("")))).alias("nth", "word"))
    voted = voted.select(
        *keys,
        F.when(F.coalesce("nth", F.lit(0)) == 0, 1).otherwise(0).alias("_first"),
        F.coalesce(F.char_length("word"), F.lit(0)).cast("long").alias("_weight"),
        F.xxhash64("word").alias("_hash"),
    )
    ones = [F.sum(F.shiftright("_hash", i).bitwiseAND(F.lit(1)) * F.col("_weight")).alias(f"_b{i}") for i in range(BITS)]
    sums = voted.groupBy(*keys).agg(F.sum("_first").alias("copies"), F.sum("_weight").alias("_all"), *ones)
    bits = [F.when(2 * F.col(f"_b{i}") > F.col("_all"), F.lit(_signed(1 << i))).otherwise(F.lit(0)) for i in range(BITS)]
    whole = bits[0]
    for b in bits[1:]:
        whole = whole.bitwiseOR(b)
    return sums.select(*keys, "copies", whole.cast("long").alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_text(fingerprint: Column) -> Column:
    """16 hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def block_masks() -> list[tuple[int, int]]:
    """The bits of each block, and its share of the radius."""
    borders = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    shares = [(RADIUS + 1 + i) // BLOCKS - 1 for i in range(BLOCKS)]
    return [(((1 << b) - 1) ^ ((1 << a) - 1), share) for a, b, share in zip(borders, borders[1:], shares)]


def within_radius(queries: DataFrame, index: DataFrame) -> DataFrame:
    """(query, fingerprint, distance) of all pairs of the two frames' distinct fingerprints within the radius."""
    blocks = block_masks()
    flips = [
        (i, _signed(mask), _signed(sum(1 << b for b in c)))
        for i, (mask, share) in enumerate(blocks)
        for k in range(share + 1)
        for c in combinations([b for b in range(BITS) if mask >> b & 1], k)
    ]

    def tables(frame: DataFrame, name: str, changes: list[tuple[int, int, int]]) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).alias("m"), F.lit(x).alias("x")) for i, m, x in changes])
        rows = frame.select(F.col("fingerprint").alias("f")).filter("f IS NOT NULL").distinct().select("f", F.inline(rows).alias("t", "m", "c"))
        return rows.select(F.col("f").alias(name), F.col("t").alias(f"t{name}"), F.col("f").bitwiseAND(F.col("m")).bitwiseXOR(F.col("c")).alias(f"k{name}"))

    differs = F.col("q").bitwiseXOR(F.col("x"))
    first = F.coalesce(*[F.when(F.bit_count(differs.bitwiseAND(F.lit(_signed(m)))) <= share, i) for i, (m, share) in enumerate(blocks)])
    meet = (F.col("tq") == F.col("tx")) & (F.col("kq") == F.col("kx"))
    meet = meet & (F.bit_count(differs) <= RADIUS) & (first == F.col("tq"))
    plain = [(i, _signed(m), 0) for i, (m, _) in enumerate(blocks)]
    pairs = tables(queries, "q", flips).join(tables(index, "x", plain).hint("merge"), meet)
    return pairs.select(F.col("q").alias("query"), F.col("x").alias("fingerprint"), F.bit_count(differs).alias("distance"))


def neighbours(documents: DataFrame) -> DataFrame:
    """(key, next_key, previous_key, previous_chars) of the keys by descending doc_id, null last, the ends joined.

    ``documents`` has key, doc_id, n_chars. Only keys and lengths are sorted, across the cluster: each
    range partition numbers its own, and one row per partition closes the gaps between them. A key that occurs in several rows
    counts once, with its largest length.
    """
    once = documents.groupBy("key", "doc_id").agg(F.max("n_chars").alias("n_chars"))
    by = F.desc_nulls_last("doc_id")
    # written out: the range borders are sampled and must not change between the two uses below
    ranged = stored(
        once.repartitionByRange(by).sortWithinPartitions(by).withColumn("part", F.spark_partition_id()), "ranged"
    )
    here = Window.partitionBy("part").orderBy(by)
    rows = ranged.select("*", F.row_number().over(here).alias("nth"), F.lead("key").over(here).alias("after"),
                         F.lag(F.struct("key", "n_chars")).over(here).alias("before"))
    ends = ranged.groupBy("part").agg(
        F.min_by("key", F.struct(F.col("doc_id").isNull(), -F.col("doc_id"))).alias("head"),
        F.max_by(F.struct("key", "n_chars"), F.struct(F.col("doc_id").isNull(), -F.col("doc_id"))).alias("tail"),
    )
    # one row per partition
    order = Window.orderBy("part")
    ring = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        F.col("part").alias("p"),
        F.coalesce(F.lead("head").over(order), F.first("head").over(ring)).alias("head_after"),
        F.coalesce(F.lag("tail").over(order), F.last("tail").over(ring)).alias("tail_before"),
    )
    return rows.join(ends, F.col("part") == F.col("p")).select(
        "key",
        F.coalesce("after", "head_after").alias("next_key"),
        F.coalesce("before", "tail_before")["key"].alias("previous_key"),
        F.coalesce("before", "tail_before")["n_chars"].alias("previous_chars"),
    )


def compare_edits(docs: DataFrame, query_divisor: int = 20) -> DataFrame:
    """``compare_and_link`` without the fingerprints found."""
    return compare_and_link(docs, query_divisor).drop("within_radius")


def compare_and_link(docs: DataFrame, query_divisor: int = 20) -> DataFrame:
    """One row per document with the fingerprints of its text and of its edited text, and those within the radius.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_within_radius and within_radius. The edited text has its last n_chars // 3 characters replaced by the first as many (or
    all) of the next document's by descending doc_id, after the last the first's. near_* are shares of equal bits. n_within_radius is set where
    doc_id is divisible by ``query_divisor``: the number of documents, itself included, whose fingerprint lies within the radius of its own.
    within_radius, set for the same rows, lists these fingerprints as "fingerprint:distance" by distance, separated by commas; the column
    fingerprint gives the documents of each.

    Null texts count as empty; a null doc_id comes last. Repeated rows all stay, with equal results; where
    rows share a doc_id and differ in text, the next document is taken to have the smallest prefix and the smallest fingerprint of
    them. A single document is its own next one. Other columns are ignored; an empty table gives no rows.
    """
    # the key alone names a document, so that both joins with the texts read the same columns and share one shuffle;
    # all joins that grow with the documents are sort-merge joins, at any size
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    doc_id = F.nullif(F.col("key"), F.lit("")).cast(docs.schema["doc_id"].dataType)
    around = stored(neighbours(texts.select("key", doc_id.alias("doc_id"), F.char_length("text").alias("n_chars"))), "neighbours")
    given = texts.join(
        around.select(F.col("key").alias("k"), "previous_key", "previous_chars").hint("merge"), F.col("key") == F.col("k")
    )
    heads = (
        given.select(F.col("previous_key").alias("to"), F.substring("text", F.lit(1), F.floor(F.col("previous_chars") / 3).cast("int")).alias("head"))
        .groupBy("to")
        .agg(F.min("head").alias("head"))
    )
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("head", F.lit(1), cut))
    both = texts.join(heads.hint("merge"), F.col("key") == F.col("to")).select("key", "text", edited.alias("edited"))
    keys = ["key", "n_chars", "text_hash", "edited_sha256", "edit"]
    listed = both.select(
        "key", n.cast("long").alias("n_chars"), F.xxhash64("text").alias("text_hash"), F.sha2("edited", 256).alias("edited_sha256"),
        F.posexplode(F.array("text", "edited")).alias("edit", "version"),
    )
    prints = fingerprints(listed, keys, "version")
    prints = stored(
        prints.groupBy(*keys[:-1]).agg(
            F.max("copies").alias("copies"),
            F.max(F.when(F.col("edit") == 0, F.col("fingerprint"))).alias("f"),
            F.max(F.when(F.col("edit") == 1, F.col("fingerprint"))).alias("e"),
        ),
        "fingerprints",
    )
    by_key = prints.groupBy(F.col("key").alias("nk")).agg(F.min("f").alias("nf"))
    nexts = around.select(F.col("key").alias("k"), "next_key").join(by_key.hint("merge"), F.col("next_key") == F.col("nk")).select("k", "nf")

    asked = (doc_id % query_divisor) == 0
    classes = prints.groupBy(F.col("f").alias("fingerprint")).agg(F.sum("copies").alias("documents"))
    pairs = within_radius(prints.filter(asked).select(F.col("f").alias("fingerprint")), classes)
    near = (
        pairs.join(classes.hint("merge"), "fingerprint").groupBy(F.col("query").alias("asked")).agg(
            F.sum("documents").alias("n_within_radius"),
            F.sort_array(F.collect_list(F.struct("distance", as_text(F.col("fingerprint")).alias("print")))).alias("found"),
        )
    )
    joined = prints.join(nexts.hint("merge"), F.col("key") == F.col("k"))
    joined = joined.join(near.hint("merge"), F.col("f") == F.col("asked"), "left")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        doc_id.alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("e")).alias("near_edited"),
        likeness(F.col("f"), F.col("nf")).alias("near_next"),
        F.when(asked, F.col("n_within_radius")).alias("n_within_radius"),
        F.when(asked, F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["print"], x["distance"])), ",")).alias("within_radius"),
    )
