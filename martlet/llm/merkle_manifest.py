"""Merkle manifest of a data set: one root for all rows, and for each row a proof that it is part of it.

``H`` is the lowercase hex SHA-256 of its inputs concatenated, digests as hex text. A row's leaf is H of its fields. The leaves of a
tree (a language) stand by doc_id; while there are several nodes, each 8 consecutive ones (the last run has fewer) become
their H. What remains is the tree's subroot, and the subroots, by language, give the root in the same way.

Leaves get their number from a range partitioning that is written down: counts by partition and tree tell how many precede. Then
512 consecutive nodes (a superblock, three levels) are folded to one by a group of their own, and these again, until each tree has one.
On the way back, superblocks are exchanged: a superblock's nodes and the outer nodes that their proofs need from there to the root
(one row, made by the superblock above) are cogrouped, and one ``applyInPandas`` reduces them once more, joins the
local to the outer proof and folds every leaf up to the root. A group holds 512 nodes at most, whatever the size of a language; a
level has 1/512 of the rows of the one below.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.shared import ascii_lower, stored

RUN = 8
#: levels that a superblock folds, so it has RUN ** BLOCK_LEVELS nodes
BLOCK_LEVELS = 3
BLOCK = RUN**BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODE = "tree string, pos long, total long, node string"
OUTER = "tree string, pos long, lefts array<string>, rights array<string>, subroot string, root string"
PROOF = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def leaf_hash(fields: dict[str, Column]) -> Column:
    """H of the fields in their order, each ``-`` if null, else its UTF-8 bytes' number, a colon and the value."""
    parts = []
    for value in fields.values():
        value = value.cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def document_leaves(docs: DataFrame, tamper: bool = False) -> DataFrame:
    """(tree, doc_id, leaf, claimed) of each row; a tree is a language, whose name sorts as the language does, null first.

    ``claimed`` is null or, with ``tamper``, the leaf that the row has after A-Z of its text are lower-cased, for rows whose
    doc_id has a crc32 that 3 divides; a null doc_id is left alone.
    """
    fields = {c: F.col(c) for c in FIELDS}
    claimed = F.lit(None).cast("string")
    if tamper:
        claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf_hash(fields | {"text": ascii_lower(F.col("text"))}))
    tree = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang")))
    return docs.select(tree.alias("tree"), "doc_id", leaf_hash(fields).alias("leaf"), claimed.alias("claimed"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds pos (from 0, by ``order`` within ``tree``) and total (of the tree); both hold for one written state of the rows.

    Rows are dealt out by ranges of (tree, order), so a tree of any size is sorted by many tasks; the windows see one row
    for each tree and range only.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = ranged.withColumn("range", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    # which row has which place must not change when a task is repeated
    ranged = stored(ranged, "merkle-ranges")
    counts = ranged.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("total")
    )
    return ranged.join(starts, ["tree", "range"]).withColumn("pos", F.col("at") + F.col("shift")).drop("range", "at", "shift")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], total: int) -> list[list[str]]:
    """The levels of a superblock from its nodes up; a tree that is down to one node has no more."""
    levels = [nodes]
    for _ in range(BLOCK_LEVELS):
        if total <= 1:
            break
        nodes = [_hash("".join(nodes[i : i + RUN])) for i in range(0, len(nodes), RUN)]
        total = -(-total // RUN)
        levels.append(nodes)
    return levels


def _fold_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("pos")
    total = int(rows["total"].iloc[0])
    return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "total": [-(-total // BLOCK)], "node": [_levels(rows["node"].tolist(), total)[-1][0]]})


def _siblings(rows: pd.DataFrame) -> tuple[list[list[str]], list[list[str]]]:
    """For each node of a superblock, what stands left and right of it and of its ancestors below the top."""
    levels = _levels(rows["node"].tolist(), int(rows["total"].iloc[0]))
    lefts: list[list[str]] = [[] for _ in range(len(rows))]
    rights: list[list[str]] = [[] for _ in range(len(rows))]
    width = 1
    for level in levels[:-1]:
        for i in range(len(level)):
            first = i - i % RUN
            left, right = "".join(level[first:i]), "".join(level[i + 1 : first + RUN])
            for x in range(i * width, min((i + 1) * width, len(rows))):
                lefts[x].append(left)
                rights[x].append(right)
        width *= RUN
    return lefts, rights


def _exchange(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The outer proofs of a superblock's nodes, which are superblocks of the level below."""
    if nodes.empty:
        return pd.DataFrame({c.split()[0]: [] for c in OUTER.split(", ")})
    nodes, up = nodes.sort_values("pos"), outer.iloc[0]
    lefts, rights = _siblings(nodes)
    return pd.DataFrame(
        {
            "tree": nodes["tree"],
            "pos": nodes["pos"],
            "lefts": [[*x, *up["lefts"]] for x in lefts],
            "rights": [[*x, *up["rights"]] for x in rights],
            "subroot": up["subroot"],
            "root": up["root"],
        }
    )


def _prove(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The proof digest of each leaf of a superblock, and the root that the claimed leaf gives with it."""
    if nodes.empty:
        return pd.DataFrame({c.split()[0]: [] for c in PROOF.split(", ")})
    nodes, up = nodes.sort_values("pos"), outer.iloc[0]
    outer_pairs = list(zip(up["lefts"], up["rights"]))
    outer_proof = "".join(a + b for a, b in outer_pairs)
    proofs, folded = [], []
    for leaf, claimed, left, right in zip(nodes["node"], nodes["claimed"], *_siblings(nodes)):
        pairs = list(zip(left, right))
        proofs.append(_hash("".join(a + b for a, b in pairs) + outer_proof))
        node = claimed or leaf
        for a, b in pairs + outer_pairs:
            node = _hash(a + node + b)
        folded.append(node)
    return pd.DataFrame(
        {"doc_id": nodes["doc_id"], "leaf": nodes["node"], "subroot": up["subroot"], "root": up["root"], "proof_sha256": proofs, "folded_root": folded}
    )


def _blocked(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))


def _reduced(nodes: DataFrame) -> list[DataFrame]:
    """The levels of superblock tops above these nodes; the last one has a row for each tree."""
    levels = []
    while True:
        most = nodes.agg(F.max("total")).first()[0]
        if levels and (most is None or most <= 1):
            return levels
        nodes = stored(_blocked(nodes).groupBy("tree", "block").applyInPandas(_fold_block, NODE), "merkle-level")
        levels.append(nodes)


def _descended(nodes: DataFrame, outer: DataFrame, apply, schema: str) -> DataFrame:
    """Cogroups each superblock's nodes with its row of the level above."""
    above = outer.withColumnRenamed("pos", "block")
    return _blocked(nodes).groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInPandas(apply, schema)


def manifest(leaves: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of (tree, doc_id, leaf, claimed).

    ``claimed`` is the leaf to be checked with the row's proof; null stands for the row's own. Rows with equal doc_id stand by their
    leaves, null ids first; an empty table gives no rows. A lone leaf is its subroot, and a lone subroot the root: the proof is then H of
    nothing. doc_id keeps its type.
    """
    kind = leaves.schema["doc_id"].dataType
    rows = numbered(stored(leaves, "merkle-leaves"), ["doc_id", "leaf", "claimed"])
    # as text: pandas would make floats of integers beside nulls
    rows = rows.select("tree", "pos", "total", F.col("leaf").alias("node"), F.col("doc_id").cast("string").alias("doc_id"), "claimed")
    levels = _reduced(rows.select("tree", "pos", "total", "node"))
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("node"))
    forest = numbered(subroots, ["name"])
    forest_levels = [forest, *_reduced(forest.select("tree", "pos", "total", "node"))]
    none = F.array().cast("array<string>")
    outer = forest_levels[-1].select("tree", "pos", none.alias("lefts"), none.alias("rights"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    for nodes in forest_levels[-2::-1]:
        outer = _descended(nodes, outer, _exchange, OUTER)
    outer = (
        outer.drop("tree", "subroot")
        .join(forest.select("pos", F.col("name").alias("tree"), F.col("node").alias("subroot")), "pos")
        .select("tree", F.lit(0).cast("long").alias("pos"), "lefts", "rights", "subroot", "root")
    )
    for nodes in levels[-2::-1]:
        outer = _descended(nodes, outer, _exchange, OUTER)
    out = _descended(rows, stored(outer, "merkle-outer"), _prove, PROOF)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(levels: int = 8) -> str:
    """SQL for trees of up to RUN ** levels nodes: the levels one by one, each node's run beside it."""
    crc = (
        "(4294967295::BIGINT - list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),"
        " lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),"
        " lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"
    )

    def field(c: str, value: str | None = None) -> str:
        value = value or f"{c}::VARCHAR"
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({value})::VARCHAR || ':' || {value} END"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = " || ".join(map(field, FIELDS))
    claimed = " || ".join([*map(field, FIELDS[:-1]), field("text", lowered)])
    parts = [
        f"""WITH f0 AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, sha256({leaf}) AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN sha256({claimed}) END AS claimed FROM documents
), f AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos FROM f0
), a0 AS (SELECT tree, pos, leaf AS node FROM f
)"""
    ]

    def tree(name: str) -> None:
        for k in range(levels):
            parts.append(
                f""", {name}{k + 1} AS (
  SELECT tree, pos // width AS pos, CASE WHEN width = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node
  FROM (SELECT *, CASE WHEN count(*) OVER (PARTITION BY tree) = 1 THEN 1 ELSE {RUN} END AS width FROM {name}{k}) GROUP BY tree, width, pos // width
), {name}s{k} AS (
  SELECT tree, pos, coalesce(string_agg(node, '' ORDER BY pos) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '' ORDER BY pos) OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r,
         count(*) OVER (PARTITION BY tree) > 1 AS up
  FROM {name}{k} WINDOW r AS (PARTITION BY tree, pos // {RUN} ORDER BY pos)
)"""
            )

    tree("a")
    parts.append(f", b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, node, tree AS name FROM a{levels})")
    tree("b")
    row = "f.doc_id, f.leaf, f.claimed, b0.node AS subroot, top.node AS root"
    joins = [f"JOIN b0 ON b0.name = f.tree CROSS JOIN b{levels} top"]
    siblings = []
    for name, own in (("a", "f"), ("b", "b0")):
        for k in range(levels):
            s = f"{name}s{k}"
            joins.append(f"JOIN {s} ON {s}.tree = {'f.tree' if name == 'a' else chr(39) * 2} AND {s}.pos = {own}.pos // CASE WHEN {s}.up THEN {RUN**k} ELSE {own}.pos + 1 END")
            siblings.append(f"{{'l': {s}.l, 'r': {s}.r, 'up': {s}.up}}")
    parts.append(f", p AS (SELECT {row}, list_filter([{', '.join(siblings)}], lambda s: s.up) AS path FROM f {' '.join(joins)})")
    parts.append(
        """, q AS (
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256,
         list_reduce(list_prepend({'l': coalesce(claimed, leaf), 'r': '', 'up': true}, path), lambda x, s: {'l': sha256(s.l || x.l || s.r), 'r': '', 'up': true}).l AS folded_root FROM p
)
SELECT *, folded_root = root AS verified FROM q"""
    )
    return "\n".join(parts)


ORACLE = _oracle(5)
