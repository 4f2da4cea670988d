"""Token budgets for a domain-language-source tree, and the documents that fill them.

1. A budget falls from the root to the leaves. At each node the children get it in proportion to their weights, none
   more than its capacity (``max_epochs`` times the tokens below it); what a child can't take goes to its
   siblings by weight, and only what all siblings together can't take is left to the ancestors' other
   branches. With the capacities summed from the leaves, that is one water-filling at each level, from the top: children
   sorted by capacity over weight are filled up as long as that ratio is below the level, the rest share what
   remains, rounded so that the shares add up.
2. A leaf with a budget of q times its tokens and a rest takes all of its documents q times (q epochs), and in
   the next epoch a prefix of the rest's length in that epoch's order, a seeded hash of the document; the last document is
   cut after the tokens that are left.

The prefix ends at one value of the order hash per leaf. It is found from token sums over 2**14 ranges
of the hash, summed before the shuffle, then by sorting the one range per leaf in which it lies, so no task sorts a
leaf. What is needed of each document (its leaf, doc_id and number of tokens) is written once and the plan is made from
that. Documents are not shuffled but compared with their leaf's end where they are read, as long as there are at most
``BROADCAST_LEAVES`` leaves; with more, they are joined by leaf. Tokens are the words ``[^\x20\x09-\x0D]+``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.shared import stored

SEED = 17
BROADCAST_LEAVES = 100_000  # some 10 MB
MAX_EPOCHS = 3
LEVELS = ("domain", "lang", "source")
RANGE_SHIFT = 46  # of the 60 bits of the order hash: 2**14 ranges
# relative weights among siblings; nodes that are not named weigh 1
WEIGHTS = {("crawl",): 3, ("curated",): 5, ("community",): 2, ("crawl", "en"): 4, ("curated", "en"): 2, ("community", "de"): 3}

_WORD = r"[^ \t-\r]+"
_BIG = "decimal(38,0)"


def domain_of(source: Column) -> Column:
    """The domain of a source by its number: 0 crawl, odd curated, even community; other names unknown."""
    number = F.try_to_number(F.regexp_extract(source, "^src([0-9]{1,9})$", 1), F.lit("999999999"))
    return (
        F.when(number.isNull(), "unknown").when(number == 0, "crawl").when(number % 2 == 1, "curated").otherwise("community")
    )


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def node_key(depth: int) -> Column:
    """The path of a node as text, null parts told apart from empty ones."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in LEVELS[:depth]]))


def _weight(depth: int, weights: dict[tuple, int]) -> Column:
    named = [(path, w) for path, w in weights.items() if len(path) == depth]
    out = F.lit(1)
    for path, w in named:
        same = F.lit(True)
        for c, value in zip(LEVELS, path):
            same = same & F.col(c).eqNullSafe(F.lit(value))
        out = F.when(same, F.lit(w)).otherwise(out)
    return out.cast("long")


def _fill(children: DataFrame) -> DataFrame:
    """Adds ``share`` to (parent, node, given, capacity, weight): what each child gets of its parent's ``given``."""
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf")))
    siblings = Window.partitionBy("parent")
    before = siblings.orderBy("ratio", "node").rowsBetween(Window.unboundedPreceding, -1)
    big = lambda c: F.col(c).cast(_BIG)
    ranked = children.withColumn("ratio", ratio)
    ranked = ranked.withColumn("left", F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0)))
    ranked = ranked.withColumn("weights", F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    ranked = ranked.withColumn("full", big("capacity") * big("weights") <= big("left") * big("weight"))
    ranked = ranked.withColumn("rest", F.max(F.when(~F.col("full"), F.col("left"))).over(siblings))
    ranked = ranked.withColumn("rest_weights", F.max(F.when(~F.col("full"), F.col("weights"))).over(siblings))
    # whole-number division of decimals: products of tokens and weights can pass 64 bits
    part = lambda w: F.expr(f"(CAST(rest AS {_BIG}) * ({w})) div rest_weights")
    shared = F.when(F.col("rest_weights") > 0, part("rest_weights - weights + weight") - part("rest_weights - weights")).otherwise(F.lit(0))
    share = F.when(F.col("full"), F.col("capacity")).otherwise(shared)
    return ranked.withColumn("share", share).drop("ratio", "left", "weights", "full", "rest", "rest_weights")


def leaf_budgets(leaves: DataFrame, weights: dict[tuple, int], budget_percent: int, max_epochs: int) -> DataFrame:
    """(domain, lang, source, leaf, available, budget) from (domain, lang, source, available).

    The whole budget is ``budget_percent`` percent of all tokens.
    """
    named = leaves.withColumn("capacity", F.col("available") * max_epochs).withColumn("leaf", node_key(3))
    # the root's key is an empty text cut from the keys below it: a literal would turn the join into a cross join
    root = lambda key: F.substring(key, 1, 0)
    total = named.groupBy(root("leaf").alias("parent")).agg(F.sum("available").alias("all"))
    above = total.select("parent", F.floor(F.lit(budget_percent) * F.col("all") / 100).cast("long").alias("given"))
    for depth in (1, 2, 3):
        level = LEVELS[:depth]
        nodes = named.groupBy(*level).agg(F.sum("capacity").alias("capacity"))
        parent = node_key(depth - 1) if depth > 1 else root(node_key(1))
        nodes = nodes.select(*level, parent.alias("up"), node_key(depth).alias("node"), "capacity", _weight(depth, weights).alias("weight"))
        nodes = nodes.join(above, F.col("up") == F.col("parent")).drop("up")
        filled = _fill(nodes)
        above = filled.select(F.col("node").alias("parent"), F.col("share").alias("given"))
    return named.join(above, F.col("leaf") == F.col("parent")).select(*LEVELS, "leaf", "available", F.col("given").alias("budget"))


def order_hash(seed: int, epoch: Column, doc_id: Column) -> Column:
    """60 bits that order the documents of one epoch."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _prefix_ends(slim: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """(leaf, epochs, end_hash, end_tokens): where the last epoch of each leaf ends; end_hash is null if it is empty.

    Documents below the end hash are taken whole, those at it get end_tokens each.
    """
    goal = plan.filter("available > 0").select(
        F.col("leaf").alias("goal_leaf"), F.expr("budget div available").alias("epochs"), F.expr("budget % available").alias("rest")
    )
    hashed = slim.join(goal.filter("rest > 0"), F.col("leaf") == F.col("goal_leaf")).select(
        "leaf", "rest", "n_tokens", order_hash(seed, F.col("epochs"), F.col("doc_id")).alias("h")
    )
    ranges = hashed.groupBy("leaf", F.shiftright("h", RANGE_SHIFT).alias("r")).agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("rest"))
    so_far = Window.partitionBy("leaf").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    ends = ranges.withColumn("after", F.sum("t").over(so_far)).filter("after - t < rest AND rest <= after")
    ends = ends.select(F.col("leaf").alias("end_leaf"), "r", (F.col("after") - F.col("t")).alias("before"))
    inside = hashed.join(ends, (F.col("leaf") == F.col("end_leaf")) & (F.shiftright("h", RANGE_SHIFT) == F.col("r")))
    values = inside.groupBy("leaf", "h").agg(
        F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("rows"), F.first("rest").alias("rest"), F.first("before").alias("before")
    )
    so_far = Window.partitionBy("leaf").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    last = values.withColumn("after", F.col("before") + F.sum("t").over(so_far)).filter("after - t < rest AND rest <= after")
    last = last.select(
        F.col("leaf").alias("last_leaf"), F.col("h").alias("end_hash"), F.expr("(rest - (after - t)) div rows").alias("end_tokens")
    )
    return goal.join(last, F.col("goal_leaf") == F.col("last_leaf"), "left").select("goal_leaf", "epochs", "end_hash", "end_tokens")


def planned(
    docs: DataFrame,
    weights: dict[tuple, int] | None = None,
    budget_percent: int = 100,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The rows of a frame (doc_id, domain, lang, source, n_tokens, ...) with what the mixture takes of each.

    Adds leaf, epochs (how often the row is taken whole) and prefix_tokens (what the last epoch takes of it). All rows
    stay, also those of which nothing is taken. Null paths are leaves of their own. Rows of one leaf that
    share a doc_id (nulls too) are neighbours in the order; those at the end of a prefix divide what is left evenly, rounded down, none
    more than it has. A leaf without tokens, and an empty table, take nothing.
    """
    keyed = docs.withColumn("leaf", node_key(3))
    slim = stored(keyed.select("leaf", *LEVELS, "doc_id", "n_tokens"), "mixture-tokens")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("available"))
    plan = leaf_budgets(leaves, WEIGHTS if weights is None else weights, budget_percent, max_epochs)
    ends = stored(_prefix_ends(slim, plan, seed), "mixture-ends")
    if ends.count() <= BROADCAST_LEAVES:
        ends = F.broadcast(ends)
    joined = keyed.join(ends, F.col("leaf") == F.col("goal_leaf"), "left")
    h = order_hash(seed, F.col("epochs"), F.col("doc_id"))
    taken = F.when(F.col("end_hash").isNull(), F.lit(0)).when(h < F.col("end_hash"), F.col("n_tokens"))
    taken = taken.when(h == F.col("end_hash"), F.least("end_tokens", "n_tokens")).otherwise(F.lit(0))
    return joined.withColumn("prefix_tokens", taken.cast("long")).withColumn("epochs", F.coalesce("epochs", F.lit(0)).cast("long")).drop(
        "goal_leaf", "end_hash", "end_tokens"
    )


def mixture_plan(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, domain, lang, source, n_tokens, epochs, prefix_tokens."""
    slim = docs.select("doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", count_tokens(F.col("text")).alias("n_tokens"))
    return planned(slim, **settings).select("doc_id", *LEVELS, "n_tokens", "epochs", "prefix_tokens")


def first_tokens(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th token."""
    pieces = F.split(text, r"(?<=[^ \t-\r])(?=[ \t-\r])", -1)
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mixture takes them, with all their columns.

    A row comes once for each epoch that takes it whole, and once more, cut to its first prefix_tokens tokens, if the
    last epoch takes a part; n_chars, where there is one, follows the text. Columns pass through whatever they are called.
    """
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).select(
        "row",
        F.col("row.doc_id").alias("doc_id"),
        domain_of(F.col("row.source")).alias("domain"),
        F.col("row.lang").alias("lang"),
        F.col("row.source").alias("source"),
        count_tokens(F.col("row.text")).alias("n_tokens"),
    )
    times = F.array_repeat(F.col("n_tokens"), F.col("epochs").cast("int"))
    rest = F.when(F.col("prefix_tokens") > 0, F.array("prefix_tokens")).otherwise(F.array().cast("array<bigint>"))
    taken = planned(row, **settings).select("row", "n_tokens", F.explode(F.concat(times, rest)).alias("take"))
    text = F.when(F.col("take") < F.col("n_tokens"), first_tokens(F.col("row.text"), F.col("take"))).otherwise(F.col("row.text"))
    out = taken.select("row", text.alias("taken_text"))
    columns = []
    for c in names:
        if c == "text":
            columns.append(F.col("taken_text").alias("text"))
        elif c == "n_chars":
            columns.append(F.char_length("taken_text").cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(F.col(f"row.`{c}`").alias(c))
    return out.select(*columns)


def _sql_case(depth: int) -> str:
    named = [(p, w) for p, w in WEIGHTS.items() if len(p) == depth]
    whens = " ".join(f"WHEN {' AND '.join(f'''{c} = '{v}' ''' for c, v in zip(LEVELS, p))} THEN {w}" for p, w in named)
    return f"CASE {whens} ELSE 1 END" if whens else "1"


def _sql_level(depth: int, above: str) -> str:
    path = ", ".join(LEVELS[:depth])
    same = " AND ".join(f"n.{c} IS NOT DISTINCT FROM a.{c}" for c in LEVELS[: depth - 1]) or "true"
    parent = ", ".join(LEVELS[: depth - 1])
    part = f"PARTITION BY {parent}" if parent else ""
    node = "to_json([" + ", ".join(f"{c}::VARCHAR" for c in LEVELS[:depth]) + "])"
    return f"""
n{depth} AS (SELECT {path}, sum(capacity) AS capacity, {_sql_case(depth)} AS weight FROM leaf GROUP BY {path}),
g{depth} AS (SELECT n.*, a.share AS given, {node.replace("[", "[n.").replace(", ", ", n.")} AS node FROM n{depth} n JOIN {above} a ON {same}),
r{depth} AS (SELECT *, given - coalesce(sum(capacity) OVER w, 0) AS left_, sum(weight) OVER ({part}) - coalesce(sum(weight) OVER w, 0) AS weights
  FROM g{depth} WINDOW w AS ({part} ORDER BY capacity::DOUBLE / weight, node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f{depth} AS (SELECT *, capacity * weights <= left_ * weight AS full_ FROM r{depth}),
e{depth} AS (SELECT *, max(CASE WHEN NOT full_ THEN left_ END) OVER ({part}) AS rest, max(CASE WHEN NOT full_ THEN weights END) OVER ({part}) AS rw FROM f{depth}),
s{depth} AS (SELECT {path}, CASE WHEN full_ THEN capacity ELSE (rest * (rw - weights + weight)) // rw - (rest * (rw - weights)) // rw END AS share FROM e{depth})"""


ORACLE = f"""
WITH d AS (
  SELECT doc_id, lang, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS n_tokens,
         TRY_CAST(nullif(regexp_extract(source, '^src([0-9]{{1,9}})$', 1), '') AS BIGINT) AS number FROM documents
), doc AS (
  SELECT *, CASE WHEN number IS NULL THEN 'unknown' WHEN number = 0 THEN 'crawl' WHEN number % 2 = 1 THEN 'curated' ELSE 'community' END AS domain FROM d
), leaf AS (SELECT domain, lang, source, sum(n_tokens) AS available, sum(n_tokens) * {MAX_EPOCHS} AS capacity FROM doc GROUP BY ALL),
s0 AS (SELECT sum(available) AS share FROM leaf),
{_sql_level(1, "s0")},
{_sql_level(2, "s1")},
{_sql_level(3, "s2")},
goal AS (SELECT leaf.domain, leaf.lang, leaf.source, share // available AS epochs, share % available AS rest
  FROM leaf JOIN s3 ON leaf.domain IS NOT DISTINCT FROM s3.domain AND leaf.lang IS NOT DISTINCT FROM s3.lang AND leaf.source IS NOT DISTINCT FROM s3.source
  WHERE available > 0),
h AS (SELECT doc.*, epochs, rest, ('0x' || substr(md5(concat('{SEED}:', epochs, ':', doc_id)), 1, 15))::BIGINT AS h
  FROM doc LEFT JOIN goal ON doc.domain IS NOT DISTINCT FROM goal.domain AND doc.lang IS NOT DISTINCT FROM goal.lang AND doc.source IS NOT DISTINCT FROM goal.source),
o AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h RANGE UNBOUNDED PRECEDING) AS after FROM h)
SELECT doc_id, domain, lang, source, n_tokens, coalesce(epochs, 0)::BIGINT AS epochs,
       coalesce(greatest(0, least(n_tokens, rest - (after - n_tokens))), 0)::BIGINT AS prefix_tokens FROM o
"""
