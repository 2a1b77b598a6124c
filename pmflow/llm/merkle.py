"""Merkle manifest of a table: a hash tree per part, a tree over the parts'
roots, and a recursive climb from every leaf to the root.

A leaf is the hash of its row's fields, each ``-`` if null, else its UTF-8 byte
count, ``:`` and its text. Within a part, leaves stand by key; while a tree has
several nodes, every two consecutive ones (the last alone, if their number is
odd) become the hash of their hex digests. The parts' roots, by part, are the
leaves of the top tree.

``build`` stores what it builds as node rows, each linked with an ancestor
``stride`` levels up and holding the siblings on the way (``path``): one row per
leaf, and one per node of every ``stride``-th level. ``climb`` is a recursive
query: it starts at all leaves, follows the links, appends the siblings that it
meets and folds the given hash with them, until the root.

Scale. A part may be of any size: rows are range-sorted, levels are built from
groups of 2^stride consecutive nodes, and what climbs through a node near the
root is dealt over copies of its row (``SPREAD`` leaves to each). A step's rows
hold that step's siblings only; a leaf's are joined once, at the end.

Defined cases: null and equal keys and parts are values like others (nulls
first; equal keys stand by hash, equal rows are interchangeable); a null text
or count is ``-``, an empty text ``0:``; a part of one row has that leaf as its
root; an only part's root is the root; an empty table has no rows. Columns that
aren't named are ignored, also those whose names clash with the result's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import column, materialise, place

#: Levels between a stored node and the ancestor that it is linked with.
STRIDE = 6
#: Leaves that climb through one copy of a node's row.
SPREAD = 8192
#: Tree numbers: parts have theirs from 0.
TOP, DONE = -1, -2


def hashed(*fields: Column) -> Column:
    """H: the SHA-256 (32 bytes) of concatenated texts."""
    return F.unhex(F.sha2(F.concat(*fields).cast("binary"), 256))


def digest(b: Column) -> Column:
    """Bytes as lowercase hex."""
    return F.lower(F.hex(b))


def field(c: Column) -> Column:
    """A field as it enters a leaf."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def _parent(level: Column) -> Column:
    """The level above: hashes of two consecutive nodes."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")), lambda i: hashed(
        digest(F.concat(F.get(level, i * 2), F.coalesce(F.get(level, i * 2 + 1), F.lit(b""))))))


def _height(n: Column) -> Column:
    """Levels above n leaves."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _copies(leaves: Column) -> Column:
    return F.ceil(leaves / SPREAD)


def _blocks(nodes: DataFrame, stride: int) -> DataFrame:
    """Nodes (tree, pos, hash, leaves, n: of its tree, row: what a leaf carries)
    -> a written row per 2^stride consecutive ones, with the levels above them."""
    b = nodes.groupBy("tree", F.floor(F.col("pos") / (1 << stride)).alias("block")).agg(
        F.max("n").alias("n"), F.sum("leaves").alias("leaves"),
        F.sort_array(F.collect_list(F.struct("pos", "hash", "leaves", "row"))).alias("nodes"))
    b = b.withColumns({"height": _height(F.col("n")), "l0": F.transform("nodes", lambda x: x["hash"])})
    for j in range(stride):  # a level above the tree's last one repeats it
        b = b.withColumn(f"l{j + 1}", F.when(F.col("height") > j, _parent(F.col(f"l{j}"))).otherwise(F.col(f"l{j}")))
    return materialise(b.select("tree", "block", "n", "height", "leaves", "nodes", F.array(
        *[F.col(f"l{j}") for j in range(stride + 1)]).alias("levels")), "merkle-blocks")


def _linked(blocks: DataFrame, level: int, stride: int, only_part: bool) -> DataFrame:
    """The node rows of some blocks, whose nodes stand ``level`` levels above
    their tree's leaves."""
    x = blocks.select("*", F.posexplode("nodes").alias("p", "node"))
    path = F.transform(F.slice("levels", F.lit(1), F.least("height", F.lit(stride))), lambda nodes, j: F.struct(
        F.get(nodes, F.call_function("shiftright", F.col("p"), j).bitwiseXOR(F.lit(1))).alias("sibling"),
        F.call_function("shiftright", F.col("p"), j).bitwiseAND(F.lit(1)).alias("left")))
    ends, in_top = F.col("height") <= stride, F.col("tree") == TOP
    ancestor = F.get(F.get("levels", F.lit(stride)), F.lit(0))
    x = x.select(
        "tree", F.lit(level).alias("level"), "node.pos", "node.hash", "node.row", "node.leaves", path.alias("path"),
        F.when(~ends, F.col("tree")).when(in_top, DONE).otherwise(TOP).alias("up_tree"),
        F.when(ends, 0).otherwise(level + stride).alias("up_level"),
        F.when(ends, F.col("tree")).otherwise(F.col("block")).alias("up_pos"),
        _copies(F.col("leaves")).alias("up_copies"),
        F.when(ends & ~in_top, ancestor).alias("up_subroot"),
        F.when(ends & (in_top | F.lit(only_part)), ancestor).alias("up_root"))
    siblings = F.aggregate("path", F.lit(b""), lambda a, s: F.concat(a, F.coalesce(s["sibling"], F.lit(b""))))
    return x.withColumn("siblings", siblings)


def _tree(nodes: DataFrame, stride: int, only_part: bool = False) -> tuple[list[DataFrame], DataFrame]:
    """Build all trees of ``nodes``: node rows by stored level, and the roots
    (tree, hash, leaves)."""
    linked, roots, level = [], [], 0
    while True:
        blocks = _blocks(nodes, stride)
        linked.append(_linked(blocks, level, stride, only_part))
        above = blocks.select("tree", F.col("block").alias("pos"), F.get(F.get("levels", F.lit(stride)), F.lit(0)).alias(
            "hash"), "leaves", F.ceil(F.col("n") / (1 << stride)).alias("n"), F.lit(None).cast("int").alias("row"),
            (F.col("height") <= stride).alias("ends"))
        roots.append(above.where("ends").select("tree", "hash", "leaves"))
        nodes, level = above.where("not ends").drop("ends"), level + stride
        if nodes.isEmpty():
            break
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return linked, out


def build(rows: DataFrame, key: str, part: str, fields: Column, changed: Column | None = None,
          stride: int = STRIDE) -> tuple[DataFrame, DataFrame]:
    """The manifest of ``rows``: (leaves, nodes), both written tables.

    ``fields`` is the text that a row's leaf hashes (joined ``field``s),
    ``changed`` another such text, null where the row is as it was: its hash is
    kept beside the leaf to climb from. Leaves have key, part, at, leaf, changed
    and their link; nodes have theirs, a row per copy."""
    base = rows.select(column(key).alias("key"), column(part).alias("part"), hashed(fields).alias("leaf"),
                       (hashed(changed) if changed is not None else F.lit(None).cast("binary")).alias("changed"),
                       F.monotonically_increasing_id().alias("row_no"))
    base = materialise(base, "merkle-rows")
    leaves = place(base, [F.asc_nulls_first("part"), F.asc_nulls_first("key"), F.asc("leaf"), F.asc("row_no")],
                   "merkle-sorted", group="part")
    n_parts = leaves.select("group_no").where("group_at = 0").count()
    row = F.struct("key", "part", "at", "changed")
    linked, roots = _tree(leaves.select(F.col("group_no").alias("tree"), F.col("group_at").alias("pos"), F.col("leaf").alias("hash"),
                                        F.lit(1).cast("bigint").alias("leaves"), F.col("group_n").alias("n"),
                                        row.alias("row")), stride, n_parts == 1)
    found = linked[0].select("row.*", F.col("hash").alias("leaf"), "path", "siblings", "up_tree", "up_level", "up_pos",
                             "up_copies", "up_subroot", "up_root")
    if n_parts > 1:
        top, _ = _tree(roots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("pos"), "hash", "leaves",
                                    F.lit(n_parts).cast("bigint").alias("n"), F.lit(None).cast("int").alias("row")),
                       stride)
        linked += top
    nodes = rows.sparkSession.createDataFrame([], linked[0].drop("row", "hash").schema)
    for x in linked[1:]:
        nodes = nodes.unionByName(x.drop("row", "hash"))
    nodes = nodes.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), _copies(F.col("leaves")) - 1)))
    return materialise(found, "merkle-leaves"), materialise(nodes.drop("leaves"), "merkle-nodes")


#: Follows the links of all leaves, one stored level per step.
CLIMB = """
WITH RECURSIVE climb (at, step, tree, level, pos, copy, siblings, folded, subroot, root) AS (
  SELECT at, 0, up_tree, up_level, up_pos, pmod(at, up_copies), siblings,
         aggregate(path, start, (f, s) -> {fold}), up_subroot, up_root
  FROM {{leaves}}
  UNION ALL
  SELECT c.at, c.step + 1, n.up_tree, n.up_level, n.up_pos, pmod(c.at, n.up_copies), n.siblings,
         aggregate(n.path, c.folded, (f, s) -> {fold}), n.up_subroot, n.up_root
  FROM climb c JOIN {{nodes}} n ON c.tree = n.tree AND c.level = n.level AND c.pos = n.pos AND c.copy = n.copy)
SELECT * FROM climb
""".format(fold="unhex(sha2(CAST(lower(hex(CASE WHEN s.sibling IS NULL THEN f WHEN s.left = 1 THEN s.sibling || f "
                "ELSE f || s.sibling END)) AS BINARY), 256))")


def climb(leaves: DataFrame, nodes: DataFrame, start: Column) -> DataFrame:
    """From every leaf of ``build``'s tables up to the root: (at, subroot, root:
    as built; folded: the root that follows from ``start``, the leaf's hash to
    fold, and the siblings; proof: the siblings' digests, level by level)."""
    spark = leaves.sparkSession
    # as many rows and levels as there are: the defaults are meant for runaway queries
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    steps = spark.sql(CLIMB, leaves=leaves.withColumn("start", start), nodes=nodes)
    ways = F.sort_array(F.collect_list(F.struct("step", "siblings")))
    return steps.groupBy("at").agg(
        F.max("subroot").alias("subroot"), F.max("root").alias("root"),
        F.max(F.when(F.col("root").isNotNull(), F.col("folded"))).alias("folded"),
        digest(F.aggregate(ways, F.lit(b""), lambda a, s: F.concat(a, s["siblings"]))).alias("proof"))


def verify(rows: DataFrame, key: str, part: str, fields: Column, changed: Column | None = None,
           stride: int = STRIDE) -> DataFrame:
    """Build the manifest of ``rows`` and climb from every leaf, changed ones
    from their changed hash: (key, part, leaf, subroot, root, proof, folded,
    verified), digests as lowercase hex, proofs as these joined."""
    leaves, nodes = build(rows, key, part, fields, changed, stride)
    up = climb(leaves, nodes, F.coalesce("changed", "leaf"))
    found = leaves.select("key", "part", "at", "leaf").join(up, "at")
    return found.select("key", "part", *[digest(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], "proof",
                        digest(F.col("folded")).alias("folded"), (F.col("folded") == F.col("root")).alias("verified"))
