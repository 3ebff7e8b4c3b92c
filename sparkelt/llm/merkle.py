"""Merkle manifest of a dataset: a digest per row, per group and of the whole, and a proof per row.

Rows are ranked within their group; the digits of the rank, in base FANOUT, name their place in the
tree. Within a bounded block of rows the digit columns are grouped away one after the other, lowest
first, and each grouping nests the child structs of a node in its parent. One shuffle serves all of
a block's levels, as every grouping keeps the block's key. Block digests are the rows of the next
tier, until a group has one node; the group digests are a last tree. From the top down, every nested
block is then unfolded by a transform and an explode, which hands each child its siblings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
#: Levels of a block: at most FANOUT ** LEVELS rows are nested in one struct.
LEVELS = 6

#: One step of a proof: what stands to the left and to the right of the node in its run.
STEP = "array<struct<left:string,right:string>>"
_POSITION = (1 << 33) - 1


# --- digests --------------------------------------------------------------------------------------


def leaf_digest(*values: Column) -> Column:
    """Hex SHA-256 over the values: each ``-`` if null, else its UTF-8 length, a colon and itself."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def proof_digest(path: Column) -> Column:
    """Hex SHA-256 over all siblings of a proof, from the leaf to the root, left to right."""
    steps = F.transform(path, lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(steps, ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, leaf, lambda own, s: F.sha2(F.concat(s["left"], own, s["right"]), 256))


# --- ranks ----------------------------------------------------------------------------------------


def _ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the position in their group from zero, and ``n``, the group's size.

    A range sort: a group with a third of all rows is cut across partitions. The positions are noted
    as the sorted rows are written; rows of a group before a partition are summed over its at most
    one count per partition.
    """
    by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = written(placed.withColumn("__m", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumns({"__part": F.shiftright("__m", 33), "__pos": F.col("__m").bitwiseAND(F.lit(_POSITION))})
    counts = placed.groupBy("__part", *group).agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__first"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    starts = counts.select(
        "__part",
        *group,
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(whole).alias("n"),
    )
    found = placed.join(starts, ["__part", *group])
    return found.withColumn("at", F.col("__pos") + F.col("__shift")).drop("__m", "__part", "__pos", "__shift")


# --- one tier -------------------------------------------------------------------------------------


def _nested(nodes: DataFrame, group: list[str], levels: int) -> DataFrame:
    """One row per block of ``nodes`` (group, at, n, node): group, n, block, and the nested node.

    ``node`` is a struct that begins with its digest. A level is applied while several nodes of the
    group remain; beyond that a node is handed up as it is.
    """
    size = FANOUT**levels
    digits = [f"__d{i}" for i in range(levels)]
    places = {d: (F.expr(f"at div {FANOUT ** i}") % FANOUT).cast("int") for i, d in enumerate(digits)}
    block = F.expr(f"at div {size}").alias("block")
    rows = nodes.select(*group, "n", block, *[c.alias(d) for d, c in places.items()], "node")
    rows = rows.repartition(*group, "block")
    for level, digit in enumerate(digits):
        by = [*group, "n", "block", *digits[level + 1 :]]
        runs = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(digit, "node"))).alias("run"))
        joined = F.sha2(F.array_join(F.col("run.node.digest"), ""), 256)
        digest = F.when(F.col("n") > FANOUT**level, joined).otherwise(F.col("run")[0]["node"]["digest"])
        rows = runs.select(*by, F.struct(digest.alias("digest"), F.col("run.node").alias("kids")).alias("node"))
    return rows


def _unfolded(node: Column, n: Column, above: Column, levels: int) -> Column:
    """The bottom nodes below ``node``, each with the steps of its proof, lowest first."""
    if levels == 0:
        return F.array(F.struct(node.alias("node"), above.alias("path")))
    kids = node["kids"]

    def below(kid: Column, i: Column) -> Column:
        left = F.array_join(F.slice(kids["digest"], F.lit(1), i), "")
        right = F.array_join(F.slice(kids["digest"], i + 2, F.lit(FANOUT)), "")
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        path = F.when(n > FANOUT ** (levels - 1), F.concat(step, above)).otherwise(above)
        return _unfolded(kid, n, path, levels - 1)

    return F.flatten(F.transform(kids, below))


# --- one tree per group ---------------------------------------------------------------------------


class _Forest:
    """The trees over ``nodes`` (group, at, n, node), one per group, as tiers of nested blocks."""

    def __init__(self, nodes: DataFrame, group: list[str], levels: int):
        self.group, self.levels, self.tiers = group, levels, []
        size = FANOUT**levels
        most = nodes.agg(F.max("n")).first()[0] or 0
        while True:
            tier = written(_nested(nodes, group, levels), "blocks")
            self.tiers.append(tier)
            if most <= size:
                break
            most = -(-most // size)
            blocks = F.expr(f"(n + {size - 1}) div {size}")
            node = F.struct(F.col("node.digest").alias("digest"), F.col("block").alias("at"))
            nodes = tier.select(*group, F.col("block").alias("at"), blocks.alias("n"), node.alias("node"))

    def tops(self) -> DataFrame:
        """group and ``digest`` of each tree."""
        return self.tiers[-1].select(*self.group, F.col("node.digest").alias("digest"))

    def leaves(self, tops: DataFrame) -> DataFrame:
        """group, node, path and ``told`` of every bottom node; ``tops`` has group, path and told.

        Each tier's blocks meet what is known above them by a grouping of two rows per block.
        """
        known = tops.withColumn("block", F.lit(0).cast("long"))
        for tier in reversed(self.tiers):
            key = [*self.group, "block"]
            parts = tier.select(*key, "n", "node", F.lit(None).cast(known.schema["path"].dataType).alias("path"), F.lit(None).cast(known.schema["told"].dataType).alias("told"))
            above = known.select(*key, F.lit(None).cast("long").alias("n"), F.lit(None).cast(tier.schema["node"].dataType).alias("node"), "path", "told")
            met = parts.unionByName(above).groupBy(*key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", "told")])
            rows = met.select(*self.group, "told", F.explode(_unfolded(F.col("node"), F.col("n"), F.col("path"), self.levels)).alias("e"))
            rows = rows.select(*self.group, "told", F.col("e.node").alias("node"), F.col("e.path").alias("path"))
            if tier is self.tiers[0]:
                return rows
            known = rows.select(*self.group, "told", "path", F.col("node.at").alias("block"))


# --- the manifest ---------------------------------------------------------------------------------


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    carried: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """order, group, leaf, subroot, root and path of every row of ``docs``, and ``carried`` columns.

    ``leaf`` is the digest of the row's ``fields``; leaves of a group ascend by ``order``, group
    digests by group, nulls first, text by its bytes. Runs of FANOUT nodes are joined until one is
    left. ``path`` holds the siblings by which ``folded(leaf, path)`` gives ``root``. ``carried``
    are further columns, computed from the row where its text is read, such as another leaf; texts
    never move. Defined results: null and empty values have different digests; rows of equal
    ``order`` follow the order of their digests, repeated rows count each; a group of one row has
    its leaf as digest, a table of one group that group's digest as root; an empty table gives an
    empty table; other columns are left out.
    """
    carried = carried or {}
    kinds = docs.schema
    own = [F.col(f"`{f}`") for f in fields]
    leaf = leaf_digest(*own).alias("digest")
    extra = F.struct(F.col(f"`{order}`").alias("id"), *[c.alias(f"c{i}") for i, c in enumerate(carried.values())])
    name = F.col(f"`{group}`")
    leaves = docs.select(F.coalesce(name.cast("string"), F.lit("")).alias("g"), name.isNotNull().alias("named"), leaf, extra.alias("extra"))
    # The number tells equal rows apart, so that ranges may cut through them.
    leaves = written(leaves.withColumn("seq", F.monotonically_increasing_id()), "leaves")
    ranked = _ranked(leaves.withColumn("id", F.col("extra.id")), ["named", "g"], ["id", "digest", "seq"])
    trees = _Forest(ranked.select("named", "g", "at", "n", F.struct("digest", "extra").alias("node")), ["named", "g"], levels)

    tops = _ranked(trees.tops(), [], ["named", "g"])
    one = F.lit(0).alias("all")
    whole = _Forest(tops.select(one, "at", "n", F.struct("digest", "named", "g").alias("node")), ["all"], levels)
    start = whole.tops().select("all", F.array().cast(STEP).alias("path"), F.struct(F.col("digest").alias("root")).alias("told"))
    groups = whole.leaves(start)
    told = F.struct(F.col("told.root").alias("root"), F.col("node.digest").alias("subroot"))
    known = groups.select(F.col("node.named").alias("named"), F.col("node.g").alias("g"), "path", told.alias("told"))

    rows = trees.leaves(known)
    value = F.when(F.col("named"), F.col("g")).cast(kinds[group].dataType)
    return rows.select(
        F.col("node.extra.id").alias(order),
        value.alias(group),
        F.col("node.digest").alias("leaf"),
        F.col("told.subroot").alias("subroot"),
        F.col("told.root").alias("root"),
        "path",
        *[F.col(f"node.extra.c{i}").alias(c) for i, c in enumerate(carried)],
    )
