"""A Merkle manifest of a dataset, and proofs that climb it by a recursive query.

Rows are leaves. The leaves of a source, in the order of their ids, are hashed together
three at a time, level by level, to the source's subroot, and the subroots likewise to
the root. The levels are stored as rows of nodes, each linked to its parent and holding
what its siblings' digests add on its left and on its right. A recursive query then
climbs from all leaves at once: a step joins every leaf's present node with its row,
gives the siblings, and folds the leaf's digest with them.

Ranks inside a source are taken without bringing a source together: leaves are sorted by
ranges, and the ranges' counts are summed. Six levels are made per pass, from blocks of
729 neighbours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import column, let, stage

ARITY = 3
# Levels made in one pass.
LEVELS = 6
BLOCK = ARITY**LEVELS
# The levels over the sources' subroots are numbered from here on.
UPPER = 64
# Nodes near the root that every task may hold; a row has some 150 bytes.
TOP_NODES = 20_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_HEIGHT = "size(filter(sequence(0, 33), k -> power(3, k) < n))"


def leaf_hash(changed: Mapping[str, Column] | None = None, fields: Sequence[str] = COLUMNS) -> Column:
    """Digest of a row: each field's length in bytes and value, or a dash for null."""
    parts = []
    for name in fields:
        value = (changed or {}).get(name, column(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


@dataclass(frozen=True)
class Manifest:
    """The stored tree: a row per leaf with its first step, a row per other node.

    `leaves`: id, doc_id, leaf, node, upto, folded, siblings. `nodes`: level, node,
    parent, upto, before, after, subroot. `upto` is the level of the next row up.
    """

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def build(
    docs: DataFrame, found: str | None = None, doc_id: str = "doc_id", source: str = "source", fields: Sequence[str] = COLUMNS
) -> Manifest:
    """The tree over all rows. `found` names the column of digests that proofs start from.

    Leaves with a null id come first in their source; rows of one id follow each other
    in the order of their digests, and each is a leaf of its own. The null source comes
    first. Without `found` the proofs start from the leaves themselves, as where it is
    null. Texts are hashed whole. No rows give a manifest without a root.
    """
    own = leaf_hash(fields=fields)
    given = own if found is None else F.coalesce(column(found), own)
    name = column(source).cast("string")
    leaves = stage(
        docs.select(
            F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("tree"),
            column(doc_id).cast("long").alias("doc_id"),
            own.alias("own"),
            F.unhex(given).alias("found"),
            F.monotonically_increasing_id().alias("salt"),
        ),
        "leaves",
    )
    numbered = _numbered(leaves, ["doc_id", "own", "salt"])
    lower, subroots = _levels(numbered.withColumn("node", _node(0, F.col("first"), F.col("pos"))), 0)
    # Sources are few next to leaves, but may be any number.
    tops = stage(
        subroots.select(F.lit("").alias("tree"), F.col("first").alias("rank"), "node", "own", F.lit(0).alias("salt")), "subroots"
    )
    upper, roots = _levels(_numbered(tops, ["rank"]), UPPER)
    root = roots.select("own").head()
    return Manifest(_first_steps(lower[0]), _nodes(lower, upper), root and root[0])


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with `pos`, their rank within their tree, `n`, its rows, and `first`, the
    rank of its first row among all; ranks are counted from 0."""
    keys = ["tree", *order]
    place = F.monotonically_increasing_id()
    placed = stage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", place), "placed")
    part, at = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    spots = stage(
        placed.groupBy(part.alias("part"), F.col("tree").alias("of")).agg(F.count(F.lit(1)).alias("rows"), F.min(at).alias("at")),
        "spots",
    )
    # A row per range of the sort.
    upto = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = spots.groupBy(F.col("part").alias("p")).agg(F.sum("rows").alias("rows"))
    parts = parts.select("p", F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("base"))
    tree = Window.partitionBy("of")
    spots = spots.join(parts, F.col("part") == F.col("p")).select(
        "part", "of", "base", F.min(F.col("base") + F.col("at")).over(tree).alias("first"), F.sum("rows").over(tree).alias("n")
    )
    joined = placed.withColumn("in", part).join(spots, (F.col("in") == F.col("part")) & (F.col("tree") == F.col("of")))
    return joined.withColumn("pos", F.col("base") + at - F.col("first")).drop("place", "in", "part", "of", "base", "tree")


def _node(level: Column | int, first: Column, pos: Column) -> Column:
    """Number of a node: the level, then a place that no other tree's nodes have."""
    level = F.lit(level) if isinstance(level, int) else level
    return F.shiftleft(level.cast("long"), 56) + first + pos


def _hashed(level: Column) -> Column:
    """Digests of a level's runs, from the hex digests of its nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda run: F.sha2(F.array_join(F.slice(level, run * ARITY + 1, ARITY), ""), 256))


def _levels(members: DataFrame, lowest: int) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every pass, and the top node of every tree.

    A block holds neighbours of one level of one tree (`members`) and the digests of all
    levels that are made of them (`levels`, the first its members' own).
    """
    passes: list[DataFrame] = []
    tops = None
    members = members.withColumn("height", F.expr(_HEIGHT)).drop("n")
    carried = [c for c in members.columns if c not in ("first", "height", "pos", "salt")]
    while True:
        base = LEVELS * len(passes)
        member = F.struct("pos", *[c for c in carried if c in members.columns])
        steps = F.least(F.lit(LEVELS), F.col("height") - base)
        grouped = members.groupBy("first", "height", F.expr(f"pos div {BLOCK}").alias("block")).agg(
            F.sort_array(F.collect_list(member)).alias("members")
        )
        grow = lambda made, _: F.concat(made, F.array(let(F.element_at(made, -1), _hashed)))
        own = F.transform("members", lambda m: m["own"])
        levels = F.when(steps > 0, F.aggregate(F.sequence(F.lit(1), steps), F.array(own), grow)).otherwise(F.array(own))
        blocks = stage(
            grouped.select(
                "first", "height", "block", steps.alias("steps"), "members", levels.alias("levels")
            ).withColumns({"base": F.lit(base), "lowest": F.lit(lowest)}),
            "blocks",
        )
        passes.append(blocks)
        summit = F.element_at(F.element_at("levels", -1), 1)
        node = F.when(F.col("steps") == 0, F.col("members")[0]["node"]).otherwise(
            _node(F.col("height") + lowest, F.col("first"), F.lit(0))
        )
        done = blocks.filter(F.col("height") <= base + LEVELS).select("first", node.alias("node"), summit.alias("own"))
        tops = done if tops is None else tops.unionByName(done)
        more = blocks.filter(F.col("height") > base + LEVELS)
        if more.isEmpty():
            return passes, tops
        members = more.select(
            "first",
            "height",
            F.col("block").alias("pos"),
            _node(base + LEVELS + lowest, F.col("first"), F.col("block")).alias("node"),
            summit.alias("own"),
        )


def _beside(level: Column, i: Column) -> tuple[Column, Column]:
    """Digests of a node's siblings on its left and on its right, as bytes."""
    within = i % ARITY
    joined = lambda start, n: F.unhex(F.array_join(F.slice(level, start, n), ""))
    return joined(i - within + 1, within), joined(i + 2, ARITY - 1 - within)


def _above(j: Column, i: Column) -> tuple[Column, Column]:
    """Number of the parent of a block's node, and the level of the next row up.

    The row of a tree's top lies in the tree above, under the same number.
    """
    level = F.col("base") + j + 1
    width = F.get(F.array(*[F.lit(ARITY ** (LEVELS - k)).cast("long") for k in range(LEVELS)]), j)
    pos = F.floor((F.col("block") * width + i) / ARITY)
    inside = F.when(level < F.col("height"), level + F.col("lowest"))
    return _node(level + F.col("lowest"), F.col("first"), pos), F.when(F.col("lowest") == 0, F.coalesce(inside, F.lit(UPPER))).otherwise(inside)


def _fold(before: Column, digest: Column, after: Column) -> Column:
    return F.unhex(F.sha2(F.lower(F.hex(F.concat(before, digest, after))), 256))


def _first_steps(blocks: DataFrame) -> DataFrame:
    """Every leaf after its first step; a leaf alone in its source takes none."""

    def step(m: Column, i: Column) -> Column:
        before, after = _beside(F.element_at("levels", 1), i)
        parent, upto = _above(F.lit(0), i)
        alone = F.col("steps") == 0
        return F.struct(
            m["node"].alias("id"),
            m["doc_id"].alias("doc_id"),
            m["own"].alias("leaf"),
            F.when(alone, m["node"]).otherwise(parent).alias("node"),
            upto.alias("upto"),
            F.when(alone, m["found"]).otherwise(_fold(before, m["found"], after)).alias("folded"),
            F.concat(before, after).alias("siblings"),
        )

    return stage(blocks.select(F.inline(F.transform("members", step))), "steps")


def _nodes(lower: list[DataFrame], upper: list[DataFrame]) -> DataFrame:
    """A row for every node but the leaves and the root."""

    def rows(blocks: DataFrame, from_level: int, subroots: bool) -> DataFrame:
        def of_level(level: Column, j: Column) -> Column:
            def of_node(own: Column, i: Column) -> Column:
                before, after = _beside(level, i)
                parent, upto = _above(j, i)
                width = F.get(F.array(*[F.lit(ARITY ** (LEVELS - k)).cast("long") for k in range(LEVELS)]), j)
                number = _node(F.col("base") + j + F.col("lowest"), F.col("first"), F.col("block") * width + i)
                given = F.get(F.col("members"), i)["node"]
                return F.struct(
                    (F.col("base") + j + F.col("lowest")).alias("level"),
                    F.when(j == 0, given).otherwise(number).alias("node"),
                    parent.alias("parent"),
                    upto.alias("upto"),
                    before.alias("before"),
                    after.alias("after"),
                    F.when((j == 0) & F.lit(subroots), F.unhex(own)).alias("subroot"),
                )

            return F.when(j < from_level, F.array().cast(_NODES)).otherwise(F.transform(level, of_node))

        made = F.transform(F.slice("levels", 1, F.col("steps")), of_level)
        return blocks.select(F.inline(F.flatten(made)))

    parts = [rows(b, 1 if k == 0 else 0, False) for k, b in enumerate(lower)]
    parts += [rows(b, 0, k == 0) for k, b in enumerate(upper)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return stage(found, "nodes")


_NODES = "array<struct<level:int,node:bigint,parent:bigint,upto:int,before:binary,after:binary,subroot:binary>>"
_CLIMB = """
WITH RECURSIVE climb AS (
  SELECT id, node, upto, folded, siblings, subroot, depth FROM {begin}
  UNION ALL
  SELECT c.id, n.parent, n.upto,
         unhex(sha2(lower(hex(concat(n.before, c.folded, n.after))), 256)),
         concat(n.before, n.after), n.subroot, c.depth + 1
  FROM climb c JOIN {nodes} n ON c.node = n.node
)
SELECT id, node, upto, folded, siblings, subroot, depth FROM climb LIMIT ALL
"""


def verify(tree: Manifest) -> DataFrame:
    """Climb from every leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    `proof_sha256` is the digest of the siblings' digests met on the way up. Below, where
    a node has few leaves, a step is a join by node; the nodes near the root, which
    every leaf passes, are a bounded number and go to all tasks.
    """
    spark = tree.leaves.sparkSession
    begin = tree.leaves.select(
        "id", "node", "upto", "folded", "siblings", F.lit(None).cast("binary").alias("subroot"), F.lit(0).alias("depth")
    )
    counts = dict(tree.nodes.groupBy("level").count().collect())
    border = min((k for k in counts if sum(n for j, n in counts.items() if j >= k) <= TOP_NODES), default=2 * UPPER)
    inner = F.coalesce(F.col("upto") < border, F.lit(False))
    rows = begin
    if any(level < border for level in counts):
        rows = stage(spark.sql(_CLIMB, begin=begin, nodes=tree.nodes.filter(F.col("level") < border)), "climb")
    near_root = F.broadcast(tree.nodes.filter(F.col("level") >= border))
    rows = rows.filter(inner).unionByName(spark.sql(_CLIMB, begin=rows.filter(~inner), nodes=near_root))
    ends = tree.leaves.select("id", "doc_id", "leaf")
    all_rows = rows.select("id", "depth", "siblings", "folded", "subroot").unionByName(ends, allowMissingColumns=True)
    met = F.sort_array(F.collect_list(F.when(F.col("depth").isNotNull(), F.struct("depth", "siblings"))))
    grouped = all_rows.groupBy("id").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("leaf").alias("leaf"),
        F.max("subroot").alias("subroot"),
        F.max_by("folded", "depth").alias("folded"),
        met.alias("met"),
    )
    digest = lambda value: F.lower(F.hex(value))
    proof = F.array_join(F.transform("met", lambda m: digest(m["siblings"])), "")
    root = F.lit(tree.root).cast("string")
    return grouped.select(
        "doc_id",
        "leaf",
        F.coalesce(digest("subroot"), root).alias("subroot"),
        root.alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"),
        digest("folded").alias("folded_root"),
        (digest("folded") == root).alias("verified"),
    )
