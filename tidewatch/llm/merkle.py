"""A Merkle manifest of a dataset: node rows linked to their parents, climbed by a recursive query.

Every row is a leaf. The leaves of a group form a tree: runs of ``FAN`` consecutive nodes become one
node each, until one is left; the tops of the groups' trees form one more tree. ``build`` stores one
row per inner node with its run's digests and the place of its parent. ``climb`` takes the leaves
up that table with ``WITH RECURSIVE``: a step joins a row's parent, folds the row's digest between
its siblings and appends the siblings to the proof. The leaves of one run have the same path from
their parent on, so they ascend in one row, which carries their folded digests and one proof.
"""

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import stored
from tidewatch.llm.numbering import numbered

FAN = 8
DIGEST_BYTES = 32
# The tree over the groups' trees; those are numbered from 0.
TOP = -1
# The engine stops a recursive query at this many rows by default; the climb has rows per leaf.
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


class Manifest(NamedTuple):
    """Stored tables: ``runs`` (``tree, size, run, leaves``, an array of ``place, key, leaf, claimed`` in
    order), ``nodes`` (``tree, level, place, digest, kids, up_tree, up_level, up_place, slot``: an
    inner node, the digests of its run one after the other, and where it stands in its parent's
    run), ``trees`` (``tree, group, size, subroot`` and the same links), and the ``root``, None for
    an empty dataset."""

    runs: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: str | None


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 in hex of all fields, each as byte count, colon and text; ``-`` for null."""
    parts = []
    for field in fields:
        text = field.cast("string")
        length = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(length, F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda all_, one: F.concat(all_, one))


def _hash(digests: Column) -> Column:
    """The digest of digests, which are hashed as hex text; both binary."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)).cast("binary"), 256))


def _levels(level_0: DataFrame, purpose: str) -> tuple[list[DataFrame], DataFrame]:
    """From rows ``tree, size, place, digest``: the stored inner nodes of each level, ``tree, size,
    level, place, digest, kids`` (``size`` nodes of that tree and level), and ``tree, digest`` of
    the node that is left of each tree."""
    levels, left = [], []
    rows = level_0
    largest = rows.agg(F.max("size")).first()[0] or 0
    while True:
        left.append(rows.where("size = 1").select("tree", "digest"))
        if largest <= 1:
            return levels, reduce(DataFrame.unionByName, left)
        kids = F.array_sort(F.collect_list(F.struct("place", "digest")))["digest"]
        above = (
            rows.where("size > 1")
            .groupBy("tree", "size", F.floor(F.col("place") / FAN).alias("place"))
            .agg(_joined(kids).alias("kids"))
            .select(
                "tree",
                F.ceil(F.col("size") / FAN).alias("size"),
                F.lit(len(levels) + 1).alias("level"),
                "place",
                _hash(F.col("kids")).alias("digest"),
                "kids",
            )
        )
        rows = stored(above, f"{purpose}-{len(levels) + 1}")
        levels.append(rows)
        largest = -(-largest // FAN)


def _linked(nodes: DataFrame, over: DataFrame) -> DataFrame:
    """Nodes (``tree, size, level, place``) with the place of their parent: in their own tree, or
    that of the tree in the tree over all trees, where it has one."""
    inner = F.col("size") > 1
    own = {
        "up_tree": F.col("tree"),
        "up_level": F.col("level") + 1,
        "up_place": F.floor(F.col("place") / FAN),
        "slot": (F.col("place") % FAN).cast("int"),
    }
    hung = over.select("tree", *(F.col(name).alias(f"over_{name}") for name in own))
    return nodes.join(hung, "tree", "left").select(
        *nodes.columns,
        *(F.when(inner, up).otherwise(F.col(f"over_{name}")).alias(name) for name, up in own.items()),
    )


def build(
    rows: DataFrame, key: str, group: str, leaf: Column, claimed: Column | None = None
) -> Manifest:
    """Store the trees over ``rows``, by ``group`` (text, null is a group of its own and the first)
    and ascending ``key`` (null first, repeated keys by their leaves). ``leaf`` and ``claimed`` are
    hex digests; ``claimed``, where it is not null, is what ``climb`` takes up instead of the leaf.

    Texts are read once; what is shuffled are digests. Leaves are numbered by ranges, not in one
    window, and every level combines runs of ``FAN``, so no group is handled as a whole.
    """
    known = rows.select(
        F.col(key).alias("key"),
        # Null sorts before any text; the mark keeps it apart from an empty one.
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("group"),
        F.unhex(leaf).alias("leaf"),
        F.unhex(F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"),
    )
    # Stored, as numbering reads its input twice.
    known = stored(known, "digests")
    order = [F.asc_nulls_first("key"), F.col("leaf"), F.asc_nulls_first("claimed")]
    leaves = numbered(known, "group", order, "place", "leaves")
    sizes = leaves.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.withColumn("all", F.lit("all"))
    groups = stored(numbered(sizes, "all", [F.col("group")], "tree", "groups").drop("all"), "groups")
    placed = leaves.join(groups, "group")

    run = placed.groupBy("tree", "size", F.floor(F.col("place") / FAN).alias("run"))
    members = F.array_sort(F.collect_list(F.struct("place", "key", "leaf", "claimed")))
    runs = stored(run.agg(members.alias("leaves")), "runs")
    digests = placed.select("tree", "size", "place", F.col("leaf").alias("digest"))
    levels, subroots = _levels(digests, "level")
    trees = stored(groups.join(subroots.withColumnRenamed("digest", "subroot"), "tree"), "subroots")
    count = trees.count()
    tops = trees.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(count).cast("long").alias("size"),
        F.col("tree").alias("place"), F.col("subroot").alias("digest"),
    )
    top_levels, last = _levels(tops, "top-level")
    root = last.first() if count else None

    nowhere = trees.select("tree").withColumns(
        {name: F.lit(None).cast(kind) for name, kind in _UP.items()}
    )
    place = tops.select("tree", "size", F.lit(0).alias("level"), "place")
    hung = _linked(place, nowhere).select(F.col("place").alias("tree"), *_UP)
    trees = stored(
        trees.withColumn("group", F.when(F.col("group") != "", F.substring("group", 2, _ALL)))
        .select("tree", "group", "size", "subroot")
        .join(hung, "tree"),
        "trees",
    )
    parts = [_linked(level, trees) for level in levels] + [
        _linked(level, nowhere) for level in top_levels
    ]
    none = rows.sparkSession.createDataFrame([], _NODE)
    nodes = reduce(DataFrame.unionByName, [none, *(part.drop("size") for part in parts)])
    return Manifest(runs, stored(nodes, "nodes"), trees, root and bytes(root["digest"]).hex())


_ALL = 1 << 30
_UP = {"up_tree": "long", "up_level": "int", "up_place": "long", "slot": "int"}
_NODE = "tree long, level int, place long, digest binary, kids binary, " + ", ".join(
    f"{name} {kind}" for name, kind in _UP.items()
)
_BEFORE = f"substring(n.kids, 1, c.slot * {DIGEST_BYTES})"
_AFTER = f"substring(n.kids, c.slot * {DIGEST_BYTES} + {DIGEST_BYTES + 1})"
_CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT tree, run, up_tree, up_level, up_place, slot, folded, above FROM {{start}}
  UNION ALL
  SELECT c.tree, c.run, n.up_tree, n.up_level, n.up_place, n.slot,
    transform(c.folded, digest ->
      unhex(sha2(lower(concat(hex({_BEFORE}), hex(digest), hex({_AFTER}))), 256))),
    concat(c.above, {_BEFORE}, {_AFTER})
  FROM climb c JOIN {{nodes}} n
    ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_place = n.place
)
SELECT tree, run, folded, above FROM climb WHERE up_tree IS NULL
"""


@contextmanager
def _unlimited(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(ROW_LIMIT, before)


def climb(manifest: Manifest) -> DataFrame:
    """``key, leaf, subroot, root, proof, folded_root, verified`` of every leaf: its siblings from
    the leaf's run up to the root's, left to right (binary, one digest after the other), what its
    claimed digest folds to between them, and whether that is the root. Digests are hex text. An
    empty dataset has no rows.

    The climb is stored before it is read: its row limit must not depend on a session's default.
    """
    spark = manifest.runs.sparkSession
    kept = F.transform("leaves", lambda one: one["leaf"])
    claims = F.transform("leaves", lambda one: F.coalesce(one["claimed"], one["leaf"]))

    def others(digests: Column, at: Column) -> tuple[Column, Column]:
        return _joined(F.slice(digests, 1, at)), _joined(F.slice(digests, at + 2, FAN))

    def first_fold(digest: Column, at: Column) -> Column:
        before, after = others(kept, at)
        return F.when(F.col("size") > 1, _hash(F.concat(before, digest, after))).otherwise(digest)

    runs = manifest.runs.select(
        "tree",
        "size",
        # A lone leaf is its tree's last node itself.
        F.when(F.col("size") > 1, 1).otherwise(0).alias("level"),
        F.col("run").alias("place"),
        F.transform(claims, first_fold).alias("folded"),
        F.lit(b"").alias("above"),
    ).withColumn("size", F.ceil(F.col("size") / FAN))
    start = _linked(runs, manifest.trees).withColumnRenamed("place", "run")
    with _unlimited(spark):
        climbed = stored(spark.sql(_CLIMB, start=start, nodes=manifest.nodes), "climbed")
    leaf = F.col("one.leaf")
    before, after = others(kept, F.col("at"))
    return (
        manifest.runs.join(climbed, ["tree", "run"])
        .join(manifest.trees.select("tree", "subroot"), "tree")
        .select("*", F.posexplode("leaves").alias("at", "one"))
        .select(
            F.col("one.key").alias("key"),
            F.lower(F.hex(leaf)).alias("leaf"),
            F.lower(F.hex("subroot")).alias("subroot"),
            F.lit(manifest.root).cast("string").alias("root"),
            F.concat(before, after, "above").alias("proof"),
            F.lower(F.hex(F.get("folded", F.col("at")))).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
