"""A Merkle manifest of a dataset: one digest that vouches for every row, and a proof per row.

The leaves of a group stand in order; while more than one node remains, every ARITY
consecutive ones become the hash of their digests as hex text. The roots of the groups, in
order, become the root the same way.

The place of a leaf, written in base ARITY, says where it belongs. Leaves are cut into blocks
of ARITY ** DIGITS places. Inside a block the digits are grouped away one by one, from the last
to the first: each grouping hashes the nodes of a run and keeps them, with all that is below,
as nested structs of their parent. A block is one row of bounded size; the roots of the blocks
are the leaves of the next tier, and so on until each group has one block. Proofs go the way
back: the path down to a block meets the block's row in one grouping by block, and then
transform and explode open one level of the nested structs after the other, adding the
siblings. No join takes part in that.

Defined cases: a null value is `-` in the leaf, an empty one `0:`. A null group is a group,
ordered first. Null ids come first; equal ids are ordered by their leaf, and rows equal in all
fields have equal leaves, so either order gives the same tree. A group of one row has its leaf
as root, one group its root as the root of all, and an empty table has no rows and no root.
Very long texts are hashed where they are read and travel no further. Columns of `docs` that are not
named are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .order import running

ARITY = 8
#: Digits of a place inside one block: a row holds at most ARITY ** DIGITS leaves.
DIGITS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, fields)), 256)


def hash_of(digests: Column) -> Column:
    """The parent of the nodes with these digests, as hex text."""
    return F.sha2(F.array_join(digests, ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof (runs of siblings to the left and right) lead to."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def siblings(proof: Column) -> Column:
    """All siblings of a proof as one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _blocks(leaves: DataFrame, group: list[str], payload: list[str]) -> DataFrame:
    """(group, block, all, hash, tree) from leaves (group, _at, _all, hash, payload).

    `_all` counts the leaves of the group: a level that has one node already is not hashed again.
    """
    digit = lambda level: F.expr(f"_at div {ARITY**level} % {ARITY}")
    names = [f"_d{level}" for level in range(DIGITS)]
    nodes = leaves.select(
        *group,
        F.expr(f"_at div {ARITY**DIGITS}").alias("_block"),
        "_all",
        *[digit(level).alias(n) for level, n in enumerate(names)],
        "hash",
        *payload,
    ).repartition(*group, "_block")
    for level, name in enumerate(names):
        kept = [*group, "_block", "_all", *names[level + 1 :]]
        below = payload if level == 0 else ["nodes"]
        runs = nodes.groupBy(*kept).agg(F.sort_array(F.collect_list(F.struct(name, "hash", *below))).alias("nodes"))
        alone = F.col("_all") <= ARITY**level
        digest = F.when(alone, F.col("nodes")[0]["hash"]).otherwise(hash_of(F.col("nodes.hash")))
        nodes = runs.withColumn("hash", digest)
    return nodes.select(*group, "_block", "_all", "hash", "nodes")


def _opened(blocks: DataFrame, group: list[str], above: list[str], payload: list[str]) -> DataFrame:
    """One row per leaf of the blocks: group, `_block`, its digit columns, hash, payload, the columns `above`
    and `path`, the siblings from the leaf up to the top of the path that the block had."""
    rows = blocks.withColumn("_place", F.col("_block"))
    for level in reversed(range(DIGITS)):
        hashes = F.col("nodes.hash")
        run = F.transform(
            "nodes",
            lambda node, i: F.struct(
                node.alias("node"),
                i.alias("i"),
                F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"),
                F.array_join(F.slice(hashes, i + 2, F.lit(ARITY)), "").alias("right"),
            ),
        )
        rows = rows.select(*group, "_all", "_place", *above, "path", F.explode(run).alias("run"))
        step = F.array(F.struct(F.col("run.left").alias("left"), F.col("run.right").alias("right")))
        path = F.when(F.col("_all") > ARITY**level, F.concat(step, F.col("path"))).otherwise(F.col("path"))
        below = [F.col("run.node.nodes").alias("nodes")] if level else [F.col(f"run.node.{c}").alias(c) for c in ("hash", *payload)]
        rows = rows.select(
            *group, "_all", (F.col("_place") * ARITY + F.col("run.i")).alias("_place"), *above, path.alias("path"), *below
        )
    return rows


def _tree(leaves: DataFrame, group: list[str], payload: list[str], most: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored tiers of blocks from the bottom up, and the roots (group, hash).

    `most` is the number of leaves of the largest group.
    """
    tiers = []
    while True:
        blocks = stored(_blocks(leaves, group, payload if not tiers else []), "blocks")
        tiers.append(blocks)
        if most <= ARITY**DIGITS:
            return tiers, blocks.select(*group, "hash")
        size = ARITY**DIGITS
        leaves = blocks.select(*group, F.col("_block").alias("_at"), F.expr(f"(_all + {size - 1}) div {size}").alias("_all"), "hash")
        most = -(-most // size)


def _met(blocks: DataFrame, paths: DataFrame, group: list[str], above: list[str]) -> DataFrame:
    """Blocks with the path and the columns `above` of their (group, _block), by one grouping."""
    columns = ["_all", "nodes", *above, "path"]
    have = {**{c: t for c, t in blocks.dtypes}, **{c: t for c, t in paths.dtypes}}
    sides = [
        side.select(*group, "_block", *[F.col(c) if c in side.columns else F.lit(None).cast(have[c]).alias(c) for c in columns])
        for side in (blocks.drop("hash"), paths)
    ]
    first = [F.first(c, ignorenulls=True).alias(c) for c in columns]
    return sides[0].unionByName(sides[1]).groupBy(*group, "_block").agg(*first)


def _proved(tiers: list[DataFrame], paths: DataFrame, group: list[str], above: list[str], payload: list[str]) -> DataFrame:
    """One row per leaf with its whole path, from the paths (group, path, above) of the groups."""
    rows = paths.withColumn("_block", F.lit(0).cast("long"))
    for n, blocks in reversed(list(enumerate(tiers))):
        opened = _opened(_met(blocks, rows, group, above), group, above, payload if n == 0 else [])
        if n == 0:
            return opened
        rows = opened.select(*group, F.col("_place").alias("_block"), *above, "path")
    return rows


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    group: str = "lang",
    id_column: str = "doc_id",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: id, group, leaf, subroot, root, proof, and the columns of `carry`.

    `proof` lists, from the leaf upwards, the digests to the left and to the right in each run;
    `folded(leaf, proof)` leads to `root`. `carry` names columns to compute from a row of `docs`
    (such as the leaf of another copy of it) that come out beside its proof.
    """
    carried = list(carry or {})
    leaves = docs.select(
        F.col(id_column).alias("id"),
        F.col(group).alias("group"),
        leaf_hash(*map(F.col, fields)).alias("hash"),
        *[c.alias(f"_c{i}") for i, c in enumerate((carry or {}).values())],
    )
    payload = ["id", *[f"_c{i}" for i in range(len(carried))]]
    leaves = stored(leaves, "leaves")
    most = leaves.groupBy("group").count().agg(F.max("count")).first()[0] or 0
    placed = running(leaves, ["group"], [F.asc_nulls_first("id"), F.col("hash")])
    tiers, roots = _tree(placed, ["group"], payload, most)

    # The roots of the groups are the leaves of one more tree.
    roots = stored(roots, "roots")
    ordered = running(roots, [], [F.asc_nulls_first("group")])
    tops, top = _tree(ordered, [], ["group"], roots.count())
    none = F.array().cast("array<struct<left:string,right:string>>")
    start = top.select(F.col("hash").alias("root"), none.alias("path"))
    paths = _proved(tops, start, [], ["root"], ["group"]).select("group", "root", F.col("hash").alias("subroot"), "path")

    proved = _proved(tiers, paths, ["group"], ["root", "subroot"], payload)
    return proved.select(
        "id", "group", F.col("hash").alias("leaf"), "subroot", "root", F.col("path").alias("proof"),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carried)],
    )
