"""Merkle manifest of a dataset, with inclusion proofs by checkpoint and recompute.

A row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its UTF-8 byte count, a colon
and its value. The leaves of each group, in the order of their key, form a tree in which every
sixteen consecutive nodes become the digest of their hex texts; the groups' roots, in the order of
the groups, form one more tree of the same kind, whose root stands for the dataset.

Only every third level is written: the leaves, then the tops of aligned subtrees of 4,096 leaves, of
4,096 such tops, and so on. A proof needs the levels between, and they are computed again from the
stored nodes below, one aligned subtree at a time, and thrown away after the siblings are taken from
them. So storage beyond the leaves is one node in 4,096, and a subtree that is lost with its
executor is computed anew by itself. A group of any size is cut into subtrees, so no task sees more
than one subtree at a time.

Order and odd input: null keys and null groups come first, and all rows with a null group are one
group; rows that share a key are ordered by their leaf, and rows alike in all are as many leaves. An
empty text is ``0:``. An empty table has no leaf, no root and an empty result. Other columns are
neither hashed nor carried unless asked for.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.llm.ordering import numbered
from parcelscope.settings import staged

# Fixed value: nodes that become one of the next level.
FAN = 16
# Levels from one stored level to the next; a subtree has FAN ** EVERY nodes at its foot.
EVERY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# The siblings of a node by level, from its own up, as the texts left and right of it. A run of one
# node has none, and its step is two empty texts; where a tree has one node left, it has no step.
PATH = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def field(value: Column) -> Column:
    """A value as it goes into a leaf."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def folded(node: Column, path: Column) -> Column:
    """The root that a node and its path lead to."""
    return F.aggregate(path, node, lambda below, step: F.sha2(F.concat(step["left"], below, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """One digest for all siblings of a path, from the node's level up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


@dataclass(frozen=True)
class Manifest:
    """``levels[k]``: the stored nodes (tree, pos, n, digest) of the group trees, ``k * EVERY`` levels
    above the leaves; the leaves also have the key, the group and what else was carried. ``tops``
    are the same of the tree of groups. ``root`` is null for an empty table."""

    levels: list[DataFrame]
    tops: list[DataFrame]
    root: str | None
    every: int


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "source",
    carry: dict[str, Column] | None = None, every: int = EVERY,
) -> Manifest:
    """Hash all rows and store the manifest's levels. ``carry`` are more columns of the leaves, made
    from ``docs``, which is read once."""
    given = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").alias("group"),
        leaf(*[F.col(f"`{c}`") for c in fields]).alias("digest"),
        # tells rows apart that are alike in all, so that even they are dealt over tasks
        F.monotonically_increasing_id().alias("tie"),
        *[made.alias(name) for name, made in (carry or {}).items()],
    )
    leaves = numbered(staged(given, "leaves"), ["group"], ["key", "digest", "tie"])
    groups = leaves.where("pos = 0").select("group")
    trees = staged(numbered(groups, [], ["group"], "tree", "trees"), "trees")
    same = leaves["group"].eqNullSafe(trees["group"])
    leaves = leaves.join(trees, same).select(trees["tree"], *[leaves[c] for c in leaves.columns if c != "tie"])
    levels = _stored_levels(staged(leaves, "level"), every)
    subroots = trees.join(levels[-1], "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("trees").alias("n"), "digest"
    )
    tops = _stored_levels(staged(subroots, "level"), every)
    last = tops[-1].first()
    return Manifest(levels, tops, last["digest"] if last else None, every)


def _stored_levels(foot: DataFrame, every: int) -> list[DataFrame]:
    """The foot and the stored levels above it, up to one node per tree."""
    levels = [foot]
    while (foot.agg(F.max("n")).first()[0] or 0) > 1:
        foot = staged(_tops(foot, every), "level")
        levels.append(foot)
    return levels


def _up(digests: list[str]) -> list[str]:
    return [
        hashlib.sha256("".join(digests[at : at + FAN]).encode()).hexdigest() for at in range(0, len(digests), FAN)
    ]


def _fewer(n: int) -> int:
    return -(-n // FAN)


def _in_order(nodes: pa.Table) -> pa.Table:
    return nodes.sort_by("pos")


def _tops(nodes: DataFrame, every: int) -> DataFrame:
    """The nodes ``every`` levels up; a tree that is down to one node keeps it."""
    wide = FAN**every

    def top(subtree: pa.Table) -> pa.Table:
        subtree = _in_order(subtree)
        digests, n = subtree["digest"].to_pylist(), subtree["n"][0].as_py()
        for _ in range(every):
            if n > 1:
                digests, n = _up(digests), _fewer(n)
        return pa.table(
            {"tree": subtree["tree"][:1], "pos": [subtree["pos"][0].as_py() // wide], "n": [n], "digest": digests}
        )

    block = F.floor(F.col("pos") / wide).alias("block")
    small = nodes.select("tree", "pos", "n", "digest")
    return small.groupBy("tree", block).applyInArrow(top, "tree long, pos long, n long, digest string")


def _paths(nodes: DataFrame, above: DataFrame, every: int) -> DataFrame:
    """``nodes`` of a stored level with their paths, from the paths ``above`` of the next stored level
    (tree, pos, subroot, path). A node stands in for its tree's subroot where it is the only one."""
    wide = FAN**every
    carried = [c for c in nodes.columns if c not in ("pos", "n")]
    schema = T.StructType(
        [*[nodes.schema[c] for c in carried], nodes.schema["pos"], above.schema["subroot"], T.StructField("path", PATH)]
    )

    def siblings(subtree: pa.Table, top: pa.Table) -> pa.Table:
        subtree = _in_order(subtree)
        level, n = subtree["digest"].to_pylist(), subtree["n"][0].as_py()
        paths: list[list[dict]] = [[] for _ in level]
        stands = 1  # nodes of the foot under one of the level
        for _ in range(every):
            if n == 1:
                break
            steps = []
            for at in range(0, len(level), FAN):
                run = level[at : at + FAN]
                steps += [{"left": "".join(run[:i]), "right": "".join(run[i + 1 :])} for i in range(len(run))]
            for i, path in enumerate(paths):
                path.append(steps[i // stands])
            level, n, stands = _up(level), _fewer(n), stands * FAN
        further = top["path"][0].as_py()
        made = pa.array([path + further for path in paths], schema_path)
        subroot = pa.repeat(top["subroot"][0], len(paths))
        return pa.table([*[subtree[c] for c in [*carried, "pos"]], subroot, made], names=schema.names)

    schema_path = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    below = nodes.withColumn("block", F.floor(F.col("pos") / wide))
    upper = above.select("tree", F.col("pos").alias("block"), "subroot", "path")
    pairs = below.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block"))
    return pairs.applyInArrow(siblings, schema)


def _all_paths(levels: list[DataFrame], roots: DataFrame, every: int) -> DataFrame:
    """Paths of the lowest level, from those of the trees' ``roots``."""
    above = roots
    for nodes in islice(reversed(levels), 1, len(levels) - 1):
        above = staged(_paths(nodes, above, every), "paths")
    if len(levels) > 1:
        return _paths(levels[0], above, every)
    return levels[0].drop("n").join(roots.drop("pos"), "tree")


def proofs(made: Manifest) -> DataFrame:
    """Every leaf with ``subroot`` and ``path``: its ``key``, ``group``, ``digest`` and what it carries."""
    top = made.tops[-1].select(
        "tree", "pos", F.col("digest").alias("subroot"), F.array().cast(PATH).alias("path")
    )
    roots = _all_paths(made.tops, top, made.every).select(
        F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "path"
    )
    return _all_paths(made.levels, staged(roots, "paths"), made.every)
