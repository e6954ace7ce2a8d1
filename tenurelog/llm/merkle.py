"""A Merkle tree over a dataset as a table of content-addressed nodes, and proofs by descent.

Each row is a leaf, the hash of its columns. The leaves of one group, in order,
form a tree whose nodes hash up to ``FAN`` consecutive children; the group roots,
in order of the group, form the tree above. Digests are hashed as lower-case hex.

The tree is kept as a table that says for each digest which digests are its
children. It is built, and read, in segments of ``HEIGHT`` levels: what one
task holds is one segment, at most ``FAN ** HEIGHT`` leaves with the nodes above
them, however large a group is. A row's segment is its rank divided by that
number, so a hot group has many.

A proof is found from the root down. A leaf's rank, written in base ``FAN``, says
which child to take at each node; the children that are not taken are its
siblings there. A request enters a segment at the segment's own root and leaves
it at the bottom, where the next segment begins. All leaves below a node share
the path down to it, so above the lowest segments only nodes are requested. The
path is collected from the root and then reversed, segment by segment.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from .workspace import Workspace, ship, small_batches

FAN = 3
HEIGHT = 6

NODE = "tree long, block long, levels int, level int, digest binary, children array<binary>"
SMALL = 10_000  # a table of so many groups is broadcast, a larger one joined by shuffle
STEP = "struct<before:string,after:string>"


def leaf_digest(*columns: Column) -> Column:
    """The hash of a row: each value as its UTF-8 byte count, ``:`` and itself; ``-`` for NULL."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold_proof(leaf: str | Column, proof: str | Column) -> Column:
    """The root that follows from a leaf (hex) and its siblings, level by level."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(proof, start, lambda at, s: F.sha2(F.concat(s["before"], at, s["after"]), 256))


def proof_text(proof: str | Column) -> Column:
    """All siblings of a proof, level by level, left to right, as one text of hex digests."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def levels_of(size: int, fan: int) -> int:
    """How often ``size`` nodes are grouped until one is left."""
    levels = 0
    while size > 1:
        size, levels = -(-size // fan), levels + 1
    return levels


# -- building --------------------------------------------------------------


def _grow(fan: int, height: int, below: int, table: pa.Table) -> pa.Table:
    """The nodes over one segment; its root is the row of the highest level, without children for a lone leaf."""
    tree, block, levels = (table.column(c)[0].as_py() for c in ("tree", "block", "levels"))
    order = pa.array(table.column("rank").to_numpy().argsort(kind="stable"))
    level = [d.hex() for d in table.column("digest").take(order).to_pylist()]
    found: list[tuple[int, str, list[str]]] = []
    top = min(height, levels - below)
    for step in range(top):
        groups = [level[at : at + fan] for at in range(0, len(level), fan)]
        level = [sha256("".join(g).encode()).hexdigest() for g in groups]
        found += [(step + 1, d, g) for d, g in zip(level, groups)]
    if top <= 0:
        found = [(0, level[0], [])]
    n = len(found)
    return pa.table(
        {
            "tree": pa.array([tree] * n, pa.int64()),
            "block": pa.array([block] * n, pa.int64()),
            "levels": pa.array([levels] * n, pa.int32()),
            "level": pa.array([s for s, _, _ in found], pa.int32()),
            "digest": pa.array([bytes.fromhex(d) for _, d, _ in found], pa.binary()),
            "children": pa.array([[bytes.fromhex(c) for c in g] for _, _, g in found], pa.list_(pa.binary())),
        }
    )


def _levels_column(size: Column, fan: int) -> Column:
    """:func:`levels_of` of a column."""
    out, k = F.when(size <= 1, 0), 1
    while fan**k < 1 << 62:
        out, k = out.when(size <= fan**k, k), k + 1
    return out.otherwise(k)


def _nodes(fan: int, height: int, below: int):
    def over(table: pa.Table) -> pa.Table:
        return _grow(fan, height, below, table)

    return over


def _paths(fan: int, height: int, below: int, own: Sequence[str]):
    def along(requests: pa.Table, records: pa.Table) -> pa.Table:
        return _descend(fan, height, below, own, requests, records)

    return along


class _Forest:
    """Trees over ``leaves(tree, rank, levels, digest, ...)``: written node tables, one per round of segments.

    ``levels`` is the number of levels above the leaves of a tree, ``most`` the largest of them.
    """

    def __init__(self, work: Workspace, leaves: DataFrame, most: int, fan: int, height: int):
        self.work, self.fan, self.height, self.wide = work, fan, height, fan**height
        self.nodes: list[DataFrame] = []
        self.requests = [self._blocked(leaves)]
        ended = []
        for turn in range(max(1, -(-most // height))):
            level = self.requests[turn].select("tree", "block", "rank", "levels", "digest")
            grown = level.groupBy("tree", "block").applyInArrow(_nodes(fan, height, turn * height), NODE)
            table = work.write(grown, "nodes")
            self.nodes.append(table)
            left = F.col("levels") - turn * height
            tops = table.where(F.col("level") == F.least(left, F.lit(height)))
            ended.append(tops.where(left <= height).select("tree", "levels", "digest"))
            upper = tops.where(left > height).select("tree", F.col("block").alias("rank"), "levels", "digest")
            self.requests.append(self._blocked(upper))
        self.roots = reduce(DataFrame.unionByName, ended)

    def _blocked(self, level: DataFrame) -> DataFrame:
        return level.withColumn("block", F.expr(f"rank div {self.wide}"))

    def proofs(self, entries: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, list[DataFrame]]:
        """``path`` of each leaf, all its siblings up to where ``entries`` came from, and the written tables it reads.

        ``entries(tree, levels, digest, subroot, path)`` has the root of each tree
        and what to append to all paths in it; ``keep`` are columns of the leaves.
        """
        reads, came = [entries], None
        for turn in range(len(self.nodes) - 1, -1, -1):
            left = F.col("levels") - turn * self.height
            begins = (left <= self.height) if turn == 0 else (left > 0) & (left <= self.height)
            enter = entries.where(begins).withColumn("block", F.lit(0).cast("long"))
            if came is not None:
                enter = enter.unionByName(came.withColumnRenamed("rank", "block"))
            record = self.nodes[turn].select("tree", "block", "levels", "digest", "children")
            records = enter.withColumn("enters", F.lit(True)).unionByName(record.withColumn("enters", F.lit(False)), allowMissingColumns=True)
            requests, own = self.requests[turn], keep if turn == 0 else ["tree", "rank", "levels"]
            schema = [f"{c} {requests.schema[c].dataType.simpleString()}" for c in own]
            schema += ["digest binary", "subroot binary", f"path array<{STEP}>"]
            found = requests.groupBy("tree", "block").cogroup(records.groupBy("tree", "block")).applyInArrow(
                _paths(self.fan, self.height, turn * self.height, own), ", ".join(schema)
            )
            reads.append(self.nodes[turn])
            if turn:
                came = self.work.write(found, "paths")
                reads.append(came)
        return found, reads


# -- descent ---------------------------------------------------------------


def _descend(fan: int, height: int, below: int, own: Sequence[str], requests: pa.Table, records: pa.Table) -> pa.Table:
    """Follow each request of a segment from the segment's root down by the digits of its rank.

    A step goes from a digest to one of the children recorded for it and collects
    the others; the path is reversed at the bottom, and what the segment above
    collected follows it.
    """
    children: dict[bytes, list[bytes]] = {}
    start, depth, subroot, upper = None, 0, None, []
    for digest, kids, enters, levels, root, path in zip(
        *(records.column(c).to_pylist() for c in ("digest", "children", "enters", "levels", "subroot", "path"))
    ):
        if enters:
            start, depth, subroot, upper = digest, min(height, levels - below), root, path
        elif kids:
            children[digest] = kids
    # The leaves below a node share its steps: one object each, however many leaves there are.
    steps = {
        (digest, digit): {"before": b"".join(kids[:digit]).hex(), "after": b"".join(kids[digit + 1 :]).hex()}
        for digest, kids in children.items()
        for digit in range(len(kids))
    }
    reached, paths = [], []
    for rank in requests.column("rank").to_pylist():
        at, down = start, []
        for step in range(depth - 1, -1, -1):
            kids, digit = children[at], rank // fan**step % fan
            down.append(steps[at, digit])
            at = kids[digit]
        reached.append(at)
        paths.append(down[::-1] + upper)
    step_type = pa.struct([("before", pa.string()), ("after", pa.string())])
    more = {
        "digest": pa.array(reached, pa.binary()),
        "subroot": pa.array([subroot] * len(reached), pa.binary()),
        "path": pa.array(paths, pa.list_(step_type)),
    }
    return pa.table({**{n: requests.column(n) for n in own}, **more})


def merkle_proofs(
    rows: DataFrame,
    columns: Sequence[str],
    group: str,
    order: str,
    keep: Sequence[str] = (),
    fan: int = FAN,
    height: int = HEIGHT,
) -> DataFrame:
    """One row per row: the columns of ``keep``, ``leaf``, ``subroot``, ``root`` (hex) and ``proof``.

    ``columns`` are hashed to the leaf, see :func:`leaf_digest`. Leaves of one
    ``group`` are taken in order of ``order``, NULL first, and groups in their
    own order, NULL first, texts by their UTF-8 bytes. ``proof`` is an array of
    ``(before, after)``: the siblings on both sides, from the leaf's level to the
    root, as hex digests put together; :func:`fold_proof` gives the root again.

    Rows that are equal in group and order are taken in order of their leaves;
    equal leaves are interchangeable. A single leaf is its group's root, a single
    group's root is the root. NULLs and empty texts are hashed as such. Columns
    not named are ignored, whatever their names; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    ship(spark)
    small_batches(spark)
    work = Workspace(spark, "merkle")
    kept = [f"_keep{i}" for i in range(len(keep))]
    slim = rows.select(
        F.col(f"`{group}`").alias("_group"),
        F.col(f"`{order}`").alias("_order"),
        F.unhex(leaf_digest(*[F.col(f"`{c}`") for c in columns])).alias("digest"),
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept)],
    )
    slim = work.write(slim, "leaves")  # the texts are read once
    by = [F.col("_group").asc_nulls_first(), F.col("_order").asc_nulls_first(), F.col("digest").asc()]
    numbered = number_rows(slim, by, "_row")
    groups = numbered.groupBy("_group").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    groups = groups.withColumn("levels", _levels_column(F.col("_n"), fan))
    groups = work.write(number_rows(groups, [F.col("_group").asc_nulls_first()], "_tree"), "groups")
    counted = groups.agg(F.count(F.lit(1)).alias("n"), F.max("levels").alias("most")).first()
    if not counted["n"]:
        none = {"subroot": F.lit(None).cast("binary"), "path": F.lit(None).cast(f"array<{STEP}>")}
        return _outer(slim.withColumns(none), keep, "")

    small = groups.select(F.col("_group").alias("_g"), "_first", "levels", (F.col("_tree") - 1).alias("tree"))
    joined = numbered.join(F.broadcast(small) if counted["n"] <= SMALL else small, F.col("_group").eqNullSafe(F.col("_g")))
    leaves = work.write(joined.select("tree", (F.col("_row") - F.col("_first")).alias("rank"), "levels", "digest", *kept), "ranked")

    below = _Forest(work, leaves, counted["most"], fan, height)
    high = levels_of(counted["n"], fan)
    heads = below.roots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("rank"),
        F.lit(high).alias("levels"),
        "digest",
        F.col("tree").alias("own"),
        F.col("levels").alias("own_levels"),
    )
    above = _Forest(work, heads, high, fan, height)
    root = bytes(above.roots.first()["digest"])  # one digest
    nothing = F.array().cast(f"array<{STEP}>")
    top = above.roots.select("tree", "levels", "digest", F.lit(None).cast("binary").alias("subroot"), nothing.alias("path"))
    # Where the descent to a group's root ends, the group's own tree begins.
    to_heads, _ = above.proofs(top, ["own", "own_levels"])
    entries = to_heads.select(
        F.col("own").alias("tree"), F.col("own_levels").alias("levels"), "digest", F.col("digest").alias("subroot"), "path"
    )
    found, reads = below.proofs(work.write(entries, "entries"), kept)
    work.keep_only(leaves, *reads)
    return _outer(found, keep, root.hex())


def _outer(found: DataFrame, keep: Sequence[str], root: str) -> DataFrame:
    return found.select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
        F.lower(F.hex("digest")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        F.lit(root).alias("root"),
        F.col("path").alias("proof"),
    )
