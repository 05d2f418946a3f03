"""Merkle dataset manifest: rows as leaves, a tree per group, a tree over the groups' roots, proofs and their check.

Every level is one equijoin of its nodes with their siblings' computed places;
the rows in slot zero then emit the parents. Texts are hashed where they are
read and never shuffled: a leaf is 32 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawldelta.llm.scratch import ship_code, stored

#: Nodes that one parent has at most.
ARITY = 2

#: Levels of paths that one job joins.
STRIDE = 4

#: Fixed value: the row's columns in the order in which a leaf holds them.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<before:binary,after:binary>>"


class Manifest(NamedTuple):
    """What a manifest holds; digests are binary.

    rows: tree, idx, h and the kept columns of every row
    levels: per level of the groups' trees (tree, idx, h, before, after): a node and the siblings on its sides
    top: the same of the tree over the groups' roots, tree 0, idx the group's tree
    groups: tree, name, subroot
    root: the one digest of the whole table, None without rows
    """

    rows: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    groups: DataFrame
    root: bytes | None


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def as_hex(value: Column) -> Column:
    """Digests in lower-case hex; nothing for null."""
    return F.coalesce(F.lower(F.hex(value)), F.lit(""))


def leaf_text(values: list[Column]) -> Column:
    """`-` for null, else the value's UTF-8 byte count, a colon and the value, one after another."""
    told = [F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")) for v in values]
    return F.concat(*[F.coalesce(t, F.lit("-")) for t in told])


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored rows with task, run and pos: the range-sorted rows' task, and in it the number of its group and the place within."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, run, pos, before = TaskContext.get().partitionId(), -1, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("name")
            codes = pc.dictionary_encode(names, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            first, last = names[0].as_py(), names[-1].as_py()
            # A group goes on from the batch before, or the batch's first row begins one.
            fresh = run < 0 or first != before
            begins = np.concatenate(([fresh], codes[1:] != codes[:-1]))
            runs = run + np.cumsum(begins)
            starts = np.maximum.accumulate(np.where(begins, np.arange(len(codes)), -pos))
            places = np.arange(len(codes)) - starts
            run, pos, before = int(runs[-1]), int(places[-1]) + 1, last
            told = [np.full(len(codes), task, np.int64), runs.astype(np.int64), places.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, told)], names=[*batch.schema.names, "task", "run", "pos"])

    ship_code(rows.sparkSession)
    keys = [F.col(c).asc_nulls_first() for c in order]
    kept = rows.columns
    # Equal rows are told apart by where they were read, so that many of them are no single task's work.
    marked = rows.withColumn("__read", F.monotonically_increasing_id())
    ranged = marked.repartitionByRange(*keys, "__read").sortWithinPartitions(*keys).select(*kept)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema) + ", task long, run long, pos long"
    return stored(ranged.mapInArrow(count, ddl), "placed")


def _task_bases(placed: DataFrame) -> DataFrame:
    """(task, first_tree, carried): the tree of the task's first group, and the rows it has in earlier tasks.

    One row per task enters the windows; a group may span any number of them.
    """
    spot = F.struct("run", "pos", "name")
    ends = placed.groupBy("task").agg(F.count("*").alias("n"), F.min(spot).alias("a"), F.max(spot).alias("z"))
    by_task = Window.orderBy("task")
    before = by_task.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("held", F.coalesce(F.sum("n").over(before), F.lit(0)))
    goes_on = F.lag(F.lit(True)).over(by_task).isNotNull() & F.lag("z.name").over(by_task).eqNullSafe(F.col("a.name"))
    ends = ends.withColumn("goes_on", goes_on)
    begun = F.col("z.run") + 1 - F.col("goes_on").cast("long")
    own_start = F.when((F.col("z.run") > 0) | ~F.col("goes_on"), F.col("held") + F.col("n") - F.col("z.pos") - 1)
    ends = ends.withColumns({"begun": begun, "mark": own_start})
    earlier = F.coalesce(F.sum("begun").over(before), F.lit(0)) - F.col("goes_on").cast("long")
    carried = F.when(F.col("goes_on"), F.col("held") - F.last("mark", ignorenulls=True).over(before)).otherwise(F.lit(0))
    return ends.select("task", earlier.alias("first_tree"), carried.alias("carried"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with tree (groups by `name`, null first, bytewise) and idx (from zero, in the given order within the group).

    Rows are counted within range-sorted tasks, so a group that holds most rows is
    spread over many; what tasks tell each other is one row each.
    """
    placed = _placed(rows, ["name", *order])
    bases = F.broadcast(_task_bases(placed))  # as many rows as tasks
    idx = F.col("pos") + F.when(F.col("run") == 0, F.col("carried")).otherwise(F.lit(0))
    joined = placed.join(bases, "task").withColumns({"tree": F.col("first_tree") + F.col("run"), "idx": idx})
    return joined.select("tree", "idx", *rows.columns)


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """nodes(tree, idx, h) with `before` and `after`: the digests of the run's other nodes on either side, joined; null if none."""
    if arity < 2:
        raise ValueError("a parent has two nodes at least")
    slot = F.col("idx") % arity
    met = nodes
    for shift in range(1, arity):
        # The sibling's place: the other one of a pair, else the slot that many steps further round.
        place = F.col("idx").bitwiseXOR(F.lit(1).cast("long")) if arity == 2 else F.col("idx") - slot + (slot + shift) % arity
        own = nodes.select("tree", F.col("idx").alias("__at"), F.col("h").alias(f"__s{shift}"))
        met = met.withColumn("__at", place).join(own, ["tree", "__at"], "left").drop("__at")
    shifted = F.array(*[F.col(f"__s{s}") for s in range(1, arity)])
    none = F.lit(b"")

    def side(slots: range, test) -> Column:
        found = [F.when(test(F.lit(j)), F.get(shifted, ((F.lit(j + arity) - slot) % arity - 1).cast("int"))) for j in slots]
        return F.nullif(F.concat(*[F.coalesce(x, none) for x in found]), none)

    return met.select(
        "tree", "idx", "h",
        side(range(arity - 1), lambda j: j < slot).alias("before"),
        side(range(1, arity), lambda j: j > slot).alias("after"),
    )


def _lone() -> Column:
    """The only node that its tree has at this level: its root."""
    return (F.col("idx") == 0) & F.col("after").isNull()


def climb(leaves: DataFrame, arity: int) -> list[DataFrame]:
    """All levels of the trees of leaves(tree, idx, h), each stored; a tree ends at the level where it has one node."""
    last = leaves.agg(F.max("idx")).first()[0] or 0
    levels, nodes = [], leaves
    while True:
        met = stored(with_siblings(nodes, arity), "level")
        levels.append(met)
        if not last:
            return levels
        first = met.where((F.col("idx") % arity == 0) & ~_lone())
        nodes = first.select("tree", F.expr(f"idx div {arity}").alias("idx"), digest(F.concat(as_hex(F.col("h")), as_hex(F.col("after")))).alias("h"))
        last //= arity


def roots_of(levels: list[DataFrame]) -> DataFrame:
    """(tree, h) of every tree's root."""
    found = levels[0].where(_lone())
    for level in levels[1:]:
        found = found.unionByName(level.where(_lone()))
    return found.select("tree", "h")


def build(docs: DataFrame, group: str, order: str, leaf: Column, keep: dict[str, Column] | None = None, arity: int = ARITY) -> Manifest:
    """The manifest of a table: a leaf per row, a tree per value of `group`, leaves ascending by `order`, a tree over the groups.

    Null is a group of its own and stands before the others, as null orders
    stand before others; rows of one order are sorted by their leaves, repeated
    rows have a leaf each. Extra columns are ignored but for `keep`, which names
    expressions over docs that stay beside each leaf. An empty table has no root.
    """
    kept = keep or {}
    rows = docs.select(
        docs[group].cast("string").alias("name"), docs[order].alias("__order"), leaf.alias("h"), *[c.alias(n) for n, c in kept.items()]
    )
    rows = numbered(rows, ["__order", "h"])
    levels = climb(rows.select("tree", "idx", "h"), arity)
    subroots = stored(roots_of(levels), "subroots")
    top = climb(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "h"), arity)
    named = rows.where("idx = 0").select("tree", "name")
    groups = subroots.withColumnRenamed("h", "subroot").join(named, "tree").select("tree", "name", "subroot")
    found = roots_of(top).first()
    return Manifest(rows.select("tree", "idx", "h", *kept), levels, top, groups, bytes(found["h"]) if found else None)


def _descend(levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """(tree, idx, path) of the lowest level's nodes: from each node on, its siblings level by level.

    above(tree, path) is the path that goes on from each tree's root.
    """
    step = F.array(F.struct("before", "after"))
    paths = None
    for n, level in reversed(list(enumerate(levels))):
        at_root = level.where(_lone()).join(above, "tree").select("tree", "idx", "path")
        if paths is None:
            paths = at_root
        else:
            up = paths.withColumnRenamed("idx", "__up")
            inner = level.where(~_lone()).withColumn("__up", F.expr(f"idx div {arity}")).join(up, ["tree", "__up"])
            paths = inner.select("tree", "idx", F.concat(step, "path").alias("path")).unionByName(at_root)
        # Plans stay short: some levels are joined at once; the lowest has one reader and need not be written.
        paths = stored(paths, "paths") if n and n % STRIDE == 0 else paths
    return paths


def proofs(manifest: Manifest, arity: int = ARITY) -> DataFrame:
    """rows of a manifest with `subroot` and `path`: its siblings level by level through subroot to root, left and right of it."""
    first = manifest.top[-1].where(_lone()).select("tree", F.array().cast(_PATH).alias("path"))
    over = _descend(manifest.top, first, arity).select(F.col("idx").alias("tree"), "path")
    paths = _descend(manifest.levels, over, arity)
    return manifest.rows.join(paths, ["tree", "idx"]).join(manifest.groups.select("tree", "subroot"), "tree")


def siblings_text(path: Column) -> Column:
    """All siblings of a path in hex, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(as_hex(s["before"]), as_hex(s["after"]))), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root in hex that a leaf's digest and a path lead to."""
    return F.aggregate(path, as_hex(leaf), lambda acc, s: F.sha2(F.concat(as_hex(s["before"]), acc, as_hex(s["after"])).cast("binary"), 256))


def manifest_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; digests in hex.

    A document is tampered with where 7 divides the CRC-32 of its doc_id as text:
    its n_chars grows by one, nulls stay. Its proof is that of the table as it is.
    Rows without doc_id are not tampered with; repeated rows have a leaf and a
    proof each; an empty table gives an empty one; extra columns are ignored.
    """
    column = {c: docs[c] for c in LEAF_COLUMNS}
    forged = column | {"n_chars": F.try_add(column["n_chars"], F.lit(1).cast("long"))}
    hit = F.crc32(column["doc_id"].cast("string")) % 7 == 0
    leaf = digest(leaf_text(list(column.values())))
    keep = {"doc_id": column["doc_id"], "forged": F.when(hit, digest(leaf_text(list(forged.values()))))}
    made = build(docs, "lang", "doc_id", leaf, keep)
    root = F.lit(made.root.hex() if made.root else None).cast("string")
    shown = proofs(made).select(
        "doc_id",
        as_hex(F.col("h")).alias("leaf"),
        as_hex(F.col("subroot")).alias("subroot"),
        root.alias("root"),
        F.sha2(siblings_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("forged", "h"), F.col("path")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))
