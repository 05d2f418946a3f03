"""The manifest against plain trees, of any arity, over awkward rows."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from crawldelta.llm import merkle
from tests.llm.conftest import ROWS


def plain_hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, extra=0):
    doc_id, text, lang, source, n = row
    told = [doc_id, source, lang, None if n is None else n + extra, text]
    raw = b"".join(b"-" if v is None else b"%d:%b" % (len(str(v).encode()), str(v).encode()) for v in told)
    return hashlib.sha256(raw).hexdigest()


def plain_tree(leaves, arity):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([plain_hash(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def plain_path(levels, at, arity):
    path = []
    for level in levels[:-1]:
        low = at // arity * arity
        run = level[low : low + arity]
        path.append(("".join(run[: at - low]), "".join(run[at - low + 1 :])))
        at //= arity
    return path


def plain_manifest(rows, arity=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    held = [sorted(groups[g], key=lambda x: x[:3]) for g in names]
    trees = [plain_tree([x[2] for x in own], arity) for own in held]
    top = plain_tree([t[-1][0] for t in trees], arity)
    root, out = top[-1][0], []
    for g, tree in enumerate(trees):
        for i, (_, _, leaf, row) in enumerate(held[g]):
            path = plain_path(tree, i, arity) + plain_path(top, g, arity)
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            acc = plain_leaf(row, 1) if bad else leaf
            for before, after in path:
                acc = plain_hash(before, acc, after)
            out.append((row[0], leaf, tree[-1][0], root, plain_hash(*[a + b for a, b in path]), acc, acc == root))
    return sorted(out, key=repr)


DDL = "doc_id long, text string, lang string, source string, n_chars long"


def with_sizes(rows):
    return [(*r, None if r[1] is None or i % 5 == 4 else len(r[1])) for i, r in enumerate(rows)]


def table(spark, rows):
    frame = spark.createDataFrame(rows, DDL).repartition(3)
    return frame.select("*", *[F.lit("x").alias(c) for c in "name tree idx h task run pos path before after root".split()])


MORE = [(i // 3, f"text {i % 11}", "en" if i % 3 else f"l{i % 40}", None) for i in range(300)]


@pytest.mark.parametrize("rows", [ROWS, ROWS + MORE + [(None, "x", None, "s")] * 3, ROWS[:1], ROWS[3:4] * 5, MORE[:2], [(70, "a", "zh", "s")] * 40])
def test_manifest_matches_plain_trees(spark, rows):
    rows = with_sizes(rows)
    got = sorted(map(tuple, merkle.manifest_report(table(spark, rows)).collect()), key=repr)
    assert got == plain_manifest(rows)


def test_the_tampered_rows_fail_and_the_others_hold(spark):
    rows = with_sizes([(i, f"t{i}", "en" if i % 2 else "de", "s") for i in range(120)])
    got = {r.doc_id: r.verified for r in merkle.manifest_report(table(spark, rows)).collect()}
    assert got == {r[0]: r[4] is None or zlib.crc32(str(r[0]).encode()) % 7 != 0 for r in rows}


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_any_arity(spark, arity):
    rows = with_sizes(ROWS + MORE[:100])
    docs = table(spark, rows)
    leaf = merkle.digest(merkle.leaf_text([docs[c] for c in merkle.LEAF_COLUMNS]))
    made = merkle.build(docs, "lang", "doc_id", leaf, {"doc_id": docs["doc_id"]}, arity)
    shown = merkle.proofs(made, arity).select(
        "doc_id", merkle.as_hex(F.col("h")).alias("leaf"), F.sha2(merkle.siblings_text(F.col("path")).cast("binary"), 256).alias("p"),
        merkle.folded(F.col("h"), F.col("path")).alias("root"),
    )
    want = [(d, leaf, p, root) for d, leaf, _, root, p, _, _ in plain_manifest(rows, arity)]
    assert sorted(map(tuple, shown.collect()), key=repr) == sorted(want, key=repr)
    assert made.root.hex() == want[0][3]


def test_groups_spread_over_many_tasks(spark, monkeypatch):
    rows = with_sizes([(i, f"t{i % 7}", "en" if i % 10 else f"l{i % 30}", "s") for i in range(2000)] + [(5, "t5", "en", "s")] * 700)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = table(spark, rows)
        leaf = merkle.digest(merkle.leaf_text([docs[c] for c in merkle.LEAF_COLUMNS]))
        own = merkle._placed(docs.select(F.col("lang").alias("name"), "doc_id", leaf.alias("h")), ["name", "doc_id", "h"])
        shares = [r["count"] for r in own.groupBy("task").count().collect()]
        assert max(shares) < 1000 and len(shares) > 4
        got = sorted(map(tuple, merkle.manifest_report(docs).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == plain_manifest(rows)


def test_no_rows_no_root(spark):
    assert merkle.manifest_report(spark.createDataFrame([], DDL)).count() == 0
    nothing = merkle.build(spark.createDataFrame([], DDL), "lang", "doc_id", F.lit(b"x"))
    assert nothing.root is None


def test_one_node_has_no_parent():
    with pytest.raises(ValueError):
        merkle.with_siblings(None, 1)
