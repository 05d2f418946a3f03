"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawldelta.llm.scratch import matching, stored, without

#: Bytes of a block. Any value gives the same groups.
BLOCK_BYTES = 4096


def _blocks(text: Column, size: int) -> Column:
    """The text's UTF-8 bytes in blocks of a fixed size; an empty text is one empty block."""
    raw = F.array(F.coalesce(text, F.lit("")).cast("binary"))

    def cut(b: Column) -> Column:
        last = F.greatest(F.ceil(F.octet_length(b) / F.lit(size)) - 1, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(b, i * size + 1, F.lit(size)))

    # Bound to a lambda's variable, the bytes are made once and not for every block.
    return F.transform(raw, cut)[0]


def _named(distinct: DataFrame, by: list[str]) -> DataFrame:
    """Sorted rows with integer names: no two rows share one. Stored, so that a name is given once."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def block_identities(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, block_hash: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """One stored row per document: row_id, doc_id, text_sha256, level, name.

    Two texts are equal if and only if they agree in (level, name). The blocks'
    bytes are shuffled once, each block at most once per task; block_hash only
    leads from a document's block to its name, and blocks that share a hash are
    told apart by their bytes.
    """
    cut = docs.select("doc_id", "text", _blocks(F.col("text"), block_bytes).alias("blocks"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    base = stored(
        cut.select(
            F.monotonically_increasing_id().alias("row_id"),
            "doc_id",
            digest.alias("text_sha256"),
            F.transform("blocks", lambda b: block_hash(b)).alias("hashes"),
        ),
        "base",
    )
    piece = cut.select(F.explode("blocks").alias("block")).select(block_hash(F.col("block")).alias("h"), "block")
    names = stored(_named(piece.distinct(), ["h", "block"]).select("h", "name"), "names")
    rows = base.select("row_id", F.size("hashes").alias("n"), F.posexplode("hashes").alias("idx", "h"))
    shared = names.groupBy("h").agg(F.count("*").alias("owners")).where("owners > 1").select("h")
    if shared.isEmpty():
        now = rows.join(names, "h").select("row_id", "n", "idx", "name")
    else:
        base, now = _named_by_bytes(docs, block_bytes)
    level, done = 0, None
    now = stored(now, "level0")
    longest = now.agg(F.max("n")).first()[0] or 1
    while True:
        ended = now.where("n = 1").select("row_id", F.lit(level).alias("level"), "name")
        done = ended if done is None else done.unionByName(ended)
        if 1 << level >= longest:
            break
        level += 1
        now = _next_level(now.where("n > 1"), level)
    told = base.select("row_id", "doc_id", "text_sha256").join(done, "row_id")
    return stored(told, "identities")


def _next_level(now: DataFrame, level: int) -> DataFrame:
    """Name adjacent pairs; a last single name is paired with -1."""
    even = F.col("idx") % 2 == 0
    pairs = stored(
        now.groupBy("row_id", "n", F.shiftright("idx", 1).alias("idx")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
        ),
        f"pairs{level}",
    )
    names = stored(_named(pairs.select("a", "b").distinct(), ["a", "b"]), f"names{level}")
    halved = F.ceil(F.col("n") / 2).cast("int").alias("n")
    return stored(pairs.join(names, ["a", "b"]).select("row_id", halved, "idx", "name"), f"level{level}")


def _named_by_bytes(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The documents and their level-0 names where some blocks share a hash: joined on the bytes themselves."""
    full = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row_id"),
            "doc_id",
            F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
            _blocks(F.col("text"), block_bytes).alias("blocks"),
        ),
        "bytes",
    )
    rows = full.select("row_id", F.size("blocks").alias("n"), F.posexplode("blocks").alias("idx", "block"))
    names = stored(_named(rows.select("block").distinct(), ["block"]), "names")
    return full.drop("blocks"), rows.join(names, "block").select("row_id", "n", "idx", "name")


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES, block_hash: Callable = F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row_id.

    Texts are equal when identical; null counts as empty. Of equal texts the row
    with the largest doc_id stays; among rows with that same doc_id exactly one
    does; a null doc_id stays only where the group has no other. Extra columns
    are ignored; an empty table gives an empty one.
    """
    told = block_identities(docs, block_bytes, block_hash)
    groups = told.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "row_id")).alias("top"), F.count("*").alias("group_size")
    )
    groups = stored(groups, "groups")
    kept = F.col("row_id") == F.col("top.row_id")
    return told.join(groups, ["level", "name"]).select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "row_id"
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents without exact copies, columns unchanged; identical rows (same doc_id too) fold into one."""
    judged = stored(exact_groups(docs).where("group_size > 1"), "judged")
    of_kept_id = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    losers = stored(judged.where(~of_kept_id).select("doc_id", "text_sha256"), "losers")
    repeated = stored(judged.where(of_kept_id & ~F.col("kept")).select("doc_id", "text_sha256").distinct(), "repeated")

    def keys(df: DataFrame) -> dict[str, Column]:
        return {"doc_id": df["doc_id"], "text_sha256": F.sha2(F.coalesce(df["text"], F.lit("")).cast("binary"), 256)}

    left = without(docs, losers, keys(docs))
    if repeated.isEmpty():
        return left
    # Rows that agree in doc_id and text: one of them stays.
    single = matching(left, repeated, keys(left), "left_semi").dropDuplicates(["doc_id", "text"])
    return without(left, repeated, keys(left)).unionByName(single)
