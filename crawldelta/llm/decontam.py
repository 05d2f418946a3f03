"""Benchmark decontamination: size-partitioned MinHash containment search, in SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawldelta.llm.scratch import keys_for_join, stored, without

#: Words of a shingle, and the least share of a test item's shingles that a document must hold.
WORDS = 5
CONTAINMENT = 0.8

#: Items of at most this many bytes in all are broadcast for the verification.
BROADCAST_BYTES = 4 << 20


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null counts as empty."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(low, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def text_key(text: str | Column) -> Column:
    """Hash that tells texts with one doc_id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _windows(tokens: Column, size: int) -> Column:
    """First positions of the shingles: of a text of fewer words, the whole sequence is one; of none, there is none."""
    n = F.size(tokens)
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value bound to a lambda's variable: within another lambda it would be computed for every element."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(tokens: Column, size: int = WORDS) -> Column:
    """64-bit hash of every shingle in order, repeats included, without building the strings."""
    one = lambda t: lambda i: F.xxhash64(*[F.get(t, i + k) for k in range(size)])
    return _once(tokens, lambda t: F.transform(_windows(t, size), one(t)))


def shingle_texts(tokens: Column, size: int = WORDS) -> Column:
    """Every shingle in order as text, for the exact comparison."""
    one = lambda t: lambda i: F.array_join(F.slice(t, i + 1, F.lit(size)), " ")
    return _once(tokens, lambda t: F.transform(_windows(t, size), one(t)))


def item_sketches(items: DataFrame, size: int = WORDS, threshold: float = CONTAINMENT) -> DataFrame:
    """Stored MinHash sketches (item_key, size_class, h) of items(item_id, text).

    An item of n distinct shingles keeps its floor((1 - t) n) + 1 smallest
    hashes. A document that holds a share t of the shingles misses at most
    floor((1 - t) n), so it meets the sketch at least once: no link is lost.
    size_class is floor(log2 n): items of like size have like largest hashes.
    """
    each = F.array_distinct(shingle_hashes(words(F.col("text")), size))
    some = items.select("item_key", F.array_sort(each).alias("hs")).where("size(hs) > 0")
    miss = F.floor((1 - threshold) * F.size("hs") + F.lit(1e-9)).cast("int")
    kept = some.select(
        "item_key",
        F.floor(F.log2(F.size("hs"))).cast("int").alias("size_class"),
        F.explode(F.slice("hs", F.lit(1), miss + 1)).alias("h"),
    )
    return stored(kept, "sketches")


def contained_items(
    docs: DataFrame, items: DataFrame, size: int = WORDS, threshold: float = CONTAINMENT
) -> DataFrame:
    """(doc_id, item_id, containment) for every document that holds the share `threshold` of an item's distinct shingles.

    Documents meet the sketches of one size class with their hashes up to that
    class's largest one only; what meets is verified on the shingles' texts.
    Items of fewer words than a shingle are one shingle and match only a
    document of just these words; empty items match nothing; equal items match
    alike; rows with a null id take part. One row for each pair of a document
    row and an item row; empty tables give none; extra columns are ignored.
    """
    return _contained(docs, items, size, threshold).drop("text_key")


def _contained(docs: DataFrame, items: DataFrame, size: int = WORDS, threshold: float = CONTAINMENT) -> DataFrame:
    """contained_items() with the text_key that tells rows with one doc_id apart."""
    keyed = stored(
        items.select(F.monotonically_increasing_id().alias("item_key"), "item_id", F.coalesce("text", F.lit("")).alias("text")),
        "items",
    )
    sketches = item_sketches(keyed, size, threshold)
    # One bound for each size class, log2 of the longest item at most.
    bounds = {r[0]: r[1] for r in sketches.groupBy("size_class").agg(F.max("h")).collect()}
    if not bounds:
        no_item = F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id")
        return docs.select("doc_id", text_key("text").alias("text_key"), no_item, F.lit(0.0).alias("containment")).where(F.lit(False))
    texts = docs.select("doc_id", text_key("text").alias("text_key"), "text")
    hashed = texts.select("doc_id", "text_key", F.array_distinct(shingle_hashes(words(F.col("text")), size)).alias("hs"))
    classes = F.array(*[F.struct(F.lit(c).alias("size_class"), F.lit(top).alias("top")) for c, top in sorted(bounds.items())])
    highest = max(bounds.values())
    low = F.filter("hs", lambda h: h <= F.lit(highest))
    sent = hashed.select("doc_id", "text_key", F.explode(low).alias("h"))
    met = sent.join(keys_for_join(sketches), "h").select("doc_id", "text_key", "item_key", "size_class", "h")
    reach = F.filter(classes, lambda c: c["size_class"] == F.col("size_class"))[0]["top"]
    pairs = stored(met.where(F.col("h") <= reach).select("doc_id", "text_key", "item_key").distinct(), "pairs")
    asked = pairs.withColumnsRenamed({"doc_id": "__d", "text_key": "__k"})
    same = texts["doc_id"].eqNullSafe(F.col("__d")) & (texts["text_key"] == F.col("__k"))
    suspects = texts.join(keys_for_join(asked), same).select("doc_id", "text_key", "text", "item_key")
    wanted = keyed.select("item_key", "item_id", F.array_distinct(shingle_texts(words(F.col("text")), size)).alias("item_shingles"))
    held = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    both = suspects.join(F.broadcast(wanted) if held <= BROADCAST_BYTES else wanted, "item_key")
    both = both.withColumn("doc_shingles", shingle_texts(words(F.col("text")), size))
    share = F.size(F.array_intersect("item_shingles", "doc_shingles")) / F.size("item_shingles")
    return both.select("doc_id", "text_key", "item_id", share.alias("containment")).where(F.col("containment") >= threshold - 1e-9)


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no test item, columns unchanged. Of rows that share a doc_id, or have none, only those that hold one go."""
    found = stored(_contained(docs, items).select("doc_id", "text_key").distinct(), "contaminated")
    return without(docs, found, {"doc_id": docs["doc_id"], "text_key": text_key(docs["text"])})
