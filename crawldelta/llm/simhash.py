"""SimHash near-duplicates: meet-in-the-middle ball hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from crawldelta.llm.components import roots
from crawldelta.llm.scratch import keys_for_join, ship_code, stored, without

#: Fixed values of the fingerprint.
WORDS = 3
SEED = 42
BITS = 64

#: Fingerprints within this many differing bits are linked.
RADIUS = 2

_AT_ONCE = 1 << 15


def simhash(text: str | None) -> int:
    """The fingerprint of one text, unsigned; zero without words.

    A-Z are lower-cased, words end at ASCII white space, shingles are three
    words joined by a space, repeats included. A bit is set if more than half
    of the shingles' hashes have it.
    """
    return bits_of(shingle_hashes(text)) & (1 << BITS) - 1


def shingle_hashes(text: str | None, size: int = WORDS) -> np.ndarray:
    """The 64-bit hash of every shingle of so many words in order; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    width = min(size, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    stops = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), "<u8", len(stops))


def bits_of(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes, as a signed 64-bit integer."""
    counts = np.zeros(BITS, np.int64)
    for low in range(0, len(hashes), _AT_ONCE):
        some = hashes[low : low + _AT_ONCE]
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprint(texts: pd.Series) -> pd.Series:
    """simhash() of a column, as a signed 64-bit integer."""
    return pd.Series(np.array([simhash(t) for t in texts], np.uint64).view(np.int64))


def _variants(fp: str, flips: int) -> F.Column:
    """The fingerprint and all values within `flips` differing bits, 1 at most."""
    if flips not in (0, 1):
        raise ValueError("half the radius must be 0 or 1")
    one_off = [F.col(fp).bitwiseXOR(F.lit(1).cast("long") if i == 0 else F.shiftleft(F.lit(1).cast("long"), i)) for i in range(BITS * flips)]
    return F.array(F.col(fp), *one_off)


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified links (a, b) that connect all distinct values of fp within the radius, 0 or 2.

    Every fingerprint sends its variants within half the radius; two
    fingerprints within an even radius meet in at least one variant, and all
    that meet in one variant lie within the radius of each other. A variant is
    met by 65 distinct fingerprints at most, so its members are tied to the
    smallest of them, which keeps every connection.
    """
    if radius not in (0, 2):
        raise ValueError("the radius must be 0 or 2")
    # Each row becomes 65: spread them first, over as many tasks as a shuffle has.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = fps.select("fp").repartition(tasks, "fp").select("fp", F.explode(_variants("fp", radius // 2)).alias("variant"))
    met = sent.groupBy("variant").agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"))
    met = stored(met.where("n > 1"), "met")
    tied = met.select(F.col("low").alias("a"), F.col("high").alias("b"))
    # The smallest and the largest of more than two are tied; the others are looked up by their variant.
    more = met.where("n > 2").select("variant", F.col("low").alias("a"))
    if not more.isEmpty():
        others = sent.join(keys_for_join(more), "variant").where("fp <> a")
        tied = tied.unionByName(others.select("a", F.col("fp").alias("b")))
    pairs = tied.distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for every distinct fp of the stored table (doc_id, fp): the smallest doc_id reachable.

    Null doc_ids take part in links, but name a component only if it has no other.
    """
    firsts = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    tree = stored(roots(links(firsts, radius)), "tree").withColumnRenamed("node", "fp")
    named = firsts.join(tree, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    groups = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return stored(named.join(groups, "root").select("fp", "component_id"), "groups")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id. Extra columns are ignored.

    Null and empty texts have fingerprint zero and are linked like any other;
    repeated rows stay repeated; an empty table gives an empty one.
    """
    ship_code(docs.sparkSession)
    prints = stored(docs.select("doc_id", fingerprint(F.col("text")).alias("fp")), "prints")
    return prints.join(near_groups(prints, radius), "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: str = "fp") -> F.Column:
    """A signed 64-bit fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest doc_id stays.

    Of rows that share this doc_id, the one with the smallest text hash stays;
    identical rows stay or go together. Columns and texts are unchanged.
    """
    ship_code(docs.sparkSession)
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    prints = stored(docs.select("doc_id", key.alias("text_key"), fingerprint(F.col("text")).alias("fp")), "prints")
    grouped = prints.join(near_groups(prints, radius).withColumnRenamed("component_id", "keep_id"), "fp")
    first = grouped.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    low = first.groupBy("keep_id").agg(F.min("text_key").alias("keep_key"))
    judged = grouped.join(low.withColumnRenamed("keep_id", "k"), F.col("keep_id").eqNullSafe(F.col("k")), "left")
    lost = judged.where(~(F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("text_key").eqNullSafe(F.col("keep_key"))))
    losers = stored(lost.select("doc_id", "text_key"), "losers")
    return without(docs, losers, {"doc_id": docs["doc_id"], "text_key": F.xxhash64(F.coalesce(docs["text"], F.lit("")))})
