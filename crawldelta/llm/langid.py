"""Language identification: Bayesian fusion of text, declared language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawldelta.llm.html_text import host, read_page
from crawldelta.llm.scratch import keys_for_join, ship_code, stored

#: Pairs of bytes counted for each language, and the count added to each.
PAIRS = 1 << 16
ADDED = 0.5

#: A text weighs as much as this many pairs at most: neighbouring pairs aren't independent.
WEIGHT = 200

#: Counts added to each declared language or suffix, and the weight of the wider level in a host's prior.
EVIDENCE_ADDED = 1.0
PRIOR_WEIGHT = 5.0

#: Languages that are told apart, as each of them has a table in every task. Where there are
#: more labels, the commonest by pairs of bytes are, and all others are one class of its own.
MOST_LANGUAGES = 256
REST = "(other)"


def pair_codes(text: str | None) -> np.ndarray:
    """Codes of the neighbouring bytes of the lower-cased text."""
    raw = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.int32)
    return raw[:-1] * 256 + raw[1:]


def _count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of one task by label, added up before the shuffle; what many labels need in memory is told and begun anew."""
    totals: dict[str, np.ndarray] = {}

    def told() -> Iterator[pd.DataFrame]:
        for lang, counts in totals.items():
            seen = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "code": seen.astype(np.int32), "n": counts[seen]})
        totals.clear()

    for pdf in batches:
        for text, lang in zip(pdf["text"], pdf["lang"]):
            codes = pair_codes(text)
            if lang not in totals:
                if len(totals) >= MOST_LANGUAGES:
                    yield from told()
                totals[lang] = np.zeros(PAIRS, np.int64)
            if len(codes) > PAIRS:
                totals[lang] += np.bincount(codes, minlength=PAIRS)
            else:
                np.add.at(totals[lang], codes, 1)
    yield from told()


def _told_apart(counts: DataFrame) -> DataFrame:
    """Counts by the languages that are told apart: the rarer labels' ones are added up under REST, whatever their number."""
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("pairs"))
    first = sizes.orderBy(F.desc("pairs"), "lang").limit(MOST_LANGUAGES + 1).collect()
    if len(first) <= MOST_LANGUAGES:
        return counts
    kept = [r.lang for r in first[: MOST_LANGUAGES - 1]]
    one = F.when(F.col("lang").isin(kept), F.col("lang")).otherwise(F.lit(REST))
    return counts.groupBy(one.alias("lang"), "code").agg(F.sum("n").alias("n"))


def train_text(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each pair in each language) from all labelled documents(text, lang).

    Null and empty labels are left out; without labels there are no languages;
    beyond MOST_LANGUAGES the rarest labels are one class, REST. What reaches the driver is one count for each language and pair of bytes.
    """
    ship_code(docs.sparkSession)
    labelled = docs.where("lang is not null and lang <> ''").select("text", "lang")
    counts = labelled.mapInPandas(_count_pairs, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rows = _told_apart(stored(counts, "pairs")).toPandas()
    langs = sorted(rows["lang"].unique())
    table = np.full((PAIRS, len(langs)), ADDED)
    for i, lang in enumerate(langs):
        own = rows[rows["lang"] == lang]
        table[own["code"], i] += own["n"]
    return langs, np.log(table / table.sum(0)).astype(np.float32) if langs else np.zeros((PAIRS, 0), np.float32)


def text_support(text: str | None, table: np.ndarray) -> np.ndarray:
    """Log likelihood of each language, less the largest; a long text counts as WEIGHT pairs."""
    codes = pair_codes(text)
    if not len(codes) or not table.shape[1]:
        return np.zeros(table.shape[1])
    total = np.zeros(table.shape[1])
    for low in range(0, len(codes), 1 << 16):
        total += table[codes[low : low + (1 << 16)]].sum(0, dtype=np.float64)
    support = total / len(codes) * min(len(codes), WEIGHT)
    return support - support.max()


def declared(html_text: str) -> Column:
    """Primary tag of the language that a page declares, in lower case; null without one."""
    opened = F.regexp_extract(F.coalesce(F.col(html_text), F.lit("")), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", 1)
    return F.nullif(F.lower(opened), F.lit(""))


def suffix(host_name: str) -> Column:
    """Last label of a host name; null for an address in numbers, or without one."""
    return F.nullif(F.regexp_extract(F.col(host_name), r"\.([a-z][a-z0-9-]*)\.?(?::\d+)?$", 1), F.lit(""))


def domain(host_name: str) -> Column:
    """Last two labels of a host name, or the whole name."""
    short = F.regexp_extract(F.col(host_name), r"([^.]+\.[^.]+?)\.?(?::\d+)?$", 1)
    return F.when(short == "", F.col(host_name)).otherwise(short)


def page_rows(pages: DataFrame) -> DataFrame:
    """Evidence rows of pages(page_id, url, html)."""
    rows = pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", F.col("html").alias("text"), F.lit(True).alias("is_page"),
                        declared("html").alias("declared"), host("url").alias("host"))
    return rows.withColumn("suffix", suffix("host")).withColumn("domain", domain("host"))


def document_rows(docs: DataFrame) -> DataFrame:
    """Evidence rows of documents(doc_id, text, source): the source stands for the host; there is no markup or address."""
    none = F.lit(None).cast("string")
    name = F.concat(F.lit("source:"), F.coalesce("source", F.lit("")))
    return docs.select("doc_id", F.lit(None).cast("long").alias("page_id"), "text", F.lit(False).alias("is_page"), none.alias("declared"),
                       name.alias("host"), none.alias("suffix"), name.alias("domain"))


def identify(rows: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """One row per evidence row: doc_id, page_id, lang, confidence, text_lang, declared, suffix, host.

    The posterior is the product of the text's likelihood, of P(declared | lang)
    and P(suffix | lang), both counted over all rows by their text's posterior,
    and of the host's prior: the other rows of the host, smoothed by its domain,
    smoothed by all rows; a row never counts in its own prior. Missing evidence
    plays no part; ties go to the first language by name; empty texts are told
    by the rest. Without languages, lang and confidence are null.
    """
    if not langs:
        none = [F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("text_lang")]
        return rows.select("doc_id", "page_id", *none, "declared", "suffix", "host")
    ship_code(rows.sparkSession)
    size = len(langs)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            support = []
            for text, is_page in zip(pdf["text"], pdf["is_page"]):
                if is_page:
                    page = read_page(text)
                    text = "\n".join(page.article or page.open_blocks)
                support.append(text_support(text, table))
            yield pdf.drop(columns=["text", "is_page"]).assign(support=support)

    kept = "doc_id long, page_id long, declared string, host string, suffix string, domain string"
    told = rows.select("doc_id", "page_id", "text", "is_page", "declared", "host", "suffix", "domain").mapInPandas(read, f"{kept}, support array<double>")
    weights = F.transform("support", lambda s: F.exp(s))
    summed = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    told = stored(told.withColumn("post", F.transform(weights, lambda w: w / summed)), "evidence")

    sums = lambda prefix: [F.sum(F.col("post")[i]).alias(f"{prefix}{i}") for i in range(size)]
    vector = lambda prefix: F.array(*[F.col(f"{prefix}{i}") for i in range(size)])
    every = told.agg(*sums("s")).select(*[F.coalesce(f"s{i}", F.lit(0.0)) for i in range(size)]).first()
    whole = [(x + 1.0) / (sum(every) + size) for x in every]

    def given(column: str) -> DataFrame:
        """log P(value | lang) of a kind of evidence."""
        counts = stored(told.where(F.col(column).isNotNull()).groupBy(column).agg(*sums("n")), column)
        over = counts.agg(F.count("*").alias("values"), *[F.sum(f"n{i}").alias(f"t{i}") for i in range(size)]).first()
        logs = [F.log((F.col(f"n{i}") + EVIDENCE_ADDED) / F.lit(float((over[i + 1] or 0.0) + EVIDENCE_ADDED * max(1, over[0])))) for i in range(size)]
        return stored(counts.select(column, F.array(*logs).alias(f"given_{column}")), f"given-{column}")

    def level(name: str) -> DataFrame:
        return told.groupBy(name).agg(*sums("n")).select(name, vector("n").alias(f"n_{name}"))

    hosts = told.groupBy("host", "domain").agg(*sums("n")).select("host", "domain", vector("n").alias("n_host"))
    priors = stored(hosts.join(level("domain"), "domain").select("host", "n_host", "n_domain"), "priors")

    zero = F.array(*[F.lit(0.0)] * size)
    minus = lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x - y, F.lit(0.0)))
    count = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def smooth(counts: Column, wider: Column) -> Column:
        return F.zip_with(counts, wider, lambda n, w: (n + PRIOR_WEIGHT * w) / (count(counts) + PRIOR_WEIGHT))

    joined = told.join(priors, "host")
    for column in ("declared", "suffix"):
        joined = joined.join(keys_for_join(given(column)), column, "left")
    all_rows = F.array(*map(F.lit, whole))
    joined = joined.withColumn("others", minus(F.col("n_host"), F.col("post"))).withColumn("near", minus(F.col("n_domain"), F.col("post")))
    joined = joined.withColumn("wide", smooth(F.col("near"), all_rows)).withColumn("prior", smooth(F.col("others"), F.col("wide")))
    parts = [F.col("support"), F.transform("prior", lambda p: F.log(p)), F.coalesce("given_declared", zero), F.coalesce("given_suffix", zero)]
    joined = joined.withColumn("logs", reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), parts))
    names = F.array(*map(F.lit, langs))
    best = F.array_max("logs")
    spread = count(F.transform("logs", lambda x: F.exp(x - best)))
    return joined.select(
        "doc_id", "page_id", names[(F.array_position("logs", best) - 1).cast("int")].alias("lang"), (F.lit(1.0) / spread).alias("confidence"),
        names[(F.array_position("support", F.array_max("support")) - 1).cast("int")].alias("text_lang"), "declared", "suffix", "host",
    )
