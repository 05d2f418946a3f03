"""Secret scans over historical versions with an incremental blob ledger."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from crawldelta.llm.scratch import keys_for_join, new_folder, ship_code, stored

#: The kinds in their order, pattern and version. Letters of the
#: assign keywords match in either case, ASCII only.
RULES = {
    "assign": (1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": (1, r"AKIA[A-Z0-9]+"),
    "hex": (1, r"[0-9a-f]+"),
}

_ASSIGN = re.compile(RULES["assign"][1], re.IGNORECASE | re.ASCII)
_KEYWORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_SPANS = "array<struct<kind:string,start:int,end:int>>"
#: The ledger keeps each span under the rule and version that found it.
_HELD = "array<struct<rule:string,start:int,end:int>>"

#: Copies of each blob's findings where they are joined back, so that a blob of very many rows is no single task's.
SALTS = 16
_SCANNED = pa.schema(
    [
        ("blob_id", pa.binary()),
        ("rules", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def _assign(text: str) -> Iterator[tuple[int, int]]:
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        yield from (m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 8)


def _access(text: str) -> Iterator[tuple[int, int]]:
    # A run of 16 characters or more is taken whole from its first AKIA, as the open pattern would.
    yield from (m.span() for m in _ACCESS.finditer(text))


def _hex(text: str) -> Iterator[tuple[int, int]]:
    yield from (m.span() for m in _HEX.finditer(text))


FINDERS = {"assign": _assign, "access": _access, "hex": _hex}


def rule_keys() -> list[str]:
    """Each rule with its version: what the ledger records as scanned."""
    return [f"{kind}@{version}" for kind, (version, _) in RULES.items()]


def find_spans(text: str, kinds: list[str]) -> list[dict]:
    """Spans of the kinds in code points, by start, then in the rules' order."""
    order = {k: i for i, k in enumerate(FINDERS)}
    found = [(a, order[k], b, k) for k in kinds for a, b in FINDERS[k](text)]
    return [{"kind": k, "start": a, "end": b} for a, _, b, k in sorted(found)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scan each blob for the rules it has not been scanned for."""
    for batch in batches:
        todo = batch.column("todo").to_pylist()
        spans = [
            [{"rule": r, "start": a, "end": b} for r in rules for a, b in FINDERS[r.partition("@")[0]](text)]
            for text, rules in zip(batch.column("text").to_pylist(), todo)
        ]
        yield pa.RecordBatch.from_pydict(
            {"blob_id": batch.column("blob_id").cast(pa.binary()), "rules": todo, "spans": spans}, schema=_SCANNED
        )


def read_ledger(spark, ledger: str) -> DataFrame | None:
    """One row per blob: the rules it was scanned for, and the spans of every rule version; None without a ledger."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.schema(f"blob_id binary, rules array<string>, spans {_HELD}").parquet(ledger)
    return rows.groupBy("blob_id").agg(
        F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"),
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
    )


def blob_id(text: Column) -> Column:
    """Content address: SHA-256 of the text's UTF-8 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def update_ledger(versions: DataFrame, ledger: str) -> int:
    """Scan the (blob, rule version) pairs of versions(text, ...) that the ledger lacks; append them. Gives the number of blobs scanned.

    Copies fold into one blob before the shuffle, and each unseen blob's text is
    shuffled once; of blobs that the ledger knows only the id is. The append is
    one committed write: a lost run leaves the ledger as it was, and a blob that
    two runs scanned counts once.
    """
    spark = versions.sparkSession
    ship_code(spark)
    known = read_ledger(spark, ledger)
    text = F.coalesce("text", F.lit(""))
    blobs = versions.select(blob_id(F.col("text")).alias("blob_id"), text.alias("text"))
    wanted = F.array(*map(F.lit, rule_keys()))
    if known is None:
        todo = blobs.groupBy("blob_id").agg(F.first("text").alias("text")).withColumn("todo", wanted)
    else:
        seen = known.select("blob_id", F.col("rules").alias("seen"))
        lacking = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        ids = blobs.select("blob_id").distinct().join(seen, "blob_id", "left").withColumn("todo", lacking)
        ids = stored(ids.where("size(todo) > 0").select("blob_id", "todo"), "unseen")
        asked = blobs.join(keys_for_join(ids), "blob_id")
        todo = asked.groupBy("blob_id").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    seen_now, counted = Observation("scanned"), F.count(F.lit(1)).alias("n")
    scanned = todo.mapInArrow(_scan, f"blob_id binary, rules array<string>, spans {_HELD}")
    scanned.observe(seen_now, counted).write.mode("append").parquet(ledger)
    return seen_now.get["n"]


def scan_versions(versions: DataFrame, ledger: str, keep: list[str] | None = None) -> DataFrame:
    """versions(text, ...) with `spans`: the ledger brought up to date and joined back to every row.

    A row is one version of one path; its other columns are kept, or those named
    in `keep`; without the text there, no text takes part in the join. spans has
    kind, start, end (code points, end exclusive) as the present rules' present
    versions find them, by start, then kind as listed; no finding gives an empty
    array. What retired versions found stays in the ledger and out of the result.
    Null and empty texts have no span, repeated rows have the same; an empty
    table gives an empty one.
    """
    update_ledger(versions, ledger)
    live = F.filter("spans", lambda s: s["rule"].isin(rule_keys()))
    kind = lambda s: F.substring_index(s["rule"], "@", 1)
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(FINDERS) for x in (k, i)])
    keyed = F.array_sort(F.transform(live, lambda s: F.struct(s["start"], rank[kind(s)].alias("rank"), s["end"], kind(s).alias("kind"))))
    tidy = F.transform(keyed, lambda s: F.struct(s["kind"], s["start"], s["end"]))
    found = read_ledger(versions.sparkSession, ledger).select("blob_id", tidy.alias("spans")).where("size(spans) > 0")
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    found = found.select(F.col("blob_id").alias("__blob"), F.col("spans").alias("__spans"), copies.alias("__salt"))
    kept = versions.columns if keep is None else keep
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    # The blob's id is made where the text is read: what is shuffled are the kept columns.
    rows = versions.select(F.struct(*[versions[c] for c in kept]).alias("__row"), blob_id(versions["text"]).alias("__blob"), salt.alias("__salt"))
    joined = rows.join(found, ["__blob", "__salt"], "left")
    none = F.array().cast(_SPANS)
    return joined.select(*[F.col("__row")[c].alias(c) for c in kept if c != "spans"], F.coalesce("__spans", none).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the spans' order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans; without a ledger's path a new one is begun."""
    ledger = ledger or new_folder(docs.sparkSession, "ledger")
    found = scan_versions(docs.select("doc_id", "text"), ledger, ["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    told = joined_spans(F.col("spans"))
    return found.select(
        "doc_id", *map(count, RULES), F.sha2(told.cast("binary"), 256).alias("base_sha256"), told.alias("spans")
    )
