"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawldelta.llm import align, blocks, decontam, html_text, langid, licenses, merkle, pieces, quality, secrets, simhash, tokenbin, warc
from crawldelta.llm.scratch import new_folder


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = langid.document_rows(docs).unionByName(langid.page_rows(_table(spark, sf_dir, "pages")))
    return langid.identify(rows, *langid.train_text(docs))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    docs = _table(spark, sf_dir, "documents")
    tokenbin.write_shards(docs, folder, tokenizer_file("byte_bpe_50k.json"))
    return tokenbin.token_report(spark, folder)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blocks.exact_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_report(_table(spark, sf_dir, "pages"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(_table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return align.alignment_report(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scans,
        op2_html_extraction,
        op3_simhash_near_dedup,
        op4_license_scans,
        op5_language_id,
        op6_quality_classifier,
        op7_token_id_output,
        op8_exact_dedup,
        op9_benchmark_decontamination,
        op10_sentencepiece,
        op11_warc,
        op12_merkle_manifest,
        op13_tokenizer_alignment,
    )
}

_SQL_SPELLINGS = "flat"
for _pattern, _instead in licenses.SPELLINGS:
    _SQL_SPELLINGS = f"regexp_replace({_SQL_SPELLINGS}, '{_pattern}', '{_instead.replace('$', chr(92))}', 'g')"

_SQL_KNOWN = ", ".join(
    "('{}', '{}')".format(name, text.replace("'", "''"))
    for name, texts in [*licenses.NOTICES.items(), *((k, [t]) for k, t in licenses.TEXTS.items())]
    for text in texts
)

ORACLES = {
    # The same canonical form for the known texts, the documents and their lines, and a join on it as text.
    "op4_license_scans": rf"""
        WITH known(license_id, unit) AS (VALUES {_SQL_KNOWN}),
        units AS (
            SELECT doc_id, 'text' AS scope, text AS unit, NULL AS license_id FROM documents WHERE text IS NOT NULL
            UNION ALL
            SELECT doc_id, 'line', unnest(regexp_split_to_array(text, '\r?\n')), NULL FROM documents WHERE text IS NOT NULL
            UNION ALL SELECT NULL, 'known', unit, license_id FROM known),
        bare AS (
            SELECT *, trim(regexp_replace(lower(regexp_replace(unit,
                '(?im)^[ \t/*#;-]*(copyright[ \t]+(\(c\)|©|[0-9]{{4}}|by[ \t])|\(c\)[ \t]|©|all rights reserved).*$', ' ', 'g')),
                '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS flat
            FROM units),
        canonical AS (SELECT *, {_SQL_SPELLINGS} AS form FROM bare)
        SELECT c.doc_id, k.license_id, c.scope, count(*) AS n_units
        FROM canonical c JOIN (SELECT DISTINCT license_id, form FROM canonical WHERE scope = 'known') k USING (form)
        WHERE c.scope <> 'known' GROUP BY ALL
    """,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    # Words as maximal runs of letters and digits, shingles of five as text, and plain counting.
    "op9_benchmark_decontamination": r"""
        WITH items AS (
            SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws
            FROM benchmark),
        item_shingles AS (
            SELECT DISTINCT item_id, array_to_string(ws[i:i + 4], ' ') AS s
            FROM items, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS r(i) WHERE len(ws) > 0),
        sizes AS (SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id),
        docs AS (
            SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws
            FROM documents),
        doc_shingles AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
            FROM docs, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS r(i) WHERE len(ws) > 0)
        SELECT doc_id, item_id, count(*) / any_value(n) AS containment
        FROM doc_shingles JOIN item_shingles USING (s) JOIN sizes USING (item_id)
        GROUP BY doc_id, item_id HAVING count(*) / any_value(n) >= 0.8 - 1e-9
    """,
    # Base32 of the digest's 40-bit parts, five bits at a time.
    "op11_warc": """
        WITH told AS (
            SELECT page_id, coalesce(html, '') AS payload FROM pages),
        parts AS (
            SELECT page_id, payload, list_transform(range(4), lambda i: CAST('0x' || substr(sha1(payload), 1 + 10 * i, 10) AS BIGINT)) AS bits,
                   min(page_id) OVER (PARTITION BY payload) AS first_id
            FROM told)
        SELECT page_id, strlen(payload) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((bits[1 + i // 8] >> (35 - 5 * (i % 8))) & 31), 1)), '') AS payload_digest,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM parts
    """,
    # Trees level by level, then every row's way up, one level at a time.
    "op12_merkle_manifest": r"""
        WITH RECURSIVE
        -- CRC-32 byte by byte, over the table that its polynomial gives
        crc_table AS (
            SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        told AS (
            SELECT doc_id, lang, list_transform([0, 1], lambda extra: sha256(concat(
                    coalesce(concat(strlen(CAST(doc_id AS VARCHAR)), ':', CAST(doc_id AS VARCHAR)), '-'),
                    coalesce(concat(strlen(source), ':', source), '-'),
                    coalesce(concat(strlen(lang), ':', lang), '-'),
                    CASE WHEN n_chars IS NULL THEN '-'
                         ELSE concat(strlen(CAST(n_chars + extra AS VARCHAR)), ':', CAST(n_chars + extra AS VARCHAR)) END,
                    CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END))) AS leaves,
                xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 7 = 0 AS tampered
            FROM documents, crc_table),
        rows AS (
            SELECT dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaves[1]) - 1 AS idx,
                   doc_id, leaves[1] AS leaf, CASE WHEN coalesce(tampered, false) THEN leaves[2] ELSE leaves[1] END AS start
            FROM told),
        nodes(tree, level, idx, h) AS (
            SELECT tree, 0, idx, leaf FROM rows
            UNION ALL
            SELECT tree, any_value(level) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
            FROM (SELECT *, max(idx) OVER (PARTITION BY tree) AS last FROM nodes) WHERE last > 0 GROUP BY tree, idx // 2),
        subroots AS (SELECT tree, max_by(h, level) AS subroot, max(level) AS levels FROM nodes GROUP BY tree),
        top(level, idx, h) AS (
            SELECT 0, tree, subroot FROM subroots
            UNION ALL
            SELECT any_value(level) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
            FROM (SELECT *, max(idx) OVER () AS last FROM top) WHERE last > 0 GROUP BY idx // 2),
        root AS (SELECT max_by(h, level) AS root, max(level) AS top_levels FROM top),
        -- Every row goes up one level at a time with what it has met.
        up(tree, idx, doc_id, leaf, step, spot, seen, acc) AS (
            SELECT tree, idx, doc_id, leaf, 0, CASE WHEN levels = 0 THEN tree ELSE idx END, '', start FROM rows JOIN subroots USING (tree)
            UNION ALL
            SELECT u.tree, u.idx, u.doc_id, u.leaf, u.step + 1,
                   CASE WHEN u.step + 1 = s.levels THEN u.tree ELSE u.spot // 2 END,
                   concat(u.seen, coalesce(n.h, o.h, '')),
                   sha256(CASE WHEN u.spot % 2 = 1 THEN concat(coalesce(n.h, o.h, ''), u.acc) ELSE concat(u.acc, coalesce(n.h, o.h, '')) END)
            FROM up u JOIN subroots s ON u.tree = s.tree JOIN root ON u.step < s.levels + top_levels
            LEFT JOIN nodes n ON u.step < s.levels AND n.tree = u.tree AND n.level = u.step AND n.idx = xor(u.spot, 1)
            LEFT JOIN top o ON u.step >= s.levels AND o.level = u.step - s.levels AND o.idx = xor(u.spot, 1))
        SELECT doc_id, leaf, subroot, root, sha256(seen) AS proof_sha256, acc AS folded_root, acc = root AS verified
        FROM up JOIN subroots USING (tree) JOIN root ON step = levels + top_levels
    """,
}
