"""Page metadata and the indexability verdict, from fetched HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import blank_to_null, decode_entities, strip
from .probes import with_error

# Fixed caps on stored text, in characters.
TITLE_CAP, DESCRIPTION_CAP, OG_TITLE_CAP, H1_CAP, SCHEMA_TYPE_CAP = 500, 500, 200, 200, 10


def _bare(url: Column) -> Column:
    return F.regexp_replace(url, "/+$", "")


def page_meta(pages: DataFrame) -> DataFrame:
    """Title, description, robots, canonical, Open Graph, h1, word count and schema types.

    Input columns: ``url``, ``html`` and, if the fetch was redirected,
    ``final_url``. All other input columns are kept. One narrow stage.
    """
    final_url = F.col("final_url") if "final_url" in pages.columns else F.lit(None).cast("string")

    def meta(key: str, value: str, ignore_case: bool) -> Column:
        tag = H.first_tag_with(F.col("_metas"), key, value, ignore_case)
        return H.raw_attribute(tag, "content")

    # One step per line of work: a column that several later expressions read is
    # computed in its own projection, so that it is evaluated once.
    canonical_rel = r"(?:[^\"'>]*\s)?canonical(?:\s[^\"'>]*)?"
    raw = (
        pages.withColumn("_doc", H.without_comments(F.col("html")))
        .withColumn("_clean", H.without_raw_text(F.col("_doc")))
        .withColumns(
            {
                "_metas": H.open_tags(F.col("_clean"), "meta"),
                "_links": H.open_tags(F.col("_clean"), "link"),
                "_h1s": H.element_bodies(F.col("_clean"), "h1"),
                "_title": F.get(H.element_bodies(F.col("_clean"), "title"), F.lit(0)),
                "c_word_count": H.word_count(F.col("_clean")),
                "c_schema_list": H.json_ld_types(F.col("_doc")),
            }
        )
        .drop("_doc", "_clean")
        .withColumns(
            {
                "_description": meta("name", "description", True),
                "_robots": meta("name", "robots", True),
                "_og_title": meta("property", "og:title", False),
                "_og_description": meta("property", "og:description", False),
                "_canonical": H.raw_attribute(
                    H.first_tag_with(F.col("_links"), "rel", canonical_rel, False), "href"
                ),
                "_title": strip(F.col("_title")),
                "_h1": F.get(F.col("_h1s"), F.lit(0)),
                "c_h1_count": F.coalesce(F.size("_h1s"), F.lit(0)),
            }
        )
        .drop("_metas", "_links", "_h1s")
    )
    # Character references of all short texts are decoded by one expression.
    fields = ["_title", "_description", "_robots", "_canonical", "_og_title", "_og_description"]
    decoded = raw.withColumn("_text", F.transform(F.array(*fields), decode_entities))

    def text(field: str, cap: int | None = None) -> Column:
        value = F.get(F.col("_text"), F.lit(fields.index(field)))
        return blank_to_null(value if cap is None else F.substring(value, 1, cap))

    out = decoded.withColumns(
        {
            "c_title": text("_title", TITLE_CAP),
            "c_meta_description": text("_description", DESCRIPTION_CAP),
            "c_meta_robots": F.lower(text("_robots")),
            "c_canonical": text("_canonical"),
            "c_og_title": text("_og_title", OG_TITLE_CAP),
            "c_og_description": text("_og_description", DESCRIPTION_CAP),
            "c_h1": F.substring(H.joined_text(F.col("_h1")), 1, H1_CAP),
        }
    ).drop("_text", "_h1", *fields)
    is_self = (_bare(F.col("c_canonical")) == _bare(F.col("url"))) | F.coalesce(
        _bare(F.col("c_canonical")) == _bare(final_url), F.lit(False)
    )
    return out.withColumns(
        {
            "c_title_length": F.length("c_title"),
            "c_meta_description_length": F.length("c_meta_description"),
            "c_canonical_is_self": is_self,
            "c_schema_types": blank_to_null(
                F.array_join(F.slice("c_schema_list", 1, SCHEMA_TYPE_CAP), ",")
            ),
        }
    )


def with_indexable(meta: DataFrame) -> DataFrame:
    """Add ``content_error`` and the final ``inferred_indexable`` verdict.

    The robots test is by substring, so ``max-image-preview:none`` counts as
    ``none``. Pages that did not answer 200 are not indexable. A check that
    raised (``exception_type`` and ``exception_message``, where there are such
    columns) has status 0 and the exception's label or text as its error; a
    status that is missing counts as 0.
    """
    if "exception_type" in meta.columns:
        raised = with_error(meta.withColumn("status_code", F.col("content_status_code")))
        meta = raised.withColumns({"content_status_code": F.col("status_code"), "_raised": F.col("error")}).select(
            *meta.columns, "_raised"
        )
    else:
        meta = meta.withColumn("_raised", F.lit(None).cast("string"))
    meta = meta.withColumn("content_status_code", F.coalesce("content_status_code", F.lit(0)))
    ok = F.col("content_status_code") == 200
    robots = F.coalesce("c_meta_robots", F.lit(""))
    verdict = (
        ok
        & ~F.contains(robots, F.lit("noindex"))
        & ~F.contains(robots, F.lit("none"))
        & (F.col("c_canonical").isNull() | F.coalesce("c_canonical_is_self", F.lit(False)))
    )
    return meta.withColumns(
        {
            "content_error": F.when(
                ~ok, F.coalesce("_raised", F.concat(F.lit("status_"), F.col("content_status_code").cast("string")))
            ),
            "inferred_indexable": F.coalesce(verdict, F.lit(False)),
        }
    ).drop("_raised")


def with_meta_json(meta: DataFrame) -> DataFrame:
    """Add the metadata as one JSON object, null members included."""
    members = [
        ("title", "c_title"), ("meta_description", "c_meta_description"),
        ("meta_robots", "c_meta_robots"), ("canonical", "c_canonical"),
        ("canonical_is_self", "c_canonical_is_self"), ("og_title", "c_og_title"),
        ("og_description", "c_og_description"), ("h1", "c_h1"), ("h1_count", "c_h1_count"),
        ("word_count", "c_word_count"), ("schema_types", "c_schema_list"),
    ]
    packed = F.struct(*[F.col(c).alias(n) for n, c in members])
    as_json = F.to_json(packed, {"ignoreNullFields": "false"})
    return meta.withColumn("content_meta_json", F.when(F.col("content_error").isNull(), as_json))


def page_report(pages: DataFrame) -> DataFrame:
    """The whole content check: metadata, verdict and JSON.

    Where ``content_status_code`` is not 200 the body is not read, and only the
    error and the verdict are filled.
    """
    readable = pages.withColumn("html", F.when(F.col("content_status_code") == 200, F.col("html")))
    return with_meta_json(with_indexable(page_meta(readable)))
