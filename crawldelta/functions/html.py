"""HTML expressions: tags, attributes and visible text by regular expression.

Everything stays inside the JVM and in one narrow stage. Quantifiers over tag
bodies are possessive, so long attributes cannot exhaust the matcher's stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_references, count_words, decode_entities, strip

_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
# Whichever begins first: within a script "<!--" begins no comment.
_COMMENT_OR_RAW = r"(?is)(<(script|style|template)\b[^>]*+>.*?</\2\s*+>)|<!--.*?-->"
_RAW_TEXT = r"(?is)<(script|style|template)\b[^>]*>.*?</\1\s*>"
_TAG = rf"(?s)<(?:[A-Za-z/!?]{_ATTRS})>"


def without_comments(html: Column) -> Column:
    """Drop comments; scripts, styles and templates stay as they are."""
    return F.regexp_replace(html, _COMMENT_OR_RAW, "$1 ")


def without_raw_text(html: Column) -> Column:
    """Drop scripts, styles and templates with their bodies."""
    return F.regexp_replace(html, _RAW_TEXT, " ")


def open_tags(html: Column, tag: str) -> Column:
    """All opening tags of one element, as text, in document order."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?=[\s/>]){_ATTRS}>"), F.lit(0))


def raw_attribute(tag: Column, name: str) -> Column:
    """Undecoded value of an attribute of one tag; empty if absent."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def first_tag_with(tags: Column, name: str, value: str, ignore_case: bool) -> Column:
    flags = "(?is)" if ignore_case else "(?s)"
    attr = name if ignore_case else f"(?i:{name})"
    pattern = rf"""{flags}[\s"'/]{attr}\s*=\s*(?:"{value}"|'{value}'|{value}(?=[\s/>]))"""
    return F.get(F.filter(tags, lambda t: t.rlike(pattern)), F.lit(0))


def element_bodies(html: Column, tag: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?=[\s/>]){_ATTRS}>(.*?)</{tag}\s*>"), F.lit(1))


def joined_text(inner: Column) -> Column:
    """Text of an element: every text piece stripped, pieces joined without a gap."""
    pieces = F.transform(F.split(inner, _TAG), lambda p: strip(decode_entities(p)))
    return F.array_join(pieces, "")


def word_count(clean_html: Column) -> Column:
    """Words of the visible text; scripts, styles and comments must be gone already.

    Of the character references only those that stand for white space part words, so no other is decoded.
    """
    return count_words(blank_references(F.regexp_replace(clean_html, _TAG, " ")))


def visible_text(html: Column) -> Column:
    """The text of a page: comments, scripts, styles, templates and tags become white space, and so do references that stand for it."""
    plain = without_raw_text(without_comments(F.coalesce(html, F.lit(""))))
    return blank_references(F.regexp_replace(plain, _TAG, " "))


def json_ld_types(html_without_comments: Column) -> Column:
    """Top-level ``@type`` values of all JSON-LD scripts, in document order.

    A script may hold one object or a list of objects, and a type may itself be
    a list. Scripts that are not valid JSON are ignored.
    """
    bodies = F.regexp_extract_all(
        html_without_comments,
        F.lit(
            r"""(?is)<script\b[^>]*?[\s"']type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script\s*>"""
        ),
        F.lit(1),
    )

    def types_of_item(item: Column) -> Column:
        t = F.get_json_object(item, "$.@type")
        listed = F.from_json(t, "array<string>")
        return F.when(t.isNull(), F.array().cast("array<string>")).otherwise(
            F.when(t.startswith("["), F.coalesce(listed, F.array(t))).otherwise(F.array(t))
        )

    def types_of_body(body: Column) -> Column:
        b = strip(body)
        items = F.when(b.startswith("["), F.from_json(b, "array<string>")).otherwise(F.array(b))
        valid = F.try_parse_json(b).isNotNull()
        return F.when(valid, F.flatten(F.transform(F.filter(items, lambda i: i.startswith("{")), types_of_item)))

    per_body = F.filter(F.transform(bodies, types_of_body), lambda a: a.isNotNull())
    return F.flatten(per_body)
