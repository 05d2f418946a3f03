"""Entries of sitemap texts that no parser takes: cut out by one pattern in one pass, and read one by one.

All loops are possessive, so neither long documents nor missing end tags cost
stack or second tries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import decode_closed_entities

# Tag names of the sitemap protocol.
ENTRY_FIELDS = {"url": ("loc", "lastmod", "changefreq", "priority"), "sitemap": ("loc", "lastmod")}

_PREFIX = r"(?:[\w.-]++:)?+"
_ENTRY = "(?:url|sitemap)"
_FIELD = "(?:loc|lastmod|changefreq|priority)"
_COMMENT = r"<!--(?:[^-]++|-(?!->))*+"
_CDATA = r"<!\[CDATA\[(?:[^\]]++|\](?!\]>))*+"
# Within an entry: text, whole comments and CDATA, and every "<" that begins no tag of an entry.
_BODY = rf"(?:[^<]++|{_COMMENT}-->|{_CDATA}\]\]>|<(?!/?+{_PREFIX}{_ENTRY}[\s>]))*+"
# Whichever begins first; what is never closed hides all that follows.
_TOKEN = (
    rf"{_COMMENT}(?:-->|\z)|{_CDATA}(?:\]\]>|\z)|<\?(?:[^?]++|\?(?!>))*+(?:\?>|\z)"
    rf"|<{_PREFIX}({_ENTRY})(?=[\s>])[^>]*+>{_BODY}</{_PREFIX}\1\s*+>"
)
_KIND = rf"^<{_PREFIX}({_ENTRY})(?=[\s>])"
# What an entry holds beside its own fields: comments, and elements of other vocabularies with all that is in them.
_OTHER = (
    rf"({_CDATA}\]\]>)|{_COMMENT}-->|<({_PREFIX}(?!{_FIELD}[\s/>])[\w.-]++)(?=[\s/>])"
    rf"(?:[^>]*+(?<=/)>|[^>]*+>(?:[^<]++|{_CDATA}\]\]>|<(?!/\2\s*+>))*+</\2\s*+>)"
)
_PARTS = rf"{_CDATA}\]\]>|(?:[^<]++|<(?!!\[CDATA\[))++"
# Characters that XML does not allow, written as they are.
_CONTROLS = "".join(chr(n) for n in range(32) if n not in (9, 10, 13))


def entries(xml: Column) -> Column:
    """The complete entries of a text, as texts, in order; none from comments, CDATA or processing instructions."""
    tokens = F.regexp_extract_all(xml, F.lit(_TOKEN), F.lit(0))
    return F.filter(tokens, lambda t: t.rlike(_KIND))


def entry_kind(entry: Column) -> Column:
    return F.regexp_extract(entry, _KIND, 1)


def _text(raw: Column) -> Column:
    """Character data: CDATA as it stands, elsewhere references decoded, unknown ones and bare ampersands left as written."""
    parts = F.regexp_extract_all(raw, F.lit(_PARTS), F.lit(0))

    def one(p: Column) -> Column:
        return F.when(p.startswith("<![CDATA["), F.substr(p, F.lit(10), F.length(p) - 12)).otherwise(decode_closed_entities(p))

    return F.translate(F.array_join(F.transform(parts, one), ""), _CONTROLS, "")


def _field(inner: Column, name: str) -> Column:
    """Text of an entry's first field of a name; null if there is none that is whole."""
    tag = rf"{_PREFIX}{name}"
    body = rf"(?:[^<]++|{_CDATA}\]\]>|<(?!/?+{_PREFIX}{_FIELD}[\s/>]))*+"
    whole = rf"<{tag}(?:\s[^>]*+)?+>{body}</{tag}\s*+>"
    found = F.regexp_extract(inner, whole, 0)
    return F.when(found != "", _text(F.regexp_replace(found, r"^<[^>]*+>|</[^>]*+>\z", "")))


def read_entries(found: Column, kind: str) -> Column:
    """The entries of one kind as structs of their fields, each read alone; null if there are none."""
    own = F.filter(found, lambda e: entry_kind(e) == kind)
    inner = F.transform(own, lambda e: F.regexp_replace(F.regexp_replace(e, r"^<[^>]*+>|</[^>]*+>\z", ""), _OTHER, "$1"))
    read = F.transform(inner, lambda i: F.struct(*[_field(i, n).alias(n) for n in ENTRY_FIELDS[kind]]))
    return F.when(F.size(own) > 0, read)
