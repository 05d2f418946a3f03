"""Text helpers shared by the XML, HTML, robots and header expressions."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in Unicode text.
_SPACES = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())


def strip(c: Column) -> Column:
    """Remove leading and trailing white space, tabs and line ends included."""
    return F.btrim(c, F.lit(_SPACES))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def count_words(c: Column) -> Column:
    """Number of white-space separated words; 0 for blank text."""
    plain = F.translate(c, _SPACES, " " * len(_SPACES))
    return F.regexp_count(plain, F.lit("[^ ]++"))


def _named_entities() -> Column:
    # One literal that is folded to a map; no value holds a tab or a line end.
    table = {n.rstrip(";"): c for n, c in html5.items() if not set(c) & set("\t\n")}
    named = F.str_to_map(F.lit("\n".join(f"{n}\t{c}" for n, c in table.items())), F.lit("\n"), F.lit("\t"))
    return F.map_concat(named, F.create_map(F.lit("Tab"), F.lit("\t"), F.lit("NewLine"), F.lit("\n")))


# Names that stand for a character without a semicolon too, longest first.
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
_NUMBER = "#[xX]0*+[0-9a-fA-F]{1,6}|#0*+[0-9]{1,7}"
_REFERENCE = rf"^(?:({_NUMBER}|[A-Za-z][A-Za-z0-9]*+);|({_NUMBER})(?![0-9a-fA-F])|({_BARE})(?![=A-Za-z0-9;]))"

_CLOSED = rf"^({_NUMBER}|[A-Za-z][A-Za-z0-9]*+);"


def _code_to_char(code: Column) -> Column:
    # Java's UTF-32 decoder takes big-endian bytes when there is no mark.
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


# References that stand for white space, after the "&".
_SPACE_CODES = [ord(s) for s in _SPACES]
_SPACE_NAMES = sorted(n.rstrip(";") for n, c in html5.items() if n.endswith(";") and set(c) <= set(_SPACES))
_SPACE_NUMBER = f"#(?:[xX]0*+(?i:{'|'.join(f'{n:x}' for n in _SPACE_CODES)})|0*+(?:{'|'.join(map(str, _SPACE_CODES))}))"
_SPACE_REFERENCE = rf"&(?:{_SPACE_NUMBER}(?:;|(?![0-9a-fA-F]))|(?:{'|'.join(_SPACE_NAMES)});|nbsp(?![=A-Za-z0-9;]))"


def blank_references(c: Column) -> Column:
    """White space in place of the character references that stand for it; all others stay as written."""
    return F.regexp_replace(c, _SPACE_REFERENCE, " ")


def decode_entities(c: Column) -> Column:
    """Decode named (HTML 5), decimal and hexadecimal character references, with or without semicolon.

    Unknown references stay as written. Text without ``&`` is passed through
    untouched, so the array work runs only where it is needed.
    """
    return _decoded(c, lambda p: F.concat(*[F.regexp_extract(p, _REFERENCE, i) for i in (1, 2, 3)]))


def decode_closed_entities(c: Column) -> Column:
    """The same where, as in XML, only what ends in a semicolon is a reference."""
    return _decoded(c, lambda p: F.regexp_extract(p, _CLOSED, 1))


def _decoded(c: Column, reference: Callable[[Column], Column]) -> Column:
    parts = F.split(c, "&")
    tail = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))

    # Two passes, so that the reference of a piece is extracted once.
    def with_ref(p: Column) -> Column:
        ref = reference(p)
        hexadecimal = F.lower(F.substring(ref, 1, 2)) == "#x"
        digits = F.when(hexadecimal, F.conv(F.substr(ref, F.lit(3)), 16, 10)).otherwise(F.substr(ref, F.lit(2)))
        code = F.when(ref.startswith("#"), digits.try_cast("bigint"))
        return F.struct(p.alias("piece"), ref.alias("ref"), code.alias("code"))

    def one(r: Column) -> Column:
        code = r["code"]
        usable = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.when(code.isNull(), F.try_element_at(_named_entities(), r["ref"])).when(
            usable, _code_to_char(code)
        )
        after = F.substr(r["piece"], F.length(r["ref"]) + 1)
        rest = F.when(after.startswith(";"), F.substr(after, F.lit(2))).otherwise(after)
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), r["piece"]))

    decoded = F.concat(
        F.get(parts, F.lit(0)),
        F.array_join(F.transform(F.transform(tail, with_ref), one), ""),
    )
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)
