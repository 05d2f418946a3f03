"""License scans: canonical digest lookup, in SQL functions only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What counts as one spelling, each pattern applied in this order to lower-cased text.
SPELLINGS = [
    ("licence", "license"),
    ("(sub ?)licens(ing|able|ed|ee|or|es|e)", "sublicens$2"),
    ("organis", "organiz"),
    ("recognis", "recogniz"),
    ("authoris", "authoriz"),
    ("whilst", "while"),
    ("per ?cent", "percent"),
    ("non commercial", "noncommercial"),
    ("copyright (owner|holder)", "copyright holder"),
    ("https?", "http"),
]

#: A lower-cased text without any of these is in that one spelling already.
SPELT = ["licenc", "licens", "organis", "recognis", "authoris", "whilst", "per cent", "percent", "non commercial", "copyright", "https"]

#: Lower-cased lines of this form name an owner or a year and play no part, and what each of them contains.
COPYRIGHT_LINE = r"(?m)^[ \t/*#;-]*(copyright[ \t]+(\(c\)|©|[0-9]{4}|by[ \t])|\(c\)[ \t]|©|all rights reserved).*$"
COPYRIGHT_SIGNS = ["copyright", "(c)", "©", "all rights reserved"]

#: Words of a known body by whose hash its runs are found.
ANCHOR = 16

#: Spelling shortens a text by one character in five at most.
SHORTENED = 1.25

#: Published licence notices, by SPDX identifier. Each line of a
#: document, and each whole document, is compared with them.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"],
    "GPL-3.0-only": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC"],
}

#: Whole texts of short licences as published.
TEXTS = {
    "MIT": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    "ISC": """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
""",
}


#: Whole texts of longer licences as published, a file each, named by SPDX identifier.
LONG_TEXTS = {p.stem: p for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}

#: What follows this line in a licence's file tells how to apply it, and may be left out.
_END = "END OF TERMS AND CONDITIONS"


def whole_texts() -> list[tuple[str, str]]:
    """(license_id, text) of all known whole texts, the longer ones also up to the end of their terms."""
    found = list(TEXTS.items())
    for name, path in LONG_TEXTS.items():
        text = path.read_text(encoding="utf-8")
        found += [(name, text)] + [(name, text[: text.index(_END)] + part) for part in (_END, "") if _END in text]
    return found


def _body(text: str) -> str:
    """A whole text without what may be left out: a short one's title, and what follows a long one's terms."""
    title, _, rest = text.partition("\n\n")
    text = rest if title in ("MIT License", "ISC License", "BSD 2-Clause License", "BSD 3-Clause License") else text
    return text.partition(_END)[0]


def _any_of(text: Column, signs: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(s)) for s in signs])


def _flat(line: Column) -> Column:
    """A lower-cased line without what a copyright line says, its words of letters and digits joined by single spaces."""
    bare = F.when(_any_of(line, COPYRIGHT_SIGNS), F.regexp_replace(line, COPYRIGHT_LINE, " ")).otherwise(line)
    return F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " "))


def _flats(text: str) -> Column:
    """The flat form of every line of a text."""
    return F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\r?\n"), _flat)


def _joined(flats: str) -> Column:
    return F.array_join(F.filter(flats, lambda f: f != ""), " ")


def _spelt(form: Column) -> Column:
    """A flat form in one spelling."""
    spelt = reduce(lambda t, pair: F.regexp_replace(t, *pair), SPELLINGS, form)
    return F.when(_any_of(form, SPELT), spelt).otherwise(form)


def with_digest(texts: DataFrame, text: str, longest: int | None = None) -> DataFrame:
    """The table's other columns with `scope`, `n` and `digest`: length and SHA-256 of canonical forms.

    One row for the whole text (scope `text`) and one for each line (`line`). The
    form has no copyright lines, is lower-cased, in one spelling, and has words
    of letters and digits joined by single spaces; that of a text is joined from
    its lines. Units that can't have a form of `longest` characters or fewer are
    left out. Spellings are replaced only where one occurs.
    """
    others = [F.col(c) for c in texts.columns if c != text]
    flat = texts.select(*others, _flats(text).alias("__flats"))
    whole = _joined("__flats")
    unit = lambda scope, form: F.struct(F.lit(scope).alias("scope"), form.alias("form"))
    units = F.concat(F.array(unit("text", whole)), F.transform("__flats", lambda f: unit("line", f)))
    rows = flat.select(*others, F.explode(units).alias("__u")).select(*others, "__u.scope", F.col("__u.form").alias("__form"))
    if longest is not None:
        rows = rows.where(F.length("__form") <= int(SHORTENED * longest) + 1)
    told = rows.withColumn("__form", _spelt(F.col("__form")))
    return told.select(*others, "scope", F.length("__form").alias("n"), F.sha2(F.col("__form").cast("binary"), 256).alias("digest"))


def known_digests(spark: SparkSession, notices: dict[str, list[str]] | None = None, texts: dict[str, str] | None = None) -> DataFrame:
    """(license_id, n, digest) of the fixed texts; as many rows as they have."""
    listed = [(k, t) for k, ts in (NOTICES if notices is None else notices).items() for t in ts]
    whole = whole_texts() if texts is None else list(texts.items())
    listed += whole + [(k, _body(t)) for k, t in whole if texts is None]
    told = with_digest(spark.createDataFrame(listed, "license_id string, text string"), "text")
    return told.where("scope = 'text'").drop("scope").distinct()


def known_runs(spark: SparkSession) -> DataFrame:
    """(license_id, run) of the whole texts' bodies in canonical form; as many rows as they have."""
    told = spark.createDataFrame([(k, _body(t)) for k, t in whole_texts()], "license_id string, text string")
    return told.select("license_id", _spelt(_joined(_flats("text"))).alias("run")).distinct()


def _anchor(words: Column, at: Column) -> Column:
    """Hash of the words from a place on, as many as an anchor has."""
    return F.xxhash64(*[F.get(words, at + k) for k in range(ANCHOR)])


def known_anchors(spark: SparkSession) -> list[tuple[str, str, int, int, str]]:
    """(license_id, first word, hash of the first words, number of words, digest) of every known body."""
    words = F.split("run", " ")
    told = known_runs(spark).select("license_id", F.get(words, F.lit(0)), _anchor(words, F.lit(0)), F.size(words), _sha("run"))
    return [tuple(r) for r in told.collect()]  # a constant list


def _sha(form: str | Column) -> Column:
    return F.sha2((F.col(form) if isinstance(form, str) else form).cast("binary"), 256)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), the value computed once and not for every element of a lambda within."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _run_digests(form: Column, anchors: list[tuple[str, str, int, int, str]]) -> Column:
    """Digests of the runs of words in a canonical text that begin as a known body does and are as long.

    A place is looked at if its word begins a body, its anchor's hash is one of
    theirs and the text is long enough: then the words that the body would be are
    digested. Whether they are the body is for the join with the known digests.
    """
    firsts = sorted({first for _, first, *_ in anchors})
    known = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(n).alias("n")) for h, n in sorted({(h, n) for _, _, h, n, _ in anchors})])

    def in_words(words: Column) -> Column:
        begins = F.filter(F.transform(words, lambda w, i: F.when(w.isin(firsts), i)), lambda i: i.isNotNull())

        def at(i: Column) -> Column:
            fit = _with(_anchor(words, i), lambda own: F.filter(known, lambda a: (a["h"] == own) & (i + a["n"] <= F.size(words))))
            return F.transform(fit, lambda a: _sha(F.array_join(F.slice(words, i + 1, a["n"]), " ")))

        return F.flatten(F.transform(begins, at))

    return _with(F.split(form, " "), in_words)


def _units(docs: DataFrame, digests: list[str], anchors: list[tuple[str, str, int, int, str]]) -> DataFrame:
    """(row, doc_id, scope, digest) of the documents' units whose digest is a known one.

    The canonical form of each line is made once, that of the text from its
    lines, and all units are told within the row, so only those that are known
    become rows.
    """
    row = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", _flats("text").alias("__flats"))
    row = row.select("row", "doc_id", "__flats", _spelt(_joined("__flats")).alias("__whole"))
    unit = lambda scope: lambda d: F.struct(F.lit(scope).alias("scope"), d.alias("digest"))
    lines = F.transform(F.filter("__flats", lambda f: f != ""), lambda f: _sha(_spelt(f)))
    told = [F.array(unit("text")(_sha("__whole"))), F.transform(lines, unit("line"))]
    if anchors:
        told.append(F.transform(_run_digests(F.col("__whole"), anchors), unit("run")))
    known = F.filter(F.concat(*told), lambda u: u["digest"].isin(digests))
    return row.select("row", "doc_id", F.inline(known))


def license_matches(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(doc_id, license_id, scope, n_units): the licences that a document's units equal in canonical form.

    Scope `text` is the whole document, scope `line` each of its lines, scope
    `run` (without a `known` of the caller's) the body of a licence's whole text
    as a run of words that may begin and end within lines and go over any number
    of them; runs within a line or a text that is such a whole text itself are
    not told again. n_units counts the equal units over all rows with that
    doc_id, null among them.
    Null, empty and unmatched texts give no row; repeated rows add up; an empty
    table gives an empty one; extra columns are ignored. The known digests are a
    constant list, so they are sent to every task and no text is shuffled.
    """
    spark = docs.sparkSession
    anchors = known_anchors(spark) if known is None else []
    wholes = set() if known is not None else {r.digest for r in known_digests(spark, {}).collect()}
    known = known_digests(spark) if known is None else known
    listed = {(r.license_id, "unit", r.digest, r.digest in wholes) for r in known.select("license_id", "digest").collect()}
    listed |= {(a[0], "run", a[4], False) for a in anchors}
    if not listed:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("license_id", "string"), ("scope", "string"), ("n_units", "long"))]
        return docs.select("doc_id", *nothing).where(F.lit(False))
    table = spark.createDataFrame(sorted(listed), "license_id string, kind string, digest string, whole boolean")
    found = _units(docs.where("text is not null").select("doc_id", "text"), sorted({d for _, _, d, _ in listed}), anchors)
    kind = F.when(F.col("scope") == "run", "run").otherwise("unit")
    met = found.withColumn("kind", kind).join(F.broadcast(table), ["kind", "digest"])
    count = lambda scope, also=F.lit(True): F.count_if((F.col("scope") == scope) & also)
    per_row = met.groupBy("row", "doc_id", "license_id").agg(
        count("text").alias("text"), count("line").alias("line"), count("run").alias("run"),
        # A text of one line is one place, however often it is told.
        F.greatest(count("text", F.col("whole")), count("line", F.col("whole"))).alias("own"),
    )
    runs = F.greatest(F.col("run") - F.col("own"), F.lit(0).cast("long"))
    scopes = F.array(*[F.struct(F.lit(s).alias("scope"), n.alias("n")) for s, n in (("text", F.col("text")), ("line", F.col("line")), ("run", runs))])
    units = per_row.select("doc_id", "license_id", F.inline(scopes)).where("n > 0")
    return units.groupBy("doc_id", "license_id", "scope").agg(F.sum("n").alias("n_units"))
