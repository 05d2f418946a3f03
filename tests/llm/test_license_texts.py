"""Whole licence texts, alone and within longer documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawldelta.llm import licenses
from tests.llm.test_operators import rows


def test_whole_texts_alone_and_among_other_lines(spark):
    mit, texts = licenses.TEXTS["MIT"], {k: p.read_text() for k, p in licenses.LONG_TEXTS.items()}
    commented = "/*\n" + "\n".join(f" * {line}" for line in ["Copyright (c) 2020 Me", *mit.splitlines()]) + "\n */\nint main() {}\n"
    body = mit.split("\n\n", 1)[1]
    data = list(enumerate(texts.values())) + [
        (100, commented), (101, f"Intro.\n\n{body}\n{body}\nAfter."), (102, "Intro " + licenses.TEXTS["ISC"].replace("\n", "\n\n")),
        (103, "x\n" + " ".join(mit.split())), (104, body), (105, "README\n" + texts["BSD-2-Clause"] + "\nmore"), (106, mit[:-60]), (107, None),
    ]
    found = rows(licenses.license_matches(spark.createDataFrame(data, "doc_id long, text string").withColumn("run", F.lit(1))))
    want = [(i, k, "text", 1) for i, k in enumerate(texts)]
    want += [(100, "MIT", "run", 1), (101, "MIT", "run", 2), (102, "ISC", "run", 1), (103, "MIT", "line", 1), (104, "MIT", "text", 1)]
    assert found == sorted([*want, (105, "BSD-2-Clause", "run", 1)], key=repr)
    assert {"Apache-2.0", "BSD-3-Clause", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0"} <= set(texts)
