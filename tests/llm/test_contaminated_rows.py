"""Contaminated rows that share their doc_id, or the lack of one, with clean rows."""

from __future__ import annotations

from crawldelta.llm import decontam


def test_clean_rows_with_the_same_id_stay(spark):
    item = "one two three four five six seven eight"
    data = [(None, f"x {item} y"), (None, "clean"), (None, None), (1, item), (1, "clean too"), (2, item), (2, item)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    left = decontam.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(map(tuple, left.collect()), key=repr) == sorted([(None, "clean"), (None, None), (1, "clean too")], key=repr)
    assert decontam.contained_items(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).columns == ["doc_id", "item_id", "containment"]
