"""Content-defined blocks of a text: cut where its words say so, so that an edit moves the blocks around it only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of the rolling window, and the hex digits of its hash that must be zero where a block ends:
# one place in 16 for a digit.
WINDOW = 3
ZEROS = 1


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), the value computed once and not for every element of a lambda within."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_words(text: Column) -> Column:
    """Runs of signs that are no white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def content_blocks(text: Column, window: int = WINDOW, zeros: int = ZEROS) -> Column:
    """array<struct<hash, words>>: the blocks of a text in order, each with the MD5 of its words and their number.

    A block ends after a word where the hash of the last words up to it begins
    with zeros; windows reach back over block ends, but not over the text's begin.
    """
    end = "0" * zeros

    def of_words(words: Column) -> Column:
        n = F.size(words)
        places = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        last = lambda i: F.slice(words, F.greatest(i - window + 1, F.lit(1)), F.least(i, F.lit(window)))
        cuts = F.filter(places, lambda i: (i == n) | F.md5(F.array_join(last(i), " ").cast("binary")).startswith(end))

        return _with(cuts, lambda own: F.transform(own, lambda cut, k: F.struct(
            F.md5(F.array_join(F.slice(words, _begin(own, k) + 1, cut - _begin(own, k)), " ").cast("binary")).alias("hash"),
            (cut - _begin(own, k)).cast("bigint").alias("words"),
        )))

    return _with(text_words(text), of_words)


def _begin(cuts: Column, k: Column) -> Column:
    return F.when(k > 0, F.get(cuts, k - 1)).otherwise(F.lit(0))
