"""Linear steps over long arrays and texts inside one row, with DataFrame expressions only.

A fold that appends to its state copies it each time, which is quadratic. Here a fold runs
inside blocks of BLOCK elements, and the blocks are joined by a second, short fold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements of a block, and code points of a piece of text.
BLOCK, PIECE = 256, 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not once for each element of a lambda inside."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blocks(values: str) -> Column:
    """The array of a column cut into arrays of BLOCK elements; empty for an empty one.

    Elements are taken by place: ``slice`` would read the whole array for each block.
    """
    n = F.size(values)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(BLOCK)), lambda b: b < n)
    return F.transform(starts, lambda b: F.transform(F.sequence(b + 1, F.least(b + BLOCK, n)), lambda i: F.element_at(values, i)))


def inner_prefixes(values: str, combine: Callable[[Column, Column], Column]) -> Column:
    """For each block of an integer column its running combinations, from its own first element; input for ``prefixes``."""
    def fold(block: Column) -> Column:
        empty = F.array().cast("array<int>")
        return F.aggregate(block, empty, lambda s, x: F.concat(s, F.array(F.when(F.size(s) > 0, combine(F.element_at(s, -1), x)).otherwise(x))))

    return F.transform(blocks(values), fold)


def prefixes(inner: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running combinations of the whole integer array from those of its blocks; ``combine`` is associative with 0 neutral."""
    carry = F.aggregate(inner, F.array(F.lit(0)), lambda s, b: F.concat(s, F.array(combine(F.element_at(s, -1), F.element_at(b, -1)))))
    return F.flatten(F.zip_with(inner, F.slice(carry, F.lit(1), F.size(inner)), lambda b, c: F.transform(b, lambda v: combine(c, v))))


def pieces(text: Column) -> Column:
    """The text in pieces of PIECE code points, input for ``between``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def between(parts: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to before ``end``, 0-based; reads only the pieces that hold them."""
    first = (start / PIECE).cast("int")
    near = F.transform(F.sequence(first + 1, ((end - 1) / PIECE).cast("int") + 1), lambda k: F.element_at(parts, k))
    return F.when(end > start, F.substring(F.array_join(near, ""), start - first * PIECE + 1, end - start)).otherwise(F.lit(""))
