"""Helpers for rows that hold arrays, built of Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Entries of an array that one block of a running fold holds.
BLOCK = 128


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def indices(n: Column) -> Column:
    """0 to n - 1 as an array; empty for 0."""
    return F.slice(F.sequence(F.lit(0), n.cast("int")), 1, n.cast("int"))


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """The fold of each entry with all before it.

    A lambda cannot append to an array without copying it, so a plain fold
    would be quadratic; here each block is folded on what the blocks before it
    come to.
    """

    def of(x: Column) -> Column:
        blocks = indices(F.ceil(F.size(x) / BLOCK))

        def block(b: Column, upto: Column | None = None) -> Column:
            return F.slice(x, b * BLOCK + 1, F.lit(BLOCK) if upto is None else upto)

        totals = F.transform(blocks, lambda b: F.aggregate(block(b), zero, merge))
        carried = let(totals, lambda t: F.transform(blocks, lambda b: F.aggregate(F.slice(t, 1, b), zero, merge)))
        rows = let(carried, lambda c: F.transform(blocks, lambda b: F.transform(block(b), lambda _, i: F.aggregate(block(b, i + 1), F.get(c, b), merge))))
        return F.flatten(rows)

    return let(values, of)
