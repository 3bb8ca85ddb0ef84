"""Functions over small groups, streamed: a task sorts its rows by group and goes through them once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame


def _same(rows: pd.DataFrame, keys: list[str], other: pd.Series) -> pd.Series:
    """Whether each row has the keys of ``other``; nulls are equal to each other."""
    same = pd.Series(True, index=rows.index)
    for k in keys:
        same &= rows[k].isna() if pd.isna(other[k]) else rows[k] == other[k]
    return same


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by ``keys``, cut anew so that no group lies in two of them."""
    held: list[pd.DataFrame] = []  # the rows of the group that the last batch ended in
    for batch in batches:
        if batch.empty:
            continue
        tail = _same(batch, keys, batch.iloc[-1])
        cut = len(batch) - int(tail.sum())
        if cut or (held and not _same(held[-1].iloc[:1], keys, batch.iloc[-1]).all()):
            yield pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
            held = []
        held.append(batch.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)


def map_groups(df: DataFrame, keys: list[str], spread: list[Column | str], run: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``run`` over frames of whole groups of equal ``keys``, many groups a frame, in the order of the keys.

    ``spread`` deals groups to tasks and must be a function of the keys.
    Unlike a grouped map, where each group costs a call, a call handles what
    an Arrow batch holds, and a task holds a batch and one group at a time.
    """

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, keys):
            yield run(rows)

    return df.repartition(*spread).sortWithinPartitions(*keys).mapInPandas(stream, schema)
