"""Runs of equal keys in a sorted stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table for each run of rows with equal ``keys``; a run may span batches.

    Holds one run and one batch; callers bound their runs.
    """
    rest: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        head = tuple(c[0] for c in columns)
        new[0] = last is not None and head != last
        cuts = [*np.flatnonzero(new).tolist(), b.num_rows]
        begin = 0
        for cut in cuts[:-1]:
            if cut > begin:
                rest.append(b.slice(begin, cut - begin))
            yield pa.Table.from_batches(rest)
            rest, begin = [], cut
        rest.append(b.slice(begin))
        last = tuple(c[-1] for c in columns)
    if rest:
        yield pa.Table.from_batches(rest)


def whole_runs(batches: Iterable[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """Tables of at least ``least`` rows (the last may have fewer) that cut no run of equal ``key``."""
    rest: list[pa.RecordBatch] = []
    many = 0
    for b in batches:
        if not b.num_rows:
            continue
        rest.append(b)
        many += b.num_rows
        if many < least:
            continue
        t = pa.Table.from_batches(rest)
        column = t[key].to_numpy()
        cut = int(np.flatnonzero(column != column[-1])[-1]) + 1 if column[0] != column[-1] else 0
        if cut:
            yield t.slice(0, cut)
            rest = t.slice(cut).to_batches()
            many -= cut
    if rest:
        yield pa.Table.from_batches(rest)


def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of lists without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    at = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]], at - at[0]
