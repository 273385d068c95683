"""Order statistics of rolling windows: how much of a window lies below a value, in log n steps a row.

A window function would need a list of n values for each row. Here a task reads its keys' rows in order,
in Arrow batches, and holds no more than a block of them and the n - 1 rows before it. The block's values
are replaced by their ranks, which a wavelet matrix sorts bit by bit: after each bit the number, and the
sum, of a range's values below any rank are differences of two running totals. All rows of a block go
through the bits together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

#: Rows that are worked on together, at least (and no fewer than the window's).
BLOCK_ROWS = 16_384


def below(ranks: np.ndarray, weights: np.ndarray, first: np.ndarray, last: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query: how many of ranks[first:last] are below its limit, and the sums of their weights (rows of integers)."""
    count, total = np.zeros(len(first), np.int64), np.zeros((len(weights), len(first)), np.int64)
    for bit in reversed(range(max(int(ranks.max(initial=0)), int(limit.max(initial=0))).bit_length())):
        zero = (ranks >> bit) & 1 == 0
        zeros, sums = _totals(zero), _totals(np.where(zero, weights, 0))
        a, b = zeros[first], zeros[last]
        up = (limit >> bit) & 1 == 1
        count += np.where(up, b - a, 0)
        total += np.where(up, sums[:, last] - sums[:, first], 0)
        first, last = np.where(up, first - a + zeros[-1], a), np.where(up, last - b + zeros[-1], b)
        ranks, weights = np.concatenate([ranks[zero], ranks[~zero]]), np.concatenate([weights[:, zero], weights[:, ~zero]], axis=1)
    return count, total


def _totals(x: np.ndarray) -> np.ndarray:
    """Running totals along the last axis, from 0."""
    out = np.zeros((*x.shape[:-1], x.shape[-1] + 1), np.int64)
    np.cumsum(x, axis=-1, out=out[..., 1:])
    return out


def _fixed(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """y as two rows of integers and their units: whole running totals fit 64 bits and lose nothing that a double shows."""
    room = 61 - len(y).bit_length()
    unit = np.ldexp(1.0, int(np.frexp(np.abs(y).max())[1]) - room)
    high = np.rint(y / unit)
    units = np.array([unit, np.ldexp(unit, -room) or unit])
    return np.stack([high, np.rint((y - high * unit) / units[1])]).astype(np.int64), units


Measure = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def mean_deviation(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Mean absolute distance of x[first:last] from its mean, for each of the (equally long) windows.

    The distances above the mean add up to as much as those below it: twice what lies below is enough.
    """
    fine = np.isfinite(x)
    bad = np.concatenate([[0], np.cumsum(~fine)])
    shift = x[fine].mean() if fine.any() else 0.0
    y = np.where(fine, x - shift, 0.0)
    n = last - first
    parts, units = _fixed(y)
    upto = _totals(parts)
    mean = units @ (upto[:, last] - upto[:, first]) / n
    levels, ranks = np.unique(y, return_inverse=True)
    count, total = below(ranks, parts, first, last, np.searchsorted(levels, mean))
    total = units @ total
    since = np.maximum.accumulate(np.where(np.append(True, y[1:] != y[:-1]), np.arange(len(y)), 0))
    flat = since[last - 1] <= first  # exactly 0, whatever the running totals have lost
    return np.where(bad[last] > bad[first], np.nan, np.where(flat, 0.0, np.maximum(2 * (mean * count - total) / n, 0.0)))


def percent_below(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Percent of x[first:last] below the last of it; NaN is above all numbers."""
    _, ranks = np.unique(x, return_inverse=True)
    count, _ = below(ranks, np.empty((0, len(x)), np.int64), first, last, ranks[last - 1])
    return 100 * count / (last - first)


class _Blocks:
    """Values of keys in order, and the measure of the last n at each place (null where fewer, or one is null)."""

    def __init__(self, n: int, measure: Measure) -> None:
        self.n, self.measure = n, measure
        self.key: object = self  # none yet: equal to no key
        self.before = np.empty(0), np.empty(0, bool)

    def next(self, keys: pa.Array, values: pa.Array) -> pa.Array:
        codes = keys.dictionary_encode(null_encoding="encode")
        code = codes.indices.to_numpy(zero_copy_only=False)
        there = pc.is_valid(values).to_numpy(zero_copy_only=False)
        x = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
        if codes.dictionary[int(code[0])].as_py() == self.key:
            held, held_there = self.before
        else:
            held, held_there = np.empty(0), np.empty(0, bool)
        x, there, k = np.concatenate([held, x]), np.concatenate([held_there, there]), len(held)
        new = np.append(True, code[1:] != code[:-1])
        start = np.concatenate([np.zeros(k, np.int64), np.maximum.accumulate(np.where(new, np.arange(len(code)) + k, 0))])
        start[start == k] = 0  # the first key goes on from the block before
        last = np.arange(k, len(x)) + 1
        first = last - self.n
        nulls = np.concatenate([[0], np.cumsum(~there)])
        full = first >= start[k:]
        full[full] = nulls[last[full]] == nulls[first[full]]
        out = np.zeros(len(code))
        if full.any():
            out[full] = self.measure(x, first[full], last[full])
        tail = max(int(start[-1]), len(x) - self.n + 1)
        self.key, self.before = codes.dictionary[int(code[-1])].as_py(), (x[tail:], there[tail:])
        return pa.array(out, mask=~full)


def with_rolling(df: DataFrame, key: str, time: str, value: str, n: int, measure: Measure, name: str) -> DataFrame:
    """df with the measure of the last n values of each key, in order of time, as a column of doubles.

    Keys are dealt to tasks and sorted there, as by a window over (key, time).
    """
    schema = StructType([*df.schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, held, rows = _Blocks(n, measure), [], 0

        def done() -> Iterator[pa.RecordBatch]:
            made = blocks.next(*(pa.concat_arrays([b.column(c) for b in held]) for c in (key, value)))
            at = 0
            for b in held:
                yield b.append_column(name, made.slice(at, b.num_rows))
                at += b.num_rows

        for b in batches:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
            if rows >= max(BLOCK_ROWS, n):
                yield from done()
                held, rows = [], 0
        if held:
            yield from done()

    return df.repartition(key).sortWithinPartitions(key, time).mapInArrow(run, schema)
