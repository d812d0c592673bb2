"""Percentiles of very large columns with a guaranteed relative error.

Values are counted in signed logarithmic buckets of fixed relative width.
Counts of equal buckets add up, so sketches of partitions or days combine by a
sum; a percentile is the middle of the bucket that holds its rank, and differs
from the exact order statistic by at most the stated share of its value.

A sketch is a row ``by, *keys, feature, buckets, counts``.  Every task counts its
own rows before anything is shuffled; what moves is sorted bucket numbers and
counts, not values.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR = 0.01
SHIFT = 1 << 20  # beyond the bucket number of any double
INFINITE = 1 << 21
WIDTH = 1 << 23  # numbers a bucket can have, with its sign
TASK_ROWS = 200_000  # rows counted at once
MERGE_ENTRIES = 2_000_000  # bucket counts merged at once


def _gamma(error: float) -> float:
    return (1 + error) / (1 - error)


def bucket_of(v: np.ndarray, error: float) -> np.ndarray:
    """Signed bucket numbers, increasing with the value; 0 for zero. No NaN allowed."""
    with np.errstate(divide="ignore"):
        size = np.log(np.abs(v)) / math.log(_gamma(error))
    size = np.where(np.isfinite(size), np.ceil(np.where(np.isfinite(size), size, 0)) + SHIFT, INFINITE)
    return np.where(v == 0, 0, np.sign(v) * size).astype(np.int64)


def value_of(number: np.ndarray, error: float) -> np.ndarray:
    """The value that is within ``error`` of every value of a bucket."""
    size = np.abs(number)
    power = np.where(size == INFINITE, 0, size - SHIFT)
    with np.errstate(over="ignore"):
        middle = np.exp(power * math.log(_gamma(error)) + math.log(2 / (1 + _gamma(error))))
    middle = np.where(size == INFINITE, np.inf, np.minimum(middle, np.finfo(float).max))
    return np.where(number == 0, 0.0, np.sign(number) * middle)


def _lists(joint: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Sorted ``group * WIDTH + bucket`` with counts -> groups and one list of buckets and counts for each."""
    group, number = joint // WIDTH, joint % WIDTH - WIDTH // 2
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    ends = pa.array(np.r_[start, len(group)].astype(np.int32))
    return group[start], pa.ListArray.from_arrays(ends, pa.array(number.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int64)))


def _fields(df: DataFrame, keys: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{k}` {kinds[k]}" for k in keys)


def count_values(df: DataFrame, keys: list[str], groupings: dict[str, list[str]], values: list[str], error: float = ERROR, open_keys: tuple[str, ...] = ()) -> DataFrame:
    """Sketches of each task's rows for every grouping: ``by, *keys, feature, buckets, counts``.

    ``groupings`` names lists of keys; keys outside a grouping come out null, and
    rows with a null key of a grouping are left out of it, save ``open_keys``
    (such as a day), where null is a key of its own.  Null and NaN values are left out; infinite values get buckets of their own.  An empty
    table gives an empty result.
    """
    rows = df.select(*keys, *[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)])
    names = ["by", *keys, "feature", "buckets", "counts"]

    def count(table: pa.Table):
        code = {}
        for k in keys:
            d = table[k].combine_chunks().dictionary_encode(null_encoding="encode")
            code[k] = (d.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(d.dictionary), table[k].is_null().to_numpy())
        columns = [table[f"v{i}"].to_numpy() for i in range(len(values))]
        buckets = []
        for x in columns:
            real = ~np.isnan(x)
            buckets.append((real, bucket_of(np.where(real, x, 0.0), error)))
        for by, own in groupings.items():
            joint = np.zeros(table.num_rows, np.int64)
            keep = np.ones(table.num_rows, bool)
            for k in own:
                joint = joint * code[k][1] + code[k][0]
                if k not in open_keys:
                    keep &= ~code[k][2]
            _, first, group = np.unique(joint, return_index=True, return_inverse=True)
            packed = [((group * len(values) + i) * WIDTH + b + WIDTH // 2)[real & keep] for i, (real, b) in enumerate(buckets)]
            groups, numbers, counts = _lists(*np.unique(np.concatenate(packed), return_counts=True))
            at = table.select(keys).take(pa.array(first[groups // len(values)])).combine_chunks()
            cells = [at[k].combine_chunks() if k in own else pa.nulls(len(groups), at[k].type) for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array([by] * len(groups), pa.string()), *cells, pa.array(np.array(values, object)[groups % len(values)], pa.string()), numbers, counts], names=names)

    def run(batches):
        kept, n = [], 0
        for b in batches:
            kept.append(b)
            n += b.num_rows
            if n >= TASK_ROWS:
                yield from count(pa.Table.from_batches(kept))
                kept, n = [], 0
        if n:
            yield from count(pa.Table.from_batches(kept))

    return rows.mapInArrow(run, f"by string, {_fields(df, keys)}, feature string, buckets array<int>, counts array<long>")


def combine(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of several parts or days added up to ``keys``; the result is a sketch again.

    One shuffle of sketches; a task adds up sorted sketches as they come and
    never holds more than ``MERGE_ENTRIES`` counts and one group's buckets.
    """
    order = ["by", *keys, "feature"]
    rows = sketches.select(*order, "buckets", "counts").repartition(*order).sortWithinPartitions(*order)
    names = [*order, "buckets", "counts"]

    def add(table: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        b, n = table["buckets"].combine_chunks(), table["counts"].combine_chunks()
        each = np.repeat(group, np.diff(b.offsets.to_numpy()))
        joint = each * WIDTH + b.flatten().to_numpy() + WIDTH // 2
        packed, place = np.unique(joint, return_inverse=True)
        total = np.zeros(len(packed), np.int64)
        np.add.at(total, place, n.flatten().to_numpy())
        _, numbers, counts = _lists(packed, total)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        head = table.select(order).take(pa.array(first))
        return pa.RecordBatch.from_arrays([*(head[k].combine_chunks() for k in order), numbers, counts], names=names)

    def groups_of(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, bool)
        for k in order:
            d = table[k].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            change[1:] |= d[1:] != d[:-1]
        return np.cumsum(change)

    def run(batches):
        kept, n = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            kept.append(b)
            n += len(b.column("buckets").flatten())
            if n >= MERGE_ENTRIES:
                table = pa.Table.from_batches(kept)
                merged = add(table, groups_of(table))
                if merged.num_rows > 1:
                    yield merged.slice(0, merged.num_rows - 1)
                kept = [pa.RecordBatch.from_arrays([merged.column(c).take(pa.array([merged.num_rows - 1])) for c in names], names=names)]  # the last group may go on
                n = len(kept[0].column("buckets").flatten())
        if kept:
            table = pa.Table.from_batches(kept)
            yield add(table, groups_of(table))

    return rows.mapInArrow(run, f"by string, {_fields(sketches, keys)}, feature string, buckets array<int>, counts array<long>")


def percentiles(combined: DataFrame, keys: list[str], at: list[float], names: list[str], error: float = ERROR) -> DataFrame:
    """``by, *keys, feature, n, *names``: the order statistics of rank ``floor(q * (n - 1))``."""
    head = ["by", *keys, "feature"]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            b = batch.column("buckets")
            ends = b.offsets.to_numpy()
            ends = ends - ends[0]
            number, upto = b.flatten().to_numpy(), np.cumsum(batch.column("counts").flatten().to_numpy())
            upto = np.r_[0, upto]
            before = upto[ends[:-1]]
            total = upto[ends[1:]] - before
            found = [value_of(number[np.searchsorted(upto[1:], before + np.floor(q * (total - 1)), side="right")], error) for q in at]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in head), pa.array(total), *map(pa.array, found)], names=[*head, "n", *names])

    schema = f"by string, {_fields(combined, keys)}, feature string, n long, " + ", ".join(f"`{x}` double" for x in names)
    return combined.mapInArrow(run, schema)
