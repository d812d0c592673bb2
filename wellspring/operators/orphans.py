"""References to records that do not exist (at the time of the reference).

Parents are range-partitioned by key and each range is kept as sorted arrays;
references are sent to their range, probed in vectorised batches by binary
search, and misses are aggregated per table and month.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.session import cut

PARENTS_PER_RANGE = 50_000
REFERENCES_PER_TASK = 250_000
FOREVER = np.iinfo(np.int64).max


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _disjoint(keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted validity intervals, overlapping ones of a key merged; empty intervals dropped."""
    real = start < end
    keys, start, end = keys[real], start[real], end[real]
    order = np.lexsort((start, keys))
    keys, start, end = keys[order], start[order], end[order]
    if not len(keys):
        return keys, start, end
    first = np.r_[True, keys[1:] != keys[:-1]]
    group = np.cumsum(first) - 1
    # running maximum of the ends within a key: ranks of the ends, lifted by group
    ends, rank = np.unique(end, return_inverse=True)
    reach = np.maximum.accumulate(rank + group * len(ends)) - group * len(ends)
    reach = ends[reach]
    opens = first | np.r_[True, start[1:] > reach[:-1]]
    at = np.flatnonzero(opens)
    last = np.r_[at[1:] - 1, len(keys) - 1]
    return keys[at], start[at], reach[last]


def _alive(keys, start, end, ref_keys, ref_time) -> np.ndarray:
    """For each reference whether an interval of its key holds its time."""
    if not len(keys):
        return np.zeros(len(ref_keys), bool)
    names, of = np.unique(keys, return_inverse=True)
    times, at = np.unique(start, return_inverse=True)
    joint = of.astype(np.int64) * (len(times) + 1) + at + 1
    place = np.searchsorted(names, ref_keys)
    place[place == len(names)] = 0
    known = names[place] == ref_keys
    probe = place.astype(np.int64) * (len(times) + 1) + np.searchsorted(times, ref_time, side="right")
    found = np.searchsorted(joint, probe, side="right") - 1
    inside = (found >= 0) & known
    found[found < 0] = 0
    return inside & (of[found] == place) & (ref_time < end[found])


def _bytes(column) -> np.ndarray:
    return np.array(column.cast(pa.binary()).to_pylist(), dtype="S")


def find_orphans(references: DataFrame, parents: DataFrame, row_id: str, key: str, time: str, valid_from: str, valid_to: str) -> DataFrame:
    """References ``(row_id, key, time)`` that no parent ``(key, from, to)`` covers.

    ``key`` is a string column on both sides.  A parent holds from ``valid_from``
    (inclusive) to ``valid_to`` (exclusive; null: forever).  References with a
    null key or time are no cases; a null ``valid_from`` never holds.  Repeated
    references each count; repeated parents count once.  An empty parent table
    makes every reference with a key an orphan.  Other columns of both tables
    are ignored, so clashing names do no harm.  Returns ``row_id, key, time``.

    No task holds more than one range of parents and about
    ``REFERENCES_PER_TASK`` references: a range with more is salted, and its
    parents (of bounded size, hot keys merged to disjoint intervals) repeated.
    """
    spark = references.sparkSession
    refs = references.select(
        F.col(row_id).cast("long").alias("row_id"), F.col(key).alias("key"), F.col(time).alias("time")
    ).filter("key is not null and time is not null")
    own = parents.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("key"),
        _micros(F.col(valid_from)).alias("start"),
        F.coalesce(_micros(F.col(valid_to)), F.lit(int(FOREVER))).alias("end"),
    )
    ranges = max(1, -(-own.count() // PARENTS_PER_RANGE))

    def as_arrays(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        keys, start, end = _disjoint(_bytes(table["key"].combine_chunks()), table["start"].to_numpy(), table["end"].to_numpy())
        if len(keys):
            yield pa.RecordBatch.from_pydict({
                "lo": [keys[0].decode()],
                "keys": pa.array([[k.decode() for k in keys]], pa.list_(pa.string())),
                "starts": pa.array([start.tolist()], pa.list_(pa.int64())),
                "ends": pa.array([end.tolist()], pa.list_(pa.int64())),
            })

    # a hot key would fill one range: its repeated and nested intervals collapse before
    slim = own.groupBy("key", "start").agg(F.max("end").alias("end"))
    ordered = slim.repartitionByRange(ranges, "key").sortWithinPartitions("key", "start")
    stored = cut(ordered.mapInArrow(as_arrays, "lo string, keys array<string>, starts array<long>, ends array<long>"))
    bounds = sorted(r.lo for r in stored.select("lo").collect())  # one per range of 50,000 parents
    edges = np.array([b.encode() for b in bounds], dtype="S") if bounds else np.array([], dtype="S1")

    def to_range(batches):
        for b in batches:
            place = np.searchsorted(edges, _bytes(b.column("key")), side="right") - 1 if b.num_rows else np.array([], int)
            yield b.append_column("range", pa.array(np.maximum(place, 0).astype(np.int32)))

    if not bounds:
        return refs
    # how many references each range gets, from counts per distinct key
    load = refs.groupBy("key").count().mapInArrow(to_range, "key string, count long, range int").groupBy("range").agg(F.sum("count").alias("n")).collect()
    share = {r["range"]: max(1, -(-r["n"] // REFERENCES_PER_TASK)) for r in load}
    plan = F.broadcast(spark.createDataFrame([(i, b, int(share.get(i, 1))) for i, b in enumerate(bounds)], "range int, lo string, salts int"))
    kind = dict(refs.dtypes)["time"]
    located = refs.mapInArrow(to_range, f"row_id long, key string, time {kind}, range int").join(plan.drop("lo"), "range")
    located = located.withColumn("salt", F.pmod(F.xxhash64("row_id", "time"), F.col("salts")).cast("int")).drop("salts")
    copies = stored.join(plan, "lo").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("lo", "salts")

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.select(["row_id", "key", "time"])
        if not left.num_rows or not right.num_rows:
            return left
        keys = np.concatenate([np.array([k.encode() for k in x], dtype="S") for x in right["keys"].to_pylist()])
        start = np.concatenate([np.array(x, np.int64) for x in right["starts"].to_pylist()])
        end = np.concatenate([np.array(x, np.int64) for x in right["ends"].to_pylist()])
        time = left["time"].combine_chunks().cast(pa.timestamp("us", tz=getattr(left.schema.field("time").type, "tz", None))).cast(pa.int64()).to_numpy()
        alive = _alive(keys, start, end, _bytes(left["key"].combine_chunks()), time)
        return left.filter(pa.array(~alive))

    return located.groupBy("range", "salt").cogroup(copies.groupBy("range", "salt")).applyInArrow(
        probe, f"row_id long, key string, time {kind}"
    )


def count_by_month(orphans: DataFrame, rows: DataFrame, group: list[str], time: str) -> DataFrame:
    """Orphans and all references with a key, per ``group`` and month, with the rate."""
    month = F.date_format(F.col(time), "yyyy-MM").alias("month")
    bad = orphans.groupBy(*group, month).agg(F.count(F.lit(1)).alias("n_orphans"))
    return (
        rows.groupBy(*group, month).agg(F.count(F.lit(1)).alias("n_rows"))
        .join(bad, [*group, "month"], "left")
        .withColumn("n_orphans", F.coalesce("n_orphans", F.lit(0)).cast("long"))
        .withColumn("orphan_rate", F.round(F.col("n_orphans") / F.col("n_rows"), 6))
    )
