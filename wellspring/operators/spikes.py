"""Implausible readings: spikes, stuck values, impossible values.

Every series of readings (one measurement of one source) is decoded by a hidden
Markov model with the states normal, spike, stuck and out-of-range.
Forward-backward gives each reading's probability of not being normal; hard
bounds on the distance from the source's median, on runs of equal readings and
on the physical range then assign the flag.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.operators.stats import median_and_mad, number_rows
from wellspring.session import cut

NORMAL, SPIKE, STUCK, OUT = range(4)


@dataclass(frozen=True)
class SpikeRule:
    """What counts as implausible, and the model's fixed probabilities."""

    deviations: float = 6.0  # robust standard deviations that bound normal readings
    mad_scale: float = 1.4826
    run: int = 8  # equal readings in a row that count as stuck
    least: int = 20  # finite readings a series needs for spike and stuck
    repeat_when_normal: float = 0.1  # chance that a normal reading repeats its neighbour
    leave_normal: float = 1e-3
    stay: float = 0.9  # chance of staying in a faulty state
    source_rows: int = 20_000  # larger sources are decoded in chunks by several tasks
    chunk: int = 16_384
    context: int = 64  # readings before and after a chunk that warm up the recursion


def _padded(series: list[np.ndarray], fill: float) -> np.ndarray:
    out = np.full((max(map(len, series)), len(series)), fill)
    for i, x in enumerate(series):
        out[: len(x), i] = x
    return out


def abnormal_probability(series: list[np.ndarray], center: np.ndarray, scale: np.ndarray, outside: list[np.ndarray], rule: SpikeRule) -> list[np.ndarray]:
    """Forward-backward over many series at once; the probability of any faulty state.

    ``series`` are readings in order, ``scale`` the robust standard deviation,
    ``outside`` marks readings beyond the physical range.  A normal reading
    cannot lie beyond ``rule.deviations`` or outside the range.
    """
    if not series:
        return []
    lengths = np.array([len(x) for x in series])
    x = _padded(series, np.nan)
    out = _padded([o.astype(float) for o in outside], 0.0) > 0
    valid = np.arange(len(x))[:, None] < lengths
    same = np.zeros(x.shape, bool)
    same[1:] = x[1:] == x[:-1]
    held = same.copy()
    held[:-1] |= same[1:]
    with np.errstate(invalid="ignore", divide="ignore"):
        far = np.abs(x - center)
        z = np.where(far == 0, 0.0, far / scale)
        beyond = far > rule.deviations * scale
        bell = np.exp(-0.5 * np.minimum(z, 40.0) ** 2) / 2.5066
    e = np.empty((*x.shape, 4))
    e[..., NORMAL] = np.where(out | beyond, 0.0, np.maximum(bell, 1e-9) * np.where(held, rule.repeat_when_normal, 1.0))
    e[..., SPIKE] = np.where(beyond & ~out, 1e-2, 1e-12)
    e[..., STUCK] = np.where(held, np.maximum(bell, 1e-9), 1e-12)
    e[..., OUT] = np.where(out, 1.0, 1e-15)
    e[~valid] = 1.0
    leave, stay = rule.leave_normal, rule.stay
    move = np.array([[1 - 3 * leave, leave, leave, leave]] + [[1 - stay if j == 0 else stay if j == i else (1 - stay) / 10 for j in range(4)] for i in (1, 2, 3)])
    move /= move.sum(1, keepdims=True)
    steps = len(x)
    forward = np.empty_like(e)
    a = np.array([1 - 3 * leave, leave, leave, leave]) * e[0]
    forward[0] = a / a.sum(1, keepdims=True)
    for t in range(1, steps):
        a = (forward[t - 1] @ move) * e[t]
        forward[t] = a / a.sum(1, keepdims=True)
    b = np.ones_like(e[0])
    bad = np.empty(x.shape)
    back = move.T.copy()
    for t in range(steps - 1, -1, -1):
        g = forward[t] * b
        bad[t] = 1 - g[:, NORMAL] / g.sum(1)
        b = (e[t] * b) @ back
        b /= b.sum(1, keepdims=True)
    return [bad[:n, i] for i, n in enumerate(lengths)]


def _in_run(x: np.ndarray, least: int) -> np.ndarray:
    starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.array([], int)
    return np.repeat(np.diff(np.r_[starts, len(x)]) >= least, np.diff(np.r_[starts, len(x)])) if len(x) else np.zeros(0, bool)


def decode(series: list[np.ndarray], center: np.ndarray, mad: np.ndarray, outside: list[np.ndarray], rule: SpikeRule):
    """Per series: (indices flagged, their kind, their probability of being faulty)."""
    scale = rule.mad_scale * mad
    p = abnormal_probability(series, center, scale, outside, rule)
    for x, c, m, o, q in zip(series, center, mad, outside, p):
        suspect = q >= 0.5
        with np.errstate(invalid="ignore"):
            spike = suspect & ~o & (np.abs(x - c) > rule.deviations * rule.mad_scale * m)
        stuck = suspect & _in_run(x, rule.run)
        kind = np.where(o, OUT, np.where(spike, SPIKE, np.where(stuck, STUCK, NORMAL)))
        at = np.flatnonzero(kind)
        yield at, kind[at], q[at]


def _outside(x: np.ndarray, lo: float, hi: float) -> np.ndarray:
    return np.isinf(x) | (x < lo) | (x > hi)


FOUND = "row_id long, measurement string, kind string, probability double"
KINDS = np.array(["normal", "spike", "stuck", "impossible"])


def _decode_sources(bounds: dict[str, tuple[float, float]], rule: SpikeRule) -> Callable:
    """mapInArrow over rows sorted by source and time; whole sources are decoded in batches."""
    names = list(bounds)

    def emit(ids: np.ndarray, source: np.ndarray, values: np.ndarray):
        cut_at = np.r_[np.flatnonzero(np.r_[True, source[1:] != source[:-1]]), len(source)]
        series, of, center, mad, out = [], [], [], [], []
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for lo, hi in zip(cut_at[:-1], cut_at[1:]):
            for j, name in enumerate(names):
                x = values[lo:hi, j]
                at = np.flatnonzero(~np.isnan(x))
                x = x[at]
                o = _outside(x, *bounds[name])
                finite = x[np.isfinite(x)]
                if len(finite) < rule.least:
                    k = np.flatnonzero(o)
                    found.append((ids[lo + at[k]], np.full(len(k), j), np.full(len(k), OUT), np.ones(len(k))))
                    continue
                m = np.median(finite)
                series.append(x), of.append((lo + at, j)), center.append(m), mad.append(np.median(np.abs(finite - m))), out.append(o)
        for (rows, j), (at, kind, q) in zip(of, decode(series, np.array(center), np.array(mad), out, rule)):
            found.append((ids[rows[at]], np.full(len(at), j), kind, q))
        parts = [np.concatenate(x) for x in zip(*found)] if found else [np.array([], int)] * 4
        return pa.RecordBatch.from_pydict({
            "row_id": pa.array(parts[0], pa.int64()), "measurement": pa.array(np.array(names, object)[parts[1].astype(int)], pa.string()),
            "kind": pa.array(KINDS.astype(object)[parts[2].astype(int)], pa.string()), "probability": pa.array(parts[3], pa.float64()),
        })

    def run(batches):
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0
        for b in batches:
            if not b.num_rows:
                continue
            get = lambda c: b.column(c).to_numpy(zero_copy_only=False)
            kept.append((get("row_id"), get("source"), np.column_stack([get(n).astype(float) for n in names])))
            rows += b.num_rows
            if rows >= rule.source_rows:
                ids, source, values = (np.concatenate(x) for x in zip(*kept))
                whole = int(np.flatnonzero(source != source[-1])[-1]) + 1 if (source != source[-1]).any() else 0
                if whole:
                    yield emit(ids[:whole], source[:whole], values[:whole])
                kept, rows = [(ids[whole:], source[whole:], values[whole:])], len(ids) - whole
        if rows:
            yield emit(*(np.concatenate(x) for x in zip(*kept)))

    return run


def _decode_chunks(bounds: dict[str, tuple[float, float]], rule: SpikeRule) -> Callable:
    names = list(bounds)

    def run(table: pa.Table) -> pa.Table:
        p = table.select(["at", "chunk", "row_id", "source", "series", "value", "center", "mad", "n"]).sort_by("at")
        g = {c: p[c].to_numpy() for c in p.column_names}
        edge = np.flatnonzero(np.r_[True, (g["source"][1:] != g["source"][:-1]) | (g["series"][1:] != g["series"][:-1])])
        spans = list(zip(edge, np.r_[edge[1:], len(g["at"])]))
        spans = [s for s in spans if g["n"][s[0]] >= rule.least]
        series = [g["value"][a:b] for a, b in spans]
        out = [_outside(x, *bounds[names[g["series"][a]]]) for x, (a, b) in zip(series, spans)]
        rows = {"row_id": [], "measurement": [], "kind": [], "probability": []}
        for (a, b), (at, kind, q) in zip(spans, decode(series, np.array([g["center"][a] for a, _ in spans]), np.array([g["mad"][a] for a, _ in spans]), out, rule)):
            core = g["at"][a + at] // rule.chunk == g["chunk"][0]
            rows["row_id"] += g["row_id"][a + at[core]].tolist()
            rows["measurement"] += [names[g["series"][a]]] * int(core.sum())
            rows["kind"] += KINDS[kind[core]].tolist()
            rows["probability"] += q[core].tolist()
        return pa.table({"row_id": pa.array(rows["row_id"], pa.int64()), "measurement": pa.array(rows["measurement"], pa.string()), "kind": pa.array(rows["kind"], pa.string()), "probability": pa.array(rows["probability"], pa.float64())})

    return run


def _large_sources(df: DataFrame, bounds: dict[str, tuple[float, float]], rule: SpikeRule) -> DataFrame:
    """The same flags for sources of any size: distributed medians, chunks with context."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("series"), F.col(n).cast("double").alias("value")) for i, n in enumerate(bounds)]))
    long = df.select("row_id", "source", "time", cells.alias("c")).select("row_id", "source", "time", "c.series", "c.value").filter("value is not null and not isnan(value)")
    finite = long.filter(F.abs("value") < float("inf"))
    keys = ["source", "series"]
    stats = cut(median_and_mad(finite, keys, "value").withColumnRenamed("med", "center"))
    ordered = number_rows(long, [*keys, "time", "row_id"], "at")
    chunk, place = F.floor(F.col("at") / rule.chunk), F.col("at") % rule.chunk
    copies = F.array_compact(F.array(chunk, F.when(place < rule.context, chunk - 1), F.when(place >= rule.chunk - rule.context, chunk + 1)))
    spread_out = ordered.withColumn("chunk", F.explode(copies)).join(stats, keys)
    return spread_out.select("at", "chunk", "row_id", "source", "series", "value", "center", "mad", "n").groupBy("chunk").applyInArrow(_decode_chunks(bounds, rule), FOUND)


def flag_readings(df: DataFrame, row_id: str, source: Column, time: str, bounds: dict[str, tuple[float, float]], rule: SpikeRule = SpikeRule()) -> DataFrame:
    """Implausible readings of the columns in ``bounds``: ``row_id, measurement, kind, probability``.

    ``kind`` is impossible (infinite or outside the column's bounds), spike
    (further than ``deviations`` robust standard deviations from the source's
    median) or stuck (in a run of ``run`` equal readings, in order of ``time``
    and ``row_id``).  Null and NaN readings are no cases and do not interrupt a
    run.  Rows whose source is null, and series with fewer than ``least`` finite
    readings, are only tested for impossible readings.  Repeated rows count as
    rows.  A MAD of 0 makes every other value a spike.  An empty table gives an
    empty result; further columns are ignored.

    One shuffle by source; sources above ``source_rows`` rows take another way
    on which no task holds more than a chunk.
    """
    rows = df.select(F.col(row_id).cast("long").alias("row_id"), source.alias("source"), F.col(time).alias("time"), *[F.col(n).cast("double").alias(n) for n in bounds])
    large = cut(rows.filter("source is not null").groupBy("source").count().filter(F.col("count") > rule.source_rows).select("source"))
    sourced = rows.filter("source is not null")
    any_large = not large.isEmpty()
    small = sourced.join(large, "source", "left_anti") if any_large else sourced
    decoded = small.repartition("source").sortWithinPartitions("source", "time", "row_id").drop("time").mapInArrow(_decode_sources(bounds, rule), FOUND)

    def impossible(frame: DataFrame) -> DataFrame:
        tests = [F.when(F.isnan(n) | F.col(n).isNull(), None).when((F.abs(n) == float("inf")) | (F.col(n) < lo) | (F.col(n) > hi), F.lit(n)) for n, (lo, hi) in bounds.items()]
        return frame.select("row_id", F.explode(F.array_compact(F.array(*tests))).alias("measurement"), F.lit("impossible").alias("kind"), F.lit(1.0).alias("probability"))

    parts = [decoded, impossible(rows.filter("source is null"))]
    if any_large:
        hot = sourced.join(large, "source", "left_semi")
        parts += [_large_sources(hot, bounds, rule).filter("kind <> 'impossible'"), impossible(hot)]
    return reduce(DataFrame.unionByName, parts)
