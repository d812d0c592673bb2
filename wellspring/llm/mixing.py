"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern of the public byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_ROWS = 2_000


def count_tokens(documents: DataFrame, doc_id: str, source: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, n_tokens`` by a public tokenizer; a null text has none."""
    with open(tokenizer, "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(f.read())  # a fixed file of under 1 MB

    def run(batches):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        coder = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [0 if t is None else len(coder.encode_ordinary(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(n, pa.int64())], names=["doc_id", "source", "n_tokens"])

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, source string, n_tokens long")


def plan_rates(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """Per source with a target: ``target_share, max_repeats, n_docs, available, goal, rate``.

    ``rate`` is the expected copies of each document.  The total is the largest
    that lets every source with documents keep its share (in relation to the
    others) within ``max_repeats``, unless ``total_tokens`` is given; then a
    source that would need more is held at ``max_repeats``.  Sources without
    documents or tokens have the rate 0, as have shares of 0 and null.
    """
    have = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("available"))
    plan = targets.select("source", "target_share", "max_repeats").filter("source is not null").join(have, "source", "left").fillna(0, ["n_docs", "available"])
    usable = (F.col("available") > 0) & (F.coalesce("target_share", F.lit(0.0)) > 0) & (F.coalesce("max_repeats", F.lit(0)) > 0)
    plan = plan.withColumn("share", F.when(usable, F.col("target_share")))
    everything = Window.partitionBy()  # one row per source of the targets
    plan = plan.withColumn("share", F.col("share") / F.sum("share").over(everything))
    reach = F.col("max_repeats") * F.col("available") / F.col("share")
    total = F.min(reach).over(everything) if total_tokens is None else F.lit(float(total_tokens))
    plan = plan.withColumn("goal", F.coalesce(total * F.col("share"), F.lit(0.0)))
    rate = F.when(F.col("goal") > 0, F.least(F.col("goal") / F.nullif(F.col("available"), F.lit(0)), F.col("max_repeats").cast("double"))).otherwise(F.lit(0.0))
    return plan.withColumn("rate", rate).drop("share")


def draw(sizes: DataFrame, plan: DataFrame, seed: int = 11) -> DataFrame:
    """``doc_id, source, n_tokens, copies`` for the documents chosen, systematically within each source.

    Documents are put in a fixed random order of blocks and by size within a
    block, so that every stretch holds all sizes.  The expected copies are summed
    up along that order, one random offset is added, and a document gets one
    copy per integer that its sum crosses: the rate rounded up or down, never
    more than ``max_repeats``.  Sums run within blocks and over the blocks'
    totals; no task holds a source.
    """
    rows = sizes.join(F.broadcast(plan.select("source", "rate", "max_repeats")), "source").filter("rate > 0")  # as many rows as targets
    blocks = max(1, -(-sizes.count() // BLOCK_ROWS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(blocks)))
    inside = F.sum("rate").over(Window.partitionBy("source", "block").orderBy("n_tokens", "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    counts = rows.groupBy("source", "block").agg(F.sum("rate").alias("sum"))
    before = F.sum("sum").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.withColumn("before", F.coalesce(before, F.lit(0.0))).select("source", "block", "before")
    offset = F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(1_000_003)) / 1_000_003
    placed = rows.withColumn("inside", F.coalesce(inside, F.lit(0.0))).join(starts, ["source", "block"])
    low = F.col("before") + F.col("inside") + offset
    # rounding of long sums must not tip a boundary
    copies = F.floor(low + F.col("rate") + 1e-7) - F.floor(low + 1e-7)
    return placed.withColumn("copies", F.least(copies, F.col("max_repeats").cast("long")).cast("int")).filter("copies > 0").select("doc_id", "source", "n_tokens", "copies")


def shares(plan: DataFrame, drawn: DataFrame) -> DataFrame:
    """The shares reached, per source of the targets."""
    got = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("n_used"), F.sum("copies").alias("n_copies"), F.max("copies").alias("most_copies"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"))
    out = plan.join(got, "source", "left").fillna(0, ["n_used", "n_copies", "most_copies", "tokens"])
    return out.withColumn("actual_share", F.round(F.try_divide("tokens", F.sum("tokens").over(Window.partitionBy())), 6)).withColumn("rate", F.round("rate", 6)).withColumn("goal", F.round("goal"))


def mix(documents: DataFrame, targets: DataFrame, doc_id: str, source: str, text: str, tokenizer: str = TOKENIZER, total_tokens: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row per copy: ``doc_id, source, copy, n_tokens``; the report of :func:`shares`)."""
    sizes = cut(count_tokens(documents, doc_id, source, text, tokenizer))
    plan = cut(plan_rates(sizes, targets, total_tokens))
    drawn = draw(sizes, plan)
    rows = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", "source", "copy", "n_tokens")
    return rows, shares(plan, drawn)
