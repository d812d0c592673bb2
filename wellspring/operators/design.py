"""Plate layouts: how many plates, where the controls go, which compound lies in which well."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.functions.keys import well_label
from wellspring.operators.stats import number_rows


@dataclass(frozen=True)
class Layout:
    rows: int = 8
    columns: int = 12
    negative_share: float = 0.10
    positive_share: float = 0.05
    replicates: int = 2
    positives: int = 2
    controls: str = "edge"  # edge first, random, or uniform steps over the plate
    seed: int = 1

    @property
    def wells(self) -> int:
        return self.rows * self.columns

    @property
    def negative(self) -> int:
        return math.floor(self.wells * self.negative_share + 0.5)

    @property
    def positive(self) -> int:
        return math.floor(self.wells * self.positive_share + 0.5)

    @property
    def per_plate(self) -> int:
        return max(1, (self.wells - self.negative - self.positive) // self.replicates)


# Fewest controls of a plate.
LEAST_CONTROLS = {"neg": 6, "pos": 4}


def wells_of(spark: SparkSession, layout: Layout, plates: int) -> DataFrame:
    """Every well of every plate with its place: first those for controls (``layout.controls``), then the others in a fixed random order."""
    grid = spark.range(plates * layout.wells).select((F.floor(F.col("id") / layout.wells) + 1).cast("int").alias("plate"), (F.col("id") % layout.wells).cast("int").alias("ix"))
    grid = grid.withColumn("row", (F.floor(F.col("ix") / layout.columns) + 1).cast("int")).withColumn("column", (F.col("ix") % layout.columns + 1).cast("int"))
    edge = (F.col("row").isin(1, layout.rows) | F.col("column").isin(1, layout.columns)).cast("int")
    order = F.md5(F.concat_ws(":", F.lit(layout.seed), F.col("plate"), F.col("ix")))
    held = layout.negative + layout.positive
    steps = [min(layout.wells - 1, math.floor(i * layout.wells / held + 0.5)) for i in range(held)] if held else []
    uniform = F.array_position(F.array(*[F.lit(i) for i in steps]), F.col("ix")) if steps else F.lit(0)
    first = {"edge": [edge.desc()], "uniform": [F.when(uniform > 0, uniform).otherwise(F.lit(len(steps) + 1))], "random": []}[layout.controls]
    place = F.row_number().over(Window.partitionBy("plate").orderBy(*first, order, "ix")) - 1
    return grid.withColumn("place", place).withColumn("well", well_label(F.col("row"), F.col("column")))


def plate_layout(compounds: DataFrame, compound: str, layout: Layout = Layout()) -> DataFrame:
    """``plate, well, row, column, type, label, replicate``: compounds in order, ``replicates`` of each on one plate.

    Each plate's first places hold the negative and then the positive controls
    (``PC_i`` in equal numbers, what is left over stays empty); the other places
    take the plate's compounds in random order.  Repeated and null names count
    once and not at all; without compounds there are no plates.
    """
    spark = compounds.sparkSession
    names = compounds.select(F.col(compound).alias("label")).filter("label is not null").distinct()
    numbered = number_rows(names, ["label"], "k")
    total = numbered.count()
    plates = -(-total // layout.per_plate)
    wells = wells_of(spark, layout, plates)
    slot = F.col("place") - layout.negative - layout.positive
    free = wells.filter(slot >= 0).withColumn("slot", F.row_number().over(Window.partitionBy("plate").orderBy(F.md5(F.concat_ws(":", F.lit(layout.seed), F.lit("slot"), F.col("plate"), F.col("ix"))), "ix")) - 1)
    placed = numbered.withColumn("plate", (F.floor(F.col("k") / layout.per_plate) + 1).cast("int")).withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(layout.replicates))))
    placed = placed.withColumn("slot", ((F.col("k") % layout.per_plate) * layout.replicates + F.col("replicate") - 1).cast("int"))
    cells = free.join(placed.select("plate", "slot", "label", "replicate"), ["plate", "slot"], "left").select("plate", "well", "row", "column", F.when(F.col("label").isNotNull(), "cmpd").otherwise("empty").alias("type"), "label", "replicate")
    each = layout.positive // layout.positives if layout.positives else 0
    rank = F.col("place") - layout.negative
    negative = wells.filter(F.col("place") < layout.negative).select("plate", "well", "row", "column", F.lit("neg").alias("type"), F.lit("DMSO").alias("label"), (F.col("place") + 1).alias("replicate"))
    held = rank < each * layout.positives
    positive = wells.filter((rank >= 0) & (rank < layout.positive)).select(
        "plate", "well", "row", "column", F.when(held, "pos").otherwise("empty").alias("type"),
        F.when(held, F.concat(F.lit("PC_"), (F.floor(rank / max(each, 1)) + 1).cast("string"))).alias("label"), F.when(held, rank % max(each, 1) + 1).alias("replicate"),
    )
    return cells.unionByName(negative).unionByName(positive)


def as_platemap(layout: DataFrame) -> DataFrame:
    """The layout in the columns that the platemap reader expects; empty wells left out."""
    return layout.filter("type <> 'empty'").select(F.concat(F.lit("P"), F.lpad(F.col("plate").cast("string"), 2, "0")).alias("Metadata_Plate"), F.col("well").alias("Metadata_Well"), F.col("label").alias("Metadata_Perturbation"), F.col("type").alias("well_type"))


def control_warnings(layout: DataFrame) -> DataFrame:
    """``plate, n_neg, n_pos, few_neg, few_pos``: controls per plate and whether they are fewer than they should be."""
    n = {kind: F.count_if(F.col("type") == kind) for kind in LEAST_CONTROLS}
    return layout.groupBy("plate").agg(*[n[k].alias(f"n_{k}") for k in n], *[(n[k] < least).alias(f"few_{k}") for k, least in LEAST_CONTROLS.items()])
