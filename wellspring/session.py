"""Session helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is taken on a single machine
    (master ``local``), and a cluster is refused: executors do not share such a
    folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-shared-"))
    return named or context.getCheckpointDir()


def cut(df: DataFrame, looping: bool = False) -> DataFrame:
    """Materialise ``df`` in the shared folder and drop its lineage.

    A checkpoint hands the partitioning of its plan on, under every name that
    joins gave it.  Where each round of a loop builds on the last (``looping``)
    those names double until planning takes longer than the work, so there a
    table is written and read instead.
    """
    folder = shared_folder(df.sparkSession)
    if not looping:
        return df.checkpoint(eager=True)
    path = f"{folder}/loop-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
