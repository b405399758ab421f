"""Extract checkpoints: one small JSON document per saved page."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import CHECKPOINT


def scan_checkpoint(spark: SparkSession, prefix: str) -> DataFrame | None:
    """The newest checkpoint under ``prefix`` (names sort by their timestamp), or
    None when there is none (the caller then runs a full extract). Only a missing
    folder means "none": an unreadable or corrupt checkpoint raises."""
    try:
        df = (spark.read.schema(CHECKPOINT).option("recursiveFileLookup", "true").option("mode", "FAILFAST")
              .json(prefix).withColumn("_file", F.input_file_name()))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    newest = df.orderBy(F.col("_file").desc()).limit(1).drop("_file")
    return newest if newest.limit(1).count() else None
