"""Tables saved together: readers see all of a version or the version before.

Every save writes its tables to a folder of its own, then one row to the manifest. The row
appears when its job commits, so a job that dies earlier leaves the version before in place.
Earlier versions stay until their folders are removed; the manifest names the latest.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "version long, folder string"


def _latest(spark: SparkSession, path: str) -> tuple[int, str] | None:
    try:
        row = (spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
               .orderBy(F.desc("version"), F.desc("folder")).first())
    except AnalysisException:                      # nothing saved with a manifest
        return None
    return (row["version"], row["folder"]) if row else None


def save_together(spark: SparkSession, path: str, tables: Mapping[str, DataFrame]) -> None:
    """Write all ``tables`` below ``path`` as its next version."""
    path = path.rstrip("/")
    before = _latest(spark, path)
    folder = f"version-{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.parquet(f"{path}/{folder}/{name}")
    version = (before[0] if before else 0) + 1
    (spark.createDataFrame([(version, folder)], _MANIFEST).coalesce(1)
     .write.mode("append").parquet(f"{path}/manifest"))


def saved_folder(spark: SparkSession, path: str) -> str:
    """The folder of the latest whole version; ``path`` itself where there is no manifest."""
    path = path.rstrip("/")
    latest = _latest(spark, path)
    return f"{path}/{latest[1]}" if latest else path
