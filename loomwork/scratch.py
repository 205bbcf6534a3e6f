"""Intermediate tables in the folder that driver and executors share.

The folder is the session's ``spark.checkpoint.dir``.  Where that is unset, a
local session takes a temporary folder; on a cluster that would fail late, in
some executor, so there it is an error at once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="shared-")
        base = _own[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder, in folders of ``by`` if given, and read it again.

    This cuts the lineage: a lost executor costs a read, never a recomputation.
    """
    path = shared_path(df.sparkSession, name)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
