"""Materializing intermediate tables in the shared checkpoint folder.

Lineage is cut by writing Parquet (not ``localCheckpoint``): a written
table survives the loss of any executor, and later reads get column
pruning and predicate pushdown.  The folder is the one the cluster names
in ``spark.checkpoint.dir``; tests get a scratch folder only when unset.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, *parts: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = spark.conf.get("tallyvault.run.id", None)
    if not run:
        run = uuid.uuid4().hex[:12]
        spark.conf.set("tallyvault.run.id", run)
    return "/".join([base, f"tallyvault-{run}", *parts])


def write_read(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` (overwrite) and return the stored table.

    The read names the schema, so a write of no rows reads back as no rows.
    """
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Hadoop file system, no data read
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern meets, in order."""
    fs, p = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or ())


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written beside, then renamed."""
    fs, p = _path(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}-{uuid.uuid4().hex[:8]}")  # noqa: SLF001
    out = fs.create(beside)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(beside, p)


def has_days(spark: SparkSession, path: str, column: str = "ds") -> bool:
    """Whether a table's folder holds a day partition (one without rows has none)."""
    fs, p = _path(spark, f"{path}/{column}=*")
    return len(fs.globStatus(p) or ()) > 0


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own tables, if it is there."""
    fs, p = _path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def bytes_of(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder, 0 without one."""
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def clear_days(spark: SparkSession, table_path: str, days, column: str = "ds") -> None:
    """Empty the day partitions of a table: a dynamic overwrite leaves days without new rows as they were."""
    for day in days:
        remove(spark, f"{table_path}/{column}={day.isoformat()}")


def parquet_persister(path: str, partition_by: dict[str, list[str]] | None = None):
    """``persist`` callback for ``build_vault``: write to ``path/<name>``."""
    def persist(name: str, df: DataFrame) -> DataFrame:
        return write_read(df, f"{path}/{name}", (partition_by or {}).get(name))
    return persist
