"""Helpers shared by the training-data operators.

Intermediate tables are written as Parquet below ``spark.checkpoint.dir`` (through
:func:`stored`), so a lost executor re-reads files instead of losing state.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..plans.storage import scratch_path

#: The six ASCII white-space characters, the separators of words.
WHITESPACE = " \t\n\x0b\x0c\r"
_WS_RUN = "[ \\t\\n\\x0B\\f\\r]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package's Python files, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch space and return the stored table."""
    path = scratch_path(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written within drops its shuffle files with the write; Spark else keeps them until the driver collects garbage.

    For tables that are planned and stored within: a result that is returned and may be run twice is planned outside.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def map_frames(rows: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``mapInPandas`` that keeps 64-bit ids whole: a long column with a null becomes Int64, where pandas alone makes it float."""
    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)

    def frame(batch: pa.RecordBatch) -> pd.DataFrame:
        out = batch.to_pandas()
        for field, column in zip(batch.schema, batch.columns):
            if pa.types.is_int64(field.type) and column.null_count:
                out[field.name] = column.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        return out

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(map(frame, batches)):
            yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    return rows.mapInArrow(mapped, schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(col: str | Column = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, _UPPER, _UPPER.lower())


def words(col: Column) -> Column:
    """Maximal runs of non-white-space; an empty array for a text without words."""
    return F.filter(F.split(col, _WS_RUN), lambda w: F.length(w) > 0)


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns of ``df`` as one struct, so that added columns can't clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def with_text(df: DataFrame, columns: list[str], new_text: Column, row: str = "row") -> DataFrame:
    """Unpack ``row`` with ``text`` replaced and ``n_chars``, where there is one, set to its length."""
    fresh = {"text": new_text, "n_chars": F.length(new_text).cast("long")}
    return df.select(*[(fresh[c] if c in fresh else F.col(f"{row}.`{c}`")).alias(c) for c in columns])
