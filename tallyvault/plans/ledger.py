"""The run ledger: which steps of which day are done, as one small file per step in the storage root.

``root/ledger/ds=<day>/<step>.json`` is written, under another name first, when a step's rows are
committed.  A run that was broken off asks the ledger what is left; a step without its file is done
again, which every step of the pipeline allows (hubs and links insert what is absent, satellites
and staging replace their day, the mart merges).  Spark reads the files as a table.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession

from .storage import exists, folders, remove, write_file

SCHEMA = "step string, run string, finished_at timestamp_ntz, ds date"


class Ledger:
    def __init__(self, spark: SparkSession, root: str, run: str = "") -> None:
        self.spark, self.path, self.run = spark, f"{root.rstrip('/')}/ledger", run

    def _file(self, ds: _dt.date, step: str) -> str:
        return f"{self.path}/ds={ds.isoformat()}/{step}.json"

    def done(self, ds: _dt.date) -> set[str]:
        """Steps of a day that are done."""
        return {f.rsplit("/", 1)[1].removesuffix(".json") for f in folders(self.spark, f"{self.path}/ds={ds.isoformat()}/*.json")}

    def mark(self, ds: _dt.date, step: str) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0).isoformat()
        write_file(self.spark, self._file(ds, step), json.dumps({"step": step, "run": self.run, "finished_at": now}) + "\n")

    def forget(self, ds: _dt.date) -> None:
        """The day's steps count as not done: it will be loaded again."""
        remove(self.spark, f"{self.path}/ds={ds.isoformat()}")

    def rows(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(self.path)
