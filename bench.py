"""Benchmark: the pipeline's headline jobs on the test data.

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit",
"queries": {name: seconds}, "sf", ...}.  Inputs: $BENCH_SF_DIR (default
/root/testdata/sf0.1), cores $BENCH_CPUS (default 8).  One warm-up pass of
the whole set runs first; each timing is the median of $BENCH_REPEAT runs
(5), except the day-by-day replay of all days, which runs once.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyvault.operators import mart as M  # noqa: E402
from tallyvault.operators import quality as Q  # noqa: E402
from tallyvault.operators import upsert as U  # noqa: E402
from tallyvault.operators import vault as V  # noqa: E402
from tallyvault.plans import pipeline as P  # noqa: E402
from tallyvault.plans.storage import parquet_persister, scratch_path  # noqa: E402
from tallyvault.session import build_session  # noqa: E402
from tallyvault.sources import fixture  # noqa: E402


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    tx = fixture.transactions(spark, sf_dir)
    cur = fixture.currencies(spark, sf_dir)
    state: dict = {}

    def vault_backfill():
        path = scratch_path(spark, "bench", uuid.uuid4().hex[:8], "vault")
        state["vault"] = V.build_vault(tx, cur, persist=parquet_persister(path))

    def mart_reference():
        _noop(M.global_metrics(state["vault"]))

    def mart_per_transaction():
        _noop(M.global_metrics(state["vault"], rate_mode="per_transaction"))

    def mart_upsert_day():
        if "mart_path" not in state:
            state["mart_path"] = scratch_path(spark, "bench", uuid.uuid4().hex[:8], "mart")
            U.upsert_table(spark, state["mart_path"], M.global_metrics(state["vault"]))
        last = state["vault"]["s_transactions"].agg({"ds": "max"}).first()[0]
        U.upsert_table(spark, state["mart_path"], M.global_metrics(state["vault"], ds_from=last, ds_to=last))

    def dq_report():
        v = state["vault"]
        _noop(Q.quality_report(v, tx, cur, M.global_metrics(v)))

    sources = {"transactions": tx, "currencies": cur}
    days = P.days_between(*tx.agg(F.min("transaction_dt").cast("date"), F.max("transaction_dt").cast("date")).first())
    daily = scratch_path(spark, "bench", uuid.uuid4().hex[:8], "daily")
    P.backfill(spark, daily, sources, days[0], days[-2])
    P.stage_day(spark, daily, sources, days[-1])

    def vault_day():
        P.load_vault_day(spark, daily, days[-1], replace_slice=True)

    def mart_day():
        P.load_mart_day(spark, daily, days[-1])

    def replay_all_days():
        P.run_range(spark, scratch_path(spark, "bench", uuid.uuid4().hex[:8], "replay"), sources, days[0], days[-1])

    jobs = [vault_backfill, mart_reference, mart_per_transaction, mart_upsert_day, dq_report, vault_day, mart_day]
    for job in jobs:                       # warm-up (JIT, codegen caches)
        job()
    times: dict[str, float] = {}
    for job in jobs:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            job()
            runs.append(time.perf_counter() - t0)
        times[job.__name__] = round(statistics.median(runs), 3)
    t0 = time.perf_counter()
    replay_all_days()
    times["replay_all_days"] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "repeat": repeat,
        "rows": {"transactions": tx.count()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
