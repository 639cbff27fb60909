"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The driver's tables are first staged as Parquet, untimed.  Every query is run once to warm up and
then $BENCH_RUNS times; its time is the median.  Results go to a sink that discards rows, except for
the full refresh, which writes the six model tables and checks them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from conformance import fixtures as fx  # noqa: E402
from conformance import queries as registered  # noqa: E402
from tenderloom.plans import catalog, dimensions, facts, refresh, reports  # noqa: E402
from tenderloom.schemas import AWARD_LINES, BUYERS, SUPPLIERS  # noqa: E402
from tenderloom.session import local_session, work_folder  # noqa: E402
from tenderloom.sources.tables import load_folder, read_models, read_staging  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")

    staged_at, model_at = work_folder(spark, "bench-staging"), work_folder(spark, "bench-model")
    start = time.time()
    for name, df in fx.staging(spark, sf_dir).items():
        folder = load_folder(f"{staged_at}/{name}", "bench")
        df.repartition(spark.sparkContext.defaultParallelism).write.parquet(folder)
    staging_sec = round(time.time() - start, 3)
    st = read_staging(spark, staged_at)
    lines, bid_lines = st["stg_lineas_carteles"], st["stg_lineas_ofertadas"]
    awards, procedures = st["stg_lineas_adjudicadas"], st["stg_procedimientos_adjudicacion"]

    queries = {
        "full_refresh": lambda: refresh.full_refresh(spark, st, model_at),
        "supplier_buyer_ranking": lambda: registered.supplier_buyer_ranking(spark, sf_dir),
        "awards_by_buyer_for_supplier": lambda: registered.awards_by_buyer_for_supplier(spark, sf_dir),
        "top_buyers_by_month": lambda: registered.top_buyers_by_month(spark, sf_dir),
        "model_supplier_buyer_ranking": lambda: reports.supplier_buyer_ranking(
            *read_models(spark, model_at, AWARD_LINES, BUYERS, SUPPLIERS)
        ),
        "model_awards_by_buyer": lambda: reports.model_awards_by_buyer(spark, model_at, "7"),
        "model_top_buyers": lambda: reports.model_top_buyers(spark, model_at, 1996, 1),
        "latest_line": lambda: facts.latest_tender_lines(lines),
        "latest_award_line": lambda: facts.latest_award_lines(awards),
        "build_supplier_dim": lambda: dimensions.supplier_dimension(st["stg_proveedores"]),
        "build_buyer_dim": lambda: dimensions.buyer_dimension(st["stg_instituciones"]),
        "build_product_catalog": lambda: catalog.product_catalog(lines, bid_lines, awards, procedures),
        "build_tender_lines": lambda: facts.tender_line_fact(lines, st["stg_carteles"]),
        "build_bid_lines": lambda: facts.bid_line_fact(bid_lines, st["stg_ofertas"]),
        "build_award_lines": lambda: facts.award_line_fact(awards, procedures),
    }

    def seconds(query) -> float:
        start = time.time()
        query().write.format("noop").mode("overwrite").save()
        return time.time() - start

    times = {}
    for name, query in queries.items():
        seconds(query)
        times[name] = round(statistics.median(seconds(query) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "sum of median warm query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
                "staging_sec": staging_sec,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
