"""Headline timings as one JSON line.

The steps follow the life of the data: load raw rows, refresh the stored model, then
answer measures and report visuals from it; last, whole queries from the driver tables.
Each timed read runs once to warm up and then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillmark.operators import measures, normalise, report, star  # noqa: E402
from tillmark.plans import measure_store  # noqa: E402
from tillmark.plans.catalog import QUERIES  # noqa: E402
from tillmark.plans.model import refresh_model  # noqa: E402
from tillmark.session import local_session  # noqa: E402
from tillmark.sources import fixtures, sinks  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "tillmark-bench")
    work = tempfile.mkdtemp(prefix="tillmark-bench-")
    seconds: dict[str, float] = {}

    def once(name, action):
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    def median(name, build):
        build().collect()
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            build().collect()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)

    # The raw sheet rows exist before the load, as the workbook does.
    fixtures.raw_sales_line(spark, sf_dir).repartition(int(cpus)).write.parquet(f"{work}/raw")
    raw = spark.read.parquet(f"{work}/raw")

    def load():
        mapped = normalise.map_source_columns(raw, keep=["SourceRowId"])
        sinks.write_load(normalise.normalise_lines(mapped), f"{work}/load")

    once("raw_load", load)
    loaded = star.standardized_fact(sinks.read_load(spark, f"{work}/load", "loaded"))
    once("model_refresh_cold", lambda: refresh_model(loaded, f"{work}/model"))
    once("model_refresh_warm", lambda: refresh_model(loaded, f"{work}/model2"))
    model = refresh_model(loaded, f"{work}/model3")

    median("product_dimension", lambda: star.dim_product(model.fact))
    # Report queries run on a model held in memory, as in the figures they compare with.
    fact = model.fact.coalesce(int(cpus)).persist()
    fact.count()
    store = model.measures.in_memory(int(cpus))
    median("ten_measures_all", lambda: measure_store.store_measures(store))
    median("ten_measures_country", lambda: measure_store.store_country(store, "NATION_2"))
    median("ten_measures_month", lambda: measure_store.store_month(store, "1996-11"))
    median("ten_measures_all_lines", lambda: measures.measures_by(fact))
    median("visual_default_page", lambda: report.net_sales_by(fact, "Country"))
    median("visual_country_filter", lambda: report.monthly_net_sales(report.slicer_filter(fact, {"Country": ["NATION_2"]})))
    median("visual_month_filter", lambda: report.net_sales_by(report.slicer_filter(fact, {"YearMonth": ["1996-11"]}), "Country"))
    for name in ("base_metrics_all", "metrics_all_slices", "net_sales_by_product", "sales_mom_pct", "rls_scope_summary",
                 "anomaly_report", "reconcile_slices"):
        median(name, lambda: QUERIES[name](spark, sf_dir))

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
