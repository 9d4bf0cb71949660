"""Time the headline queries and the whole batch run; prints one JSON line.

Every result is computed in full and discarded (``noop`` sink), so nothing is pruned away and no time
goes into showing it. ``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of cores.
``python bench.py all`` times every registered query.
"""

import json
import os
import sys
import time
import uuid

from riskloom.catalog import base, registry
from riskloom.plans import layers
from riskloom.session import local_session, work_folder
from riskloom.sources import readers

HEADLINE = """
    c01_dedup c17_transactions f_geo_flags r1_batch_score r2_enriched_score r3_geo_score r4_sensitive_score
    r6_combined_score j3_customer_summary w1_previous e1_last_day e2_month_average e4_first_use a01_monthly
    a03_by_type a05_by_customer a10_type_by_level q01_total_transactions q07_monthly_counts q16_frauds_by_period
    q18_top_merchants q20_customers_with_most_alerts q22_channel_type_matrix q36_overall_detection
    a15_m3_distances m1_flag_prevalence m5_detection_quality m8_distance_error t2_silver t4_metrics_by_type
    t5_minutes t9_transactions
""".split()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    names = list(queries) if sys.argv[1:] == ["all"] else HEADLINE

    raw = base.feed(spark, sf_dir)
    # One untimed query first, so that starting the engine is not charged to the first timed one.
    run(queries["a14_totals"](spark, sf_dir))
    counts = {}
    built = layers.Layers(f"{work_folder(spark)}/riskloom-bench-{uuid.uuid4().hex}")
    layer_seconds = {
        "bronze": timed(lambda: counts.update(bronze=layers.write_bronze(raw, built, "parquet")["rows"])),
        "silver": timed(lambda: counts.update(silver=layers.write_silver(readers.table(spark, built.bronze), built)["rows"])),
        "detection": timed(lambda: counts.update(gold=layers.write_detection(spark, built)["rows"])),
        "alerts": timed(lambda: layers.write_alerts(spark, built)),
        "reports": timed(lambda: layers.write_reports(spark, built)),
    }
    medallion = round(sum(layer_seconds.values()), 3)
    tables = timed(lambda: base.tables(spark, sf_dir))
    seconds = {name: timed(lambda n=name: run(queries[n](spark, sf_dir))) for name in names}

    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cores": cores,
        "batch_run": {
            "seconds": medallion, "rows_in": counts["bronze"], "rows_per_sec": round(counts["bronze"] / medallion),
            "rows_out": counts["gold"], "layers": layer_seconds,
        },
        "tables_written_sec": tables,
        "stream_rows_per_sec": round(counts["bronze"] / seconds["t2_silver"]) if "t2_silver" in seconds else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
