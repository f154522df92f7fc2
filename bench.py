"""Headline timings: the star build from raw tables, publishing, then the reports on the star.

Reads BENCH_SF_DIR and BENCH_CPUS; prints one JSON line. Each figure is the median of three
runs after one warm-up. ``publish_star`` publishes into an empty warehouse, ``merge_one_percent``
merges a hundredth of the events and visitors into the full tables. The queries that parse landed
JSON or run a stream take longer and run once, without a warm-up; their input is written in that
time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from reelstar import queries as q  # noqa: E402
from reelstar.operators import quality, upsert  # noqa: E402
from reelstar.plans import daily, reports  # noqa: E402
from reelstar.schemas import KEYS  # noqa: E402
from reelstar.session import build_session, scratch_dir, stored  # noqa: E402
from reelstar.sources import silver  # noqa: E402
from reelstar.sources.warehouse import Warehouse  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def seconds(action, runs: int = RUNS) -> float:
    if runs > 1:
        action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def consume(build):
    """Compute every row and column of a frame, and keep nothing."""
    return lambda: build().write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    published = Warehouse(spark, scratch_dir(spark, "warehouse"))
    silver_root = scratch_dir(spark, "silver")
    built = {
        "dim_media": q.dim_media(spark, SF_DIR),
        "dim_visitor": q.dim_visitor(spark, SF_DIR),
        q.FACT: q.fact(spark, SF_DIR),
    }

    def write_all():
        for name, df in built.items():
            silver.write_silver(df, silver_root, name)

    write_silver = seconds(write_all)
    staged = {name: silver.read_silver(spark, silver_root, name) for name in built}

    loads = {name: daily.load(name, df) for name, df in staged.items()}
    publish_star = seconds(lambda: Warehouse(spark, scratch_dir(spark, "empty")).publish(loads))
    published.publish(loads)
    tables = ("dim_visitor", q.FACT)
    part = {
        t: stored(spark, staged[t].filter(f"pmod(hash({KEYS[t]}), 100) = 0"), t) for t in tables
    }
    merge = seconds(lambda: published.publish({t: daily.load(t, df) for t, df in part.items()}))

    star = daily.published(spark, published.root)
    fact, media = star[q.FACT], star["dim_media"]
    measured = media.filter("total_plays IS NOT NULL")
    target, staging = q.upsert_sides(spark, SF_DIR)

    def run(name):
        return consume(lambda: q.all_queries()[name](spark, SF_DIR))

    timed = {
        "dim_media_build": run("dim_media_build"),
        "dim_visitor_build": run("dim_visitor_build"),
        "fact_build": run("fact_build"),
        "replay_dedup_lineitem": run("replay_dedup_lineitem"),
        "visitor_geo_latest": run("visitor_geo_latest"),
        "upsert_fact": consume(lambda: upsert.upsert(target, staging, ["event_key"])),
        "incremental_filter": run("incremental_filter"),
        "next_watermark": run("next_watermark"),
        "kpi_media": lambda: reports.kpi_media(media).collect(),
        "kpi_fact": lambda: reports.kpi_fact(fact).collect(),
        "channel_comparison": lambda: reports.channel_comparison(fact, media).collect(),
        "geo_top15": lambda: reports.geo_top(fact).collect(),
        "daily_trend": lambda: reports.daily_trend(fact, media).collect(),
        "depth_histogram": lambda: reports.depth_histogram(fact, media).collect(),
        "engagement_daily": lambda: reports.engagement_daily(fact, media).collect(),
        "top_countries": lambda: reports.top_countries(fact, media).collect(),
        "table_counts": lambda: reports.table_counts(star).collect(),
        "null_pct": lambda: quality.null_profile(fact, q.FACT, ["visitor_key"]).collect(),
        "orphan_count": lambda: quality.orphan_count(fact, measured).collect(),
        "dq_report": lambda: quality.quality_report(star).collect(),
    }
    result = {
        "write_silver": write_silver,
        "publish_star": publish_star,
        "merge_one_percent": merge,
    }
    for name, action in timed.items():
        result[name] = seconds(action)
    for name in ("json_bronze_roundtrip", "pull_and_publish", "stream_upsert", "stream_daily_trend"):
        result[name] = seconds(run(name), runs=1)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "star_build_and_reports_total",
                "value": round(sum(result.values()), 3),
                "unit": "sec",
                "queries": result,
                "sf": float(os.path.basename(SF_DIR).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
