"""Time the headline queries on whole tables; prints one JSON line.

The tables are first copied into as many files as there are cores, as a cluster would hold them; single files
of one row group have one split.  The copy is not timed, and goes when the bench ends.  With ``BENCH_AS_STORED=1`` the
queries are timed on the tables as they are, too (``as_stored``).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.catalog import load  # noqa: E402
from marquee.catalog.registry import TABLES  # noqa: E402
from marquee.session import build_session, release  # noqa: E402

HEADLINE = [
    "category_shares", "tag_shares", "category_months", "most_common_per_host", "ingest_summary", "dedupe_documents",
    "text_clean", "category_by_keyword", "time_parse_moment", "merge_exact", "clean_listings", "host_cadence",
    "rank_hosts", "vector_medoids", "vector_rescue_noise", "place_groups", "topic_groups", "page_events",
    "adapt_ticketmaster", "display_events",
]


def spread_copy(spark, folder: str, to: str, files: int) -> str:
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            spark.read.parquet(f"{folder}/{name}.parquet").repartition(files).write.parquet(f"{to}/{name}.parquet")
    return to


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("marquee-bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    queries, _ = load()
    scratch = tempfile.TemporaryDirectory(prefix="marquee-bench-")
    stored = folder
    name_of_sf, folder = os.path.basename(folder.rstrip("/")).removeprefix("sf"), spread_copy(spark, folder, scratch.name, int(cpus))
    # One small job brings up the JVM and the Python workers before the clock starts.
    queries["text_clean"](spark, folder).limit(10).write.format("noop").mode("overwrite").save()

    def timed(at: str) -> dict[str, float]:
        times = {}
        for name in names:
            start = time.perf_counter()
            queries[name](spark, at).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        return times

    times = timed(folder)
    more = {"as_stored": timed(stored)} if os.environ.get("BENCH_AS_STORED") else {}
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": name_of_sf,
                      "cpus": int(cpus), "spark": spark.version} | more))
    release(spark)
    spark.stop()
    scratch.cleanup()


if __name__ == "__main__":
    main()
