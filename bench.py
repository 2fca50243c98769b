"""Time the registered queries on the driver's tables and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyframes.catalog.queries import QUERIES  # noqa: E402
from skyframes.session import local_session  # noqa: E402

HEADLINE = [
    "s01_capture_range_scan", "p01_request_validate", "p07_color_rule", "w03_bilateral", "w05_edge_pixels",
    "a01_pixel_hits", "g03_regions", "a04_region_rb_sum", "g05_final_mask", "u04_sun_detect",
    "j02_day_pair_match", "u05_sun_pairs", "t03_parabola_fit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), stages=tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM and the Python workers before the clock does
    QUERIES["g01_components"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
                "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rpartition("sf")[2],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
