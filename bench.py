"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

HEADLINE = [
    "tower_cluster",
    "place_tower_count",
    "place_pop_sum",
    "place_elevation",
    "place_building_partial",
    "point_n_d",
    "point_score_invsq",
    "point_pop_multi",
    "point_building_multi",
    "point_elev_rank",
    "ring_area_3395",
    "minmax_scale",
    "mlp_score",
    "greedy_placement",
]


def main() -> None:
    from siteplan.queries import QUERIES
    from siteplan.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["union_all"](spark, sf_dir).count()  # start the engine before the clock
    times = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    spark.stop()
    line = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
