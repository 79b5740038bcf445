"""Bench the warehouse the way it is used.

* ``full_refresh``: stage the four inputs, gate, build the star schema, gate
  (every table written under the shared scratch folder);
* analyst reports over the written warehouse (as the notebooks query the
  production tables);
* the flagship, the whole fact and the top-5 report recomputed from the raw
  and the top-5 report this way).

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1). Each
item runs once to warm up (``first_runs``: these include measuring the
inputs for broadcasts), then ``$BENCH_REPS`` times (median reported);
queries execute fully into Spark's ``noop`` sink. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rangewise.plans import registry  # noqa: E402
from rangewise.plans import reports as R  # noqa: E402
from rangewise.plans.model import load  # noqa: E402
from rangewise.plans.refresh import refresh  # noqa: E402
from rangewise.session import local_session  # noqa: E402
from rangewise.sources.fixtures import raw_tables  # noqa: E402

WAREHOUSE_REPORTS = {
    "known_area_counts": lambda s, w: R.known_area_counts(w),
    "observers_per_year": lambda s, w: R.observers_per_year(w),
    "dd_out_of_range_top5": lambda s, w: R.dd_out_of_range_top5(w),
    "species_top_observers": lambda s, w: R.species_top_observers(w),
    "obs_per_taxon": lambda s, w: R.obs_per_taxon(w),
    "hist_day": lambda s, w: R.hist_day(s, w),
    "obs_by_category": lambda s, w: R.obs_by_category(w),
    "out_of_range_share": lambda s, w: R.out_of_range_share(w),
}
FROM_RAW = ["known_area_counts", "species_observations", "dd_out_of_range_top5"]


COLD = {}


def _timed(name, fn, reps):
    t0 = time.perf_counter()
    fn()  # warm-up
    COLD[name] = round(time.perf_counter() - t0, 3)
    out = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t0)
    return statistics.median(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "16")))
    times = {}

    roots = []

    def do_refresh():
        roots.append(refresh(spark, raw_tables(spark, sf_dir)).root)

    times["full_refresh"] = _timed("full_refresh", do_refresh, max(1, reps - 1))
    w = load(spark, roots[-1])
    for name, fn in WAREHOUSE_REPORTS.items():
        times[f"wh_{name}"] = _timed(
            f"wh_{name}", lambda fn=fn: fn(spark, w).write.format("noop").mode("overwrite").save(), reps)
    qs = registry.queries()
    for name in FROM_RAW:
        times[f"raw_{name}"] = _timed(
            f"raw_{name}", lambda name=name: qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save(),
            reps)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "warehouse_refresh_plus_reports_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "first_runs": COLD,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
