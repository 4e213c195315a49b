"""Headline benchmark: the whole job (``job.run``, every stage with its reports, curve
and saved model) on adapter B (lineitem x orders).

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "job_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Input preparation (writing the raw shard folder in log order) is done first
and reported separately as ``input_write``; it is not part of ``value``.
Set ``BENCH_EVENT_LOG_DIR`` to an existing scratch folder to keep Spark's
event log (stage and task times) there.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    with_ranker = os.environ.get("BENCH_RANKER", "1") != "0"

    from rankbeam.config import Config
    from rankbeam.plans import job
    from rankbeam.session import local_session, scratch_path
    from rankbeam.sources import shard_tree

    extra = {}
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if log_dir:  # Spark event log (stage/task times) into a scratch folder
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="rankbeam-bench",
                          extra=extra)
    # Ranker settings of the published demo run: 10 trees, depth 6, all of them fitted.
    cfg = Config().with_model(max_iter=10, max_depth=6, metric_period=5, early_stop=False)
    times: dict[str, float] = {}

    t = time.time()
    raw = shard_tree.write_lineitem_tree(spark, sf_dir, num_files=2 * cpus)
    times["input_write"] = time.time() - t
    out = scratch_path(spark, "bench-out")

    stages = job.STAGES if with_ranker else job.STAGES[:-1]
    res = job.run(spark, raw, out, cfg, stages)
    times.update(res.seconds)

    total = sum(v for k, v in times.items() if k != "input_write")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "job_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "rows": {"interactions": int(res.stats["n_rows"]), **{k: int(v) for k, v in res.sizes.items()}},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
