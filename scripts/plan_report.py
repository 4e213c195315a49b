"""Summarise the physical plans of the main stages (exchanges, scans, joins).

Usage: python scripts/plan_report.py [sf_dir]  -> markdown on stdout
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from rankbeam.config import EVENT_ORDER, LABEL, SPLIT, Config  # noqa: E402
from rankbeam.operators import clean as cl  # noqa: E402
from rankbeam.operators import dataset as ds  # noqa: E402
from rankbeam.operators import features as ft  # noqa: E402
from rankbeam.operators import ranking as rk  # noqa: E402
from rankbeam.plans import job, sinks  # noqa: E402
from rankbeam.session import local_session, scratch_path  # noqa: E402
from rankbeam.sources import shard_tree  # noqa: E402


def summary(df) -> list[str]:
    qe = df._jdf.queryExecution()
    text = qe.executedPlan().toString()
    out = []
    for line in text.splitlines():
        s = line.strip().lstrip(":+- ").strip()
        if re.match(r"(\*\(\d+\) )?(Exchange|BroadcastExchange|SortMergeJoin|BroadcastHashJoin|"
                    r"ShuffledHashJoin|FileScan|Scan|MapInPandas|Window|HashAggregate|ObjectHashAggregate)", s):
            s = re.sub(r"#\d+L?", "", s)
            s = re.sub(r"\[plan_id=\d+\]", "", s)
            s = re.sub(r"Location: [^,]*,?", "", s)
            s = re.sub(r", PartitionFilters: \[\]", "", s)
            out.append(s[:230])
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    cfg = Config()
    raw = shard_tree.write_lineitem_tree(spark, sf_dir, num_files=16)
    man = job.prepare(spark, raw, cfg)
    inp = job.load_inputs(spark, raw, man, cfg)
    out = scratch_path(spark, "plans")
    inter_lazy = cl.preprocess(inp.log, inp.items, inp.users, cfg)
    sections = [("preprocess (interactions sink, O1 global sort)", cl.sort_by_order(inter_lazy))]
    sinks.write_interactions(inter_lazy, out + "/inter")
    inter = spark.read.parquet(out + "/inter")
    b = ft.split_bounds(inter, cfg)
    feats = ft.build_aggregates(inter, b, cfg)
    sections.append(("user features (rolled up from (user, author) partials)", feats.user))
    sections.append(("item features (rolled up from (author, item) partials)", feats.item))
    d, _ = ds.assemble(inter, feats, b, cfg, inp.vectors, layout=True)
    sections.append(("dataset (broadcast joins, early range layout)", d))
    val = ft.temporal_split(inter.where(ft.split_predicate(b, ("val", "test"))), b)
    m = rk.ranking_metrics(val.withColumn("score", F.col("watch_ratio")), ["user_id"], LABEL, "score",
                           EVENT_ORDER, by=[SPLIT])
    sections.append(("ranking metrics, all k, val+test (one range exchange + partials)", m))
    print(f"# Plan report ({sf_dir}, adapter B, static plans with AQE off)\n")
    print("Generated by `scripts/plan_report.py`. Lines kept: scans, exchanges, joins, aggregates,")
    print("windows and Python map stages, in plan order (top = last operator).\n")
    for title, df in sections:
        print(f"## {title}\n\n```")
        for line in summary(df):
            print(line)
        print("```\n")
    feats.release()


if __name__ == "__main__":
    main()
