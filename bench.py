"""Headline operators at scale factor 0.1 on one machine: median seconds, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from terraloom.operators import embeddings as E  # noqa: E402
from terraloom.registry import bindings as B  # noqa: E402
from terraloom.registry import graphs, models, tables  # noqa: E402,F401
from terraloom.registry.base import REGISTRY  # noqa: E402
from terraloom.session import build_session  # noqa: E402

# Name in the report -> registered query.
HEADLINE = {
    "m1_municipal_annual": "municipal_annual",
    "f6_f10_keyed_rules_report": "rule_report",
    "f6_clean_indicators": "clean_indicators",
    "a7_conflicting_keys": "conflicting_keys",
    "w1_a4_latest_pivot": "latest_pivot",
    "j8_spatial_neighbors": "spatial_neighbors",
    "g7_knowledge_graph": "knowledge_graph",
    "g9_province_neighbors": "query_province_neighbors",
    "g9_top_of_comarca": "query_top_of_comarca",
    "m3_time_features": "time_features",
    "g11_closure": "closure",
    "g10_catalog": "query_catalog",
    "e6_rank_triples": "rank_triples",
}


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    B.graph_table(spark, sf)  # graph queries read the written graph
    seconds = {}
    for name, query in HEADLINE.items():
        def run(q=REGISTRY[query].run):
            q(spark, sf).write.format("noop").mode("overwrite").save()
        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(repeats)), 3)
    links = graphs._links(spark, sf)
    extra = {
        "e4_train_transe_dim16_per_epoch": round(timed(lambda: E.train_kge(links, None, "TransE", 16, epochs=3)) / 3, 3),
        "m7_boosted_trees": round(timed(lambda: REGISTRY["boosted_trees"].run(spark, sf).write.format("noop").mode("overwrite").save()), 3),
    }
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "reported_separately": extra, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
