"""Benchmark: every registered query over whole tables, plus parse rates.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line.  Each query is planned and run once after one warm-up job
that starts the Python workers; results go to a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from vitrine.operators.links import page_links
from vitrine.operators.products import extract_products
from vitrine.plans import rendered
from vitrine.plans.queries import BASE, QUERIES, RULES
from vitrine.session import build_session, spread
from vitrine.sources.htmltree import Keep
from vitrine.sources.pages import load_pages
from vitrine.sources.parse import parse_pages


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    start = time.perf_counter()
    run(make())
    return time.perf_counter() - start


def rates(spark, folder: str) -> dict[str, float]:
    """Pages per second: parse only, links, and the whole record."""
    pages = load_pages(spark, f"{folder}/pages.parquet")
    n_pages = pages.count()
    items = rendered.product_pages(spread(spark.read.parquet(f"{folder}/part.parquet"), "p_partkey"))
    n_items = items.count()
    return {
        "parse_only_pages_per_sec": n_pages / timed(lambda: parse_pages(pages, Keep())),
        "all_nodes_pages_per_sec": n_pages / timed(lambda: parse_pages(pages)),
        "links_pages_per_sec": n_pages / timed(lambda: page_links(pages, BASE)),
        "record_pages_per_sec": n_items / timed(lambda: extract_products(items, RULES, as_of="2025-01-01")),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]", shuffle_partitions=cpus, **{"spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["h1_names"](spark, folder))
    only = sys.argv[1:] or list(QUERIES)
    times = {name: round(timed(lambda: QUERIES[name](spark, folder)), 3) for name in only}
    result = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder).removeprefix("sf"),
        "cores": cpus,
        "rates": {k: round(v, 1) for k, v in rates(spark, folder).items()},
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
