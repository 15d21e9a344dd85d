"""Headline timings: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs on fresh input and is forced with a full aggregation of
its output (no driver collect of rows).  "value" is the sum of the query
times.  Throughput per stage is reported in "rates".
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from duoweave.plans import catalog  # noqa: E402
from duoweave.session import local_session  # noqa: E402

HEADLINE = [
    "corpus_pairs",      # pages -> extract -> route -> align -> numbered pairs (flagship)
    "keep_failed",       # fetch log -> validity, usability, extraction of raw test pages
    "page_blocks",       # raw test pages -> paragraph blocks
    "fallback_layout",   # fallback layout extraction and labelling
    "clean_lines",       # every line of every document cleaned
    "language_label",    # script share per block
    "greedy_merge",      # vector alignment with greedy merge on embeddings
    "seed_expand",       # hub expansion by link cells
    "discovery",         # link discovery report
    "idle_streak",       # scroll stop rule report
    "api_items",         # paged JSON listing -> items and URLs
    "api_audit",         # listing completeness audit
]


def force(df) -> int:
    """Run the whole plan; return the row count (hash of every column too)."""
    cols = [F.col(c) for c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash(*cols)).alias("h")).collect()[0]
    return int(row["n"])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    times, rows = {}, {}
    force(catalog.QUERIES["page_title"](spark, sf_dir))  # warm-up: JVM, codegen caches
    errors = {}
    for name in HEADLINE:
        t0 = time.time()
        try:
            rows[name] = force(catalog.QUERIES[name](spark, sf_dir))
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - record and go on, one JSON line always
            times[name] = None
            errors[name] = str(e)[:300]
    pages = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).count()
    raw_pages = spark.read.parquet(os.path.join(sf_dir, "pages.parquet")).count()

    def rate(n, name):
        return round(n / times[name], 1) if times.get(name) else None

    rates = {
        "corpus_pages_per_s": rate(pages, "corpus_pairs"),
        "corpus_pairs_per_s": rate(rows.get("corpus_pairs", 0), "corpus_pairs"),
        "raw_pages_per_s": rate(raw_pages, "keep_failed"),
        "api_items_per_s": rate(rows.get("api_items", 0), "api_items"),
    }
    out = {
        "metric": "headline_total", "value": round(sum(t for t in times.values() if t), 3), "unit": "sec",
        "queries": times, "rows": rows, "rates": rates, "sf": sf, "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
