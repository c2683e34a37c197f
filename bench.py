"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is executed to completion with the ``noop`` sink (full computation, no output I/O).
The star flow runs first: it parses every payload once into a checkpoint that later star
queries read, as the batch job does.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # event -> star batch flow
    "gate_events", "status_summary", "mark_processed",
    "required_sections", "write_star", "star_multas", "star_entidades", "star_representantes",
    "star_compania_info", "star_proveedores_info",
    # reports over the star
    "contracts_by_type", "section_counts", "fine_totals", "star_view", "touch_updated_at", "ordered_constraints",
    # documents
    "unpack_pages", "doc_stats", "extract_fields", "read_document",
    # scalars
    "normalize_date", "normalize_decimal",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from contractlake.plans import catalog
    from contractlake.session import get_session
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    times: dict[str, float] = {}
    t_all = time.time()
    for name in HEADLINE:
        fn = catalog.REGISTRY[name][0]
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    total = round(time.time() - t_all, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
