"""Headline benchmark: wall time of registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Each query writes its whole result to Spark's no-op sink, so every row is
computed and nothing is collected.  The same queries run over the next smaller size beside it first, which
starts code paths and workers and gives ``growth``: the power of the input with which their time grows.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpusloom import plans  # noqa: E402
from corpusloom.plans import registry  # noqa: E402
from corpusloom.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_curate_and_count",
    "k3_tokenize",
    "k8_verify_roundtrip",
    "d1_exact_dedup",
    "d6_near_dedup",
    "d7_line_dedup",
    "f1_gopher",
    "f10_repetition",
    "f13_filter_report",
    "l1_lang_profiles",
    "l2_detect_lang",
    "p2_redact_pii",
    "q2_perplexity",
    "x1_html_to_text",
    "x2_strip_repeated_lines",
    "n5_materialize_samples",
    "b2_blend_exact",
    "b3_blend_scalable",
    "m8_tail_to_head",
    "a3_rolling_throughput",
]


SMALLER = {"sf0.1": "sf0.01", "sf0.01": "sf0.001"}


def run(spark, names: list[str], sf_dir: str) -> dict[str, float]:
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{Path(sf_dir).name} {name}: {times[name]}", file=sys.stderr, flush=True)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench", shuffle=2 * int(cpus) if cpus.isdigit() else 16)
    spark.sparkContext.setLogLevel("ERROR")
    # The fixtures are single files of one row group.
    registry.SPREAD = spark.sparkContext.defaultParallelism
    # Start the JVM code paths and Python workers once, outside the timings.
    plans.QUERIES["k8_verify_roundtrip"](spark, "/root/testdata/sf0.001").count()
    small_dir = str(Path(sf_dir).parent / SMALLER.get(Path(sf_dir).name, "none"))
    small = run(spark, names, small_dir) if Path(small_dir).is_dir() else {}
    times = run(spark, names, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n_docs, n_chars = docs.selectExpr("count(*)", "sum(n_chars)").first()
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "documents": n_docs,
        "characters": n_chars,
    }
    if small:
        # Ten times the input; below 1 the fixed cost of jobs still shows.
        out["growth"] = {k: round(math.log10(times[k] / small[k]), 2) for k in names}
        out["queries_smaller"] = small
    if "k3_tokenize" in times:
        out["tokenize_docs_per_sec"] = round(n_docs / times["k3_tokenize"], 1)
        out["tokenize_mchars_per_sec"] = round(n_chars / times["k3_tokenize"] / 1e6, 3)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
