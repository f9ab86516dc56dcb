"""

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) and prints one JSON line. Each timed
part runs to completion through the ``noop`` sink (every row computed,
nothing collected); inputs a scenario needs landed first (a COPY dump, a
captured-message table, a feed cut into 10 files) are written before the
clock starts, like data that has already arrived. Time = best of
``$BENCH_REPEAT`` runs (default 2) after one warm-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from keelson.operators.partitioning import spread  # noqa: E402
from keelson.operators.unchanged import apply_with_unchanged  # noqa: E402
from keelson.plans import capture, feeds  # noqa: E402
from keelson.plans.queries import (EMPLOYEE, EMPLOYEE_KEYS, QUERIES,  # noqa: E402
                                   _landed_feed, _seeded_target, _stream)
from keelson.session import get_session, scratch_path  # noqa: E402
from keelson.sources.messages import decode_messages  # noqa: E402
from keelson.sources.snapshot import read_copy_text, write_copy_text  # noqa: E402
from keelson.streaming.replicate import run_available  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = get_session("keelson-bench", master=f"local[{cpus}]", conf={
        "spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus))),
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEM", "16g"),
    })

    # Landed inputs (untimed).
    docs = feeds.table(spark, sf_dir, "documents")
    dump = scratch_path(spark, "bench_dump")
    write_copy_text(spread(docs), dump)
    cap = scratch_path(spark, "bench_capture")
    capture.captured_messages(spark, sf_dir).write.parquet(cap)
    base = feeds.employee_base(spark, sf_dir)

    def stream_apply():
        path = _landed_feed(spark, sf_dir)
        target = _seeded_target(spark, sf_dir)
        t0 = time.perf_counter()
        run_available(_stream(spark, path), target, EMPLOYEE_KEYS,
                      checkpoint=scratch_path(spark, "bench_ckpt"))
        noop(target.current())
        return time.perf_counter() - t0

    scenarios = {
        "apply_in_order": lambda: QUERIES["apply_in_order"](spark, sf_dir),
        "apply_wide_keys": lambda: QUERIES["apply_wide_keys"](spark, sf_dir),
        "copy_text_decode": lambda: read_copy_text(spark, dump, docs.schema),
        "message_decode": lambda: decode_messages(spark.read.parquet(cap), EMPLOYEE),
        "unchanged_fill": lambda: apply_with_unchanged(
            base, decode_messages(spark.read.parquet(cap), EMPLOYEE), EMPLOYEE_KEYS),
        "stream_apply": stream_apply,
        "insert_if_absent": lambda: QUERIES["insert_if_absent"](spark, sf_dir),
        "delete_by_composite_key": lambda: QUERIES["delete_by_composite_key"](
            spark, sf_dir),
        "segment_plan": lambda: QUERIES["segment_plan"](spark, sf_dir),
    }
    noop(QUERIES["apply_in_order"](spark, sf_dir))  # warm-up

    names = os.environ.get("BENCH_QUERIES")
    times: dict[str, float] = {}
    for name in (names.split(",") if names else scenarios):
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            out = scenarios[name]()
            if isinstance(out, float):
                dt = out
            else:
                noop(out)
                dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    n_docs = docs.count()
    n_msgs = spark.read.parquet(cap).count()
    if "copy_text_decode" in times:
        result["copy_text_rows_per_sec"] = round(n_docs / times["copy_text_decode"])
    if "message_decode" in times:
        result["message_rows_per_sec"] = round(n_msgs / times["message_decode"])
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
