"""Time the headline queries at one scale factor and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through the ``noop`` sink (every row computed, nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.operators import decode as dc  # noqa: E402
from tidemark.operators import fold as fo  # noqa: E402
from tidemark.operators import reconcile as rc  # noqa: E402
from tidemark.plans.catalog import QUERIES, SPEC, envelopes, log  # noqa: E402
from tidemark.plans.catalog import truth as truth_rows  # noqa: E402
from tidemark.session import local_session, scratch_path  # noqa: E402
from tidemark.sources import fixture as fx  # noqa: E402
from tidemark.streaming.state import StateTable  # noqa: E402

HEADLINE = [
    "fold_lsn",            # merge core: log -> current state
    "applied_events",      # running high-water-mark counters
    "batch_net_changes",   # per-batch net changes
    "decode_envelope",     # log -> before images -> JSON envelopes -> typed changes
    "merge_guarded",       # state + batch guarded merge
    "resolve_on_read",     # epochs appended, compacted, folded at read
    "stream_merge",        # Structured Streaming end to end
    "recon_summary",       # reconciliation verdict
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # One shuffle partition per core at this scale; AQE coalesces further.
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    # Untimed warm-up pass (JVM JIT, codegen) on a smaller sibling scale factor.
    warm_dir = str(Path(sf_dir).with_name("sf0.01"))
    if not Path(warm_dir).exists() or warm_dir == sf_dir:
        warm_dir = str(Path(sf_dir).with_name("sf0.001"))
    for name in HEADLINE:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    events = log(spark, sf_dir).count()
    live = truth_rows(spark, sf_dir).count()

    # Decoding alone, over change lines written beforehand; and from these lines to the verdict.
    lines = scratch_path(spark, "bench-lines")
    envelopes(spark, sf_dir).write.json(lines)
    state = StateTable(spark, scratch_path(spark, "bench-state"), SPEC)
    state.write_epochs(fx.with_batch(log(spark, sf_dir)), "batch", "bench", fx.ARRIVAL)

    def decoded():
        rows = spark.read.json(lines, schema="slot BIGINT, pos BIGINT, dup INT, value STRING")
        return dc.accepted(dc.decode(rows, SPEC, keep=fx.ARRIVAL), "strict")

    def verdict():
        truth = fo.fold_live(decoded(), SPEC, fo.MODE_LSN, fx.ARRIVAL)
        return rc.summary(rc.compare(truth, state.read_live(), SPEC))

    times = {}
    for name, make in (("decode_written_lines", decoded), ("recon_from_lines", verdict)):
        make().write.format("noop").mode("overwrite").save()
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf,
        "cpus": int(cpus), "warmup": Path(warm_dir).name,
        "events": events, "live_rows": live,
        "fold_lsn_events_per_sec": round(events / times["fold_lsn"]),
        "stream_merge_events_per_sec": round(events / times["stream_merge"]),
        "recon_rows_per_sec": round(live / times["recon_summary"]),
        "decode_lines_per_sec": round(events / times["decode_written_lines"]),
        "recon_from_lines_rows_per_sec": round(live / times["recon_from_lines"]),
    }))


if __name__ == "__main__":
    main()
