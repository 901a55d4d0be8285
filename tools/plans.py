"""Summarise the physical plan of every registered job into PLANS.md.

    python tools/plans.py [sf_dir]

Plans are taken with AQE off (the static plan; AQE may still turn a
sort-merge join into a broadcast at run time when a side is measured small).
Jobs that write tables while being built are skipped.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WRITES = {"stream_ingest", "chunk_counts", "append_entities", "lifecycle_incremental", "lifecycle_late"}


def summarise(plan: str) -> dict[str, object]:
    lines = plan.splitlines()
    own = [ln for ln in lines if "ReusedExchange" not in ln]
    shuffles = [re.sub(r"#\d+L?", "", m.group(1)) for ln in own
                for m in [re.search(r"Exchange (hashpartitioning\([^)]*\)|RoundRobinPartitioning\(\d+\)|"
                                    r"SinglePartition|rangepartitioning\([^)]*\))", ln)] if m
                and "BroadcastExchange" not in ln]
    return {
        "shuffles": shuffles,
        "reused": sum("ReusedExchange" in ln for ln in lines),
        "broadcasts": sum("BroadcastExchange" in ln for ln in own),
        "interpreted": [re.sub(r"#\d+L?", "", ln.strip())[:60] for ln in lines
                        if re.search(r"^[\s:+-]*(Project|Filter) ", ln)],
        # Spark truncates long plan fields with "...", so the closing bracket may be missing.
        "pushed": sorted({m.rstrip(", ") for ln in lines
                          for m in re.findall(r"PushedFilters: \[(.+?)(?:\]|\.\.\.)", ln)}),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from ledgerline.plans.registry import JOBS
    from ledgerline.session import local_session

    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = ["# PLANS", "",
           f"Static physical plans of the registered jobs on `{sf_dir}` (AQE off), produced by `tools/plans.py`.",
           "Shuffles list each exchange of the job's own data; reused exchanges are read, not written again.", "",
           "| job | shuffles | reused | broadcasts | outside codegen | pushed filters |",
           "| --- | --- | --- | --- | --- | --- |"]
    for name, fn in JOBS.items():
        if name in WRITES:
            out.append(f"| `{name}` | (writes while built; see README) | | | | |")
            continue
        s = summarise(fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
        out.append(f"| `{name}` | {'<br>'.join(s['shuffles']) or 'none'} | {s['reused']} | {s['broadcasts']} | "
                   f"{'<br>'.join(s['interpreted']) or 'none'} | {'<br>'.join(s['pushed'])[:120] or ''} |")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out) + "\n")
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
