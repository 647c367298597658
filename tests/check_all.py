"""Run every registered query (or those named) against its SQL and print the outcome."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tablewright.plans.catalog import all_queries  # noqa: E402
from tablewright.session import build_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    if os.environ.get("PLAIN_SESSION"):
        # A session without any of our settings, as another driver may bring it.
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
    else:
        spark = build_session("check", "local[8]", 8)
    db = connect(folder)
    bad = 0
    for name, q in all_queries().items():
        if names and not any(n in name or any(c.startswith(n) for c in q.covers) for n in names):
            continue
        start = time.time()
        try:
            df = q.run(spark, folder)
            if q.sql is None:
                said = f"rows {df.count()} (no SQL)"
            else:
                found = differences(db, df, q.sql)
                said, bad = (found or "ok"), bad + bool(found)
        except Exception as problem:
            said, bad = f"ERROR {type(problem).__name__}: {str(problem)[:600]}", bad + 1
        print(f"{name:34s} {time.time() - start:6.2f}s {said}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
