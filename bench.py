"""Headline timings on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``local[$BENCH_CPUS]``.

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit", "queries", "sf"}.
Each query is timed to its full result, written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sylvan.plans import pipeline as P  # noqa: E402
from sylvan.plans import queries as Q  # noqa: E402
from sylvan.session import get_spark  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# the reference's deepest published run used treeMaxDepth=20 (its default)
MAX_DEPTH = int(os.environ.get("BENCH_MAX_DEPTH", "20"))


def run(df):
    """The whole result, without sending it to the driver."""
    df.write.format("noop").mode("overwrite").save()


def _forest_and_score(spark, rule):
    feats = P.prepare(spark, SF_DIR, "lang", Q.MIN_DF)
    nodes = P.train(spark, feats, rule=rule, max_depth=MAX_DEPTH)
    run(nodes)
    return feats, nodes


def main():
    cpus = int(CPUS) if CPUS.isdigit() else 8
    spark = get_spark(cpus, max(8, cpus))
    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        timings[name] = round(time.time() - t0, 3)
        return out

    # warm the JVM and the file listing once (not timed)
    spark.read.parquet(f"{SF_DIR}/documents.parquet").select(F.count(F.lit(1))).collect()

    timed("clean_tokens", lambda: run(Q.tokenize(spark, SF_DIR)))
    timed("postings_vocabulary", lambda: run(Q.vocabulary(spark, SF_DIR)))
    timed("root_best_split", lambda: run(Q.best_split(spark, SF_DIR)))
    timed("top_splits", lambda: run(Q.top_splits(spark, SF_DIR)))
    feats, nodes = timed("forest_c45", lambda: _forest_and_score(spark, "c45"))
    timed("score_c45", lambda: run(P.evaluate(spark, feats, nodes)[2]))
    timed("forest_mr", lambda: _forest_and_score(spark, "mr"))
    timed("forest_toxic_c45", lambda: run(Q._forest(spark, SF_DIR, "c45", MAX_DEPTH, profile="toxic", min_df=10)[1]))
    # the classic job at its own defaults (min_df 200, rule mr, depth 20, stemming + stop words)
    from sylvan.plans.job import JobParams, run_job
    from sylvan.session import scratch_path

    timed("job_defaults", lambda: run(run_job(spark, SF_DIR, scratch_path(spark, "bench-job"), "lang", JobParams())))

    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "sum_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf.group(1)) if sf else SF_DIR,
                "max_depth": MAX_DEPTH,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
