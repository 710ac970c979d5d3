"""Run one of the four jobs from the command line (spark-submit or python).

    spark-submit scripts/run_job.py profile   --input RAW [--header TEXT]
    spark-submit scripts/run_job.py clean     --input RAW --output CLEAN --limits LIMITS.csv [--synonyms SYN.csv]
    spark-submit scripts/run_job.py analytics --output CLEAN [--show 20]
    spark-submit scripts/run_job.py audit     --output CLEAN

LIMITS.csv has a header ``category_key,analyte_key,max_reading``; SYN.csv has
``alias,canonical``. Results are shown (first rows only) or, with
``--results DIR``, written as Parquet, one folder per result.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from assayframe.plans import jobs  # noqa: E402


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("job", choices=["profile", "clean", "analytics", "audit"])
    ap.add_argument("--input")
    ap.add_argument("--output")
    ap.add_argument("--header")
    ap.add_argument("--limits")
    ap.add_argument("--synonyms")
    ap.add_argument("--format", default="parquet", choices=["parquet", "tsv"])
    ap.add_argument("--show", type=int, default=20)
    ap.add_argument("--results")
    a = ap.parse_args(argv)
    spark = (SparkSession.builder.appName(f"assayframe-{a.job}")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate())
    if a.job == "profile":
        results = jobs.profile_job(spark, a.input, a.header)
    elif a.job == "clean":
        limits = spark.read.csv(a.limits, header=True, schema="category_key string, analyte_key string, max_reading double")
        syn = spark.read.csv(a.synonyms, header=True, schema="alias string, canonical string") if a.synonyms else None
        results = {"report": jobs.clean_job(spark, a.input, a.output, limits, syn, a.header, a.format)}
    elif a.job == "analytics":
        results = jobs.analytics_job(spark, a.output, a.format)
    else:
        results = jobs.audit_job(spark, a.output, a.format)
    for name, df in results.items():
        if a.results:
            df.write.mode("overwrite").parquet(f"{a.results.rstrip('/')}/{name}")
        else:
            print(f"-------- {name}")
            df.show(a.show, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
