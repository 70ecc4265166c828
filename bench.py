"""Headline benchmark: prints one JSON line with the median time per query."""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "call_rate_by_chromosome",
    "assay_qc",
    "normalize_mappings",
    "canonical_genotypes",
    "genotype_states",
    "review_queue",
    "pgs_scores",
    "gene_outcomes",
    "family_segregation",
    "pca_projection",
    "nearest_samples",
    "masked_selection",
    "two_tier_lookup",
)


def session(cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("varloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from varloom.plans import suite

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            start = time.time()
            suite.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
