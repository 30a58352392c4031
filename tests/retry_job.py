"""Run the KPI with injected task failures (first attempt of one task fails) and print whether
the retried result equals an undisturbed run. Executed in its own process by test_retries.py,
because task retries need a ``local[N, maxFailures]`` master."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pandas as pd  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import LongType, StringType  # noqa: E402


@F.pandas_udf(LongType())
def fail_first_attempt(s: pd.Series) -> pd.Series:
    """Identity, except that the first attempt of partition 0 fails (test-only fault injection)."""
    tc = TaskContext.get()
    if tc is not None and tc.partitionId() == 0 and tc.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return s


@F.pandas_udf(StringType())
def fail_first_attempt_text(s: pd.Series) -> pd.Series:
    """Same fault injection for a text column."""
    tc = TaskContext.get()
    if tc is not None and tc.partitionId() == 0 and tc.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return s


def main(sf: str, ckpt: str) -> None:
    spark = (SparkSession.builder.master("local[4,4]").config("spark.sql.shuffle.partitions", "4")
             .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", ckpt).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from martforge.plans import queries as Q

    sc = spark.sparkContext

    def run(group, build):
        sc.setJobGroup(group, group)   # set before building: dimensions checkpoint eagerly
        rows = sorted(tuple(r) for r in build().collect())
        failed = 0
        for job in sc.statusTracker().getJobIdsForGroup(group):
            for stage in sc.statusTracker().getJobInfo(job).stageIds:
                info = sc.statusTracker().getStageInfo(stage)
                failed += info.numFailedTasks if info else 0
        return rows, failed

    from martforge.operators import kpi

    g = Q.layers_of(spark, sf)
    sales = g.sales

    def made(own):
        return kpi.rollup_kpi(own, g.dim_date, g.lkp_store_geography, g.lkp_product_hierarchy, g.period_map(), g.total_stores())

    expected, _ = run("plain", lambda: made(sales))
    # failure while reading the input (map side of the first shuffle)
    got_in, f_in = run("in", lambda: made(sales.withColumn("store_id", fail_first_attempt("store_id"))))
    # failure after the last shuffle (the stage reading the aggregated shuffle output)
    k = made(sales)
    got_out, f_out = run("out", lambda: k.withColumn("hierarchy_id", fail_first_attempt("hierarchy_id"))
                         .select(*k.columns))
    # dense ids of a freshly built dimension with a failing input stage
    from martforge.operators import hierarchy
    from martforge.plans import retail
    stores = g.stores
    dim, _ = run("dim", lambda: hierarchy.hierarchy_dim(stores, retail.GEOGRAPHY))
    flaky_stores = stores.withColumn("store_state", fail_first_attempt_text("store_state"))
    dim_f, f_dim = run("dimf", lambda: hierarchy.hierarchy_dim(flaky_stores, retail.GEOGRAPHY))
    print("RESULT", got_in == expected, got_out == expected, dim_f == dim, len(expected), f_in, f_out, f_dim)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
