"""Times the headline reports and prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores. All queries run once to
warm the session up. Each figure then is the median of three runs, from building
the plan to having computed every row. `compared` holds the same results of the same
input computed date by date, once each.
"""

import json
import os
import statistics
import time
from datetime import timedelta


from checks.compare import local_session
from checks.queries import AS_OF, QUERIES, WEEK, _mat_tables, _rob_tables
from nightledger.plans import mat, rob

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "rob_daily", "rob_bulk", "rob_bulk_default_start", "rob_sql_report",
    "mat_daily", "mat_bulk", "mat_bulk_text", "mat_bulk_all_dates", "mat_sql_report",
    "latest_version", "fiscal_calendar",
]


def compute(df):
    df.write.format("noop").mode("overwrite").save()


def _week():
    return [WEEK[0] + timedelta(days=n) for n in range((WEEK[1] - WEEK[0]).days + 1)]


def rob_week_by_day(spark):
    for day in _week():
        compute(rob.rob(*_rob_tables(spark, SF_DIR, WEEK[1]), day))


def mat_week_by_day(spark):
    for day in _week():
        compute(mat.mat(*_mat_tables(spark, SF_DIR), day))


def timed(run, runs=3):
    seconds = []
    for _ in range(runs):
        begun = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - begun)
    return round(statistics.median(seconds), 3)


def main():
    spark = local_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE:
        compute(QUERIES[name](spark, SF_DIR))
    queries = {name: timed(lambda: compute(QUERIES[name](spark, SF_DIR))) for name in HEADLINE}
    compared = {
        run.__name__: timed(lambda: run(spark), runs=1)
        for run in (rob_week_by_day, mat_week_by_day)
    }
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "compared": compared,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
