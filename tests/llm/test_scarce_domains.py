import numpy as np
import pytest
from pyspark.sql import functions as F

from nightledger.llm.mixing import GRID, rate, solve


def members(spark, rows):
    return spark.createDataFrame([(k, n, p) for k, (n, p) in enumerate(rows)], "doc_id long, n_tokens long, p array<long>")


def shares(spark, rows, weights):
    table = members(spark, rows)
    got = table.select("doc_id", rate(F.col("p"), solve(table, weights)).alias("rate")).collect()
    rates = np.array([r.rate for r in sorted(got, key=lambda r: r.doc_id)])
    totals = (np.array([n for n, _ in rows]) * rates) @ np.array([p for _, p in rows]) / GRID
    assert rates.min() >= 0
    return totals / totals.sum(), rates


def test_a_scarce_domain_is_repeated_until_it_meets_its_weight(spark):
    rows = [(100, [64, 0])] * 180 + [(100, [60, 4])] * 15 + [(100, [8, 56])]
    found, rates = shares(spark, rows, [0.95, 0.05])
    assert abs(found[1] - 0.05) < 1e-3 and rates[-1] > 3


def test_steps_go_on_until_the_tolerance(spark):
    rows = [(100, [64, 0, 0])] * 500 + [(100, [56, 8, 0])] * 60 + [(100, [40, 4, 20])] * 3 + [(100, [34, 26, 4])]
    found, _ = shares(spark, rows, [0.90, 0.07, 0.03])
    assert np.allclose(found, [0.90, 0.07, 0.03], atol=1e-3)


def test_targets_out_of_reach_are_told(spark):
    with pytest.warns(UserWarning, match="cannot be met"):
        solve(members(spark, [(100, [32, 32])] * 5), [0.9, 0.1])
