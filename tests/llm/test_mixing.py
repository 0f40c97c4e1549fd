import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import clashing, documents, labels  # noqa: F401
from nightledger.llm.mixing import GRID, label_domains, mix, on_grid, rate, solve
from test_toxicity import table


def least_squares(p, tokens, target):
    """Nonnegative rates of least residual, by an active set (independent of how the operator does it)."""
    matrix = (np.array(p, float) / GRID * np.array(tokens, float)[:, None]).T
    rates, free = np.zeros(matrix.shape[1]), np.zeros(matrix.shape[1], bool)
    for _ in range(500):
        slope = matrix.T @ (target - matrix @ rates)
        slope[free] = -np.inf
        if slope.max() <= 1e-9 * np.abs(target).max() ** 2:
            break
        free[slope.argmax()] = True
        while True:
            tried = np.zeros_like(rates)
            tried[free] = np.linalg.lstsq(matrix[:, free], target, rcond=None)[0]
            if (tried[free] > 0).all():
                rates = tried
                break
            stuck = free & (tried <= 0)
            part = (rates[stuck] / (rates[stuck] - tried[stuck])).min()
            rates = rates + part * (tried - rates)
            free &= rates > 1e-12
            rates[~free] = 0
    return np.abs(target - matrix @ rates) / target


@pytest.mark.parametrize("weights", [[0.6, 0.3, 0.1], [0.97, 0.01, 0.02], [0.2, 0.2, 0.6], [0.05, 0.9, 0.05]])
def test_targets_that_can_be_met_are_met(spark, recwarn, weights):
    """Near the natural shares and far from them: within 1e-3 of an independent fit, with rates as near to 1 as can be."""
    random = np.random.default_rng(1)
    p = on_grid(random.dirichlet([0.4, 0.4, 0.2], 500))
    tokens = random.integers(0, 900, 500)
    members = spark.createDataFrame([(k, int(n), [int(v) for v in row]) for k, (n, row) in enumerate(zip(tokens, p))], "doc_id long, n_tokens long, p array<long>")
    push = solve(members, weights)
    rates = np.array([r.rate for r in members.select("doc_id", rate(F.col("p"), push).alias("rate")).orderBy("doc_id").collect()])
    there, share = tokens @ p / GRID, np.array(weights)
    target = share * there[share.argmax()] / share.max()
    assert least_squares(p, tokens, target).max() < 1e-3
    assert np.allclose((tokens * rates) @ p / GRID, target, rtol=1e-3) and rates.min() >= 0
    assert not any("mix targets" in str(w.message) for w in recwarn.list)
    # No way to the same totals is nearer to 1: it would have to go along the documents that are free.
    assert np.allclose(rates, np.maximum(0, 1 + p @ np.array(push) / GRID))


def test_a_bound_on_rates(spark):
    rows = [(k, 100, [64, 0]) for k in range(190)] + [(200 + k, 100, [32, 32]) for k in range(10)]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<long>")
    free, bound = solve(members, [0.9, 0.1]), solve(members, [0.9, 0.1], most=5.0)
    high = lambda push, most: max(r.rate for r in members.select(rate(F.col("p"), push, most).alias("rate")).collect())
    assert high(free, None) > 3 and high(bound, 5.0) <= 5.0
    with pytest.warns(UserWarning, match="cannot be met"):
        assert high(solve(members, [0.9, 0.1], most=1.5), 1.5) <= 1.5


def test_grid():
    shares = on_grid(np.array([[1 / 3, 1 / 3, 1 / 3], [1, 0, 0], [0.5, 0.499, 0.001]]))
    assert (shares.sum(axis=1) == GRID).all() and (shares >= 0).all()


def test_mix_meets_its_targets(documents, labels, clashing):
    rows, marks = table(700)
    targets = {"clean": 0.95, "toxic": 0.05}
    found = mix(clashing(documents(rows)), clashing(label_domains(labels(marks[:500]))), targets).toPandas()
    assert len(found) == 700
    expected = {d: (found.n_tokens * found.rate * found[f"p_{d}"]).sum() for d in targets}
    assert abs(expected["toxic"] / sum(expected.values()) - 0.05) < 0.01
    fine = found[found.doc_id % 7 != 0]
    assert (fine.copies >= 1).mean() > 0.95 and fine.rate.mean() > 0.95
    assert found[found.doc_id % 7 == 0].rate.mean() < 0.6
    assert abs(found.copies.sum() - found.rate.sum()) < 40


def test_odd_tables(documents, labels):
    pick = random.Random(1)
    odd = [(1, None), (2, ""), (None, "a b"), (3, "w " * 50_000), (3, "x"), *((k, " ".join(pick.choices("abcdef", k=9))) for k in range(10, 20))]
    for marks in ([], [(1, 1, 0)], [(k, 1, k % 2) for k in range(10, 20)], [(None, 1, 1), (3, None, 1), (2, 1, 1), (2, 1, 0), (12, 1, 0)]):
        found = mix(documents(odd), label_domains(labels(marks)), {"clean": 0.9, "toxic": 0.1}).collect()
        assert len(found) == len(odd) and all(r.rate >= 0 and r.copies >= 0 for r in found)
    assert mix(documents([]), label_domains(labels([])), {"clean": 0.9, "toxic": 0.1}).count() == 0
