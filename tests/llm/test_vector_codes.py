import math

import numpy as np
import pytest

from nightledger.llm.vector_codes import (
    assigned_again, assigned_anew, codebooks_digest, next_nearest, vector_codes, with_label_errors,
)

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] for r in kept]
    width = len(vectors[0]) // parts
    points = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in vectors]
    books = [[points[i][p] for i in range(min(entries, len(points)))] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [[min(range(len(books[p])), key=lambda e: (far(x[p], books[p][e]), e)) for p in range(parts)] for x in points]
    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [x[p] for x, n in zip(points, near) if n[p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    near = assign()
    errors = [sum(far(x[p], books[p][n[p]]) for p in range(parts)) for x, n in zip(points, near)]
    codes = ["".join(f"{e:02x}" for e in n) for n in near]
    by_label = {r[2]: sum(e for e, q in zip(errors, kept) if q[2] == r[2]) for r in kept}
    found = [(r[0], c, e, by_label[r[2]]) for r, c, e in zip(kept, codes, errors)]
    return sorted(found, key=str), codebooks_digest(np.array(books))


def got(spark, rows):
    codes, books = vector_codes(spark.createDataFrame(rows, SCHEMA))
    found = with_label_errors(codes).select("vec_id", "code", "error", "label_error").collect()
    return sorted((tuple(r) for r in found), key=str), codebooks_digest(books)


def vectors(count, width=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (7, width))
    return [(i, (centres[i % 7] + rng.normal(0, 0.05, width)).astype(np.float32).tolist(), i % 3) for i in range(count)]


def test_codes_equal_plain_k_means(spark):
    rows = vectors(150)
    # Nulls, ties, repeated rows and vectors, labels and ids that are missing.
    rows += [(200, None, 1), (201, [None] * 16, 1), (202, [float("nan")] * 16, 1), (203, [float("inf")] + [0.0] * 15, 2)]
    rows += [rows[3], rows[3], (204, rows[5][1], None), (None, rows[6][1], None), (205, [0.0] * 16, 1), (206, [0.0] * 16, 1)]
    assert got(spark, rows) == brute(rows)


def test_few_vectors_and_none(spark):
    rows = vectors(5)
    assert got(spark, rows) == brute(rows)
    assert got(spark, [(1, None, 1)])[0] == [] == got(spark, [])[0]
    assert got(spark, [(1, [], 1), (2, [], 1)])[0] == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]


def test_other_columns_do_not_matter(spark):
    rows = vectors(20)
    plain = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    more = plain.withColumns({name: F.lit("x") for name in ("code", "error", "near", "vector", "ints", "is_total", "of_label")})
    assert sorted(vector_codes(more)[0].collect()) == sorted(vector_codes(plain)[0].collect())


def test_odd_lengths(spark):
    rows = vectors(10)
    assert len(got(spark, [*rows, (50, [1.0] * 24, 1)])[0]) == 10
    with pytest.raises(ValueError, match="equal parts"):
        got(spark, [(1, [1.0] * 9, 1)])


@pytest.mark.parametrize("seed", range(6))
def test_bounds_never_lose_the_nearest(seed):
    """Entries wander, b changes: each assignment equals that of all distances."""
    rng = np.random.default_rng(seed)
    points = rng.integers(-300, 300, (400, 3))
    points[:40] = points[40:80]
    book = points[:16].copy()
    nearest = 4
    near, bounds = assigned_anew(points, book, nearest)
    skipped = 0
    for _ in range(12):
        after = book + rng.integers(-12, 13, book.shape) * (rng.random((16, 1)) < 0.5)
        moved = np.sqrt(((after - book) ** 2).sum(axis=1)) * (1 + 1e-9)
        book, wanted = after, int(rng.integers(1, 12))
        near, bounds, looked = assigned_again(points, near, bounds, book, moved, wanted)
        exact = ((points[:, None] - book) ** 2).sum(axis=2)
        assert (near[:, 0] == exact.argmin(axis=1)).all()
        assert (bounds[:, 0].astype(float) ** 2 >= exact.min(axis=1)).all()
        for row, ids, limits in zip(exact, near, bounds):
            others = np.delete(np.sqrt(row), [i for i in ids if i < 16])
            assert not len(others) or limits[-1] <= others.min()
            assert all(i >= 16 or limits[j + 1] <= math.sqrt(row[i]) for j, i in enumerate(ids[1:]))
            assert (np.diff(limits[1:]) >= 0).all()
        skipped += (looked == 0).sum()
    assert skipped > 400


def test_number_of_bounds_adapts():
    looked = np.zeros(18, np.int64)
    looked[0], looked[2], looked[-1] = 900, 95, 5
    assert next_nearest(looked, 4, 16) == 2
    looked[-1] = 100
    assert next_nearest(looked, 4, 16) == 8
    assert next_nearest(np.zeros(18, np.int64), 4, 16) == 4
