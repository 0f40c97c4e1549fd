import random

from nightledger.llm.linking import crowded, link_buckets


def test_a_reference_outside_large_buckets_may_hold_single_elements(spark):
    """x (1) and y (2) are similar enough; r (3), weightier and in small buckets only, holds what x alone has in the large one."""
    pick = random.Random(4)
    common, alone, other = range(92), range(100, 108), range(1000, 1008)
    sets = {1: [*common, *alone], 2: [*common, *other], 3: [*range(70), *alone, *range(200, 222)]}
    for k in range(10, 50):
        sets[k] = sorted(pick.sample(range(1000, 1400), 100))
    buckets = [(0, 1), (0, 2), *((b, k) for b in (0, 1) for k in range(10, 50)), (2, 1), (2, 3), (3, 2), (3, 3)]
    for b in range(100, 130):
        buckets += [(b, 3), *((b, k) for k in range(500, 514))]
    sets |= {k: [k * 100] for k in range(500, 514)}
    members = crowded(spark.createDataFrame(buckets, "bucket long, id long"))
    found = link_buckets(members, spark.createDataFrame(list(sets.items()), "id long, shingles array<long>"), 85, 100)
    assert {(r.id, r.component) for r in found.collect() if r.id < 4} >= {(1, 1), (2, 1)}
