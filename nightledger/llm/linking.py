"""Links between sets that share a bucket, without emitting all pairs of a bucket.

Two sets can only be similar enough if their sizes agree, and in a large bucket only if
few of their elements are in no other set of such a bucket; members that fit no other
are dropped. Of the rest, each round tests pivots, those first whose buckets
are largest: the original of many copies, rather than one of them. A pivot is tested against
members of other components only. So copies of one text cost a
pair each, not a pair for each two. Nothing is given up: the last round tests all
members of different components that are left and fit each other.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import saved
from nightledger.llm.components import components

#: From this many members on, elements of no other set are counted out.
LARGE = 16
#: Sizes are dealt into classes of this ratio; a member meets those of the classes that fit it.
RATIO = 1.05
#: Pivots per bucket and class of each round; in the last, all that is left.
PIVOTS = (1, 8, None)
#: Bytes of a member's row in any of the tables, of a pair and of the two sets of one, about.
ROW, PAIR, SETS = 100, 16, 8192


def crowded(buckets: DataFrame, most: int | None = None) -> DataFrame:
    """Rows (bucket, id, n, weight) of buckets with two ids or more: n members, and all members of the id's buckets.

    `buckets` has `most` rows at most, if that is known.
    """
    size = most if most is None else ROW * most
    sizes = saved(buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "bucket-sizes", size)
    members = saved(buckets.join(sizes, "bucket").groupBy("bucket", "id").agg(F.max("n").alias("n")), "sized-members", size)
    weights = members.groupBy("id").agg(F.sum("n").alias("weight"))
    return saved(members.join(weights, "id"), "members", ROW * members.count())


def _sized(members: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """bucket, id, weight, size, single (elements of no other set) and most: the largest set to be linked with there.

    Sets outside large buckets may hold single elements too. Of x elements, of which u are in no other set of a large bucket, at most x - u are
    common with one of y, and the union has at least y + u.
    """
    sizes = sets.select("id", F.size("shingles").alias("size"))
    heavy = members.filter(F.col("n") >= LARGE).select("id").distinct()
    elements = sets.join(heavy, "id", "left_semi").select("id", F.explode("shingles").alias("element"))
    own = elements.groupBy("element").agg(F.count("*").alias("times"), F.min("id").alias("id")).filter("times = 1")
    single = own.groupBy("id").agg(F.count("*").alias("single"))
    u = F.when(F.col("n") >= LARGE, F.coalesce("single", F.lit(0))).otherwise(F.lit(0))
    most = F.floor((whole * (F.col("size") - u) - part * u) / part)
    return members.join(sizes, "id").join(single, "id", "left").select(
        "bucket", "id", "weight", "size", u.alias("single"), most.alias("most")
    )


def _sides(sized: DataFrame, part: int, whole: int) -> DataFrame:
    """Each member as the smaller set in the class of its size, and as the larger one in all classes that fit."""
    cell = lambda n: F.floor(F.log(n) / F.log(F.lit(RATIO))).cast("int")
    low, high = F.ceil(F.col("size") * part / whole), F.least("size", "most")
    smaller = sized.filter("most >= size").select("*", cell(F.col("size")).alias("cell"), F.lit(True).alias("small"))
    larger = sized.filter(low <= high).select(
        "*", F.explode(F.sequence(cell(low), cell(high))).alias("cell"), F.lit(False).alias("small")
    )
    return smaller.union(larger)


def _open(rows: DataFrame, most: int) -> DataFrame:
    """The rows, `most` at most, whose bucket and class hold a fitting row of the other side in another component."""
    small, large = F.col("small"), ~F.col("small")
    facts = rows.groupBy("bucket", "cell").agg(
        *(
            call(F.when(side, F.col(column))).alias(f"{call.__name__}_{column}_{name}")
            for side, name in ((small, "small"), (large, "large"))
            for call, column in ((F.min, "component"), (F.max, "component"), (F.min, "size"), (F.max, "most"))
        )
    )
    fits = lambda other: (
        (F.col(f"min_size_{other}") <= F.col("most")) & (F.col("size") <= F.col(f"max_most_{other}"))
        & ((F.col(f"min_component_{other}") != F.col("component")) | (F.col(f"max_component_{other}") != F.col("component")))
    )
    kept = rows.join(saved(facts, "bucket-facts", ROW * most), ["bucket", "cell"]).filter((small & fits("large")) | (large & fits("small")))
    return saved(kept.select(*rows.columns), "open-members", ROW * most)


def link_buckets(
    members: DataFrame, sets: DataFrame, part: int, whole: int, likely: Callable[[DataFrame, int], DataFrame] | None = None
) -> DataFrame:
    """(id, component) of all ids that links connect; ids without a link are not in it.

    `members` as `crowded` gives them, ids long and not null; `sets` has (id, shingles)
    for all of them. Sets in a common bucket are linked if whole * intersection >= part * union.
    `likely` may take out distinct pairs (a, b), so many, that cannot be.
    """
    most = members.count()
    sized = saved(_sized(members, sets, part, whole), "sized", 4 * ROW * most)
    # One row as the smaller set, and one for each class between a size and the least that fits it.
    classes = 3 + int(log(whole / part) / log(RATIO))
    left = _open(_sides(sized, part, whole).withColumn("component", F.col("id")), classes * most)
    rounds, stars, compared, edges = list(PIVOTS), None, None, 0
    while rounds and (rows := left.count()):
        pivots = rounds.pop(0)
        if pivots is None:
            left = _referred(left, members, compared, most, edges)
        pairs = _pairs(left, pivots, part, whole, rows)
        pairs = saved(pairs, "pairs", pivots and PAIR * pivots * rows)
        count = pairs.count()
        if likely is not None and pivots is not None:
            pairs = saved(likely(pairs, count), "likely-pairs", PAIR * count)
            count = pairs.count()
        edges += count
        now = saved(_compared(pairs, sets), "compared", SETS * count)
        compared = now if compared is None else compared.union(now)
        links = now.filter(whole * F.col("common") >= part * (F.col("size_a") + F.col("size_b") - F.col("common")))
        links = links.select("a", "b")
        if stars is not None:
            links = links.union(stars.filter("id != component").select(F.col("component").alias("a"), F.col("id").alias("b")))
        # A link for each pair that was compared, at most, and both ends of it.
        stars = saved(components(links, most=edges), "components", 2 * PAIR * edges)
        if rounds:
            rest = left.drop("component").join(stars, "id", "left")
            left = _open(rest.withColumn("component", F.coalesce("component", "id")).select(*left.columns), rows)
    if stars is None:
        return members.select("id", F.col("id").alias("component")).limit(0)
    return stars


def _referred(left: DataFrame, members: DataFrame, compared: DataFrame, most: int, pairs: int) -> DataFrame:
    """Adds all buckets of the id; and ref, the weightiest id that it has been compared with, or itself, and how many elements differ.

    There are `most` members and so many `pairs` compared. A ref that is in no large bucket may hold elements counted as single; then none are.
    """
    shared = members.groupBy("id").agg(
        F.array_sort(F.collect_set("bucket")).alias("all"), F.max("weight").alias("own_weight"),
        (F.max("n") >= LARGE).alias("heavy"),
    )
    shared = saved(shared, "shared-buckets", ROW * most)
    differ = (F.col("size_a") + F.col("size_b") - 2 * F.col("common")).alias("differ")
    both = compared.select(F.col("a").alias("id"), F.col("b").alias("other"), differ).union(
        compared.select(F.col("b").alias("id"), F.col("a").alias("other"), differ)
    )
    weights = shared.select(F.col("id").alias("other"), F.col("own_weight").alias("weight"), "heavy")
    own = shared.select("id", F.col("id").alias("other"), F.lit(0).alias("differ"), F.col("own_weight").alias("weight"), "heavy")
    every = both.join(weights, "other").select("id", "other", "differ", "weight", "heavy").union(own)
    refs = every.groupBy("id").agg(F.max(F.struct("weight", "other", "differ", "heavy")).alias("r"))
    refs = refs.select("id", F.col("r.other").alias("ref"), F.col("r.differ").alias("differ"), F.col("r.heavy").alias("heavy"))
    found = left.join(shared.select("id", "all"), "id").join(saved(refs, "references", ROW * (most + 2 * pairs)), "id")
    return found.withColumn("single", F.when(F.col("heavy"), F.col("single")).otherwise(F.lit(0))).drop("heavy")


def _pairs(left: DataFrame, pivots: int | None, part: int, whole: int, most: int) -> DataFrame:
    """Distinct pairs (a, b) of different components that fit: of `pivots` members of each bucket and class, or of all; `left` has `most` rows."""
    pivot = lambda names: [F.col(name).alias(f"pivot_{name.removeprefix('p.')}") for name in names]
    own = ["id", "component", "size", "most"]
    fits = (
        (F.col("component") != F.col("pivot_component")) & (F.col("size") <= F.col("pivot_most"))
        & (F.col("pivot_size") <= F.least("size", "most"))
    )
    small, large = left.filter("small"), left.filter("not small")
    if pivots is None:
        own = [*own, "single", "all", "ref", "differ"]
        chosen = small.select("bucket", "cell", *pivot(own))
        # A pair meets in each bucket that it shares, and if sizes are equal twice; once is enough.
        once = (F.col("pivot_size") < F.col("size")) | (F.col("pivot_id") < F.col("id"))
        fits &= once & (F.array_intersect("all", "pivot_all")[0] == F.col("bucket")) & _may_agree(part, whole)
    else:
        # A pivot per slot, found with partial minima.
        slot = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(pivots))
        order = F.struct((-F.col("weight")).alias("w"), F.xxhash64("id").alias("h"), *own)
        found = small.groupBy("bucket", "cell", slot.alias("slot")).agg(F.min(order).alias("p"))
        chosen = saved(found.select("bucket", "cell", *pivot([f"p.{name}" for name in own])), "pivots", ROW * most)
    pairs = large.join(chosen, ["bucket", "cell"]).filter(fits)
    return pairs.select(F.least("id", "pivot_id").alias("a"), F.greatest("id", "pivot_id").alias("b")).distinct()


def _may_agree(part: int, whole: int) -> Column:
    """Whether two sets that have been compared with the same third one can be similar enough.

    If they differ from it in d and e elements, they differ from each other in d + e less
    twice what both differences share, which leaves out elements that no other set has.
    """
    sizes = F.col("size") + F.col("pivot_size")
    common = F.least(F.col("differ") - F.col("single"), F.col("pivot_differ") - F.col("pivot_single"))
    apart = F.col("differ") + F.col("pivot_differ") - 2 * F.greatest(common, F.lit(0))
    return (F.col("ref") != F.col("pivot_ref")) | ((whole + part) * (sizes - apart) >= 2 * part * sizes)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, size_a, size_b) of pairs of sets."""
    left = sets.select(F.col("id").alias("id_a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("id_b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b")).alias("common")
    sizes = [F.size("set_a").alias("size_a"), F.size("set_b").alias("size_b")]
    both = pairs.join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b"))
    return both.select("a", "b", common, *sizes)
