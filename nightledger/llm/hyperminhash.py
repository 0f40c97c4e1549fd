"""HyperMinHash near-duplicates: 16-bit registers, banded, estimated, then verified on full shingle sets.

A register holds of a bucket's minimum only its leading zeros and a few bits after
the leading one. Buckets that no shingle falls in take the minimum of a hash of
their own over all shingles; so two documents agree in a bucket with probability equal to
their Jaccard similarity, also with fewer shingles than buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import in_few, saved, small_batches, text_key
from nightledger.llm.components import components
from nightledger.llm.hashing import SHINGLE, ascii_lower, mix, shingle_set
from nightledger.llm.linking import crowded, link_buckets

ROWS = 5
MANTISSA = 9
#: Bits of a bucket's value below the fill flag (1 bit) and the leading zeros (6 bits).
NUMERATOR, DENOMINATOR = 85, 100
#: Pairs at the threshold that share no band, at most.
MISSED = 2.5e-7
#: Pairs whose estimate is this many standard deviations below the threshold are not verified.
DEVIATIONS = 6.0
#: Bytes of a row without registers, about.
ROW = 64


def bands_for(similarity: float) -> int:
    """The fewest bands of ROWS registers that miss at most MISSED of the pairs of that similarity."""
    return int(np.ceil(np.log(MISSED) / np.log(1 - similarity**ROWS)))


BANDS = bands_for(NUMERATOR / DENOMINATOR)
BUCKETS = ROWS * BANDS


def compress(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Registers of 64-bit minima: fill flag, leading zeros, and MANTISSA bits after the leading one."""
    zeros = np.full(len(values), 63, np.uint64)
    rest = values.copy()
    zeros[rest > 0] = 0
    for step in (32, 16, 8, 4, 2, 1):
        small = (rest >> np.uint64(64 - step) == 0) & (rest > 0)
        zeros[small] += np.uint64(step)
        rest[small] <<= np.uint64(step)
    mantissa = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return (filled.astype(np.uint64) << np.uint64(15) | zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)


def registers(shingles: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Registers, one per bucket, of a set that is not empty."""
    hashes = mix(shingles ^ np.uint64(0xD6E8FEB86659FD93))
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    values = mix(hashes)
    least = np.full(buckets, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, bucket, values)
    filled = np.bincount(bucket, minlength=buckets) > 0
    empty = np.flatnonzero(~filled)
    if len(empty):
        seeds = mix((empty.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        for block in np.array_split(hashes, len(hashes) // 4096 + 1):
            own = mix(block[:, None] ^ seeds[None, :]).min(axis=0)
            least[empty] = np.minimum(least[empty], own)
    return compress(least, filled)


def band_keys(found: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, of the band's number and its registers."""
    bands = len(found) // ROWS
    total = np.arange(1, bands + 1, dtype=np.uint64)
    for row in found.reshape(bands, ROWS).T:
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + row)
    return total


def chance_agreement() -> float:
    """Probability that registers of different minima agree: equal zero counts, then equal bits.

    Minima of many shingles have many leading zeros of a geometric spread; given the
    scale, two agree in it with probability 1/3 at most, and their bits with 2^-MANTISSA.
    """
    return 2.0**-MANTISSA / 3


def _sketch(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, key, text in zip(batch["doc_id"], batch["text_key"], batch["text"]):
            shingles = shingle_set(ascii_lower(text).split(), SHINGLE)
            if not len(shingles):
                out.append((doc_id, key, 0, None, None, None, None))
                continue
            found = registers(shingles, buckets)
            low, high = int(shingles.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(shingles)))
            out.append(
                (doc_id, key, len(shingles), low - (1 << 63), high - (1 << 63), band_keys(found).view(np.int64), found.tobytes())
            )
        frame = pd.DataFrame(out, columns=["doc_id", "text_key", "n_shingles", "low", "high", "keys", "registers"])
        yield frame.astype({"doc_id": "Int64", "low": "Int64", "high": "Int64"})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingle_set(ascii_lower(t).split(), SHINGLE).view(np.int64) for t in batch["text"]]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "shingles": sets})


def _estimates(batches: Iterator[pd.DataFrame], bound: float, buckets: int) -> Iterator[pd.DataFrame]:
    """Keeps pairs whose similarity, corrected for registers that agree by chance, may reach the threshold `bound`."""
    least = bound - DEVIATIONS * (bound * (1 - bound) / buckets) ** 0.5
    chance = chance_agreement()
    for batch in batches:
        if not len(batch):
            continue
        left = np.frombuffer(b"".join(batch["registers_a"]), np.uint16).reshape(-1, buckets)
        right = np.frombuffer(b"".join(batch["registers_b"]), np.uint16).reshape(-1, buckets)
        agree = (left == right).mean(axis=1)
        estimate = (agree - chance) / (1 - chance)
        yield batch.loc[estimate >= least, ["a", "b"]]


def near_duplicates(docs: DataFrame, part: int = NUMERATOR, whole: int = DENOMINATOR) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not looked at): doc_id, n_shingles, component_id, kept, text_key.

    Sets are the distinct five-word shingles of the text with A-Z in lower case (fewer
    words: the whole sequence as one; none, or null: empty and linked with nothing).
    Documents are linked if whole * intersection >= part * union (85 of 100 unless
    told otherwise); component_id is the smallest doc_id that links reach, kept marks that document. Rows that repeat a
    doc_id get the same component, the smallest of theirs; rows without a doc_id are
    sketched but linked with nothing (component_id and kept are null). An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    bound, buckets_of_set = part / whole, ROWS * bands_for(part / whole)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    sketches = saved(
        texts.mapInPandas(
            lambda batches: _sketch(batches, buckets_of_set), "doc_id long, text_key long, n_shingles long, low long, high long, keys array<long>, registers binary"
        ),
        "sketches",
    )
    most, sketch = sketches.count(), ROW + 2 * buckets_of_set + 8 * buckets_of_set // ROWS
    known = sketches.filter("doc_id is not null and n_shingles > 0")
    # Documents with equal sets are one class; its smallest doc_id stands for it.
    name = ["n_shingles", "low", "high"]
    classes = saved(known.groupBy(*name).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "equal-sets", ROW * most)
    firsts = known.join(classes, name).filter("doc_id = first_id").select("doc_id", "keys", "registers")
    firsts = saved(firsts, "class-sketches", sketch * most)
    buckets = firsts.select(F.explode("keys").alias("bucket"), F.col("doc_id").alias("id"))

    members = crowded(buckets, buckets_of_set // ROWS * most)
    candidates = saved(members.select(F.col("id").alias("doc_id")).distinct(), "candidates", ROW * most)
    sets = saved(
        texts.join(candidates, "doc_id", "left_semi").drop("text_key").mapInPandas(_sets, "doc_id long, shingles array<long>"), "sets"
    )
    small = saved(firsts.join(candidates, "doc_id", "left_semi").select("doc_id", "registers"), "candidate-registers", sketch * most)

    def likely(pairs: DataFrame, count: int) -> DataFrame:
        both = (
            pairs.join(small.select(F.col("doc_id").alias("a"), F.col("registers").alias("registers_a")), "a")
            .join(small.select(F.col("doc_id").alias("b"), F.col("registers").alias("registers_b")), "b")
        )
        return (
            in_few(both, 2 * sketch * count)
            .mapInPandas(lambda batches: _estimates(batches, bound, buckets_of_set), "a long, b long").distinct()
        )

    by_id = sets.select(F.col("doc_id").alias("id"), "shingles")
    linked = link_buckets(members, by_id, part, whole, likely)
    # A repeated doc_id ties the classes of its texts together.
    ids = known.join(classes, name).select("doc_id", "first_id")
    ties = ids.filter("doc_id != first_id").distinct()
    repeated = known.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    if repeated.isEmpty():
        found = ids.join(linked, F.col("first_id") == F.col("id"), "left").select(
            "doc_id", F.coalesce("component", "first_id").alias("component")
        )
    else:
        edges = ties.select(F.col("first_id").alias("a"), F.col("doc_id").alias("b")).union(
            linked.select(F.col("component").alias("a"), F.col("id").alias("b"))
        )
        found = components(edges).select(F.col("id").alias("doc_id"), "component")
    return (
        sketches.select("doc_id", "text_key", "n_shingles").join(saved(found.distinct(), "found", ROW * most), "doc_id", "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"), "text_key")
    )

