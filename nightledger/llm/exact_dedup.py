"""Exact duplicates by composable polynomial fingerprints.

A text is a number in base B modulo two primes: the fingerprint of a
concatenation is the left one shifted by the length of the right one, plus the
right one. So chunks are hashed on their own and joined afterwards, and the size
of a document bounds nothing. Texts with equal fingerprints are then compared
chunk by chunk, as rows that Spark spreads; a fingerprint whose texts differ is
resolved by their SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import BLANKS, saved, small_batches, whole_text

PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (1_103_515_245, 1_220_703_125)
CHUNK = 1 << 16

Fingerprint = tuple[int, int, int]
EMPTY: Fingerprint = (0, 0, 0)


@cache
def _powers(k: int, size: int) -> np.ndarray:
    """B^(size-1), ..., B, 1 modulo the prime."""
    out = np.empty(size, np.uint64)
    value = 1
    for i in range(size - 1, -1, -1):
        out[i] = value
        value = value * BASES[k] % PRIMES[k]
    return out


def chunk_fingerprint(data: bytes) -> Fingerprint:
    """Length and both residues of at most CHUNK bytes: sums stay below 2^56."""
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(values)
    first, second = (int((values * _powers(k, CHUNK)[CHUNK - n :]).sum()) % PRIMES[k] for k in (0, 1))
    return n, first, second


def combine(left: Fingerprint, right: Fingerprint) -> Fingerprint:
    """The fingerprint of left + right; associative, with EMPTY as neutral element."""
    shifted = ((left[1 + k] * pow(BASES[k], right[0], PRIMES[k]) + right[1 + k]) % PRIMES[k] for k in (0, 1))
    return (left[0] + right[0], *shifted)


def fingerprint(data: bytes, chunk: int = CHUNK) -> Fingerprint:
    total = EMPTY
    for start in range(0, len(data), chunk):
        total = combine(total, chunk_fingerprint(data[start : start + chunk]))
    return total


def as_long(value: Fingerprint) -> int:
    return value[1] << 31 | value[2]


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [fingerprint(text.encode("utf-8", "surrogatepass")) for text in batch.pop("normal")]
        yield batch.assign(n_bytes=[f[0] for f in found], fp=[as_long(f) for f in found])


def normal_text(column: str = "text") -> F.Column:
    return F.regexp_replace(whole_text(column), BLANKS, " ")


def exact_dedup(docs: DataFrame, chunk: int = CHUNK, make=_fingerprints) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not looked at).

    doc_id, keep_id (smallest doc_id of the equal texts), group_size, kept,
    text_sha256, and fp with n_bytes. Texts are equal if they are after each run of
    ASCII white space has become one space; null counts as empty. Exactly one row
    of a group is kept: among repeated rows of the smallest doc_id any one; a null
    doc_id comes last. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normal_text().alias("normal"))
    rows = saved(
        texts.select("doc_id", F.sha2("normal", 256).alias("text_sha256"), "normal")
        .mapInPandas(make, "doc_id long, text_sha256 string, n_bytes long, fp long")
        .withColumn("row_id", F.monotonically_increasing_id()),
        "fingerprints",
    )
    name = ["n_bytes", "fp"]
    groups = saved(
        rows.groupBy(*name).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).filter("n > 1 and n_bytes > 0"),
        "fingerprint-groups",
    )
    unlike = saved(_unlike(texts, rows, groups, chunk), "fingerprint-collisions")

    exact = F.when(F.col("collided"), F.col("text_sha256")).otherwise("")
    classed = rows.join(unlike.withColumn("collided", F.lit(True)), name, "left").withColumn("exact", exact).drop("collided")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
    classes = saved(
        classed.groupBy(*name, "exact").agg(F.count("*").alias("group_size"), F.min(order).alias("keep")), "equal-texts"
    )
    return classed.join(classes, [*name, "exact"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("keep.row_id")).alias("kept"), "text_sha256", "n_bytes", "fp",
    )


def _unlike(texts: DataFrame, rows: DataFrame, groups: DataFrame, chunk: int) -> DataFrame:
    """Fingerprints for which some text differs in some chunk from the first text of the group.

    Both join sides are plain shuffles, so that adaptive execution can split a group
    that holds a large part of all rows.
    """
    name = ["n_bytes", "fp"]
    members = rows.join(groups, name).select(*name, "doc_id", "first_id").distinct()
    pieces = (
        texts.filter(F.length("normal") > 0)
        .join(members, "doc_id")
        .withColumn("data", F.encode("normal", "UTF-8"))
        .select(
            *name, "doc_id", "first_id", "data",
            F.explode(F.expr(f"sequence(0L, (octet_length(data) - 1) div {chunk})")).alias("chunk_no"),
        )
        .select(
            *name, "doc_id", "first_id", "chunk_no",
            F.expr(f"substring(data, cast(chunk_no * {chunk} + 1 as int), {chunk})").alias("data"),
        )
    )
    pieces = saved(pieces, "chunks")
    firsts = (
        pieces.filter("doc_id = first_id").groupBy(*name, "chunk_no").agg(F.min("data").alias("first_data"))
    )
    # Without doc ids there is no first text to compare with: such groups go by SHA-256.
    return (
        pieces.filter("doc_id != first_id")
        .join(saved(firsts, "first-chunks"), [*name, "chunk_no"], "left")
        .filter("first_data is null or data != first_data")
        .select(*name)
        .union(groups.filter("first_id is null").select(*name))
        .distinct()
    )
