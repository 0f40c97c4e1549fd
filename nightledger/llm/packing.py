"""Best-fit packing planned over a histogram of lengths.

The plan knows how many pieces there are of each length, never which: best fit,
longest first, runs over at most `size` lengths however many documents there
are. Pieces get a rank within their length, and take the planned slot of that rank by
a join.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from nightledger.llm.common import saved, small_batches, whole_text

SEQUENCE = 2048
END = 0
#: Ranks are counted in at least so many parts per length, so that no length lands in one task.
PARTS = 64
PART_ROWS = 1_000_000

#: How a byte-level BPE of this kind cuts text before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _byte_names() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Ids as `tokenizers` gives them for a byte-level BPE file, by the faster merge loop of tiktoken.

    The file's ids are in merge order, as that loop needs. Texts with one of the
    file's special tokens go to `tokenizers` itself.
    """

    def __init__(self, path: str):
        self.reference = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self.special = [t["content"] for t in data.get("added_tokens", [])]
        names = _byte_names()
        ranks = {
            bytes(names[c] for c in token): rank for token, rank in data["model"]["vocab"].items() if token not in self.special
        }
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if any(token in text for token in self.special):
            return self.reference.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@cache
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def cut(n_tokens: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole sequences, after a first piece that takes the rest."""
    first = n_tokens % size
    starts = [0, *range(first, n_tokens, size)] if first else list(range(0, n_tokens, size))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n_tokens])]


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE, end: int = END) -> DataFrame:
    """Each document's pieces with the CRC-32 of their ids; every document ends with the id `end`."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(tokenizer_path).ids
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["whole"]):
                ids = np.array([*encode(text), end], "<u4")
                for k, (start, n) in enumerate(cut(len(ids), size)):
                    out.append((doc_id, k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("whole"))
    return texts.mapInPandas(pieces, PIECES)


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts: (length, first rank, end rank, pieces per sequence, first sequence, offset).

    A run places the pieces of one length and consecutive ranks in consecutive
    sequences, each with `pieces per sequence` of them from `offset` on. Sequences with the
    same free space are interchangeable, so they are handled together; the tightest
    space that fits is always filled first, as best fit does piece by piece.
    """
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)
    runs, fresh = [], 0
    for length in sorted(counts, reverse=True):
        rank, end = 0, counts[length]
        while rank < end:
            room = min((r for r, held in free.items() if r >= length and held), default=size)
            each = room // length
            if free[room]:
                first, n = free[room].pop()
            else:
                first, n = fresh, -(-(end - rank) // each)
                fresh += n
            full = min(n, (end - rank) // each)
            if not full:
                full, each = 1, end - rank
            runs.append((length, rank, rank + full * each, each, first, size - room))
            rank += full * each
            if room > each * length:
                free[room - each * length].append((first, full))
            if n > full:
                free[room].append((first + full, n - full))
    return runs


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """The pieces (any columns, with `length` from 1 to `size`) with their sequence_id and offset."""
    spark = pieces.sparkSession
    key = F.xxhash64("doc_id", "piece", "start")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    parts = max(PARTS, -(-sum(counts.values()) // PART_ROWS))
    runs = spark.createDataFrame(
        plan(counts, size), "run_length long, from_rank long, to_rank long, each long, from_sequence long, from_offset long"
    )
    dealt = pieces.withColumn("part", F.pmod(key, F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("length", "part").agg(F.count("*").alias("n")).select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("length", "part").orderBy(key)
    ranked = (
        dealt.withColumn("nth", F.row_number().over(within))
        .join(saved(bases, "length-parts"), ["length", "part"])
        .withColumn("rank", F.col("base") + F.col("nth") - 1)
    )
    fits = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    place = F.col("rank") - F.col("from_rank")
    # The plan has a few runs for each of at most `size` lengths, whatever the input: it may be sent everywhere.
    return ranked.join(F.broadcast(runs), fits).select(
        *pieces.columns,
        (F.col("from_sequence") + F.floor(place / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("from_offset") + place % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )


def best_fit_packing(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE) -> DataFrame:
    """One row per piece of `docs` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts count as empty and pack as the end id alone; null and repeated doc_ids
    are packed like others, each row for itself. Other columns are not looked at.
    An empty table gives no rows.
    """
    return pack(saved(token_pieces(docs, tokenizer_path, size), "pieces"), size)
