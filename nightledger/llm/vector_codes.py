"""Codes for vectors: a codebook per part of the vector, fitted by k-means with adaptive bounds.

Drake and Hamerly: of each part of each vector are kept its nearest entry with an upper
bound on the distance, the b next ones in order with lower bounds, and one outer
bound for all others. When entries have moved, bounds move by as much; only if the
upper bound reaches a lower one are distances looked at, up to the first that it does not
reach. b follows from how far that was. All that decides is integer: bounds
are floats rounded away from certainty, and what they leave open is worked out exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightledger.llm.common import dropped, saved, scratch_path

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components are exact up to this value: squared distances of parts of 1000 components then fit into 64 bits.
LARGEST = 1 << 25
#: The share of points that may be beyond their b entries before b grows.
BEYOND = 0.01

#: An entry that is not one: its bound is the outer one.
NONE = 127

State = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Round:
    """What a pass over the vectors needs: codebooks (part, entry, component), how far entries have moved, and b."""

    books: np.ndarray
    moved: np.ndarray | None
    nearest: int


def _up(values: np.ndarray) -> np.ndarray:
    """As 32-bit floats that are not smaller."""
    return np.nextafter((values * (1 + 1e-9)).astype(np.float32), np.float32(np.inf))


def _down(values: np.ndarray) -> np.ndarray:
    return np.nextafter((values * (1 - 1e-9)).astype(np.float32), np.float32(-np.inf))


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of each point (n, d) to its entries (n or 1, k, d)."""
    apart = points[:, None, :] - entries
    return np.einsum("nkd,nkd->nk", apart, apart)


def _ordered(bounds: np.ndarray) -> np.ndarray:
    """Lower bounds made to rise, from the outer one inwards."""
    return np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]


def assigned_anew(points: np.ndarray, book: np.ndarray, nearest: int) -> State:
    """near (n, 1 + b): the nearest entry and the b next; bounds (n, 2 + b): upper, b lower ones, outer."""
    squares = _squares(points, book[None])
    order = np.argsort(squares, axis=1, kind="stable")
    roots = np.sqrt(np.take_along_axis(squares, order, axis=1).astype(np.float64))
    near = np.full((len(points), 1 + nearest), NONE, np.int8)
    bounds = np.full((len(points), 2 + nearest), np.inf, np.float32)
    known = min(1 + nearest, len(book))
    near[:, :known] = order[:, :known]
    bounds[:, :1] = _up(roots[:, :1])
    rest = roots[:, 1 : 2 + nearest]
    bounds[:, 1 : 1 + rest.shape[1]] = _down(rest)
    return near, bounds


def moved_bounds(near: np.ndarray, bounds: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """The bounds after entries have moved; an entry that is not one may be any."""
    by = np.append(moved, np.zeros(NONE + 1 - len(moved)))
    by[NONE] = moved.max()
    out = np.empty_like(bounds)
    out[:, 0] = _up(bounds[:, 0] + by[near[:, 0]])
    out[:, 1:-1] = _down(bounds[:, 1:-1] - by[near[:, 1:]])
    out[:, -1] = _down(bounds[:, -1] - by[NONE])
    out[:, 1:] = _ordered(out[:, 1:])
    return out


def assigned_again(points: np.ndarray, near: np.ndarray, bounds: np.ndarray, book: np.ndarray, moved: np.ndarray, nearest: int):
    """near and bounds after a move, for `nearest` entries from now on, and how many entries were looked at per point.

    The last is 0 where bounds alone decide, and b + 1 where not even the outer bound did.
    """
    near, bounds = near.copy(), moved_bounds(near, bounds, moved)
    looked = np.zeros(len(points), np.int64)
    doubt = np.flatnonzero(bounds[:, 0] >= bounds[:, 1])
    own = _squares(points[doubt], book[near[doubt, 0]][:, None])[:, 0]
    bounds[doubt, 0] = _up(np.sqrt(own.astype(np.float64)))
    looked[doubt] = (bounds[doubt, :1] >= bounds[doubt, 1:]).sum(axis=1)
    width = near.shape[1]
    for z in range(1, width):
        rows = np.flatnonzero(looked == z)
        if len(rows):
            entries = near[rows, : z + 1]
            squares = _squares(points[rows], book[entries])
            order = np.lexsort((entries, squares), axis=-1)
            near[rows, : z + 1] = np.take_along_axis(entries, order, axis=1)
            roots = np.sqrt(np.take_along_axis(squares, order, axis=1).astype(np.float64))
            bounds[rows, 0] = _up(roots[:, 0])
            bounds[rows, 1 : z + 1] = _down(roots[:, 1:])
    near, bounds = _resized(near, bounds, nearest)
    rows = np.flatnonzero(looked == width)
    if len(rows):
        near[rows], bounds[rows] = assigned_anew(points[rows], book, nearest)
    bounds[:, 1:] = _ordered(bounds[:, 1:])
    return near, bounds, looked


def _resized(near: np.ndarray, bounds: np.ndarray, nearest: int) -> State:
    """With b = nearest: entries beyond go into the outer bound, places without an entry have the outer bound."""
    now = near.shape[1] - 1
    bounds[:, 1:] = _ordered(bounds[:, 1:])
    if nearest <= now:
        return near[:, : 1 + nearest].copy(), bounds[:, : 2 + nearest].copy()
    more = nearest - now
    none = np.full((len(near), more), NONE, np.int8)
    return np.hstack([near, none]), np.hstack([bounds, np.repeat(bounds[:, -1:], more, axis=1)])


class Totals:
    """What entries gain and lose in a task: sums and counts of parts, and how far into the bounds one had to look."""

    def __init__(self, books: np.ndarray):
        self.sums = np.zeros(books.shape, np.int64)
        self.counts = np.zeros(books.shape[:2], np.int64)
        self.looked = np.zeros(ENTRIES + 2, np.int64)

    def move(self, part: int, points: np.ndarray, old: np.ndarray | None, new: np.ndarray) -> None:
        changed = slice(None) if old is None else np.flatnonzero(old != new)
        points, new, old = points[changed], new[changed], None if old is None else old[changed]
        for entry in np.unique(new):
            self.sums[part, entry] += points[new == entry].sum(axis=0)
            self.counts[part, entry] += np.count_nonzero(new == entry)
        for entry in [] if old is None else np.unique(old):
            self.sums[part, entry] -= points[old == entry].sum(axis=0)
            self.counts[part, entry] -= np.count_nonzero(old == entry)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.sums.ravel(), self.counts.ravel(), self.looked])


def _matrix(column: pa.Array, kind: str, rows: int) -> np.ndarray:
    """Rows of numbers that were written as bytes; those of a batch are equally long."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(rows, -1)


def _bytes(values: np.ndarray) -> pa.Array:
    """A row of numbers as one value: nothing between Spark and Python has to look into it."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(values)], pa.binary())


def integers(values: np.ndarray) -> np.ndarray:
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if len(scaled) and scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST // SCALE} are too large to be coded exactly")
    return scaled.astype(np.int64)


def _pass(step: Round, first: bool, fields: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Assigns the vectors of a task; its last row has the totals and no vector."""
    names = [field.name for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, schema = Totals(step.books), None
        parts, _, width = step.books.shape
        for batch in batches:
            schema = batch.schema
            rows = batch.num_rows
            if not rows:
                continue
            if first:
                vectors = integers(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(rows, parts * width))
            else:
                vectors = _matrix(batch.column("ints"), "<i4", rows).astype(np.int64) if width else np.zeros((rows, 0), np.int64)
                near = _matrix(batch.column("near"), "i1", rows).reshape(rows, parts, -1)
                bounds = _matrix(batch.column("bounds"), "<f4", rows).reshape(rows, parts, -1)
            points = vectors.reshape(rows, parts, width)
            out, error = [], np.zeros(rows, np.int64)
            for p in range(parts):
                if first:
                    state = assigned_anew(points[:, p], step.books[p], step.nearest)
                    totals.move(p, points[:, p], None, state[0][:, 0])
                else:
                    *state, looked = assigned_again(
                        points[:, p], near[:, p], bounds[:, p], step.books[p], step.moved[p], step.nearest
                    )
                    totals.move(p, points[:, p], near[:, p, 0], state[0][:, 0])
                    totals.looked += np.bincount(np.where(looked == near.shape[2], ENTRIES + 1, looked), minlength=ENTRIES + 2)
                error += _squares(points[:, p], step.books[p][state[0][:, 0]][:, None])[:, 0]
                out.append(state)
            found = {
                "vec_id": batch.column("vec_id"), "label": batch.column("label"), "ints": _bytes(vectors.astype("<i4")),
                "near": _bytes(np.stack([s[0] for s in out], axis=1).reshape(rows, -1)),
                "bounds": _bytes(np.stack([s[1] for s in out], axis=1).reshape(rows, -1)),
                "error": pa.array(error), "totals": pa.nulls(rows, pa.list_(pa.int64())), "is_total": pa.repeat(False, rows),
            }
            yield pa.RecordBatch.from_pydict({name: found[name] for name in names})
        if schema is not None:
            none = {name: pa.nulls(1, kind) for name, kind in zip(names, _arrow_types(schema), strict=True)}
            none |= {"totals": pa.array([totals.flat()]), "is_total": pa.array([True])}
            yield pa.RecordBatch.from_pydict(none)

    return run


def _arrow_types(schema: pa.Schema) -> list[pa.DataType]:
    return [
        schema.field("vec_id").type, schema.field("label").type, pa.binary(), pa.binary(), pa.binary(), pa.int64(),
        pa.list_(pa.int64()), pa.bool_(),
    ]


def _state_fields(rows: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("label", rows.schema["label"].dataType),
        T.StructField("ints", T.BinaryType()), T.StructField("near", T.BinaryType()),
        T.StructField("bounds", T.BinaryType()), T.StructField("error", T.LongType()),
        T.StructField("totals", T.ArrayType(T.LongType())), T.StructField("is_total", T.BooleanType()),
    ])


def _done(rows: DataFrame, step: Round, first: bool, fields: T.StructType) -> str:
    """Where the state after a pass is: vectors under is_total=false, totals of tasks under is_total=true."""
    path = scratch_path(rows.sparkSession, "vector-codes")
    rows.mapInArrow(_pass(step, first, fields), fields).write.partitionBy("is_total").parquet(path)
    return path


def _read(spark: SparkSession, path: str, fields: T.StructType, totals: bool) -> DataFrame:
    rows = spark.read.schema(fields).parquet(path)
    return rows.filter(F.col("is_total") == totals)


def _totals(spark: SparkSession, path: str, fields: T.StructType, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, counts and looks of all tasks: as many numbers as the codebooks have, added up by position."""
    rows = _read(spark, path, fields, True).select(F.posexplode("totals").alias("pos", "value"))
    flat = np.zeros(books.size + books.shape[0] * books.shape[1] + ENTRIES + 2, np.int64)
    for row in rows.groupBy("pos").agg(F.sum("value").alias("value")).collect():
        flat[row["pos"]] = row["value"]
    cells = books.shape[0] * books.shape[1]
    return flat[: books.size].reshape(books.shape), flat[books.size : books.size + cells].reshape(books.shape[:2]), flat[-ENTRIES - 2 :]


def next_nearest(looked: np.ndarray, nearest: int, entries: int) -> int:
    """b for the next pass: doubled if too many points were beyond it, else what all but a few needed."""
    most = max(1, entries - 2)
    total = looked.sum()
    if not total:
        return min(nearest, most)
    if looked[-1] > BEYOND * total:
        return min(2 * nearest, most)
    enough = np.flatnonzero(np.cumsum(looked[:-1]) >= (1 - BEYOND) * total - looked[-1])[0]
    return int(min(max(1, enough), nearest, most))


def vector_codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept row of `embeddings` (vec_id, embedding, label), and the codebooks.

    Kept are rows whose vector is not null and holds neither null nor non-finite
    components. Components become floor(4096 * x), which must not exceed 2^25. Vectors are cut
    into `parts` equal parts; a vector of another length than that of the smallest vec_id cannot be
    and is not kept either. A codebook starts as that part of the first `entries` rows by vec_id (nulls last), then by
    vector; repeated rows count as often as they are there, and fewer rows make fewer entries. `rounds` times
    parts are assigned to their nearest entry (ties: the lower index), and entries become the mean of
    their parts, rounded down; entries without parts stay. Then parts are assigned once more.
    code has two hex digits per part, error is the sum of squared distances. Without kept
    rows there are no codes and codebooks have no entries. Other columns are not looked at.

    Only codebooks and their sums come to the driver. Each pass writes its state, which replaces that of the last.
    """
    spark = embeddings.sparkSession
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    vectors = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), "label")
    vectors = vectors.filter(F.col("vector").isNotNull() & F.forall("vector", fine))
    order = [F.asc_nulls_last("vec_id"), F.asc("vector")]
    start = vectors.orderBy(*order).limit(1).collect()
    fields = _state_fields(vectors)
    if not start:
        nothing = vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return nothing.limit(0), np.zeros((parts, 0, 0), np.int64)
    length = len(start[0]["vector"])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    vectors = vectors.filter(F.size("vector") == length)
    firsts = integers(np.array([row["vector"] for row in vectors.orderBy(*order).limit(entries).collect()], np.float64))
    books = firsts.reshape(len(firsts), parts, length // parts).transpose(1, 0, 2).copy()
    sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
    nearest, moved, path = next_nearest(np.zeros(1), max(1, entries // 4), len(firsts)), None, None
    for number in range(rounds + 1):
        rows = vectors if path is None else _read(spark, path, fields, False)
        now = _done(rows, Round(books, moved, nearest), path is None, fields)
        if path is not None:
            dropped(spark, path)
        path = now
        if number == rounds:
            break
        more = _totals(spark, path, fields, books)
        sums, counts = sums + more[0], counts + more[1]
        nearest = next_nearest(more[2], nearest, len(firsts))
        after = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
        moved = _up(np.sqrt(((after - books) ** 2).sum(axis=2).astype(np.float64))).astype(np.float64)
        books = after
    # The nearest entry is the first of each part's bytes.
    width = (F.octet_length("near") / parts).cast("int")
    digits = [F.lower(F.hex(F.substring("near", width * p + 1, F.lit(1)))) for p in range(parts)]
    codes = _read(spark, path, fields, False).select("vec_id", "label", F.concat(*digits).alias("code"), "error")
    return codes, books


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds label_error: the errors added up over all rows of the same label, null being one.

    The sums are written before they are joined: Spark broadcasts them if they are seen to be small, else shuffles
    both sides, and can split a label that has very many rows.
    """
    sums = saved(codes.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")
