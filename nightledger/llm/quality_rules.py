"""Rule statistics of documents, and an isolation forest that tells anomalous ones by short paths.

Trees split the statistics of documents labelled clean at random; a document that few
random splits separate from those is an anomaly. How short is too short is
calibrated on the labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import saved, small_batches
from nightledger.llm.hashing import hash_words, windows

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
BLANK_CHARS = " \t\n\r\x0b\f"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30

TREES = 200
SAMPLE = 256
FIT_ROWS = 8192
#: A share is usual up to this quantile of the clean rows that the forest is fitted on.
USUAL = 0.99
BINS = 2000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_twins"]
FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "upper", "marks", "twins"]

_UPPER = bytes(range(ord("A"), ord("Z") + 1))


def statistics(text: str | None) -> tuple[int, ...]:
    """The COUNTS of a text; null has none of anything."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    tokens = data.split()
    hashes = hash_words(tokens)
    repeated = 0
    found = windows(hashes, WINDOW)
    if len(found) > 1:
        _, where, times = np.unique(found, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[where] > 1)
        edges = np.zeros(len(tokens) + 1, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WINDOW, -1)
        repeated = int((np.cumsum(edges) > 0).sum())
    seen: set[str] = set()
    lines = duplicates = 0
    for line in text.split("\n"):
        if line.strip(BLANK_CHARS):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    return (
        len(tokens),
        len(text) - sum(map(text.count, BLANK_CHARS)),
        sum(map(text.count, SYMBOLS)),
        duplicates,
        repeated,
        lines,
        len(data) - len(data.translate(None, _UPPER)),
        text.count("!"),
        int((hashes[1:] == hashes[:-1]).sum()),
    )


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the COUNTS and base_failed of each row of `docs` (doc_id, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([statistics(t) for t in batch["text"]], np.int64).reshape(-1, len(COUNTS))
            yield pd.concat([batch[["doc_id"]].astype("Int64"), pd.DataFrame(found, columns=COUNTS, index=batch.index)], axis=1)

    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return texts.mapInPandas(count, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)).withColumn("base_failed", failed)


def features(rows: pd.DataFrame) -> np.ndarray:
    """Shares that do not depend on the length of the text, from 0 to 1 on a log scale of per cent or word length."""
    words = np.maximum(rows["n_words"], 1)
    per_cent = lambda part, whole: np.log1p(100 * part / whole) / math.log(101)
    return np.minimum(
        np.column_stack(
            [
                np.log1p(rows["word_chars"] / words) / math.log(101),
                per_cent(rows["n_symbols"], words),
                rows["n_dup_lines"] / np.maximum(rows["n_lines"], 1),
                rows["n_repeat_words"] / words,
                per_cent(rows["n_upper"], np.maximum(rows["word_chars"], 1)),
                per_cent(rows["n_marks"], words),
                per_cent(rows["n_twins"], words),
            ]
        ).astype(float),
        1.0,
    )


def excess(points: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """How far each share is above its limit, as a part of what is possible: 0 for usual text, at most 1."""
    return np.maximum(points - limits, 0) / np.maximum(1 - limits, 1e-9)


def expected_depth(n: float) -> float:
    """Mean path length of a random search tree over n points."""
    return 0.0 if n <= 1 else 2 * (math.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


class Forest:
    """Isolation trees as arrays: split feature (-1: leaf), split value, children, and path length at leaves.

    A split takes any feature and any value of the node's box, which starts as the unit
    cube; so a small excess over a limit is rarely cut off, however few have it.
    """

    def __init__(self, points: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 7):
        random = np.random.default_rng(seed)
        self.sample = min(sample, len(points))
        self.trees = [self._tree(points[random.permutation(len(points))[: self.sample]], random) for _ in range(trees)]

    def _tree(self, points: np.ndarray, random) -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []
        limit = math.ceil(math.log2(max(self.sample, 2)))
        width = points.shape[1]
        todo = [(points, 0, None, 0, np.zeros(width), np.ones(width))]
        while todo:
            rows, depth, parent, side, low, high = todo.pop()
            at = len(nodes)
            if parent is not None:
                nodes[parent][2 + side] = at
            if depth >= limit or len(rows) < 2:
                nodes.append([-1, 0.0, at, at, depth + expected_depth(len(rows))])
                continue
            k = int(random.integers(width))
            value = float(random.uniform(low[k], high[k]))
            nodes.append([k, value, 0, 0, 0.0])
            left = rows[:, k] < value
            below, above = high.copy(), low.copy()
            below[k] = above[k] = value
            todo += [(rows[left], depth + 1, at, 0, low, below), (rows[~left], depth + 1, at, 1, above, high)]
        table = np.array(nodes)
        return table[:, 0].astype(int), table[:, 1], table[:, 2:4].astype(int), table[:, 4]

    def scores(self, points: np.ndarray) -> np.ndarray:
        """0 to 1; the shorter the mean path, the nearer to 1."""
        total = np.zeros(len(points))
        every = np.arange(len(points))
        for split, value, children, depth in self.trees:
            at = np.zeros(len(points), int)
            while True:
                inner = split[at] >= 0
                if not inner.any():
                    break
                right = points[every, np.maximum(split[at], 0)] >= value[at]
                at = np.where(inner, children[at, right.astype(int)], at)
            total += depth[at]
        return 2.0 ** (-total / len(self.trees) / max(expected_depth(self.sample), 1.0))


def calibrated(labelled: DataFrame) -> float:
    """The score from which labelled rows (score, quality) are best taken for anomalous.

    Shares of clean rows lost and of poor rows missed are weighed alike, over a histogram
    of BINS bins; of equally good bounds the middle one. With clean rows alone it is the
    largest of their scores, with poor rows alone none are kept.
    """
    cell = F.floor(F.col("score") * BINS).cast("int")
    found = labelled.groupBy("quality", cell.alias("cell")).agg(F.count("*").alias("n")).collect()  # at most 2 * BINS rows
    clean, poor = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for row in found:
        (clean if row["quality"] else poor)[row["cell"] + 1] += row["n"]
    lost = 1 - np.cumsum(clean) / max(clean.sum(), 1)
    missed = np.cumsum(poor) / max(poor.sum(), 1)
    best = np.flatnonzero(np.isclose(lost + missed, (lost + missed).min()))
    return float(best[len(best) // 2] if poor.any() else best[0]) / BINS


def isolation_filter(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, the COUNTS, base_failed, score and kept.

    The forest is fitted on about `fit_rows` labelled rows of quality 1 that pass the base
    rules, chosen by a hash of their id; the threshold comes from all labelled rows that pass
    them. `labels` has doc_id and quality; where it repeats a doc_id, the lower
    quality counts, and rows without an id or a quality do not. Without clean ones the
    base rules alone decide (score null). Null texts have no words, and fail. Other
    columns are not looked at; an empty table gives no rows.
    """
    rows = saved(rule_statistics(docs), "rule-statistics")
    marks = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marked = saved(rows.join(marks.agg(F.min("quality").alias("quality")), "doc_id").filter("not base_failed"), "labelled")
    clean = marked.filter("quality = 1")
    share = max(1, clean.count() // fit_rows)
    sample = clean.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(share)) == 0).orderBy("doc_id").limit(2 * fit_rows).toPandas()
    if not len(sample):
        return rows.withColumns({"score": F.lit(None).cast("double"), "kept": ~F.col("base_failed")})
    points = features(sample)
    limits = np.quantile(points, USUAL, axis=0)
    shared = docs.sparkSession.sparkContext.broadcast((Forest(excess(points, limits)), limits))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            forest, limits = shared.value
            yield batch.assign(score=forest.scores(excess(features(batch), limits)))

    def scored(df: DataFrame) -> DataFrame:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return df.mapInPandas(score, f"{fields}, score double")

    bound = calibrated(scored(marked))
    return scored(rows).withColumn("kept", ~F.col("base_failed") & (F.col("score") < F.lit(bound)))
