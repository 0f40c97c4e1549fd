"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples are dealt into blocks, and per term the index holds each block's largest
weight. That bounds the similarity of a document with any example of a block; blocks are
looked into from the highest bound on, until no bound exceeds the k-th best similarity. The
nearest examples vote by similarity, and the votes are calibrated on labelled rows that are
neither indexed nor held out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import saved, small_batches

#: Bounds of what is fitted: labelled rows looked at, terms, and indexed examples of a label.
FIT_ROWS = 10_000
TERMS = 2048
EXAMPLES = 2048
CANDIDATES = 50_000
#: A term is indexed if it is in so many toxic rows, as a number and a share, and so many standard deviations above what their share explains.
LEAST_ROWS, LEAST_SHARE = 5, 0.01
DEVIATIONS = 5.0

BLOCK = 64
NEIGHBOURS = 15
#: Similarity that the overall share of toxic rows stands for in a vote.
PRIOR = 0.25
STEM = 5
BINS = 200
FOLDS, HELD_OUT, CALIBRATION = 4, 2, 1
#: Texts whose evidence a task holds before it passes it on.
PIECE = 512

_TO_SPACE = str.maketrans({c: " " for c in ".,;:!?\"'()[]{}<>|*#$%&=+/\\_-"})


def terms(text: str | None) -> Counter:
    """Words without punctuation, in lower case, and the first letters of longer ones, with their numbers."""
    if not text:
        return Counter()
    found = Counter(text.lower().translate(_TO_SPACE).split())
    stems: Counter = Counter()
    for word, n in found.items():
        if len(word) > STEM:
            stems[word[:STEM] + "*"] += n
    found.update(stems)
    return found


class BlockMaxIndex:
    """Unit TF-IDF vectors of examples; `nearest` is exact.

    Examples are ordered by their heaviest term, so that blocks hold alike ones and
    bounds are tight.
    """

    def __init__(self, idf: dict[str, float], examples: list[tuple[int, int, Counter]], share: float, weights: tuple[float, float]):
        self.idf, self.share, self.weights = idf, share, weights
        self.number = {term: k for k, term in enumerate(idf)}
        vectors = [(doc_id, toxic, self.vector(found)) for doc_id, toxic, found in examples]
        vectors = [v for v in vectors if len(v[2][0])]
        vectors.sort(key=lambda v: (int(v[2][0][v[2][1].argmax()]), v[0]))
        self.ids = np.array([v[0] for v in vectors], np.int64)
        self.labels = np.array([v[1] for v in vectors], np.int64)
        self.blocks = -(-len(vectors) // BLOCK)
        by_term: dict[int, list[tuple[int, float]]] = {}
        for at, (_, _, (numbers, values)) in enumerate(vectors):
            for k, value in zip(numbers, values):
                by_term.setdefault(int(k), []).append((at, float(value)))
        self.highest = np.zeros((len(idf), self.blocks))
        self.postings_of: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for k, found in by_term.items():
            at = np.array([a for a, _ in found])
            value = np.array([v for _, v in found])
            for block in np.unique(at // BLOCK):
                inside = at // BLOCK == block
                self.highest[k, block] = value[inside].max()
                self.postings_of[k, int(block)] = (at[inside] % BLOCK, value[inside])

    def vector(self, found: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and weights of the indexed terms, of length 1 (empty if there are none)."""
        known = [(self.number[t], (1 + math.log(n)) * self.idf[t]) for t, n in found.items() if t in self.number]
        numbers = np.array([k for k, _ in known], int)
        values = np.array([v for _, v in known], float)
        return numbers, values / math.sqrt(float((values**2).sum())) if len(values) else values

    def nearest(self, numbers: np.ndarray, values: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """The k examples of greatest cosine above 0, as (cosine, position), by cosine, then position."""
        if not len(numbers) or not self.blocks:
            return []
        bounds = values @ self.highest[numbers]
        best: list[tuple[float, int]] = []
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or (len(best) == k and bounds[block] < -best[-1][0] - 1e-12):
                break
            cosine = np.zeros(BLOCK)
            for number, value in zip(numbers, values):
                posting = self.postings_of.get((int(number), int(block)))
                if posting:
                    cosine[posting[0]] += value * posting[1]
            best += [(-float(cosine[i]), int(block) * BLOCK + int(i)) for i in np.flatnonzero(cosine > 0)]
            best = sorted(best)[:k]
        return [(-negative, at) for negative, at in best]

    def vote(self, found: list[tuple[float, int]]) -> float:
        """Share of toxic examples among the nearest, weighted by similarity and by what each stands for."""
        total, toxic = PRIOR, PRIOR * self.share
        for cosine, at in found:
            weight = cosine * self.weights[self.labels[at]]
            total += weight
            toxic += weight * self.labels[at]
        return toxic / total


def fold(doc_id: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def _labelled(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """(doc_id, text, toxic) of at most about `fit_rows` labelled rows to learn from; their ids are few enough to send everywhere."""
    marks = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max("toxic").cast("int").alias("toxic")).filter(~fold().isin(HELD_OUT, CALIBRATION))
    share = max(1, -(-marks.count() // fit_rows))
    chosen = saved(marks.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(share)) == 0), "examples")
    return docs.join(F.broadcast(chosen), "doc_id")


def _term_rows(rows: DataFrame, known: dict[str, float] | None = None) -> DataFrame:
    """(term, n): in how many rows each term is; of `known` terms only, where given."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found = terms(text)
                total.update(t for t in found if t in known) if known is not None else total.update(found.keys())
            if len(total) > 1_000_000:
                yield pd.DataFrame({"term": list(total), "n": list(total.values())})
                total.clear()
        if total:
            yield pd.DataFrame({"term": list(total), "n": list(total.values())})

    return rows.select("text").mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> BlockMaxIndex | None:
    """The index, from a bounded sample of labelled rows; None without toxic or without other rows."""
    rows = _labelled(docs, labels, fit_rows)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    poor, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not poor or not clean:
        return None
    toxic = _term_rows(rows.filter("toxic = 1")).filter(F.col("n") >= max(LEAST_ROWS, LEAST_SHARE * poor))
    candidates = {r["term"]: r["n"] for r in toxic.orderBy(F.desc("n"), "term").limit(CANDIDATES).collect()}
    others = {r["term"]: r["n"] for r in _term_rows(rows.filter("toxic = 0"), dict.fromkeys(candidates, 0.0)).collect()}
    share = poor / (poor + clean)
    scored = []
    for term, n in candidates.items():
        every = n + others.get(term, 0)
        above = (n - every * share) / math.sqrt(every * share * (1 - share) + 1)
        if above >= DEVIATIONS:
            scored.append((-above, term, every))
    idf = {term: math.log(1 + (poor + clean) / every) for _, term, every in sorted(scored)[:TERMS]}
    examples, weights = [], []
    for label, n in ((0, clean), (1, poor)):
        found = _example_rows(rows.filter(F.col("toxic") == label), idf, min(1.0, EXAMPLES / n))
        examples += [(doc_id, label, counts) for doc_id, counts in found]
        weights.append(n / max(1, min(n, EXAMPLES)))
    return BlockMaxIndex(idf, examples, share, (weights[0], weights[1]))


def _example_rows(rows: DataFrame, idf: dict[str, float], share: float) -> list[tuple[int, Counter]]:
    """doc_id and indexed terms of about `share` of the rows, at most 2 * EXAMPLES."""

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [{t: n for t, n in terms(text).items() if t in idf} for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "terms": [list(f) for f in found], "n": [list(f.values()) for f in found]})

    part = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(21)), F.lit(1_000_000)) < int(share * 1_000_000))
    found = part.select("doc_id", "text").mapInPandas(pick, "doc_id long, terms array<string>, n array<long>")
    return [(r["doc_id"], Counter(dict(zip(r["terms"], r["n"])))) for r in found.orderBy("doc_id").limit(2 * EXAMPLES).collect()]


def isotonic(toxic: np.ndarray, rows: np.ndarray, little: float = 0.05) -> np.ndarray:
    """The non-decreasing shares nearest to toxic / rows, bin by bin; each bin has its own vote as a row of little weight."""
    level, weight, width = [], [], []
    for k, (n, total) in enumerate(zip(toxic, rows)):
        level.append((n + little * (k + 0.5) / len(rows)) / (total + little))
        weight.append(total + little)
        width.append(1)
        while len(level) > 1 and level[-2] >= level[-1]:
            a, b = weight[-2], weight[-1]
            level[-2:] = [(level[-2] * a + level[-1] * b) / (a + b)]
            weight[-2:] = [a + b]
            width[-2:] = [width[-2] + width[-1]]
    return np.repeat(level, width)


def _scored(batches: Iterator[pd.DataFrame], index: BlockMaxIndex) -> Iterator[pd.DataFrame]:
    """doc_id, vote and evidence of each text, at most PIECE texts at once."""
    for whole in batches:
        for start in range(0, len(whole), PIECE):
            batch = whole.iloc[start : start + PIECE]
            near = [index.nearest(*index.vector(terms(text))) for text in batch["text"]]
            evidence = [[{"doc_id": int(index.ids[at]), "toxic": int(index.labels[at]), "cosine": c} for c, at in n] for n in near]
            votes = [index.vote(n) for n in near]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").array, "vote": votes, "evidence": evidence})


def toxicity_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, held_out, score, predicted and evidence.

    Rows with crc32(doc_id as text) mod 4 = 2 are held out: nothing is learnt from their
    labels. Of the others, remainder 1 calibrates, and a sample of at most about
    `fit_rows` of the rest gives terms and examples. `evidence` lists the nearest
    examples (doc_id, toxic, cosine). Where `labels` repeats a doc_id, the higher label counts;
    rows without an id or label do not. Texts without an indexed term, null and
    empty ones among them, have no neighbours and get the calibrated score of such
    texts. Without toxic or without other examples every score is 0. Other columns are not looked at; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = fit(texts, labels, fit_rows)
    held_out = (fold() == HELD_OUT).alias("held_out")
    if index is None:
        nothing = F.lit(None).cast("array<struct<doc_id:bigint,toxic:bigint,cosine:double>>")
        return texts.select("doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), nothing.alias("evidence"))
    # At most 2 * EXAMPLES examples over TERMS terms, whatever the input.
    shared = docs.sparkSession.sparkContext.broadcast(index)

    schema = "doc_id long, vote double, evidence array<struct<doc_id:bigint,toxic:bigint,cosine:double>>"
    voted = lambda rows: rows.mapInPandas(lambda batches: _scored(batches, shared.value), schema)
    # The calibrating quarter is scored twice, so that nothing is stored of the others.
    votes = voted(texts)
    cell = F.least(F.floor(F.col("vote") * BINS), F.lit(BINS - 1)).cast("int")
    marks = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max("toxic").cast("int").alias("toxic")).filter(fold() == CALIBRATION)
    bins = voted(texts.filter(fold() == CALIBRATION)).join(marks, "doc_id").groupBy(cell.alias("cell")).agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).collect()
    toxic, rows = np.zeros(BINS), np.zeros(BINS)
    for row in bins:
        toxic[row["cell"]], rows[row["cell"]] = row["toxic"], row["n"]
    levels = isotonic(toxic, rows)
    # The vote breaks ties within a bin, without reaching the next one.
    score_column = F.element_at(F.lit([float(v) for v in levels]), cell + 1) * 0.999 + F.col("vote") * 0.001
    return votes.withColumn("score", score_column).select(
        "doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence"
    )
