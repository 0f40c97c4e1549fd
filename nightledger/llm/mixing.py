"""Mixing to target weights with soft membership.

A classifier learnt from labelled rows gives each document the probabilities of the
domains. Projected gradient on weighted least squares then finds nonnegative rates,
copies per document, as near to 1 as can be, under which the expected tokens of the domains match their targets.
Steps add up before they are projected, so a rate is one function of the probabilities, and each
step is one small sum over the distinct probability vectors.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import saved, small_batches, text_key
from nightledger.llm.toxicity import terms

#: Bounds of what is fitted: labelled rows looked at, and telling terms of a domain.
FIT_ROWS = 6000
TERMS = 1024
LEAST_SHARE = 0.01
DEVIATIONS = 6.0

#: Probabilities are multiples of 1 / GRID: the distinct vectors are bounded, and steps sum over those.
GRID = 64
#: What may be missing of a domain's tokens, in parts of those there are.
TOLERANCE = 1e-4
#: Weight of the distance from 1 against the residual: next to nothing, and what stands where targets cannot be met.
RIDGE, COMPROMISE = 1e-10, 5e-2
#: Where steps no longer get anywhere; far more than convex problems of this size take.
MOST_STEPS = 300

SIGNS = "#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))


def signals(text: str | None, found: dict[str, int], telling: list[set[str]]) -> list[float]:
    """What the classifier sees: telling terms of each domain, and shares of signs, capitals, marks and repeats."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = sum(n for t, n in found.items() if not t.endswith("*"))
    most = max((n for t, n in found.items() if not t.endswith("*")), default=0)
    whole, letters = max(words, 1), max(len(data), 1)
    return [
        *(math.log1p(len(found.keys() & known)) for known in telling),
        math.log1p(100 * sum(map(text.count, SIGNS)) / whole),
        math.log1p(100 * (len(data) - len(data.translate(None, _UPPER))) / letters),
        math.log1p(100 * text.count("!") / whole),
        math.log1p(letters / whole),
        math.log1p(words / max(len(found), 1)),
        most / whole,
        math.log1p(words),
    ]


class Softmax:
    """Multinomial logistic regression on standardised signals."""

    def __init__(self, points: np.ndarray, domains: np.ndarray, classes: int, rounds: int = 600, ridge: float = 1e-3):
        self.mean, self.scale = points.mean(axis=0), points.std(axis=0) + 1e-6
        x = self._design(points)
        wanted = np.eye(classes)[domains]
        self.weights = np.zeros((x.shape[1], classes))
        first, second = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for k in range(1, rounds + 1):
            slope = x.T @ (self._share(x) - wanted) / len(x) + ridge * self.weights
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            self.weights -= 0.05 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-9)

    def _design(self, points: np.ndarray) -> np.ndarray:
        return np.column_stack([np.clip((points - self.mean) / self.scale, -8, 8), np.ones(len(points))])

    def _share(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        return self._share(self._design(points))


def on_grid(shares: np.ndarray) -> np.ndarray:
    """Shares as whole numbers of 1 / GRID that add up to GRID, by largest remainders."""
    scaled = shares * GRID
    whole = np.floor(scaled + 1e-9).astype(np.int64)
    rest = GRID - whole.sum(axis=1)
    order = np.argsort(-(scaled - whole), axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    return whole + (rank < rest[:, None])


def _fit(docs: DataFrame, labelled: DataFrame, domains: list[str], fit_rows: int):
    """Telling terms of each domain and the classifier, from a bounded sample of labelled rows."""
    marks = labelled.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("domain").alias("domain"))
    share = max(1, -(-marks.count() // fit_rows))
    chosen = saved(marks.filter(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(share)) == 0), "labelled-domains")
    # About fit_rows ids, whatever the input.
    rows = docs.join(F.broadcast(chosen), "doc_id")
    number = {d: k for k, d in enumerate(domains)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[tuple[str, str], int] = {}
            for domain, text in zip(batch["domain"], batch["text"]):
                for term in terms(text):
                    out[domain, term] = out.get((domain, term), 0) + 1
            yield pd.DataFrame([(d, t, n) for (d, t), n in out.items()], columns=["domain", "term", "n"])

    sizes = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    total = sum(sizes.values())
    counts = rows.select("domain", "text").mapInPandas(count, "domain string, term string, n long")
    counts = saved(counts.groupBy("domain", "term").agg(F.sum("n").alias("n")), "term-counts")
    every = counts.groupBy("term").agg(F.sum("n").alias("every"))
    telling: list[set[str]] = []
    for domain in domains:
        size = sizes.get(domain, 0)
        part = size / total
        above = (F.col("n") - F.col("every") * part) / F.sqrt(F.col("every") * part * (1 - part) + 1)
        best = (
            counts.filter((F.col("domain") == domain) & (F.col("n") >= max(5, LEAST_SHARE * size))).join(every, "term")
            .withColumn("above", above).filter(F.col("above") >= DEVIATIONS).orderBy(F.desc("above"), "term").limit(TERMS)
        )
        telling.append({r["term"] for r in best.select("term").collect()} if 0 < part < 0.5 else set())

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = [signals(t, terms(t), telling) for t in batch["text"]]
            yield pd.DataFrame({"number": batch["domain"].map(number).astype("int64"), "point": points})

    measured = rows.select("domain", "text").mapInPandas(measure, "number long, point array<double>").collect()
    points = np.array([r["point"] for r in measured])
    return telling, Softmax(points, np.array([r["number"] for r in measured]), len(domains))


def memberships(docs: DataFrame, labelled: DataFrame, domains: list[str], fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, n_tokens (words) and p, whole numbers of 1 / GRID per domain; without two labelled domains all alike."""
    model = _fit(docs, labelled, domains, fit_rows)
    even = on_grid(np.full((1, len(domains)), 1 / len(domains)))[0]

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            found = [terms(t) for t in batch["text"]]
            size = [sum(n for t, n in f.items() if not t.endswith("*")) for f in found]
            if model is None:
                p = np.tile(even, (len(batch), 1))
            else:
                telling, classify = model
                p = on_grid(classify(np.array([signals(t, f, telling) for t, f in zip(batch["text"], found)])))
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("Int64"), "text_key": batch["text_key"], "n_tokens": size, "p": list(p)}
            )

    return docs.mapInPandas(predict, "doc_id long, text_key long, n_tokens long, p array<long>")


def rate(p: Column, push: list[float], most: float | None = None) -> Column:
    """1 and the push of each domain times its probability, from 0 to `most`."""
    if not push:
        return F.lit(1.0)
    parts = F.zip_with(p, F.lit([float(v) / GRID for v in push]), lambda a, b: a * b)
    moved = F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(1.0), lambda r, v: r + v))
    return moved if most is None else F.least(F.lit(float(most)), moved)


def solve(members: DataFrame, weights: list[float], repeat: float = 1.0, most: float | None = None) -> list[float]:
    """The push per domain under which expected tokens per domain meet their targets (see `rate`).

    The domain of the largest weight is to have `repeat` times its tokens, and the others
    theirs in proportion; of a domain scarcer than that, documents are repeated, up to `most` times if given. Steps go
    against the gradient in the metric of the documents whose rates are free to move, halved until they
    bring the convex dual of the least-squares problem down, so that they end at its only solution. If that misses a target, none
    can meet all of them: a warning tells what is missing, and a compromise stands that stays near 1.
    """
    cells = saved(members.groupBy("p").agg(F.sum("n_tokens").alias("tokens")), "membership-cells")
    k = len(weights)
    share_of = lambda i: F.element_at("p", i + 1) / GRID
    there = np.array(cells.agg(*(F.sum(F.col("tokens") * share_of(i)) for i in range(k))).first(), float)
    if not np.isfinite(there).all() or not there.any():
        return []
    share = np.array(weights, float) / sum(weights)
    main = int(share.argmax())
    target = repeat * share * there[main] / share[main]
    known = there > 0
    size = np.where(known, there, 1.0)

    def measured(push: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The dual's sum over documents, tokens per domain, and how those move with the push."""
        moved = rate(F.col("p"), push.tolist(), most)
        free = F.aggregate(F.zip_with("p", F.lit((push / GRID).tolist()), lambda a, b: a * b), F.lit(1.0), lambda r, v: r + v)
        inside = (free > 0) & (F.lit(True) if most is None else free < most)
        weigh = lambda value: F.sum(F.col("tokens") * value)
        live = [weigh(F.when(inside, share_of(i) * share_of(j)).otherwise(0.0)) for i in range(k) for j in range(i, k)]
        row = cells.agg(weigh(moved * free - moved * moved / 2), *(weigh(moved * share_of(i)) for i in range(k)), *live).first()
        both = np.zeros((k, k))
        both[np.triu_indices(k)] = row[1 + k :]
        return float(row[0]), np.array(row[1 : 1 + k], float), both + np.triu(both, 1).T

    def fitted(ridge: float) -> tuple[np.ndarray, np.ndarray]:
        """Push and what is missing per domain, in parts of its tokens."""
        push = np.zeros(k)
        dual = lambda value, push: value - target @ push + ridge / 2 * (size * push) @ push
        value, tokens, curve = measured(push)
        for _ in range(MOST_STEPS):
            slope = tokens - target + ridge * size * push
            if np.abs(slope / size).max() < TOLERANCE / 10:
                break
            step = -np.linalg.solve(curve + np.diag((ridge + 1e-12) * size), slope)
            part, now = 1.0, dual(value, push)
            while part > 1e-12:
                tried = measured(push + part * step)
                if dual(tried[0], push + part * step) <= now + 1e-4 * part * (slope @ step):
                    break
                part /= 2
            else:
                break
            push = push + part * step
            value, tokens, curve = tried
        return push, np.where(known, (target - tokens) / size, 0.0)

    push, missing = fitted(RIDGE)
    unmet = {i: None for i in range(k) if not known[i] and target[i] > 0}
    if np.abs(missing).max() >= TOLERANCE:
        push, missing = fitted(COMPROMISE)
        unmet |= {i: float(v) for i, v in enumerate(missing) if abs(v) >= TOLERANCE}
    if unmet:
        warnings.warn(f"mix targets cannot be met; part of the domain's tokens that is missing, by domain number: {unmet}", stacklevel=2)
    return [float(v) for v in push]


def mix(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], repeat: float = 1.0, fit_rows: int = FIT_ROWS,
    most: float | None = None,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_tokens, p_<domain>, rate, text_key and copies.

    `labelled` has doc_id and domain (of repeated ids the first domain by name counts;
    rows without an id or of another domain do not); `targets` weighs the domains. The rate is the expected number
    of copies, at most `most` if given; copies is that number, rounded up or down by a hash of doc_id and length. Null texts are
    empty, with no tokens; null and repeated doc_ids are rated each for itself. Other
    columns are not looked at. Without labelled rows of two domains all rates follow from even
    memberships; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    domains = sorted(targets)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").alias("text")
    )
    members = saved(memberships(texts, labelled, domains, fit_rows), "memberships")
    found = solve(members, [targets[d] for d in domains], repeat, most)
    chance = F.pmod(F.xxhash64("doc_id", "n_tokens", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return members.select(
        "doc_id", "n_tokens", *((F.element_at("p", k + 1) / GRID).alias(f"p_{d}") for k, d in enumerate(domains)),
        rate(F.col("p"), found, most).alias("rate"), "text_key",
    ).withColumn("copies", F.floor(F.col("rate") + chance).cast("long"))


#: Domains of the label table, and how much of the tokens each is to have.
TARGETS = {"clean": 0.97, "poor": 0.01, "toxic": 0.02}


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): poor, toxic or clean, in this order of precedence; rows without both labels have none."""
    domain = F.when(F.col("quality") == 0, "poor").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")
    known = labels.filter("quality is not null and toxic is not null")
    return known.select("doc_id", domain.alias("domain")).filter("domain is not null")
