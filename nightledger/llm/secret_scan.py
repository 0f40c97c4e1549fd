"""Secret scan with DataFrame functions alone: fixed patterns, and character Markov models for the rest.

Two first-order character models, one of random strings and one of ordinary words,
are trained from samples that the patterns label in all documents. A run of token
characters is a secret if the first model explains it better than the second, by
more than nearly all ordinary words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import saved, whole_text

#: The kinds of secrets, in the order in which spans are listed.
KINDS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
ASSIGNED_LENGTH = 6
MARKOV = "markov"
#: What the models judge: runs of token characters with a letter in them.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
#: Ordinary words for training: letters and digits, not next to an assigned value.
ORDINARY = r"[A-Za-z0-9_-]{6,}"

FIRST, LAST = ord("+"), ord("z")
SIGNS = LAST - FIRST + 1
#: Ordinary strings score below the bound but for this share: there may be secrets among them that no pattern names.
QUANTILE = 0.99
#: For the bound, scores of ordinary strings are counted in steps of 1 / SCORE_STEPS from 0 up to MOST_SCORE.
SCORE_STEPS, MOST_SCORE = 16, 1000
SMOOTHING = 0.5


def _matches(kind: str, pattern: str) -> Column:
    """(kind, gap before the match, match) for each leftmost match; a last entry without a match holds what follows.

    Texts without a match, nearly all, are passed over with one search.
    """
    text = F.col("text")
    pairs = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0)),
        lambda gap, match: F.struct(F.lit(kind).alias("kind"), F.char_length(gap).alias("gap"), match.alias("value")),
    )
    return F.when(text.rlike(pattern), pairs).otherwise(F.array().cast("array<struct<kind:string,gap:int,value:string>>"))


def _found(texts: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """A row per match with start and end in code points, and one with a null kind per text without any."""
    rows = texts.select(
        "row_id", "doc_id", F.posexplode_outer(F.concat(*(_matches(k, p) for k, p in kinds.items()))).alias("pos", "m")
    ).select("row_id", "doc_id", "pos", "m.kind", "m.gap", "m.value")
    so_far = Window.partitionBy("row_id", "kind").orderBy("pos")
    length = F.coalesce(F.char_length("value"), F.lit(0))
    return (
        rows.withColumn("end", F.sum(F.col("gap") + length).over(so_far))
        .withColumn("start", F.col("end") - length)
        .withColumn("kind", F.when(F.col("value").isNotNull(), F.col("kind")))
        .drop("pos", "gap")
    )


def _passes() -> Column:
    """Whether a match of a fixed pattern is long enough; patterns other than assignments say so themselves."""
    assigned = F.regexp_extract("value", KINDS["assign"], 1)
    return (F.col("kind") != "assign") | (F.char_length(assigned) >= ASSIGNED_LENGTH)


def _steps(value: str) -> Column:
    """The numbers of the transitions from each character to the next, from 1 on; the run is split once."""
    signs = F.transform(F.split(F.col(value), ""), lambda sign: F.ascii(sign) - FIRST)
    signs = F.slice(signs, F.lit(1), F.char_length(value))
    after = F.slice(signs, F.lit(2), F.char_length(value))
    return F.zip_with(F.slice(signs, F.lit(1), F.char_length(value) - 1), after, lambda a, b: a * SIGNS + b + 1)


def log_ratios(counts: dict[tuple[bool, int], int]) -> list[float]:
    """Log-likelihood ratio of each transition, random against ordinary, smoothed; 0 where nothing is known of either."""
    ratios = [0.0] * (SIGNS * SIGNS)
    for a in range(SIGNS):
        steps = range(a * SIGNS, (a + 1) * SIGNS)
        total = {label: sum(counts.get((label, s + 1), 0) for s in steps) for label in (True, False)}
        if not total[True] and not total[False]:
            continue
        for s in steps:
            chance = {
                label: (counts.get((label, s + 1), 0) + SMOOTHING) / (total[label] + SMOOTHING * SIGNS)
                for label in (True, False)
            }
            ratios[s] = math.log(chance[True] / chance[False])
    return ratios


def _score(value: str, ratios: list[float]) -> Column:
    table = F.lit(ratios)
    return F.aggregate(_steps(value), F.lit(0.0), lambda total, step: total + F.element_at(table, step.cast("int")))


def train(docs: DataFrame) -> tuple[list[float], float]:
    """The ratios, and the score that all but 1 in 100 ordinary strings stay below, 0 at least.

    Fitted on all documents: values of the fixed patterns are the random strings, other runs of letters and
    digits the ordinary ones. Equal strings are counted first. Counts come back as at most 2 * SIGNS^2 numbers, and scores as
    a histogram of at most MOST_SCORE * SCORE_STEPS + 1. Without random strings or
    without ordinary ones there is no model, and the bound is infinite.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", whole_text().alias("text"))
    secret = F.when(F.col("kind") == "assign", F.regexp_extract("value", KINDS["assign"], 1)).otherwise(F.col("value"))
    random = _found(texts, KINDS).filter("kind is not null").filter(_passes()).select(secret.alias("value"), F.lit(True).alias("random"))
    pattern = "|".join(f"(?:{p})" for p in KINDS.values())
    text = F.col("text")
    masked = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, " ")).otherwise(text)
    words = texts.select(F.explode(F.regexp_extract_all(masked, F.lit(f"({ORDINARY})"), F.lit(0))).alias("value"))
    ordinary = words.filter(F.col("value").rlike("[A-Za-z]")).select("value", F.lit(False).alias("random"))
    strings = random.union(ordinary).filter(F.char_length("value") > 1).groupBy("random", "value").agg(F.count("*").alias("n"))
    samples = saved(strings, "labelled-strings")
    steps = samples.select("random", "n", F.explode(_steps("value")).alias("step"))
    counts = {(r["random"], r["step"]): r["n"] for r in steps.groupBy("random", "step").agg(F.sum("n").alias("n")).collect()}
    if len({label for label, _ in counts}) < 2:
        return [0.0] * (SIGNS * SIGNS), math.inf
    ratios = log_ratios(counts)
    score = F.least(F.greatest(_score("value", ratios), F.lit(0.0)), F.lit(float(MOST_SCORE)))
    bins = samples.filter("not random").groupBy(F.ceil(score * SCORE_STEPS).alias("bin")).agg(F.sum("n").alias("n"))
    return ratios, upper_bound({r["bin"]: r["n"] for r in bins.collect()})


def upper_bound(bins: dict[int, int]) -> float:
    """The end of the first step that all but 1 - QUANTILE of the scores do not go beyond."""
    below, total = 0, sum(bins.values())
    for number in sorted(bins):
        below += bins[number]
        if below >= QUANTILE * total:
            return number / SCORE_STEPS
    return 0.0


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not looked at).

    doc_id, n_assign, n_access, n_hex, base_sha256 (of the spans of the fixed patterns)
    and spans (theirs and those of kind `markov` that touch none of them):
    kind:start:end in code points, end exclusive, by start, then kind. Null texts count
    as empty; repeated rows and null doc_ids are scanned each for itself. An empty
    table gives no rows; without labelled strings to learn from, fixed patterns alone count.
    """
    ratios, bound = train(docs)
    texts = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", whole_text().alias("text"))
    found = _found(texts, {**KINDS, MARKOV: CANDIDATE})
    base = F.col("kind").isin(*KINDS)
    random = F.col("value").rlike("[A-Za-z]") & (_score("value", ratios) > bound)
    found = found.filter(F.col("kind").isNull() | (base & _passes()) | ((F.col("kind") == MARKOV) & random))

    rank = F.lit(len(KINDS))
    for k, kind in enumerate(KINDS):
        rank = F.when(F.col("kind") == kind, F.lit(k)).otherwise(rank)
    around = Window.partitionBy("row_id").orderBy("start", "rank")
    end_before = F.max(F.when(base, F.col("end"))).over(around.rowsBetween(Window.unboundedPreceding, -1))
    next_start = F.min(F.when(base, F.col("start"))).over(around.rowsBetween(0, Window.unboundedFollowing))
    touches = (F.coalesce(end_before, F.lit(0)) > F.col("start")) | (F.coalesce(next_start, F.col("end")) < F.col("end"))
    spans = (
        found.withColumn("rank", rank)
        .withColumn("touches", touches)
        .filter(F.col("kind").isNull() | base | ~F.col("touches"))
        .withColumn("span", F.when(F.col("kind").isNotNull(), F.concat_ws(":", "kind", "start", "end")))
    )
    entry = F.when(F.col("span").isNotNull(), F.struct("start", "rank", "span"))
    listed = lambda kept: F.array_join(F.transform(F.array_sort(F.collect_list(kept)), lambda s: s["span"]), ",")
    return spans.groupBy("row_id", "doc_id").agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS),
        F.sha2(listed(F.when(base, entry)), 256).alias("base_sha256"),
        listed(entry).alias("spans"),
    ).drop("row_id")
