"""Repeated passages: paragraph MinHash banding, exact Jaccard, and removals clustered by components.

Paragraphs are the lines of a text, and, so that a passage is found wherever it has
been put in, windows of WINDOW words that start at minima of the text itself. Lines are banded by
MinHash, and lines that collide are linked if their shingle sets are similar enough.
A window's band is its whole content; windows of one document alone go by a count of 64-bit names, and equal windows grow on both sides for as long as words
agree with another document. Either way, the cluster's first paragraph stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import Scratch, early_cleanup, small_batches, text_key
from nightledger.llm.hashing import SHINGLE, ascii_lower, hash_words, mix, windows
from nightledger.llm.linking import crowded, link_buckets

NUMERATOR, DENOMINATOR = 80, 100
RECALL = 0.9995
#: Lines of fewer words are not paragraphs of their own, unless told otherwise.
LINE_WORDS = 40
#: Shorter passages may be missed, unless told otherwise: one of WINDOW + spread words holds a window whole, as each
#: spread consecutive shingles start one.
PASSAGE_WORDS, WINDOW = 50, 18
#: Rounds in which tails meet the first one of their group, before lengths are compared one by one.
MEETINGS = 3
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def tune_bands(similarity: float = NUMERATOR / DENOMINATOR, recall: float = RECALL, most_rows: int = 4) -> tuple[int, int]:
    """(bands, rows): as many rows as allowed, and the fewest bands that miss at most 1 - recall of pairs at the threshold."""
    bands = int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**most_rows)))
    return bands, most_rows


BANDS, ROWS = tune_bands()
_FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
_SHIFTS = mix(_FACTORS)


def band_keys(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of keys, one per band, for each set that `shingles` holds one after another from `starts` on; none is empty."""
    least = np.empty((BANDS * ROWS, len(starts)), np.uint64)
    for row, factor, shift in zip(least, _FACTORS, _SHIFTS):
        row[:] = np.minimum.reduceat(shingles * factor + shift, starts)
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], len(starts), axis=1)
    for row in least.reshape(BANDS, ROWS, len(starts)).transpose(1, 0, 2):
        keys = mix(keys * _BASE + row)
    return keys.T


def anchors(found: np.ndarray, n_words: int, spread: int) -> np.ndarray:
    """Starts of windows: the word where the least shingle of each `spread` consecutive ones begins."""
    starts, least, have, spread = np.arange(len(found), dtype=np.int32), found, 1, min(spread, len(found))
    while have < spread:
        # From the least of `have` to that of twice as many; the first of equal ones.
        step = min(have, spread - have)
        left, right = least[:-step], least[step:]
        starts, have = np.where(left <= right, starts[:-step], starts[step:]), have + step
        least = np.minimum(left, right)
    if len(starts):
        new = np.ones(len(starts), bool)
        np.not_equal(starts[1:], starts[:-1], out=new[1:])
        starts = starts[new]
    return starts[starts + WINDOW <= n_words]


def words_and_lines(text: bytes, least: int) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The words, and (first word, end) of the lines that have at least `least` of them; split once."""
    lines = [line.split() for line in text.split(b"\n")]
    ends = list(accumulate(map(len, lines)))
    return list(chain.from_iterable(lines)), [(end - len(line), end) for line, end in zip(lines, ends) if len(line) >= least]


class Spans:
    """Hashes of any spans of a row of words, the same wherever the words stand: differences of running sums."""

    _up = _down = np.ones(1, np.uint64)

    def __init__(self, words: np.ndarray):
        n = len(words)
        if len(Spans._up) < n + 1:
            ones = np.ones(2 * n + 2, np.uint64)
            Spans._up, Spans._down = (np.cumprod(np.concatenate([ones[:1], ones[1:] * base])) for base in (_BASE, _INVERSE))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * Spans._down[:n], out=self.sums[1:])

    def __call__(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of each span, the words' sum times falling powers of the base; 0 without words."""
        return (self.sums[end] - self.sums[first]) * Spans._up[np.maximum(end, 1) - 1]


def _sets(shingles: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted shingles of all lines one after another, where each line's start, and 128 bits of each set as two signed numbers."""
    values = np.concatenate(shingles)
    ends = np.cumsum([len(own) for own in shingles])
    for end, own in zip(ends, shingles):
        values[end - len(own) : end].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[ends[:-1]] = True
    starts = np.concatenate([[0], np.cumsum(new)[ends[:-1] - 1]])
    values = values[new]
    # Less 2^63, as signed numbers.
    low, high = (x ^ np.uint64(1 << 63) for x in (np.add.reduceat(values, starts), np.bitwise_xor.reduceat(mix(values), starts)))
    return values, starts, low.view(np.int64), high.view(np.int64)


def _line_keys(lines: list[tuple], shingles: list[np.ndarray]) -> pd.DataFrame:
    values, starts, low, high = _sets(shingles)
    keys = band_keys(values, starts).view(np.int64)
    frame = pd.DataFrame(lines, columns=["row_id", "doc_id", "text_key", "first", "end"])
    return frame.assign(low=low, high=high, keys=list(keys), firsts=None, names=None)


def _paragraphs(batches: Iterator[pd.DataFrame], line_words: int, spread: int) -> Iterator[pd.DataFrame]:
    """A row per text with the places and 64-bit names of its windows, and one per line."""
    for batch in batches:
        rows, lines, shingles, held = [], [], [], 0
        for row_id, doc_id, key, text in zip(batch["row_id"], batch["doc_id"], batch["text_key"], batch["text"]):
            words, ranges = words_and_lines(ascii_lower(text), line_words)
            hashes = hash_words(words)
            every = windows(hashes, SHINGLE)
            starts = anchors(every, len(hashes), spread)
            if len(starts):
                names = mix(Spans(hashes)(starts, starts + WINDOW))
                rows.append((row_id, doc_id, key, starts.astype(np.int32), names.view(np.int64)))
            for first, end in ranges:
                lines.append((row_id, doc_id, key, first, end))
                shingles.append(every[first : end - SHINGLE + 1])
                held += len(shingles[-1])
                if held > 1 << 16:
                    yield _line_keys(lines, shingles)
                    lines, shingles, held = [], [], 0
        if lines:
            yield _line_keys(lines, shingles)
        if rows:
            frame = pd.DataFrame(rows, columns=["row_id", "doc_id", "text_key", "firsts", "names"])
            none = pd.Series([None] * len(rows), dtype="Int64")
            yield frame.assign(first=none, end=none, low=none, high=none, keys=None)


def _line_sets(batches: Iterator[pd.DataFrame], line_words: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        shingles, held = [], 0
        for text in batch["text"]:
            words, ranges = words_and_lines(ascii_lower(text), line_words)
            if not ranges:
                continue
            every = windows(hash_words(words), SHINGLE)
            shingles += (every[first : end - SHINGLE + 1] for first, end in ranges)
            held += len(every)
            if held > 1 << 16:
                yield _set_rows(shingles)
                shingles, held = [], 0
        if shingles:
            yield _set_rows(shingles)


def _set_rows(shingles: list[np.ndarray]) -> pd.DataFrame:
    values, starts, low, high = _sets(shingles)
    return pd.DataFrame({"low": low, "high": high, "shingles": np.split(values.view(np.int64), starts[1:])})


def _salted(spans: np.ndarray, n: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(spans + (2 * n + right).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def _around(batches: Iterator[pd.DataFrame], reach: int) -> Iterator[pd.DataFrame]:
    """The whole name of each window, and on both sides how many words are looked at and their hash; at most 64 texts at once."""
    for whole in batches:
        for start in range(0, len(whole), 64):
            batch, out = whole.iloc[start : start + 64], []
            for row_id, doc_id, n_rows, text, firsts in zip(*(batch[c] for c in ("row_id", "doc_id", "n_rows", "text", "firsts"))):
                words = hash_words(ascii_lower(text).split())
                first, spans = np.asarray(firsts, np.int64), Spans(words)
                end = first + WINDOW
                left, right = np.minimum(first, reach), np.minimum(len(words) - end, reach)
                low, high = (mix(s(first, end)) for s in (spans, Spans(mix(words))))
                tails = _salted(spans(first - left, first), left, left * 0), _salted(spans(end, end + right), right, right * 0 + 1)
                same = (np.full(len(first), value, np.int64) for value in (row_id, doc_id, n_rows))
                out.append((low, high, *same, first, *tails, left, right))
            names = ["low", "high", "row_id", "doc_id", "n_rows", "first", "tail_left", "tail_right", "reach_left", "reach_right"]
            yield pd.DataFrame({name: np.concatenate(column).view(np.int64) for name, column in zip(names, zip(*out))})


def _chains(batches: Iterator[pd.DataFrame], reach: int) -> Iterator[pd.DataFrame]:
    """For places and sides, hashes of the 1, 2, ... `reach` words there, as far as there are words; 32 bits will do beside the class."""
    columns = ["firsts", "rights", "lows", "highs", "tails", "lasts", "ns"]
    for whole in batches:
        for start in range(0, len(whole), 64):
            out = []
            for row_id, doc_id, text, *arrays in zip(*(whole.iloc[start : start + 64][c] for c in ("row_id", "doc_id", "text", *columns))):
                words = hash_words(ascii_lower(text).split())
                first, right, low, high, tail, last, n = (np.asarray(a, np.int64) for a in arrays)
                there = np.where(right, np.minimum(len(words) - first - WINDOW, reach), np.minimum(first, reach))
                k = np.arange(1, reach + 1)
                begin = np.where(right[:, None], first[:, None] + WINDOW, np.maximum(first[:, None] - k, 0))
                end = np.where(right[:, None], np.minimum(begin + k, len(words)), first[:, None])
                found = mix(_salted(Spans(words)(begin, end), k[None, :], right[:, None]) + high.view(np.uint64)[:, None])
                found = (found >> np.uint64(32)).astype(np.uint32).view(np.int32)
                chains = (row[:m] for row, m in zip(found, there))
                out += zip([row_id] * len(n), [doc_id] * len(n), first, right, low, high, tail, last, n, chains)
            yield pd.DataFrame(out, columns=["row_id", "doc_id", "first", "right", "low", "high", "tail", "last_id", "n", "chain"])


_CLASS = ["low", "high"]


def _reaches(around: DataFrame, held: DataFrame, scratch: Scratch, reach: int) -> DataFrame:
    """low, high, right, tail, owner, any, behind, every: how far windows with the same words around them agree with another document.

    `any` words are also in another document on that side of the same window, `every` times in all; of the
    first place of the tail (owner), `behind` of them also in an earlier place, of its other places all.
    A tail is a class's windows with the same words, up to `reach`, on that side. Where a class has one tail, all of it
    is in all of its documents: such classes are left out. Others compare one chain per tail, made from the texts again.
    """
    place = F.struct("doc_id", "row_id", "first")
    sides = F.explode(F.array(*(F.struct(F.lit(right).alias("right"), F.col(f"tail_{side}").alias("tail")) for right, side in ((0, "left"), (1, "right")))))
    tails = (
        around.select(*_CLASS, "doc_id", "row_id", "first", "n_rows", sides.alias("side")).select("*", "side.*")
        .groupBy(*_CLASS, "right", "tail").agg(F.min(place).alias("owner"), F.max("doc_id").alias("last_id"), F.sum("n_rows").alias("n"))
    )
    tails = scratch.save(tails, "tails")
    several = tails.groupBy(*_CLASS, "right").agg(F.count("*").alias("tails")).filter("tails > 1").drop("tails")
    owners = scratch.save(tails.join(several, [*_CLASS, "right"], "left_semi"), "owners")
    scratch.drop("tails")
    wanted = F.struct(F.col("owner.first").alias("first"), "right", *_CLASS, "tail", "last_id", "n")
    wanted = owners.groupBy(F.col("owner.row_id").alias("row_id")).agg(F.collect_list(wanted).alias("w"))
    fields = {"firsts": "first", "rights": "right", "lows": "low", "highs": "high", "tails": "tail", "lasts": "last_id", "ns": "n"}
    wanted = wanted.select("row_id", *(F.col(f"w.{field}").alias(name) for name, field in fields.items()))
    schema = "row_id long, doc_id long, first int, right int, low long, high long, tail long, last_id long, n long, chain array<int>"
    chains = held.select("row_id", "doc_id", "text").join(wanted, "row_id").mapInPandas(lambda batches: _chains(batches, reach), schema)
    chains = scratch.save(chains, "chains")
    reaches = scratch.save(_agreement(chains, scratch), "reaches")
    scratch.drop("owners", "chains", *(name for name in list(scratch.paths) if name.startswith("compared-")))
    return reaches


def _agreement(chains: DataFrame, scratch: Scratch) -> DataFrame:
    """low, high, right, tail, owner, any, behind, every, as `_reaches` says.

    Tails of a class and side meet the one whose place is first. Those that leave it after the same number of words by
    the same word are a group of the next round, the others have met all that they agree with further.
    A round is a partial minimum and a join by group, and takes one tail at least from each group. What MEETINGS rounds
    leave is told by the hashes of all lengths beyond those met: the same result, whichever way.
    """
    two = F.col("owner.doc_id") != F.col("last_id")
    live = chains.select(
        *_CLASS, "right", "tail", F.struct("doc_id", "row_id", "first").alias("owner"), "last_id", "n", "chain",
        F.xxhash64(*_CLASS, "right").alias("group"),
    ).withColumns({"any": F.when(two, F.size("chain")).otherwise(F.lit(0)), "behind": F.lit(0)})
    group, done = ["low", "group"], None
    for turn in range(MEETINGS):
        first = F.min(F.struct("owner", "last_id", "chain")).alias("first_one")
        met = live.join(live.groupBy(*group).agg(first, F.count("*").alias("size")), group)
        parts = F.array_position(F.zip_with("chain", "first_one.chain", lambda x, y: F.coalesce(x == y, F.lit(False))), False)
        met = met.select(
            *live.columns, "size", (F.col("owner") == F.col("first_one.owner")).alias("leads"),
            F.when(parts == 0, F.size("chain")).otherwise(parts.cast("int") - 1).alias("common"),
            F.col("first_one.owner.doc_id").alias("first_id"), (F.col("first_one.owner.doc_id") != F.col("first_one.last_id")).alias("first_two"),
        )
        met = scratch.save(met, f"met-{turn}")
        other = two | (F.col("owner.doc_id") != F.col("first_id"))
        lengths = met.filter("not leads").groupBy(*group, "common").agg(F.sum("n").alias("n"), F.max(other).alias("other"))
        # At most one entry for each length.
        lengths = lengths.groupBy(*group).agg(
            F.max(F.when(F.col("other"), F.col("common"))).alias("most"), F.collect_list(F.struct("common", "n")).alias("lengths")
        )
        most = F.coalesce("most", F.lit(0))
        reached = F.when(F.col("first_two") | other, F.col("common")).otherwise(F.least(F.col("common"), most))
        now = met.join(lengths, group, "left").withColumns({
            "any": F.greatest("any", F.when(F.col("leads"), most).otherwise(reached)),
            "behind": F.when(F.col("leads"), F.col("behind")).otherwise(F.greatest("behind", "common")),
        })
        as_far = F.filter(F.coalesce("lengths", F.array().cast("array<struct<common:int,n:bigint>>")), lambda x: x["common"] >= F.col("any"))
        now = now.withColumns({
            "every": F.aggregate(as_far, F.col("n"), lambda total, x: total + x["n"]),
            "done": F.col("leads") | (F.size("chain") == F.col("common")),
        })
        left = F.when(~F.col("done"), F.xxhash64("group", "common", F.get("chain", F.col("common"))))
        now = now.select(
            *_CLASS, "right", "tail", "owner", "last_id", "n", F.when(~F.col("done"), F.col("chain")).alias("chain"),
            left.alias("group"), "any", "behind", "every", "done",
        )
        now = scratch.save(now, f"compared-{turn}")
        scratch.drop(f"met-{turn}")
        ended = now.filter("done").select(*_CLASS, "right", "tail", "owner", "any", F.least("any", "behind").alias("behind"), "every")
        done = ended if done is None else done.union(ended)
        live = now.filter("not done").select(*live.columns)
    key = [*group, "k", "hash"]
    tall = live.select(*group, *_CLASS[1:], "right", "tail", "owner", "last_id", "n", "any", "behind", F.posexplode("chain").alias("k", "hash"))
    tall = tall.filter("k >= behind").drop("any", "behind")
    shared = tall.groupBy(*key).agg(
        F.min("owner").alias("least"), F.max("last_id").alias("last_id"), F.sum("n").alias("every")
    ).filter("least.doc_id != last_id").drop("last_id")
    further = tall.drop("last_id", "n").join(scratch.save(shared, "compared-lengths"), key).groupBy(*_CLASS, "right", "tail").agg(
        F.max(F.col("k") + 1).alias("more"), F.max(F.when(F.col("least") != F.col("owner"), F.col("k") + 1)).alias("after"),
        F.max_by("every", "k").alias("every"),
    )
    far = F.greatest("any", F.coalesce("more", F.lit(0)))
    rest = live.join(further, [*_CLASS, "right", "tail"], "left").select(
        *_CLASS, "right", "tail", "owner", far.alias("any"), F.least(far, F.greatest("behind", F.coalesce("after", F.lit(0)))).alias("behind"), "every"
    )
    return rest if done is None else done.union(rest)


def _grown(texts: DataFrame, found: DataFrame, scratch: Scratch, reach: int) -> DataFrame:
    """Placed pieces (as in `repeated_passages`) of windows that are in more than one document, with what is around them.

    `found` has row_id, doc_id, text_key, firsts and names of windows. Where words around a removed
    window occur elsewhere, but not before, they are a piece of their own that stays.
    """
    # Names that one document has alone are gone before anything but names has moved.
    names = found.select("doc_id", F.explode("names").alias("name")).groupBy("name").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("last")
    ).filter("least != last").select("name")
    windows_of = found.select("row_id", F.explode(F.arrays_zip("firsts", "names")).alias("w")).select(
        "row_id", F.col("w.firsts").alias("first"), F.col("w.names").alias("name")
    )
    shared = windows_of.join(scratch.save(names, "shared-names"), "name", "left_semi")
    shared = shared.groupBy("row_id").agg(F.array_sort(F.collect_list("first")).alias("firsts"))
    rows = scratch.save(found.select("row_id", "doc_id", "text_key").join(shared, "row_id"), "shared-windows")
    # Rows that repeat the doc_id and the text have the same words around their windows.
    text_of = ["doc_id", "text_key"]
    starts = rows.groupBy(*text_of).agg(F.min("row_id").alias("row_id"), F.count("*").alias("n_rows"), F.first("firsts").alias("firsts"))
    starts = scratch.save(starts, "starts")
    again = starts.filter("n_rows > 1")
    repeated = not again.isEmpty()
    texts = texts.drop("row_id")
    held = texts.join(starts.filter("n_rows = 1"), text_of) if repeated else texts.join(starts, text_of)
    if repeated:
        held = held.union(texts.join(again, text_of).dropDuplicates(text_of))
    held = scratch.save(held.select("row_id", "doc_id", "n_rows", "text", "firsts"), "shared-texts")
    columns = ["low", "high", "row_id", "doc_id", "n_rows", "first", "tail_left", "tail_right", "reach_left", "reach_right"]
    schema = ", ".join(f"{c} {'int' if c.startswith(('first', 'reach')) else 'long'}" for c in columns)
    around = scratch.save(held.mapInPandas(lambda batches: _around(batches, reach), schema), "around")
    place = F.struct("doc_id", "row_id", "first")
    classes = around.groupBy(*_CLASS).agg(F.min(place).alias("keep"), F.max("doc_id").alias("last_id"), F.sum("n_rows").alias("n"))
    classes = scratch.save(classes.filter("keep.doc_id != last_id").drop("last_id"), "classes")
    reaches = _reaches(around, held, scratch, reach)
    if repeated:
        others = around.filter("n_rows > 1").withColumnRenamed("row_id", "first_row").join(
            starts.select(F.col("row_id").alias("first_row"), "doc_id", "text_key").join(rows.select("row_id", *text_of), text_of).drop(*text_of), "first_row"
        )
        around = around.filter("n_rows = 1").unionByName(others.drop("first_row"))
    x = around.drop("n_rows").join(classes, _CLASS)
    for right, side in ((0, "left"), (1, "right")):
        one = reaches.filter(F.col("right") == right).select(
            *_CLASS, F.col("tail").alias(f"tail_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in ("owner", "any", "behind", "every"))
        )
        x = x.join(one, [*_CLASS, f"tail_{side}"], "left").withColumns({
            f"any_{side}": F.coalesce(f"any_{side}", f"reach_{side}"), f"behind_{side}": F.coalesce(f"behind_{side}", F.lit(0)),
            f"owner_{side}": F.coalesce(f"owner_{side}", "keep"), f"every_{side}": F.when(F.col(f"owner_{side}").isNull(), F.col("n")).otherwise(F.col(f"every_{side}")),
        })
    gone = lambda side: F.when(place == F.col(f"owner_{side}"), F.col(f"behind_{side}")).otherwise(F.col(f"any_{side}"))
    x = x.withColumns({"place": place, "gone_left": gone("left"), "gone_right": gone("right"), "end": F.col("first") + WINDOW})
    first, end, stays = F.col("first"), F.col("end"), F.col("place") == F.col("keep")
    piece = lambda a, b, removed, keep, n: F.struct(
        a.cast("int").alias("first"), b.cast("int").alias("end"), removed.alias("removed"), keep.alias("keep"), n.cast("long").alias("n")
    )
    low = {c: first - F.col(f"{c}_left") for c in ("any", "gone")}
    high = {c: end + F.col(f"{c}_right") for c in ("any", "gone")}
    pieces = F.when(stays, F.array(piece(low["any"], high["any"], F.lit(False), F.col("keep"), F.col("n")))).otherwise(F.array(
        piece(low["gone"], high["gone"], F.lit(True), F.col("keep"), F.col("n")),
        piece(low["any"], low["gone"], F.lit(False), F.col("place"), F.col("every_left")),
        piece(high["gone"], high["any"], F.lit(False), F.col("place"), F.col("every_right")),
    ))
    pieces = x.select("row_id", "doc_id", F.explode(F.filter(pieces, lambda p: p["first"] < p["end"])).alias("piece"))
    pieces = scratch.save(pieces.select("row_id", "doc_id", "piece.*"), "pieces")
    scratch.drop("shared-names", "shared-windows", "starts", "shared-texts", "around", "classes", "reaches")
    return pieces


def repeated_passages(docs: DataFrame, line_words: int = LINE_WORDS, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """One row per maximal passage of `docs` (doc_id, text) that is repeated in another document.

    doc_id, first and end (words from 0, end exclusive), n_words, removed (false where
    a passage occurs first, by doc_id and place), cluster_id (smallest doc_id that has
    a part of it) and n_paragraphs (of the largest cluster that it has a part of). Passages of at least passage_words that occur twice word for word, A-Z and a-z
    taken as one, are always found, from their first word to their last; lines of at least line_words also if their
    five-word shingle sets have a Jaccard similarity of 0.8 or more. Overlapping paragraphs
    are merged. Repeats within one doc_id alone do not count, nor do rows without a
    doc_id; null and short texts have no paragraphs. Other columns are not looked at. An
    empty table gives no rows.
    """
    if line_words < SHINGLE or passage_words < 2 * WINDOW:
        raise ValueError(f"lines have {SHINGLE} words and passages {2 * WINDOW} at least")
    small_batches(docs.sparkSession)
    early_cleanup(docs.sparkSession)
    scratch, spread = Scratch(docs.sparkSession), passage_words - WINDOW
    texts = docs.filter("doc_id is not null").select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("text_key"), F.col("text").cast("string").alias("text"),
    )
    schema = "row_id long, doc_id long, text_key long, firsts array<int>, names array<long>, first int, end int, low long, high long, keys array<long>"
    found = texts.mapInPandas(lambda batches: _paragraphs(batches, line_words, spread), schema)
    found = scratch.save(found.withColumn("id", F.monotonically_increasing_id()), "paragraphs")
    # Between two windows of a passage, and before its first or after its last one, are at most spread - 1 words.
    pieces = _grown(texts, found.filter("names is not null"), scratch, spread - 1)

    name = ["low", "high"]
    lines = scratch.save(found.filter("keys is not null").drop("firsts", "names"), "lines")
    scratch.drop("paragraphs")
    equal = lines.groupBy(*name).agg(F.min("id").alias("class_id"), F.count("*").alias("n")).filter("n > 1")
    equal = scratch.save(equal.drop("n"), "equal-lines")
    firsts = lines.join(equal, name, "left").filter("class_id is null or class_id = id")
    linked = _linked_lines(texts, firsts.select("id", *name, "doc_id", "keys"), scratch, line_words)

    place = ["id", "row_id", "doc_id", "first", "end"]
    shared = lines.join(equal, name).select(*place, "class_id")
    alone = (
        lines.join(linked, "id", "left_semi").select(*place, F.col("id").alias("class_id"))
        .join(equal.select("class_id"), "class_id", "left_anti").select(*place, "class_id")
    )
    clustered = scratch.save(
        shared.union(alone).join(linked.select(F.col("id").alias("class_id"), "component"), "class_id", "left")
        .withColumn("cluster", F.coalesce("component", "class_id")).drop("component", "class_id", "id"),
        "clustered",
    )
    scratch.drop("lines", "equal-lines", "linked-lines")
    clusters = scratch.save(
        clustered.groupBy("cluster").agg(
            F.min(F.struct("doc_id", "row_id", "first")).alias("keep"), F.max("doc_id").alias("last_id"),
            F.count("*").alias("n"),
        ).filter("keep.doc_id != last_id").drop("last_id"),
        "clusters",
    )
    placed = clustered.join(clusters, "cluster").withColumn(
        "removed", F.struct("doc_id", "row_id", "first") != F.col("keep")
    ).select("row_id", "doc_id", "first", "end", "removed", "keep", "n").unionByName(pieces)
    so_far = Window.partitionBy("row_id", "removed").orderBy("first", "end")
    opens = F.coalesce(F.max("end").over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)) < F.col("first")
    merged = placed.withColumn("opens", opens.cast("int")).withColumn("part", F.sum("opens").over(so_far))
    return merged.groupBy("row_id", "doc_id", "removed", "part").agg(
        F.min("first").alias("first"), F.max("end").alias("end"),
        F.min("keep.doc_id").alias("cluster_id"), F.max("n").alias("n_paragraphs"),
    ).select("doc_id", "first", "end", (F.col("end") - F.col("first")).alias("n_words"), "removed", "cluster_id", "n_paragraphs")


def _linked_lines(texts: DataFrame, firsts: DataFrame, scratch: Scratch, line_words: int) -> DataFrame:
    """(id, component) of lines that similar shingle sets connect; `firsts` are lines with different sets."""
    firsts = scratch.save(firsts, "different-lines")
    members = crowded(firsts.select(F.explode("keys").alias("bucket"), "id"))
    wanted = scratch.save(firsts.join(members.select("id").distinct(), "id", "left_semi").drop("keys"), "candidate-lines")
    scratch.drop("different-lines")
    sets = (
        texts.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").select("text")
        .mapInPandas(lambda batches: _line_sets(batches, line_words), "low long, high long, shingles array<long>")
        .join(wanted.select("id", "low", "high"), ["low", "high"])
        .groupBy("id").agg(F.first("shingles").alias("shingles"))
    )
    sets = scratch.save(sets, "line-sets")
    linked = scratch.save(link_buckets(members, sets, NUMERATOR, DENOMINATOR), "linked-lines")
    scratch.drop("line-sets", "candidate-lines")
    return linked
