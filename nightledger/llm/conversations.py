"""Repair of the structure of conversations: which turns go, change role or come in.

No conversation is gathered whole: turns are sorted over all tasks, and stretches of them are
searched on their own, between each pair of states that may stand at their ends. The stretches
of a conversation are then put together by these few numbers each. Texts only pass by, turn for
turn, when edits are applied.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import saved, small_batches
from nightledger.llm.edit_search import (
    FOLLOWS, GONE, INSERT, KEEP, NEXT, OTHER, REROLE, ROLES, START, composed, summaries,
)

#: Turns searched together at most.
STRETCH = 128

_BLANKS = " \t\n\x0b\x0c\r"
_ORDER = ["key", "turn", "role", "mark"]


def _key(conv_id: str = "conv_id") -> Column:
    """The conversation as text that is never null."""
    return F.coalesce(F.concat(F.lit("c"), F.col(conv_id).cast("string")), F.lit("-"))


def _normal(turns: DataFrame) -> DataFrame:
    """key, turn, role, text and mark, the text's SHA-256; null roles and texts are one space."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.select(
        _key().alias("key"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"), F.sha2(text, 256).alias("mark"),
    )


def _sorted_turns(turns: DataFrame) -> DataFrame:
    """Without texts, numbered in order over all conversations: (seq, key, turn, role, mark, blank, truncated)."""
    last = F.right(F.rtrim("text", F.lit(_BLANKS)), F.lit(1))
    narrow = _normal(turns).select(
        *_ORDER, (F.btrim("text", F.lit(_BLANKS)) == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated")
    )
    ranged = narrow.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return saved(ranged.withColumn("seq", F.monotonically_increasing_id()), "turns")


def _stretches(rows: DataFrame) -> DataFrame:
    """One row per stretch: key, stretch, symbols, counts of faults, first and last, and the order of its first turn."""
    earliest = rows.groupBy("key", "role", "mark").agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("new"))
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(F.col("truncated"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise(OTHER)
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper(role)).otherwise(role)
    marked = rows.join(earliest, "seq", "left").withColumn("fault", fault).select(
        "key", F.expr(f"seq div {STRETCH}").alias("stretch"), "seq", "turn", "role", "mark", "fault",
        initial.alias("initial"), symbol.alias("symbol"),
    )
    count = lambda name: F.count(F.when(F.col("fault") == name, 1)).alias(name)
    found = marked.groupBy("key", "stretch").agg(
        F.sort_array(F.collect_list(F.struct("seq", "symbol", "initial"))).alias("turns"),
        F.min(F.struct("seq", "turn", "role", "mark")).alias("at"), count("blank"), count("duplicate"), count("truncated"),
    )
    in_order = Window.partitionBy("key").orderBy("stretch")
    before = F.lag(F.expr("element_at(turns, -1).initial")).over(in_order)
    initials = F.expr("concat(if(before is null, cast(array() as array<string>), array(before)), transform(turns, t -> t.initial))")
    illegal = F.expr(
        "size(filter(zip_with(initials, slice(initials, 2, size(initials)), (a, b) -> concat(a, b)), "
        "p -> p is not null and p not in ('su', 'ua', 'au')))"
    )
    whole = found.withColumn("before", before).withColumn("last", F.lead("stretch").over(in_order).isNull())
    return saved(
        whole.withColumn("initials", initials).select(
            "key", "stretch", F.col("before").isNull().alias("first"), "last", "at.turn", "at.role", "at.mark",
            "blank", "duplicate", "truncated", illegal.cast("long").alias("illegal"),
            F.array_join(F.expr("transform(turns, t -> t.symbol)"), "").alias("symbols"),
        ),
        "stretches",
    )


def _searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["key", "stretch", "start", "end", "cost", "rank", "edits", "single"]
    for batch in batches:
        rows = [
            (row.key, row.stretch, *way, row.first and row.last)
            for row in batch.itertuples(index=False) for way in summaries(row.symbols, row.first, row.last)
        ]
        yield pd.DataFrame(rows, columns=names)


def _composed(key: tuple[str], rows: pd.DataFrame) -> pd.DataFrame:
    """The way through the stretches of a conversation."""
    stretches: dict[int, list] = {}
    for stretch, *way in zip(*(rows[name].tolist() for name in ("stretch", "start", "end", "cost", "rank"))):
        stretches.setdefault(stretch, []).append(way)
    numbers = sorted(stretches)
    chosen = composed([stretches[number] for number in numbers])
    return pd.DataFrame({
        "key": key[0], "stretch": numbers, "start": [start for start, _ in chosen], "end": [end for _, end in chosen],
    })


def _chosen(stretches: DataFrame) -> DataFrame:
    """(key, stretch, cost, edits) of every stretch."""
    ways = saved(
        stretches.select("key", "stretch", "symbols", "first", "last").mapInPandas(
            _searched, "key string, stretch long, start int, end int, cost long, rank int, edits string, single boolean"
        ),
        "ways",
    )
    several = ways.filter("not single")
    path = several.select("key", "stretch", "start", "end", "cost", "rank").groupBy("key").applyInPandas(
        _composed, "key string, stretch long, start int, end int"
    )
    whole = ways.filter("single").unionByName(several.join(path, ["key", "stretch", "start", "end"]), allowMissingColumns=True)
    return saved(whole.select("key", "stretch", "cost", "edits"), "edits")


class Editor:
    """Applies edits to turns that come in order, one conversation after the other."""

    def __init__(self):
        self.key, self.edits, self.state, self.position = None, deque(), START, 0

    def turns(self, key, edits, role, text) -> Iterator[tuple]:
        """What comes out when edits for the next turns come in, or the next turn."""
        if key != self.key:
            yield from self.rest()
            self.key, self.edits, self.state, self.position = key, deque(), START, 0
        if edits is not None:
            self.edits.extend(edits)
            return
        while self.edits[0] == INSERT:
            yield self._next_role(self.edits.popleft(), "")
        edit = self.edits.popleft()
        if edit == KEEP:
            self.state = FOLLOWS[self.state, role[0]]
            yield self._row(edit, role, text)
        elif edit == REROLE:
            yield self._next_role(edit, text)

    def rest(self) -> Iterator[tuple]:
        """The turns inserted at the end."""
        while self.edits:
            yield self._next_role(self.edits.popleft(), "")

    def _next_role(self, edit: str, text: str) -> tuple:
        self.state = NEXT[self.state]
        return self._row(edit, ROLES[self.state], text)

    def _row(self, edit: str, role: str, text: str) -> tuple:
        self.position += 1
        return self.key, self.position - 1, edit, role, text


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    editor, names = Editor(), ["key", "position", "edit", "role", "text"]
    for batch in batches:
        rows = [out for row in zip(batch["key"], batch["edits"], batch["role"], batch["text"]) for out in editor.turns(*row)]
        yield pd.DataFrame(rows, columns=names)
    yield pd.DataFrame(list(editor.rest()), columns=names)


def _repaired(turns: DataFrame, stretches: DataFrame, edits: DataFrame) -> DataFrame:
    """The turns after their edits: each task gets conversations in order, the edits of a stretch before its first turn."""
    plans = stretches.select("key", "stretch", "turn", "role", "mark").join(edits.select("key", "stretch", "edits"), ["key", "stretch"])
    texts = _normal(turns).select(*_ORDER, F.lit(None).cast("long").alias("stretch"), F.lit(None).cast("string").alias("edits"), "text")
    both = plans.select(*_ORDER, "stretch", "edits", F.lit(None).cast("string").alias("text")).unionByName(texts)
    in_order = both.repartition("key").sortWithinPartitions(*_ORDER, F.col("edits").isNull(), "stretch")
    return in_order.select("key", "edits", "role", "text").mapInPandas(
        _edited, "key string, position long, edit string, role string, text string"
    )


def repair_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per conversation of `turns` (conv_id, turn, role, text) what was found and done, and the turns after that.

    The first has key, conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit (see edit_search for the
    edits and their costs); the second key, position, edit, role and text of the turns that
    stay or come in, each conversation in order within one task.

    Turns are in order of `turn` (nulls first), those that share it by role and then by the SHA-256 of their text. Null
    roles and texts are one space; rows without a conv_id are one conversation. A turn is blank without any
    character but ASCII blanks, a duplicate if role and text came before, truncated if its
    last such character is none of .!?; the first of these counts. Repeated rows are duplicates. A
    conversation all of whose turns go has an empty audit or one of deletions, and no turns after. An empty table
    gives no rows. Other columns are not looked at.
    """
    small_batches(turns.sparkSession)
    rows = _sorted_turns(turns)
    stretches = _stretches(rows)
    edits = _chosen(stretches)
    numbers = rows.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    faults = stretches.groupBy("key").agg(
        *(F.sum(name).cast("long").alias(name) for name in ("blank", "duplicate", "truncated", "illegal"))
    )
    pieces = F.sort_array(F.collect_list(F.struct("stretch", "edits")))
    done = edits.groupBy("key").agg(F.sum("cost").cast("long").alias("cost"), pieces.alias("pieces"))
    audit = F.array_join(F.expr("transform(pieces, p -> p.edits)"), "").alias("audit")
    ids = turns.select(_key().alias("key"), "conv_id").groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    found = ids.join(numbers, "key").join(faults, "key").join(done.select("key", "cost", audit), "key")
    return found, _repaired(turns, stretches, edits)


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names, now, digest = ["key", "repaired_sha256"], None, None
    for batch in batches:
        done = []
        for key, role, text in zip(batch["key"], batch["role"], batch["text"]):
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            if key == now:
                digest.update(b"\n" + line)
                continue
            if now is not None:
                done.append((now, digest.hexdigest()))
            now, digest = key, hashlib.sha256(line)
        yield pd.DataFrame(done, columns=names)
    if now is not None:
        yield pd.DataFrame([(now, digest.hexdigest())], columns=names)


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """(key, repaired_sha256): of role:text of the turns, joined by newlines; conversations without turns have none.

    A hash of a text goes through it from its beginning, so one task does it for a
    conversation, but it holds only a batch of turns.
    """
    return repaired.select("key", "role", "text").mapInPandas(_hashed, "key string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The turns after damage by crc32(conv_id:turn) % 20: dropped, emptied, without marks, repeated, or made user's."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text, role = F.coalesce(F.col("text"), space), F.coalesce(F.col("role"), space)
    harm = F.col("harm")
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name) % 20).alias("harm"))
    return rows.filter(harm != 0).select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(harm == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def repaired_after_damage(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of `conversations`, of what the repair of its damaged turns found and did."""
    found, repaired = repair_conversations(damaged(conversations))
    ids = conversations.select("conv_id", _key().alias("key")).distinct()
    whole = ids.join(found.drop("conv_id"), "key", "left").join(conversation_digests(repaired), "key", "left")
    zero = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
