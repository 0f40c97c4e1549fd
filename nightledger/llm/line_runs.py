"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions alone.

Documents come in batches of rising ids. The distinct line keys of a batch are anti-joined
with the runs of all batches before it, and those that no run holds become a run of
their own. Every `fanout` runs of a level are merged into one of the next, so there are
few runs to look into however many batches there were. A run is bucketed and sorted by
the hashes: merge joins read it as it lies, without shuffle or sort.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.llm.common import dropped, saved, scratch_path, whole_text

#: Shorter keys never count as repeated.
LEAST_LENGTH = 10
BATCHES = 6
FANOUT = 3
#: A key is hot if it has this share of the lines of its batch, so there are at most 1 / HOT hot keys.
HOT = 0.001

KEY = ["h1", "h2"]
#: Rows without a doc_id are one document, after all others.
NO_ID = (1 << 63) - 1
RUN = "h1 BIGINT, h2 BIGINT, first_id BIGINT, last_id BIGINT, n BIGINT"

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SORTED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: Column) -> Column:
    """The line without ASCII blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def lines_of(docs: DataFrame, least: int) -> DataFrame:
    """(doc, text_key, line_no, h1, h2) of all lines whose key has `least` code points; h1 and h2 are 128 bits of hash."""
    text = whole_text()
    exploded = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("text_key"),
        F.posexplode(F.split(text, "\n")).alias("line_no", "line"),
    )
    keyed = exploded.withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= least)
    return keyed.select(
        "doc", "text_key", "line_no", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")
    )


class LineRuns:
    """The runs under `folder`: what earlier batches held. Batches must come in order of their documents.

    A run is complete once Spark has marked it so; what a failed job leaves is not one. A merged run
    holds what its inputs held, so nothing changes if a failure leaves both.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._tables: dict[str, str] = {}

    def names(self) -> list[str]:
        """The complete runs, as level-id."""
        top = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        store = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(top):
            return []
        found = [status.getPath() for status in store.listStatus(top) if status.isDirectory()]
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(p.getName() for p in found if p.getName()[0].isdigit() and store.exists(path(p, "_SUCCESS")))

    def run(self, name: str) -> DataFrame:
        """A run as a bucketed table, for which it needs an entry in the catalog."""
        if name not in self._tables:
            table = f"line_run_{uuid.uuid4().hex}"
            self.spark.sql(
                f"CREATE TABLE {table} ({RUN}) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'"
            )
            self._tables[name] = table
        return self.spark.table(self._tables[name])

    def _write(self, rows: DataFrame, label: str) -> str:
        """Rows that are distributed by key already, written as a run: one sorted file per bucket."""
        name, table = f"{label}-{uuid.uuid4().hex}", f"line_run_{uuid.uuid4().hex}"
        writer = rows.select("h1", "h2", "first_id", "last_id", "n").write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        writer.option("path", f"{self.folder}/{name}").saveAsTable(table)
        self._tables[name] = table
        return name

    def _drop(self, name: str) -> None:
        if name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop(name)}")
        dropped(self.spark, f"{self.folder}/{name}")

    def add(self, lines: DataFrame) -> DataFrame:
        """Adds a batch of (doc, h1, h2, ...) lines and returns the keys that repeat: h1, h2, n and keep_id.

        keep_id is the document that may keep the line, null if an earlier batch has it.
        n counts the batch's lines of that key.
        """
        before = self.spark.conf.get(_SORTED_SCAN, "false")
        self.spark.conf.set(_SORTED_SCAN, "true")
        try:
            keys = lines.groupBy(*KEY).agg(
                F.min("doc").alias("first_id"), F.max("doc").alias("last_id"), F.count("*").alias("n")
            )
            batch = self._write(keys, "batch")
            fresh = self.run(batch)
            for name in self.names():
                fresh = fresh.join(self.run(name).hint("merge"), KEY, "left_anti")
            new = self._write(fresh, "0")
            firsts = self.run(new).select(*KEY, F.col("first_id").alias("keep_id")).hint("merge")
            marked = self.run(batch).join(firsts, KEY, "left")
            repeats = saved(
                marked.filter("keep_id is null or keep_id < last_id").select(*KEY, "n", "keep_id"), "repeated-lines"
            )
            self._drop(batch)
            self._compact()
        finally:
            self.spark.conf.set(_SORTED_SCAN, before)
        return repeats

    def _compact(self) -> None:
        """Merges the runs of a level once there are `fanout`; they hold no key twice."""
        levels = defaultdict(list)
        for name in self.names():
            levels[int(name.split("-")[0])].append(name)
        for level in sorted(levels):
            if len(levels[level]) < self.fanout:
                continue
            merged = self.run(levels[level][0])
            for name in levels[level][1:]:
                merged = merged.union(self.run(name))
            levels[level + 1].append(self._write(merged.repartition(self.buckets, *KEY), str(level + 1)))
            for name in levels.pop(level):
                self._drop(name)
            return self._compact()

    def drop(self) -> None:
        """Forgets the runs, files included."""
        for name in {*self.names(), *self._tables}:
            self._drop(name)
        dropped(self.spark, self.folder)


def dropped_lines(lines: DataFrame, repeats: DataFrame) -> DataFrame:
    """(doc, text_key, line_no) of the lines of a batch that go.

    Hot keys are few by definition and broadcast, so that no task has to take all lines of one.
    """
    total = lines.count()
    hot, cold = repeats.filter(F.col("n") >= HOT * total), repeats.filter(F.col("n") < HOT * total)
    hot = F.broadcast(hot)
    gone = lines.join(hot, KEY).unionByName(lines.join(hot.select(*KEY), KEY, "left_anti").join(cold, KEY))
    return gone.filter("keep_id is null or doc != keep_id").select("doc", "text_key", "line_no")


def _bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ids that part the documents into about equal batches."""
    shares = [i / batches for i in range(1, batches)]
    if not shares:
        return []
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"))
    return sorted(set(ids.agg(F.percentile_approx("doc", shares, 1000)).first()[0] or []))


def _masks(gone: DataFrame) -> DataFrame:
    """Per document: n_dropped, and a bit per line that is set for those that go, 64 to a number; zeros at the end are left out."""
    word, bit = F.expr("line_no div 64").cast("int"), F.expr("shiftleft(1L, line_no % 64)")
    words = gone.groupBy("doc", "text_key", word.alias("word")).agg(F.bit_or(bit).alias("mask"))
    per_doc = words.groupBy("doc", "text_key").agg(
        F.sum(F.bit_count("mask")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("found"),
    )
    gaps = "slice(concat(array(-1), transform(found, x -> x.word)), 1, size(found))"
    fill = "(now, last) -> concat(array_repeat(0L, now.word - last - 1), array(now.mask))"
    masks = F.expr(f"flatten(zip_with(found, {gaps}, {fill}))")
    return per_doc.select("doc", "text_key", "n_dropped", masks.alias("masks"))


def line_dedup(docs: DataFrame, least: int = LEAST_LENGTH, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not looked at): doc_id, n_lines, n_dropped, kept_text.

    Text splits at \\n; null and empty texts are one empty line. A key (see `line_key`) of at
    least `least` code points loses its lines in all documents but the one with the
    smallest doc_id that has it; there all of them stay, as do all shorter lines. Rows that
    repeat a doc_id are one document; those without one are one too, after all others. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    bounds = _bounds(docs, batches)
    batch = sum((F.when(F.col("doc") > bound, 1).otherwise(0) for bound in bounds), F.lit(0))
    path = scratch_path(spark, "lines")
    found = lines_of(docs, least).withColumn("batch", batch)
    found.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(found.schema).parquet(path)

    runs = LineRuns(spark, scratch_path(spark, "line-runs"), fanout=fanout)
    gone = None
    for number in range(len(bounds) + 1):
        part = lines.filter(F.col("batch") == number).drop("batch")
        now = dropped_lines(part, runs.add(part))
        gone = now if gone is None else gone.unionByName(now)
    runs.drop()
    masks = saved(_masks(gone), "line-masks").withColumnsRenamed({"doc": "mask_doc", "text_key": "mask_key"})
    dropped(spark, path)

    text = whole_text()
    rows = docs.withColumn("lines", F.split(text, "\n"))
    same = (F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("mask_doc")) & (F.xxhash64(text) == F.col("mask_key"))
    stays = "(line, i) -> (shiftright(coalesce(get(masks, cast(i div 64 as int)), 0L), cast(i % 64 as int)) & 1L) = 0"
    kept = F.when(F.col("masks").isNull(), text).otherwise(F.array_join(F.expr(f"filter(lines, {stays})"), "\n"))
    return rows.join(masks, same, "left").select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), kept.alias("kept_text"),
    )
