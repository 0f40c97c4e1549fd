"""Sinks into catalog tables and databases, and the catalog's view of written files."""

from pyspark.sql import functions as F

from ..fixed_values import JDBC_BATCH_ROWS


#: Catalog statements name so many partitions each.
PARTITIONS_AT_ONCE = 200

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _checked(mode):
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}: expected 'append' or 'overwrite'")


def write_table(df, table, mode="append"):
    """Into an existing catalog table, by column name; `overwrite` replaces all its rows.

    The table keeps its definition either way. A partitioned one loses partitions
    that get no rows too, whatever the session says about overwriting.
    """
    _checked(mode)
    spark = df.sparkSession
    rows = df.select(*spark.table(table).columns)
    if mode == "append":
        rows.write.insertInto(table)
        return
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "static")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def write_jdbc_options(table, mode, parallel=None):
    _checked(mode)
    options = {
        "dbtable": table,
        "batchsize": str(JDBC_BATCH_ROWS),
        "isolationLevel": "READ_COMMITTED",
    }
    if mode == "overwrite":
        # Empty the table rather than drop it: grants and column types stay.
        options["truncate"] = "true"
    if parallel:
        options["numPartitions"] = str(parallel)
    return options


def write_jdbc(df, connection, table, mode="append", parallel=None):
    """Into a database table, in batches; at most `parallel` connections at a time."""
    (
        df.write.format("jdbc")
        .options(**connection, **write_jdbc_options(table, mode, parallel))
        .mode(mode)
        .save()
    )


def register_by_date(spark, table, path, df_schema, by="as_of_date"):
    """A catalog table over the files `write_by_date` puts at `path`.

    A table of that name must be over the same files already; another one raises. A new
    one is told of all that is there.
    """
    new = not spark.catalog.tableExists(table)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df_schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY (`{by}`) LOCATION '{path}'"
    )
    there = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()["data_type"]
    if _bare(spark, there) != _bare(spark, path):
        raise ValueError(f"table {table} is over {there}, not {path}")
    if new:
        repair_by_date(spark, table)


def _bare(spark, path):
    """The path as its store names it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()


def refresh_by_date(spark, table, written=(), dropped=(), by="as_of_date"):
    """Tells the table of the date folders just written and dropped; looks at no others."""
    for days, change, between in ((written, "ADD IF NOT EXISTS", " "), (dropped, "DROP IF EXISTS", ", ")):
        for first in range(0, len(days), PARTITIONS_AT_ONCE):
            parts = [f"PARTITION (`{by}` = DATE '{day}')" for day in days[first : first + PARTITIONS_AT_ONCE]]
            spark.sql(f"ALTER TABLE {table} {change} {between.join(parts)}")
    spark.catalog.refreshTable(table)


def repair_by_date(spark, table):
    """Lets the table see all date folders added or dropped behind its back, by listing them all."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def write_bucketed(df, table, key, buckets, path):
    """A copy of `df` as a catalog table at `path`, dealt into `buckets` by `key` and sorted by it in each.

    Tables that are dealt alike join by their keys, and group by them, without a shuffle. Rows are gathered by key
    for writing, and keys with very many rows are split over tasks. A reader takes a bucket as a whole, though: a log in
    which single bookings are a large part (`hot_keys`) is better left as it is.
    """
    dealt = df.hint("rebalance", buckets, F.col(key))
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
