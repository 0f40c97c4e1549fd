from pyspark.sql import functions as F

from ..operators.schema import align_schema, rejected_cells

# Folder name that Spark gives to rows without a date.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _laid_out(df, by, tasks):
    """`df` gathered by date for writing.

    By default Spark sizes the tasks at run time: small dates share one, and a
    date too big for one is split. With `tasks` each date goes whole to one of
    that many, for results of many dates that are all small.
    """
    return df.repartition(tasks, by) if tasks else df.hint("rebalance", F.col(by))


def write_by_date(
    df, path, by="as_of_date", mode="replace", file_format="parquet", tasks=None, watch=None, **options
):
    """Writes one folder per value of `by`.

    `replace` swaps the folders of the dates in `df` and leaves all others, so a
    rerun leaves one copy. `append` adds to what is there. `watch` sees the rows
    as they are written (see `audit`).
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown mode {mode!r}: expected 'replace' or 'append'")
    rows = _laid_out(df, by, tasks)
    if watch:
        rows = watch(rows)
    writer = rows.write.partitionBy(by).format(file_format).options(**options)
    if mode == "append":
        writer.mode("append").save(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)


def write_csv_by_date(df, path, by="as_of_date", mode="append", tasks=None, delimiter=","):
    write_by_date(df, path, by, mode, "csv", tasks, header=True, delimiter=delimiter)


def write_parquet(df, path, files=None):
    """A plain write, which fails when `path` exists."""
    (df.repartition(files) if files else df).write.parquet(path)


def write_aligned(df, target, path, rejects="rejected"):
    """Casts rows to `target` and stores them, in one pass over their source; returns them as stored, and the rejected cells.

    Cells that did not parse are stored with their row, in the column `rejects`. Their counts by column and value
    read that column alone.
    """
    aligned = align_schema(df, target, rejects)
    aligned.write.parquet(path)
    stored = df.sparkSession.read.schema(aligned.schema).parquet(path)
    return stored.drop(rejects), rejected_cells(stored, rejects)
