"""JDBC reads. Credentials come in as arguments; nothing here looks them up."""

# URL form and driver class per kind of database; None leaves the driver to the URL.
DATABASES = {
    "redshift": ("jdbc:redshift://{host}:{port}/{database}", None),
    "sqlserver": (
        "jdbc:sqlserver://{host}:{port};databaseName={database}",
        "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    ),
    # All-zero dates, which this database allows, come back as NULL.
    "mysql": (
        "jdbc:mysql://{host}:{port}/{database}?zeroDateTimeBehavior=CONVERT_TO_NULL",
        "com.mysql.cj.jdbc.Driver",
    ),
}


def connection_options(kind, host, port, database, user, password):
    """Spark's JDBC connection options for one of `DATABASES`."""
    if kind not in DATABASES:
        raise ValueError(f"unknown database {kind!r}: expected one of {', '.join(DATABASES)}")
    url, driver = DATABASES[kind]
    options = {
        "url": url.format(host=host, port=port, database=database),
        "user": user,
        "password": password,
    }
    if driver:
        options["driver"] = driver
    return options


def read_options(table=None, query=None, split=None, fetch_rows=10000):
    """What to read; the query wins when both are given.

    `split` (column, lowest, highest, parts) reads in `parts` parallel ranges of
    a numeric, date or timestamp column. Rows outside the bounds are read too:
    the first and last range are open.
    """
    if not (table or query):
        raise ValueError("give a table or a query")
    options = {"fetchsize": str(fetch_rows)}
    if split is None:
        options.update({"query": query} if query else {"dbtable": table})
        return options
    column, lowest, highest, parts = split
    options.update(
        # Spark takes a split only with dbtable, so a query becomes a derived table.
        dbtable=f"({query}) source" if query else table,
        partitionColumn=column,
        lowerBound=str(lowest),
        upperBound=str(highest),
        numPartitions=str(parts),
    )
    return options


def read_jdbc(spark, connection, table=None, query=None, split=None):
    """A table or query result; filters and column choices go down to the database."""
    return (
        spark.read.format("jdbc")
        .options(**connection, **read_options(table, query, split))
        .option("preferTimestampNTZ", True)
        .load()
    )
