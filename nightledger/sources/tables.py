from ..operators.schema import conform
from ..schemas import BY_TABLE


def read_table(spark, name, names):
    """A logical table from the catalog, under its physical name in `names`, with its declared columns."""
    return conform(spark.table(names[name]), BY_TABLE[name])


def read_query(spark, query):
    """The result of a SQL query over catalog tables and views."""
    return spark.sql(query)


def read_source(spark, table=None, query=None):
    """A table or a query; the query wins when both are given."""
    if query:
        return read_query(spark, query)
    if table:
        return spark.table(table)
    raise ValueError("give a table or a query")
