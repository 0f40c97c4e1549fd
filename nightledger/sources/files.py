from ..operators.schema import null_markers_to_null


def read_files(spark, path, file_format, schema=None, infer=False):
    """Parquet or headed CSV, with null markers in text replaced by NULL.

    CSV columns are text unless `schema` declares them; `infer` has Spark guess
    their types instead, which costs a second pass over the files.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if file_format == "parquet":
        df = reader.parquet(path)
    elif file_format == "csv":
        df = reader.option("header", True).option("inferSchema", infer and schema is None).csv(path)
    else:
        raise ValueError(f"unknown file format {file_format!r}: expected 'parquet' or 'csv'")
    return null_markers_to_null(df)
