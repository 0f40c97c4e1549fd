from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import BUSINESS_DATE_FORMAT, NULL_MARKERS
from ..functions.parsing import day_from, moment_from


def _quoted(name):
    return F.col("`" + name.replace("`", "``") + "`")


def _typed(column, have, want, date_pattern=None):
    if have == want:
        return column
    if isinstance(want, T.DateType):
        return day_from(column, have, date_pattern)
    if isinstance(want, T.TimestampNTZType):
        return moment_from(column, have)
    return column.try_cast(want) if isinstance(have, T.StringType) else column.cast(want)


def _by_lower_name(df):
    """The fields by lower-cased name; names that differ only by case cannot be told apart and raise."""
    lowered = [name.lower() for name in df.columns]
    repeated = sorted({name for name in lowered if lowered.count(name) > 1})
    if repeated:
        raise ValueError(f"columns differ only by case: {', '.join(repeated)}")
    return dict(zip(lowered, df.schema))


def conform(df, schema, date_patterns=None):
    """Exactly the columns of `schema`, in order and type, whatever the case of their names in `df`.

    Text is cast with NULL for what does not parse; `business_date` text is read
    in its own format. Timestamps stay the kind of timestamp they are.
    """
    patterns = {"business_date": BUSINESS_DATE_FORMAT, **(date_patterns or {})}
    have = _by_lower_name(df)
    missing = [name for name in schema.fieldNames() if name.lower() not in have]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    columns = []
    for wanted in schema:
        found = have[wanted.name.lower()]
        typed = _typed(_quoted(found.name), found.dataType, wanted.dataType, patterns.get(wanted.name))
        columns.append(typed.alias(wanted.name))
    return df.select(*columns)


def align_schema(df, target, rejects=None):
    """`df` with lower-cased names, cast to the types `target` has for those names.

    Columns `target` lacks are kept as they are; columns only `target` has are
    not added. Text that does not parse, empty text too, gives NULL. With `rejects` a column of that name
    lists the cells of the row that did not.
    """
    kinds = {field.name.lower(): field.dataType for field in target}
    columns, broken = [], []
    for low, field in _by_lower_name(df).items():
        cell = _quoted(field.name)
        typed = _typed(cell, field.dataType, kinds[low]) if low in kinds else cell
        columns.append(typed.alias(low))
        if low in kinds and isinstance(field.dataType, T.StringType) and kinds[low] != field.dataType:
            found = F.struct(F.lit(low).alias("column_name"), cell.alias("value"))
            broken.append(F.when(cell.isNotNull() & typed.isNull(), found))
    if rejects:
        if rejects.lower() in _by_lower_name(df):
            raise ValueError(f"there is a column {rejects} already")
        none = F.array().cast("array<struct<column_name:string,value:string>>")
        columns.append((F.filter(F.array(*broken), lambda found: found.isNotNull()) if broken else none).alias(rejects))
    return df.select(*columns)


def rejected_cells(df, rejects):
    """How often each value of each column did not parse, from the column that `align_schema` made."""
    cells = df.select(F.explode(rejects).alias("cell"))
    return cells.groupBy("cell.column_name", "cell.value").agg(F.count(F.lit(1)).alias("cells"))


def null_markers_to_null(df, markers=NULL_MARKERS):
    """Marker text in string columns replaced by NULL."""
    return df.select(
        *[
            F.when(~_quoted(f.name).isin(list(markers)), _quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else _quoted(f.name)
            for f in df.schema
        ]
    )
