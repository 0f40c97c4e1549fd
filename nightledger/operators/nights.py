from pyspark.sql import functions as F

BLOCK_DAYS = 366


def stay_nights(stays, not_before=None):
    """One row per night of each stay: `arrival` up to the day before `departure`.

    Nights before `not_before` are never produced. Stays without nights give no
    rows. Long stays go by blocks of days, so that no array grows with a stay.
    """
    first = F.col("arrival")
    last = F.date_sub("departure", 1)
    if not_before is not None:
        first = F.greatest(first, not_before)
    blocks = F.sequence(F.lit(0), F.floor(F.datediff(last, first) / BLOCK_DAYS).cast("int"))
    start = F.date_add(first, F.col("block_no") * BLOCK_DAYS)
    end = F.least(last, F.date_add(start, BLOCK_DAYS - 1))
    return (
        stays.filter(first <= last)
        .withColumn("block_no", F.explode(blocks))
        .withColumn("stay_date", F.explode(F.sequence(start, end, F.expr("interval 1 day"))))
        .drop("block_no")
    )
