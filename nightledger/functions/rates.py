from pyspark.sql import functions as F

from ..schemas import RATE


def effective_rate(*rates):
    """The first rate that is present, in the order given, as decimal(10,2).

    Text that is no number counts as absent.
    """
    return F.coalesce(*[rate.try_cast(RATE) for rate in rates])
