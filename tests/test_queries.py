"""Every registered query against its SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks.compare import compare, duck
from checks.oracle import ORACLE
from checks.queries import AS_OF, QUERIES
from nightledger.operators.joins import with_segment_ids
from nightledger.operators.versions import collapse_copies, latest, loaded_by
from nightledger.sources import stand_in

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_hot_booking_leaves_few_rows_per_task(spark):
    """Half the log is copies of one version, and half the bridge links that booking."""
    versions = stand_in.reservations(spark, SF_DIR)
    one = versions.filter(F.col("load_datetime") <= F.lit(AS_OF)).orderBy("bkg_num", F.desc("load_datetime")).limit(1)
    copies = one.crossJoin(spark.range(versions.count()).select()).select(versions.columns)
    log = versions.union(copies)
    found = collapse_copies(latest(loaded_by(log, AS_OF), "bkg_num"))
    plain = collapse_copies(latest(loaded_by(versions, AS_OF), "bkg_num"))
    assert found.count() == plain.count()
    assert found.agg(F.max("copies")).first()[0] > versions.count()
    bridge = spark.createDataFrame([(one.first().bkg_num, 1)] * 500, "source_rsrv_id long, src_sgmnt_id int")
    linked = with_segment_ids(found, bridge)
    assert linked.count() == found.count()
    assert linked.agg(F.sum("copies")).first()[0] > 500 * versions.count()
