from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from nightledger import schemas
from nightledger.operators.schema import align_schema, conform
from nightledger.sinks.audit import audited_write, write_audit
from nightledger.sinks.files import write_aligned, write_by_date, write_csv_by_date, write_parquet
from nightledger.sinks.tables import refresh_by_date, register_by_date, repair_by_date, write_jdbc_options, write_table
from nightledger.sources.files import read_files
from nightledger.sources.jdbc import connection_options, read_options
from nightledger.sources.tables import read_source, read_table
from nightledger.workspace import scratch_path


@pytest.fixture
def report(spark):
    return spark.sql(
        """SELECT date_add(date'2025-01-01', cast(id % 3 AS int)) AS as_of_date, id, concat('h', id) AS hotel_code
           FROM range(30)""")


def counts(df):
    return {r.as_of_date.day: r["count"] for r in df.groupBy("as_of_date").count().collect()}


def test_rerun_leaves_one_copy(spark, report, tmp_path):
    path = str(tmp_path / "out")
    write_by_date(report, path)
    write_by_date(report.filter("day(as_of_date) = 2").limit(4), path)
    assert counts(spark.read.parquet(path)) == {1: 10, 2: 4, 3: 10}
    write_by_date(report, path, tasks=2)
    assert counts(spark.read.parquet(path)) == {1: 10, 2: 10, 3: 10}


def test_append_adds(spark, report, tmp_path):
    path = str(tmp_path / "out")
    write_by_date(report, path, mode="append")
    write_by_date(report, path, mode="append")
    assert counts(spark.read.parquet(path)) == {1: 20, 2: 20, 3: 20}


def test_with_tasks_each_date_is_one_file(report, tmp_path):
    write_by_date(report, str(tmp_path / "out"), tasks=3)
    assert len(list((tmp_path / "out").glob("as_of_date=*/*.parquet"))) == 3


def test_unknown_modes_are_rejected(report, tmp_path):
    with pytest.raises(ValueError, match="upsert"):
        write_by_date(report, str(tmp_path / "out"), mode="upsert")
    with pytest.raises(ValueError, match="replace"):
        write_jdbc_options("t", "replace")
    with pytest.raises(ValueError, match="upsert"):
        write_table(report, "nowhere", mode="upsert")


def test_csv_by_date_comes_back_typed(spark, report, tmp_path):
    path = str(tmp_path / "out")
    write_csv_by_date(report, path, delimiter=",")
    header = next((tmp_path / "out").glob("as_of_date=*/*.csv")).read_text().splitlines()[0]
    assert header == "id,hotel_code"
    back = conform(read_files(spark, path, "csv"), report.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, report.collect()))


def test_plain_parquet_write_fails_when_there_is_something(report, tmp_path):
    path = str(tmp_path / "out")
    write_parquet(report, path, files=2)
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 2
    with pytest.raises(Exception, match="(?i)already exists"):
        write_parquet(report, path)


def test_read_files(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("n,t\n1,NaN\n2,@NULL@\n3,NULL\n4,x\n")
    rows = read_files(spark, str(folder), "csv")
    assert dict(rows.dtypes) == {"n": "string", "t": "string"}
    assert [r.t for r in rows.orderBy("n").collect()] == [None, None, None, "x"]
    assert dict(read_files(spark, str(folder), "csv", infer=True).dtypes)["n"] == "int"
    assert dict(read_files(spark, str(folder), "csv", schema="n bigint, t string").dtypes)["n"] == "bigint"
    with pytest.raises(ValueError, match="orc"):
        read_files(spark, str(folder), "orc")


def test_only_the_dates_asked_for_are_read(spark, report, tmp_path):
    path = str(tmp_path / "out")
    write_by_date(report, path)
    wanted = spark.read.parquet(path).filter(F.col("as_of_date") == F.lit(date(2025, 1, 2)))
    assert {name.split("as_of_date=")[1][:10] for name in wanted.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {
        "2025-01-02"}


def test_catalog_sees_new_and_dropped_dates_after_a_refresh(spark, report, tmp_path):
    path, table = str(tmp_path / "out"), "refresh_check"
    write_by_date(report.filter("day(as_of_date) = 1"), path)
    register_by_date(spark, table, path, report.schema)
    refresh_by_date(spark, table, [first_date(report, 1)])
    assert counts(spark.table(table)) == {1: 10}
    write_by_date(report.filter("day(as_of_date) = 2"), path)
    refresh_by_date(spark, table, [first_date(report, 2)], [first_date(report, 1)])
    assert counts(spark.table(table)) == {2: 10}
    repair_by_date(spark, table)
    assert counts(spark.table(table)) == {1: 10, 2: 10}
    with pytest.raises(ValueError, match="is over"):
        register_by_date(spark, table, f"{path}-other", report.schema)
    spark.sql(f"DROP TABLE {table}")


def first_date(report, day):
    return report.filter(f"day(as_of_date) = {day}").first().as_of_date


def test_overwrite_of_a_partitioned_table_replaces_all_of_it(spark, report, tmp_path):
    spark.sql(f"CREATE TABLE part_check (hotel_code string, id bigint, as_of_date date) USING parquet "
              f"PARTITIONED BY (as_of_date) LOCATION '{tmp_path}/p'")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(report, "part_check")
        write_table(report.filter("day(as_of_date) = 1"), "part_check", mode="overwrite")
        assert counts(spark.table("part_check")) == {1: 10}
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        spark.sql("DROP TABLE part_check")


def test_table_append_and_overwrite(spark, report, tmp_path):
    spark.sql(f"CREATE TABLE load_check (hotel_code string, id bigint, as_of_date date) USING parquet LOCATION '{tmp_path}/t'")
    write_table(report, "load_check")
    write_table(report, "load_check")
    assert spark.table("load_check").count() == 60
    write_table(report.limit(5), "load_check", mode="overwrite")
    assert spark.table("load_check").count() == 5
    assert spark.table("load_check").filter("hotel_code = concat('h', id)").count() == 5
    spark.sql("DROP TABLE load_check")


def test_tables_by_name_or_query(spark):
    spark.sql("SELECT '3' AS src_sgmnt_id, 'Web' AS source, 'x' AS segment, 1 AS more").createOrReplaceTempView("seg_check")
    assert [tuple(r) for r in read_table(spark, "segments", {"segments": "seg_check"}).collect()] == [(3, "Web", "x")]
    assert read_source(spark, table="seg_check", query="SELECT 1 AS one").columns == ["one"]
    assert read_source(spark, table="seg_check").count() == 1
    with pytest.raises(ValueError):
        read_source(spark)


def test_connection_options():
    mysql = connection_options("mysql", "h", 3306, "db", "u", "p")
    assert mysql["url"] == "jdbc:mysql://h:3306/db?zeroDateTimeBehavior=CONVERT_TO_NULL"
    assert mysql["driver"] == "com.mysql.cj.jdbc.Driver"
    server = connection_options("sqlserver", "h", 1433, "db", "u", "p")
    assert server["url"] == "jdbc:sqlserver://h:1433;databaseName=db"
    warehouse = connection_options("redshift", "h", 5439, "db", "u", "p")
    assert warehouse == {"url": "jdbc:redshift://h:5439/db", "user": "u", "password": "p"}
    with pytest.raises(ValueError, match="oracle"):
        connection_options("oracle", "h", 1, "db", "u", "p")


def test_read_options():
    assert read_options(table="t")["dbtable"] == "t"
    both = read_options(table="t", query="select 1")
    assert both["query"] == "select 1" and "dbtable" not in both
    with pytest.raises(ValueError):
        read_options()
    split = read_options(query="select id from t", split=("id", 1, 1000, 8))
    assert split["dbtable"] == "(select id from t) source" and "query" not in split
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "1", "1000", "8")


def test_jdbc_write_options():
    append = write_jdbc_options("t", "append")
    assert append == {"dbtable": "t", "batchsize": "100000", "isolationLevel": "READ_COMMITTED"}
    assert write_jdbc_options("t", "overwrite", parallel=4) == {**append, "truncate": "true", "numPartitions": "4"}


def test_audit_needs_every_field(spark, tmp_path):
    whole = dict.fromkeys(schemas.AUDIT.fieldNames())
    for name in whole:
        with pytest.raises(TypeError, match=name):
            write_audit(spark, str(tmp_path / "log"), **{k: v for k, v in whole.items() if k != name})


def test_audited_write(spark, report, tmp_path):
    path, log = str(tmp_path / "out"), str(tmp_path / "log")
    changed = report.withColumn("changed", F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(datetime(2025, 1, 1))))
    for _ in range(2):
        audited_write(changed, path, log, F.col("id"), F.col("changed"), job_name="j", table_name="t",
                      glue_run_id="r", src_sys_id=None, s3_file_modified_datetime="2025-01-01 00:00:00")
    records = spark.read.parquet(log).collect()
    assert {(r.glue_run_id, r.s3_file_modified_datetime) for r in records} == {("r", "2025-01-01 00:00:00")}
    assert {(r.insert_record_count, r.last_record_id, r.last_table_update_datetime, r.update_record_count) for r in records} == {
        (30, 29, "2025-01-02 05:00:00", 0)}
    assert len(records) == 2
    assert spark.read.parquet(path).count() == 30


def session_like(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: settings.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_is_in_the_folder_the_cluster_shares(spark):
    cluster = session_like("yarn", spark_checkpoint_dir="/shared/work/")
    assert scratch_path(cluster, "x").startswith("/shared/work/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session_like("yarn"), "x")
    assert scratch_path(cluster, "x") != scratch_path(cluster, "x")
    assert scratch_path(spark, "x", "/tmp/own").startswith("/tmp/own/x-")


def test_rejected_cells_are_counted(spark, tmp_path):
    rows = [("1", "2025-01-01", "x"), ("one", "2025-13-01", "y"), ("one", None, "z"), ("", "2025-01-02", None)]
    df = spark.createDataFrame(rows, "BKG_NUM string, arrival_dt string, note string")
    aligned, found = write_aligned(df, schemas.RESERVATIONS, str(tmp_path / "aligned"))
    assert sorted(map(tuple, found.collect())) == [
        ("arrival_dt", "2025-13-01", 1), ("bkg_num", "", 1), ("bkg_num", "one", 2)]
    assert sorted(map(str, aligned.collect())) == sorted(map(str, align_schema(df, schemas.RESERVATIONS).collect()))
    assert align_schema(df.select("note"), schemas.RESERVATIONS, "rejected").first().rejected == []
    with pytest.raises(ValueError, match="already"):
        align_schema(df, schemas.RESERVATIONS, "NOTE")
