"""One audit record per load, from figures Spark gathers while it writes."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..schemas import AUDIT
from .files import write_by_date
from .versions import DatedVersions


def load_figures(record_id, modified_at):
    """Aggregates a load is audited by: rows, highest id, newest change."""
    return [
        F.count(F.lit(1)).alias("insert_record_count"),
        F.max(record_id).cast("long").alias("last_record_id"),
        F.max(modified_at).cast("string").alias("last_table_update_datetime"),
    ]


def write_audit(
    spark, path, *, glue_run_id, job_name, insert_record_count, s3_file_modified_datetime, update_record_count,
    last_table_update_datetime, table_name, last_record_id, src_sys_id,
):
    """Appends one record to the audit log at `path`. A field may be None but not left out."""
    row = (
        glue_run_id, job_name, insert_record_count, s3_file_modified_datetime, update_record_count,
        last_table_update_datetime, table_name, last_record_id, src_sys_id,
    )
    spark.createDataFrame([row], AUDIT).coalesce(1).write.mode("append").parquet(path)


def audited_write(
    df, path, audit_path, record_id, modified_at, by="as_of_date", mode="replace", *,
    glue_run_id, job_name, s3_file_modified_datetime, table_name, src_sys_id, update_record_count=0,
):
    """`write_by_date`, followed by the audit record of the rows written.

    The figures are taken in the writing stage itself, after the last shuffle:
    there every row counts once even when tasks or executors are lost. All else, the time of
    the source file too, is the caller's to say.
    """
    figures = Observation()
    write_by_date(
        df,
        path,
        by,
        mode,
        watch=lambda rows: rows.observe(figures, *load_figures(record_id, modified_at)),
    )
    write_audit(
        df.sparkSession, audit_path, glue_run_id=glue_run_id, job_name=job_name,
        s3_file_modified_datetime=s3_file_modified_datetime, update_record_count=update_record_count,
        table_name=table_name, src_sys_id=src_sys_id, **figures.get,
    )


def audited_commit(
    df, path, record_id, modified_at, by="as_of_date", tasks=None, *,
    glue_run_id, job_name, s3_file_modified_datetime, table_name, src_sys_id, update_record_count=0,
):
    """Adds a load to a `DatedVersions` store; rows and audit record are committed in one step.

    Run and table name the load: if it is run again, after a crash or not, its rows and its record replace those before.
    """
    figures = Observation()
    fields = {
        "glue_run_id": glue_run_id, "job_name": job_name, "s3_file_modified_datetime": s3_file_modified_datetime,
        "update_record_count": update_record_count, "table_name": table_name, "src_sys_id": src_sys_id,
    }
    return DatedVersions(df.sparkSession, path, by).append(
        df, tasks, load=lambda: (f"{glue_run_id}/{table_name}", fields | figures.get),
        watch=lambda rows: rows.observe(figures, *load_figures(record_id, modified_at)),
    )


def committed_audits(spark, path, by="as_of_date"):
    """The audit records of a store, one per run and table."""
    records = DatedVersions(spark, path, by).loads().values()
    return spark.createDataFrame([tuple(record.get(name) for name in AUDIT.fieldNames()) for record in records], AUDIT)
