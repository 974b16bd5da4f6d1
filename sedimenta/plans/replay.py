"""Rejected rows judged again, and the log of what rules rejected in which run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, TimestampType

from sedimenta.config import Rule, TableConfig
from sedimenta.functions.columns import all_present, any_missing, moment, with_audit
from sedimenta.operators.history import scd2_apply
from sedimenta.operators.merge import upsert
from sedimenta.operators.quality import exception_summary, tag_rows
from sedimenta.sinks.tables import write_snapshot
from sedimenta.sources.tables import read_path
from sedimenta.sources.versions import child_folders, is_complete, snapshot_path

_REJECTED = (
    StructField("_failed_rules", ArrayType(StringType())),
    StructField("_pipeline_run_id", StringType()),
    StructField("_rejection_timestamp", TimestampType()),
)


def write_exception_log(
    rejected: DataFrame, log_root: str, table: str, run_id: str, quarantine_path: str, as_of: Column | dt.datetime | str
) -> None:
    """Rejections of a run by rule, in a folder of the run's own; a re-run replaces them."""
    rows = exception_summary(rejected, run_id).select(
        "pipeline_run_id",
        F.lit(table).alias("table_name"),
        "rule_id",
        "exception_count",
        F.lit(quarantine_path).alias("quarantine_path"),
        moment(as_of).alias("log_timestamp"),
    )
    rows.coalesce(1).write.mode("overwrite").parquet(f"{log_root.rstrip('/')}/exceptions/{table}/{run_id}")


def exception_log(spark: SparkSession, log_root: str) -> DataFrame:
    """The whole log: one row per run, table and rule."""
    kinds = "pipeline_run_id string, table_name string, rule_id string, exception_count long, quarantine_path string, log_timestamp timestamp"
    return spark.read.schema(kinds).option("recursiveFileLookup", "true").parquet(f"{log_root.rstrip('/')}/exceptions")


def waiting_runs(spark: SparkSession, quarantine_root: str, log_root: str, table: str, run_id: str) -> list[str]:
    """Runs whose rejected rows no replay but this one (``run_id``) has taken up: folder names, no file is read."""
    there = [r for r in child_folders(spark, f"{quarantine_root.rstrip('/')}/silver/{table}") if r != run_id]
    place = f"{log_root.rstrip('/')}/replays/{table}"
    done = [f"{place}/{r}" for r in child_folders(spark, place) if r != run_id and is_complete(spark, f"{place}/{r}")]
    taken = {row["replayed_run"] for row in spark.read.parquet(*done).select("replayed_run").collect()} if done else set()
    return sorted(set(there) - taken)


def judged_again(
    waiting: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    rules: Sequence[Rule],
    parents: Mapping[str, DataFrame] | None = None,
    loaded: str = "_load_timestamp",
) -> DataFrame:
    """Rejected rows with ``_outcome``: ``accepted``, ``rejected`` or ``superseded``.

    Of several rows of a key the one rejected last counts, the others are superseded; so is a
    row whose key the target holds from a load after the rejection.  Rows with a NULL key stand for themselves.
    """
    keys, names = list(keys), waiting.columns
    latest = Window.partitionBy(*keys).orderBy(F.desc("_rejection_timestamp"), F.desc("_pipeline_run_id"), F.xxhash64(*keys, *names[:1]))
    known = waiting.filter(all_present(keys)).withColumn("_newest", F.row_number().over(latest) == 1)
    rows = known.unionByName(waiting.filter(any_missing(keys)).withColumn("_newest", F.lit(True)))
    if target is None:
        rows = rows.withColumn("_since", F.lit(None).cast("timestamp"))
    else:
        current = target.filter("_is_current") if "_is_current" in target.columns else target
        since = current.filter(all_present(keys)).select(*keys, F.col(loaded).cast("timestamp").alias("_since"))
        rows = rows.join(since, keys, "left").select(*names, "_newest", "_since")
    tagged = tag_rows(rows.withColumnRenamed("_failed_rules", "_failed_before"), rules, parents)
    later = F.coalesce(F.col("_since") > F.col("_rejection_timestamp"), F.lit(False))
    outcome = F.when(~F.col("_newest") | later, "superseded").when(F.col("_accepted"), "accepted").otherwise("rejected")
    return tagged.withColumn("_outcome", outcome).select(*[n for n in names if n != "_failed_rules"], "_failed_rules", "_outcome")


def replay_quarantine(
    spark: SparkSession,
    schema: StructType,
    target: DataFrame | None,
    config: TableConfig,
    rules: Sequence[Rule],
    root: str,
    version: int,
    run_id: str,
    as_of: Column | dt.datetime | str,
    quarantine_root: str,
    log_root: str,
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Judge all waiting rejected rows of a table by the rules as they are now; returns the run's metrics row.

    ``schema`` is that of the rows as they were loaded.  Accepted rows are merged into the next
    version of the table, rejected ones go to the run's own quarantine with the time of their first
    rejection, superseded ones (see :func:`judged_again`) are only counted: what was read is always
    the sum of the three.

    Each waiting row is taken up once.  What the run has read is noted last; one that failed
    is repeated with the same ``run_id`` and ``version``: it judges the same rows again, replaces its
    own files and leaves a complete version alone.
    """
    table, place = config.name, log_root.rstrip("/")
    mark = f"{place}/replays/{table}/{run_id}"
    if not is_complete(spark, mark):
        runs = waiting_runs(spark, quarantine_root, log_root, table, run_id)
        paths = [f"{quarantine_root.rstrip('/')}/silver/{table}/{run}" for run in runs]
        whole = StructType([*schema.fields, *_REJECTED])
        waiting = spark.read.schema(whole).json(paths) if paths else spark.createDataFrame([], whole)
        staged = f"{root.rstrip('/')}/staging/{table}/{run_id}"
        judged = judged_again(waiting, target, config.keys, rules, parents)
        judged.write.mode("overwrite").partitionBy("_outcome").parquet(staged)
        judged = read_path(spark, staged, judged.schema)
        again = judged.filter("_outcome = 'rejected'").drop("_outcome")
        own = f"{quarantine_root.rstrip('/')}/silver/{table}/{run_id}"
        again.withColumn("_pipeline_run_id", F.lit(run_id)).write.mode("overwrite").json(own)
        write_exception_log(again, log_root, table, run_id, own, as_of)
        accepted = judged.filter("_outcome = 'accepted'").select(*schema.names)
        accepted = with_audit(accepted, run_id, {"_load_timestamp": as_of})
        if not is_complete(spark, snapshot_path(f"{root}/{table}", version)):
            if config.scd_type == 2:
                state = scd2_apply(target, accepted, config.keys, config.tracked, as_of)
            else:
                state = upsert(target, accepted, config.keys)
            write_snapshot(state, f"{root}/{table}", version, config.partition_by, config.cluster_by)
        counted = judged.agg(
            F.count(F.lit(1)).alias("records_read"),
            *[F.count_if(F.col("_outcome") == o).alias(f"records_{o}") for o in ("accepted", "rejected", "superseded")],
        )
        metrics = counted.withColumn("pipeline_run_id", F.lit(run_id)).withColumn("table_name", F.lit(table))
        # The counts, and one row per run that was taken up.
        notes = spark.createDataFrame([(run,) for run in runs], "replayed_run string")
        metrics.unionByName(notes, allowMissingColumns=True).coalesce(1).write.mode("overwrite").parquet(mark)
    return spark.read.parquet(mark).filter("replayed_run IS NULL").drop("replayed_run")
