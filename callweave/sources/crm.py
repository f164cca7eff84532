"""CRM table scans with explicit column lists (pruned at the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callweave.schemas import TASK_COLUMNS


def read_tasks(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(*TASK_COLUMNS)


def read_opportunities(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select("fk_account", "flg_is_from_pro_form")


def read_accounts(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select("pk_account", "ds_account", "ts_created_at")


def read_users(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select("pk_user", "ds_full_name")
