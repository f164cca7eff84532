"""Target-account cohort and its calls (the CTE chain of the original query)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.constants import COHORT_CUTOFF, NULL_SENTINEL
from callweave.operators.joins import match_key
from callweave.operators.keyed import unique_key
from callweave.schemas import TASK_COLUMNS


def recorded_tasks(tasks: DataFrame, sentinel: str = NULL_SENTINEL) -> DataFrame:
    """16 task columns where the recording is not the sentinel (SRC-2, FLT-3).

    ``!= 'null'`` also drops a real NULL (three-valued logic); the scan gets
    ``IsNotNull`` and ``Not(EqualTo)`` pushed down.
    """
    return tasks.select(*TASK_COLUMNS).where(F.col("aircall__Call_Recording__c") != sentinel)


def inbound_accounts(opportunities: DataFrame) -> DataFrame:
    """Distinct accounts with a flagged opportunity (FLT-4, AG-1)."""
    return (opportunities.where(F.col("flg_is_from_pro_form"))
            .select("fk_account").distinct())


def cohort_accounts(accounts: DataFrame, opportunities: DataFrame,
                    cutoff: str = COHORT_CUTOFF) -> DataFrame:
    """Accounts created on/after ``cutoff`` having a flagged opportunity
    (FLT-5, JN-4). The membership test is a left-semi join straight on the
    flagged rows: a semi join already ignores duplicates, so no DISTINCT
    (and no extra aggregation) is needed underneath it."""
    flagged = opportunities.where(F.col("flg_is_from_pro_form")).select("fk_account")
    recent = (accounts.select("pk_account", "ds_account", "ts_created_at")
              .where(F.col("ts_created_at") >= F.lit(cutoff).cast("timestamp_ntz")))
    return (recent.join(flagged, recent["pk_account"] == flagged["fk_account"], "left_semi")
            .select("pk_account", "ds_account"))


def icp_calls(tasks: DataFrame, users: DataFrame, cohort: DataFrame, on_duplicate: str = "keep") -> DataFrame:
    """Recorded calls of cohort accounts with owner name and account name
    (JN-2, JN-3, PRJ-5, PRJ-6).

    ``calls LEFT JOIN users ... INNER JOIN cohort`` equals ``calls INNER JOIN
    cohort ... LEFT JOIN users`` (the left join's condition touches only calls
    and users), and the inner join goes first because it is the one that
    shrinks the calls. Strategy is left to AQE: a side measured under the
    broadcast threshold is broadcast, otherwise sort-merge with skew split.

    ``on_duplicate``: a user or account that its table holds twice stops the
    job (``fail``), counts once (``first``), or multiplies its calls as a
    plain join does (``keep``); the check is an aggregate of the two small
    tables inside the same plan.
    """
    calls = recorded_tasks(tasks)
    acc = unique_key(cohort.select(F.col("pk_account"), F.col("ds_account")), "pk_account", on_duplicate)
    usr = unique_key(users.select(F.col("pk_user"), F.col("ds_full_name")), "pk_user", on_duplicate)
    with_acc = calls.join(acc, calls["AccountId"] == acc["pk_account"], "inner")
    with_usr = with_acc.join(usr, match_key(with_acc["OwnerId"], with_acc["Id"]) == usr["pk_user"], "left")
    return with_usr.select(*[calls[c] for c in TASK_COLUMNS], usr["ds_full_name"], acc["ds_account"])


ICP_CALLS_SQL = """
SELECT {task_columns}, u.ds_full_name, a.ds_account
FROM {tasks} t
JOIN {accounts} a ON a.pk_account = t.AccountId
LEFT JOIN {users} u ON u.pk_user = t.OwnerId
WHERE t.aircall__Call_Recording__c <> '{sentinel}'
  AND a.ts_created_at >= TIMESTAMP_NTZ '{cutoff}'
  AND EXISTS (SELECT 1 FROM {opportunities} o
              WHERE o.fk_account = a.pk_account AND o.flg_is_from_pro_form)
"""


def icp_calls_sql(spark, tasks: str, opportunities: str, accounts: str, users: str,
                  cutoff: str = COHORT_CUTOFF, sentinel: str = NULL_SENTINEL) -> DataFrame:
    """The cohort calls as one SQL statement over catalog tables or temp
    views (PRJ-6), for callers who keep their queries as SQL text. Catalyst
    plans it like :func:`icp_calls`; the EXISTS becomes a left-semi join."""
    text = ICP_CALLS_SQL.format(task_columns=", ".join(f"t.{c}" for c in TASK_COLUMNS), tasks=tasks,
                                opportunities=opportunities, accounts=accounts, users=users,
                                cutoff=cutoff, sentinel=sentinel)
    return spark.sql(text)
