"""Properties over the driver tables (sf0.01): numbering, bundle shape,
worklist completeness, invariance to partitioning, SQL form of the cohort."""

import re

import pytest
from pyspark.sql import functions as F

from callweave.operators import bundle, cohort, ingest, worklist
from callweave.plans import catalogue
from callweave.sources import overlay
from conftest import SF_ORACLE

SF = SF_ORACLE


def test_call_numbers_are_one_to_n(spark):
    numbered = catalogue.call_numbers(spark, SF)
    per = numbered.groupBy("AccountId").agg(F.count(F.lit(1)).alias("n"), F.min("call_no").alias("lo"),
                                            F.max("call_no").alias("hi"),
                                            F.countDistinct("call_no").alias("d"))
    bad = per.where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n")))
    assert per.count() > 0 and bad.count() == 0


def test_bundle_has_one_header_per_call(spark):
    rows = catalogue.account_bundle(spark, SF).collect()
    assert rows
    for r in rows:
        headers = re.findall(r"^Call #(\d+) - ", r.bundle, flags=re.M)
        assert len(headers) == r.n_calls
        assert [int(h) for h in headers] == list(range(1, r.n_calls + 1))


@pytest.mark.parametrize("parts", [1, 3, 13])
def test_bundle_invariant_to_partitioning(spark, parts):
    calls = bundle.with_call_id(catalogue.icp_calls(spark, SF)).repartition(parts)
    texts = overlay.transcripts(spark, SF)
    got = {(r.account_id, r.part_no): r.bundle for r in bundle.account_bundle(calls, texts, part_chars=4000).collect()}
    base = {(r.account_id, r.part_no): r.bundle for r in catalogue.account_bundle_parts(spark, SF).collect()}
    assert got == base and any(p > 0 for _, p in got)


def test_worklist_and_held_cover_recorded(spark):
    rec = catalogue.call_timestamps(spark, SF)
    arts = overlay.artifacts(spark, SF)
    todo = worklist.download_worklist(rec, arts)
    held = rec.join(arts.where("kind = 'audio'").select("call_id"),
                    rec["id"].cast("string") == F.col("call_id"), "left_semi")
    assert todo.count() + held.count() == rec.count()
    assert todo.join(held, "id", "inner").count() == 0


def test_history_append_keyed_is_idempotent(spark):
    hist = overlay.history(spark, SF)
    new = catalogue.language_attach(spark, SF)
    once = worklist.append_history(hist, new, dedupe_on="id")
    twice = worklist.append_history(once, new, dedupe_on="id")
    overlap = new.join(hist, "id", "left_semi").count()
    assert overlap > 0                                  # calls that failed before
    assert once.count() == twice.count() == hist.count() + new.count() - overlap


def test_late_languages_reach_old_rows(spark):
    hist, new = overlay.history(spark, SF), catalogue.language_attach(spark, SF)
    merged = worklist.merge_history(hist, new)
    assert merged.count() == merged.select("id").distinct().count()
    late = hist.where("language = 'null'").join(new.where("language <> 'null'").select("id"), "id", "left_semi")
    assert late.count() > 0
    assert merged.join(late.select("id"), "id").where("language = 'null'").count() == 0


def test_cohort_sql_form_matches_dataframe_form(spark):
    for name, fn in [("ov_tasks", overlay.tasks), ("ov_opps", overlay.opportunities),
                     ("ov_accounts", overlay.accounts), ("ov_users", overlay.users)]:
        fn(spark, SF).createOrReplaceTempView(name)
    sql_df = cohort.icp_calls_sql(spark, "ov_tasks", "ov_opps", "ov_accounts", "ov_users")
    df = catalogue.icp_calls(spark, SF)
    assert sql_df.columns == df.columns
    assert sql_df.exceptAll(df).count() == 0 and df.exceptAll(sql_df).count() == 0


def test_lookback_default_is_now(spark):
    flat = spark.createDataFrame([(1, 0)], "id bigint, started_at bigint")
    assert ingest.lookback_calls(flat).count() == 0          # 1970 is outside any window


def test_dimension_keys_unique_so_joins_do_not_fan_out(spark):
    """D8: duplicate user or account keys would duplicate calls and inflate
    call numbers; the dimensions are unique and the cohort join keeps each
    recorded task of a cohort account exactly once."""
    users, accounts = overlay.users(spark, SF), overlay.accounts(spark, SF)
    assert users.groupBy("pk_user").count().where("count > 1").count() == 0
    assert accounts.groupBy("pk_account").count().where("count > 1").count() == 0
    icp = catalogue.icp_calls(spark, SF)
    cohort_ids = catalogue.cohort_accounts(spark, SF).select(F.col("pk_account").alias("AccountId"))
    expected = catalogue.recorded_tasks(spark, SF).join(cohort_ids, "AccountId", "left_semi")
    assert icp.count() == expected.count() == icp.select("Id").distinct().count()


def test_numbering_on_real_hot_keys(spark):
    """orders numbered within o_orderpriority: five keys of ~20% of all rows each equal the plain window."""
    from pyspark.sql import Window

    from callweave.operators.numbering import number_within

    orders = overlay.read_table(spark, SF, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    ours = number_within(orders, "o_orderpriority", ["o_orderdate ASC NULLS LAST", "o_orderkey ASC"],
                         "to_date(coalesce(o_orderdate, TIMESTAMP_NTZ'9999-01-01'))", "n")
    ref = orders.withColumn("n", F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(
        F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey"))).cast("bigint"))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_turn_bundle_on_real_hot_groups_matches_pandas(spark):
    """conversations concatenated per role (three groups holding all rows):
    parts joined in order equal a brute-force pandas build of the same text."""
    conv = overlay.read_table(spark, SF, "conversations")
    turns = conv.selectExpr("role AS conv_id", "conv_id * 1000 + turn AS turn", "role", "text")
    got = {}
    for r in sorted(bundle.turn_bundle(turns, part_chars=5000).collect(), key=lambda r: (r.conv_id, r.part_no)):
        got[r.conv_id] = got.get(r.conv_id, "") + r.bundle
    pdf = conv.toPandas().sort_values(["conv_id", "turn"])
    want = {role: "".join(f"Turn #{n} - {role}\n\n{t or ''}\n\n" for n, t in enumerate(g["text"], 1)) for role, g in pdf.groupby("role")}
    assert got == want
