"""DuckDB formulations of the registered queries (the correctness oracle).

Written independently of the Spark code: the overlay formulas are restated
as SQL views over the driver tables and each query is phrased in plain SQL
(window functions, EXISTS, string_agg). Each query selects the same column
names as its Spark twin.
"""

from __future__ import annotations

import datetime as dt

from callweave.constants import (CHAT_MODEL, CHAT_SEED, SUMMARY_TEMPLATE, TRANSCRIBE_FORMAT,
                                 TRANSCRIBE_MODEL, TRANSLATE_TEMPLATE)
from callweave.plans.catalogue import AS_OF_DAYS, AUDIO_DIR, RUN_DATE, SUMMARY_DIR, TEXT_DIR


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


NL2 = "chr(10) || chr(10)"
DAY = f"DATE '{RUN_DATE.isoformat()}'"
# A part holds 64 million characters unless a query says 4000; a call counts 64 and its transcript.
PART, SMALL = 67108864, 4000
CUT = "TIMESTAMP '2024-07-01 00:00:00'"

_FEED = """
feed AS (
  SELECT event_id AS id,
         user_id // 25 AS number_id,
         'Line ' || CAST(user_id // 25 AS VARCHAR) AS number_name,
         epoch_us(ts) // 1000000 AS started_at,
         CASE WHEN event_type = 'click' THEN NULL ELSE epoch_us(ts) // 1000000 + 3 END AS answered_at,
         epoch_us(ts) // 1000000 + CAST(floor(value) AS BIGINT) + 3 AS ended_at,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'inbound' ELSE 'outbound' END AS direction,
         CASE WHEN event_type = 'view' THEN NULL
              ELSE 'https://host.example/recordings/' || CAST(event_id AS VARCHAR) || '.mp3' END AS recording,
         CASE WHEN event_type = 'error' THEN 'null' ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN event_type = 'error' THEN 'null' ELSE 'Agent ' || CAST(user_id AS VARCHAR) END AS user_name,
         CASE WHEN event_type = 'error' THEN 'null'
              WHEN event_type = 'signup' AND user_id % 10 = 0 THEN NULL
              ELSE 'agent' || CAST(user_id AS VARCHAR) || '@host.example' END AS user_email,
         CASE WHEN event_type = 'error' THEN 'null' ELSE CAST(value >= 50.0 AS VARCHAR) END AS user_available
  FROM events),
recorded AS (SELECT * FROM feed WHERE recording IS NOT NULL),
rec_ts AS (
  SELECT *, make_timestamp(started_at * 1000000) AS started_at_ts,
            make_timestamp(answered_at * 1000000) AS answered_at_ts,
            make_timestamp(ended_at * 1000000) AS ended_at_ts
  FROM recorded),
held_audio AS (SELECT CAST(doc_id AS VARCHAR) AS call_id FROM labels),
tx AS (SELECT CAST(doc_id AS VARCHAR) AS call_id, text, lang AS language FROM documents),
worklist AS (
  SELECT * FROM rec_ts r
  WHERE NOT EXISTS (SELECT 1 FROM held_audio h WHERE h.call_id = CAST(r.id AS VARCHAR))),
new_rows AS (
  SELECT id, number_id, number_name, user_id, user_name AS user_full_name, user_email,
         started_at_ts AS started_at, answered_at_ts AS answered_at, ended_at_ts AS ended_at,
         direction, user_available AS available
  FROM worklist),
with_lang AS (
  SELECT n.*, coalesce(tx.language, 'null') AS language
  FROM new_rows n LEFT JOIN tx ON tx.call_id = CAST(n.id AS VARCHAR)),
old_hist AS (
  SELECT r.id, r.number_id, r.number_name, r.user_id, r.user_name AS user_full_name, r.user_email,
         r.started_at_ts AS started_at, r.answered_at_ts AS answered_at, r.ended_at_ts AS ended_at,
         r.direction, r.user_available AS available, coalesce(tx.language, 'null') AS language
  FROM rec_ts r LEFT JOIN tx ON tx.call_id = CAST(r.id AS VARCHAR)
  WHERE CAST(r.id AS VARCHAR) IN (SELECT call_id FROM held_audio)
  UNION ALL
  SELECT n.*, 'null' FROM new_rows n WHERE n.id % 7 = 0)
"""

# The feed as landed: damage by page number, see overlay.landed_feed.
_LANDED = _FEED + """,
page_nos AS (SELECT event_id // 50 AS no, count(*) AS n_calls, max(event_id // 50) OVER () AS last_no FROM events GROUP BY 1),
landed AS (
  SELECT no, n_calls, 'https://host.example/v1/calls?page=' || CAST(no AS VARCHAR) AS page_link,
         CASE WHEN no < last_no THEN 'https://host.example/v1/calls?page=' || CAST(no + 1 AS VARCHAR) END AS next_link,
         no % 17 = 3 OR no % 29 = 6 AS is_bad
  FROM page_nos, (VALUES (1), (2)) t(copy) WHERE no % 23 <> 5 AND (copy = 1 OR no % 19 = 4)),
links AS (
  SELECT link, sum(landed) AS landed, sum(good) AS good, sum(named) AS named, sum(ends) AS ends FROM (
    SELECT page_link AS link, 1 AS landed, CAST(NOT is_bad AS INT) AS good, 0 AS named, CAST(NOT is_bad AND next_link IS NULL AS INT) AS ends FROM landed
    UNION ALL SELECT next_link, 0, 0, 1, 0 FROM landed WHERE NOT is_bad AND next_link IS NOT NULL) GROUP BY link)
"""

# The state of each call by its log of attempts.
_ATTEMPTS = _FEED + """,
log AS (
  SELECT CAST(event_id // 3 AS VARCHAR) AS call_id, ts AS attempted_at, event_type IN ('purchase', 'signup', 'click') AS ok,
         CASE WHEN event_type IN ('purchase', 'signup', 'click') THEN 'text of ' || CAST(event_id AS VARCHAR) END AS text,
         CASE WHEN event_type IN ('purchase', 'signup', 'click') THEN CASE WHEN user_id % 2 = 0 THEN 'de' ELSE 'en' END END AS language,
         CASE WHEN event_type NOT IN ('purchase', 'signup', 'click') THEN 'service: ' || event_type END AS error
  FROM events),
last_ok AS (SELECT * FROM log WHERE ok QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY attempted_at DESC, language DESC, text DESC) = 1),
last_any AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY attempted_at DESC, ok DESC, error DESC) = 1),
states AS (
  SELECT a.call_id, (SELECT count(*) FROM log l WHERE l.call_id = a.call_id) AS n_attempts,
         (SELECT count(*) FROM log l WHERE l.call_id = a.call_id AND NOT l.ok AND (o.attempted_at IS NULL OR l.attempted_at > o.attempted_at)) AS n_failures,
         a.attempted_at, o.text, o.language, a.error
  FROM last_any a LEFT JOIN last_ok o USING (call_id)),
due AS (SELECT *, CASE WHEN error IS NOT NULL THEN attempted_at + to_minutes(CAST(15 * pow(2, least(n_failures - 1, 10)) AS BIGINT)) END AS next_due_at FROM states)
"""

_CRM = f"""
tasks AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS Id,
         '003' || CAST(o_custkey AS VARCHAR) AS WhoId,
         '006' || CAST(o_orderkey AS VARCHAR) AS WhatId,
         CAST(o_custkey AS VARCHAR) AS AccountId,
         CAST(o_orderkey % 140 AS VARCHAR) AS OwnerId,
         'Call ' || o_orderpriority AS Subject,
         CASE WHEN o_totalprice >= 100000.0 THEN 'DE' ELSE 'AT' END AS aircall__Country__c,
         CASE WHEN o_orderstatus = 'P' THEN 'null'
              WHEN o_orderstatus = 'F' THEN NULL
              WHEN o_orderpriority = '5-LOW' THEN 'https://host.example/voicemail/' || CAST(o_orderkey AS VARCHAR)
              ELSE 'https://host.example/calls/' || CAST(o_orderkey AS VARCHAR) || '/recording'
         END AS aircall__Call_Recording__c,
         o_orderpriority AS CallDisposition,
         CASE WHEN o_totalprice >= 200000.0 THEN 'inbound' ELSE 'outbound' END AS aircall__Detailed_type__c,
         'connected' AS aircall__Connection_status__c,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'agent' END AS aircall__Answered_by__c,
         o_orderdate + INTERVAL 1 HOUR AS CompletedDateTime,
         CAST(floor(o_totalprice) AS BIGINT) AS CallDurationInSeconds,
         CASE WHEN o_totalprice >= 200000.0 THEN 'Inbound' ELSE 'Outbound' END AS CallType,
         o_orderdate AS CreatedDate
  FROM orders),
opps AS (
  SELECT CAST(o_custkey AS VARCHAR) AS fk_account, o_orderpriority = '1-URGENT' AS flg_is_from_pro_form
  FROM orders),
accts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS pk_account, c_name AS ds_account,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((c_custkey * 7) % 365 AS INTEGER)) AS ts_created_at
  FROM customer),
dim_user AS (SELECT CAST(s_suppkey AS VARCHAR) AS pk_user, s_name AS ds_full_name FROM supplier),
rec_tasks AS (
  SELECT Id, WhoId, WhatId, AccountId, OwnerId, Subject, aircall__Country__c,
         aircall__Call_Recording__c, CallDisposition, aircall__Detailed_type__c,
         aircall__Connection_status__c, aircall__Answered_by__c, CompletedDateTime,
         CallDurationInSeconds, CallType, CreatedDate
  FROM tasks
  WHERE aircall__Call_Recording__c != 'null'),
flagged_accts AS (SELECT fk_account FROM opps WHERE flg_is_from_pro_form GROUP BY fk_account),
cohort AS (
  SELECT a.pk_account, a.ds_account FROM accts a
  WHERE a.ts_created_at >= {CUT}
    AND EXISTS (SELECT 1 FROM opps o WHERE o.flg_is_from_pro_form AND o.fk_account = a.pk_account)),
icp AS (
  SELECT r.*, u.ds_full_name, c.ds_account
  FROM rec_tasks r
  JOIN cohort c ON c.pk_account = r.AccountId
  LEFT JOIN dim_user u ON u.pk_user = r.OwnerId),
icp_ids AS (
  SELECT *, NULLIF(regexp_extract(aircall__Call_Recording__c, 'calls/(\\d+)', 1), '') AS call_id
  FROM icp),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY AccountId
                               ORDER BY CreatedDate ASC NULLS LAST, Id ASC NULLS LAST) AS call_no
  FROM icp_ids),
headed AS (
  SELECT *, 'Call #' || CAST(call_no AS VARCHAR)
            || ' - ' || coalesce(CAST(CreatedDate AS VARCHAR), 'NaT')
            || ', duration ' || coalesce(CAST(CallDurationInSeconds AS VARCHAR), 'nan')
            || ' seconds with ' || coalesce(ds_full_name, 'None') AS header
  FROM numbered),
laid AS (
  SELECT h.*, d.text AS body, d.doc_id AS found, least(64 + coalesce(d.n_chars, 0), {PART}) AS chars, least(64 + coalesce(d.n_chars, 0), {SMALL}) AS small_chars
  FROM headed h LEFT JOIN documents d ON h.call_id = CAST(d.doc_id AS VARCHAR)),
placed AS (
  SELECT *, CAST(sum(chars) OVER w - chars AS BIGINT) // {PART} AS part_no, CAST(sum(small_chars) OVER w - small_chars AS BIGINT) // {SMALL} AS small_no
  FROM laid WINDOW w AS (PARTITION BY AccountId ORDER BY call_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cut_up AS (SELECT *, max(part_no) OVER (PARTITION BY AccountId) + 1 AS n_parts, max(small_no) OVER (PARTITION BY AccountId) + 1 AS n_small FROM placed),
bundles AS (
  SELECT AccountId AS account_id, part_no, n_parts, count(*) AS n_calls,
         string_agg(header || {NL2} || coalesce(body, '') || {NL2}, '' ORDER BY call_no) AS bundle, min(ds_account) AS ds_account
  FROM cut_up GROUP BY ALL),
small_bundles AS (
  SELECT AccountId AS account_id, small_no AS part_no, n_small AS n_parts, count(*) AS n_calls,
         string_agg(header || {NL2} || coalesce(body, '') || {NL2}, '' ORDER BY call_no) AS bundle, min(ds_account) AS ds_account
  FROM cut_up GROUP BY ALL),
names AS (
  SELECT AccountId, ds_account FROM (
    SELECT AccountId, ds_account,
           row_number() OVER (PARTITION BY AccountId
                              ORDER BY CreatedDate ASC NULLS LAST, Id ASC NULLS LAST) AS rn
    FROM icp) WHERE rn = 1),
pairs AS (SELECT DISTINCT AccountId, ds_account FROM icp),
answered AS (SELECT *, 0 AS part_no FROM documents UNION ALL SELECT *, 1 FROM documents WHERE doc_id % 2 = 0),
resp AS (
  SELECT CAST(doc_id AS VARCHAR) AS account_id, CAST(part_no AS BIGINT) AS part_no,
         'translation' AS kind, {DAY} AS run_date,
         chr(10) || chr(9) || ' ' || text || ' ' || chr(10) || chr(10) AS text
  FROM answered
  UNION ALL
  SELECT CAST(doc_id AS VARCHAR), part_no, 'summary', {DAY},
         '  ' || lang || ' summary, ' || CAST(n_chars AS VARCHAR) || ' chars' || chr(9) || chr(10)
  FROM answered
  UNION ALL
  SELECT CAST(doc_id AS VARCHAR), part_no, 'summary', {DAY} - INTERVAL 1 DAY,
         chr(9) || 'stale summary' || chr(10)
  FROM answered),
resp_clean AS (
  SELECT account_id, part_no, kind, CAST(run_date AS DATE) AS run_date,
         regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS text
  FROM resp)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"


def _feed(select: str) -> str:
    return _with(_FEED) + select


def _crm(select: str) -> str:
    return _with(_CRM) + select


def _landed(select: str) -> str:
    return _with(_LANDED) + select


def _tried(select: str) -> str:
    return _with(_ATTEMPTS) + select


AS_OF = ", ".join(f"(DATE '{(RUN_DATE + dt.timedelta(days=n)).isoformat()}')" for n in AS_OF_DAYS)

ORACLE_SQL: dict[str, str] = {
    "landed_calls": _landed("SELECT feed.* FROM feed JOIN landed ON landed.no = feed.id // 50 WHERE NOT landed.is_bad"),
    "page_report": _landed(
        "SELECT *, n_bad = 0 AND n_repeated = 0 AND n_missing = 0 AND n_starts = 1 AND n_ends = 1 AS is_whole FROM ("
        "SELECT CAST(sum(landed) AS BIGINT) AS n_pages, CAST(sum(landed - good) AS BIGINT) AS n_bad, "
        "(SELECT CAST(sum(n_calls) AS BIGINT) FROM landed WHERE NOT is_bad) AS n_calls, CAST(sum(greatest(good - 1, 0)) AS BIGINT) AS n_repeated, "
        "count(*) FILTER (named > 0 AND good = 0) AS n_missing, count(*) FILTER (good > 0 AND named = 0) AS n_starts, CAST(sum(ends) AS BIGINT) AS n_ends FROM links)"),
    "dead_letters": _landed(
        "SELECT page_link, CASE WHEN no % 17 = 3 THEN left(raw, 10) ELSE raw END AS raw FROM (SELECT *, CASE WHEN no % 29 = 6 "
        "THEN '{\"meta\":{' || coalesce('\"next_page_link\":\"' || next_link || '\"', '') || '}}' ELSE '{\"calls\":[' END AS raw FROM landed WHERE is_bad)"),
    "missing_pages": _landed("SELECT link AS page_link FROM links WHERE named > 0 AND good = 0"),
    "call_states": _tried("SELECT * FROM due"),
    "late_languages": _tried("SELECT n.*, coalesce(o.language, 'null') AS language FROM new_rows n LEFT JOIN last_ok o ON o.call_id = CAST(n.id AS VARCHAR)"),
    "due_calls": _tried("SELECT call_id FROM due WHERE error IS NOT NULL AND next_due_at <= (SELECT max(ts) FROM events)"),
    "icp_calls_unique": _crm("SELECT * FROM icp"),
    "strip_unicode": _crm(
        "SELECT account_id, part_no, kind, CAST(run_date AS DATE) AS run_date, "
        "regexp_replace(regexp_replace(chr(8195) || chr(160) || text || chr(12288) || chr(8232) || ' ', '^[\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ''), "
        "'[\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+$', '') AS text FROM resp"),
    "account_dim_as_of": _crm(
        "SELECT b.account_id AS AccountId, b.part_no, b.n_parts, b.ds_account, d.as_of, t.text AS translation, t.run_date AS translation_date, s.text AS summary, s.run_date AS summary_date "
        f"FROM (SELECT * FROM small_bundles, (VALUES {AS_OF}) v(as_of)) b JOIN (VALUES {AS_OF}) d(as_of) ON d.as_of = b.as_of "
        "ASOF LEFT JOIN (SELECT * FROM resp_clean WHERE kind = 'translation') t ON t.account_id = b.account_id AND t.part_no = b.part_no AND b.as_of >= t.run_date "
        "ASOF LEFT JOIN (SELECT * FROM resp_clean WHERE kind = 'summary') s ON s.account_id = b.account_id AND s.part_no = b.part_no AND b.as_of >= s.run_date"),
    "flatten_calls": _feed("SELECT * FROM feed"),
    "recorded_calls": _feed("SELECT * FROM recorded"),
    "lookback_calls": _feed(
        "SELECT * FROM feed WHERE started_at >= "
        "(SELECT epoch_us(max(ts)) // 1000000 FROM events) - 15 * 86400 "
        "ORDER BY started_at DESC, id"),
    "call_timestamps": _feed("SELECT * FROM rec_ts"),
    "download_worklist": _feed("SELECT * FROM worklist"),
    "new_call_rows": _feed("SELECT * FROM new_rows"),
    "language_attach": _feed("SELECT * FROM with_lang"),
    "history_append": _feed("SELECT * FROM old_hist UNION ALL SELECT * FROM with_lang"),
    "history_append_keyed": _feed(
        "SELECT * FROM old_hist UNION ALL "
        "SELECT * FROM with_lang w WHERE NOT EXISTS (SELECT 1 FROM old_hist o WHERE o.id = w.id)"),
    "run_counts": _feed(
        "SELECT count(*) AS n_recorded, "
        "count(*) FILTER (WHERE CAST(id AS VARCHAR) NOT IN (SELECT call_id FROM held_audio)) "
        "AS n_to_download FROM recorded"),
    "recorded_tasks": _crm("SELECT * FROM rec_tasks"),
    "inbound_accounts": _crm("SELECT * FROM flagged_accts"),
    "cohort_accounts": _crm("SELECT * FROM cohort"),
    "icp_calls": _crm("SELECT * FROM icp"),
    "call_id_extract": _crm(
        "SELECT Id, aircall__Call_Recording__c, "
        "NULLIF(regexp_extract(aircall__Call_Recording__c, 'calls/(\\d+)', 1), '') AS call_id "
        "FROM rec_tasks"),
    "call_numbers": _crm("SELECT * FROM numbered"),
    "first_calls": _crm(
        "SELECT * FROM icp_ids "
        "ORDER BY AccountId ASC NULLS LAST, CreatedDate ASC NULLS LAST, Id ASC NULLS LAST LIMIT 5"),
    "call_headers": _crm("SELECT AccountId, Id, call_id, call_no, header FROM headed"),
    "account_bundle": _crm("SELECT * FROM bundles"),
    "account_bundle_parts": _crm("SELECT * FROM small_bundles"),
    "account_bundle_drop": _crm(
        "SELECT AccountId AS account_id, part_no, n_parts, count(*) AS n_calls, "
        f"string_agg(header || {NL2} || body || {NL2}, '' ORDER BY call_no) AS bundle, min(ds_account) AS ds_account "
        "FROM cut_up WHERE found IS NOT NULL GROUP BY ALL"),
    "account_name": _crm("SELECT * FROM names"),
    "account_pairs": _crm("SELECT * FROM pairs"),
    "conversation_bundle": f"""
        WITH t AS (
          SELECT *, row_number() OVER w AS turn_no, sum(least(64 + coalesce(length(text), 0), {PART})) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - least(64 + coalesce(length(text), 0), {PART}) AS before
          FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ASC NULLS LAST, role ASC NULLS LAST, text ASC NULLS LAST)),
        p AS (SELECT *, CAST(before AS BIGINT) // {PART} AS part_no, max(CAST(before AS BIGINT) // {PART}) OVER (PARTITION BY conv_id) + 1 AS n_parts FROM t)
        SELECT conv_id, part_no, n_parts, count(*) AS n_turns,
               string_agg('Turn #' || CAST(turn_no AS VARCHAR) || ' - ' || coalesce(role, 'None')
                          || {NL2} || coalesce(text, '') || {NL2}, '' ORDER BY turn_no) AS bundle
        FROM p GROUP BY ALL""",
    "newline_texts": (
        "SELECT doc_id, regexp_replace(replace(text, chr(10), chr(13) || chr(10)) || chr(13), '\\r\\n?', chr(10), 'g') AS text FROM documents"),
    "cohort_downloads": _crm(
        "SELECT DISTINCT call_id FROM icp_ids i WHERE call_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM labels l WHERE CAST(l.doc_id AS VARCHAR) = i.call_id)"),
    "json_pages": _feed("SELECT * FROM feed"),
    "retry_requests": _feed(
        f"SELECT CAST(id AS VARCHAR) AS call_id, '{AUDIO_DIR}/' || CAST(id AS VARCHAR) || '.mp3' AS audio_path, "
        f"'{TRANSCRIBE_MODEL}' AS model, '{TRANSCRIBE_FORMAT}' AS response_format, CAST(0.0 AS DOUBLE) AS temperature FROM worklist"),
    "history_merge": _feed(
        "SELECT o.* EXCLUDE (language), CASE WHEN o.language = 'null' THEN coalesce((SELECT min(w.language) FROM with_lang w "
        "WHERE w.id = o.id AND w.language <> 'null'), 'null') ELSE o.language END AS language FROM old_hist o "
        "UNION ALL SELECT * FROM with_lang w WHERE NOT EXISTS (SELECT 1 FROM old_hist o WHERE o.id = w.id)"),
    "artifact_paths": _crm(
        "SELECT Id, call_id, "
        f"'{AUDIO_DIR}/' || coalesce(call_id, 'None') || '.mp3' AS audio_path, "
        f"'{TEXT_DIR}/' || coalesce(call_id, 'None') || '.txt' AS transcript_path "
        "FROM (SELECT Id, NULLIF(regexp_extract(aircall__Call_Recording__c, 'calls/(\\d+)', 1), '') "
        "AS call_id FROM rec_tasks)"),
    "artifact_status": _crm(
        "SELECT Id, AccountId, call_id, "
        "EXISTS (SELECT 1 FROM labels l WHERE CAST(l.doc_id AS VARCHAR) = i.call_id) AS has_audio, "
        "EXISTS (SELECT 1 FROM documents d WHERE CAST(d.doc_id AS VARCHAR) = i.call_id) AS has_transcript "
        "FROM icp_ids i"),
    "transcribe_requests": _crm(
        f"SELECT DISTINCT call_id, '{AUDIO_DIR}/' || call_id || '.mp3' AS audio_path, "
        f"'{TRANSCRIBE_MODEL}' AS model, '{TRANSCRIBE_FORMAT}' AS response_format, "
        "CAST(0.0 AS DOUBLE) AS temperature "
        "FROM icp_ids i WHERE call_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM documents d WHERE CAST(d.doc_id AS VARCHAR) = i.call_id)"),
    "translate_requests": _crm(
        f"SELECT account_id, part_no, n_parts, '{CHAT_MODEL}' AS model, CAST({CHAT_SEED} AS BIGINT) AS seed, "
        f"replace({_lit(TRANSLATE_TEMPLATE)}, '{{account_name}}', coalesce(ds_account, 'None')) AS system, "
        "bundle AS user FROM bundles"),
    "summary_requests": _crm(
        f"SELECT b.account_id, b.part_no, b.n_parts, '{CHAT_MODEL}' AS model, CAST({CHAT_SEED} AS BIGINT) AS seed, "
        f"{_lit(SUMMARY_TEMPLATE)} AS system, r.text AS user "
        f"FROM small_bundles b LEFT JOIN resp_clean r ON r.account_id = b.account_id AND r.part_no = b.part_no "
        f"AND r.kind = 'translation' AND r.run_date = {DAY}"),
    "strip_text": _crm("SELECT account_id, part_no, kind, text FROM resp_clean"),
    "run_date": _crm(
        "SELECT account_id, strftime(run_date, '%Y-%m-%d') AS run_dir, "
        f"'{SUMMARY_DIR}/' || strftime(run_date, '%Y-%m-%d') || '/' || account_id || CASE WHEN part_no > 0 THEN '-' || CAST(part_no AS VARCHAR) ELSE '' END || '.txt' AS path "
        "FROM resp_clean WHERE kind = 'summary'"),
    "account_dim": _crm(
        "SELECT b.account_id AS AccountId, b.part_no, b.n_parts, b.ds_account, t.text AS translation, s.text AS summary "
        "FROM small_bundles b "
        f"LEFT JOIN resp_clean t ON t.account_id = b.account_id AND t.part_no = b.part_no AND t.kind = 'translation' AND t.run_date = {DAY} "
        f"LEFT JOIN resp_clean s ON s.account_id = b.account_id AND s.part_no = b.part_no AND s.kind = 'summary' AND s.run_date = {DAY}"),
}
