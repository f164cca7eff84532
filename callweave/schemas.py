"""Declared schemas for every table the engine reads or writes.

Nothing is inferred: an empty feed still yields a frame with the full
schema, and a partition column read back from a path keeps its type.
"""

from pyspark.sql import types as T

_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()
_TS = T.TimestampNTZType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# One landed page of the call feed: calls[] plus paging metadata.
NUMBER = T.StructType([_f("id", _L), _f("name", _S)])
USER = T.StructType([_f("id", _L), _f("name", _S), _f("email", _S), _f("available", _B)])
CALL = T.StructType([
    _f("id", _L),
    _f("number", NUMBER),
    _f("started_at", _L),        # epoch seconds
    _f("answered_at", _L),       # epoch seconds, NULL for a missed call
    _f("ended_at", _L),          # epoch seconds
    _f("direction", _S),
    _f("recording", _S),         # NULL when the call was not recorded
    _f("user", USER),            # NULL when nobody picked up
])
PAGE = T.StructType([
    _f("calls", T.ArrayType(CALL)),
    _f("meta", T.StructType([_f("next_page_link", _S)])),
])

# A page as it was landed: the link it was fetched by, and its text where it is no whole page.
LANDED_PAGE = T.StructType([*PAGE.fields, _f("page_link", _S), _f("_corrupt_record", _S)])

# Flattened feed rows (12 fields, in feed order).
FLAT_CALL = T.StructType([
    _f("id", _L), _f("number_id", _L), _f("number_name", _S),
    _f("started_at", _L), _f("answered_at", _L), _f("ended_at", _L),
    _f("direction", _S), _f("recording", _S),
    _f("user_id", _S), _f("user_name", _S), _f("user_email", _S), _f("user_available", _S),
])

# The call history table (call_meta_data).
HISTORY = T.StructType([
    _f("id", _L), _f("number_id", _L), _f("number_name", _S),
    _f("user_id", _S), _f("user_full_name", _S), _f("user_email", _S),
    _f("started_at", _TS), _f("answered_at", _TS), _f("ended_at", _TS),
    _f("direction", _S), _f("available", _S), _f("language", _S),
])

# CRM inputs.
# --- fixed values: the task table's field names, as the CRM names them ------
TASK_COLUMNS = [
    "Id", "WhoId", "WhatId", "AccountId", "OwnerId", "Subject",
    "aircall__Country__c", "aircall__Call_Recording__c", "CallDisposition",
    "aircall__Detailed_type__c", "aircall__Connection_status__c",
    "aircall__Answered_by__c", "CompletedDateTime", "CallDurationInSeconds",
    "CallType", "CreatedDate",
]
# ---------------------------------------------------------------------------
TASK = T.StructType(
    [_f(c, _S) for c in TASK_COLUMNS[:12]]
    + [_f("CompletedDateTime", _TS), _f("CallDurationInSeconds", _L),
       _f("CallType", _S), _f("CreatedDate", _TS)]
)
OPPORTUNITY = T.StructType([_f("fk_account", _S), _f("flg_is_from_pro_form", _B)])
ACCOUNT = T.StructType([_f("pk_account", _S), _f("ds_account", _S), _f("ts_created_at", _TS)])
USER_DIM = T.StructType([_f("pk_user", _S), _f("ds_full_name", _S)])

# Keyed stores that replace the reference's file-per-key folders.
ARTIFACT = T.StructType([_f("kind", _S), _f("name", _S), _f("call_id", _S)])
TRANSCRIPT = T.StructType([_f("call_id", _S), _f("text", _S), _f("language", _S)])
ATTEMPT = T.StructType([_f("call_id", _S), _f("attempted_at", _TS), _f("text", _S), _f("language", _S), _f("error", _S)])
RESPONSE = T.StructType([
    _f("account_id", _S), _f("part_no", _L), _f("kind", _S), _f("run_date", T.DateType()),
    _f("text", _S),
])

# Outputs.
ACCOUNT_DIM = T.StructType([
    _f("AccountId", _S), _f("part_no", _L), _f("n_parts", _L), _f("ds_account", _S), _f("translation", _S),
    _f("summary", _S),
])

# The driver's test tables read by the overlay, declared so that a read
# needs no schema-inference job.
_I, _D = T.IntegerType(), T.DoubleType()
DRIVER_TABLES = {
    "orders": T.StructType([_f("o_orderkey", _L), _f("o_custkey", _L), _f("o_orderstatus", _S),
                            _f("o_totalprice", _D), _f("o_orderdate", _TS),
                            _f("o_orderpriority", _S)]),
    "customer": T.StructType([_f("c_custkey", _L), _f("c_name", _S), _f("c_nationkey", _I),
                              _f("c_acctbal", _D), _f("c_mktsegment", _S)]),
    "supplier": T.StructType([_f("s_suppkey", _L), _f("s_name", _S), _f("s_nationkey", _I),
                              _f("s_acctbal", _D)]),
    "events": T.StructType([_f("event_id", _L), _f("ts", _TS), _f("user_id", _L),
                            _f("event_type", _S), _f("value", _D), _f("props", _S)]),
    "documents": T.StructType([_f("doc_id", _L), _f("text", _S), _f("lang", _S),
                               _f("source", _S), _f("n_chars", _L)]),
    "labels": T.StructType([_f("doc_id", _L), _f("quality", _I), _f("toxic", _I)]),
    "conversations": T.StructType([_f("conv_id", _L), _f("turn", _L), _f("role", _S),
                                   _f("text", _S)]),
    "pages": T.StructType([_f("page_id", _L), _f("url", _S), _f("html", _S)]),
}
