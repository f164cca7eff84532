"""Scalar functions against brute-force Python on generated inputs."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callweave.constants import CALL_HEADER_FORMAT
from callweave.functions import (call_header, epoch_to_timestamp, extract_call_id,
                                 strip_whitespace, timestamp_to_epoch)

WS = " \t\n\x0b\x0c\r"
urls = st.one_of(
    st.builds(lambda h, n, t: f"https://{h}/calls/{n}/{t}", st.sampled_from(["a.example", "b.io"]),
              st.integers(0, 10**12), st.sampled_from(["recording", "", "x"])),
    st.text(alphabet="calsx/0123456789:.", max_size=30),
    st.none())
texts = st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("ab é") + list(WS) + ["\xa0"]),
                                     max_size=20))


def _py_call_id(u):
    if u is None:
        return None
    m = re.search(r"calls/(\d+)", u)
    return m.group(1) if m else None


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(urls, texts), min_size=30, max_size=60))
def test_extract_and_strip_match_python(spark, rows):
    df = spark.createDataFrame(rows, "u string, t string")
    got = df.select(extract_call_id("u").alias("id"), strip_whitespace("t").alias("s")).collect()
    assert [r.id for r in got] == [_py_call_id(u) for u, _ in rows]
    assert [r.s for r in got] == [None if t is None else t.strip(WS) for _, t in rows]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10**6), st.one_of(st.none(), st.integers(0, 4 * 10**9)),
                          st.one_of(st.none(), st.integers(0, 10**5)),
                          st.one_of(st.none(), st.text(alphabet="Ana ß{}", max_size=8))),
                min_size=20, max_size=40))
def test_header_and_epochs_match_python(spark, rows):
    df = spark.createDataFrame(rows, "n bigint, e bigint, d bigint, a string")
    out = df.select(call_header("n", epoch_to_timestamp("e"), "d", "a").alias("h"),
                    timestamp_to_epoch(epoch_to_timestamp("e")).alias("back")).collect()
    for (n, e, d, a), r in zip(rows, out):
        created = "NaT" if e is None else str(dt.datetime(1970, 1, 1) + dt.timedelta(seconds=e))
        want = CALL_HEADER_FORMAT.format(call_no=n, created=created,
                                         duration="nan" if d is None else d,
                                         agent="None" if a is None else a)
        assert r.h == want
        assert r.back == e
    assert df.select(F.lit(1)).count() == len(rows)
