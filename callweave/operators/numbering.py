"""Running numbers per key in one lazy plan at every size.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` would put all rows of a
key into one task. Here the order is cut into buckets that follow it (a day
of the call date, a range of the turn number), and a bucket of more than
``split_rows`` rows is cut further:

1. a hot bucket's order is sketched by a hash sample of its rows, about 16
   for each part it needs; every 16th of the sorted sample is a split point;
2. each row is numbered inside its ``(key, bucket, part)`` -- the windows
   that hold whole rows are as small as those;
3. rows (and their weight) are counted per ``(key, bucket, part)``, and a
   running sum over a key's parts, one lean row each, gives what came before;
4. the two are joined on ``(key, bucket, part)``.

The input is a CTE with a random column, which Spark must evaluate once and
share (a deterministic CTE would be inlined for each reader), so it is
neither scanned twice nor written out, and building the plan runs nothing.
Its shuffle deals a hot key evenly; one more brings the rows of a part
together, and everything else that moves is one lean row per part.

The split points are sent to every task: at most 16 bytes of order key and
a few more for every ``split_rows`` rows, and none for buckets below it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

SPLIT_ROWS = 1 << 20

_SQL = """
WITH rows AS (
  SELECT *, {key} IS NULL AS _null, coalesce(CAST({key} AS STRING), '') AS _key, {bucket} AS _bucket,
         CAST({weight} AS BIGINT) AS _weight, struct({at}) AS _at, rand() AS _once
  FROM {{df}}),
hot AS (
  SELECT _null AS _hot_null, _key AS _hot_key, _bucket AS _hot_bucket, count(*) AS _size
  FROM rows GROUP BY _null, _key, _bucket HAVING count(*) > {split_rows}),
sketch AS (
  SELECT _hot_null, _hot_key, _hot_bucket, filter(array_sort(collect_set(_at)), (x, i) -> i % 16 = 15) AS _splits
  FROM rows JOIN hot ON _null = _hot_null AND _key = _hot_key AND _bucket = _hot_bucket
  WHERE pmod(xxhash64(_at), greatest(1, {split_rows} div 16)) = 0
  GROUP BY _hot_null, _hot_key, _hot_bucket),
placed AS (
  SELECT /*+ BROADCAST(sketch) */ rows.*, coalesce(size(filter(_splits, x -> x < _at)), 0) AS _part
  FROM rows LEFT JOIN sketch ON _null = _hot_null AND _key = _hot_key AND _bucket = _hot_bucket),
parts AS (
  SELECT _null, _key, _bucket, _part, count(*) AS _n, sum(_weight) AS _sum, max_by(_weight, _at) AS _last
  FROM placed GROUP BY _null, _key, _bucket, _part),
before AS (
  SELECT _null, _key, _bucket, _part, sum(_n) OVER (earlier) - _n AS _rows_before, sum(_sum) OVER (earlier) - _sum AS _weight_before,
         sum(_sum) OVER (whole) - last_value(_last) OVER (PARTITION BY _null, _key ORDER BY _bucket, _part ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS _weight_before_last
  FROM parts
  WINDOW earlier AS (PARTITION BY _null, _key ORDER BY _bucket, _part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         whole AS (PARTITION BY _null, _key)),
numbered AS (
  SELECT placed.*, row_number() OVER (inside) AS _n, sum(_weight) OVER (PARTITION BY _null, _key, _bucket, _part ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - _weight AS _w
  FROM placed WINDOW inside AS (PARTITION BY _null, _key, _bucket, _part ORDER BY {order}))
SELECT numbered.* EXCEPT (_null, _key, _bucket, _weight, _at, _once, _part, _n, _w), CAST(_n + _rows_before AS BIGINT) AS {out}{extra}
FROM numbered JOIN before USING (_null, _key, _bucket, _part)
"""


def number_within(df: DataFrame, key: str, order: list[str], bucket: str, out: str,
                  weight: str | None = None, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Add ``out`` = 1, 2, ... within each ``key`` (NULL keys form one group).

    ``order``: ``"<column> ASC"`` strings, with or without ``NULLS LAST``, together a total order.
    ``bucket``: a SQL expression, never NULL, whose ascending order agrees
    with ``order``. With ``weight`` two columns more: ``<out>_before``, the
    weight of a key's earlier rows, and ``<out>_before_last``, that of all
    but its last row.
    """
    at = []  # in ascending order of (null flag, value) structs, as in `order`
    for column, *how in map(str.split, order):
        if how not in (["ASC"], ["ASC", "NULLS", "LAST"]):
            raise ValueError("order must be ascending")
        at.append(f"{column} IS {'NOT ' if how == ['ASC'] else ''}NULL, {column}")
    extra = f", CAST(_w + _weight_before AS BIGINT) AS {out}_before, CAST(_weight_before_last AS BIGINT) AS {out}_before_last" if weight else ""
    text = _SQL.format(key=f"`{key}`", bucket=bucket, weight=weight or "0", at=", ".join(at), split_rows=int(split_rows),
                       order=", ".join(order), out=f"`{out}`", extra=extra)
    return df.sparkSession.sql(text, df=df)
