"""Slowly changing dimensions and appends.

The customer profile of a date is the status and priority of the customer's newest order
before it; its priority is unknown where the order says 5-LOW.  Profiles of later orders
are the later batches, so a batch brings new, changed, unchanged and absent customers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import table
from millrace.operators import scd
from millrace.operators.rows import deduplicate

KEYS = ["custkey"]
TRACKED = ["status", "priority"]


def _profile(spark, d, since: str | None, until: str | None):
    orders = table(spark, d, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        "o_orderdate",
        "o_orderkey",
    )
    period = orders
    if since:
        period = period.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    if until:
        period = period.filter(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
    newest = deduplicate(period, KEYS, ["o_orderdate desc", "o_orderkey desc"])
    return newest.select("custkey", "status", "priority")


def _batches(spark, d):
    return [
        _profile(spark, d, None, "1996-01-01"),
        _profile(spark, d, "1996-01-01", "2000-01-01"),
        _profile(spark, d, "2000-01-01", None),
    ]


def scd1_upsert(spark, d):
    """Orders of 1998 come again with another status, later ones are new"""
    orders = table(spark, d, "orders")
    stored = orders.filter(F.year("o_orderdate") <= 1998)
    batch = orders.filter(F.year("o_orderdate") >= 1998).withColumn(
        "o_orderstatus", F.lower("o_orderstatus")
    )
    return scd.scd1(stored, batch, ["o_orderkey"])


def scd2_versions(spark, d):
    """K4: three batches"""
    rows = None
    for batch, day in zip(_batches(spark, d), ("2002-01-01", "2002-01-02", "2002-01-03")):
        rows = scd.scd2(rows, batch, KEYS, TRACKED, f"{day} 00:00:00")
    return rows.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("start_date", "end_date")}
    )


def scd3_prev(spark, d):
    """K5: three batches"""
    rows = None
    for batch in _batches(spark, d):
        rows = scd.scd3(rows, batch, KEYS, TRACKED)
    return rows


def scd4_current(spark, d):
    """K6, current side"""
    rows = None
    for batch in _batches(spark, d):
        rows = scd.scd1(rows, batch, KEYS)
    return rows


def scd4_history(spark, d):
    """K6 K8, history side; the last batch has one more column"""
    first, second, third = _batches(spark, d)
    third = third.withColumn("checked", F.col("status") == "F")
    rows = None
    for batch, day in zip((first, second, third), ("2002-01-01", "2002-01-02", "2002-01-03")):
        rows = scd.append(rows, scd.scd4_history(batch, f"{day} 00:00:00"))
    return rows.withColumn("record_timestamp", F.col("record_timestamp").cast("timestamp_ntz"))


def scd4_changes(spark, d):
    """K6, history of changed rows only"""
    before = _profile(spark, d, None, "1996-01-01")
    batch = _profile(spark, d, "1996-01-01", None)
    rows = scd.scd4_history(batch, "2002-01-02 00:00:00", before, KEYS, TRACKED, True)
    return rows.withColumn("record_timestamp", F.col("record_timestamp").cast("timestamp_ntz"))


def delete_where(spark, d):
    """A predicate that is null for some rows"""
    orders = table(spark, d, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))
    )
    return scd.delete_where(orders, "o_orderpriority < '3' OR o_orderstatus = 'P'")


QUERIES = {
    f.__name__: f
    for f in (
        scd1_upsert,
        scd2_versions,
        scd3_prev,
        scd4_current,
        scd4_history,
        scd4_changes,
        delete_where,
    )
}


def _profile_sql(since: str | None, until: str | None) -> str:
    bounds = [f"o_orderdate >= TIMESTAMP '{since}'"] if since else []
    bounds += [f"o_orderdate < TIMESTAMP '{until}'"] if until else []
    return f"""
      SELECT o_custkey AS custkey, o_orderstatus AS status,
             nullif(o_orderpriority, '5-LOW') AS priority
      FROM orders WHERE {' AND '.join(bounds)}
      QUALIFY row_number() OVER (PARTITION BY o_custkey
                                 ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


_WITH = f"""
WITH b1 AS ({_profile_sql(None, '1996-01-01')}),
     b2 AS ({_profile_sql('1996-01-01', '2000-01-01')}),
     b3 AS ({_profile_sql('2000-01-01', None)}),
     b AS (SELECT *, 1 AS n, TIMESTAMP '2002-01-01' AS day FROM b1
           UNION ALL SELECT *, 2, TIMESTAMP '2002-01-02' FROM b2
           UNION ALL SELECT *, 3, TIMESTAMP '2002-01-03' FROM b3),
     seen AS (SELECT *, lag(status) OVER w AS old_status, lag(priority) OVER w AS old_priority,
                     lag(n) OVER w AS old_n
              FROM b WINDOW w AS (PARTITION BY custkey ORDER BY n)),
     changes AS (SELECT * FROM seen WHERE old_n IS NULL OR old_status IS DISTINCT FROM status
                                       OR old_priority IS DISTINCT FROM priority)
"""

SQL = {
    "scd1_upsert": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN year(o_orderdate) >= 1998 THEN lower(o_orderstatus)
                    ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "scd2_versions": f"""{_WITH}
        SELECT custkey, status, priority, day AS start_date,
               lead(day) OVER (PARTITION BY custkey ORDER BY n) AS end_date,
               lead(day) OVER (PARTITION BY custkey ORDER BY n) IS NULL AS is_current
        FROM changes""",
    "scd3_prev": f"""{_WITH},
        last AS (SELECT * FROM b QUALIFY row_number()
                 OVER (PARTITION BY custkey ORDER BY n DESC) = 1),
        s AS (SELECT custkey, arg_max(CASE WHEN old_status IS NULL THEN '~' ELSE old_status END, n)
                AS v FROM seen WHERE old_n IS NOT NULL AND old_status IS DISTINCT FROM status
              GROUP BY custkey),
        p AS (SELECT custkey, arg_max(CASE WHEN old_priority IS NULL THEN '~' ELSE old_priority END,
                n) AS v FROM seen
              WHERE old_n IS NOT NULL AND old_priority IS DISTINCT FROM priority GROUP BY custkey)
        SELECT custkey, status, priority, nullif(s.v, '~') AS prev_status,
               nullif(p.v, '~') AS prev_priority
        FROM last LEFT JOIN s USING (custkey) LEFT JOIN p USING (custkey)""",
    "scd4_current": f"""{_WITH}
        SELECT custkey, status, priority FROM b
        QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY n DESC) = 1""",
    "scd4_history": f"""{_WITH}
        SELECT custkey, status, priority, day AS record_timestamp,
               CASE WHEN n = 3 THEN status = 'F' END AS checked FROM b""",
    "scd4_changes": f"""
        SELECT custkey, status, priority, TIMESTAMP '2002-01-02' AS record_timestamp FROM (
          SELECT * FROM ({_profile_sql('1996-01-01', None)})
          EXCEPT SELECT * FROM ({_profile_sql(None, '1996-01-01')}))""",
    "delete_where": """
        SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders
        WHERE NOT coalesce(nullif(o_orderpriority, '5-LOW') < '3' OR o_orderstatus = 'P', false)""",
}
