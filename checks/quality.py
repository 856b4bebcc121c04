"""Data-quality rules and join-key checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import table
from millrace.operators import quality as q
from millrace.operators.rows import union_all

AS_OF = "2001-01-01 00:00:00"

NUMERIC = [
    {"column": "l_quantity", "type": "numeric", "min_value": 5, "max_value": 45,
     "null_allowed": False},
    {"column": "l_discount", "type": "numeric", "max_value": 0.08},
    {"column": "l_orderkey", "type": "numeric", "unique": True},
    {"column": "l_absent", "type": "numeric", "min_value": 0},
]
STRING = [
    {"column": "p_name", "type": "string", "unique": True, "pattern": "^[a-m]"},
    {"column": "p_brand", "type": "string", "null_allowed": False, "pattern": "#[0-9]$"},
    {"column": "p_brand", "type": "string", "unique": True},
]
TIMESTAMP = [
    {"column": "o_orderdate", "type": "timestamp", "max_age_days": 1000, "null_allowed": False},
]


def _part(spark, d):
    return table(spark, d, "part").withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#7")))


def quality_numeric(spark, d):
    """Q1 Q5"""
    return q.validate(table(spark, d, "lineitem"), q.parse_rules(NUMERIC), "lineitem")


def quality_string(spark, d):
    """Q2"""
    return q.validate(_part(spark, d), q.parse_rules(STRING), "part")


def quality_timestamp(spark, d):
    """Q3"""
    return q.validate(table(spark, d, "orders"), q.parse_rules(TIMESTAMP), "orders", AS_OF)


def quality_summary(spark, d):
    """Q9"""
    reports = [quality_numeric(spark, d), quality_string(spark, d), quality_timestamp(spark, d)]
    return q.summarise(union_all(reports))


def _labels(spark, d):
    """Labels of some documents, one of them of none."""
    return table(spark, d, "labels").select(F.nullif("doc_id", F.lit(11)).alias("doc_id"), "quality")


def orphan_keys(spark, d):
    """Q7"""
    documents = table(spark, d, "documents").select("doc_id")
    return q.orphan_check(documents, _labels(spark, d), ["doc_id"])


def orphan_rules(spark, d):
    """Q8"""
    frames = {
        "documents": table(spark, d, "documents").select("doc_id"),
        "labels": _labels(spark, d),
        "customers": table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey")),
        "nations": table(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey")),
    }
    return q.check_joins(
        frames,
        [
            {"source_table": "documents", "target_table": "labels", "keys": ["doc_id"],
             "max_orphaned_ratio": 0.1},
            {"source_table": "customers", "target_table": "nations", "keys": ["nationkey"],
             "max_orphaned_ratio": 0.05},
        ],
    )


QUERIES = {
    f.__name__: f
    for f in (
        quality_numeric,
        quality_string,
        quality_timestamp,
        quality_summary,
        orphan_keys,
        orphan_rules,
    )
}


def _report(name: str, source: str, checks: list[tuple[str, str, str, str]]) -> str:
    counts = ", ".join(f"{sql} AS c{i}" for i, (_, _, _, sql) in enumerate(checks))
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", '{column}' AS "column", '{rule}' AS rule,
            '{check}' AS "check", CAST(c{i} AS BIGINT) AS violations, row_count, c{i} = 0 AS passed
            FROM c"""
        for i, (column, rule, check, _) in enumerate(checks)
    )
    return f"(WITH c AS (SELECT count(*) AS row_count, {counts} FROM {source}) {rows})"


_LINEITEM = _report(
    "lineitem",
    "lineitem",
    [
        ("l_quantity", "numeric", "null", "count(*) - count(l_quantity)"),
        ("l_quantity", "numeric", "min_value", "count(*) FILTER (WHERE l_quantity < 5)"),
        ("l_quantity", "numeric", "max_value", "count(*) FILTER (WHERE l_quantity > 45)"),
        ("l_discount", "numeric", "max_value", "count(*) FILTER (WHERE l_discount > 0.08)"),
        ("l_orderkey", "numeric", "unique", "count(*) - count(DISTINCT l_orderkey)"),
        ("l_absent", "numeric", "column missing", "count(*)"),
    ],
)
_PART = _report(
    "part",
    "(SELECT * REPLACE (nullif(p_brand, 'Brand#7') AS p_brand) FROM part)",
    [
        ("p_name", "string", "unique", "count(*) - count(DISTINCT p_name)"),
        ("p_name", "string", "pattern",
         "count(*) FILTER (WHERE NOT regexp_matches(p_name, '^[a-m]'))"),
        ("p_brand", "string", "null", "count(*) - count(p_brand)"),
        ("p_brand", "string", "pattern",
         "count(*) FILTER (WHERE NOT regexp_matches(p_brand, '#[0-9]$'))"),
        ("p_brand", "string", "unique", "count(*) - count(DISTINCT p_brand) - 1"),
    ],
)
_ORDERS = _report(
    "orders",
    "orders",
    [
        ("o_orderdate", "timestamp", "null", "count(*) - count(o_orderdate)"),
        ("o_orderdate", "timestamp", "max_age_days",
         f"count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{AS_OF}' - INTERVAL 1000 DAY)"),
        ("o_orderdate", "timestamp", "future",
         f"count(*) FILTER (WHERE o_orderdate > TIMESTAMP '{AS_OF}')"),
    ],
)
_LABELLED = """
    l AS (SELECT DISTINCT doc_id FROM documents),
    r AS (SELECT DISTINCT nullif(doc_id, 11) AS doc_id FROM labels),
    n AS (SELECT (SELECT count(*) FROM l) AS left_keys, (SELECT count(*) FROM r) AS right_keys,
                 (SELECT count(*) FROM l WHERE NOT EXISTS
                   (SELECT 1 FROM r WHERE r.doc_id = l.doc_id)) AS left_orphans,
                 (SELECT count(*) FROM r WHERE NOT EXISTS
                   (SELECT 1 FROM l WHERE r.doc_id = l.doc_id)) AS right_orphans)
"""

SQL = {
    "quality_numeric": _LINEITEM[1:-1],
    "quality_string": _PART[1:-1],
    "quality_timestamp": _ORDERS[1:-1],
    "quality_summary": f"""
        SELECT "table", max(row_count) AS row_count, count(*) AS checks,
               count(*) FILTER (WHERE passed) AS passed_checks,
               count(*) FILTER (WHERE NOT passed) AS failed_checks,
               coalesce(string_agg("column" || '.' || "check", ',' ORDER BY "column", "check")
                 FILTER (WHERE NOT passed), '') AS failed,
               bool_and(passed) AS passed
        FROM ({_LINEITEM} UNION ALL {_PART} UNION ALL {_ORDERS}) GROUP BY "table\"""",
    "orphan_keys": f"""WITH {_LABELLED}
        SELECT left_keys, right_keys, left_orphans, right_orphans,
               left_orphans / left_keys AS left_ratio, right_orphans / right_keys AS right_ratio,
               greatest(left_orphans / left_keys, right_orphans / right_keys) <= 0.1 AS valid
        FROM n""",
    "orphan_rules": f"""WITH {_LABELLED}
        SELECT 'documents' AS source_table, 'labels' AS target_table, 'doc_id' AS keys,
               left_keys AS source_keys, left_orphans AS orphans,
               left_orphans / left_keys AS orphan_ratio, left_orphans / left_keys <= 0.1 AS passed
        FROM n
        UNION ALL
        SELECT 'customers', 'nations', 'nationkey', count(DISTINCT c_nationkey),
               count(DISTINCT c_nationkey) FILTER (WHERE n_nationkey IS NULL),
               count(DISTINCT c_nationkey) FILTER (WHERE n_nationkey IS NULL)
                 / count(DISTINCT c_nationkey),
               count(DISTINCT c_nationkey) FILTER (WHERE n_nationkey IS NULL)
                 / count(DISTINCT c_nationkey) <= 0.05
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
}
