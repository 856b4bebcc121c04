"""Compare a query with its SQL: columns, types, row count and every value.

``python tests/oracle.py [folder] [name ...]`` checks all or the named queries.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def differences(df, con, sql: str) -> list[str]:
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    wanted_types = [str(d[1]) for d in result.description]
    wanted = result.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for name, kind in zip(names, wanted_types):
        if TYPES.get(kind, kind) != kinds[name]:
            found.append(f"type of {name}: {kinds[name]} != {kind}")
    if len(rows) != len(wanted):
        found.append(f"{len(rows)} rows != {len(wanted)}")
    order = [df.columns.index(n) for n in names]
    a = Counter(tuple(r[i] for i in order) for r in rows)
    b = Counter(wanted)
    if a != b:
        found.append(f"only Spark: {list((a - b).items())[:3]}")
        found.append(f"only SQL: {list((b - a).items())[:3]}")
    return found


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(arguments: list[str]) -> int:
    import __spark_entry__ as entry

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    chosen = arguments[1:] or list(entry.queries())
    spark, con, sql, bad = session(), connect(folder), entry.oracle_sql(), 0
    for name in chosen:
        started = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            found = differences(df, con, sql[name]) if name in sql else []
            count = "" if name in sql else f" (no SQL, {df.count()} rows)"
        except Exception as error:  # noqa: BLE001
            found, count = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        bad += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {time.time() - started:.1f}s{count}", flush=True)
        for line in found:
            print("     ", line[:1200], flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
