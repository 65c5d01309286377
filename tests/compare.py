"""Run registered queries next to their SQL and compare schema, rows and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

DUCK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def connect(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    return v


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    types = dict(spark_df.dtypes)
    names = sorted(types)
    result = con.execute(sql)
    duck_types = {d[0]: DUCK_TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    want_rows = result.fetchall()
    order = [d[0] for d in result.description]
    if sorted(order) != names:
        return f"columns {names} against {sorted(order)}"
    wrong = {n: (types[n], duck_types[n]) for n in names if types[n] != duck_types[n]}
    got = Counter(
        tuple(_value(row[n]) for n in names) for row in spark_df.collect()
    )
    at = [order.index(n) for n in names]
    want = Counter(tuple(_value(row[i]) for i in at) for row in want_rows)
    if got != want:
        missing, extra = want - got, got - want
        return (
            f"rows {sum(got.values())} against {sum(want.values())}; "
            f"only sql {sum(missing.values())} {list(missing)[:2]}; "
            f"only spark {sum(extra.values())} {list(extra)[:2]}"
        )
    return f"types {wrong}" if wrong else None


def main() -> int:
    import __spark_entry__ as entry
    from claimlens.session import build_session

    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(data_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, data_dir)
            if name not in oracles:
                verdict = f"rows only: {df.count()}"
            else:
                verdict = compare(df, con, oracles[name]) or "ok"
        except Exception as error:  # noqa: BLE001
            verdict = f"error {type(error).__name__}: {str(error)[:600]}"
        if verdict != "ok" and not verdict.startswith("rows only"):
            bad += 1
        print(f"{name}: {verdict} ({time.time() - start:.2f} s)", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
