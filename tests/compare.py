"""Compare a Spark result with the reference SQL run by DuckDB.

Run as a script to check all bound queries:
``python tests/compare.py /root/testdata/sf0.01 [name ...]``
"""

from __future__ import annotations

import decimal
import glob
import math
import os
import sys
import time

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    """A hashable, sortable form; doubles to 9 significant digits."""
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        if math.isnan(number):
            return "nan"
        return f"{number:.9g}" if not number.is_integer() else str(int(value))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(normal(v) for v in value) + "]"
    return str(value).removesuffix("+00:00")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows), [columns[i] for i in order]


KIND = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp", "DATE": "date", "HUGEINT": "hugeint",
}


def difference(frame, con, sql: str) -> str | None:
    """None if names, types and values agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs, their_names = rows_of(names, result.fetchall())
    kinds = {d[0]: KIND.get(str(d[1]), str(d[1]).lower()) for d in result.description}
    ours, our_names = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if our_names != their_names:
        return f"columns {our_names} != {their_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    if ours != theirs:
        i = next(i for i, (a, b) in enumerate(zip(ours, theirs)) if a != b)
        cells = [(n, a, b) for n, a, b in zip(our_names, ours[i], theirs[i]) if a != b]
        return f"row {i}: {cells[:4]}"
    mine = {f.name: f.dataType.simpleString().replace("_ntz", "") for f in frame.schema.fields}
    wrong = [(n, mine[n], kinds[n]) for n in mine if mine[n] != kinds[n]]
    return f"types {wrong}" if wrong else None


def main(folder: str, *names: str) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from recordflow import bindings
    from recordflow.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sqls = bindings.queries(), bindings.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in sqls:
                verdict = difference(frame, con, sqls[name]) or "ok"
            else:
                verdict = f"rows-only ({frame.count()} rows)"
        except Exception as error:  # the script reports every query
            verdict = "ERROR " + str(error).replace("\n", " ")[:600]
        bad = verdict != "ok" and not verdict.startswith("rows-only")
        failed += bad
        print(f"{'!!' if bad else '  '} {name:28s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print(f"{failed} differ of {len(names or queries)}; without SQL: {sorted(set(queries) - set(sqls))}")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
