"""Compare a Spark result with DuckDB on the same files, and a command line for single queries.

    python -m tests.compare [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        if not os.path.exists(f"{sf}/{name}.parquet"):
            continue
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def _value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return repr(x)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, con, sql, show: int = 4) -> list[str]:
    """Empty when column names, row counts and values agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    spark_kinds = dict(df.dtypes)
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    problems = [f"type of {c}: {spark_kinds[c]} against {kinds[c]}" for c in names
                if same.get(spark_kinds[c]) != kinds[c]]
    ours = _rows(df.columns, df.collect())
    theirs = _rows(names, result.fetchall())
    if ours != theirs:
        problems.append(f"{sum(ours.values())} rows against {sum(theirs.values())}; "
                        f"only ours {sum((ours - theirs).values())} "
                        f"{list((ours - theirs))[:show]}; only theirs "
                        f"{list((theirs - ours))[:show]}; order {sorted(names)}")
    return problems


def main(argv):
    import __spark_entry__ as entry
    from tidemark.session import local_session

    sf = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    spark, con = local_session("compare"), connect(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracle:
                problems = differences(df, con, oracle[name])
            else:
                problems = [] if df.collect() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':5}{name:28}{time.time() - start:7.2f}s  "
              f"{' | '.join(problems)[:1600]}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
