"""Run registered queries beside their SQL and report differences: check_oracles.py SF_DIR [name ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """A value in a form both engines share."""
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.9g}" if value else "0"
    if isinstance(value, decimal.Decimal):
        return f"DECIMAL {value}"
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{plain(v)}" for k, v in value.items()) + "}"
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(plain(r[i]) for i in order) for r in rows])


def difference(spark_df, con, sql):
    """None when the two results are equal, else what differs."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    expected = rows_of(names, theirs.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}", len(got[1])
    if len(got[1]) != len(expected[1]):
        only = set(got[1]) ^ set(expected[1])
        return f"{len(got[1])} rows != {len(expected[1])} rows; e.g. {str(list(only)[:3])[:600]}", len(got[1])
    for mine, other in zip(got[1], expected[1]):
        if mine != other:
            pairs = [(n, a[:200], b[:200]) for n, a, b in zip(got[0], mine, other) if a != b]
            return f"first difference {pairs}", len(got[1])
    return None, len(got[1])


def main(argv):
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import local_session

    sf_dir, names = argv[1], argv[2:]
    spark = local_session("8")
    con = database(sf_dir)
    all_queries, all_sql = queries(), oracle_sql()
    chosen = [n for n in all_queries if not names or any(n.startswith(p) for p in names)]
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            df = all_queries[name](spark, sf_dir)
            if name in all_sql:
                diff, n = difference(df, con, all_sql[name])
            else:
                diff, n = None, df.count()
            status = "ok" if diff is None else f"DIFFERENT {diff}"
        except Exception as error:  # report and go on
            status, n = f"ERROR {type(error).__name__} {str(error)[:1500]}", -1
        bad += not status.startswith("ok")
        kind = "sql" if name in all_sql else "rows"
        print(f"{name:40s} {kind:4s} rows={n:<7d} {time.time() - start:6.2f}s {status}", flush=True)
    print(f"{len(chosen)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
