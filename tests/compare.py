"""Run registered queries against their SQL twins: python -m tests.compare [sf] [name ...]"""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return repr(value)
    if isinstance(value, int):
        return repr(float(value))
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def compare(spark, connection, query, sql, sf_dir):
    """None if equal, else the first difference."""
    result = query(spark, sf_dir)
    spark_columns, spark_rows = rows_of(result.columns, [tuple(r) for r in result.collect()])
    twin = connection.execute(sql)
    columns = [c[0] for c in twin.description]
    sql_columns, sql_rows = rows_of(columns, twin.fetchall())
    if spark_columns != sql_columns:
        return f"columns {spark_columns} / {sql_columns}", len(spark_rows)
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}", len(spark_rows)
    for left, right in zip(spark_rows, sql_rows):
        if left != right:
            short = [(c, a[:120], b[:120]) for c, a, b in zip(spark_columns, left, right) if a != b]
            return f"values {short}", len(spark_rows)
    return None, len(spark_rows)


def main():
    from revlens.plans.oracle import oracle_sql
    from revlens.plans.queries import REGISTRY
    from revlens.runtime import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(REGISTRY)
    twins = oracle_sql()
    spark = local_session(8)
    connection = connect(sf_dir)
    failed = []
    for name in names:
        started = time.time()
        try:
            if name in twins:
                problem, count = compare(spark, connection, REGISTRY[name], twins[name], sf_dir)
            else:
                problem, count = None, len(REGISTRY[name](spark, sf_dir).collect())
        except Exception as error:  # keep going, report at the end
            problem, count = f"{type(error).__name__}: {str(error)[:1500]}", 0
        kind = "sql " if name in twins else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:28s} {count:6d} rows "
              f"{time.time() - started:6.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
