"""Comparison of a Spark result with DuckDB's: column names, kinds of types, row count and every value."""

import os
from collections import Counter

import duckdb


def connect(folder):
    con = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name, ending = os.path.splitext(file)
        if ending == ".parquet":
            con.execute(f"create view {name} as select * from '{folder}/{file}'")
    return con


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def expected(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [KINDS.get(str(d[1]), str(d[1])) for d in result.description]
    return dict(zip(names, types)), names, result.fetchall()


def actual(df):
    return dict(df.dtypes), df.columns, [tuple(row) for row in df.collect()]


def in_name_order(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    """Empty if the two agree."""
    spark_types, spark_names, spark_rows = actual(df)
    duck_types, duck_names, duck_rows = expected(con, sql)
    faults = []
    if spark_types != duck_types:
        faults.append(f"schema {spark_types} against {duck_types}")
    left, right = in_name_order(spark_names, spark_rows), in_name_order(duck_names, duck_rows)
    if left != right:
        faults.append(
            f"{len(spark_rows)} rows against {len(duck_rows)}; only in Spark: "
            f"{list((left - right).items())[:3]}; only in DuckDB: {list((right - left).items())[:3]}"
        )
    return faults
