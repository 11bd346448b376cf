"""Compare every registered query with its SQL statement: python tests/compare.py [folder] [name …]"""

import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return int(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is None, str(v)) for v in row)
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=key)


def check(spark, con, folder, name, query, sql):
    begin = time.time()
    df = query(spark, folder)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - begin
    begin = time.time()
    result = con.execute(sql)
    want = table([d[0] for d in result.description], result.fetchall())
    kinds = {d[0]: str(d[1]) for d in result.description}
    return got, want, spent, time.time() - begin, kinds, dict(df.dtypes)


def main(folder, names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(sql)), "without query:", sorted(set(sql) - set(queries)))
    bad = []
    for name in names or queries:
        if name not in sql:
            continue
        try:
            got, want, spent, sql_spent, kinds, types = check(spark, con, folder, name, queries[name], sql[name])
        except Exception as error:  # noqa: BLE001
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:500]}", flush=True)
            bad.append(name)
            continue
        same = got == want
        odd = {c: (types[c], k) for c, k in kinds.items() if c in types and {types[c]} & {"int", "double"} or k in ("HUGEINT", "DOUBLE")}
        print(f"{'ok ' if same else 'BAD'} {name} rows={len(got[1])}/{len(want[1])} spark={spent:.1f}s sql={sql_spent:.1f}s {odd or ''}", flush=True)
        if not same:
            bad.append(name)
            print("  columns", got[0], want[0])
            a, b = set(got[1]), set(want[1])
            print("  only spark", [str(r)[:300] for r in list(a - b)[:2]])
            print("  only sql  ", [str(r)[:300] for r in list(b - a)[:2]])
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001", sys.argv[2:])))
