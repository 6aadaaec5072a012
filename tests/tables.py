"""Small star-schema tables, written as the given ones are."""

from datetime import datetime

KINDS = ["click", "view", "purchase", "signup", "error"]


def write_tables(spark, path, events=300, orders=40, lines=4, order_of=lambda i, j: i):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")

    day = lambda i: datetime(1996 + i % 3, 1 + i % 12, 1 + i % 28)
    put("region", [(i, n) for i, n in enumerate(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])], "r_regionkey int, r_name string")
    put("nation", [(i, f"N{i}", i % 5) for i in range(25)], "n_nationkey int, n_name string, n_regionkey int")
    put(
        "customer", [(i, f"Customer#{i:09d}", i % 25, 100.0 * i - 500, ["FURNITURE", "BUILDING", "MACHINERY"][i % 3]) for i in range(12)],
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    )
    put(
        "orders", [(i, i % 12, "FOP"[i % 3], 10.0 + i, day(i), ["1-URGENT", "2-HIGH", "5-LOW"][i % 3]) for i in range(orders)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    )
    put(
        "lineitem",
        [(order_of(i, j), i, j, j, float(1 + (i + j) % 50), 20.0 + i, 0.01 * j, 0.01 * (i % 4), "ANR"[(i + j) % 3], "FO"[(i + j) % 2], day(i + j)) for i in range(orders) for j in range(lines)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    )
    put(
        "events", [(i, datetime(2024, 1, 1 + i % 28, 10), 100 + i % 9, KINDS[i % 5], float(i), f'{{"k": {i * 7 % 100}}}') for i in range(events)],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    )
    return str(path)


def same_as_duckdb(spark, path, name):
    """Rows of a query, after they were compared with those of its SQL."""
    import glob
    import os

    import duckdb

    import __spark_entry__ as entry
    from verify import rows_of

    con = duckdb.connect()
    for file in glob.glob(f"{path}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}/*.parquet'")
    found = entry.queries()[name](spark, path)
    rows = found.collect()
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert rows_of(found.columns, rows) == rows_of(columns, cursor.fetchall())
    return rows
