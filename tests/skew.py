"""Copies of the benchmark tables in which one key holds a third of all rows."""

from __future__ import annotations

import duckdb

HOT_CUSTOMER, HOT_ORDER = 7, 11


def write_skewed(source: str, target: str) -> None:
    con = duckdb.connect()
    # Every third order belongs to one customer; every third line item belongs to one order of that customer.
    orders = f"""SELECT * REPLACE (if(o_orderkey % 3 = 0 OR o_orderkey = {HOT_ORDER}, {HOT_CUSTOMER}, o_custkey) AS o_custkey)
                 FROM '{source}/orders.parquet'"""
    lines = f"""SELECT * REPLACE (if((l_partkey + l_suppkey + l_linenumber) % 3 = 0, {HOT_ORDER}, l_orderkey) AS l_orderkey)
                FROM '{source}/lineitem.parquet'"""
    con.sql(f"COPY ({orders}) TO '{target}/orders.parquet'")
    con.sql(f"COPY ({lines}) TO '{target}/lineitem.parquet'")
    for table in (
        "region nation customer supplier part events documents embeddings pages benchmark labels conversations"
    ).split():
        con.sql(f"COPY (SELECT * FROM '{source}/{table}.parquet') TO '{target}/{table}.parquet'")
