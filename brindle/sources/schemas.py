"""Declared schemas of the eight relational tables in their '|'-delimited form.

Column names carry the usual one- or two-letter table prefix, so a table read from text and one read
from Parquet can be passed to the same report.
"""

from __future__ import annotations

# Table layouts (position decides the meaning of a field in a delimited file).
TABLES = {
    "customer": """c_custkey int, c_name string, c_address string, c_nationkey int, c_phone string,
        c_acctbal decimal(10,2), c_mktsegment string, c_comment string""",
    "lineitem": """l_orderkey int, l_partkey int, l_suppkey int, l_linenumber int,
        l_quantity decimal(10,2), l_extendedprice decimal(10,2), l_discount decimal(10,2), l_tax decimal(10,2),
        l_returnflag string, l_linestatus string, l_shipdate date, l_commitdate date, l_receiptdate date,
        l_shipinstruct string, l_shipmode string, l_comment string""",
    "nation": "n_nationkey int, n_name string, n_regionkey int, n_comment string",
    "orders": """o_orderkey int, o_custkey int, o_orderstatus string, o_totalprice decimal(10,2), o_orderdate date,
        o_orderpriority string, o_clerk string, o_shippriority int, o_comment string""",
    "part": """p_partkey int, p_name string, p_mfgr string, p_brand string, p_type string, p_size int,
        p_container string, p_retailprice decimal(10,2), p_comment string""",
    "partsupp": """ps_partkey int, ps_suppkey int, ps_availqty int, ps_supplycost decimal(10,2),
        ps_comment string""",
    "region": "r_regionkey int, r_name string, r_comment string",
    "supplier": """s_suppkey int, s_name string, s_address string, s_nationkey int, s_phone string,
        s_acctbal decimal(10,2), s_comment string""",
}
