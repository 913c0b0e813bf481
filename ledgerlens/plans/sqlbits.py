"""Reusable DuckDB oracle fragments (CTE bodies). Kept independent of the Spark code paths."""

GEO = "geo AS (SELECT n.n_nationkey, n.n_name, r.r_name, r.r_regionkey FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"

# orders with customer nation and zone
ORD_GEO = (
    GEO
    + """,
og AS (SELECT o.*, g.n_nationkey, g.n_name, g.r_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN geo g ON c.c_nationkey = g.n_nationkey)"""
)

# order revenue per nation and order year
NY = (
    ORD_GEO
    + """,
ny AS (SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) AS revenue, count(*) AS n_orders
       FROM og GROUP BY 1, 2)"""
)

# lineitem revenue by supplier nation
SUPN = (
    GEO
    + """,
supn AS (SELECT g.n_name, sum(l.l_extendedprice) AS out_rev, count(*) AS n_lines
         FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY 1)"""
)


def dec(expr: str, scale: int = 2) -> str:
    return f"CAST({expr} AS DECIMAL(38,{scale}))"
