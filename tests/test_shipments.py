"""Shipment reports: text and Parquet forms agree, edge rules, plans."""

import datetime as dt
import random

import pytest
from conftest import plan, rows

from brindle.plans import shipments as sh
from brindle.sources import readers, schemas

DAY = "1996-01-01"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """All tables as '|'-delimited text with a trailing delimiter; one order has a third of the items."""
    rng = random.Random(8)
    days = [(dt.date(1995, 12, 30) + dt.timedelta(days=i)).isoformat() for i in range(5)]
    tables = {
        "nation": [(i, n, 0, "c") for i, n in enumerate(["CANADA", "united states ", "FRANCE"])],
        "region": [(0, "AMERICA", "c")],
        "customer": [(i, f"Customer#{i}", "a", i % 3, "p", "1.50", "m", "c") for i in range(9)],
        "supplier": [(i, f"Supplier#{i}", "a", 0, "p", "0.00", "c") for i in range(4)],
        "part": [(i, f"part {i}", "m", "b", "t", 1, "x", "9.99", "c") for i in range(6)],
        "partsupp": [(1, 1, 5, "2.00", "c")],
        "orders": [
            (o, rng.randrange(11), "O", "1.00", rng.choice(days), "1-URGENT", f"Clerk#{o % 7}", 0, "c") for o in range(40)
        ],
        "lineitem": [
            (7 if i % 3 == 0 else rng.randrange(45), rng.randrange(7), rng.randrange(5), i, rng.randrange(1, 50),
             f"{rng.randrange(100, 99999) / 100:.2f}", f"0.0{rng.randrange(10)}", f"0.0{rng.randrange(9)}",
             rng.choice("ANR"), rng.choice("OF"), rng.choice(days), days[0], days[0], "i", "m", "c")
            for i in range(300)
        ],
    }
    base = tmp_path_factory.mktemp("text")
    for name, data in tables.items():
        (base / f"{name}.tbl").write_text("".join("|".join(map(str, r)) + "|\n" for r in data))
    return base


@pytest.fixture(scope="module")
def text(spark, folder):
    return {name: readers.pipe_table(spark, str(folder / f"{name}.tbl"), name, trailing=True) for name in schemas.TABLES}


@pytest.fixture(scope="module")
def parquet(spark, text, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("parquet"))
    for name, df in text.items():
        df.write.parquet(f"{base}/{name}.parquet")
    return {name: readers.parquet_table(spark, base, name) for name in text}


def reports(t, spark):
    return {
        "count": sh.shipped_count(t["lineitem"], DAY),
        "clerks": sh.clerk_orders(t["lineitem"], t["orders"], DAY),
        "parts": sh.part_supplier(t["lineitem"], t["part"], t["supplier"], DAY),
        "nations": sh.nation_shipments(t["lineitem"], t["orders"], t["customer"], t["nation"], DAY),
        "months": sh.monthly_shipments(
            t["lineitem"], t["orders"], t["customer"], t["nation"], ["canada", "UNITED STATES"]
        ),
        "pricing": sh.pricing_summary(t["lineitem"], DAY),
        "unshipped": sh.top_unshipped(t["lineitem"], t["orders"], t["customer"], DAY),
    }


def test_text_and_parquet_agree(spark, text, parquet):
    for (name, a), (_, b) in zip(reports(text, spark).items(), reports(parquet, spark).items()):
        assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()] or name == "pricing", name
        assert rows(a) == rows(b), name


def test_all_tables_parse(text):
    assert {name: df.count() for name, df in text.items()}["orders"] == 40
    assert not any(
        r[c] is None for name, df in text.items() for r in df.collect() for c in df.columns
    )


def test_reports_against_loops(spark, text):
    data = {name: df.collect() for name, df in text.items()}
    orders = {o.o_orderkey: o for o in data["orders"]}
    customers = {c.c_custkey: c for c in data["customer"]}
    nations = {n.n_nationkey: n.n_name for n in data["nation"]}
    day = dt.date.fromisoformat(DAY)
    shipped = [li for li in data["lineitem"] if li.l_shipdate == day]
    got = {name: [tuple(r) for r in df.collect()] for name, df in reports(text, spark).items()}
    assert got["count"] == [(len(shipped),)]
    clerks = sorted((li.l_orderkey, orders[li.l_orderkey].o_clerk) for li in shipped if li.l_orderkey in orders)
    assert got["clerks"] == [(c, k) for k, c in clerks][:20]

    def nation(order_key):
        order = orders.get(order_key)
        return customers[order.o_custkey].c_nationkey if order and order.o_custkey in customers else None

    counts = {}
    for li in shipped:
        if nation(li.l_orderkey) is not None:
            key = nation(li.l_orderkey)
            counts[key] = counts.get(key, 0) + 1
    assert got["nations"] == [(k, nations[k], n) for k, n in sorted(counts.items())]
    months = {}
    for li in data["lineitem"]:
        key = nation(li.l_orderkey)
        if key in (0, 1):
            month = (key, ["CANADA", "UNITED STATES"][key], li.l_shipdate.isoformat()[:7])
            months[month] = months.get(month, 0) + 1
    assert got["months"] == [(*k, n) for k, n in sorted(months.items())]
    revenue = {}
    for li in data["lineitem"]:
        order = orders.get(li.l_orderkey)
        if order and order.o_orderdate < day < li.l_shipdate and order.o_custkey in customers:
            key = (customers[order.o_custkey].c_name, li.l_orderkey, order.o_orderdate.isoformat(), order.o_shippriority)
            revenue[key] = revenue.get(key, 0) + li.l_extendedprice * (1 - li.l_discount)
    best = sorted(revenue.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert got["unshipped"] == [(k[0], k[1], round(float(v), 4), k[2], k[3]) for k, v in best]


def test_sql_text_equals_reports(spark, parquet):
    tables = {n: parquet[n] for n in ("lineitem", "orders", "customer", "nation")}
    expected = reports(parquet, spark)
    nations = sh.run_sql(spark, sh.NATION_SQL, tables, day=DAY)
    assert rows(nations) == rows(expected["nations"])
    clerks = sh.run_sql(spark, sh.CLERK_SQL.replace("{clerk}", "o_clerk"), {n: tables[n] for n in ("lineitem", "orders")}, day=DAY)
    assert rows(clerks, "o_clerk", "o_orderkey") == rows(expected["clerks"])
    pricing = sh.run_sql(spark, sh.PRICING_SQL, {"lineitem": tables["lineitem"]}, day=DAY)
    assert rows(pricing) == rows(expected["pricing"].select(*pricing.columns))


def test_timestamps_without_zone_are_compared_as_days(spark):
    items = spark.sql("SELECT timestamp_ntz'1996-01-01 23:59:59' AS l_shipdate UNION ALL SELECT timestamp_ntz'1996-01-02 00:00:00'")
    assert sh.shipped_count(items, DAY).first()[0] == 1


def test_filters_and_columns_reach_the_scan(spark, parquet):
    text = plan(sh.pricing_summary(parquet["lineitem"], DAY))
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01)" in text and "l_comment" not in text and "l_orderkey" not in text
    text = plan(sh.top_unshipped(parquet["lineitem"], parquet["orders"], parquet["customer"], DAY))
    assert "LessThan(o_orderdate,1996-01-01)" in text and "TakeOrderedAndProject" in text
