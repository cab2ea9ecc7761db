"""Sources as databases give them, and the star as others read it."""

from datetime import datetime, timedelta, timezone

import micro
from pyspark.sql import functions as F

from salesmart.operators.dimensions import changed_since
from salesmart.plans.pipeline import LoadOptions, run_incremental
from salesmart.schema import DIMS, SOURCES, TX_NEW_VERSION, TX_ORIGINAL, TX_REVERSAL
from salesmart.sources.tables import (
    VERSION_BYTES,
    decoded,
    max_versions,
    read_parquet,
    version_bytes,
    version_number,
)
from salesmart.store import Store

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
JULY = datetime(1996, 7, 4)


def at(day):
    return START + timedelta(days=day)


def as_stored(spark, root, **tables):
    """Tables with eight-byte versions and customer keys padded to five characters."""
    source = micro.sources(spark, **tables)
    for name in SOURCES:
        df = source[name]
        if "row_version" in df.columns:
            df = df.withColumn("row_version", F.unhex(F.lpad(F.hex("row_version"), 16, "0")))
        if "customer_id" in df.columns:
            df = df.withColumn("customer_id", F.rpad("customer_id", 5, " "))
        if name == "order_details":
            df = df.drop("line_no")
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    return read_parquet(spark, root, as_stored=True)


def test_binary_versions_keep_their_order(spark):
    numbers = [0, 1, 255, 256, 2001, 2**31, 2**32 + 5, 2**62, 2**63 - 1]
    rows = spark.createDataFrame([(version_bytes(n),) for n in reversed(numbers)], "v binary")
    got = [r.n for r in rows.orderBy("v").select(version_number(F.col("v")).alias("n")).collect()]
    assert got == numbers
    above = rows.filter(F.col("v") > F.lit(version_bytes(256)))
    assert above.count() == sum(n > 256 for n in numbers)


def test_binary_versions_reach_the_scan(spark, root):
    source = as_stored(spark, root, orders=[(1, 1, 1, JULY, 1, "10", 7), (2, 1, 1, JULY, 1, "10", 2**33)])
    changed = changed_since(source.orders, 7, 2**33)
    assert [(r.order_id, r.row_version) for r in changed.collect()] == [(2, 2**33)]
    plan = changed.select("order_id")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThan(row_version" in pushed and "LessThanOrEqual(row_version" in pushed
    highs = {r.source_table: r.max_row_version for r in max_versions(source, {"orders": 7}).collect()}
    assert highs["orders"] == 2**33 and highs["shippers"] == 1


def test_decoding_leaves_declared_types_alone(spark):
    source = micro.sources(spark)
    for name, schema in SOURCES.items():
        same = decoded(source[name], schema)
        assert VERSION_BYTES not in same.columns
        assert [tuple(r) for r in same.collect()] == [tuple(r) for r in source[name].collect()]


def test_a_star_of_text_keys_and_binary_versions(spark, root):
    customers = [("BLAUS", "Blau", None, None, None, None, "Germany", None, 2001), ("AB", "Ab", None, None, None, None, "Peru", None, 2002)]
    orders = [(1, "BLAUS", 1, JULY, 1, "10", 2003), (2, "AB", 1, JULY, 1, "6", 2004), (3, "NOONE", 1, JULY, 1, "6", 2004)]
    lines = [(o, 1, "5", 2, "0", 2005) for o in (1, 2, 3)]
    store = Store.create(spark, f"{root}/star", at(0))
    first = as_stored(spark, f"{root}/one", customers=customers, orders=orders, order_details=lines)
    run_incremental(spark, first, store, at(1))
    named = {r.customer_sk: r.customer_id for r in store.at().dim("dim_customer").collect()}
    assert named == {-1: None, 1: "AB", 2: "BLAUS"}  # numbered by the key's own order, unpadded
    booked = {r.order_id: r.customer_sk for r in store.at().fact().collect()}
    assert booked == {1: 2, 2: 1, 3: -1}
    assert {r.last_row_version for r in store.at().load_control().collect()} == {1, 2002, 2004, 2005}
    renamed = [customers[0], ("AB", "Ab & Co", None, None, None, None, "Peru", None, 2**33)]
    again = [orders[0], (2, "AB", 1, JULY, 1, "8", 2**33 + 1), orders[2]]
    second = as_stored(spark, f"{root}/two", customers=renamed, orders=again, order_details=lines)
    run_incremental(spark, second, store, at(2))
    moved = {r.tx_type: (r.customer_sk, r.quantity) for r in store.at().fact().filter("batch_id = 2").collect()}
    assert moved == {TX_REVERSAL: (1, -2), TX_NEW_VERSION: (3, 2)}
    versions = store.at().dim("dim_customer").filter("customer_id = 'AB'").orderBy("version").collect()
    assert [(r.company_name, r.is_current) for r in versions] == [("Ab", False), ("Ab & Co", True)]


def test_another_session_reads_the_committed_rows_by_sql(spark, root):
    store = Store.create(spark, root, at(0))
    rows = {}
    for day in (1, 2, 3):
        names = [(p, f"Tea {day if p < 3 else 1}", "C1", 1, "10 bags", "5", False, day if p < 3 else 1) for p in range(1, 30)]
        source = micro.sources(spark, products=names, order_details=[(1, 1, "5", day, "0", day)])
        run_incremental(spark, source, store, at(day), LoadOptions(rebase_share=0.2))
        if day < 3:
            assert store.publish("shop") == day
            rows[day] = store.at().fact().collect()
    other = spark.newSession()  # none of this session's temporary views or settings
    assert other.sql("SELECT batch_id FROM shop.published").first()[0] == 2
    # batch 3 is committed, but not published
    got = other.sql("SELECT * FROM shop.fact_sales").collect()
    assert sorted(map(str, got)) == sorted(map(str, rows[2]))
    assert sorted(map(str, other.sql("SELECT * FROM shop.fact_sales_at_1").collect())) == sorted(map(str, rows[1]))
    star = store.at(2).star()
    for dim in DIMS:
        columns = DIMS[dim].fieldNames()
        seen = other.table(f"shop.{dim}").select(*columns).collect()
        assert sorted(map(str, seen)) == sorted(map(str, star.dim(dim).select(*columns).collect()))
    total = other.sql(
        "SELECT product_name, sum(quantity) AS units FROM shop.fact_sales JOIN shop.dim_product USING (product_sk) "
        "JOIN shop.dim_date USING (date_sk) WHERE year = 1996 GROUP BY ALL HAVING units <> 0"
    ).collect()
    assert [tuple(r) for r in total] == [("Tea 2", 2)]
    store.publish("shop")
    store.expire(keep=1)
    store.publish("shop")
    names = {r.viewName for r in other.sql("SHOW VIEWS IN shop").collect()}
    assert "fact_sales_at_3" in names and not any(n.endswith(("_at_1", "_at_2")) for n in names)
    kinds = [r.tx_type for r in other.sql("SELECT tx_type FROM shop.fact_sales ORDER BY fact_id").collect()]
    assert sorted(set(kinds)) == sorted({TX_ORIGINAL, TX_REVERSAL, TX_NEW_VERSION})
    spark.sql("DROP DATABASE shop CASCADE")
