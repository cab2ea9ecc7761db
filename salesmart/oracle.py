"""The same results as SQL for DuckDB, over the given tables.

Each common table expression is stated once; a query takes those it names, directly or not.
"""

from __future__ import annotations

import re

from salesmart.functions.dates import MONTH_NAMES, WEEKDAY_NAMES
from salesmart.plans.kpis import HIERARCHIES
from salesmart.plans.pipeline import STATUS_OK, STATUS_START, STEP_END, STEP_START
from salesmart.plans.reports import CLASS_A, CLASS_B, CLASS_C
from salesmart.schema import (
    DIM_ATTRS,
    DIM_KEYS,
    DIM_SOURCE,
    TX_DELETION,
    TX_NEW_VERSION,
    TX_ORIGINAL,
    TX_REVERSAL,
)
from salesmart.sources.changes import ChangeRules

# --- numbers ------------------------------------------------------------------------------


def _scaled(x: str) -> str:
    return f"cast(cast({x} as decimal(30,4)) * 10000 as hugeint)"


def _money(x: str) -> str:
    return f"cast({x} as decimal(19,4))"


def _sum(x: str) -> str:
    return f"cast(sum({x}) as decimal(29,4))"


def _div(num: str, den: str, integer: bool = False) -> str:
    """Money cut after four decimals; numerators may be negative, so cut toward zero."""
    if integer:
        return _money(f"cast({_scaled(num)} // ({den}) as decimal(30,0)) * 0.0001")
    return _money(f"cast({_scaled(num)} * 10000 // {_scaled(den)} as decimal(30,0)) * 0.0001")


def _pct(num: str, den: str) -> str:
    q = f"(20000 * {_scaled(num)} + {_scaled(den)}) // (2 * {_scaled(den)})"
    return f"cast(cast({q} as decimal(30,0)) * 0.01 as decimal(5,2))"


def _list(names: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


# --- sources ------------------------------------------------------------------------------

_LINE_AMOUNT = (
    "cast(cast(unit_price as decimal(19,4)) * quantity * "
    "(cast(1 as decimal(5,4)) - discount) as decimal(19,4))"
)

_SOURCE = {
    "src_lines": f"""
        select l_orderkey as order_id, l_partkey as product_id,
          {_div("cast(l_extendedprice as decimal(19,4))", "cast(l_quantity as bigint)", True)}
            as unit_price,
          cast(l_quantity as integer) as quantity,
          cast(l_discount as decimal(5,4)) as discount, cast(1 as bigint) as row_version,
          cast((coalesce(l_suppkey, 0) * 65536 + coalesce(date_diff('day', date '1970-01-01',
            cast(l_shipdate as date)), 0)) * 8 + l_linenumber as bigint) as line_no
        from lineitem""",
    "src_orders": """
        select o_orderkey as order_id, cast(o_custkey as varchar) as customer_id,
          o_orderkey % (select count(*) from nation) as employee_id, o_orderdate as order_date,
          cast(split_part(o_orderpriority, '-', 1) as bigint) as ship_via,
          cast(o_totalprice as decimal(19,4)) as freight, cast(1 as bigint) as row_version
        from orders""",
    "src_products": """
        select p_partkey as product_id, p_name as product_name, p_type as category_id,
          p_partkey % (select count(*) from supplier) as supplier_id,
          cast(p_size as varchar) || ' units' as quantity_per_unit,
          cast(p_retailprice as decimal(19,4)) as unit_price, p_size % 10 = 0 as discontinued,
          cast(1 as bigint) as row_version
        from part""",
    "src_categories": """
        select distinct p_type as category_id, p_type as category_name,
          'Category ' || p_type as description from part""",
    "src_suppliers": """
        select s_suppkey as supplier_id, s_name as company_name, n_name as country
        from supplier left join nation on s_nationkey = n_nationkey""",
    "src_customers": """
        select cast(c_custkey as varchar) as customer_id, c_name as company_name,
          cast(null as varchar) as contact_name, c_mktsegment as contact_title,
          cast(null as varchar) as city, r_name as region, n_name as country,
          cast(null as varchar) as postal_code, cast(1 as bigint) as row_version
        from customer left join nation on c_nationkey = n_nationkey
          left join region on n_regionkey = r_regionkey""",
    "src_employees": """
        select cast(n.n_nationkey as bigint) as employee_id, 'Emp' as first_name,
          n.n_name as last_name, r_name as title, cast(null as varchar) as city,
          n.n_name as country,
          cast(case when h.head <> n.n_nationkey then h.head end as bigint) as reports_to,
          cast(1 as bigint) as row_version
        from nation n left join region on n.n_regionkey = r_regionkey
          join (select n_regionkey, min(n_nationkey) as head from nation group by 1) h
            on h.n_regionkey = n.n_regionkey""",
    "src_shippers": """
        select distinct cast(split_part(o_orderpriority, '-', 1) as bigint) as shipper_id,
          substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) as company_name, cast(null as varchar) as phone,
          cast(1 as bigint) as row_version from orders""",
}

# --- source states ------------------------------------------------------------------------


def _changed(table: str, rule: str, column: str, value: str) -> str:
    return f"""
        select * replace (case when {rule} then {value} else {column} end as {column},
          cast(case when {rule} then 2 else row_version end as bigint) as row_version)
        from {table}"""


def _states(r: ChangeRules) -> dict[str, str]:
    marked = f"""
        select *, {r.late_order} as late, {r.recounted_order} as recounted,
          {r.refreighted_order} as refreighted from src_orders"""
    lines = f"""
        select l.*, ({r.cancelled_line}) as cancelled, o.late, o.recounted
        from src_lines l join marked_orders o on o.order_id = l.order_id"""
    order_columns = "order_id, customer_id, employee_id, order_date, ship_via"
    line_columns = "order_id, product_id, line_no, unit_price"
    second_lines = f"""
        select {line_columns}, quantity + cast(recounted as integer) as quantity, discount,
          cast(case when late or recounted then 2 else 1 end as bigint) as row_version
        from marked_lines where not cancelled"""
    return {
        "marked_orders": marked,
        "marked_lines": lines,
        "s1_orders": f"select {order_columns}, freight, row_version from marked_orders "
        "where not late",
        "s1_lines": f"select {line_columns}, quantity, discount, row_version from marked_lines "
        "where not late",
        "s2_orders": f"""
            select {order_columns},
              cast(freight * (case when refreighted then 2 else 1 end) as decimal(19,4))
                as freight,
              cast(case when late or refreighted then 2 else 1 end as bigint) as row_version
            from marked_orders""",
        "s2_lines": second_lines,
        "s4_lines": f"""
            select {line_columns}, quantity + cast(recounted as integer) as quantity, discount,
              cast(case when cancelled then 3 when late or recounted then 2 else 1 end as bigint)
                as row_version
            from marked_lines""",
        "s2_products": _changed(
            "src_products",
            r.repriced_product,
            "unit_price",
            "cast(unit_price + 10 as decimal(19,4))",
        ),
        "s2_customers": _changed(
            "src_customers", r.renamed_customer, "company_name", "company_name || ' Ltd'"
        ),
        "s2_employees": _changed(
            "src_employees", r.retitled_employee, "title", "'Head ' || title"
        ),
        "s2_shippers": _changed("src_shippers", r.rephoned_shipper, "phone", "'555-0100'"),
    }


# --- dimensions ---------------------------------------------------------------------------


def _members(prefix: str) -> dict[str, str]:
    """Members as state `prefix` (src or s2) has them."""
    p = prefix
    return {
        f"{p}_m_product": f"""
            select p.product_id, p.product_name, c.category_name,
              c.description as category_desc, s.company_name as supplier_name,
              s.country as supplier_country, p.quantity_per_unit, p.unit_price, p.discontinued,
              p.row_version as source_version
            from {p}_products p left join src_categories c on c.category_id = p.category_id
              left join src_suppliers s on s.supplier_id = p.supplier_id""",
        f"{p}_m_customer": f"""
            select customer_id, company_name, contact_name, contact_title, city, region, country,
              postal_code, row_version as source_version from {p}_customers""",
        f"{p}_m_employee": f"""
            select e.employee_id, e.first_name || ' ' || e.last_name as full_name, e.title,
              cast(null as timestamp) as hire_date, e.city, e.country,
              h.first_name || ' ' || h.last_name as supervisor_name,
              e.row_version as source_version
            from {p}_employees e left join {p}_employees h on h.employee_id = e.reports_to""",
        f"{p}_m_shipper": f"""
            select shipper_id, company_name, phone, row_version as source_version
            from {p}_shippers""",
    }


def _dims() -> dict[str, str]:
    """`full_d_*`: after a full refresh or batch 1; `led_d_*`: all versions after batch 2."""
    tables = {}
    for dim, (sk, key) in DIM_KEYS.items():
        name = dim.removeprefix("dim_")
        tables[f"full_d_{name}"] = f"""
            select row_number() over (order by {key}) as {sk}, m.*, 1 as version,
              '2026-01-02' as valid_from, cast(null as varchar) as valid_to, true as is_current
            from src_m_{name} m"""
        tables[f"led_d_{name}"] = f"""
            select f.* replace (case when d.{key} is not null then '2026-01-03' end as valid_to,
                d.{key} is null as is_current)
            from full_d_{name} f
              left join s2_m_{name} d on d.{key} = f.{key} and d.source_version = 2
            union all by name
            select (select count(*) from src_m_{name}) + row_number() over (order by {key})
                as {sk}, m.*, 2 as version, '2026-01-03' as valid_from,
              cast(null as varchar) as valid_to, true as is_current
            from s2_m_{name} m where source_version = 2"""
    return tables


def _date_key(d: str) -> str:
    return f"cast(year({d}) * 10000 + month({d}) * 100 + day({d}) as integer)"


def _calendar() -> str:
    months, weekdays = _list(MONTH_NAMES), _list(WEEKDAY_NAMES)
    parts = {
        "year": "year(d)",
        "quarter": "quarter(d)",
        "month": "month(d)",
        "day": "day(d)",
        "weekday": "dayofweek(d) + 1",
        "week": "(dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) // 7 + 1",
    }
    numbers = ", ".join(f"cast({text} as integer) as {name}" for name, text in parts.items())
    return f"""
        select {_date_key("d")} as date_sk, cast(d as date) as date, {numbers},
          {months}[month(d)] as month_name, {weekdays}[dayofweek(d) + 1] as weekday_name
        from (select unnest(generate_series(
            make_date(year(min(o_orderdate)), 1, 1), make_date(year(max(o_orderdate)), 12, 31),
            interval 1 day)) as d from orders)"""


# --- facts --------------------------------------------------------------------------------


def _ratio(mode: str) -> str:
    if mode == "money":
        share = _money(f"coalesce(o.freight, 0) * {_div('l.sale_amount', 's.subtotal')}")
        return f"case when s.subtotal > 0 then {share} else 0 end"
    share = _money(
        "cast(coalesce(o.freight, 0) as double) * "
        "(cast(l.sale_amount as double) / cast(s.subtotal as double))"
    )
    return f"case when s.subtotal = 0 then 0 else {share} end"


def _drawn(lines: str, orders: str, affected: str | None, mode: str = "float") -> str:
    """Lines of the affected orders with their freight share, natural keys and date key."""
    only = f"where order_id in (select order_id from {affected})" if affected else ""
    return f"""
        with l as (select *, {_LINE_AMOUNT} as sale_amount from {lines} {only}),
          s as (select order_id, sum(sale_amount) as subtotal from l group by 1)
        select l.order_id, l.product_id, l.line_no, o.customer_id, o.employee_id, o.ship_via as shipper_id,
          {_date_key("o.order_date")} as date_sk,
          l.unit_price, l.quantity, l.discount, l.sale_amount,
          cast({_ratio(mode)} as decimal(19,4)) as freight_alloc
        from l join {orders} o on o.order_id = l.order_id join s on s.order_id = l.order_id"""


def _keyed(drawn: str, dims: str, drop: bool = False) -> str:
    joins, keys = "", []
    for dim, (sk, key) in DIM_KEYS.items():
        name = dim.removeprefix("dim_")
        kind = "join" if drop else "left join"
        joins += (
            f" {kind} {dims}_d_{name} {name} on {name}.{key} = x.{key} and {name}.is_current"
        )
        keys.append(f"{name}.{sk}" if drop else f"coalesce({name}.{sk}, -1) as {sk}")
    if drop:
        joins += " join cal on cal.date_sk = x.date_sk"
    return f"""
        select {", ".join(keys)}, x.date_sk, x.order_id, x.product_id, x.line_no, x.unit_price, x.quantity,
          x.discount, x.sale_amount, x.freight_alloc
        from {drawn} x{joins}"""


_POSITION = (
    "order_id, product_id, line_no, product_sk, customer_sk, employee_sk, date_sk, shipper_sk, "
    "unit_price, discount"
)
_ENTRY = (
    "product_sk, customer_sk, employee_sk, date_sk, shipper_sk, order_id, product_id, line_no, "
    "unit_price, quantity, discount, sale_amount, freight_alloc, tx_type"
)


def _open(rows: str) -> str:
    return f"""
        select {_POSITION}, cast(sum(quantity) as bigint) as quantity,
          {_sum("sale_amount")} as sale_amount, {_sum("freight_alloc")} as freight_alloc
        from {rows} group by {_POSITION} having sum(quantity) > 0"""


def _reversal(rows: str, tx_type: str, batch: int) -> str:
    return f"""
        select product_sk, customer_sk, employee_sk, date_sk, shipper_sk, order_id, product_id,
          line_no, unit_price, cast(-quantity as integer) as quantity, discount,
          cast(-sale_amount as decimal(19,4)) as sale_amount,
          cast(-freight_alloc as decimal(19,4)) as freight_alloc, '{tx_type}' as tx_type,
          cast({batch} as bigint) as batch_id
        from {rows}"""


def _ledger() -> dict[str, str]:
    tables = {
        "full_drawn": _drawn("src_lines", "src_orders", None),
        "full_drawn_money": _drawn("src_lines", "src_orders", None, "money"),
        "full_rows": _keyed("full_drawn", "full", drop=True),
        "full_rows_money": _keyed("full_drawn_money", "full", drop=True),
        "full_fact": f"select *, '{TX_ORIGINAL}' as tx_type from full_rows",
        "drawn1": _drawn("s1_lines", "s1_orders", None),
        "fresh1": _keyed("drawn1", "full"),
        "led1": f"select *, '{TX_ORIGINAL}' as tx_type, cast(1 as bigint) as batch_id from fresh1",
        "affected2": """
            select order_id from s2_orders where row_version > 1
            union select order_id from s2_lines where row_version > 1""",
        "affected3": "select distinct order_id from s4_lines where row_version > 2",
    }
    for batch, lines in ((2, "s2_lines"), (3, "s4_lines")):
        old = f"led{batch - 1}"
        tables[f"drawn{batch}"] = _drawn(lines, "s2_orders", f"affected{batch}")
        tables[f"fresh{batch}"] = _keyed(f"drawn{batch}", "led")
        tables[f"balance{batch}"] = f"""
            select * from ({_open(old)}) b where exists (select 1 from fresh{batch} f
              where f.order_id = b.order_id and f.product_id = b.product_id and f.line_no = b.line_no)"""
        tables[f"upsert{batch}"] = f"""
            {_reversal(f"balance{batch}", TX_REVERSAL, batch)}
            union all by name
            select f.*, case when exists (select 1 from balance{batch} b
                where b.order_id = f.order_id and b.product_id = f.product_id
                  and b.line_no = f.line_no)
                then '{TX_NEW_VERSION}' else '{TX_ORIGINAL}' end as tx_type,
              cast({batch} as bigint) as batch_id
            from fresh{batch} f"""
        tables[f"booked{batch}"] = (
            f"select * from {old} union all by name select * from upsert{batch}"
        )
        tables[f"gone{batch}"] = f"""
            select * from ({_open(f"booked{batch}")}) b where not exists (select 1 from {lines} l
              where l.order_id = b.order_id and l.product_id = b.product_id
                and l.line_no = b.line_no)"""
        tables[f"deleted{batch}"] = _reversal(f"gone{batch}", TX_DELETION, batch)
        tables[f"led{batch}"] = (
            f"select * from booked{batch} union all by name select * from deleted{batch}"
        )
    return tables


# --- reports ------------------------------------------------------------------------------


def _reports(fact: str, d: str) -> dict[str, str]:
    product, customer = f"{d}_d_product", f"{d}_d_customer"
    employee, shipper = f"{d}_d_employee", f"{d}_d_shipper"
    with_product = f"{fact} f join {product} p on p.product_sk = f.product_sk"
    with_date = f"{fact} f join cal t on t.date_sk = f.date_sk"
    with_customer = f"{fact} f join {customer} c on c.customer_sk = f.customer_sk"
    orders = "count(distinct order_id)"
    sales, freight = _sum("sale_amount"), _sum("freight_alloc")
    units = "cast(sum(quantity) as bigint)"
    avg_discount = "cast(sum(discount) as double) / count(*) * 100 as avg_discount_pct"
    previous = "lag(sales) over (order by year, month)"
    gross = "sum(cast(f.unit_price as decimal(19,4)) * quantity)"
    return {
        "q01_sales_by_quarter": f"""
            select year, quarter, {orders} as orders, {units} as units, {sales} as sales,
              {freight} as freight from {with_date} group by year, quarter""",
        "q02_top_products": f"""
            select product_name, category_name, {units} as units, {sales} as sales,
              {avg_discount} from {with_product} group by product_name, category_name
            order by sales desc, product_name, category_name limit 10""",
        "q03_category_share": f"""
            select *, {_pct("sales", "(sum(sales) over ())")} as pct from (
              select category_name, {orders} as orders, {units} as units, {sales} as sales
              from {with_product} group by category_name)""",
        "q04_employee_rank": f"""
            select *, cast(rank() over (order by sales desc) as integer) as ranking from (
              select full_name, title, supervisor_name, {orders} as orders, {sales} as sales
              from {fact} f join {employee} e on e.employee_sk = f.employee_sk
              group by full_name, title, supervisor_name)""",
        "q05_country_sales": f"""
            select *, {_div("sales", "orders", True)} as ticket from (
              select country, count(distinct c.customer_sk) as customers, {orders} as orders,
                {sales} as sales from {with_customer} group by country)""",
        "q06_shipper_freight": f"""
            select *, {_div("freight", "shipments", True)} as freight_per_order from (
              select company_name as shipper, {orders} as shipments, {freight} as freight
              from {fact} f join {shipper} s on s.shipper_sk = f.shipper_sk
              group by company_name)""",
        "q07_monthly_variation": f"""
            select *, case when prev_sales > 0 then cast(
                {_div("sales - prev_sales", "prev_sales")} * 100 as decimal(8,2)) end
                as variation_pct
            from (select *, {previous} as prev_sales from (
              select year, month, month_name, {sales} as sales from {with_date}
              group by year, month, month_name))""",
        "q08_discounts": f"""
            select category_name, lines, discounted,
              {_pct("discounted", "lines")} as discounted_pct, avg_discount_pct, discount_amount
            from (select category_name, count(*) as lines,
                count(*) filter (where discount > 0) as discounted, {avg_discount},
                cast({gross} - sum(sale_amount) as decimal(29,4)) as discount_amount
              from {with_product} group by category_name)""",
        "q09_top_customers": f"""
            select * from (
              select *, cast(row_number() over (partition by country
                  order by sales desc, company_name) as integer) as rank_in_country
              from (select country, company_name, {sales} as sales from {with_customer}
                group by country, company_name))
            where rank_in_country <= 5""",
        "q10_pareto_abc": f"""
            select product_name, sales,
              cast({_div("sales", "total")} * 100 as decimal(5,2)) as pct,
              cast({_div("cum", "total")} * 100 as decimal(5,2)) as cum_pct,
              case when {_div("cum", "total")} <= 0.80 then '{CLASS_A}'
                when {_div("cum", "total")} <= 0.95 then '{CLASS_B}' else '{CLASS_C}' end
                as abc_class
            from (select *, sum(sales) over (order by sales desc) as cum,
                sum(sales) over () as total from (
              select product_name, {sales} as sales from {with_product} group by 1))""",
        "q11_suppliers": f"""
            select supplier_name, supplier_country, count(distinct p.product_sk) as products,
              {units} as units, {sales} as sales from {with_product}
            group by supplier_name, supplier_country""",
        "q12_weekday": f"""
            select *, {_div("sales", "orders", True)} as ticket from (
              select weekday, weekday_name, {orders} as orders, {sales} as sales
              from {with_date} group by weekday, weekday_name)""",
        "q13_summary": f"""
            select (select count(*) from {product}) as products,
              (select count(*) from {customer}) as customers,
              (select count(*) from {employee}) as employees,
              (select count(*) from {shipper}) as shippers,
              (select count(*) from cal) as days, count(*) as lines, {orders} as orders,
              {sales} as sales, {freight} as freight from {fact}""",
    }


def _kpi_columns() -> str:
    ticket = _div(_sum("sale_amount"), "count(distinct order_id)", True)
    return f"""{_sum("sale_amount")} as sales, cast(sum(quantity) as bigint) as units,
        {_sum("freight_alloc")} as freight,
        cast(sum(discount) as double) / count(*) * 100 as avg_discount_pct, {ticket} as ticket"""


def _rollup(dim: str, *path: str) -> str:
    sk, table = f"{dim}_sk", "cal" if dim == "date" else f"full_d_{dim}"
    columns = ", ".join(f"d.{c}" for c in path)
    return f"""
        select {columns}, cast(grouping_id({columns}) as bigint) as level, {_kpi_columns()}
        from full_fact f join {table} d on d.{sk} = f.{sk} group by rollup ({columns})"""


def _queries() -> dict[str, str]:
    queries = {
        **_reports("full_fact", "full"),
        **{f"{name}_ledger": sql for name, sql in _reports("led2", "led").items()},
        "kpi_global": f"select {_kpi_columns()} from full_fact",
        "kpi_by_category": f"""
            select category_name, {_kpi_columns()} from full_fact f
            join full_d_product p on p.product_sk = f.product_sk group by category_name""",
        **{name: _rollup(*path) for name, path in HIERARCHIES.items()},
        "dim_date": "select * from cal",
        "date_key_style112": f"""
            select order_id, {_date_key("order_date")} as date_sk,
              cast(strftime(order_date, '%Y%m%d') as integer) as date_sk_style112
            from src_orders""",
        "max_row_versions": _marks("max_row_version"),
        "control_after_batch": _marks("last_row_version"),
        "snapshot_change_stamp": """
            select n.order_id, n.product_id, n.line_no,
              cast(case when o.order_id is not null and o.unit_price = n.unit_price
                  and o.quantity = n.quantity and o.discount = n.discount
                then o.row_version else 2 end as bigint) as row_version
            from s2_lines n
              left join s1_lines o on o.order_id = n.order_id
                and o.product_id = n.product_id and o.line_no = n.line_no""",
        "surrogate_keys": """
            select order_id, row_number() over (order by order_id) as order_sk
            from src_orders""",
        "next_versions": """
            select m.product_id, cast(coalesce((select max(d.version) from led_d_product d
                where d.product_id = m.product_id), 0) + 1 as integer) as version
            from s2_m_product m where m.source_version > 1""",
        "affected_orders": "select order_id from affected2",
        "order_subtotals": f"""
            select order_id, {_sum("sale_amount")} as subtotal from drawn2 group by 1""",
        "fresh_lines": "select * from drawn2",
        "freight_proration": "select order_id, product_id, line_no, sale_amount, freight_alloc "
        "from full_drawn",
        "fact_sk_lookup": "select * from fresh2",
        "existing_balances": "select * from balance2",
        "new_lines": """
            select order_id, product_id, line_no, quantity from drawn2 f where not exists (
              select 1 from balance2 b
              where b.order_id = f.order_id and b.product_id = f.product_id
                  and b.line_no = f.line_no)""",
        "incremental_ledger": f"select {_ENTRY}, batch_id from led2",
        "incremental_ledger_restored": f"select {_ENTRY}, batch_id from led3",
        "incremental_noop": f"""
            select (select count(*) from (
                select order_id from s2_orders
                where row_version > (select max(row_version) from s2_orders)
                union select order_id from s2_lines
                where row_version > (select max(row_version) from s2_lines)))
                as affected_orders,
              (select count(*) from ({_open("led2")}) b where not exists (
                select 1 from s2_lines l
                where l.order_id = b.order_id and l.product_id = b.product_id
                and l.line_no = b.line_no))
                as deleted_lines""",
        "reconcile_deletes": f"select {_ENTRY} from deleted2",
        "net_positions": f"""
            select order_id, product_id, line_no, cast(sum(quantity) as bigint) as quantity,
              {_sum("sale_amount")} as sale_amount, {_sum("freight_alloc")} as freight_alloc
            from led2 group by 1, 2, 3 having sum(quantity) <> 0""",
        "kept_balances": f"""
            select order_id, product_id, line_no, cast(sum(quantity) as bigint) as quantity,
              {_sum("sale_amount")} as sale_amount, {_sum("freight_alloc")} as freight_alloc
            from led2 group by 1, 2, 3 having sum(quantity) <> 0""",
        "order_digests": "select order_id, count(*) as n from s2_lines group by 1",
        "changed_line_sets": """
            select coalesce(a.order_id, b.order_id) as order_id,
              coalesce(b.n, 0) - coalesce(a.n, 0) as more, coalesce(a.n, 0) as were
            from (select order_id, count(*) as n, list(distinct (product_id, line_no)
                order by (product_id, line_no)) as own from s1_lines group by 1) a
              full join (select order_id, count(*) as n, list(distinct (product_id, line_no)
                order by (product_id, line_no)) as own from s2_lines group by 1) b
              on a.order_id = b.order_id
            where a.own is distinct from b.own""",
        # every line of state 1 has its members and its day: a refresh books what a first load does
        "refresh_then_incremental": f"select {_ENTRY}, batch_id from led2",
        "ledger_by_notices": f"""
            select {_ENTRY}, cast(case when tx_type = '{TX_DELETION}'
                and order_id not in (select order_id from affected2) then 3 else batch_id end
              as bigint) as batch_id from led2""",
        "check_line_keys": """
            select count(*) as lines, count(distinct (order_id, product_id, line_no)) as keys
            from src_lines""",
        "full_fact": f"select {_ENTRY} from full_fact",
        "full_fact_money_ratio": "select * from full_rows_money",
        "check_row_counts": """
            select *, source_rows = fact_rows as equal from (
              select (select count(*) from lineitem) as source_rows,
                (select count(*) from full_fact) as fact_rows)""",
        "check_freight": f"""
            select *, cast(freight - allocated as decimal(29,4)) as difference from (
              select f.order_id, o.freight, {_sum("f.freight_alloc")} as allocated
              from full_fact f join src_orders o on o.order_id = f.order_id
              group by f.order_id, o.freight)
            order by abs(difference) desc, order_id limit 5""",
        "check_calendar": """
            select *, (select count(*) from cal) as days from cal order by date_sk limit 5""",
        "check_fk": " union all ".join(_orphans(dim) for dim in (*DIM_KEYS, "dim_date")),
        "check_keys": " union all ".join(
            [_key_report(dim) for dim in (*DIM_KEYS, "dim_date")]
            + ["select 'fact_sales', count(*), 0, 0 from led2"]
        ),
    }
    queries["full_refresh_log"] = _full_refresh_log()
    queries["stream_equals_batch"] = _both_ledgers()
    queries["pareto_scalable"] = queries["q10_pareto_abc"]
    for dim, (sk, key) in DIM_KEYS.items():
        name = dim.removeprefix("dim_")
        attrs = ", ".join(c for c, _ in DIM_ATTRS[dim] if c != "hire_date")
        all_attrs = ", ".join(c for c, _ in DIM_ATTRS[dim])
        row = f"{sk}, {key}, {attrs}, version, valid_from, valid_to, is_current, source_version"
        queries[f"delta_{DIM_SOURCE[dim]}"] = (
            f"select {key}, {all_attrs}, source_version from s2_m_{name} where source_version > 1"
        )
        queries[f"scd2_{name}"] = f"select {row} from led_d_{name}"
        queries[f"full_{dim}"] = f"select {row} from full_d_{name}"
    return queries


def _full_refresh_log() -> str:
    """What one full refresh logs, newest first in Spark; the order does not matter here."""
    counts = {
        "dim_product": "full_d_product",
        "dim_customer": "full_d_customer",
        "dim_employee": "full_d_employee",
        "dim_shipper": "full_d_shipper",
        "fact_sales": "full_fact",
    }
    steps = [
        f"""
        select cast({place} as bigint) as log_id, '{step}' as step, n as rows_affected,
          '{STATUS_OK}' as status, '{step}: ' || n || ' rows loaded' as message
        from (select count(*) as n from {table})"""
        for place, (step, table) in enumerate(counts.items(), 2)
    ]
    none = "cast(null as bigint)"
    ends = [
        f"select 1, '{STEP_START}', {none}, '{STATUS_START}', 'load started'",
        f"select 7, '{STEP_END}', {none}, '{STATUS_OK}', 'load finished'",
    ]
    return " union all ".join([*steps, *ends])


def _both_ledgers() -> str:
    """The ledger of two batches summed once for the streamed and once for the batch load."""
    measures = ", ".join(
        f"count(*) as rows_{s}, cast(sum(quantity) as bigint) as units_{s}, "
        f"{_sum('sale_amount')} as sales_{s}, {_sum('freight_alloc')} as freight_{s}"
        for s in ("stream", "batch")
    )
    return f"select batch_id, tx_type, {measures} from led2 group by batch_id, tx_type"


def _marks(column: str) -> str:
    tables = {
        "products": "s2_products",
        "customers": "s2_customers",
        "employees": "s2_employees",
        "shippers": "s2_shippers",
        "orders": "s2_orders",
        "order_details": "s2_lines",
    }
    return " union all ".join(
        f"select '{name}' as source_table, coalesce(max(row_version), 0) as {column} from {table}"
        for name, table in tables.items()
    )


def _dim_table(dim: str) -> tuple[str, str]:
    if dim == "dim_date":
        return "cal", "date_sk"
    return f"led_d_{dim.removeprefix('dim_')}", DIM_KEYS[dim][0]


def _orphans(dim: str) -> str:
    table, sk = _dim_table(dim)
    return f"""
        select '{dim}' as dimension, count(*) as orphan_rows,
          count(distinct {sk}) as orphan_keys
        from led2 where {sk} not in (select {sk} from {table})"""


def _key_report(dim: str) -> str:
    table, sk = _dim_table(dim)
    return f"""
        select '{dim}' as table_name, cast(sum(n) as bigint) as rows,
          cast(coalesce(sum(n) filter (where {sk} is null), 0) as bigint) as null_keys,
          count(*) filter (where n > 1 and {sk} is not null) as repeated_keys
        from (select {sk}, count(*) as n from {table} group by 1)"""


def oracle_sql(rules: ChangeRules = ChangeRules()) -> dict[str, str]:
    tables = {
        **_SOURCE,
        **_states(rules),
        **_members("src"),
        **_members("s2"),
        **_dims(),
        "cal": _calendar(),
        **_ledger(),
    }
    return {name: _with_tables(sql, tables) for name, sql in _queries().items()}


def _with_tables(sql: str, tables: dict[str, str]) -> str:
    """Put the table expressions that a query needs in front of it, in order of definition."""
    needed, open_texts = set(), [sql]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        for name in words & tables.keys() - needed:
            needed.add(name)
            open_texts.append(tables[name])
    parts = [f"{name} as ({text})" for name, text in tables.items() if name in needed]
    return f"with {', '.join(parts)} {sql}" if parts else sql
