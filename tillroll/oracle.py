"""Independent SQL for every catalogue query, for DuckDB over the same tables.

Written from the meaning of each query, not from its Spark plan: ranks and row
numbers are plain windows, rounding is integer arithmetic.
"""

from __future__ import annotations

from .schemas import MISSING_TOKENS, READER_NA_TOKENS

# --- clean lines over the mapped tables -------------------------------------------------

_LOCATIONS = """
locations as (
    select n_nationkey as location_id, r_name as country, r_name as region, n_name as state,
           case when n_nationkey % 3 <> 0 then 'City_' || n_nationkey end as city,
           case when n_nationkey % 4 <> 0
                then lpad(cast(n_nationkey * 137 as varchar), 5, '0') end as postal_code
    from nation join region on r_regionkey = n_regionkey
)"""

_LINES = f"""
with {_LOCATIONS},
priced as (
    select *, cast(cast(l_discount as decimal(5,4)) * 4 as decimal(5,4)) as discount,
           cast(l_extendedprice as decimal(12,2)) as list_total
    from lineitem
),
costed as (
    select *, cast(cast(p_retailprice as decimal(12,2)) * cast(1.75 as decimal(3,2))
                   as decimal(12,2)) as cost
    from part
),
lines as (
    select cast(l_orderkey as varchar) as order_id, cast(o_orderdate as date) as order_date,
           cast(l_shipdate as date) as ship_date, cast(c_custkey as varchar) as customer_id,
           c_name as customer_name, cast(p_partkey as varchar) as product_id,
           p_name as product_name, p_type as category, p_brand as sub_category,
           region, state, discount, cast(l_quantity as int) as quantity,
           cast(list_total * (1 - discount) as decimal(12,2)) as sales,
           cast(cast(list_total * (1 - discount) as decimal(12,2))
                - cast(cost * cast(l_quantity as decimal(4,0)) as decimal(12,2))
                as decimal(12,2)) as profit
    from priced
    join orders on o_orderkey = l_orderkey
    join customer on c_custkey = o_custkey
    join locations on location_id = c_nationkey
    join costed on p_partkey = l_partkey
)
"""


def _half_up(part: str, part_scale: int, whole: str, whole_scale: int, digits: int) -> str:
    """part/whole of two decimals rounded half away from zero, in whole numbers."""
    p = f"cast(({part}) * {10**part_scale} as hugeint)"
    w = f"cast(({whole}) * {10**whole_scale} as hugeint)"
    up = 10 ** max(digits + whole_scale - part_scale, 0)
    down = 10 ** max(part_scale - whole_scale - digits, 0)
    size = f"((2 * {up} * abs({p}) + {down} * abs({w})) // (2 * {down} * nullif(abs({w}), 0)))"
    return f"(sign({p}) * sign({w}) * {size} / {10**digits}.0::double)"


def _pct(part: str, whole: str) -> str:
    return _half_up(f"100 * ({part})", 2, whole, 2, 2)


def _total(expr: str, name: str) -> str:
    return f"cast({expr} as decimal(22,2)) as {name}"


_MONEY = f"{_total('sum(sales)', 'total_sales')}, {_total('sum(profit)', 'total_profit')}"
_MONTH = "strftime(order_date, '%Y-%m')"
_REPORT_BAND = """case when discount = 0 then '0%' when discount <= 0.10 then '1-10%'
    when discount <= 0.20 then '11-20%' when discount <= 0.30 then '21-30%' else '30%+' end"""

_BANDS = f"""
select {_REPORT_BAND} as discount_band, count(*) as order_lines, {_MONEY},
       {_pct('sum(profit)', 'sum(sales)')} as margin_pct
from lines where discount is not null group by 1
"""

_PRODUCTS = """
products as (
    select product_id, product_name, category, sum(sales) as s, sum(profit) as p,
           sum(quantity) as u
    from lines group by 1, 2, 3
)"""

_DECILES = """
customers as (select customer_id, sum(sales) as s from lines group by 1),
tiles as (
    select *, ntile(10) over (order by s desc nulls last, customer_id nulls last) as t
    from customers
)"""

_CELLS = f"""
, {_DECILES},
banded as (
    select *, case when d <= -0.01 then null when d <= 0 then '0%' when d <= 0.10 then '1-10%'
                   when d <= 0.20 then '11-20%' when d <= 0.30 then '21-30%'
                   when d <= 1 then '30%+' end as discount_band
    from (select *, coalesce(discount, 0) as d from lines)
),
cells as (
    select order_date, region, category, discount_band, cast(t as int) as spend_decile,
           {_total('sum(sales)', 'sales')}, {_total('sum(profit)', 'profit')},
           count(*) as order_lines
    from banded left join tiles using (customer_id) group by 1, 2, 3, 4, 5
)"""


def _visual(name: str, label: str) -> str:
    return f"""
        select '{name}' as visual, {label} as label, cast(sum(order_lines) as bigint) as order_lines,
               {_total('coalesce(sum(sales), 0)', 'sales')},
               {_total('coalesce(sum(profit), 0)', 'profit')},
               cast(sum(profit) as double) / nullif(cast(sum(sales) as double), 0) * 100 as margin_pct
        from chosen group by 1, 2"""


_VISUALS = {
    "month": _MONTH,
    "region": "region",
    "category": "category",
    "discount_band": "discount_band",
    "spend_decile": "cast(spend_decile as varchar)",
}

_OVER_LINES = {
    "monthly_sales_summary": f"""
        select {_MONTH} as order_month, region, category, count(distinct order_id) as orders,
               cast(sum(quantity) as bigint) as units_sold, {_MONEY},
               {_half_up('sum(discount)', 4, 'count(discount)', 0, 4)} as avg_discount
        from lines group by 1, 2, 3""",
    "regional_running_sales": f"""
        , monthly as (
            select region, {_MONTH} as order_month, sum(sales) as s, sum(profit) as p
            from lines group by 1, 2
        )
        select region, order_month, {_total('s', 'monthly_sales')},
               {_total('''sum(s) over (partition by region order by order_month
                          rows between unbounded preceding and current row)''', 'running_sales')},
               {_total('p', 'monthly_profit')}
        from monthly""",
    "top_products_by_category": f"""
        , {_PRODUCTS},
        ranked as (
            select *, dense_rank() over (partition by category order by s desc) as r from products
        )
        select category, cast(r as int) as revenue_rank, product_name,
               {_total('s', 'total_sales')}, {_total('p', 'total_profit')},
               cast(u as bigint) as units_sold
        from ranked where r <= 5""",
    "mom_growth": f"""
        , monthly as (
            select category, {_MONTH} as order_month, sum(sales) as s from lines group by 1, 2
        ),
        paired as (
            select *, lag(s) over (partition by category order by order_month) as b from monthly
        )
        select category, order_month, {_total('s', 'monthly_sales')},
               {_total('b', 'prev_month_sales')}, {_pct('s - b', 'b')} as mom_growth_pct
        from paired""",
    "discount_margin": f"""
        select {_REPORT_BAND} as discount_band, count(*) as order_lines,
               count(distinct order_id) as orders, {_MONEY},
               {_pct('sum(profit)', 'sum(sales)')} as profit_margin_pct
        from lines where discount is not null group by 1""",
    "customer_deciles": f"""
        , {_DECILES},
        grouped as (
            select cast(t as int) as spend_decile, count(*) as customers, sum(s) as d
            from tiles group by 1
        )
        select spend_decile, customers, {_total('d', 'decile_sales')},
               {_half_up('d', 2, 'customers', 0, 2)} as avg_customer_value,
               {_pct('d', 'sum(d) over ()')} as pct_of_total_sales
        from grouped""",
    "loss_making_subcategories": f"""
        select region, sub_category, {_MONEY},
               {_pct('sum(profit)', 'sum(sales)')} as margin_pct,
               {_half_up('sum(discount)', 4, 'count(discount)', 0, 3)} as avg_discount
        from lines group by 1, 2 having sum(profit) < 0""",
    "scale_counts": """
        select (select count(*) from lines) as order_lines,
               (select count(distinct order_id) from lines) as orders,
               (select count(*) from customer) as customers,
               (select count(*) from part) as products,
               (select count(*) from nation) as locations""",
    "date_span": """
        select min(order_date) as first_order, max(order_date) as last_order from lines""",
    "discount_bands": _BANDS,
    "margin_gap": f"""
        , bands as ({_BANDS}),
        gap as (
            select avg(margin_pct) filter (discount_band in ('0%', '1-10%')) as low,
                   avg(margin_pct) filter (discount_band in ('21-30%', '30%+')) as high
            from bands
        )
        select low, high, low - high as difference from gap""",
    "busy_locations": """
        select cast(c_nationkey as bigint) as location_id, count(*) as rows
        from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
        group by 1 having 25 * count(*) > (
            select count(*) from lineitem join orders on o_orderkey = l_orderkey
            join customer on c_custkey = o_custkey)""",
    "top_regions": f"""
        select region, {_MONEY}, {_pct('sum(profit)', 'sum(sales)')} as margin_pct
        from lines group by 1""",
    "top_losses": f"""
        select region, sub_category, {_MONEY} from lines group by 1, 2
        having sum(profit) < 0 order by sum(profit), region, sub_category limit 10""",
    "top_decile_share": f"""
        , {_DECILES}
        select {_pct('sum(case when t = 1 then s else 0 end)', 'sum(s)')} as top_decile_share_pct
        from tiles""",
    "filter_options": """
        select distinct 'region' as filter_name, region as value from lines
        where region is not null
        union all
        select distinct 'category', category from lines where category is not null""",
    "filtered_lines": """
        select order_id, product_id, sales, region, category, order_date from lines
        where region is not null and category is not null and order_date is not null""",
    "dashboard_kpis": f"""
        select {_MONEY}, count(distinct order_id) as orders,
               case when sum(sales) = 0 then 0.0::double
                    else cast(sum(profit) as double) / cast(sum(sales) as double)
               end as profit_margin
        from lines""",
    "monthly_sales_dense": f"""
        , span as (
            select date_trunc('month', min(order_date)) as a,
                   date_trunc('month', max(order_date)) as b from lines
        ),
        months as (
            select cast(unnest(generate_series(a, b, interval 1 month)) as date) as month from span
        )
        select month, {_total('coalesce(sum(sales), 0)', 'sales')}
        from months left join lines on cast(date_trunc('month', order_date) as date) = month
        group by 1""",
    "sales_by_region": f"""
        select region, {_total('sum(sales)', 'sales')} from lines group by 1""",
    "top_products_by_name": f"""
        select product_name, {_total('sum(sales)', 'sales')} from lines group by 1
        order by sum(sales) desc, product_name limit 10""",
    "discount_margin_dashboard": f"""
        , banded as (
            select case when d <= -0.01 then null when d <= 0 then 1 when d <= 0.10 then 2
                        when d <= 0.20 then 3 when d <= 0.30 then 4 when d <= 1 then 5 end
                   as band_order, sales, profit
            from (select coalesce(discount, 0) as d, sales, profit from lines)
        )
        select ['0%', '1-10%', '11-20%', '21-30%', '30%+'][band_order] as discount_band,
               band_order, {_total('sum(sales)', 'sales')}, {_total('sum(profit)', 'profit')},
               cast(sum(profit) as double) / cast(sum(sales) as double) * 100 as margin_pct
        from banded where band_order is not null group by 1, 2 having sum(sales) <> 0""",
    "customer_concentration": f"""
        , customers as (select customer_id, sum(sales) as s from lines group by 1),
        running as (
            select *, sum(s) over (order by s desc, customer_id
                                   rows between unbounded preceding and current row) as c,
                   sum(s) over () as a
            from customers
        )
        select customer_id, {_total('s', 'sales')},
               cast(c as double) / cast(a as double) as cumulative_share
        from running""",
    "measure_totals": f"""
        select {_MONEY},
               cast(sum(profit) as double) / nullif(cast(sum(sales) as double), 0) as profit_margin
        from lines""",
    "measure_totals_sliced": f"""
        select {_MONEY},
               cast(sum(profit) as double) / nullif(cast(sum(sales) as double), 0) as profit_margin
        from lines
        where region in ('ASIA', 'EUROPE') and category in ('ECONOMY', 'STANDARD')
              and order_date between date '1996-01-01' and date '1998-12-31'""",
    "cube_cells": _CELLS + "select * from cells",
    "cube_visuals": _CELLS
    + """,
        chosen as (
            select * from cells
            where region in ('ASIA', 'EUROPE') and category in ('ECONOMY', 'STANDARD')
              and order_date between date '1996-01-01' and date '1998-12-31'
              and spend_decile <= 5
        ),
        series as ("""
    + " union all ".join(_visual(name, label) for name, label in _VISUALS.items())
    + ") select * from series where label is not null union all"
    + _visual("total", "cast(null as varchar)"),
    "sales_ytd": f"""
        , daily as (select order_date, sum(sales) as s from lines group by 1)
        select order_date, {_total('s', 'total_sales')},
               {_total('''sum(s) over (partition by year(order_date) order by order_date
                          rows between unbounded preceding and current row)''', 'sales_ytd')}
        from daily""",
    "calendar": """
        , span as (
            select min(least(order_date, ship_date)) as a, max(greatest(order_date, ship_date)) as b
            from lines
        )
        select cast(unnest(generate_series(make_date(year(a), 1, 1), make_date(year(b), 12, 31),
                                           interval 1 day)) as date) as calendar_date
        from span""",
    "sales_ytd_calendar": f"""
        , span as (
            select min(least(order_date, ship_date)) as a, max(greatest(order_date, ship_date)) as b
            from lines
        ),
        days as (
            select cast(unnest(generate_series(make_date(year(a), 1, 1), make_date(year(b), 12, 31),
                                               interval 1 day)) as date) as calendar_date
            from span
        ),
        daily as (select order_date, sum(sales) as s from lines group by 1)
        select calendar_date, {_total('s', 'total_sales')},
               {_total('''sum(s) over (partition by year(calendar_date) order by calendar_date
                          rows between unbounded preceding and current row)''', 'sales_ytd')}
        from days left join daily on order_date = calendar_date""",
    "mom_calendar": f"""
        , span as (
            select min(least(order_date, ship_date)) as a, max(greatest(order_date, ship_date)) as b
            from lines
        ),
        months as (
            select cast(unnest(generate_series(make_date(year(a), 1, 1), make_date(year(b), 12, 1),
                                               interval 1 month)) as date) as m
            from span
        ),
        monthly as (
            select cast(date_trunc('month', order_date) as date) as m, sum(sales) as s
            from lines group by 1
        ),
        paired as (
            select months.m, now.s, before.s as b
            from months left join monthly now on now.m = months.m
            left join monthly before on before.m = months.m - interval 1 month
        )
        select strftime(m, '%Y-%m') as order_month, {_total('s', 'total_sales')},
               {_total('b', 'prev_month_sales')},
               cast(coalesce(s, 0) - b as double) / nullif(cast(b as double), 0) as mom_growth
        from paired where s is not null or b is not null""",
    "running_sales_global": f"""
        , monthly as (select {_MONTH} as order_month, sum(sales) as s from lines group by 1)
        select order_month, {_total('s', 'monthly_sales')},
               {_total('''sum(s) over (order by order_month
                          rows between unbounded preceding and current row)''', 'running_sales')}
        from monthly""",
    "top_products_in_category": f"""
        , {_PRODUCTS},
        placed as (
            select *, row_number() over (partition by category order by s desc, product_id) as r
            from products
        )
        select category, cast(r as int) as position, product_id, product_name,
               {_total('s', 'total_sales')}
        from placed where r <= 10""",
    "sales_by_state": f"""
        select state, {_total('sum(sales)', 'total_sales')} from lines group by 1""",
    "region_subcategory_matrix": "select sub_category, "
    + ", ".join(
        _total(f"sum(profit) filter (region = '{r}')", f'"{r}"')
        for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    )
    + f""", {_total("sum(profit) filter (region is null)", "other_regions")}
       from lines group by 1""",
    "region_subcategory_matrix_chosen": f"""
        select sub_category, {_total("sum(profit) filter (region = 'ASIA')", '"ASIA"')},
               {_total("sum(profit) filter (region is null or region <> 'ASIA')", "other_regions")}
        from lines group by 1""",
}

# --- defective export and its cleaning --------------------------------------------------

_TOKENS = ", ".join(f"'{t}'" for t in sorted({*MISSING_TOKENS, *READER_NA_TOKENS}))


def _known(column: str) -> str:
    return f"case when {column} not in ({_TOKENS}) then {column} end as {column}"


_WITH_CUSTOMER_ID = "cast(c_custkey as varchar)"
_WITHOUT_CUSTOMER_ID = "cast(null as varchar)"

_EXPORT = f"""
with {_LOCATIONS},
once as (
    select l_orderkey,
           case when l_orderkey % 97 = 0 then 'N/A' else cast(l_orderkey as varchar) end as order_id,
           case when l_orderkey % 101 = 0 then 'not a date'
                when l_orderkey % 5 = 0 then strftime(o_orderdate, '%Y-%m-%d')
                else strftime(o_orderdate, '%-m/%-d/%Y') end as order_date,
           strftime(l_shipdate, '%-m/%-d/%Y') as ship_date,
           o_orderpriority as ship_mode, {_WITH_CUSTOMER_ID} as customer_id,
           E' \\t' || case when l_orderkey % 7 = 0 then upper(c_name) else c_name end || '  '
               as customer_name,
           case when c_custkey % 11 = 0 then 'unknown' else c_mktsegment end as segment,
           country, city, state, postal_code, region,
           cast(p_partkey as varchar) as product_id, p_type as category, p_brand as sub_category,
           p_name as product_name,
           cast(cast(p_retailprice as decimal(12,2)) as varchar) as list_price,
           cast(cast(cast(p_retailprice as decimal(12,2)) * cast(0.80 as decimal(3,2))
                     as decimal(12,2)) as varchar) as cost_price,
           case when l_orderkey % 103 = 0 then 'x' else cast(cast(l_quantity as int) as varchar) end
               as quantity,
           case when l_partkey % 13 <> 0
                then cast(cast(cast(l_discount as decimal(5,4)) * 4 * 100 as decimal(5,2)) as varchar)
           end as discount
    from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
    join part on p_partkey = l_partkey join locations on location_id = c_nationkey
),
export as (
    select * exclude (l_orderkey) from once
    union all
    select * exclude (l_orderkey) from once where l_orderkey % 50 = 0
)"""

_DATE = "cast(try_strptime({0}, ['%m/%d/%Y', '%Y-%m-%d']) as date) as {0}"
_TEXTS = [
    "order_id", "product_id", "ship_mode", "customer_id", "customer_name", "segment", "country",
    "region", "state", "city", "postal_code", "product_name", "category", "sub_category",
]

_PARSED = (
    _EXPORT
    + f""",
known as (
    select {", ".join(_known(c) for c in _TEXTS if c != "customer_name")},
           trim(customer_name, E' \\t') as customer_name,
           {_DATE.format("order_date")}, {_DATE.format("ship_date")},
           try_cast(quantity as double) as quantity, try_cast(discount as double) as percent,
           try_cast(list_price as double) as list_price,
           try_cast(cost_price as double) as cost_price
    from export
),
scaled as (
    select *, case when (select max(percent) from known) > 1 then percent / 100.0::double
                   else percent end as discount
    from known
),
sold as (select *, list_price * (1 - coalesce(discount, 0)) * quantity as sales from scaled),
parsed as (select *, sales - cost_price * quantity as profit from sold),
unique_lines as (select distinct * exclude (percent) from parsed),
complete_lines as (
    select * from unique_lines
    where order_id is not null and order_date is not null and product_id is not null
          and sales is not null and quantity is not null
)"""
)

# Only what the number steps need, with the order id as it is in the export.
_NUMBERS = (
    _EXPORT
    + """,
numbers as (
    select order_id, product_id, try_cast(quantity as double) as quantity,
           try_cast(discount as double) as percent, try_cast(list_price as double) as list_price,
           try_cast(cost_price as double) as cost_price
    from export
)"""
)
_PRICED = (
    _NUMBERS
    + """,
largest as (select max(percent) as top from numbers),
scaled as (
    select order_id, product_id, quantity, list_price, cost_price,
           case when top > 1 then percent / 100.0::double else percent end as discount
    from numbers, largest
),
priced as (select *, list_price * (1 - coalesce(discount, 0)) * quantity as sales from scaled)"""
)

_AFTER_ORDER_DATE = [
    "order_id", "product_id", "ship_date", "sales", "quantity", "discount", "profit", "ship_mode",
    "customer_id", "customer_name", "segment", "country", "region", "state", "city", "postal_code",
    "product_name", "category", "sub_category",
]
_CENTS = "cast(cast({0} as varchar) as decimal(12,2)) as {0}"

# A double goes to a decimal by way of its shortest text, which rounds ties half away.
_NUMBERED = (
    _PARSED
    + f""",
typed as (
    select * replace ({_CENTS.format("sales")}, {_CENTS.format("profit")},
                      cast(quantity as int) as quantity,
                      cast(cast(discount as varchar) as decimal(5,4)) as discount)
    from complete_lines
),
lines as (
    select *, row_number() over (
        order by order_date, {", ".join(f"{c} nulls last" for c in _AFTER_ORDER_DATE)}
    ) as order_line_id
    from typed
)"""
)

_STAR = (
    _NUMBERED
    + """,
dim_customer as (
    select customer_id, customer_name, segment from lines
    qualify row_number() over (partition by customer_id order by order_line_id) = 1
),
dim_product as (
    select product_id, product_name, category, sub_category from lines
    qualify row_number() over (partition by product_id order by order_line_id) = 1
),
places as (select distinct country, region, state, city, postal_code from lines),
dim_location as (
    select row_number() over (order by country nulls last, region nulls last, state nulls last,
                              city nulls last, postal_code nulls last) as location_id, *
    from places
),
fact as (
    select order_line_id, order_id, order_date, ship_date, ship_mode, customer_id, product_id,
           location_id, sales, quantity, discount, profit
    from lines l join dim_location d
      on l.country is not distinct from d.country and l.region is not distinct from d.region
     and l.state is not distinct from d.state and l.city is not distinct from d.city
     and l.postal_code is not distinct from d.postal_code
)"""
)

_LINE = "order_id, order_date, product_id, sales, quantity, discount, profit"


def _key_check(table: str, key: str, source: str | None = None) -> str:
    return f"""
        select '{table}' as table_name, count(*) filter ({key} is not null and n > 1)
                   as repeated_keys,
               cast(coalesce(sum(n) filter ({key} is not null and n > 1), 0) as bigint)
                   as repeated_rows,
               cast(coalesce(sum(n) filter ({key} is null), 0) as bigint) as null_rows
        from (select {key}, count(*) as n from {source or table} group by 1)"""


def _reference_check(key: str, table: str, fact: str = "fact") -> str:
    orphan = f"{key} is not null and {key} not in (select {key} from {table})"
    return f"""
        select '{key}' as foreign_key, count(distinct {key}) filter ({orphan}) as orphan_keys,
               count(*) filter ({orphan}) as orphan_lines,
               count(*) filter ({key} is null) as null_lines
        from {fact}"""


def _counted(table: str, label: str, value: str, conditions: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as {label}, count(*) filter ({test}) as {value} from {table}"
        for name, test in conditions.items()
    )


# Declared widths, stated again so that the check does not compare a list with itself.
_WIDE = {
    "dim_customer": {"customer_id": 32, "customer_name": 120, "segment": 40},
    "dim_product": {"product_id": 32, "product_name": 255, "category": 60, "sub_category": 60},
    "dim_location": {"country": 60, "region": 40, "state": 60, "city": 80, "postal_code": 20},
    "fact": {"order_id": 40, "ship_mode": 40},
}


def _widths(prefix: str = "") -> str:
    return " union all ".join(
        _counted(
            prefix + table,
            "column_name",
            "too_long_rows",
            {
                f"{'fact_order_lines' if table == 'fact' else table}.{c}": f"length({c}) > {n}"
                for c, n in widths.items()
            },
        )
        for table, widths in _WIDE.items()
    )


_REQUIRED = {
    c: f"{c} is null" for c in ("order_line_id", "order_id", "order_date", "sales", "quantity")
}
_OUT_OF_RANGE = {
    "sales": "abs(sales) >= 9999999999.995",
    "quantity": "abs(quantity) >= 2147483647.5",
    "discount": "abs(discount) >= 9.99995",
    "profit": "abs(profit) >= 9999999999.995",
}

# The star with defects in fixed places, for checks that have something to find.
_BAD_STAR = (
    _STAR
    + """,
bad_dim_customer as (
    select customer_id, case when customer_id::bigint % 5 = 0 then rpad(customer_name, 130, '*')
           else customer_name end as customer_name, segment
    from dim_customer where customer_id::bigint % 7 <> 0
),
bad_dim_product as (
    select * from dim_product union all
    select * from dim_product where product_id::bigint % 13 = 0
),
bad_dim_location as (select * from dim_location),
bad_fact as (
    select case when order_line_id % 211 = 0 then null when order_line_id % 97 = 0
                then order_line_id - 1 else order_line_id end as order_line_id,
           case when order_line_id % 31 <> 0 then order_id end as order_id, order_date, ship_date,
           case when order_line_id % 19 = 0 then rpad(ship_mode, 45, '*') else ship_mode end
               as ship_mode,
           customer_id, product_id,
           case when order_line_id % 50 <> 0 then location_id end as location_id,
           case when order_line_id % 29 <> 0 then sales end as sales, quantity, discount, profit
    from fact
)"""
)

_ENRICHED = """
select f.order_line_id, order_id, order_date, ship_date, ship_mode, customer_id, customer_name,
       segment, product_id, product_name, category, sub_category, region, state, city, sales,
       quantity, discount, profit
from fact f join dim_customer using (customer_id) join dim_product using (product_id)
join dim_location using (location_id)"""

_DASHBOARD = """
select f.*, product_name, category, sub_category, country, region, state, city, postal_code,
       customer_name, cast(profit as double) / nullif(cast(sales as double), 0) as margin
from fact f left join dim_customer using (customer_id) left join dim_product using (product_id)
left join dim_location using (location_id)"""

# Over an export without customer ids, where the column is NULL until it is filled.
_CUSTOMER_KEYS = """
, firsts as (
    select customer_name, min(order_line_id) as first from lines
    where customer_name is not null group by 1
),
keys as (
    select customer_name, row_number() over (order by first) - 1 as n from firsts
)
select order_line_id, l.customer_name,
       case when keys.n is null then 'C-00001'
            else 'C' || lpad(cast(n as varchar), cast(greatest(6, length(cast(n as varchar))) as int), '0')
       end as customer_id
from lines l left join keys on keys.customer_name = l.customer_name"""

_OVER_EXPORT = {
    "clean_null_tokens": _EXPORT
    + f"""select {", ".join(_known(c) for c in
        ("order_id", "segment", "city", "postal_code", "product_id"))} from export""",
    "clean_trim": _EXPORT
    + "select trim(customer_name, E' \\t') as customer_name, segment, product_id from export",
    "clean_parse_dates": _EXPORT
    + f"""select order_id, product_id, {_DATE.format("order_date")}, {_DATE.format("ship_date")}
         from export""",
    "clean_parse_numbers": _NUMBERS
    + "select order_id, product_id, quantity, percent as discount, list_price, cost_price"
    + " from numbers",
    "clean_discount_scale": _PRICED + "select order_id, product_id, quantity, discount from priced",
    "clean_derive_sales": _PRICED
    + "select order_id, product_id, quantity, discount, sales from priced",
    "clean_derive_profit": _PRICED
    + "select order_id, product_id, quantity, sales, sales - cost_price * quantity as profit"
    + " from priced",
    "clean_drop_duplicates": _PARSED + f"select {_LINE} from unique_lines",
    "clean_drop_incomplete": _PARSED + f"select {_LINE} from complete_lines",
    "clean_customer_key": _NUMBERED.replace(_WITH_CUSTOMER_ID, _WITHOUT_CUSTOMER_ID)
    + _CUSTOMER_KEYS,
    "clean_customer_key_spread": _NUMBERED.replace(_WITH_CUSTOMER_ID, _WITHOUT_CUSTOMER_ID)
    + _CUSTOMER_KEYS,
    "clean_order_line_id": _NUMBERED + f"select order_line_id, {_LINE} from lines",
    "clean_audit": _PARSED
    + """select (select count(*) from export) as rows_in, cast(0 as bigint) as malformed_rows,
         (select count(*) from export) - (select count(*) from unique_lines) as exact_duplicates,
         (select count(*) from unique_lines) - (select count(*) from complete_lines)
             as incomplete_rows,
         (select count(*) from complete_lines) as rows_out""",
    "clean_rejects": _PARSED
    + """select 'duplicate' as reason, cast(null as varchar) as detail,
              (select count(*) from export) - (select count(*) from unique_lines) as rows
         union all
         select 'incomplete', concat_ws(',',
                    case when order_id is null then 'order_id' end,
                    case when order_date is null then 'order_date' end,
                    case when product_id is null then 'product_id' end,
                    case when sales is null then 'sales' end,
                    case when quantity is null then 'quantity' end) as detail, count(*)
         from unique_lines
         where order_id is null or order_date is null or product_id is null
               or sales is null or quantity is null
         group by detail""",
    "monthly_summary_merged": _STAR
    + f"""select {_MONTH} as order_month, region, category,
                cast(sum(quantity) as bigint) as units_sold, {_MONEY},
                {_half_up('sum(discount)', 4, 'count(discount)', 0, 4)} as avg_discount
         from fact join dim_customer using (customer_id) join dim_product using (product_id)
              join dim_location using (location_id)
         group by 1, 2, 3""",
    "dim_customer": _STAR + "select * from dim_customer",
    "dim_product": _STAR + "select * from dim_product",
    "dim_location": _STAR + "select * from dim_location",
    "fact_order_lines": _STAR + "select * from fact",
    "fact_location_match": _STAR
    + """select order_line_id, location_id, country, region, state, city, postal_code
         from fact join dim_location using (location_id)""",
    "check_primary_keys": _STAR
    + ", fact_order_lines as (select * from fact)"
    + " union all ".join(
        [
            _key_check("dim_customer", "customer_id"),
            _key_check("dim_product", "product_id"),
            _key_check("dim_location", "location_id"),
            _key_check("fact_order_lines", "order_line_id"),
        ]
    ),
    "check_foreign_keys": _STAR
    + " union all ".join(
        [
            _reference_check("customer_id", "dim_customer"),
            _reference_check("product_id", "dim_product"),
            _reference_check("location_id", "dim_location"),
        ]
    ),
    "check_not_null": _STAR + _counted("fact", "column_name", "null_rows", _REQUIRED),
    "check_widths": _STAR + _widths(),
    "check_ranges": _PRICED
    + ", parsed as (select *, sales - cost_price * quantity as profit from priced)"
    + _counted("parsed", "column_name", "out_of_range_rows", _OUT_OF_RANGE),
    "check_primary_keys_planted": _BAD_STAR
    + " union all ".join(
        [
            _key_check("dim_customer", "customer_id", "bad_dim_customer"),
            _key_check("dim_product", "product_id", "bad_dim_product"),
            _key_check("dim_location", "location_id", "bad_dim_location"),
            _key_check("fact_order_lines", "order_line_id", "bad_fact"),
        ]
    ),
    "check_foreign_keys_planted": _BAD_STAR
    + " union all ".join(
        [
            _reference_check("customer_id", "bad_dim_customer", "bad_fact"),
            _reference_check("product_id", "bad_dim_product", "bad_fact"),
            _reference_check("location_id", "bad_dim_location", "bad_fact"),
        ]
    ),
    "check_not_null_planted": _BAD_STAR
    + _counted("bad_fact", "column_name", "null_rows", _REQUIRED),
    "check_widths_planted": _BAD_STAR + _widths("bad_"),
    "check_ranges_planted": _PRICED.replace("from scaled)", "from large)").replace(
        "priced as (",
        """large as (
    select * replace (case when product_id::bigint % 41 = 0 then quantity * 1e9
                           else quantity end as quantity) from scaled
),
priced as (""",
    )
    + ", parsed as (select *, sales - cost_price * quantity as profit from priced)"
    + _counted("parsed", "column_name", "out_of_range_rows", _OUT_OF_RANGE),
    # Appending in two batches by date leaves nothing to tell from one cleaning of the whole.
    "appended_fact": _STAR
    + """select order_line_id, order_id, customer_id, product_id, sales, country, region, state,
                city, postal_code
         from fact join dim_location using (location_id)""",
    # Loading the second batch again changes nothing.
    "appended_twice": _STAR
    + """select order_line_id, order_id, customer_id, product_id, sales, country, region, state,
                city, postal_code
         from fact join dim_location using (location_id)""",
    # Without customer columns every order is a customer, numbered in order of appearance.
    "appended_order_customers": _NUMBERED
    + """select order_id, 'C' || lpad(cast(row_number() over (order by min(order_line_id)) - 1
                                   as varchar), 6, '0') as customer_id
         from lines group by order_id""",
    "appended_customers": _STAR + "select * from dim_customer",
    "appended_products": _STAR + "select * from dim_product",
    "appended_locations": _STAR + "select * exclude (location_id) from dim_location",
    "appended_top_regions": _NUMBERED
    + f"""select region, {_MONEY}, {_pct('sum(profit)', 'sum(sales)')} as margin_pct
          from lines group by 1""",
    "order_lines_enriched": _STAR + _ENRICHED,
    "order_lines_enriched_spread": _STAR + _ENRICHED,
    "dashboard_base": _STAR + _DASHBOARD,
}

ORACLE: dict[str, str] = {
    **_OVER_EXPORT,
    **{name: _LINES + text for name, text in _OVER_LINES.items()},
}
