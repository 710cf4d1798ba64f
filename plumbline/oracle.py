"""The registered queries once more, as SQL for another engine.

Written independently of the Spark plans: the raw tables are unions of copies,
the dedup ranks rows, the history re-measures every prefix, the cooldown is a
recursion.  Only constants and the draw formula are shared.
"""

from __future__ import annotations

from collections.abc import Sequence

from plumbline.functions.address import STATES
from plumbline.functions.draws import draw_sql, identifier_sql
from plumbline.functions.text import PAGE_FIELDS
from plumbline.plans.shop_monitors import EMAIL
from plumbline.sources import shop

# Patterns of this module's own; the other engine knows no lookarounds.
ADDRESS = "^([0-9]+ [A-Za-z ]+), ([A-Za-z .]+) ([A-Z]{2}) ([0-9]{5})$"
PERSONAL_DATA = {
    "ADDRESS": "[0-9]{1,6}( [A-Za-z0-9.#-]+){1,5}(, (Apt|Unit|Suite|Ste)[.]? [A-Za-z0-9-]+)?, [A-Za-z.]+( [A-Za-z.]+){0,2} [A-Z]{2} [0-9]{5}(-[0-9]{4})?",
    "EMAIL": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+",
    "IP": "[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}",
    "CARD": "[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    "PHONE": "([+]?1[-. ])?[(]?[0-9]{3}[)]?[-. ][0-9]{3}[-. ][0-9]{4}",
}

AS_OF = f"timestamp '{shop.AS_OF}'"
DAY = f"date '{shop.LAST_DAY}'"


def _listed(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _pick(key: str, salt: int, values: Sequence[str]) -> str:
    return f"([{_listed(values)}])[{draw_sql(key, salt, len(values))} + 1]"


def _orders(source: str) -> str:
    """Raw orders from rows (k, custkey, day)."""

    def d(salt: int, n: int) -> str:
        return draw_sql("k", salt, n)

    total = "quantity * unit_price"
    columns = ("order_id, customer_id, product_id, quantity, unit_price, order_total, {day} as order_date, "
               "{status} as status, shipping_address, region, customer_notes")
    return f"""
  select {columns.format(day="day", status="status")} from made
  union all select {columns.format(day="day", status="status")} from made where {d(17, 100)} < 2
  union all select {columns.format(day="day + 1", status=f"'{shop.LATE_COPY}'")} from made where {d(18, 100)} < 1
""", f"""
  select *,
    case when {d(7, 200)} < 1 then null
         when {d(3, 100)} < 2 then cast(-10 - {d(4, 491)} as double)
         when {d(5, 100)} < 3 then cast(0 as double)
         when {d(6, 100)} < 6 then {total} + cast(7.5 as double)
         else {total} end as order_total
  from (select k, day,
    {identifier_sql("ORD", "k")} as order_id,
    case when {d(1, 100)} < (case when {d(15, 4)} = 3 then 12 else 8 end) then null
         else {identifier_sql("CUST", "custkey")} end as customer_id,
    {identifier_sql("PROD", d(13, 200))} as product_id,
    cast(1 + {d(11, 25)} as int) as quantity,
    cast(500 + {d(12, 29400)} as double) / cast(100 as double) as unit_price,
    {_pick("k", 8, shop.ORDER_STATUSES)} as status,
    case when {d(9, 100)} < 4 then null
         when {d(9, 100)} < 6 then concat('n/a ', cast(100 + {d(14, 9900)} as varchar))
         else concat(cast(100 + {d(14, 9900)} as varchar), {_pick("k", 10, shop.STREETS)}) end as shipping_address,
    {_pick("k", 15, shop.REGIONS)} as region,
    case when {d(16, 100)} < 10 then '{shop.NOTES[0]}' when {d(16, 100)} < 20 then '{shop.NOTES[1]}'
         when {d(16, 100)} < 30 then '{shop.NOTES[2]}' end as customer_notes
    from ({source}))
"""


_COPIES, _MADE = _orders("select o_orderkey as k, o_custkey as custkey, cast(o_orderdate as date) as day from orders")


def _updated(rows: str) -> str:
    """The rows of a table of orders after the statements of ``shop.updated_orders``."""
    def d(salt: int) -> str:
        return draw_sql(shop.KEY_OF_ORDER, salt, 100)

    other = "product_id, quantity, unit_price"
    rest = "shipping_address, region, customer_notes"
    return f"""{rows}_changed as (select order_id, case when {d(84)} >= 1 then customer_id end as customer_id, {other},
      case when {d(83)} < 2 then -order_total else order_total end as order_total,
      case when {d(85)} < 2 and status <> '{shop.LATE_COPY}' then order_date + 3 else order_date end as order_date, status, {rest}
    from {rows} where not ({d(81)} < 3 and status <> '{shop.LATE_COPY}') and {d(82)} >= 2 and order_date <= date '{shop.CLOSED_AFTER}'),
{rows}_updated as (select * from {rows}_changed union all
    select order_id, customer_id, {other}, order_total, order_date - 2, '{shop.RESTATED}', {rest} from {rows}_changed where {d(86)} < 1)"""


def _c(salt: int, n: int) -> str:
    return draw_sql("c_custkey", salt, n)


def _p(salt: int, n: int) -> str:
    return draw_sql("p_partkey", salt, n)


def _o(salt: int, n: int) -> str:
    return draw_sql("o_orderkey", salt, n)


_ORDERS = f"made as ({_MADE}), raw_orders as ({_COPIES})"
_CUSTOMERS = f"""made_customers as (select c_custkey as k, {identifier_sql("CUST", "c_custkey")} as customer_id,
    case when {_c(21, 100)} < 2 then concat('user', cast(c_custkey as varchar), 'nodomain.com')
         when {_c(21, 100)} < 4 then '@example.com'
         when {_c(21, 100)} < 5 then concat('user', cast(c_custkey as varchar), '@@example.com')
         else concat('user', cast(c_custkey as varchar), '@example.com') end as email,
    {_pick("c_custkey", 28, shop.FIRST_NAMES)} as first_name,
    {_pick("c_custkey", 29, shop.LAST_NAMES)} as last_name,
    concat('555-', cast(100 + {_c(22, 900)} as varchar), '-', cast(1000 + {_c(23, 9000)} as varchar)) as phone,
    {DAY} - cast({_c(24, 1096)} as int) as signup_date,
    {_pick("c_custkey", 25, shop.REGIONS)} as region,
    case when {_c(26, 10)} < 2 then 'PLATINUM' when {_c(26, 10)} < 5 then 'GOLD'
         when {_c(26, 10)} < 7 then 'SILVER' else 'BRONZE' end as tier from customer),
raw_customers as (select * exclude (k) from made_customers
    union all select * exclude (k) from made_customers where {draw_sql("k", 27, 100)} < 2)"""
_PRODUCTS = f"""raw_products as (select {identifier_sql("PROD", "p_partkey")} as product_id, p_name as product_name,
    case when {_p(31, 100)} < 5 then {_pick("p_partkey", 35, shop.MISSPELT_CATEGORIES)}
         else {_pick("p_partkey", 32, shop.CATEGORIES)} end as category,
    case when {_p(33, 100)} < 1 then cast(0 as double) when {_p(33, 100)} < 3 then cast(99999.99 as double)
         else p_retailprice end as unit_price,
    {_p(34, 10)} > 0 as is_active from part)"""
_INVENTORY = f"""raw_inventory as (select {identifier_sql("INV", "p_partkey")} as inventory_id,
    case when {_p(41, 100)} < 3 then {identifier_sql("PROD", "(p_partkey + 90000000)")}
         else {identifier_sql("PROD", "p_partkey")} end as product_id,
    {_pick("p_partkey", 42, shop.WAREHOUSES)} as warehouse_location,
    case when {_p(43, 100)} < 5 then cast(-1 - {_p(44, 200)} as int) else cast({_p(44, 5001)} as int) end as quantity_on_hand,
    cast({DAY} - cast({_p(46, 30)} as int) as timestamp) as last_updated,
    cast(10 + {_p(45, 191)} as int) as reorder_point from part)"""
_SHIPMENTS = f"""raw_shipments as (select {identifier_sql("SHIP", "o_orderkey")} as shipment_id,
    {identifier_sql("ORD", "o_orderkey")} as order_id, {_pick("o_orderkey", 51, shop.CARRIERS)} as carrier,
    case when {_o(52, 4)} = 2 and {_o(53, 5)} = 0 then null
         else concat('1Z', lpad(cast({_o(54, 1000000000)} as varchar), 12, '0')) end as tracking_number,
    case when {_o(55, 100)} < 4 then cast(o_orderdate as date) + 3650
         else cast(o_orderdate as date) + cast({_o(56, 30)} as int) end as ship_date,
    cast(o_orderdate as date) + cast(31 + {_o(57, 10)} as int) as estimated_delivery,
    case when {_o(58, 4)} = 0 then null
         else cast(o_orderdate as date) + cast(31 + {_o(59, 30)} as int) end as actual_delivery,
    {_pick("o_orderkey", 52, shop.SHIPMENT_STATUSES)} as status from orders)"""
_VALIDATED = """deduped as (select * exclude (rn) from (select *, row_number() over (partition by order_id
      order by order_date asc nulls last, customer_id nulls first, product_id nulls first, quantity nulls first,
      unit_price nulls first, order_total nulls first, status nulls first, shipping_address nulls first,
      region nulls first, customer_notes nulls first) as rn from raw_orders) where rn = 1),
flagged as (select *, customer_id is null as is_null_customer, order_total < 0 as is_negative_total,
      coalesce(order_total = 0, false) as is_zero_total, shipping_address is null as is_missing_address,
      coalesce(abs(order_total - quantity * unit_price) > 1, false) as is_total_mismatch from deduped),
points as (select *, is_null_customer or coalesce(is_negative_total, false) as is_rejected,
      100 - 20 * cast(is_zero_total as int) - 15 * cast(is_missing_address as int)
          - 10 * cast(is_total_mismatch as int) as pts from flagged),
judged as (select *, cast(case when is_rejected then 0 else pts end as int) as quality_score,
      case when is_rejected then 'REJECTED' when pts >= 90 then 'CLEAN' else 'REVIEW_NEEDED' end as quality_status
      from points),
validated as (select order_id, customer_id, product_id, quantity, unit_price, order_total, order_date, status,
      shipping_address, region, customer_notes, quality_score, quality_status from judged),
customer_tier as (select customer_id, tier from (select customer_id, tier, row_number() over (
      partition by customer_id order by signup_date nulls last, tier nulls first) as rn from raw_customers) where rn = 1),
tiered as (select v.*, t.tier from validated v left join customer_tier t on v.customer_id = t.customer_id)"""


def _with(tables: Sequence[str], body: str) -> str:
    return f"with {', '.join(tables)} {body}"


def _on_orders(body: str) -> str:
    return _with([_ORDERS], body)


def _on_updated(*more: str, body: str) -> str:
    """``raw_orders`` stands for the orders after the updates."""
    return _with([f"made as ({_MADE}), raw_first as ({_COPIES})", _updated("raw_first"),
                  "raw_orders as (select * from raw_first_updated)", *more], body)


def _on_validated(body: str) -> str:
    return _with([_ORDERS, _CUSTOMERS, _VALIDATED], body)


def _big(expression: str) -> str:
    return f"cast({expression} as bigint)"


def _suspicious(column: str) -> str:
    states = _listed(STATES)
    return (f"{column} is not null and not (regexp_matches({column}, '{ADDRESS}') "
            f"and regexp_extract({column}, '{ADDRESS}', 3) in ({states}))")


# -- metrics ------------------------------------------------------------------------

# name, columns, expression over a table r, expression for the measurement time
_ORDER_METRICS = (
    ("NULL_COUNT", "customer_id", "count_if(customer_id is null)"),
    ("DUPLICATE_COUNT", "order_id", "count(order_id) - count(distinct order_id)"),
    ("NEGATIVE_TOTAL_COUNT", "order_total", "count_if(order_total < 0)"),
    ("SUSPICIOUS_ADDRESS_COUNT", "shipping_address", f"count_if({_suspicious('shipping_address')})"),
    ("FRESHNESS", "order_date", "date_sub('second', cast(max(order_date) as timestamp), {at})"),
)
_LINE_METRICS = (
    ("NULL_COUNT", "l_partkey", "count_if(l_partkey is null)"),
    ("DUPLICATE_COUNT", "l_orderkey,l_linenumber",
     "count_if(l_orderkey is not null and l_linenumber is not null) - count(distinct (l_orderkey, l_linenumber))"),
    ("NEGATIVE_TOTAL_COUNT", "l_extendedprice", "count_if(l_extendedprice < 0)"),
    ("FRESHNESS", "l_shipdate", "date_sub('second', max(l_shipdate), {at})"),
)
_EXPECTATIONS = (
    ("NEGATIVE_TOTAL_COUNT", "few_negatives", "value < 50"),
    ("DUPLICATE_COUNT", "no_duplicates", "value = 0"),
    ("NULL_COUNT", "low_nulls", "value < 200"),
    ("FRESHNESS", "fresh_data", "value < 86400"),
)
_PLACE = "'shop' as table_database, 'raw' as table_schema, '{t}' as table_name"


def _measured(table: str, name: str, metrics, at: str) -> str:
    return " union all ".join(
        f"select {_PLACE.format(t=name)}, '{m}' as metric_name, '{c}' as columns, "
        f"cast({e.replace("{at}", at)} as double) as value, {at} as measurement_time from {table}"
        for m, c, e in metrics)


def _history() -> str:
    """Every metric measured again on every prefix of the months."""
    at = "cast(b.month + interval 1 month as timestamp)"
    rows = " union all ".join(
        f"select {_PLACE.format(t='orders')}, '{m}' as metric_name, '{c}' as columns, "
        f"cast({e.replace("{at}", at)} as double) as value, {at} as measurement_time "
        f"from months b join raw_orders r on date_trunc('month', r.order_date) <= b.month group by b.month"
        for m, c, e in _ORDER_METRICS)
    return ("months as (select distinct date_trunc('month', order_date) as month from raw_orders), "
            f"history as ({rows})")


def _judged(results: str, table: str = "orders", expectations=_EXPECTATIONS, name: str = "statuses") -> str:
    rows = " union all ".join(
        f"select table_database, table_schema, table_name, metric_name, columns, '{n}' as expectation_name, "
        f"'{e}' as expression, value, ({e}) is not null as evaluated, coalesce(not ({e}), false) as violated, "
        f"measurement_time from {results} where metric_name = '{m}' and table_name = '{table}'" for m, n, e in expectations)
    return f"{name} as ({rows})"


# table: metrics as above, then expectations
_OTHER_TABLES = {
    "customers": (((f"NOT_MATCHING_COUNT({EMAIL})", "email", f"count_if(not regexp_matches(email, '{EMAIL}'))"),
                   ("DUPLICATE_COUNT", "customer_id", "count(customer_id) - count(distinct customer_id)")),
                  ((f"NOT_MATCHING_COUNT({EMAIL})", "emails_well_formed", "value = 0"),
                   ("DUPLICATE_COUNT", "no_duplicates", "value = 0"))),
    "products": (((f"NOT_ACCEPTED_COUNT({', '.join(shop.CATEGORIES)})", "category",
                   f"count_if(category not in ({_listed(shop.CATEGORIES)}))"),
                  ("OUTLIER_COUNT(0.0, 99999.0)", "unit_price", "count_if(unit_price <= 0 or unit_price >= 99999)")),
                 ((f"NOT_ACCEPTED_COUNT({', '.join(shop.CATEGORIES)})", "known_categories", "value = 0"),
                  ("OUTLIER_COUNT(0.0, 99999.0)", "plausible_prices", "value = 0"))),
    "inventory": ((("BELOW_COUNT(0)", "quantity_on_hand", "count_if(quantity_on_hand < 0)"),),
                  (("BELOW_COUNT(0)", "no_negative_stock", "value = 0"),)),
    "shipments": ((("NULL_WHERE_COUNT(DELIVERED)", "status,tracking_number",
                    "count_if(status = 'DELIVERED' and tracking_number is null)"),
                   (f"LATER_THAN_COUNT({shop.LAST_DAY})", "ship_date", f"count_if(ship_date > {DAY})")),
                  (("NULL_WHERE_COUNT(DELIVERED)", "delivered_are_tracked", "value = 0"),
                   (f"LATER_THAN_COUNT({shop.LAST_DAY})", "nothing_from_the_future", "value = 0"))),
}


def _all_tables() -> str:
    parts = [_ORDERS, _CUSTOMERS, _PRODUCTS, _INVENTORY, _SHIPMENTS,
             f"m_orders as ({_measured('raw_orders', 'orders', _ORDER_METRICS, AS_OF)})", _judged("m_orders", name="s_orders")]
    for t, (metrics, expectations) in _OTHER_TABLES.items():
        parts += [f"m_{t} as ({_measured(f'raw_{t}', t, metrics, AS_OF)})", _judged(f"m_{t}", t, expectations, f"s_{t}")]
    return _with(parts, " union all ".join(f"select * from s_{t}" for t in ("orders", *_OTHER_TABLES)))


def _one(column: str, table: str, expression: str, *prefix: str) -> str:
    return _with(prefix, f"select {expression} as {column} from {table}")


def _per_hundred(part: str, whole: str) -> str:
    return f"round(cast({part} as double) * 100 / nullif(cast({whole} as double), 0), 2)"


# -- semantic model -------------------------------------------------------------------

_METRICS = {
    "total_orders": _big("count(order_id)"),
    "clean_order_count": _big("count_if(quality_status = 'CLEAN')"),
    "rejected_count": _big("count_if(quality_status = 'REJECTED')"),
    "review_needed_count": _big("count_if(quality_status = 'REVIEW_NEEDED')"),
    "clean_order_rate": _per_hundred("count_if(quality_status = 'CLEAN')", "count(order_id)"),
    "avg_quality_score": "round(avg(quality_score), 1)",
    "null_customer_count": _big("count_if(customer_id is null)"),
    "negative_total_count": _big("count_if(order_total < 0)"),
    "null_customer_rate": _per_hundred("count_if(customer_id is null)", "count(order_id)"),
    "rejection_rate": _per_hundred("count_if(quality_status = 'REJECTED')", "count(order_id)"),
}


def _semantic(*dims: str, metrics: Sequence[str] = tuple(_METRICS), where: str = "true", group: str = "") -> str:
    columns = ", ".join([*dims, *[f"{_METRICS[m]} as {m}" for m in metrics]])
    grouping = group or (f"group by {', '.join(dims)}" if dims else "")
    return _on_validated(f"select {columns} from tiered where {where} {grouping}")


def _flags() -> str:
    rates = {
        "rejection_rate": ("count_if(quality_status = 'REJECTED')", "count(*)", ">", 1.1),
        "null_customer_rate": ("count_if(customer_id is null)", "count(*)", ">", 1.1),
        "negative_total_rate": ("count_if(order_total < 0)", "count(*)", ">", 1.1),
        "clean_order_rate": ("count_if(quality_status = 'CLEAN')", "count(*)", "<", 0.9),
        "avg_quality_score": ("sum(quality_score)", "count(quality_score)", "<", 0.9),
    }
    # Each rule's share of a group's rows less its share of all rows; the largest one is the cause.
    broken = ", ".join(f"count_if(is_{i}) as n_{i}" for i in _ISSUES)
    excess = " union all ".join(
        f"select g.region, '{i}' as rule, cast(g.n_{i} as double) / g.n - cast(o.n_{i} as double) / o.n as x "
        "from by_region g, by_all o" for i in _ISSUES)
    rows = " union all ".join(
        f"select g.region, '{name}' as metric_name, g.value, o.overall, g.value {sign} o.overall * {bound} as flagged, "
        f"case when g.value {sign} o.overall * {bound} and c.x > 0 then c.rule end as cause "
        f"from (select region, cast({part} as double) / {whole} as value from validated group by region) g "
        f"join worst c on c.region = g.region, "
        f"(select cast({part} as double) / {whole} as overall from validated) o"
        for name, (part, whole, sign, bound) in rates.items())
    return _with([_ORDERS, _CUSTOMERS, _VALIDATED, f"by_region as (select region, count(*) as n, {broken} from judged group by region)",
                  f"by_all as (select count(*) as n, {broken} from judged)", f"excess as ({excess})",
                  "worst as (select region, rule, x from (select *, row_number() over (partition by region "
                  "order by x desc, rule desc) as rn from excess) where rn = 1)"], rows)


def _facts(dims: str, where: str, chosen: str, customers: bool = False) -> str:
    """Every fact counted by itself, then the counts added up."""
    columns = {"n_orders": "count(*)", "n_rejected": "count_if(quality_status = 'REJECTED')"}
    ship = {"n_shipments": "count(*)", "n_late": "count_if(actual_delivery > estimated_delivery)", "n_untracked": "count_if(tracking_number is null)"}
    names = [*columns, *ship, "n_customers"]
    parts = [("tiered", columns), ("shipped", ship), *([("raw_customers_tier", {"n_customers": "count(*)"})] if customers else [])]
    rows = " union all ".join(
        f"select {dims}, {', '.join(f'{measures.get(n, 0)} as {n}' for n in names)} from {t} where {where} group by all" for t, measures in parts)
    totals = ", ".join(f"{_big(f'sum({n})')} as {n}" for n in names)
    return _with([_ORDERS, _CUSTOMERS, _SHIPMENTS, _VALIDATED,
                  "shipped as (select s.* exclude (status), t.tier, t.region, t.quality_status from raw_shipments s left join tiered t on s.order_id = t.order_id)",
                  "raw_customers_tier as (select tier from raw_customers)",
                  f"totals as (select {dims}, {totals} from ({rows}) group by all)"], f"select {dims}, {chosen} from totals")


def _slices(dims: Sequence[str], bad: str, least_rows: int, least_share: float, above: float) -> str:
    """All slices by brute force, each beside all slices with one dimension less."""
    free = ", ".join(f"grouping({d}) as g_{d}" for d in dims)
    cells = (f"cells as (select {', '.join(dims)}, {free}, count(*) as n, count_if({bad}) as bad from tiered group by cube ({', '.join(dims)})), "
             "whole as (select bad, n, cast(bad as double) / n as rate from cells where "
             + " and ".join(f"g_{d} = 1" for d in dims) + ")")
    fewer = " or ".join(
        "(" + " and ".join([f"c.g_{d} = 0 and p.g_{d} = 1", *[f"p.g_{e} = c.g_{e} and p.{e} is not distinct from c.{e}" for e in dims if e != d]]) + ")"
        for d in dims)
    fixed = "array_to_string(list_filter([" + ", ".join(f"case when c.g_{d} = 0 then '{d}' end" for d in dims) + "], lambda x: x is not null), ',')"
    kept = (f"select {fixed} as fixed, {', '.join('c.' + d for d in dims)}, c.n as row_count, cast(c.bad as bigint) as bad_count, "
            "round(cast(c.bad as double) * 100 / c.n, 2) as bad_rate, round(c.bad - c.n * w.rate, 4) as excess "
            f"from cells c join cells p on {fewer}, whole w "
            f"group by {', '.join(f'c.{d}, c.g_{d}' for d in dims)}, c.n, c.bad, w.bad, w.rate "
            f"having c.n >= {least_rows} and c.bad > 0 and c.bad - c.n * w.rate >= {least_share} * w.bad "
            f"and cast(c.bad as double) / c.n >= {above} * max(cast(p.bad as double) / p.n)")
    return _with([_ORDERS, _CUSTOMERS, _VALIDATED, cells], kept)


def _sides(table: str, inside: str, chosen: Sequence[str]) -> str:
    rows = " union all ".join(
        f"select '{m}' as metric_name, w.v as group_value, r.v as rest_value, w.v - r.v as difference from "
        f"(select cast({_METRICS[m]} as double) as v from {table} where {inside}) w, "
        f"(select cast({_METRICS[m]} as double) as v from {table} where coalesce(not ({inside}), true)) r" for m in chosen)
    return _on_validated(rows)


def _redacted(text: str) -> str:
    for kind, pattern in PERSONAL_DATA.items():
        text = f"regexp_replace({text}, '{pattern}', '[{kind}]', 'g')"
    return text


def _hits(kind: str) -> str:
    return f"len(regexp_extract_all(text, '{PERSONAL_DATA[kind]}'))"


def _part(i: int) -> str:
    return f"nullif(regexp_extract(shipping_address, '{ADDRESS}', {i}), '')"


_PARTS = f"{_part(1)} as street, {_part(2)} as city, {_part(3)} as state, {_part(4)} as zip_code"
_MASKED = (f"case when shipping_address is null then null when {_part(2)} is null then '[ADDRESS]' "
           f"else concat('[STREET], ', {_part(2)}, ' ', {_part(3)}, ' [ZIP]') end")
_ISSUES = ("null_customer", "negative_total", "zero_total", "missing_address", "total_mismatch")
_SENT = """with recursive violations as (select event_type, ts from events where value > 20),
sent as (select event_type, min(ts) as ts from violations group by event_type
  union all
  select s.event_type, min(v.ts) as ts from sent s join violations v
    on v.event_type = s.event_type and v.ts >= s.ts + interval 1 hour group by s.event_type, s.ts)
select event_type, ts from sent"""
_PAYLOAD = """concat('{"table":"', table_name, '","metric":"', metric_name, '","columns":"', columns, '","value":',
  cast(value as varchar), ',"expectation":"', expectation_name, '","measurement_time":"',
  strftime(measurement_time, '%Y-%m-%d %H:%M:%S'), '"}')"""


def oracle_sql() -> dict[str, str]:
    measured = f"measured as ({_measured('raw_orders', 'orders', _ORDER_METRICS, AS_OF)})"
    queries = {
        "scan_orders": _on_orders("select * from raw_orders"),
        "scan_customers": _with([_CUSTOMERS], "select * from raw_customers"),
        "scan_products": _with([_PRODUCTS], "select * from raw_products"),
        "scan_inventory": _with([_INVENTORY], "select * from raw_inventory"),
        "scan_shipments": _with([_SHIPMENTS], "select * from raw_shipments"),
        "row_counts": _with([_ORDERS, _CUSTOMERS, _PRODUCTS, _INVENTORY, _SHIPMENTS], " union all ".join(
            f"select 'raw.{t}' as table_name, count(*) as row_count from raw_{t}"
            for t in ("orders", "customers", "products", "inventory", "shipments")) + " order by table_name"),
        "update_null_tracking": _with([_SHIPMENTS], "select shipment_id, status, tracking_number from raw_shipments"),
        "sample_rows": ("select o_orderkey, o_totalprice from orders "
                        f"order by {draw_sql('o_orderkey', 63, 1000000007)}, o_orderkey limit 150"),
        "inject_duplicates": (
            "with chosen as (select c_custkey, c_name, c_mktsegment from customer "
            f"order by {draw_sql('c_custkey', 64, 1000000007)}, c_custkey limit 40) "
            "select c_custkey, c_name, c_mktsegment from customer union all select * from chosen"),
        "negative_totals": _on_orders("select order_id, order_total from raw_orders where order_total < 0"),
        "dq_null_count": _one("dq_null_count", "raw_orders", "count(*) - count(customer_id)", _ORDERS),
        "dq_duplicate_count": _one("dq_duplicate_count", "raw_orders",
                                   "count(order_id) - count(distinct order_id)", _ORDERS),
        "dq_negative_total": _on_orders("select count(*) as dq_negative_total from raw_orders where order_total < 0"),
        "dq_suspicious_address": _on_orders(
            f"select count(*) as dq_suspicious_address from raw_orders where {_suspicious('shipping_address')}"),
        "price_mismatch": _on_orders("select count(*) as price_mismatch from raw_orders "
                                     "where abs(order_total - quantity * unit_price) > 1"),
        "notes_fill_rate": _one("notes_fill_rate", "raw_orders",
                                "cast(count(customer_notes) as double) * 100 / cast(count(*) as double)", _ORDERS),
        "customers_bad_email": _with([_CUSTOMERS], "select count(*) as customers_bad_email from raw_customers "
                                                   f"where not regexp_matches(email, '{EMAIL}')"),
        "customers_duplicates": _one("customers_duplicates", "raw_customers",
                                     "count(customer_id) - count(distinct customer_id)", _CUSTOMERS),
        "products_bad_category": _with([_PRODUCTS], "select count(*) as products_bad_category from raw_products "
                                                    f"where category not in ({_listed(shop.CATEGORIES)})"),
        "products_price_outlier": _with([_PRODUCTS], "select count(*) as products_price_outlier from raw_products "
                                                     "where unit_price <= 0 or unit_price >= 99999"),
        "inventory_negative": _with([_INVENTORY], "select count(*) as inventory_negative from raw_inventory "
                                                  "where quantity_on_hand < 0"),
        "shipments_no_tracking": _with([_SHIPMENTS], "select count(*) as shipments_no_tracking from raw_shipments "
                                                     "where status = 'DELIVERED' and tracking_number is null"),
        "shipments_future": _with([_SHIPMENTS], "select count(*) as shipments_future from raw_shipments "
                                                f"where ship_date > cast({AS_OF} as date)"),
        "dq_freshness": _on_orders(
            "select s as freshness_seconds, round(s / 3600.0::double, 1) as freshness_hours from "
            f"(select date_sub('second', cast(max(order_date) as timestamp), {AS_OF}) as s from raw_orders)"),
        "dq_custom_metric": _on_orders(
            "select cast(count_if(customer_id is null or shipping_address is null) as double) * 100 "
            "/ cast(count(*) as double) as unplaced_rate from raw_orders"),
        "dq_duplicate_variants": _on_orders(
            f"select {_big('sum(n - 1)')} as excess_rows, {_big('count_if(n > 1)')} as duplicated_keys, "
            f"{_big('coalesce(sum(n) filter (n > 1), 0)')} as rows_in_duplicate_groups from "
            "(select order_id, count(*) as n from raw_orders group by order_id)"),
        "inventory_orphans": _with([_PRODUCTS, _INVENTORY], (
            "select count(*) as orphan_rows, count(distinct product_id) as orphan_keys from raw_inventory i "
            "where product_id is not null and not exists "
            "(select 1 from raw_products p where p.product_id = i.product_id)")),
        "shipment_order_semi": _with([_ORDERS, _SHIPMENTS], (
            "select status, count(*) as rows from raw_shipments s where exists "
            "(select 1 from raw_orders o where o.order_id = s.order_id) group by status")),
        "category_repair": _with([_PRODUCTS], (
            "select category, repaired, count(*) as products from (select category, (select v from "
            f"(select unnest([{_listed(shop.CATEGORIES)}]) as v) order by levenshtein(p.category, v), v limit 1) "
            "as repaired from raw_products p) group by category, repaired")),
        "product_label_repair": (
            "with labels as (select p_partkey, concat_ws(' ', p_brand, p_name, p_type) as label from part), "
            f"placed as (select *, {draw_sql('p_partkey', 91, 100)} as kind, "
            f"cast({draw_sql('p_partkey', 92, 'length(label)')} as int) as gone from labels), "
            "named as (select p_partkey, label, case when kind < 4 then label[:gone] || label[gone + 2:] "
            "when kind < 7 then label[:gone] || '_' || label[gone + 2:] "
            "when kind < 8 then 'zzz' || label else label end as given_label from placed), "
            "wrong as (select * from named where given_label <> label), "
            "pairs as (select w.given_label, l.label, levenshtein(w.given_label, l.label) as far "
            "from (select distinct given_label from wrong) w, (select distinct label from labels) l), "
            "best as (select given_label, min({'far': far, 'label': label}) as b from pairs where far <= 2 group by given_label) "
            "select p_partkey, w.given_label, b.label as repaired, cast(b.far as int) as distance "
            "from wrong w left join best on best.given_label = w.given_label"),
        "history_estimates": _on_orders(
            "select months.batch, count(*) as exact, true as within_bound from "
            "(select distinct cast(date_trunc('month', order_date) as date) as batch from raw_orders) months join "
            "(select order_id, min(order_date) as first from raw_orders where order_id is not null group by order_id) o "
            "on o.first < months.batch + interval 1 month group by months.batch"),
        "dq_orders_all": _on_orders(_measured("raw_orders", "orders", _ORDER_METRICS, AS_OF)),
        "dq_lineitem_all": _measured("lineitem", "lineitem", _LINE_METRICS, AS_OF),
        "dq_expectations": _with([_ORDERS, measured, _judged("measured")], "select * from statuses"),
        "dq_all_tables": _all_tables(),
        "dq_model_metric": _on_orders("select count(*) as dq_model_metric from raw_orders where shipping_address is not null "
                                      "and not regexp_matches(shipping_address, '^[0-9]+ ')"),
        "metric_history": _with([_ORDERS, _history()], "select * from history"),
        "metric_results_latest": _with([_ORDERS, _history()], (
            "select metric_name, columns, value, measurement_time from history "
            "order by measurement_time desc, metric_name, columns limit 20")),
        "expectation_history": _with([_ORDERS, _history(), _judged("history")], (
            "select * from statuses order by measurement_time desc, metric_name, columns, expectation_name limit 20")),
        "metric_references": _with([_ORDERS, _history(), _judged("history")], (
            "select h.table_name, h.metric_name, h.columns, "
            "cast(case when h.metric_name = 'SUSPICIOUS_ADDRESS_COUNT' then 0 else 1 end as int) as expectations, "
            "h.value, h.measurement_time, s.violated from history h left join statuses s "
            "on s.metric_name = h.metric_name and s.measurement_time = h.measurement_time "
            "where h.measurement_time = (select max(measurement_time) from history)")),
        "alert_payload": _with([_ORDERS, _history(), _judged("history")], (
            "select table_database, table_schema, table_name, expectation_name, measurement_time, "
            f"{_PAYLOAD} as payload from statuses where violated")),
        "alerts_cooldown": _SENT,
        "extract_address": _on_orders(f"select order_id, shipping_address, {_PARTS} from raw_orders "
                                      "where shipping_address is not null"),
        "redact_address": _on_orders(f"select order_id, shipping_address as original_address, {_MASKED} "
                                     "as redacted_address from raw_orders where shipping_address is not null"),
        "address_preview": _on_orders(
            f"select order_id, shipping_address, {_PARTS}, {_MASKED} as redacted_address from raw_orders "
            "where shipping_address is not null order by order_id limit 10"),
        "enriched_orders": _on_orders(
            "select order_id, customer_id, order_total, order_date, region, shipping_address, "
            f"{_MASKED} as redacted_address, {_PARTS} from raw_orders"),
        "redact_documents": f"select doc_id, {_redacted('text')} as redacted_text from documents",
        "redact_counts": " union all ".join(
            f"select '{k}' as kind, count_if({_hits(k)} > 0)::bigint as texts, "
            f"{_big(f'coalesce(sum({_hits(k)}), 0)')} as hits from documents" for k in PERSONAL_DATA),
        "extract_pages": "select page_id, " + ", ".join(
            f"nullif(regexp_extract({source}, '{pattern}', 1), '') as {name}"
            for name, (source, pattern) in PAGE_FIELDS.items()) + " from pages",
        "redact_conversations": "select role, count(*) as turns, " + ", ".join(
            f"{_big(f'sum(coalesce({_hits(k)}, 0))')} as {k.lower()}_hits" for k in PERSONAL_DATA)
            + " from conversations group by role",
        "dedup_earliest": _on_validated("select * from deduped"),
        "hard_failures": _on_validated("select order_id, is_null_customer, is_negative_total from flagged"),
        "score_histogram": _on_validated(
            "select quality_score, count(*) as orders from validated group by quality_score order by quality_score"),
        "validated_orders": _on_validated("select * from validated"),
        "status_pct": _on_validated(
            "select quality_status, order_count, round(cast(order_count as double) * 100 "
            "/ cast(sum(order_count) over () as double), 1) as pct from (select quality_status, "
            "count(*) as order_count from validated group by quality_status) order by quality_status"),
        "region_status": _on_validated("select region, quality_status, count(*) as cnt from validated "
                                       "group by region, quality_status order by region, quality_status"),
        "semantic_overall": _semantic(),
        "semantic_region": _semantic("region"),
        "semantic_status": _semantic("status"),
        "semantic_quality": _semantic("quality_status"),
        "semantic_tier": _semantic("tier"),
        "semantic_grouping_sets": _semantic(
            "region", "tier", "cast(grouping(region) as int) as grouping_region",
            "cast(grouping(tier) as int) as grouping_tier",
            metrics=("total_orders", "rejected_count", "rejection_rate"),
            group="group by grouping sets ((region, tier), (region), (tier), ())"),
        "semantic_filtered": _semantic(
            "region", metrics=("total_orders", "clean_order_rate", "avg_quality_score"),
            where="tier in ('GOLD', 'PLATINUM') and status <> 'PENDING'"),
        "semantic_facts": _on_validated("select order_id, region, tier, order_total, quality_score from tiered"),
        "root_cause_region": _on_validated(
            "select *, row_number() over (order by rejection_rate desc, region) as rank from (select region, "
            "count(*) as total_orders, count_if(quality_status = 'REJECTED')::bigint as rejected_count, "
            "count_if(is_null_customer)::bigint as null_customer_count, "
            "count_if(is_negative_total)::bigint as negative_total_count, "
            f"{_per_hundred('count_if(is_rejected)', 'count(*)')} as rejection_rate, "
            f"{_per_hundred('count_if(is_null_customer)', 'count_if(is_rejected)')} as null_customer_share, "
            f"{_per_hundred('count_if(is_negative_total)', 'count_if(is_rejected)')} as negative_total_share, "
            "case when count_if(is_null_customer) >= count_if(is_negative_total) then 'null_customer' "
            "else 'negative_total' end as main_cause from judged group by region)"),
        "root_cause_flags": _flags(),
        "issues_by_region": _on_validated(" union all ".join(
            f"select region, '{i}' as issue, count_if(is_{i})::bigint as orders from judged group by region"
            for i in _ISSUES)),
        "west_vs_rest": _sides("validated", "region = 'WEST'", (
            "clean_order_rate", "rejection_rate", "avg_quality_score", "null_customer_rate")),
        "tier_vs_rest": _sides("tiered", "tier = 'GOLD'", (
            "total_orders", "clean_order_rate", "rejection_rate", "avg_quality_score")),
        "refresh_history": "select * from (values (1::bigint, 'shop.clean.validated_orders', 'SUCCEEDED', 1), "
                           "(2::bigint, 'shop.clean.validated_orders', 'SUCCEEDED', 1)) as v(position, name, state, attempt)",
    }
    queries["facts_by_tier"] = _facts("tier", "true", f"""n_late as late_shipments, {_per_hundred("n_late", "n_shipments")} as late_rate,
        n_shipments as total_shipments, n_rejected as rejected_count, n_orders as total_orders,
        round(cast(n_shipments as double) / nullif(cast(n_orders as double), 0), 3) as shipments_per_order, n_customers as customer_rows""", customers=True)
    queries["facts_filtered"] = _facts("region, tier", "quality_status <> 'REJECTED'",
                                       "n_late as late_shipments, n_untracked as untracked_count, n_orders as total_orders")
    queries["root_cause_slices"] = _slices(["region", "tier", "status"], "quality_status = 'REJECTED'", 20, 0.01, 1.05)
    queries["root_cause_address_slices"] = _slices(["region", "status", "quality_status", "tier"], "shipping_address is null", 50, 0.02, 1.0)
    queries["captured_changes"] = _on_updated(body=f"""
        select case when n > 0 then 'came' else 'went' end as kind, {_big("sum(abs(n))")} as copies, count(*) as different_rows
        from (select * exclude (v), sum(v) as n from (select *, 1 as v from raw_orders union all select *, -1 as v from raw_first) group by all)
        where n <> 0 group by 1""")
    changed = ("(select count(*) from (select * exclude (v), sum(v) as n from (select *, 1 as v from {1} union all "
               "select *, -1 as v from {0}) group by all) where n <> 0)")
    modes = " union all ".join(f"select {_big(i)} as batch_id, {changed.format(a, b)} as changed_rows" for i, a, b in (
        (0, "raw_first", "raw_orders"), (1, "raw_orders", "(select * replace (quantity + 1 as quantity) from raw_orders)")))
    queries["refresh_modes"] = _on_updated(body=f"""
        select batch_id, case when changed_rows > 0.5 * base_rows then 'FULL' else 'INCREMENTAL' end as refresh_mode, changed_rows, base_rows
        from ({modes}), (select count(distinct order_id) as base_rows from raw_first)""")
    queries["validated_after_updates"] = _on_updated(_CUSTOMERS, _VALIDATED, body="select * from validated")
    queries["metrics_after_updates"] = _on_updated(body=_measured("raw_orders", "orders", _ORDER_METRICS, AS_OF))
    updated = _on_updated(_CUSTOMERS.replace("raw_customers as", "first_customers as"), f"""raw_customers as (select * replace (
        case when customer_id like '%{shop.PROMOTED_CUSTOMERS}' and tier = 'SILVER' then 'GOLD' else tier end as tier)
        from first_customers where customer_id not like '%{shop.CLOSED_CUSTOMERS}')""", _VALIDATED, body="select {} from tiered {}")
    columns = ["region", "tier", *[f"cast(grouping({c}) as int) as grouping_{c}" for c in ("region", "tier")], *[f"{e} as {m}" for m, e in _METRICS.items()]]
    queries["semantic_after_updates"] = updated.format(
        ", ".join(columns), "where status <> 'PENDING' group by grouping sets ((region, tier), (region), (tier), ())")
    unit = f"case {draw_sql(shop.KEY_OF_ORDER, shop.SALT_OF_SPELLING, 8)} when 5 then ', Apt 4B' when 6 then ', #12' else '' end"
    queries["address_spellings"] = _on_orders(
        f"select order_id, {_part(1)} || {unit} as street, {_part(2)} as city, {_part(3)} as state, {_part(4)} as zip_code, true as zip_of_state "
        f"from raw_orders where {_part(2)} is not null")
    queries["stream_semantic"] = _semantic("tier", "quality_status")
    queries["stream_validated"] = queries["validated_orders"]
    queries["stream_metrics"] = queries["dq_orders_all"]
    queries["stream_alerts"] = queries["alerts_cooldown"]
    return queries
