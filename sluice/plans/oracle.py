"""DuckDB oracle SQL for the registered queries (same names, same column aliases).

The SQL is written independently of the Spark plans: it restates each
operator's semantics with plain windows, joins and aggregates over the
pre-registered driver tables.
"""

from __future__ import annotations

import hashlib

# The fixture bronze of FIXTURES.md §3.
BRONZE = """
bronze as (
 select l.l_orderkey*10+l.l_linenumber as sales_id,
  case when (l.l_orderkey*7+l.l_partkey)%10<3 then null else o.o_custkey end as client_id,
  case when (l.l_orderkey+l.l_partkey*3)%10<2 then null else l.l_partkey end as product_id,
  case when l.l_partkey%50=0 then null else c.c_mktsegment end as address,
  case when (l.l_orderkey+l.l_partkey)%10<4 then null else cast(o.o_orderdate as date) end as signup_date,
  p.p_name as product_name, p.p_type as category, p.p_retailprice as price,
  cast(l.l_shipdate as date) as date, cast(l.l_quantity as int)-2 as quantity,
  l.l_extendedprice as sale_amount, l.l_suppkey, l.l_linenumber
 from lineitem l join orders o on l.l_orderkey=o.o_orderkey
  join customer c on o.o_custkey=c.c_custkey join part p on l.l_partkey=p.p_partkey)"""

# Latest row per sales_id.
SALES_DEDUP = """
sales_dedup as (select * from (select *, row_number() over (partition by sales_id
   order by date desc nulls last, sale_amount desc nulls last, l_suppkey desc nulls last) rn from bronze) x where rn=1)"""

# The five sales rules, null counts as failure.
SALES_JUDGED = """
sales_judged as (select *,
  coalesce(client_id is not null, false) as r_client,
  coalesce(date between date '1995-06-01' and date '2001-06-01', false) as r_date,
  coalesce(product_id is not null, false) as r_product,
  coalesce(sales_id is not null, false) as r_sales,
  coalesce(quantity > 0, false) as r_quantity
 from sales_dedup)"""

SALES_REASONS = """concat_ws(',',
   case when not r_client then 'client_id_not_null' end,
   case when not r_date then 'dateWithinRange' end,
   case when not r_product then 'product_id_not_null' end,
   case when not r_sales then 'sales_id_not_null' end,
   case when not r_quantity then 'validQuantity' end)"""

SALES_OK = "(r_client and r_date and r_product and r_sales and r_quantity)"


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes)


ORACLE = {
    "quarantine_split": _with(BRONZE, SALES_DEDUP, SALES_JUDGED) + f"""
select sales_id, client_id, product_id, cast(date as varchar) as date, quantity, sale_amount,
  case when {SALES_OK} then 'valid' else 'quarantine' end as status,
  {SALES_REASONS} as reasons
from sales_judged""",
}

CLIENTS_DEDUP = """
clients_dedup as (select * from (select client_id, address, signup_date, row_number() over (partition by client_id
   order by date desc nulls last, sales_id desc nulls last, sale_amount desc nulls last, l_suppkey desc nulls last) rn
   from bronze) x where rn=1)"""

PRODUCTS_DEDUP = """
products_dedup as (select * from (select product_id, product_name, category, price, row_number() over (partition by product_id
   order by date desc nulls last, sales_id desc nulls last, sale_amount desc nulls last, l_suppkey desc nulls last) rn
   from bronze) x where rn=1)"""

ADDR_OK = "address in ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')"
DATE_OK = "date between date '1995-06-01' and date '2001-06-01'"


def _count_fail(pred: str) -> str:
    """Rows whose predicate is not TRUE."""
    return f"cast(count_if(not coalesce({pred}, false)) as bigint)"


ORACLE.update({
    "silver_sales": _with(BRONZE, SALES_DEDUP, SALES_JUDGED) + f"""
select sales_id, client_id, product_id, cast(date as varchar) as date, quantity, sale_amount
from sales_judged where {SALES_OK}""",

    "silver_clients": _with(BRONZE, CLIENTS_DEDUP) + f"""
select client_id, address, cast(signup_date as varchar) as signup_date from clients_dedup
where coalesce(client_id is not null, false) and coalesce({ADDR_OK}, false)""",

    "silver_products": _with(BRONZE, PRODUCTS_DEDUP) + """
select product_id, product_name, category, price from products_dedup where product_id is not null""",

    "rule_violations": _with(BRONZE, SALES_DEDUP) + f"""
select * from (
 select 'sales_id_not_null' as rule_name, {_count_fail('sales_id is not null')} as failed_rows from sales_dedup
 union all select 'client_id_not_null', {_count_fail('client_id is not null')} from sales_dedup
 union all select 'product_id_not_null', {_count_fail('product_id is not null')} from sales_dedup
 union all select 'dateWithinRange', {_count_fail(DATE_OK)} from sales_dedup
 union all select 'validQuantity', {_count_fail('quantity > 0')} from sales_dedup
 union all select 'validAddress', {_count_fail(ADDR_OK)} from sales_dedup)""",

    "quarantine_reasons": _with(BRONZE, SALES_DEDUP, SALES_JUDGED) + f"""
select {SALES_REASONS} as reasons, count(*) as n_rows, cast(sum(quantity) as bigint) as sum_quantity
from sales_judged where not {SALES_OK} group by 1""",

    "quality_metrics": _with(BRONZE, SALES_DEDUP, SALES_JUDGED) + f"""
select 'input_rows' as metric, count(*) as value from bronze
union all select 'deduped_rows', count(*) from sales_judged
union all select 'valid_rows', cast(count_if({SALES_OK}) as bigint) from sales_judged
union all select 'quarantined_rows', cast(count_if(not {SALES_OK}) as bigint) from sales_judged
union all select 'unknown_rows', cast(0 as bigint)""",

    "null_policy_split": _with(BRONZE, SALES_DEDUP) + f""",
raw as (select sales_id, client_id is not null as a, product_id is not null as b, sales_id is not null as c,
   ({DATE_OK}) as d, (quantity > 0) as e, ({ADDR_OK}) as f from sales_dedup),
flags as (select sales_id,
   (a is not true or b is not true or c is not true or d is not true or e is not true or f is not true) as any_not_true,
   (a is false or b is false or c is false or d is false or e is false or f is false) as any_false,
   (a is null or b is null or c is null or d is null or e is null or f is null) as any_null from raw)
select sales_id,
  case when any_not_true then 'quarantine' else 'valid' end as status_quarantine,
  case when any_false then 'quarantine' else 'valid' end as status_pass,
  case when any_false then 'quarantine' when any_null then 'unknown' else 'valid' end as status_drop
from flags""",

    "expect_metrics": _with(BRONZE) + f"""
select rule_name, action, cast(n - failed as bigint) as passed_rows, failed as failed_rows from (
 select 'valid_sales_id' as rule_name, 'drop' as action, {_count_fail('sales_id is not null')} as failed, count(*) as n from bronze
 union all select 'valid_client_id', 'drop', {_count_fail('client_id is not null')}, count(*) from bronze
 union all select 'valid_product_id', 'drop', {_count_fail('product_id is not null')}, count(*) from bronze
 union all select 'valid_quantity', 'warn', {_count_fail('quantity > 0')}, count(*) from bronze
 union all select 'valid_address', 'warn', {_count_fail(ADDR_OK)}, count(*) from bronze
 union all select 'valid_date', 'warn', {_count_fail(DATE_OK)}, count(*) from bronze)""",

    "expect_drop": _with(BRONZE) + """
select sales_id, client_id, product_id, quantity, cast(date as varchar) as date, l_suppkey from bronze
where sales_id is not null and client_id is not null and product_id is not null""",

    "expect_all_drop": _with(BRONZE) + f"""
select sales_id, client_id, product_id, quantity, cast(date as varchar) as date, l_suppkey from bronze
where sales_id is not null and client_id is not null and coalesce({DATE_OK}, false) and coalesce(quantity > 0, false)""",

    "rules_by_tag": _with(BRONZE) + f"""
select * from (
 select 'clients' as tag, 'address_valid_value' as name, {_count_fail(ADDR_OK)} as failed_rows from bronze
 union all select 'clients', 'client_id_not_null', {_count_fail('client_id is not null')} from bronze
 union all select 'products', 'product_id_not_null', {_count_fail('product_id is not null')} from bronze
 union all select 'sales', 'sales_id_not_null', {_count_fail('sales_id is not null')} from bronze
 union all select 'sales', 'client_id_not_null', {_count_fail('client_id is not null')} from bronze
 union all select 'sales', 'date_valid_range', {_count_fail(DATE_OK)} from bronze
 union all select 'sales', 'quantity_valid_value', {_count_fail('quantity > 0')} from bronze)""",

    "dedupe_latest": _with(BRONZE, SALES_DEDUP) + """
select sales_id, cast(date as varchar) as date, sale_amount, l_suppkey, quantity from sales_dedup""",

    "dedupe_rank_ties": _with(BRONZE) + """
select sales_id, cast(date as varchar) as date, sale_amount, l_suppkey from (
 select *, rank() over (partition by sales_id order by date desc nulls last) rk from bronze) x where rk = 1""",

    "dedupe_any_keys": _with(BRONZE) + """
select distinct client_id from bronze""",
})


def _documents_sql() -> str:
    """The rule documents as a DuckDB relation: JSON text -> unnest of statements -> regex
    normalisation (an independent restatement of A3/D1/D2)."""
    from ..sources.rules import FIXTURE_RULES, rule_documents
    docs = ", ".join("('" + d.replace("'", "''") + "')" for d in rule_documents(FIXTURE_RULES))
    return f"""
docs as (select * from (values {docs}) t(doc)),
stmts as (select json_extract_string(doc, '$.tableName') as tableName,
   unnest(json_extract_string(doc, '$.constraints[*]')) as statement from docs),
norm as (select tableName as table_name, statement,
   regexp_extract(statement, '(?i)ALTER\\s+COLUMN\\s+(\\w+)\\s+SET\\s+NOT\\s+NULL', 1) as nn,
   regexp_extract(statement, '(?i)ADD\\s+CONSTRAINT\\s+(\\w+)', 1) as cname,
   trim(regexp_extract(statement, '(?i)CHECK\\s*[(](.*)[)]\\s*;?\\s*$', 1)) as chk from stmts),
rules as (select table_name, statement,
   case when nn <> '' then 'not_null' when cname <> '' and chk <> '' then 'check' else 'unknown' end as kind,
   case when nn <> '' then nn || '_not_null' else cname end as name,
   case when nn <> '' then nn || ' IS NOT NULL' else chk end as expression from norm)"""


def _rule_counts(src: str, table: str, names_preds: list[tuple[str, str]]) -> str:
    parts = [f"select '{table}' as table_name, '{n}' as name, "
             f"cast(count_if(({p}) is false) as bigint) as failed_rows, "
             f"cast(count_if(({p}) is null) as bigint) as unknown_rows from {src}" for n, p in names_preds]
    return " union all ".join(parts)


_SALES_PREDS = [("client_id_not_null", "client_id is not null"), ("dateWithinRange", DATE_OK),
                ("product_id_not_null", "product_id is not null"), ("sales_id_not_null", "sales_id is not null"),
                ("validQuantity", "quantity > 0")]

ORACLE.update({
    "rules_explode": _with(BRONZE, _documents_sql()) + f""",
counts as (select 'client_id_not_null' as name, {_count_fail('client_id is not null')} as failed_rows from bronze
 union all select 'validAddress', {_count_fail(ADDR_OK)} from bronze
 union all select 'product_id_not_null', {_count_fail('product_id is not null')} from bronze
 union all select 'sales_id_not_null', {_count_fail('sales_id is not null')} from bronze
 union all select 'dateWithinRange', {_count_fail(DATE_OK)} from bronze
 union all select 'validQuantity', {_count_fail('quantity > 0')} from bronze)
select r.table_name as tableName, r.statement, c.failed_rows from rules r join counts c on r.name = c.name""",

    "rules_normalised": _with(BRONZE, SALES_DEDUP, CLIENTS_DEDUP, PRODUCTS_DEDUP, _documents_sql()) + f""",
counts as ({_rule_counts('sales_dedup', 'silver_sales', _SALES_PREDS)}
 union all {_rule_counts('clients_dedup', 'silver_clients', [('client_id_not_null', 'client_id is not null'), ('validAddress', ADDR_OK)])}
 union all {_rule_counts('products_dedup', 'silver_products', [('product_id_not_null', 'product_id is not null')])})
select r.table_name, r.kind, r.name, r.expression, c.failed_rows, c.unknown_rows
from rules r join counts c on r.table_name = c.table_name and r.name = c.name""",
})


def _sales_silver(name: str, where: str) -> str:
    return f"""
{name} as (select sales_id, client_id, product_id, date, quantity, sale_amount from (
  select *, row_number() over (partition by sales_id
    order by date desc nulls last, sale_amount desc nulls last, l_suppkey desc nulls last) rn
  from bronze where {where}) x
 where rn = 1 and client_id is not null and product_id is not null and sales_id is not null
   and coalesce({DATE_OK}, false) and coalesce(quantity > 0, false))"""


EVENTS_LATEST = """
latest as (select * from (select *, row_number() over (partition by user_id order by event_id desc) rn
   from events) x where rn = 1)"""

SCD2_DELETES = """
with e as (select user_id, event_type, event_id, event_type = 'error' as is_del,
   lag(event_type = 'error') over w as prev_del, lag(event_type) over w as prev_type,
   row_number() over w as pos
  from events window w as (partition by user_id order by event_id)),
k as (select * from e where not (pos > 1 and ((prev_del and is_del) or (not prev_del and not is_del and prev_type = event_type)))),
v as (select *, lead(event_id) over (partition by user_id order by event_id) as nxt from k)
select user_id, event_type, event_id as __start_at, nxt as __end_at from v where not is_del"""

ORACLE.update({
    "upsert_sales": _with(BRONZE, _sales_silver("t", "date < date '1998-08-01'"),
                          _sales_silver("s", "not (date < date '1998-08-01')")) + """
select sales_id, client_id, product_id, cast(date as varchar) as date, quantity, sale_amount
from t where not exists (select 1 from s where s.sales_id = t.sales_id)
union all
select sales_id, client_id, product_id, cast(date as varchar) as date, quantity, sale_amount from s""",

    "scd1_latest": _with(EVENTS_LATEST) + """
select user_id, event_type, value, cast(ts as varchar) as ts from latest""",

    "scd1_deletes": _with(EVENTS_LATEST) + """
select user_id, event_type, value, cast(ts as varchar) as ts from latest where event_type <> 'error'""",

    "scd2_history": """
with e as (select user_id, event_type, event_id, lag(event_type) over w as prev_type, row_number() over w as pos
  from events window w as (partition by user_id order by event_id)),
k as (select * from e where pos = 1 or prev_type <> event_type)
select user_id, event_type, event_id as __start_at,
  lead(event_id) over (partition by user_id order by event_id) as __end_at from k""",

    "scd2_current": """
with e as (select user_id, event_type, event_id, lag(event_type) over w as prev_type, row_number() over w as pos
  from events window w as (partition by user_id order by event_id)),
k as (select * from e where pos = 1 or prev_type <> event_type),
v as (select *, lead(event_id) over (partition by user_id order by event_id) as nxt from k)
select user_id, event_type, event_id as __start_at from v where nxt is null""",

    "scd2_deletes": SCD2_DELETES,
    "scd2_late": SCD2_DELETES,

    "change_feed": """
with v1 as (select o_orderkey, o_orderstatus, o_orderpriority, o_totalprice from orders
   where o_orderdate <= timestamp '2000-12-31 00:00:00'),
ret as (select l_orderkey, max(l_returnflag = 'R') as has_return from lineitem group by l_orderkey),
v2 as (select o.o_orderkey, o.o_orderstatus,
   case when coalesce(r.has_return, false) then '1-URGENT' else o.o_orderpriority end as o_orderpriority,
   o.o_totalprice from orders o left join ret r on o.o_orderkey = r.l_orderkey where o.o_orderstatus <> 'P')
select v2.*, 'insert' as _change_type from v2 where not exists (select 1 from v1 where v1.o_orderkey = v2.o_orderkey)
union all
select v1.*, 'delete' from v1 where not exists (select 1 from v2 where v1.o_orderkey = v2.o_orderkey)
union all
select v1.*, 'update_preimage' from v1 join v2 using (o_orderkey)
 where v1.o_orderstatus is distinct from v2.o_orderstatus or v1.o_orderpriority is distinct from v2.o_orderpriority
    or v1.o_totalprice is distinct from v2.o_totalprice
union all
select v2.*, 'update_postimage' from v1 join v2 using (o_orderkey)
 where v1.o_orderstatus is distinct from v2.o_orderstatus or v1.o_orderpriority is distinct from v2.o_orderpriority
    or v1.o_totalprice is distinct from v2.o_totalprice""",
})


# Events with planted nulls and zeros, a decimal and a date.
DIRTY_EVENTS = """(select event_id, case when event_id % 29 <> 0 then ts end as ts, case when event_id % 17 <> 0 then user_id end as user_id,
  case when event_id % 13 <> 0 then event_type end as event_type,
  case when event_id % 7 = 0 then null when event_id % 11 = 0 then 0.0 else value end as value, props,
  cast(event_id % 1000 as decimal(12,2)) as amount, cast(ts as date) as day from events)"""


def _profile_sql(table: str, cols: list[tuple[str, str]], window: str | None, modes: tuple[str, ...]) -> str:
    """Long profile by unpivoting with union all; ``cols`` = (name, kind): int, dec and dbl are numbers, str, ord
    (dates and timestamps as text) and other."""
    w = window or "cast(null as timestamp)"
    parts = []
    for c, kind in cols:
        num = f"cast({c} as double)" if kind in ("int", "dec", "dbl") else "cast(null as double)"
        dec = f"cast({c} as decimal(38,10))" if kind in ("int", "dec") else "cast(null as decimal(38,10))"
        order = f"cast({c} as varchar)" if kind in ("str", "ord") else "cast(null as varchar)"
        st = c if kind == "str" else "cast(null as varchar)"
        top = f"cast({c} as varchar)" if c in modes else "cast(null as varchar)"
        parts.append(f"select {w} as window_start, '{c}' as column_name, {num} as num, {dec} as dec, {order} as ord, {st} as str, "
                     f"{top} as top, cast({c} as varchar) as val from {table}")
    long = " union all ".join(parts)
    return f"""
with long as ({long}),
prof as (select window_start, column_name, count(*) as row_count, cast(count_if(val is null) as bigint) as num_nulls,
   cast(cast(count_if(val is null) / count(*) as float) as double) as percent_null, count(distinct val) as num_distinct,
   cast(sum(case when num = 0 then 1 else 0 end) as bigint) as num_zeros, min(num) as min, max(num) as max, cast(cast(avg(num) as float) as double) as avg,
   cast(cast(stddev_samp(num) as float) as double) as stddev, cast(cast(quantile_cont(num, 0.25) as float) as double) as p25, cast(cast(quantile_cont(num, 0.5) as float) as double) as p50, cast(cast(quantile_cont(num, 0.75) as float) as double) as p75,
   case when min(dec) is not null then rtrim(rtrim(cast(min(dec) as varchar), '0'), '.') else min(ord) end as min_value,
   case when max(dec) is not null then rtrim(rtrim(cast(max(dec) as varchar), '0'), '.') else max(ord) end as max_value,
   cast(min(length(str)) as integer) as min_length, cast(max(length(str)) as integer) as max_length,
   cast(cast(avg(length(str)) as float) as double) as avg_length
  from long group by window_start, column_name),
cnt as (select window_start, column_name, top, count(*) as c from long where top is not null
  group by window_start, column_name, top),
modes as (select window_start, column_name, top as mode from (select *, row_number() over
  (partition by window_start, column_name order by c desc, top asc) rn from cnt) x where rn = 1)
select p.* replace (case when p.column_name in ('value', 'o_totalprice') then null else min_value end as min_value,
  case when p.column_name in ('value', 'o_totalprice') then null else max_value end as max_value), m.mode from prof p left join modes m
 on p.window_start is not distinct from m.window_start and p.column_name = m.column_name"""


_EVENT_COLS = [("user_id", "int"), ("event_type", "str"), ("value", "dbl"), ("props", "str"), ("amount", "dec"), ("day", "ord")]
_EVENT_PROFILE = _profile_sql(DIRTY_EVENTS, _EVENT_COLS, "date_trunc('day', ts)", ("event_type",))
_REFRESHED = _profile_sql(f"(select * from {DIRTY_EVENTS} where ts is null or day(ts) % 10 <> 0)", _EVENT_COLS, "date_trunc('day', ts)", ("event_type",))
_PROFILE_COLS = ("column_name, row_count, num_nulls, percent_null, num_distinct, num_zeros, min, max, avg, "
                 "stddev, p25, p50, p75, min_value, max_value, min_length, max_length, avg_length, mode")

ORACLE.update({
    "profile_daily": f"select cast(window_start as varchar) as window_start, {_PROFILE_COLS} from ({_EVENT_PROFILE})",
    "profile_refresh": f"select cast(window_start as varchar) as window_start, {_PROFILE_COLS} from ({_REFRESHED})",
    "profile_snapshot": f"select {_PROFILE_COLS} from (" + _profile_sql(
        "orders", [("o_custkey", "int"), ("o_orderstatus", "str"), ("o_totalprice", "dbl"),
                   ("o_orderpriority", "str"), ("o_orderdate", "ord")], None, ("o_orderstatus", "o_orderpriority")) + ")",
})


_TWO_COLS = [("event_type", "str"), ("value", "dbl")]
_HOURS_EVERY_20_MINUTES = f"""(select *, unnest(case when ts is null then [cast(null as timestamp)] else
   [time_bucket(interval '20 minutes', ts), time_bucket(interval '20 minutes', ts) - interval '20 minutes',
    time_bucket(interval '20 minutes', ts) - interval '40 minutes'] end) as own from {DIRTY_EVENTS})"""
_SKETCHED = _profile_sql(f"(select * from {DIRTY_EVENTS} where ts is null or day(ts) % 10 <> 0)",
                         [("user_id", "int"), ("event_type", "str"), ("value", "dbl"), ("amount", "dec")], "date_trunc('day', ts)", ("event_type",))
ORACLE.update({
    "profile_quarter_hours": f"select cast(window_start as varchar) as window_start, {_PROFILE_COLS} from ("
                             + _profile_sql(DIRTY_EVENTS, _TWO_COLS, "time_bucket(interval '15 minutes', ts)", ("event_type",)) + ")",
    "profile_sliding": f"select cast(window_start as varchar) as window_start, {_PROFILE_COLS} from ("
                       + _profile_sql(_HOURS_EVERY_20_MINUTES, _TWO_COLS, "own", ("event_type",)) + ")",
    "profile_sketches": f"""select cast(window_start as varchar) as window_start, column_name, row_count, num_nulls, num_zeros, min, max, avg,
   stddev, mode, true as distinct_near, true as ranks_near from ({_SKETCHED})""",
})


def _draw(name: str, id_: str = "id") -> str:
    """The generator's integer draw of one column, restated: three multiplications modulo 2**31 - 1."""
    salt = int(hashlib.sha256(f"{name}|42".encode()).hexdigest()[:16], 16) % 2147483646 + 1
    step1 = f"((({id_} % 2147483647 + 2147483647 + {salt}) % 2147483647) * 48271 % 2147483647)"
    step2 = f"((xor({step1}, {step1} >> 13) + (({id_} // 2147483647) % 2147483647 + 2147483647) % 2147483647) % 2147483647 * 69621 % 2147483647)"
    return f"(xor({step2}, {step2} >> 16) * 16807 % 2147483647)"


def _unit(name: str) -> str:
    return f"(cast({_draw(name)} as double) / cast(2147483647 as double))"


_PEOPLE = f"""
  (['John', 'Jane', 'Alex', 'Chris', 'Katie', 'James', 'Sarah'])[{_draw('first_name')} % 7 + 1] as first_name,
  (['Smith', 'Doe', 'Johnson', 'Lee', 'Brown', 'Williams'])[{_draw('last_name')} % 6 + 1] as last_name,
  (['M', 'F'])[{_draw('gender')} % 2 + 1] as gender, cast(18 + {_draw('age')} % 63 as integer) as age"""
_GOODS = f"""
  (['Laptop', 'Phone', 'Tablet', 'Monitor', 'Keyboard', 'Mouse'])[{_draw('product_name')} % 6 + 1] as product_name,
  (['Electronics', 'Home', 'Toys', 'Clothing', 'Books'])[{_draw('category')} % 5 + 1] as category,
  round(10.0 + {_unit('price')} * 1990.0, 6) as price, cast(1 + {_draw('quantity')} % 10 as integer) as quantity,
  {_unit('sale_amount')} as u"""
_SYNTH_COLS = ("client_id, first_name, last_name, gender, age, first_name || '.' || last_name || '@example.com' as email, signup_date, address, "
               "product_id, product_name, category, price, date, sales_id, quantity, round(quantity * u * 200, 6) as sale_amount")


def _clean_rows(seeds: str) -> str:
    """16 columns of the clean load: 100 clients and 10 products in turn."""
    return f"""select {_SYNTH_COLS} from (select id % 100 as client_id, {_PEOPLE}, {_GOODS},
  cast(date '2020-01-01' + cast({_draw('signup_date')} % 1706 as integer) as varchar) as signup_date,
  (['New York', 'California', 'Texas', 'Florida', 'Illinois'])[{_draw('address')} % 5 + 1] as address, id % 10 as product_id,
  cast(date '2021-01-01' + cast({_draw('date')} % 1461 as integer) as varchar) as date, id as sales_id from ({seeds}))"""


def _dirty_rows(seeds: str, first_sales_id: str) -> str:
    """The dirty append: 30 / 40 / 20 percent null client_id / signup_date / product_id, one more state, ids that go on."""
    return f"""select {_SYNTH_COLS} from (select case when {_unit('client_id#null')} < 0.3 then null else id % 100 end as client_id, {_PEOPLE}, {_GOODS},
  case when {_unit('signup_date#null')} < 0.4 then null else cast(date '2020-01-01' + cast({_draw('signup_date')} % 1827 as integer) as varchar) end as signup_date,
  (['New York', 'California', 'Texas', 'Florida', 'Illinois', 'Washington'])[{_draw('address')} % 6 + 1] as address,
  case when {_unit('product_id#null')} < 0.2 then null else id % 10 end as product_id,
  cast(date '2024-01-01' + cast({_draw('date')} % 280 as integer) as varchar) as date, {first_sales_id} + id as sales_id from ({seeds}))"""


_ORDER_SEEDS = "select o_orderkey as id from orders"
ORACLE.update({
    "synth_bronze": _clean_rows(_ORDER_SEEDS),
    "synth_defects": _dirty_rows("select l_orderkey * 10 + l_linenumber as id from lineitem", "0"),
    "synth_append": _clean_rows(_ORDER_SEEDS) + " union all " + _dirty_rows("select event_id as id from events", "(select max(o_orderkey) + 1 from orders)"),
})


def _judged_part(name: str, where: str) -> str:
    return f"""
{name} as (select *, coalesce(client_id is not null, false) as r_client,
  coalesce({DATE_OK}, false) as r_date, coalesce(product_id is not null, false) as r_product,
  coalesce(sales_id is not null, false) as r_sales, coalesce(quantity > 0, false) as r_quantity
 from (select *, row_number() over (partition by sales_id
    order by date desc nulls last, sale_amount desc nulls last, l_suppkey desc nulls last) rn
  from bronze where {where}) x where rn = 1)"""


_EARLY = "date < date '1998-08-01'"
_LATE = "not (date < date '1998-08-01')"

ORACLE.update({
    "stream_split": ORACLE["upsert_sales"],
    "stream_quarantine": _with(BRONZE, _judged_part("e", _EARLY), _judged_part("l", _LATE)) + f"""
select sales_id, {SALES_REASONS} as reasons, cast(0 as bigint) as batch_id from e where not {SALES_OK}
union all
select sales_id, {SALES_REASONS} as reasons, cast(1 as bigint) as batch_id from l where not {SALES_OK}""",
    "stream_dedupe": _with(BRONZE) + f"""
select sales_id, cast(min(case when {_EARLY} then 0 else 1 end) as bigint) as batch_id, true as own_row
from bronze group by sales_id""",
})

ORACLE["silver_validate_first"] = _with(BRONZE) + f""",
judged_all as (select *, coalesce(client_id is not null, false) as r_client,
  coalesce({DATE_OK}, false) as r_date, coalesce(product_id is not null, false) as r_product,
  coalesce(sales_id is not null, false) as r_sales, coalesce(quantity > 0, false) as r_quantity from bronze),
ok as (select * from judged_all where {SALES_OK}),
bad as (select * from judged_all where not {SALES_OK}
  and not exists (select 1 from ok where ok.sales_id is not distinct from judged_all.sales_id)),
picked as (
  select *, 'valid' as status from (select *, row_number() over (partition by sales_id
    order by date desc nulls last, sale_amount desc nulls last, l_suppkey desc nulls last) rn2 from ok) x where rn2 = 1
  union all
  select *, 'quarantine' as status from (select *, row_number() over (partition by sales_id
    order by date desc nulls last, sale_amount desc nulls last, l_suppkey desc nulls last) rn2 from bad) y where rn2 = 1)
select sales_id, client_id, product_id, cast(date as varchar) as date, quantity, sale_amount, status,
  {SALES_REASONS} as reasons from picked"""


def _dim_part(name: str, cols: str, key: str, where: str) -> str:
    return f"""
{name} as (select {cols} from (select *, row_number() over (partition by {key}
   order by date desc nulls last, sales_id desc nulls last, sale_amount desc nulls last, l_suppkey desc nulls last) rn
   from bronze where {where}) x where rn = 1 and {key} is not null)"""


_PCOLS = "product_id, product_name, category"
_CCOLS = "client_id, address, signup_date"


def _detail(*cols: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '-')" for c in cols) + ") as detail"


def _merged(early: str, late: str, key: str) -> str:
    return f"(select * from {early} where not exists (select 1 from {late} l where l.{key} = {early}.{key}) union all select * from {late})"


ORACLE.update({
    "stream_multi_target": _with(
        BRONZE, _dim_part("pe", _PCOLS, "product_id", _EARLY), _dim_part("pl", _PCOLS, "product_id", _LATE),
        _dim_part("ce0", _CCOLS, "client_id", _EARLY), _dim_part("cl0", _CCOLS, "client_id", _LATE),
        f"ce as (select * from ce0 where coalesce({ADDR_OK}, false))", f"cl as (select * from cl0 where coalesce({ADDR_OK}, false))") + f"""
select 'products' as target, product_id as key, {_detail('product_name', 'category')} from {_merged('pe', 'pl', 'product_id')}
union all select 'clients', client_id, {_detail('address', 'signup_date')} from {_merged('ce', 'cl', 'client_id')}
union all select 'sales', sales_id, {_detail('date', 'client_id', 'product_id', 'quantity')} from ({ORACLE['upsert_sales']})""",
    "profile_hourly": f"select cast(window_start as varchar) as window_start, {_PROFILE_COLS} from (" + _profile_sql(
        DIRTY_EVENTS, [("event_type", "str"), ("value", "dbl")], "date_trunc('hour', ts)", ("event_type",)) + ")",
})

# Rows that the three drop expectations keep, and the order of a key's changes.
KEPT = "kept as (select * from bronze where sales_id is not null and client_id is not null and product_id is not null)"
_CHANGES = "order by date, sales_id, sale_amount, l_suppkey"


def _latest_kept(key: str, cols: str) -> str:
    return _with(BRONZE, KEPT) + f"""
select {cols} from (select *, row_number() over (partition by {key}
  order by date desc, sales_id desc, sale_amount desc, l_suppkey desc) as rn from kept) x where rn = 1"""


def _batch_metrics(batch: int, where: str) -> str:
    rules = [("valid_sales_id", "drop", "sales_id is not null"), ("valid_client_id", "drop", "client_id is not null"),
             ("valid_product_id", "drop", "product_id is not null"), ("valid_quantity", "warn", "quantity > 0"),
             ("valid_address", "warn", ADDR_OK), ("valid_date", "warn", DATE_OK)]
    return " union all ".join(
        f"select cast({batch} as bigint) as batch_id, '{n}' as rule_name, '{a}' as action, "
        f"cast(count(*) - {_count_fail(p)} as bigint) as passed_rows, {_count_fail(p)} as failed_rows from bronze where {where}" for n, a, p in rules)


ORACLE["scd2_ties"] = f"""
with hours as (select distinct user_id, date_trunc('hour', ts) as h, cast(floor(hour(ts) / 6) as integer) as phase from {DIRTY_EVENTS}),
seen as (select *, row_number() over w as rn, lag(phase) over w as before from hours window w as (partition by user_id order by h nulls first)),
starts as (select * from seen where rn = 1 or phase is distinct from before)
select user_id, phase, cast(h as varchar) as from_hour, cast(lead(h) over (partition by user_id order by h nulls first) as varchar) as to_hour from starts"""

ORACLE.update({
    "declarative_clients": _with(BRONZE, KEPT) + f""",
rows as (select client_id, address, date, sales_id, sale_amount, l_suppkey, row_number() over w as rn, lag(address) over w as before
  from kept window w as (partition by client_id {_CHANGES})),
starts as (select * from rows where rn = 1 or address is distinct from before)
select client_id, address, cast(date as varchar) as from_date, sales_id as from_sale,
  cast(lead(date) over w as varchar) as to_date, lead(sales_id) over w as to_sale
from starts window w as (partition by client_id {_CHANGES})""",
    "declarative_products": _latest_kept("product_id", "product_id, product_name, category, quantity"),
    "declarative_sales": _latest_kept("sales_id", "sales_id, client_id, quantity, cast(date as varchar) as date, true as stamped"),
    "declarative_metrics": _with(BRONZE) + f"""
{_batch_metrics(0, _EARLY)} union all {_batch_metrics(1, _LATE)}""",
    "violation_policies": _with(BRONZE, SALES_DEDUP) + f""",
raw as (select sales_id, client_id is not null as a, product_id is not null as b, sales_id is not null as c,
   ({DATE_OK}) as d, (quantity > 0) as e, ({ADDR_OK}) as f from sales_dedup)
select sales_id, (a is not true or b is not true or c is not true or d is not true or e is not true or f is not true) as violates_quarantine,
  (a is false or b is false or c is false or d is false or e is false or f is false) as violates_pass,
  not (a and b and c and d and e and f) as violates_drop,
  case when not (a and b and c and d and e and f) then 'quarantine' when a and b and c and d and e and f then 'valid' end as part
from raw""",
})

ORACLE["stream_scd2"] = SCD2_DELETES
ORACLE["stream_scd1"] = ORACLE["scd1_deletes"]
