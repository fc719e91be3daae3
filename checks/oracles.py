"""For each registered query the same result in SQL over the test tables."""

from __future__ import annotations

from vitrine.operators import quality
from vitrine.schemas import SHOPS

# Shared table expressions.

LISTINGS = """
listings as (
  select cast(l.l_partkey as varchar) as product_id, p.p_name as name, p.p_brand as brand,
    l.l_extendedprice / l.l_quantity * (1 - l.l_discount) as price, l.l_extendedprice / l.l_quantity as original_price,
    p.p_type as category, s.s_name as seller,
    case l.l_suppkey % 4 when 0 then 'amazon' when 1 then 'americanas' when 2 then 'kabum' else 'books' end as source,
    cast(1 + p.p_size % 5 as double) as rating, cast(l.l_linenumber as int) as reviews_count, l.l_shipdate as scraped_at,
    l.l_orderkey as seq_order, l.l_linenumber as seq_line, l.l_suppkey as seq_supp
  from lineitem l join part p on l.l_partkey = p.p_partkey join supplier s on l.l_suppkey = s.s_suppkey)"""

_RANK = "row_number() over (partition by {keys} order by scraped_at desc, seq_order desc, seq_line desc, seq_supp desc)"

PRODUCTS = LISTINGS + f""",
dim_products as (
  select product_id || '_' || source as id, product_id, name as product_name, brand, price, original_price,
    case when original_price > 0 and original_price > price
      then round((original_price - price) / original_price * 100, 2) else 0.0 end as discount_percentage,
    category, seller, cast(null as varchar) as image_url, cast(null as varchar) as url, source,
    case when price < 100 then 'Economico' when price < 500 then 'Medio' when price < 2000 then 'Premium'
      else 'Luxo' end as price_tier, scraped_at
  from (select *, {_RANK.format(keys='product_id, source')} as rn from listings
        where source <> 'books' and name is not null and price > 0) where rn = 1)"""

_LABEL = """case when rating is null then 'Sem avaliacao' when rating >= 4 then 'Excelente' when rating >= 3 then 'Bom'
  when rating >= 2 then 'Regular' else 'Ruim' end"""

BOOKS = f"""
category_avg as (select category, avg(price) as avg_category_price from listings
                 where source = 'books' and category is not null group by category),
dim_books as (
  select 'book_' || product_id as book_id, product_id, name as book_name, price, rating, {_LABEL} as rating_label,
    cast(null as varchar) as availability, cast(null as varchar) as image_url, cast(null as varchar) as url,
    category, source, scraped_at,
    case when avg_category_price > 0 then round((price - avg_category_price) / avg_category_price * 100, 2)
      else 0.0 end as price_vs_category
  from (select b.*, a.avg_category_price, {_RANK.format(keys='b.product_id')} as rn
        from listings b left join category_avg a on b.category = a.category where source = 'books') where rn = 1)"""

ALL = LISTINGS + """,
all_listings as (
  select product_id, name, price,
    case source when 'amazon' then 'Amazon' when 'americanas' then 'Americanas' when 'kabum' then 'KaBuM'
      else 'Books' end as source, scraped_at,
    case source when 'amazon' then 'Amazon' when 'kabum' then 'KaBuM' else category end as category,
    seq_order, seq_line, seq_supp
  from listings)"""

DROPS = """
drop_items as (
  select cast(l_partkey as varchar) as product_id, p_name as name, p_brand as brand, l_extendedprice as price,
    p_retailprice as original_price, p_type as category, 'Seller ' || l_suppkey as seller,
    case l_suppkey % 4 when 0 then 'amazon' when 1 then 'americanas' when 2 then 'kabum' else 'books' end as source,
    1 + p_size % 5 as rating, l_linenumber as reviews_count,
    make_timestamp(epoch_us(l_shipdate) + l_orderkey * 1000000 + l_linenumber * 1000 + l_suppkey) as scraped_at
  from lineitem join part on l_partkey = p_partkey)"""

ORDERS = """
stg_customers as (
  select c_custkey as customer_id, split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
    cast(null as varchar) as email, cast(null as varchar) as phone, n_name as city, r_name as state,
    cast(null as varchar) as created_at
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
stg_products as (
  select p_partkey as product_id, p_name as product_name, p_type as category, p_retailprice as price,
    p_size as stock_quantity, cast(null as varchar) as created_at from part),
stg_orders as (
  select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as order_date, o_orderstatus as status,
    o_totalprice as total_amount, cast(null as varchar) as shipping_address, cast(null as varchar) as created_at,
    cast(null as varchar) as updated_at
  from orders),
items as (
  select l_orderkey as order_id, l_partkey as product_id, l_quantity as quantity,
    l_extendedprice / l_quantity as unit_price from lineitem),
facts as (
  select o.order_id, customer_id, product_id, order_date, status, quantity, unit_price,
    quantity * unit_price as total_price, created_at
  from stg_orders o join items i on o.order_id = i.order_id),
customer_orders as (
  select customer_id, count(order_id) as total_orders, sum(total_price) as total_spent,
    min(order_date) as first_order_date, max(order_date) as last_order_date from facts group by customer_id),
product_sales as (
  select product_id, count(*) as times_sold, sum(quantity) as total_quantity_sold,
    sum(quantity * unit_price) as total_revenue from items group by product_id)"""

LINEAGE = """
lineage_rows as (
  select event_type as source_name, 'file' as source_type, 'raw' as target_schema,
    't' || cast(user_id % 4 as varchar) as target_table, 'load' as operation,
    cast(floor(value) as bigint) as record_count, ts as execution_time,
    case when event_type = 'error' then 'error' else 'success' end as status
  from events)"""

ORACLES: dict[str, str] = {}


def _with(*parts: str) -> str:
    return "with " + ",".join(parts) + "\n"


def _add(name: str, sql: str) -> None:
    ORACLES[name] = sql


# Marts and staging.

_add("dim_products_latest", _with(PRODUCTS) + "select * from dim_products")
_add("dim_products", _with(PRODUCTS) + "select * replace (" + ", ".join(
    f"case when source <> 'amazon' then {c} end as {c}" for c in ("brand", "category", "seller")) + ") from dim_products")
_add("prepared_sources", _with(LISTINGS) + """
select product_id, name as product_name, case when source <> 'amazon' then brand end as brand, price, original_price,
  case when source <> 'amazon' then category end as category, case when source <> 'amazon' then seller end as seller,
  cast(null as varchar) as image_url, cast(null as varchar) as url, source, scraped_at
from listings where source <> 'books'""")
_add("dim_books", _with(LISTINGS, BOOKS) + "select * from dim_books")
_STG = {
    "books": f"product_id, name, price, rating, category, source, scraped_at, {_LABEL} as rating_label",
    "amazon": "product_id, name, price, original_price, rating, cast(reviews_count as bigint) as reviews_count, source, scraped_at",
    "americanas": """product_id, name, brand, price, original_price as list_price,
      cast(reviews_count as bigint) as available_quantity, category, seller, source, scraped_at""",
    "kabum": """product_id, name, brand, price, original_price as old_price, cast(reviews_count as bigint) as stock,
      category, seller, rating, cast(reviews_count as bigint) as reviews_count, source, scraped_at""",
}
for _shop in SHOPS:
    _add(f"stg_{_shop}", _with(LISTINGS) + f"""select {_STG[_shop]}, seq_order, seq_line, seq_supp
from (select *, {_RANK.format(keys='product_id')} as rn from listings where source = '{_shop}') where rn = 1""")
_add("newest_per_key", _with(LISTINGS) + f"""select * exclude (rn) from (
  select *, {_RANK.format(keys='product_id, source')} as rn from listings) where rn = 1""")
_add("first_items", _with(LISTINGS) + """select * exclude (rn) from (
  select *, row_number() over (partition by product_id, source order by seq_order, seq_line, seq_supp, name) as rn
  from listings where seq_line <> 1) where rn = 1
union all select * replace (null as product_id) from listings where seq_line = 1""")
_add("category_avg_price", _with(LISTINGS, BOOKS) + "select * from category_avg")
_add("valid_listings", _with(LISTINGS) + """
select product_id, name as product_name, brand, price, original_price, category, seller,
  cast(null as varchar) as image_url, cast(null as varchar) as url, source, scraped_at
from listings where name is not null and price > 0""")

# Order branch.

for _name in ("stg_customers", "stg_products", "stg_orders"):
    _add(_name, _with(ORDERS) + f"select * from {_name}")
for _name in ("int_order_items", "fact_orders"):
    _add(_name, _with(ORDERS) + "select * from facts")
_add("customer_orders", _with(ORDERS) + "select * replace (round(total_spent, 2) as total_spent) from customer_orders")
_add("dim_customers", _with(ORDERS) + """
select c.customer_id, first_name, last_name, email, phone, city, state, coalesce(total_orders, 0) as total_orders,
  round(coalesce(total_spent, 0), 2) as total_spent, first_order_date, last_order_date,
  case when total_orders > 5 then 'VIP' when total_orders > 1 then 'Recorrente' else 'Novo' end as customer_segment
from stg_customers c left join customer_orders o on c.customer_id = o.customer_id""")
_add("product_sales", _with(ORDERS) + "select * replace (round(total_revenue, 2) as total_revenue) from product_sales")
_add("dim_product_sales", _with(ORDERS) + """
select p.product_id, product_name, category, price, stock_quantity, coalesce(times_sold, 0) as times_sold,
  coalesce(total_quantity_sold, 0) as total_quantity_sold, round(coalesce(total_revenue, 0), 2) as total_revenue
from stg_products p left join product_sales s on p.product_id = s.product_id""")

# Reports.

_add("source_tier_report", _with(PRODUCTS) + """
select source, price_tier, count(*) as count, round(avg(price), 2) as avg_price,
  round(avg(discount_percentage), 2) as avg_discount from dim_products group by source, price_tier""")
_add("price_by_source", _with(LISTINGS) + """
select source, count(*) as count, round(avg(price), 2) as avg_price, round(min(price), 2) as min_price,
  round(max(price), 2) as max_price from listings group by source""")
_add("books_by_category_source", _with(LISTINGS) + """
select category, source, count(*) as count, round(avg(price), 2) as avg_price, round(avg(rating), 2) as avg_rating
from listings where source = 'books' group by category, source""")
_add("filtered_price_by_source", _with(LISTINGS) + """
select source, round(avg(price), 2) as avg_price, count(*) as count from listings
where price > 0 and price < 2000 group by source""")
_add("row_count_overview", _with(PRODUCTS, BOOKS) + """
select 'raw.' || source as table_name, count(*) as n from listings group by source
union all select 'marts.dim_products', count(*) from dim_products
union all select 'marts.dim_books', count(*) from dim_books""")
_add("run_report", _with(PRODUCTS, BOOKS) + "select " + ", ".join(
    f"count(*) filter (source = '{s}') as raw_{s}" for s in SHOPS) + """,
  (select count(*) from dim_books) as dim_books, (select count(*) from dim_products) as dim_products,
  round(avg(price) filter (source = 'books'), 2) as avg_price_books from listings""")
_add("source_comparison", _with(LISTINGS) + """
select source, count(*) as count, round(avg(price), 2) as avg_price from listings
where source <> 'books' and price > 0 group by source""")
_add("ratings_comparison", _with(LISTINGS) + """
select source, case when source <> 'americanas' then round(avg(rating), 2) end as avg_rating, count(*) as review_count
from listings where source <> 'books' group by source""")
_add("all_listings", _with(ALL) + "select product_id, name, price, source, scraped_at, category from all_listings")
_add("distinct_sources", _with(ALL) + "select distinct source from all_listings")
_add("price_bounds", _with(ALL) + """select min(coalesce(price, 0)) as price_min, max(coalesce(price, 0)) as price_max
from all_listings""")
_add("filtered_listings", _with(ALL) + """select product_id, name, price, source, scraped_at, category from all_listings
where source in ('Books', 'KaBuM') and price between 1000 and 3000""")
_add("kpis", _with(ALL) + """select count(*) as total_products, round(avg(price), 6) as avg_price,
  min(price) as min_price, max(price) as max_price, count(distinct source) as active_sources,
  max(scraped_at) as last_scraped from all_listings""")


def _brl(cents: str) -> str:
    return (f"'R$ ' || replace(format('{{:,}}', ({cents}) // 100), ',', '.') || ',' || "
            f"lpad(cast(({cents}) % 100 as varchar), 2, '0')")


_add("kpi_texts", _with(ALL) + f"""select total_products, {_brl('a')} as avg_price, {_brl('lo')} as min_price,
  {_brl('hi')} as max_price, active_sources, last_scraped from (
  select count(*) as total_products, cast(round(avg(price) * 100) as bigint) as a,
    cast(round(min(price) * 100) as bigint) as lo, cast(round(max(price) * 100) as bigint) as hi,
    count(distinct source) as active_sources, max(scraped_at) as last_scraped from all_listings)""")
_add("volume_by_source", _with(ALL) + """select source, count(*) as products,
  round(count(*) / sum(count(*)) over (), 6) as share from all_listings group by source""")
_add("timeline", _with(ALL) + """select cast(scraped_at as date) as scraped_date, source, count(*) as count
from all_listings group by 1, 2""")
_add("price_stats_by_source", _with(ALL) + """select source, count(price) as count, round(avg(price), 2) as mean,
  round(median(price), 2) as median, round(min(price), 2) as min, round(max(price), 2) as max
from all_listings group by source""")
_add("price_box_stats", _with(ALL) + """,
box as (select source, count(price) as n, quantile_cont(price, 0.25) as q1, median(price) as median,
  quantile_cont(price, 0.75) as q3 from all_listings group by source)
select b.source, n, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
  round(min(price) filter (price >= q1 - 1.5 * (q3 - q1) and price <= q3 + 1.5 * (q3 - q1)), 6) as lower_whisker,
  round(max(price) filter (price >= q1 - 1.5 * (q3 - q1) and price <= q3 + 1.5 * (q3 - q1)), 6) as upper_whisker
from all_listings a join box b on a.source = b.source group by b.source, n, q1, median, q3""")
_add("price_histogram", _with(ALL) + """,
limits as (select min(price) as lo, max(price) as hi from all_listings)
select cast(least(floor((price - lo) / ((hi - lo) / 30)), 29) as int) as bin, count(*) as n,
  round(min(lo + (hi - lo) / 30 * least(floor((price - lo) / ((hi - lo) / 30)), 29)), 6) as bin_start,
  round(min(lo + (hi - lo) / 30 * (least(floor((price - lo) / ((hi - lo) / 30)), 29) + 1)), 6) as bin_end
from all_listings, limits group by 1""")
_add("avg_price_by_source", _with(ALL) + "select source, round(avg(price), 6) as price from all_listings group by source")
_add("top10_expensive", _with(ALL) + """select name, price, source from all_listings
order by price desc, seq_order desc, seq_line desc, seq_supp desc limit 10""")
_add("top10_categories", _with(ALL) + """select category, count(*) as count from all_listings
where category is not null group by category order by count desc, category limit 10""")
_add("top10_categories_price", _with(ALL) + """select category, round(avg(price), 6) as avg_price from all_listings
where category is not null group by category order by avg(price) desc, category limit 10""")
_add("price_sample", _with(ALL) + """select price, source from (select *, md5('42|' || product_id || '|' || source || '|' ||
  epoch_us(scraped_at) || '|' || seq_order || '|' || seq_line || '|' || seq_supp) as mixed from all_listings)
order by mixed limit 500""")
_add("category_source_matrix", _with(ALL) + "select category, " + ", ".join(
    f"round(coalesce(avg(price) filter (source = '{n}'), 0), 6) as \"{n}\""
    for n in ("Books", "Amazon", "Americanas", "KaBuM")) + " from all_listings group by category")
_add("currency_table", _with(DROPS) + f"""select product_id, name, source,
  strftime(scraped_at, '%Y-%m-%d %H:%M:%S.%f') as scraped_at, {_brl('cast(round(price * 100) as bigint)')} as price
from drop_items""")
_add("dashboard_tables", _with(ALL, PRODUCTS.replace(LISTINGS + ",", "")) + """
select 'listings' as table_name, count(*) as n from all_listings
union all select unnest(['kpis', 'volume', 'price_stats', 'price_box', 'avg_price', 'most_expensive']),
  unnest([1, 4, 4, 4, 4, 10])
union all select 'timeline', count(*) from (select distinct cast(scraped_at as date), source from all_listings)
union all select 'price_histogram', count(distinct least(floor((price - lo) / ((hi - lo) / 30)), 29))
  from all_listings, (select min(price) as lo, max(price) as hi from all_listings)
union all select 'sample', least(500, count(*)) from all_listings
union all select unnest(['largest_categories', 'dearest_categories']), least(10, count(distinct category))
  from all_listings
union all select 'category_matrix', count(distinct category) from all_listings
union all select 'raw_' || source || '_brl', count(*) from listings group by source""")

# Lineage.

_add("lineage_summary", _with(LINEAGE) + """select source_name, target_schema, target_table, operation,
  cast(sum(record_count) as bigint) as total_records, count(*) as executions, min(execution_time) as first_run,
  max(execution_time) as last_run, count(distinct status) as distinct_statuses
from lineage_rows group by all""")
_add("lineage_daily", _with(LINEAGE) + """select target_schema, target_table,
  cast(sum(record_count) as bigint) as total_records, count(*) as executions
from lineage_rows where cast(execution_time as date) = date '2024-01-15' group by all""")
_add("lineage_latest", _with(LINEAGE) + """select source_name, source_type, target_schema, target_table, operation,
  record_count, execution_time, status from lineage_rows
order by execution_time desc, source_name, target_schema, target_table, operation, record_count, status limit 100""")
_add("lineage_table", _with(LINEAGE) + "select * from lineage_rows")

# Merges.

_SIDES = LISTINGS + f""",
old as (select * exclude (rn) from (select *, {_RANK.format(keys='product_id, source')} as rn from listings
  where scraped_at < timestamp '1999-01-01') where rn = 1),
new as (select * exclude (rn) from (select *, {_RANK.format(keys='product_id, source')} as rn from listings
  where scraped_at >= timestamp '1999-01-01') where rn = 1)"""
_MERGED = ("name", "brand", "price", "original_price", "category", "rating", "reviews_count", "scraped_at")
_add("upsert_result", _with(_SIDES) + "select coalesce(n.product_id, o.product_id) as product_id, " + ", ".join(
    f"case when n.product_id is not null then n.{c} else o.{c} end as {c}" for c in _MERGED) + """,
  o.seller, coalesce(n.source, o.source) as source, o.seq_order, o.seq_line, o.seq_supp
from old o full join new n on o.product_id = n.product_id and o.source = n.source""")
_add("insert_only_result", _with(_SIDES) + """select n.* exclude (seller, seq_order, seq_line, seq_supp)
from new n anti join old o on o.product_id = n.product_id and o.source = n.source""")
_add("change_rows", _with(_SIDES) + """select 'raw.listings' as source_table, n.product_id || '|' || n.source as source_key,
  case when o.product_id is null then 'insert' else 'update' end as operation,
  timestamp '2024-01-31 06:00:00' as changed_at
from new n left join old o on o.product_id = n.product_id and o.source = n.source""")
_add("cdc_columns", _with(LISTINGS) + """select product_id, source, scraped_at,
  timestamp '2024-01-31 06:00:00' as updated_at, timestamp '2024-01-31 06:00:00' as _extract_ts,
  cast(null as timestamp) as deleted_at from listings""")

# Items.

_TITLE = "array_to_string([upper(x[1]) || lower(x[2:]) for x in string_split(p_name, ' ')], ' ')"
_CLEAN = f"""
base as (
  select l_linenumber as line, cast(l_partkey as varchar) as pid, {_TITLE} as title, p_type, l_extendedprice as amount,
    1 + p_size % 5 as stars, l_orderkey, l_suppkey,
    case l_suppkey % 4 when 0 then 'amazon' when 1 then 'americanas' when 2 then 'kabum' else 'books' end as shop,
    make_timestamp(epoch_us(l_shipdate) + l_orderkey * 1000000 + l_linenumber * 1000 + l_suppkey) as made
  from lineitem join part on l_partkey = p_partkey),
cleaned as (
  select case when line <> 2 then pid end as product_id, case when line = 3 then '' else title end as name,
    case p_type when 'STANDARD' then 'Eletronicos' when 'ECONOMY' then 'Casa e Decoração' when 'MEDIUM' then 'Moda'
      when 'LARGE' then 'Esportes' when 'SMALL' then 'Livros' else 'Mesa Posta' end as category,
    case line when 4 then null when 5 then 0.0 else amount end as price,
    case when stars <> 5 then cast(stars as int) end as rating,
    'https://' || shop || '.example.org/list' as source,
    case when line <> 6 then strftime(made, '%Y-%m-%d %H:%M:%S.%f') else '2024-01-31T06:00:00' end as scraped_at
  from base),
reasons as (
  select *, case when product_id is null or name = '' or coalesce(price, 0) = 0 then 'missing: ' || concat_ws(', ',
      case when product_id is null then 'product_id' end, case when name = '' then 'name' end,
      case when coalesce(price, 0) = 0 then 'price' end) end as reject_reason
  from cleaned)"""
_ITEM = "product_id, name, category, price, rating, source, scraped_at"
_add("clean_items", _with(_CLEAN) + f"select {_ITEM} from cleaned")
_add("valid_items", _with(_CLEAN) + f"select {_ITEM} from reasons where reject_reason is null")
_add("rejected_items", _with(_CLEAN) + """select product_id, name, price, reject_reason from reasons
where reject_reason is not null""")
_add("item_chain", _with(_CLEAN) + f"""select {_ITEM} from (select *, row_number() over (
  partition by product_id, source order by price, scraped_at, name, category, rating) as rn
  from reasons where reject_reason is null) where rn = 1""")

# Scalar functions.

_LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
_add("scalar_prices", f"""select {_LINE}, c / 100.0 as brazilian, c / 100.0 as american, c / 100.0 as comma,
  c / 100.0 as unsigned, cast(null as double) as two_points, c / 100.0 as br_only, c / 100.0 as pounds,
  c / 100.0 as reais, cast(null as double) as reais_bad, c / 100.0 as "numeric", cast(null as double) as numeric_bad
from (select *, cast(round(l_extendedprice * 100) as double) as c from lineitem)""")
_add("scalar_ratings", f"""select {_LINE}, l_linenumber + 0.5::double as rating, cast(null as double) as no_rating,
  cast(l_linenumber as bigint) * 1001 as reviews, cast(null as bigint) as no_reviews,
  case when l_linenumber < 6 then cast(l_linenumber as int) end as word,
  case l_linenumber when 1 then 'One' when 2 then 'Two' when 3 then 'Three' when 4 then 'Four' when 5 then 'Five'
    when 6 then '6.7' else 'none' end as css_word from lineitem""")
_add("scalar_texts", f"""select p_partkey, p_name as collapsed, '' as nothing, {_TITLE} || ' 15Pro D''Agua' as title,
  case when p_type = 'PROMO' then 'Casa e Decoração' else upper(p_type[1]) || lower(p_type[2:]) end as category,
  'https://x.example.org/' || p_partkey as address, md5(p_partkey || ':' || p_brand) as item_key,
  cast(p_partkey as varchar) as href_id, 'MLB' || p_partkey as market_id, '' as no_market_id,
  'book_' || p_partkey as book_id, p_partkey || '_' || p_brand as listing_id from part""")
_add("scalar_dates", f"""select {_LINE}, strftime(l_shipdate, '%Y-%m-%dT00:00:00') as iso_day,
  strftime(l_shipdate, '%Y-%m-%dT00:00:00') as br_day, strftime(l_shipdate, '%Y-%m-%dT10:30:00') as iso_time,
  cast(null as varchar) as bad, l_shipdate as stamp, cast(null as timestamp) as bad_stamp,
  cast(l_shipdate as date) as "day" from lineitem""")
_add("scalar_labels", f"""select {_LINE},
  case when l_linenumber = 7 then 'Sem avaliacao' when l_linenumber >= 5 then 'Excelente'
    when l_linenumber = 4 then 'Bom' when l_linenumber = 3 then 'Regular' else 'Ruim' end as rating_label,
  case when price / 20 < 100 then 'Economico' when price / 20 < 500 then 'Medio' when price / 20 < 2000 then 'Premium'
    else 'Luxo' end as price_tier,
  case when l_linenumber > 5 then 'VIP' when l_linenumber > 1 then 'Recorrente' else 'Novo' end as segment,
  case when l_extendedprice > price then round((l_extendedprice - price) / l_extendedprice * 100, 2) else 0.0
    end as discount,
  cast(round((1 - price / l_extendedprice) * 100) as int) as whole_discount,
  round((l_quantity - 25) / 25 * 100, 2) as against_average, l_quantity * l_tax as line_total,
  case when l_linenumber = 7 then 0.0 else l_linenumber - 1.0::double end as rating_or_zero,
  {_brl('cast(round(l_extendedprice * 100) as bigint)')} as currency
from (select *, l_extendedprice * (1 - l_discount) as price from lineitem)""")

# Extraction.

_LINES = """
lines as (
  select l_orderkey as seq_order, l_linenumber as seq_line, l_suppkey as seq_supp, cast(l_partkey as varchar) as id,
    p_name as name, p_brand as brand, p_type as type, p_size as size, l_extendedprice as price,
    p_retailprice as list_price, cast(l_quantity as int) as quantity, cast(round(l_extendedprice * 100) as bigint) as cents,
    cast(round(p_retailprice * 100) as bigint) as list_cents
  from lineitem join part on l_partkey = p_partkey)"""
_SEQ = "seq_order, seq_line, seq_supp"
_VTEX = """ || id as product_id, name, brand, {price} as price, list_price_ as list_price, {quantity} as available_quantity,
  type || '/Sub' as category, {image} as image_url,
  'https://www.americanas.com.br/' || replace(name, ' ', '-') || '/p' as url, {seller} as seller, 'americanas' as source
from lines where seq_line <> 7"""
_add("vtex_listings", _with(_LINES) + "\nunion all ".join(
    f"select {_SEQ}, {pos} as pos, '{prefix}'" + _VTEX.format(price=price, quantity=quantity, image=image, seller=seller)
    .replace("list_price_", listed) for pos, prefix, price, listed, quantity, image, seller in (
        (0, "", "price", "list_price", "quantity", "'https://img.example.org/' || id", "'Seller ' || seq_supp"),
        (1, "b", "list_price", "list_price", "quantity", "''", "'Other'"),
        (2, "c", "0.0", "0.0", "0", "''", "''"))))
_add("kabum_listings", _with(_LINES) + f"""
select {_SEQ}, 0 as pos, id as product_id, name, brand, price, list_price as old_price,
  seq_line as discount_percentage, quantity as stock, type as category, 'https://img.example.org/' || id as image_url,
  'https://www.kabum.com.br/produto/' || id as url, 'Seller ' || seq_supp as seller, 1.5 + size % 5 as rating,
  size as reviews_count, 'kabum' as source from lines
union all
select {_SEQ}, 1 as pos, id, upper(name), '', list_price, list_price, seq_line, quantity, '',
  'https://img.example.org/' || id, '', 'KaBuM', 1.5 + size % 5, size, 'kabum' from lines""")
_add("book_page_listings", _with(_LINES.replace("p_name as name", f"p_name as name, {_TITLE} as title")) + f"""
select {_SEQ}, 0 as pos, id as product_id, title as name, cents / 100.0 as price,
  ['One', 'Two', 'Three', 'Four', 'Five'][1 + size % 5] as rating, 'In stock' as availability,
  'media/' || id || '.jpg' as image_url,
  'catalogue/' || replace(name, ' ', '-') || '_' || id || '/index.html' as url, 'Livros' as category,
  'https://books.example.org/page-' || seq_line || '.html' as source from lines""")
_add("amazon_page_listings", _with(_LINES) + f"""
select {_SEQ}, 0 as pos, id as product_id, name, cents / 100.0 as price, list_cents / 100.0 as original_price,
  size % 5 + 0.5::double as rating, cast(1000 + size as bigint) as reviews_count, 'i/' || id || '.jpg' as image_url,
  '/dp/' || id as url, 'amazon.com.br' as source from lines""")
_add("market_page_listings", _with(_LINES) + f"""
select {_SEQ}, 0 as pos, 'MLB' || id as product_id, name, p as price, o as original_price, 'Novo' as condition,
  cast(size as bigint) as sold_quantity, 'https://p.example.org/MLB-' || id || '-x' as permalink,
  seq_line % 2 = 1 as shipping_free, 'mercadolivre' as source,
  cast(round_even((1 - p / o) * 100, 0) as int) as discount_percentage
from (select *, cast(cents // 100 as double) as p, cast(list_cents // 100 as double) as o from lines) where seq_line <> 7""")
_add("card_page_listings", _with(_LINES) + f"""
select {_SEQ}, 0 as pos, id as product_id, name, cents / 100.0 as price, 'promo' as category,
  'Marca & tipo: ' || brand as description, 'i/' || id || '.jpg' as image_url, '/product/' || id as url,
  'https://shop.example.org/products?page=' || seq_line as source from lines""")
_add("detail_page_listings", _with(_LINES) + f"""
select {_SEQ}, 0 as pos, id as product_id, name, cents / 100.0 as price, type as category, brand as description,
  'g/' || id || '.jpg' as image_url, 'https://shop.example.org/p/' || id as url,
  'https://shop.example.org/product/' || id as source from lines""")
_HREF = """'<li><a href="([^"]*)">([^<]*)</a></li>'"""
_add("configured_listings", f"""select page_id, pos - 1 as pos, names[pos] as name, links[pos] as link,
  cast(null as double) as price
from (select page_id, regexp_extract_all(html, {_HREF}, 2) as names, regexp_extract_all(html, {_HREF}, 1) as links,
        unnest(generate_series(1, len(regexp_extract_all(html, {_HREF})))) as pos from pages)""")
_add("page_titles", r"""select page_id, replace(trim(regexp_replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '\s+', ' ',
  'g')), '&amp;', '&') as name, cast(null as varchar) as product_id, cast(null as double) as price, url as source
from pages""")
_add("html_links", f"""select page_id, pos - 1 as pos, links[pos] as href,
  regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || links[pos] as link
from (select page_id, url, regexp_extract_all(html, {_HREF}, 1) as links,
        unnest(generate_series(1, len(regexp_extract_all(html, {_HREF})))) as pos from pages)""")
_add("product_page_links", """select l_orderkey as page_id, i as pos, '../product/' || l_partkey || '/' || i as href,
  'https://shop.example.org/a/product/' || l_partkey || '/' || i as link
from lineitem, (select unnest(generate_series(0, 11)) as i)""")
_add("next_page_links", """select l_orderkey as page_id, 'page-' || (l_linenumber + 1) || '.html' as href,
  'https://books.example.org/page-' || (l_linenumber + 1) || '.html' as link from lineitem""")
_add("capped_listings", _with(LISTINGS) + """select source, category, product_id, seq_order, seq_line, seq_supp from (
  select *, row_number() over (partition by source, category order by seq_order, seq_line, seq_supp, product_id) as rn
  from listings) where rn <= 100""")

# Files and tables.

_add("json_drop_files", _with(DROPS) + """select product_id, name, brand, cast(price as decimal(10,2)) as price, category,
  seller, cast(rating as decimal(3,1)) as rating, cast(reviews_count as int) as reviews_count, source, scraped_at
from drop_items""")
_add("parquet_drop_files", _with(DROPS) + """select product_id, name, cast(price as decimal(10,2)) as price,
  cast(original_price as decimal(10,2)) as original_price, cast(rating as decimal(3,1)) as rating,
  cast(reviews_count as int) as reviews_count, source, scraped_at from drop_items""")
for _name in ("csv_export", "json_export"):
    _add(_name, _with(LISTINGS) + "select product_id, name, brand, price, source, scraped_at from listings")
_NEWEST_DROP = DROPS + """,
newest as (select * exclude (rn) from (select *, row_number() over (partition by product_id, source
  order by scraped_at desc) as rn from drop_items) where rn = 1)"""
_add("raw_load_tables", _with(_NEWEST_DROP) + """select product_id, name, price,
  case when source <> 'americanas' then cast(rating as double) end as rating, source, scraped_at,
  timestamp '2024-01-31 06:00:00' as _extract_ts from newest""")
_add("daily_run_products", _with(_NEWEST_DROP) + """
select product_id || '_' || source as id, name as product_name, case when source <> 'amazon' then brand end as brand,
  price, original_price, case when original_price > price
    then round((original_price - price) / original_price * 100, 2) else 0.0 end as discount_percentage,
  case when source <> 'amazon' then category end as category, case when source <> 'amazon' then seller end as seller,
  source, case when price < 100 then 'Economico' when price < 500 then 'Medio' when price < 2000 then 'Premium'
    else 'Luxo' end as price_tier, scraped_at
from newest where source <> 'books'""")

# Checks.

_STAGED = ",\n".join(f"""stg_{s} as (select * from (
  select *, {_RANK.format(keys='product_id')} as rn from listings where source = '{s}') where rn = 1)""" for s in SHOPS)
_CHECKED = _with(PRODUCTS, BOOKS, _STAGED, LINEAGE)
_SOURCES = {**{f"raw.{s}": f"(select * from listings where source = '{s}')" for s in SHOPS},
            **{f"staging.stg_{s}": f"stg_{s}" for s in SHOPS}, "marts.dim_books": "dim_books",
            "marts.dim_products": "dim_products", "lineage.data_lineage": "lineage_rows"}


def _row(stage: str, test: str, count: str, passes: str, message: str) -> str:
    return (f"select '{stage}' as stage, '{test}' as test, case when n {passes} then 'PASS' else 'FAIL' end as status, "
            f"{message} as message from ({count})")


def _nulls(stage, test, table, column):
    return _row(stage, test, f"select count(*) as n from {_SOURCES[table]} where {column} is null", "= 0",
                f"'{table}.{column}: ' || n || ' nulos'")


def _unique(stage, table, column):
    base = table.split(".")[1]
    return _row(stage, f"load_unique_{base}_{column}", "select coalesce(sum(c), 0) as n from (select count(*) as c from "
                f"{_SOURCES[table]} group by {column} having count(*) > 1)", "= 0",
                f"'{table}.{column}: ' || n || ' duplicatas'")


def _rows(stage, table, least):
    return _row(stage, f"{stage}_rowcount_{table.split('.')[1]}", f"select count(*) as n from {_SOURCES[table]}",
                f">= {least}", f"'{table} tem ' || n || ' registros (minimo: {least})'")


def _columns(stage, prefix, shop):
    n = {"books": 13, "amazon": 14, "americanas": 16, "kabum": 18}[shop]
    return (f"select '{stage}' as stage, '{prefix}_{shop}' as test, 'PASS' as status, "
            f"'raw.{shop}: {n} colunas' as message")


_suite = [_columns("extract", "extract_schema", s) for s in SHOPS]
_suite += [_row("extract", f"extract_notempty_{s}", f"select count(*) as n from {_SOURCES[f'raw.{s}']}", "> 0",
                f"'raw.{s} (' || n || ' registros)'") for s in SHOPS]
_suite += [_nulls("transform", f"transform_null_stg_{s}_{c}", f"staging.stg_{s}", c)
           for s in SHOPS for c in ("product_id", "name")]
_suite += [_row("transform", "transform_dedup_stg_books_product_id", "select count(*) as n from (select product_id from "
                "stg_books group by product_id having count(*) > 1)", "= 0",
                "'staging.stg_books: ' || n || ' duplicatas em product_id'"), _rows("transform", "staging.stg_books", 0)]
_suite += [_unique("load", "marts.dim_books", "book_id"), _unique("load", "marts.dim_products", "id"),
           _nulls("load", "load_notnull_dim_books_book_name", "marts.dim_books", "book_name"),
           _nulls("load", "load_notnull_dim_products_product_name", "marts.dim_products", "product_name"),
           _rows("load", "marts.dim_books", 0), _rows("load", "marts.dim_products", 0)]
_suite += [_columns("cdc", "cdc", s) for s in SHOPS]
_suite += [_row("lineage", "lineage_exists", "select count(*) as n from lineage_rows", "> 0",
                "'lineage.data_lineage tem ' || n || ' registros'")]
_add("quality_suite", _CHECKED + "\nunion all ".join(_suite))

_marts = [_nulls("staging", f"staging_notnull_stg_{s}_name", f"staging.stg_{s}", "name") for s in SHOPS]
for _table, _key, _text in (("dim_books", "book_id", "book_name"), ("dim_products", "id", "product_name")):
    _marts += [_unique("marts", f"marts.{_table}", _key),
               _nulls("marts", f"marts_notnull_{_table}_{_text}", f"marts.{_table}", _text),
               _row("marts", f"positive_{_table}_price", f"select count(*) as n from {_table} where price < 0", "= 0",
                    f"'marts.{_table}.price: ' || n || ' negativos'"), _rows("marts", f"marts.{_table}", 100)]
for _column, _valid in (("source", quality.MART_SOURCES), ("price_tier", quality.MART_TIERS)):
    _marts.append(_row("marts", f"value_in_set_dim_products_{_column}", f"select count(*) as n from dim_products where "
                       f"coalesce({_column} not in {_valid}, true)", "= 0",
                       f"'marts.dim_products.{_column}: ' || n || ' invalidos'"))
_add("mart_quality_suite", _CHECKED + "\nunion all ".join(_marts))

_DUP = "(select product_id, count(*) as c from listings group by product_id having count(*) > 1)"
_found = [
    _row("extract", "extract_rowcount_listings", "select count(*) as n from listings", ">= 1000",
         "'listings tem ' || n || ' registros (minimo: 1000)'"),
    _row("load", "load_notnull_listings_seller", "select count(*) as n from listings where seller is null", "= 0",
         "'listings.seller: ' || n || ' nulos'"),
    _row("transform", "transform_dedup_listings_product_id", f"select count(*) as n from {_DUP}", "= 0",
         "'listings: ' || n || ' duplicatas em product_id'"),
    _row("load", "load_unique_listings_product_id", f"select coalesce(sum(c), 0) as n from {_DUP}", "= 0",
         "'listings.product_id: ' || n || ' duplicatas'"),
    _row("load", "positive_listings_price", "select count(*) as n from listings where price < 0", "= 0",
         "'listings.price: ' || n || ' negativos'"),
    _row("transform", "transform_dtype_listings_name", "select count(*) as n from listings where name is not null and "
         "try_cast(name as double) is null", "= 0", "'listings.name: ' || n || ' valores nao numericos'"),
    _row("transform", "transform_dtype_listings_product_id", "select count(*) as n from listings where product_id is not "
         "null and try_cast(product_id as double) is null", "= 0",
         "'listings.product_id: ' || n || ' valores nao numericos'"),
    _row("load", "value_in_set_listings_source", "select count(*) as n from listings where source not in "
         "('amazon', 'americanas', 'kabum')", "= 0", "'listings.source: ' || n || ' invalidos'"),
    _row("load", "load_fk_items_order_id", "select count(*) as n from items i anti join stg_orders o "
         "on i.order_id = o.order_id", "= 0", "'items.order_id: ' || n || ' chaves invalidas'"),
    "select 'extract' as stage, 'extract_rowcount_missing_table' as test, 'FAIL' as status, "
    "'missing_table nao existe' as message",
]


def _key(table, source, column):
    return _row("load", f"key_{table}", f"select count(*) as n from (select {column} from {source} group by {column} "
                "having count(*) > 1)", "= 0", f"'raw.{table}: ' || n || ' chaves repetidas'")


def _fk(table, source, column, parent):
    return _row("load", f"load_fk_{table}_{column}", f"select count(*) as n from {source} c anti join {parent} p "
                f"on c.{column} = p.{column}", "= 0", f"'raw.{table}.{column}: ' || n || ' chaves invalidas'")


def _length(table, source, column, limit):
    return _row("load", f"length_{table}_{column}", f"select count(*) as n from {source} where len({column}) > {limit}",
                "= 0", f"'raw.{table}.{column}: ' || n || ' textos longos demais'")


_add("definition_checks", _with(ORDERS) + "\nunion all ".join(
    [_key("customers", "stg_customers", "customer_id"), _key("products", "stg_products", "product_id"),
     _key("orders", "stg_orders", "order_id"), _key("order_items", "items", "order_id"),
     _fk("orders", "stg_orders", "customer_id", "stg_customers"), _fk("order_items", "items", "order_id", "stg_orders"),
     _fk("order_items", "items", "product_id", "stg_products"), _length("products", "(select *, product_name as name from "
     "stg_products)", "name", 255), _length("products", "stg_products", "category", 100),
     _length("orders", "stg_orders", "status", 50)]
    + [_length("customers", "stg_customers", c, n) for c, n in dict(
        first_name=100, last_name=100, email=255, phone=20, city=100, state=50).items()]))
_FOUND = _with(LISTINGS, ORDERS, "\nresults as (" + "\nunion all ".join(_found) + ")")
_add("snapshot_checks", _FOUND + "select * from results")
_add("failed_checks", _FOUND + "select stage, test from results where status = 'FAIL'")
_add("check_pass_count", _FOUND + """select count(*) filter (status = 'PASS') as passed, count(*) as total,
  bool_and(status = 'PASS') as all_passed from results""")
_add("duplicate_keys", _with(LISTINGS) + f"select count(*) as n, cast(coalesce(sum(c), 0) as bigint) as n_rows from {_DUP}")
_add("orphan_keys", _with(ORDERS) + """select i.order_id, count(*) as n from items i anti join (
  select order_id from stg_orders where status = 'F') o on i.order_id = o.order_id group by i.order_id""")
_add("freshness", _with(LISTINGS) + """select max(scraped_at) as last_scraped,
  cast(epoch_us(timestamp '2002-01-01') - epoch_us(max(scraped_at)) as double) / 3600000000 as hours from listings""")
_add("latest_scrapes", _with(LISTINGS) + "select source, max(scraped_at) as last_scraped from listings group by source")

_health = []
for _shop in ("books", "amazon", "americanas"):
    _t = f"raw.{_shop}"
    _health.append(f"""select unnest(['exists', 'not_empty', 'freshness', 'min_rows']) as k, '{_t}' as t, n, h from (
      select count(*) as n, cast(epoch_us(timestamp '2002-01-01') - epoch_us(max(scraped_at)) as double) / 3600000000 as h
      from listings where source = '{_shop}')""")
_HEALTH = _with(PRODUCTS, BOOKS, "\nfacts_raw as (" + "\nunion all ".join(_health) + ")", """
results as (
  select replace(t, '.', '_') || '_' || k as "check", case k when 'exists' then true when 'not_empty' then n > 0
      when 'freshness' then h <= 48 else n >= 10 end as passed,
    case when k = 'freshness' and h > 48 then 'Dados de ' || t || ' estao ' || format('{:.1f}', h) || 'h atrasados (max: 48h)'
      end as message from facts_raw
  union all select 'raw_kabum_' || unnest(['exists', 'not_empty', 'freshness', 'min_rows']), false,
    'Tabela raw.kabum nao existe'
  union all select unnest(['dim_products_exists', 'dim_products_not_empty', 'dim_products_unique_id', 'dim_books_exists',
    'dim_books_not_empty', 'dim_books_unique_id']), true, null)""")
_add("health_checks", _HEALTH + 'select "check", passed, message from results')
_add("health_alerts", _HEALTH + """select 'WARNING' as level, message, '2002-01-01T00:00:00' as timestamp from results
where not passed""")
_add("health_summary", _HEALTH + """select p as passed, t as total, case when p = t then 'healthy'
  when p >= t * 0.8 then 'degraded' else 'unhealthy' end as status
from (select count(*) filter (passed) as p, count(*) as t from results)""")

_any = [(f"staging.stg_{s}", f"stg_{s}", 24, 100) for s in SHOPS] + [("marts.dim_products", "dim_products", 100000, 10000000)]
_any = "\nunion all ".join(f"""select unnest(['exists', 'not_empty', 'freshness', 'min_rows']) as k, '{t}' as t, n, h,
  {hours} as most, {least} as least from (select count(*) as n,
    cast(epoch_us(timestamp '2002-01-01') - epoch_us(max(scraped_at)) as double) / 3600000000 as h from {source})"""
                           for t, source, hours, least in _any)
_add("health_of_any_table", _with(PRODUCTS, BOOKS, _STAGED, f"\nfacts_any as ({_any})", """
results as (
  select replace(t, '.', '_') || '_' || k as "check", case k when 'exists' then true when 'not_empty' then n > 0
      when 'freshness' then coalesce(h <= most, false) else n >= least end as passed,
    case k when 'not_empty' then 'Tabela ' || t || ' esta vazia'
      when 'freshness' then coalesce('Dados de ' || t || ' estao ' || format('{:.1f}', h) || 'h atrasados (max: ' || most || 'h)',
        'Tabela ' || t || ' sem dados de scraped_at')
      else 'Tabela ' || t || ' tem apenas ' || n || ' linhas (minimo: ' || least || ')' end as message from facts_any
  union all select unnest(['stg_books_exists', 'stg_books_not_empty', 'stg_books_unique_id']), unnest([true, n > 0, d = 0]),
    unnest(['', 'Tabela staging.stg_books esta vazia', 'Tabela staging.stg_books tem ' || d || ' duplicatas em product_id'])
  from (select coalesce(sum(c), 0) as n, count(*) filter (c > 1) as d from (select count(*) as c from stg_books group by product_id)))""")
     + """select "check", passed, case when not passed then message end as message from results""")

_STAGES = [_row("extract", f"extract_notempty_{s}", f"select count(*) as n from newest where source = '{s}'", "> 0",
                f"'raw.{s} (' || n || ' registros)'") for s in SHOPS]
# The loaded tables have fewer columns than the rows the suite above reads.
_STAGES += [f"select 'extract' as stage, 'cdc_{s}' as test, 'PASS' as status, 'raw.{s}: {n} colunas' as message"
            for s, n in dict(books=13, amazon=13, americanas=15, kabum=18).items()]
_STAGES += [_row("transform", "transform_rowcount_stg_books", "select count(*) as n from newest where source = 'books'", ">= 0",
                 "'staging.stg_books tem ' || n || ' registros (minimo: 0)'"),
            _row("transform", "transform_dedup_stg_books_product_id", "select count(*) as n from (select product_id from newest "
                 "where source = 'books' group by product_id having count(*) > 1)", "= 0",
                 "'staging.stg_books: ' || n || ' duplicatas em product_id'")]
_STAGES += [_row("transform", f"transform_null_stg_books_{c}", f"select count(*) as n from newest where source = 'books' and {c} is null",
                 "= 0", f"'staging.stg_books.{c}: ' || n || ' nulos'") for c in ("product_id", "name")]
for _table, _key_name, _text, _of in (("dim_books", "book_id", "book_name", "="), ("dim_products", "id", "product_name", "<>")):
    _STAGES += [_row("load", f"load_unique_{_table}_{_key_name}", f"select coalesce(sum(c), 0) as n from (select count(*) as c from newest "
                     f"where source {_of} 'books' group by product_id, source having count(*) > 1)", "= 0",
                     f"'marts.{_table}.{_key_name}: ' || n || ' duplicatas'"),
                _row("load", f"load_notnull_{_table}_{_text}", f"select count(*) as n from newest where source {_of} 'books' and name is null",
                     "= 0", f"'marts.{_table}.{_text}: ' || n || ' nulos'")]
_STAGES += [_row("load", "load_rowcount_dim_books", "select count(*) as n from newest where source = 'books'", ">= 0",
                 "'marts.dim_books tem ' || n || ' registros (minimo: 0)'"),
            "select 'load' as stage, 'lineage_exists' as test, 'PASS' as status, null as message"]
_add("stage_check_rows", _with(_NEWEST_DROP) + "\nunion all ".join(_STAGES))

# Streams.

_add("stream_all_shops", _with(_NEWEST_DROP) + "select product_id, name, price, source, scraped_at from newest")
_add("stream_daily_volume", """select date_trunc('day', ts) as scraped_date, event_type as source, count(*) as count
from events group by all""")
_add("stream_first_seen", """select distinct cast(user_id as varchar) as product_id, event_type as source from events""")
_add("stream_raw_load", _with(_NEWEST_DROP) + """select product_id, name, price, cast(rating as bigint) as rating, source,
  scraped_at from newest where source = 'books'""")
