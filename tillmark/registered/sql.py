"""The same results in plain SQL for DuckDB, computed from numbers rather than texts."""

from __future__ import annotations

from tillmark.plans.marts import DAILY_COLUMNS
from tillmark.sources.feeds import FEEDS

_OBS = """obs as (
  select l.*, p.*, coalesce(l_returnflag = 'R' and l_quantity = 50, false) as gone,
         cast(floor(l_extendedprice * 10 / l_quantity) as bigint) as cents,
         cast(floor(l_extendedprice * 10 / l_quantity) as bigint) // (4 * p_size) as unit_cents,
         (['Aldi', 'Coles', 'IGA', 'Woolworths'])[(l_suppkey % 4) + 1] as retailer,
         date '2021-04-23' + cast(datediff('day', date '1995-01-01', cast(l_shipdate as date)) % 28 as int) as day
  from lineitem l join part p on l_partkey = p_partkey)"""

_NO_UNIT = "p_size in (25, 50)"
_UNIT_COLUMNS = f"""
  case when {_NO_UNIT} then null else unit_cents / 100.0::double end as unit_price_value,
  case when {_NO_UNIT} then null else
    (['per_100g', 'per_each', 'per_100ml', 'per_l', 'per_kg', 'per_250g'])[p_size % 6 + 1] end as unit_price_measure,
  case when {_NO_UNIT} then null when p_size % 6 in (0, 2) then unit_cents / 10.0::double
       when p_size % 6 = 5 then unit_cents / 25.0::double else unit_cents / 100.0::double end as norm_unit_price,
  case when {_NO_UNIT} then null else
    (['per_kg', 'per_each', 'per_l', 'per_l', 'per_kg', 'per_kg'])[p_size % 6 + 1] end as norm_unit_measure"""
_PRICE = "case when gone then null else cents / 100.0::double end"
_CAP = "upper(left({0}, 1)) || substr({0}, 2)"
_WORD1 = _CAP.format("split_part(p_name, ' ', 1)")
_WORD2 = _CAP.format("split_part(p_name, ' ', 2)")
_BRAND = f"case when p_size % 2 = 0 then {_WORD1} else {_WORD1} || ' ' || {_WORD2} end"
_NAME = (
    f"case when p_size % 2 = 0 then {_CAP.format('p_name')} else {_WORD1} || ' ' || {_WORD2} end || ' ' || p_size || 'pk'"
)
_PACKAGE = "case when p_size % 2 = 0 then p_size || ' pack' else p_size || 'L' end"
_UNIT_SIZE = "case p_size % 3 when 0 then 'each' when 1 then p_size || 'L' else p_size || '0g' end"
_URL = "'https://shop.example/p/' || l_partkey"


def _by_type(medium, standard, large, promo, small, economy):
    names = ("MEDIUM", "STANDARD", "LARGE", "PROMO", "SMALL", "ECONOMY")
    texts = (medium, standard, large, promo, small, economy)
    cases = [f"when '{n}' then {_text(t)}" for n, t in zip(names, texts)]
    return f"case p_type {' '.join(cases)} end"


def _text(value):
    return "null" if value is None else "'" + value.replace("'", "''") + "'"


_FV, _HB = "Fruit & Vegetables", "Health & Beauty"
_FEEDS = {
    "Aldi": {
        "source_sku": f"left(md5('aldi|' || lower({_NAME}) || '|' || lower({_URL})), 16)",
        "product_name": _NAME,
        "brand": _BRAND,
        "previous": "null",
        "size": "null",
        "special": "false",
        "availability": "'unknown'",
        "ratings": "null",
        "supplier": "null",
        "main": _by_type("Dairy Eggs & Fridge", _HB, "Household", "Frozen", "Mystery-Dept", "Pantry"),
        "sub": "null",
        "l1": _by_type("Fresh Food", _HB, "Household", "Frozen", "Mystery-Dept", "Pantry"),
        "l2": _by_type("Dairy, Eggs & Fridge", _HB, "Household", "Frozen", "Mystery-Dept", "Pantry"),
        "keep": "true",
    },
    "Coles": {
        "source_sku": "l_partkey::varchar",
        "product_name": "p_name",
        "brand": "p_brand",
        "previous": "cents / 100.0::double",
        "size": _UNIT_SIZE,
        "special": "l_discount > 0.07::double",
        "availability": "case when gone then 'unavailable' else 'available' end",
        "ratings": "null",
        "supplier": "case when l_suppkey % 5 = 0 then 'unknown' else l_suppkey || ' CARTER & CO' end",
        "main": _by_type("Fruit Vegetables", "Health Beauty", "Laundry", "Liquor", "720488 L'Oreal P/L", "Other"),
        "sub": "null",
        "l1": _by_type("Fresh Food", _HB, "Household", None, "Other", "Other"),
        "l2": _by_type(_FV, _HB, "Laundry", None, "Other", "Other"),
        "keep": "p_type <> 'PROMO'",
    },
    "IGA": {
        "source_sku": "l_partkey::varchar",
        "product_name": "p_name || ' ' || p_size || 'g'",
        "brand": "split_part(p_name, ' ', 1)",
        "previous": "null",
        "size": "null",
        "special": "false",
        "availability": "'unknown'",
        "ratings": "null",
        "supplier": "null",
        "main": _by_type("Groceries", "Groceries", "Household", "Frozen", "Big Deals", "Pet"),
        "sub": _by_type("fruit", "health", "unheard of", None, None, "pet"),
        "l1": _by_type("Fresh Food", _HB, "Household", "Frozen", "Big Deals", "Pet"),
        "l2": _by_type(_FV, "Health", "Household", "Frozen", "Big Deals", "Pet"),
        "keep": "true",
    },
    "Woolworths": {
        "source_sku": "l_partkey::varchar",
        "product_name": "p_name",
        "brand": "p_brand",
        "previous": "null",
        "size": _PACKAGE,
        "special": "l_discount > 0.07::double",
        "availability": "case when gone then 'unavailable' else 'available' end",
        "ratings": "p_size % 5 + 0.5::double",
        "supplier": "null",
        "main": _by_type("Meat Seafood & Deli", "Pantry", None, "NOT LISTED", "Bakery", "Baby"),
        "sub": "null",
        "l1": _by_type("Fresh Food", "Pantry", None, "Not Listed", "Fresh Food", "Baby"),
        "l2": _by_type("Meat & Seafood", "Pantry", None, "Not Listed", "Bakery", "Baby"),
        "keep": "p_type <> 'LARGE'",
    },
}


def _feed_sql(retailer: str, rows: str = "true") -> str:
    f = _FEEDS[retailer]
    return f"""select '{retailer}' as retailer, {f["source_sku"]} as source_sku, {f["product_name"]} as product_name,
  {f["brand"]} as brand, {_PRICE} as price_aud, cast({f["previous"]} as double) as previous_price_aud, {_UNIT_COLUMNS},
  cast({f["size"]} as varchar) as package_size_raw, {f["special"]} as on_special, {f["availability"]} as availability,
  cast({f["ratings"]} as double) as ratings, cast({f["supplier"]} as varchar) as primary_supplier,
  {f["main"]} as raw_main_category, cast({f["sub"]} as varchar) as raw_sub_category,
  {f["l1"]} as canonical_l1, {f["l2"]} as canonical_l2, {_URL} as product_url,
  concat_ws(' ', {f["brand"]}, {f["product_name"]}, cast({f["size"]} as varchar)) as brand_product_size,
  day as snapshot_date, '{retailer}/date=' || day as _source_file
  from obs where {rows} and {f["keep"]}"""


_UNION = " union all ".join(_feed_sql(retailer, f"retailer = '{retailer}'") for retailer in _FEEDS)

_VERDICT = """case
  when retailer is null or retailer not in ('Aldi', 'Coles', 'IGA', 'Woolworths') then 'drop|invalid_retailer:''' || retailer || ''''
  when product_name is null or trim(product_name) = '' then 'drop|missing_product_name'
  when price_aud is null and availability <> 'unavailable' then 'drop|null_price_for_available_item'
  when price_aud <= 0 then 'drop|non_positive_price:' || price_aud::varchar
  when price_aud > 1000 then 'quarantine|price_out_of_range:' || price_aud::varchar
  when unit_price_value > 0 and (price_aud / unit_price_value > 100 or price_aud / unit_price_value < 0.01::double)
    then 'quarantine|price_unit_mismatch:ratio=' || printf('%.1f', price_aud / unit_price_value)
  when price_aud is null then 'quarantine|unavailable_no_price'
  else 'pass|' end"""


def _judged(rows: str) -> str:
    return f"""judged as (select *, split_part(verdict, '|', 1) as dq_action,
      nullif(substr(verdict, strpos(verdict, '|') + 1), '') as dq_reason
    from (select *, {_VERDICT} as verdict from {rows}))"""


_FACT_COLUMNS = """* exclude (verdict), dq_action = 'quarantine' as is_quarantined,
      md5(concat_ws('|', retailer, source_sku)) as product_sk, md5(concat_ws('|', canonical_l1, canonical_l2)) as category_sk"""

_PLAIN = """plain as (select retailer, l_partkey::varchar as source_sku, p_name as product_name, p_brand as brand,
    case when gone then null else cents / 100.0::double end as price_aud, cast(null as double) as previous_price_aud,
    unit_cents / 100.0::double as unit_price_value, 'per_100g' as unit_price_measure,
    case when p_size % 7 > 0 then unit_cents / 10.0::double end as norm_unit_price,
    case when p_size % 7 > 0 then (['per_kg', 'per_l', 'per_each'])[p_size % 3 + 1] end as norm_unit_measure,
    case when l_discount > 0.05::double then '1L' else '2L' end as package_size_raw,
    l_discount > 0.07::double as on_special,
    case when gone then 'unavailable' when l_linestatus = 'O' then 'available' else 'unknown' end as availability,
    p_size / 10.0::double as ratings, cast(null as varchar) as primary_supplier, p_type as raw_main_category,
    cast(null as varchar) as raw_sub_category, p_type as canonical_l1, p_type || ' ' || (p_size % 5) as canonical_l2,
    'https://shop.example/p/' || l_partkey as product_url, p_brand || ' ' || p_name as brand_product_size,
    day as snapshot_date, retailer || '/date=' || day as _source_file from obs)"""
_FACT = f"""with {_OBS}, {_PLAIN}, {_judged("plain")},
  fact as (select {_FACT_COLUMNS} from judged where dq_action <> 'drop')"""

_DAILY_TIES = sorted(
    name
    for name in (*DAILY_COLUMNS, "_source_file")
    if name
    not in (
        "product_sk", "snapshot_date", "price_aud", "retailer_sk", "date_sk", "prev_day_price", "price_change_pct",
    )
)
_DAILY_ORDER = ", ".join(f"{name} nulls first" for name in ("snapshot_date", "price_aud", *_DAILY_TIES))


def _daily(fact: str, source: str) -> str:
    return f"""{fact}, lagged as (
    select *, lag(price_aud) over (partition by product_sk order by {_DAILY_ORDER}) as prev_day_price
    from {source} where not is_quarantined),
  daily as (select {", ".join(c for c in DAILY_COLUMNS if c not in ("retailer_sk", "date_sk", "price_change_pct"))},
    md5(retailer) as retailer_sk, cast(strftime(snapshot_date, '%Y%m%d') as int) as date_sk,
    case when prev_day_price <> 0 then round((price_aud - prev_day_price) / prev_day_price * 100, 2) end as price_change_pct
    from lagged)"""


_DAILY = _daily(_FACT, "fact")
_CROWDED_FACT = f"""{_FACT}, one_key as (select * replace (
    case when source_sku::bigint % 2 = 1 then product_sk end as product_sk,
    case when source_sku::bigint % 10 = 0 then null when source_sku::bigint % 50 = 2 then date '1999-01-01'
      else snapshot_date end as snapshot_date) from fact),
  crowded as (select * from one_key union all select * from one_key where source_sku::bigint % 4 = 0)"""

# mean of values with four decimals, half up to cents, in whole numbers
_MEAN = """((2 * sum(cast(round(norm_unit_price * 10000) as hugeint)) + 100 * count(*)) // (200 * count(*))) / 100.0::double"""


def _pct(part: str, whole: str) -> str:
    return f"round({part} / {whole}::double * 100, 2)"


def _islands(source: str, key: str, seq: str, tracked: str, columns: str) -> str:
    changed = " or ".join(f"lag({c}) over w is distinct from {c}" for c in tracked.split(", "))
    return f"""marked as (select *, case when row_number() over w = 1 or {changed} then 1 else 0 end as opens
      from {source} window w as (partition by {key} order by {seq})),
    numbered as (select *, sum(opens) over (partition by {key} order by {seq}) as island from marked),
    spans as (select *, min({seq}) over (partition by {key}, island) as "__START_AT",
      row_number() over (partition by {key}, island order by {seq} desc) as back from numbered)
    select {columns}, "__START_AT",
      lead("__START_AT") over (partition by {key} order by island) as "__END_AT" from spans where back = 1"""


_PRODUCT_KEPT = (
    "retailer", "source_sku", "product_name", "brand", "unit_price_value", "unit_price_measure",
    "norm_unit_price", "norm_unit_measure", "package_size_raw", "ratings", "primary_supplier",
    "raw_main_category", "raw_sub_category", "canonical_l1", "canonical_l2", "product_url",
    "brand_product_size", "category_sk",
)
_PRODUCT_BEST = ", ".join(f"{name} desc nulls last" for name in ("_source_file", *_PRODUCT_KEPT))
_PRODUCT_TRACKED = "product_name, brand, package_size_raw, canonical_l1, canonical_l2"

_UNCHECKED = f"""with {_OBS}, unchecked as (select l_orderkey, l_linenumber,
    case when l_suppkey % 50 = 0 then 'Costco' else retailer end as retailer,
    case when p_size = 13 then ' ' when p_size = 14 then '' else p_name end as product_name,
    case when gone then null when l_quantity = 49 then 0.0::double else cents / 100.0::double end as price_aud,
    case when gone and l_linenumber < 5 then 'unavailable' else 'available' end as availability,
    unit_cents / 100.0::double as unit_price_value from obs)"""

_SLUG = _by_type("fresh product", "beauty", "laundry household", "freezer", "mystery-dept", "pantry")
_NAMES = """with names as (select o_custkey % 6 as mark, o_orderkey % 11 = 0 as undated,
    strftime(o_orderdate, '%Y-%m-%d') as stamp, '/in/' || (o_custkey % 3) || '/' ||
    case when o_orderkey % 11 = 0 then '' else strftime(o_orderdate, '%Y-%m-%d') end ||
    ([' ALDI', ' Coles', ' iga', ' WOW', ' Woolworths', ' shop'])[(o_custkey % 6) + 1] || ' Data ' || o_orderkey || '.csv'
      as source from orders),
  placed as (select *, 'raw/' || retailer || '/date=' || "date" || '/' || retailer || '_' || "date" || '.csv' as target
    from (select source, (['aldi', 'coles', 'iga', 'woolworths', 'woolworths', null])[mark + 1] as retailer,
      case when not undated then stamp end as "date" from names))"""

_RUNS = f"""{_NAMES},
  runs as (select *, (source like '%7.csv' or source like '/in/1/%')::bigint as batch from placed),
  winners as (select batch, target, max(source) as source from runs where target is not null group by all)"""

EVENT_HISTORY = "with " + _islands("events", "user_id", "ts", "event_type", "event_id, ts, user_id, event_type")

# no time comes before every other one
_NO_TIME = "timestamp '0001-01-01'"
_CROWDED_HISTORY = f"""select event_id, nullif(ts, {_NO_TIME}) as ts, user_id, event_type,
    nullif("__START_AT", {_NO_TIME}) as "__START_AT", "__END_AT" from (
  with crowded as (select event_id, event_type, case when event_id % 2 = 1 then user_id end as user_id,
      case when event_id % 97 = 0 then {_NO_TIME} when event_id % 1000 < 3 then ts - interval 20 years else ts end as ts
      from events),
    best as (select * from (select *, row_number() over (
      partition by user_id, ts order by event_id desc, event_type desc) as pick from crowded) where pick = 1),
    {_islands("best", "user_id", "ts", "event_type", "event_id, ts, user_id, event_type")})"""

# Types of the feeds' columns as they are spelled; "sku" depends on the part numbers.
_NUMBERS = {
    ("Coles", "SKU"): "sku", ("Coles", "Previous Price"): "double", ("Coles", "On Special"): "boolean", ("IGA", "SKU"): "double",
    ("Woolworths", "SKU"): "sku", ("Woolworths", "Ratings"): "double",
}
_COLUMN_TYPES = [
    (feed.retailer, header, _NUMBERS.get((feed.retailer, header), "string")) for feed in FEEDS for header in feed.headers if header != "Date"
]
_EXPECTATIONS = (
    ("valid_retailer", "drop", "retailer in ('Aldi', 'Coles', 'IGA', 'Woolworths')"),
    ("has_product_name", "drop", "product_name <> ''"),
    ("price_present_or_unavailable", "warn", "(price_aud is not null or availability = 'unavailable')"),
)

SQL = {
    "unit_price_normalised": f"with {_OBS} select l_orderkey, l_linenumber, {_UNIT_COLUMNS} from obs",
    "price_text_clean": f"with {_OBS} select l_orderkey, l_linenumber, {_PRICE} as price_aud from obs",
    "supplier_list_first": """select l_orderkey, l_linenumber, case when l_suppkey % 5 = 0 then 0 else 2 end as n_suppliers,
        case when l_suppkey % 5 > 0 then l_partkey || ' COSTA''S P/L' end as second_supplier,
        case when l_suppkey % 5 = 0 then 'unknown' else l_suppkey || ' CARTER & CO' end as primary_supplier
        from lineitem""",
    "primary_department": f"select p_partkey, {_FEEDS['Woolworths']['main']} as department from part",
    "canonical_category": f"""select p_partkey,
        {_by_type("Medium", "Standard", "Other", "Soft Drinks", "Big Deals", "Economy")} as label,
        case p_type when 'LARGE' then p_size || 'Er Set' when 'MEDIUM' then 'Frozen'
          else upper(left(p_type, 1)) || lower(substr(p_type, 2)) end as slug_label,
        {_by_type("Fresh Food", "Standard", "Other", "Drinks", "Big Deals", "Economy")} as canonical_l1,
        {_by_type(_FV, "Standard", "Other", "Soft Drinks", "Big Deals", "Economy")} as canonical_l2,
        {_by_type("Frozen", "Standard", "Other", "Promo", "Small", "Economy")} as slug_l1,
        {_by_type("Frozen", "Standard", "Other", "Promo", "Small", "Economy")} as slug_l2 from part""",
    "label_cleanup": f"""select p_partkey, {_PACKAGE} as package_size, {_UNIT_SIZE} as unit_size,
        p_name || ' ' || p_size || 'g' as product_name, p_partkey::varchar as source_sku from part""",
    "brand_and_match_key": f"""select p_partkey, {_BRAND} as brand,
        concat_ws(' ', {_BRAND}, {_NAME}, case when p_size % 2 = 0 then p_size || 'pk' else p_size || 'l' end)
          as brand_product_size from part""",
    "surrogate_sku": """select p_partkey, source_sku, md5('Aldi|' || source_sku) as product_sk,
        md5(p_type || '|' || p_brand) as category_sk from (select *, left(md5('aldi|' || p_name || '|' ||
          case when p_size > 5 then 'https://shop.example/p/' || p_partkey else '' end), 16) as source_sku from part)""",
    "availability_special_flags": """select l_orderkey, l_linenumber, case l_returnflag when 'R' then 'available'
        when 'A' then 'unavailable' else 'unknown' end as availability, l_discount > 0.07::double as on_special
        from lineitem""",
    "conform_feed_a": f"with {_OBS} {_feed_sql('Aldi')}",
    "conform_feed_b": f"with {_OBS} {_feed_sql('Coles')}",
    "conform_feed_c": f"with {_OBS} {_feed_sql('IGA')}",
    "conform_feed_d": f"with {_OBS} {_feed_sql('Woolworths')}",
    "conformed_union": f"with {_OBS} {_UNION}",
    "fact_price": f"with {_OBS}, {_judged(f'({_UNION})')} select {_FACT_COLUMNS} from judged where dq_action <> 'drop'",
    "dq_classified": f"{_UNCHECKED}, {_judged('unchecked')} select l_orderkey, l_linenumber, retailer, dq_action, dq_reason from judged",
    "dq_quarantine": f"""{_FACT} select product_sk, snapshot_date, price_aud, availability, dq_action, dq_reason
        from fact where is_quarantined""",
    "expectation_metrics": " union all ".join(
        f"""select * from ({_UNCHECKED} select '{name}' as expectation, '{on_fail}' as on_fail,
        count(*) filter (where {met}) as passed, count(*) filter (where not coalesce({met}, false)) as failed from unchecked)"""
        for name, on_fail, met in _EXPECTATIONS
    ),
    "expectation_log_streamed": f"""{_UNCHECKED}, {_judged("unchecked")}, kept as (select * from judged where dq_action <> 'drop')
        select expectation, on_fail, n_batches, passed, failed, (select count(*) from kept where
          retailer in ('Aldi', 'Coles', 'IGA', 'Woolworths') and product_name <> '') as n_stored from (
        select 'drop_rules' as expectation, 'drop' as on_fail, 2::bigint as n_batches,
          count(*) filter (where dq_action <> 'drop') as passed, count(*) filter (where dq_action = 'drop') as failed from judged
        """
    + " ".join(
        f"""union all select '{name}', '{on_fail}', 2::bigint, count(*) filter (where coalesce({met}, false)),
        count(*) filter (where not coalesce({met}, false)) from kept"""
        for name, on_fail, met in _EXPECTATIONS
    )
    + ")",
    "fact_price_daily": f"{_DAILY} select * from daily",
    "fact_price_daily_hot_keys": f"{_daily(_CROWDED_FACT, 'crowded')} select * from daily",
    "mart_price_comparison": f"""{_DAILY} select *, price_rank = 1 as is_cheapest from (select *,
        cast(rank() over (partition by snapshot_date, canonical_l1, canonical_l2, norm_unit_measure
          order by avg_norm_unit_price) as int) as price_rank from (select snapshot_date, canonical_l1, canonical_l2,
          norm_unit_measure, retailer, {_MEAN} as avg_norm_unit_price, count(*) as n_products
          from daily where norm_unit_price is not null group by all))""",
    "mart_specials_penetration": f"""{_DAILY} select *, {_pct("n_on_special", "n_products")} as specials_pct from (
        select snapshot_date, retailer, canonical_l1, count(*) as n_products,
          cast(sum(on_special::int) as bigint) as n_on_special from daily group by all)""",
    "mart_category_price_index": f"""{_DAILY} select *, round(avg_norm_unit_price / nullif(base_price, 0) * 100, 1) as price_index
        from (select *, first_value(avg_norm_unit_price) over (partition by retailer, canonical_l1, norm_unit_measure
          order by snapshot_date) as base_price from (select snapshot_date, retailer, canonical_l1, norm_unit_measure,
          {_MEAN} as avg_norm_unit_price, count(*) as n_products from daily where norm_unit_price is not null group by all))""",
    "mart_availability": f"""{_FACT} select *, {_pct("n_available", "n_listings")} as availability_rate from (
        select snapshot_date, retailer, count(*) as n_listings,
          count(*) filter (where availability = 'available') as n_available,
          count(*) filter (where availability = 'unavailable') as n_unavailable from fact group by all)""",
    "mart_dq_scorecard": f"""{_FACT} select *, {_pct("n_quarantined", "n_rows")} as quarantine_pct,
        {_pct("n_null_price", "n_rows")} as null_price_pct from (select snapshot_date, retailer, count(*) as n_rows,
          count(*) filter (where is_quarantined) as n_quarantined,
          count(*) filter (where price_aud is null) as n_null_price from fact group by all)""",
    "dim_product_scd2": f"""{_FACT}, best as (select * from (select *, row_number() over (
          partition by product_sk, snapshot_date order by {_PRODUCT_BEST}) as pick from fact) where pick = 1),
        {_islands("best", "product_sk", "snapshot_date", _PRODUCT_TRACKED, f"{', '.join(_PRODUCT_KEPT)}, product_sk, snapshot_date")}""",
    "dim_category": f"{_FACT} select distinct category_sk, canonical_l1, canonical_l2 from fact",
    "dim_retailer": f"""{_FACT} select retailer, parent_company, retailer_type, md5(retailer) as retailer_sk from (values
        ('Aldi', 'ALDI Australia', 'Discounter'), ('Coles', 'Coles Group', 'Full-service'),
        ('IGA', 'Metcash (IGA)', 'Independent'), ('Woolworths', 'Woolworths Group', 'Full-service'))
        r (retailer, parent_company, retailer_type) where retailer in (select retailer from fact)""",
    "dim_date": f"""{_FACT} select date_day, cast(strftime(date_day, '%Y%m%d') as int) as date_sk,
        cast(year(date_day) as int) as "year", cast(month(date_day) as int) as "month", cast(day(date_day) as int) as "day",
        cast(dayofweek(date_day) + 1 as int) as day_of_week, dayofweek(date_day) in (0, 6) as is_weekend from (
        select cast(unnest(generate_series(min(snapshot_date), max(snapshot_date), interval 1 day)) as date) as date_day
        from fact)""",
    "event_history_scd2": EVENT_HISTORY,
    "event_history_scd2_hot_keys": _CROWDED_HISTORY,
    "event_history_scd2_streamed": EVENT_HISTORY,
    "event_type_dedup_stream": "select distinct event_type, upper(event_type) as label from events",
    "ingested_feed": f"with {_OBS} select * exclude (_source_file) from ({_feed_sql('Coles')})",
    "file_lineage": f"""with {_OBS} select strftime(day, '%Y-%m-%d') as path_date, day as snapshot_date,
        count(*) as n_rows, count(*) as n_stamped_in_time from obs group by day""",
    "rescued_columns": f"""with {_OBS}, named as (select *, {_NAME} as name, l_linenumber = 7 as ragged from obs)
        select case when not (ragged and length(name) % 3 = 1) then name end as "Product", {_URL} as "Product_Page",
        case when l_linenumber % 2 = 0 then {_SLUG} end as "Sub_Category",
        case when l_linenumber % 2 = 1 then '{{"Colour":"' || p_brand || '"' ||
          case when ragged and length(name) % 3 = 0 then ',"_c3":"x y","_c4":"' || length(name) || '"' else '' end || '}}' end
          as _rescued_data,
        day as _snapshot_date from named""",
    "inferred_feed_types": f"""with {_OBS}, kinds as (select retailer,
          case when max(l_partkey) < 2147483648 then 'int' else 'bigint' end as sku from obs group by retailer)
        select lower(retailer) as feed, "column", case when "type" = 'sku' then sku else "type" end as "type"
        from kinds join (values {", ".join(f"('{r}', '{c}', '{t}')" for r, c, t in _COLUMN_TYPES)})
          t (retailer, "column", "type") using (retailer)""",
    "typed_feed": f"""with {_OBS} select l_orderkey, l_linenumber,
        case when l_linenumber < 7 then l_partkey::int end as "SKU", cents / 100.0::double as "Previous_Price",
        case when l_linenumber < 6 then l_discount > 0.07::double end as "On_Special", p_brand as "Brand",
        case when l_linenumber = 7 then '{{"SKU":"X' || l_partkey || '","On_Special":"maybe"}}' end as _rescued_data from obs""",
    "landing_plan": f"""{_NAMES}, last as (select target, max(source) as source from placed group by all)
        select source, retailer, "date", target, case when target is null then 'cannot classify'
          when (target, source) not in (select (target, source) from last) then 'superseded' end as reason from placed""",
    "landing_rejects": f"""{_NAMES} select source, retailer, "date" from placed where target is null""",
    "landing_log_streamed": f"""{_RUNS} select runs.source, retailer, "date", runs.target,
        case when runs.target is null then 'cannot classify' when runs.source <> mine.source then 'superseded' end as reason,
        case when runs.source = mine.source then earlier.source end as replaces, runs.batch
        from runs left join winners mine on mine.target = runs.target and mine.batch = runs.batch
        left join winners earlier on earlier.target = runs.target and earlier.batch < runs.batch""",
    "landed_files_streamed": f"""{_RUNS}
        select target, max_by(source, batch) as source, max(batch) as batch from winners group by target""",
}
SQL["mart_in_catalogue"] = f"""select *, 'Quality by day and retailer' as table_comment, 'gold' as table_tier
    from ({SQL["mart_dq_scorecard"]})"""
for _name in (
    "dim_product_scd2", "dim_category", "fact_price_daily", "mart_price_comparison", "mart_specials_penetration", "mart_category_price_index",
    "mart_availability", "mart_dq_scorecard",
):
    SQL[f"{_name}_streamed"] = SQL[_name]
SQL["fact_price_daily_streamed_hot_keys"] = SQL["fact_price_daily_hot_keys"]
SQL["event_history_scd2_streamed_hot_keys"] = SQL["event_history_scd2_hot_keys"]
SQL["fact_price_streamed"] = f"select * exclude (_source_file) from ({SQL['fact_price']})"
