"""For each query, the DuckDB SQL over the same tables that gives the same rows."""

from __future__ import annotations


def _text(c: str) -> str:
    """Text normalisation. DuckDB has no initcap; words are title-cased one by one."""
    return f"""trim(regexp_replace(array_to_string(list_transform(string_split(lower({c}), ' '),
        lambda x: (case when x[1:1] = 'ß' then 'Ss' else upper(x[1:1]) end) || x[2:]), ' '),
        '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))"""


def _int(c: str) -> str:
    """Fractions are cut off as text, since a cast would round them."""
    return f"""case when regexp_full_match({c}, '\\s*[+-]?[0-9]*(\\.[0-9]*)?\\s*')
        then try_cast(regexp_extract({c}, '^\\s*([+-]?[0-9]+)', 1) as int) end"""


def _exact_average(c: str) -> str:
    """Half up, for values of two decimals that are not negative."""
    return f"((2 * sum(cast(round({c} * 100) as hugeint)) + count({c})) // (2 * count({c}))) / 100.0"


def _stats(source: str, keys: str, value: str, exact: bool = False) -> str:
    average = _exact_average(value) if exact else f"round(avg({value}), 2)"
    return f"""select {keys}, count(*) as item_count, {average} as avg_price,
        round(min({value}), 2) as min_price, round(max({value}), 2) as max_price
        from {source} group by {keys}"""


_RAW = """raw as (select cast(p_partkey as varchar) as "Unnamed: 0",
    case when p_partkey % 17 = 0 then concat('bad', p_partkey)
         when p_partkey % 13 = 0 then concat(p_partkey, '.0')
         else cast(p_partkey as varchar) end as id,
    case when p_partkey % 19 = 0 then null
         else concat('  ', upper(replace(p_name, ' ', '   ')), ' ') end as name,
    p_name as description, cast(null as varchar) as long_description,
    cast(p_size as varchar) as customer_part_id, p_brand as manufacturer_name,
    cast(p_partkey as varchar) as manufacturer_part_id,
    case when p_partkey % 20 = 0 then 'acme corp' end as competitor_name,
    cast(null as varchar) as competitor_part_name, cast(null as varchar) as competitor_part_id,
    case when p_partkey % 23 = 0 then null else lower(p_type) end as category,
    'EA' as unit_of_measure,
    case when p_partkey % 7 = 0 then 'n/a' else cast(p_size as varchar) end as unit_quantity,
    cast(p_size * 2 as varchar) as requested_quantity,
    cast(p_retailprice as varchar) as requested_unit_price
    from part)"""

_TAGGED = f"""{_RAW}, cleaned as (select *,
    {_text("name")} as name_cleaned, {_text("description")} as description_cleaned,
    {_text("manufacturer_name")} as manufacturer_name_cleaned,
    {_text("competitor_name")} as competitor_name_cleaned,
    {_text("category")} as category_cleaned, {_int("id")} as id_cleaned,
    try_cast(unit_quantity as double) as unit_quantity_cleaned,
    try_cast(requested_quantity as double) as requested_quantity_cleaned,
    try_cast(requested_unit_price as double) as requested_unit_price_cleaned from raw),
    tagged as (select *, case when id_cleaned is null or name_cleaned is null
    or category_cleaned is null then 'N' else 'Y' end as is_valid from cleaned)"""

# The columns of the clean table, and those of them that are sparse here.
_OUTPUT = (
    "id_cleaned",
    "name_cleaned",
    "description_cleaned",
    "long_description",
    "customer_part_id",
    "manufacturer_name_cleaned",
    "manufacturer_part_id",
    "competitor_name_cleaned",
    "competitor_part_name",
    "competitor_part_id",
    "category_cleaned",
    "unit_of_measure",
    "unit_quantity_cleaned",
    "requested_quantity_cleaned",
    "requested_unit_price_cleaned",
)
_SPARSE = ("long_description", "competitor_name_cleaned", "competitor_part_name", "competitor_part_id")
_KEPT = tuple(c for c in _OUTPUT if c not in _SPARSE)

_VALID = f"""{_TAGGED}, valid as (select {", ".join(_OUTPUT)}, is_valid
    from tagged where is_valid = 'Y')"""

_LINES = f"""lines as (select
    case when l_orderkey % 11 = 0 then concat('#', l_orderkey) else cast(l_orderkey as varchar) end as order_id,
    case when l_suppkey % 23 = 0 then null else cast(l_suppkey as varchar) end as supplier,
    concat('  ', lower(l_returnflag), '   ', lower(l_linestatus), ' ') as status,
    cast(l_quantity as varchar) as quantity,
    case when l_partkey % 7 = 0 then 'n/a' else cast(l_extendedprice as varchar) end as price,
    case when l_linenumber = 7 then 'last line' end as note from lineitem),
    valid_lines as (select {_int("order_id")} as order_id_cleaned, supplier,
    {_text("status")} as status_cleaned, {_int("quantity")} as quantity_cleaned,
    try_cast(price as double) as price_cleaned, {_text("note")} as note_cleaned, 'Y' as is_valid
    from lines where {_int("order_id")} is not null and supplier is not null)"""

_LINE_OUTPUT = (
    "order_id_cleaned",
    "supplier",
    "status_cleaned",
    "quantity_cleaned",
    "price_cleaned",
    "note_cleaned",
)

_ALL_RAW = f"with {_RAW} select * from raw"
_STATS_KEYS = "name_cleaned, manufacturer_name_cleaned, category_cleaned"
_PRICE = "requested_unit_price_cleaned"
_CATEGORY_STATS = f"with {_VALID} " + _stats("valid", _STATS_KEYS, _PRICE)
_EXACT_CATEGORY_STATS = f"with {_VALID} " + _stats("valid", _STATS_KEYS, _PRICE, exact=True)
_ISSUES = """select * from (values
    ('missing_column', 'category', 'string', null),
    ('type_mismatch', 'id', 'string', 'int'),
    ('unexpected_column', 'colour', null, 'string')) t(kind, "column", expected, actual)"""


_ORDERS_ISSUES = """select * from (values
    ('missing_column', 'o_colour', 'string', null),
    ('type_mismatch', 'o_orderkey', 'string', 'bigint')) t(kind, "column", expected, actual)
    union all select 'unexpected_column', column_name, null, case column_type when 'VARCHAR' then 'string'
        when 'TIMESTAMP' then 'timestamp_ntz' when 'INTEGER' then 'int' else lower(column_type) end
    from (describe orders) where column_name not in
        ('o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice')"""
_BLANK = f"""{_VALID}, blank as (select * replace (
    case when cast(manufacturer_part_id as int) % 5 = 0 then '' else category_cleaned end as category_cleaned)
    from tagged where id_cleaned is not null and name_cleaned is not null
    and (category_cleaned is not null or cast(manufacturer_part_id as int) % 5 = 0))"""


def _ratios(columns: tuple[str, ...]) -> str:
    return ", ".join(f"count(*) filter ({c} is null) / count(*) as {c}" for c in (*columns, "is_valid"))


_FIELDS = (
    "Unnamed: 0",
    "id",
    "name",
    "description",
    "long_description",
    "customer_part_id",
    "manufacturer_name",
    "manufacturer_part_id",
    "competitor_name",
    "competitor_part_name",
    "competitor_part_id",
    "category",
    "unit_of_measure",
    "unit_quantity",
    "requested_quantity",
    "requested_unit_price",
)


def _line(fields: tuple[str, ...]) -> str:
    return "array_to_string([" + ", ".join(f"coalesce(\"{c}\", '')" for c in fields) + "], ',')"


# Lines of a multiple of 29 are too long, those of a multiple of 31 lack two fields.
_RAGGED = f"""{_TAGGED}, keyed as (select *, cast(manufacturer_part_id as int) as k from tagged),
    ragged as (select * replace (
        case when k % 31 = 0 and k % 29 <> 0 then null else requested_quantity end as requested_quantity,
        case when k % 31 = 0 and k % 29 <> 0 then null else requested_unit_price end as requested_unit_price),
        case when k % 29 = 0 then {_line(_FIELDS)} || ',surplus,field'
             when k % 31 = 0 then {_line(_FIELDS[:-2])} end as raw_line from keyed)"""
_RAGGED_COLUMNS = ", ".join(f'"{c}"' for c in (*_FIELDS, "raw_line"))


_SUMMARY = f"""with {_TAGGED}, ratios as (select unnest([{", ".join(f"'{c}'" for c in _OUTPUT)}]) as c,
    unnest([{", ".join(f"count(*) filter ({c} is null) / count(*)" for c in _OUTPUT)}]) as ratio,
    generate_subscripts([{", ".join(f"'{c}'" for c in _OUTPUT)}], 1) as i
    from tagged where is_valid = 'Y')
    select (select count(*) from tagged) as total_rows,
    (select count(*) from tagged where is_valid = 'Y') as valid_rows,
    (select count(*) from tagged where is_valid = 'N') as invalid_rows,
    cast(0.9 as double) as null_threshold,
    (select string_agg(c, ',' order by i) from ratios where ratio >= 0.9) as columns_removed_due_to_nulls,
    (select string_agg(c, ',' order by i) from ratios where ratio < 0.9) as columns_retained"""

ORACLE_SQL: dict[str, str] = {
    "csv_contract_scan": _ALL_RAW,
    "csv_reordered_scan": _ALL_RAW,
    "csv_dialect_scan": """select cast(doc_id as varchar) as doc_id,
        concat('|"', source, '", ') as source, nullif(text, '') as text from documents""",
    "csv_infer_scan": f"""with {_RAW} select * replace (cast("Unnamed: 0" as int) as "Unnamed: 0",
        cast(customer_part_id as int) as customer_part_id,
        cast(manufacturer_part_id as int) as manufacturer_part_id,
        cast(requested_quantity as int) as requested_quantity,
        cast(requested_unit_price as double) as requested_unit_price) from raw""",
    "typed_contract_scan": """select cast(c_custkey as varchar) as c_custkey, c_name,
        cast(c_nationkey as varchar) as c_nationkey, cast(c_acctbal as varchar) as c_acctbal,
        c_mktsegment from customer""",
    "schema_report": _ISSUES,
    "headerless_csv_scan": _ALL_RAW,
    "csv_by_name_scan": _ALL_RAW,
    "contract_gate_refusal": """select kind, "column", 'FAILED' as status, (select count(*) from part) as n_rows
        from (values ('missing_column', 'category'), ('unexpected_column', 'colour')) t(kind, "column")""",
    "unknown_format_refusal": "select s_suppkey, 2 as refused from supplier",
    "schema_report_orders": _ORDERS_ISSUES,
    "schema_report_document": f"""with issues as ({_ORDERS_ISSUES}) select 'FAILED' as status,
        (select string_agg("column", ',') from issues where kind = 'missing_column') as missing_columns,
        (select string_agg("column" || ':' || expected || ':' || actual, ',') from issues
         where kind = 'type_mismatch') as type_mismatches,
        (select string_agg("column", ',' order by "column") from issues
         where kind = 'unexpected_column') as unexpected_columns,
        (select cast(count(*) as int) from issues) as n_errors, (select count(*) from orders) as n_rows""",
    "text_normalize": f"select doc_id, {_text('text')} as text_cleaned from documents",
    "text_normalize_turns": f"select conv_id, turn, {_text('text')} as text_cleaned from conversations",
    "text_normalize_pages": f"select page_id, {_text('html')} as html_cleaned from pages",
    "text_normalize_columns": f"""with {_TAGGED} select manufacturer_part_id, name_cleaned,
        description_cleaned, manufacturer_name_cleaned, competitor_name_cleaned, category_cleaned
        from tagged""",
    "tolerant_int": f"""select l_orderkey, l_linenumber, {_int("cast(l_quantity as varchar)")} as quantity
        from lineitem""",
    "tolerant_int_ids": f"with {_TAGGED} select id, id_cleaned from tagged",
    "tolerant_double": """select event_id, try_cast(cast(value as varchar) as double) as value,
        try_cast(event_type as double) as event_type, try_cast(props as double) as props from events""",
    "tolerant_double_documents": "select doc_id, try_cast(text as double) as number from documents",
    "tolerant_int_line_ends": f"""select l_orderkey, l_linenumber, case when l_linenumber % 5 in (0, 1)
        then {_int("cast(l_quantity as varchar)")} end as quantity from lineitem""",
    "inferred_other_ids": """select kind, cast(p_partkey as varchar) as manufacturer_part_id,
        cast(null as int) as id_cleaned, 'N' as is_valid
        from part, (values ('date'), ('time'), ('boolean')) t(kind)""",
    "validity_flag": f"with {_TAGGED} select manufacturer_part_id, is_valid from tagged",
    "all_null_rows": f"""with {_RAW} select * from raw
        where long_description is null and competitor_name is null""",
    "quarantine_rows": f"""with {_TAGGED} select raw.*, 'N' as is_valid from raw
        semi join (select "Unnamed: 0" from tagged where is_valid = 'N') t using ("Unnamed: 0")""",
    "valid_rows": f"with {_VALID} select * from valid",
    "null_ratios": f"with {_VALID} select {_ratios(_OUTPUT)} from valid",
    "drop_sparse_columns": f"with {_VALID} select {', '.join(_KEPT)} from valid",
    "clean_with_metadata": f"with {_VALID} select {', '.join(_KEPT)}, is_valid from valid",
    "ingestion_stamp": f"""with {_VALID} select id_cleaned, name_cleaned,
        timestamp '2024-01-01 00:00:00' as ingestion_time from valid""",
    "cleaning_summary": _SUMMARY,
    "cleaning_summary_observed": _SUMMARY,
    "order_line_ratios": f"with {_LINES} select {_ratios(_LINE_OUTPUT)} from valid_lines",
    "category_stats": _CATEGORY_STATS,
    "category_stats_exact": _EXACT_CATEGORY_STATS,
    "grouped_line_stats_exact": _stats(
        "lineitem", "l_suppkey, l_returnflag, l_linestatus", "l_extendedprice", exact=True
    ),
    "huge_sum_stats_exact": "with lines as (select l_returnflag, floor(l_extendedprice) * 1e8"
    " + l_linenumber * cast(0.25 as double) as price from lineitem) "
    + _stats("lines", "l_returnflag", "price", exact=True),
    "category_only_stats": f"with {_VALID} "
    + _stats("valid", "category_cleaned", _PRICE, exact=True),
    "grouped_price_stats": _stats("lineitem", "l_suppkey, l_returnflag, l_linestatus", "l_extendedprice"),
    "grouped_price_stats_exact": _stats("orders", "o_custkey", "o_totalprice", exact=True),
    "event_value_stats_exact": _stats("events", "event_type", "value", exact=True),
    "csv_roundtrip": _ALL_RAW,
    "json_roundtrip": _ALL_RAW,
    "parquet_roundtrip": _ALL_RAW,
    "orc_roundtrip": _ALL_RAW,
    "partitioned_roundtrip": _EXACT_CATEGORY_STATS,
    "partitioned_csv_roundtrip": "select o_orderkey, o_totalprice, o_orderpriority from orders",
    "append_mode": f"with {_RAW} select * from raw union all select * from raw",
    "ignore_mode": _ALL_RAW,
    "errorifexists_mode": f"with {_RAW} select *, true as refused from raw",
    "quarantine_roundtrip": f"""with {_TAGGED} select raw.*, 'N' as is_valid from raw
        semi join (select "Unnamed: 0" from tagged where is_valid = 'N') t using ("Unnamed: 0")""",
    "checkpoint_reuse": f"with {_VALID} select *, true as reused from valid",
    "staged_valid_rows": f"with {_LINES} select {', '.join(_LINE_OUTPUT)}, is_valid from valid_lines",
    "curated_category_stats": _EXACT_CATEGORY_STATS,
    "curated_inferred_stats": _EXACT_CATEGORY_STATS,
    "curated_blank_category_stats": f"with {_BLANK} " + _stats("blank", _STATS_KEYS, _PRICE, exact=True),
    "curated_rerun_without_valid_rows": f"""with {_VALID} select 'first' as run, count(*) as valid_rows,
        0 as clean_left, 0 as stats_left from valid
        union all select 'second', 0, 0, 0""",
    "curated_appended_clean_rows": f"""with {_VALID} select id_cleaned,
        cast(null as varchar) as competitor_name_cleaned from valid
        union all select id_cleaned, 'Acme Corp' from valid""",
    "csv_bad_lines_scan": f"with {_RAGGED} select {_RAGGED_COLUMNS} from ragged",
    "curated_bad_lines_quarantine": f"""with {_RAGGED} select {_RAGGED_COLUMNS}, 'N' as is_valid
        from ragged where is_valid = 'N' or raw_line is not null""",
    "partitioned_blank_keys_csv": """select o_orderkey, case when o_orderkey % 5 = 0 then ''
        when o_orderkey % 7 <> 0 then o_orderpriority end as priority from orders""",
    "checkpointed_valid_rows": f"with {_VALID} select * from valid",
    "curated_json_stats": _EXACT_CATEGORY_STATS,
    "released_appended_stats": _EXACT_CATEGORY_STATS,
    "released_order_line_stats": f"with {_LINES}, thrice as (select * from valid_lines, range(3)) "
    + _stats("thrice", "supplier, status_cleaned", "price_cleaned", exact=True),
    "released_rows_after_a_failed_run": f"with {_VALID} select {', '.join(_KEPT)}, true as failed from valid",
    "curated_order_line_stats": f"with {_LINES} "
    + _stats("valid_lines", "supplier, status_cleaned", "price_cleaned", exact=True),
}
