"""The same results as plain SQL, for the correctness check.

The catalog of the test tables is written out once as common table expressions;
row, partition and size figures are taken from the tables themselves.
"""

from __future__ import annotations

TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem "
    "nation orders pages part region supplier"
).split()
OBJECT_ID = {t: 1001 + i for i, t in enumerate(TABLES)}
KEY = {
    "benchmark": "item_id",
    "conversations": "conv_id",
    "customer": "c_custkey",
    "documents": "doc_id",
    "embeddings": "vec_id",
    "events": "event_id",
    "lineitem": "l_orderkey",
    "nation": "n_nationkey",
    "orders": "o_orderkey",
    "pages": "page_id",
    "part": "p_partkey",
    "region": "r_regionkey",
    "supplier": "s_suppkey",
}
LOBS = [
    ("benchmark", "text"),
    ("conversations", "text"),
    ("documents", "text"),
    ("events", "props"),
    ("pages", "html"),
    ("pages", "url"),
]
STRINGS = {
    "benchmark": ["text"],
    "conversations": ["role", "text"],
    "customer": ["c_name", "c_mktsegment"],
    "documents": ["text", "lang", "source"],
    "events": ["event_type", "props"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "nation": ["n_name"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "pages": ["url", "html"],
    "part": ["p_name", "p_brand", "p_type"],
    "region": ["r_name"],
    "supplier": ["s_name"],
}
PARTITION = {"events": "ts::date", "documents": "lang"}


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def _profile(table: str, column: str) -> str:
    return f"""select {OBJECT_ID[table]}::int as object_id, '{column}' as "LOBColName",
  sum(case when {column} is null or strlen({column}) <= 1024 then 1 else 0 end)::bigint as "CountLess1KAndNulls",
  cast((max(strlen({column})) * 1000000 // 1024) / 1000000.0 as decimal(18,7)) as "MaxLOBSizeKB",
  ((sum(strlen({column})) // count({column})) // 1024)::int as "AvgSizeKB",
  (min(strlen({column})) // 1024)::int as "MinSizeKB",
  (max(strlen({column})) // 1048576)::int as "MaxSizeMB",
  ((sum(strlen({column})) // count({column})) // 1048576)::int as "AvgSizeMB",
  (min(strlen({column})) // 1048576)::int as "MinSizeMB"
from {table}"""


def _counts(table: str) -> str:
    parts = f"count(distinct {PARTITION[table]})" if table in PARTITION else "1"
    return f"""select {OBJECT_ID[table]}::int as object_id, 'main' as "SchemaName", '{table}' as "TableName",
  count(*)::bigint as rows, (case when {parts} > 1 then {parts} else 0 end)::int as "PartitionCount"
from {table}"""


PROFILE = "profile as (\n" + _union([_profile(t, c) for t, c in LOBS]) + "\n)"
COUNTS = "counts as (\n" + _union([_counts(t) for t in TABLES]) + "\n)"
# The two entries that a partition list keeps and a report leaves out.
PARTITION_INFO = """select object_id, rows, "PartitionCount" from counts
union all select 901::int, 10::bigint, 0::int union all select 902::int, 10::bigint, 0::int"""

SIZE_CLASS = """case when rows < 10000 then 'Small' when rows between 10000 and 50000 then 'Medium'
  when rows between 50000 and 100000 then 'Large' else 'Extra_Large' end"""

REPORT = f"""report as (
  select (row_number() over (order by "MaxLOBSizeKB" desc, "SchemaName", "TableName", "ConcatenatedLOBs"))::int as "ID", *
  from (
    select c."TableName", c."SchemaName", c.rows,
      case when c."PartitionCount" > 0 then 'Partitioned' else 'Not Partitioned' end as "IsPartitioned",
      c."PartitionCount",
      case when p.object_id is null then 'No' else 'Yes' end as "ContainsLOBs",
      coalesce(p."LOBColName", '') as "ConcatenatedLOBs",
      coalesce(p."CountLess1KAndNulls", 0)::bigint as "CountLess1KAndNulls",
      coalesce(p."MaxLOBSizeKB", 0)::decimal(18,7) as "MaxLOBSizeKB",
      coalesce(p."AvgSizeKB", 0)::int as "AvgSizeKB", coalesce(p."MinSizeKB", 0)::int as "MinSizeKB",
      coalesce(p."MaxSizeMB", 0)::int as "MaxSizeMB", coalesce(p."AvgSizeMB", 0)::int as "AvgSizeMB",
      coalesce(p."MinSizeMB", 0)::int as "MinSizeMB",
      {SIZE_CLASS} as "TableSize", null::varchar as "Type", '' as "Table_JSON"
    from counts c left join profile p using (object_id)
  )
)"""

ROLLUP = """rollup as (
  select "SchemaName", "TableName", max("PartitionCount") as "PartitionCount", max(rows) as rows,
    max("ContainsLOBs") as "ContainsLOBs", max("MaxLOBSizeKB") as "MaxLOBSizeKB"
  from report group by all
)"""

BASE = f"with {PROFILE},\n{COUNTS},\n{REPORT}"


def _small(limit_kb: int) -> str:
    return f"""("ContainsLOBs" = 'No' or ("ContainsLOBs" = 'Yes' and "MaxLOBSizeKB" <= {limit_kb}))"""


def _large(limit_kb: int) -> str:
    return f"""("ContainsLOBs" = 'Yes' and "MaxLOBSizeKB" > {limit_kb})"""


def _locator() -> str:
    return """{'schema-name': "SchemaName", 'table-name': "TableName"}"""


def _selection(base: int, filters: bool) -> str:
    rule_id = f"({base} + rn)::varchar"
    extra = ", 'filters': []::varchar[]" if filters else ""
    return (
        f"to_json({{'rule-type': 'selection', 'rule-id': {rule_id}, 'rule-name': {rule_id}, "
        f"'object-locator': {_locator()}, 'rule-action': 'include'{extra}}})::varchar"
    )


def _settings(base: int, load: str) -> str:
    rule_id = f"({base} + rn)::varchar"
    return (
        f"to_json({{'rule-type': 'table-settings', 'rule-id': {rule_id}, 'rule-name': {rule_id}, "
        f"'object-locator': {_locator()}, 'parallel-load': {load}}})::varchar"
    )


def _row_case(case: int, where: str, rule: str) -> str:
    return f"""select {case}::int as case_id, "ID", "SchemaName", "TableName", rn::int as rn, {rule} as rule_json
from (select *, row_number() over (order by "SchemaName", "TableName", "ConcatenatedLOBs") as rn
  from report where {where})"""


def _row_cases(row_limit: int, limit_kb: int) -> dict[int, str]:
    auto = "{'type': 'partitions-auto'}"
    whole, few = '"PartitionCount" = 0', f"rows <= {row_limit}"
    return {
        1: _row_case(1, f"{whole} and {few} and {_small(limit_kb)}", _selection(100000000, True)),
        3: _row_case(
            3,
            f'"PartitionCount" > 0 and {_small(limit_kb)}',
            f"{_selection(300000000, False)} || ',' || {_settings(310000000, auto)}",
        ),
        5: _row_case(
            5,
            f'"PartitionCount" > 0 and {_large(limit_kb)}',
            f"{_selection(500000000, False)} || ',' || {_settings(510000000, auto)}",
        ),
        6: _row_case(
            6,
            f"""{whole} and {few} and "ContainsLOBs" = 'Yes' and "MaxLOBSizeKB" >= {limit_kb}""",
            _selection(100000000, True),
        ),
    }


def _chosen(case: int, where: str, row_limit: int) -> str:
    keys = ", ".join(f"('{t}', {repr(KEY[t]) if t in KEY else 'null'})" for t in TABLES)
    return f"""chosen{case} as (
  select r."SchemaName", r."TableName", k.first_column,
    least(10, rows // {row_limit} + 1)::int as tiles,
    row_number() over (order by r."SchemaName", r."TableName") as rn
  from rollup r join (values {keys}) k("TableName", first_column) using ("TableName")
  where {where}
),
bounds{case} as (
{_union([_bounds(case, t) for t in KEY])}
)"""


def _bounds(case: int, table: str) -> str:
    return f"""  select '{table}' as "TableName", to_json(list([min_val] order by loc)) as boundaries
  from (select loc, min(k) as min_val
    from (select {KEY[table]} as k, ntile(tiles) over (order by {KEY[table]}) as loc
      from {table}, (select tiles from chosen{case} where "TableName" = '{table}' and tiles > 1))
    group by loc)
  where loc > 1 having count(*) > 0"""


def _table_case(case: int) -> str:
    base = case * 100000000
    load = "{'type': 'ranges', 'columns': [first_column], 'boundaries': boundaries}"
    pair = f"{_selection(base, case == 4)} || ',' || {_settings(base + 10000000, load)}"
    rule = f"case when first_column is not null and boundaries is not null then {pair}"
    rule += f" else {_selection(base, True)} end" if case == 4 else " end"
    return f"""select {case}::int as case_id, "SchemaName", "TableName", rn::int as rn, {rule} as rule_json
from chosen{case} left join bounds{case} using ("TableName")"""


def _chosen_for(case: int, row_limit: int, limit_kb: int) -> str:
    where = '"PartitionCount" = 0 and ' + (
        f"rows > {row_limit} and {_small(limit_kb)}" if case == 2 else _large(limit_kb)
    )
    return _chosen(case, where, row_limit)


def _all_rules(row_limit: int, limit_kb: int) -> str:
    parts = list(_row_cases(row_limit, limit_kb).values())
    for case in (2, 4):
        parts.append(
            f'select case_id, null::int as "ID", "SchemaName", "TableName", rn, rule_json from ({_table_case(case)})'
        )
    return f"""{BASE},
{ROLLUP},
{_chosen_for(2, row_limit, limit_kb)},
{_chosen_for(4, row_limit, limit_kb)}
{_union([f"select * from ({p})" for p in parts])}"""


def _one_table_case(case: int, row_limit: int, limit_kb: int) -> str:
    return f"{BASE},\n{ROLLUP},\n{_chosen_for(case, row_limit, limit_kb)}\n{_table_case(case)}"


LABELS = """(values
  (1, '[Table has No Partitions -- Number of Rows <= 10,000,000]'),
  (3, '[Table has Partitions -- Table does not contain lobs or lobs size is <= 1K]'),
  (5, '[Table has Partitions -- Table contains lobs > 1K]'),
  (6, '[Table has No Partitions, has LOBs => 1024KB and Number of Rows <= 10,000,000]')
) labels(case_id, label)"""

WITH_RULES = f"""{BASE},
stored as (
{_union([f"select * from ({c})" for c in _row_cases(10000, 4).values()])}
),
latest as (
  select "ID", label, rule_json
  from (select *, row_number() over (partition by "ID" order by case_id desc) as turn from stored)
  join {LABELS} using (case_id) where turn = 1
)
select r.* replace (l.label as "Type", coalesce(l.rule_json, r."Table_JSON") as "Table_JSON")
from report r left join latest l using ("ID")"""


def _ntile(table: str, key: str, tiles: int) -> str:
    return f"""select loc::int as loc, count(*)::bigint as cnt_vals, min(k) as min_val, max(k) as max_val
from (select {key} as k, ntile({tiles}) over (order by {key}) as loc from {table}) group by loc"""


def _declared(table: str, column: str) -> str:
    return f"""select {OBJECT_ID[table]}::int as object_id, 'main' as schema, '{table}' as "table",
  '{column}' as "column" """


def _leading_key(table: str) -> str:
    key = KEY.get(table)
    first = f"case when bool_and({key} is not null) then '{key}' end" if key else "max(null::varchar)"
    return f"""select 'main' as "SchemaName", '{table}' as "TableName", {first} as first_column from {table}"""


def _stats(table: str, column: str, nested: bool) -> str:
    low, high = (
        ("null::varchar", "null::varchar")
        if nested
        else (f"min({column})::varchar", f"max({column})::varchar")
    )
    return f"""select '{table}' as table_name, '{column}' as column_name, count(*)::bigint as row_count,
  (count(*) - count({column}))::bigint as null_count, count(distinct {column})::bigint as distinct_count,
  {low} as min_value, {high} as max_value from {table}"""


COLUMNS = {
    "benchmark": "item_id text",
    "conversations": "conv_id turn role text",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "events": "event_id ts user_id event_type value props",
    "labels": "doc_id quality toxic",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "nation": "n_nationkey n_name n_regionkey",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "pages": "page_id url html",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "region": "r_regionkey r_name",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
}

LOADED_ORDERS = """loaded as (
  select o_orderkey, o_custkey,
    case when o_orderstatus = 'F' and o_orderpriority = '1-URGENT' then null else o_orderstatus end as o_orderstatus,
    case when o_orderpriority = '1-URGENT' then o_totalprice + 1 else o_totalprice end as o_totalprice,
    o_orderdate, o_orderpriority
  from orders where not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')
  union all
  select -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderstatus = 'O' and o_orderpriority = '5-LOW'
)"""

_ORDER_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
COMPARE_TABLES = f"""with {LOADED_ORDERS}
select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey,
  case when t.o_orderkey is null then 'missing' when s.o_orderkey is null then 'extra' else 'changed' end as status,
  (case when s.o_orderkey is null then 0 else 1 end)::bigint as source_rows,
  (case when t.o_orderkey is null then 0 else 1 end)::bigint as target_rows,
  case when s.o_orderkey is null or t.o_orderkey is null then '' else concat_ws(',',
    {", ".join(f"case when s.{c} is distinct from t.{c} then '{c}' end" for c in _ORDER_VALUES)}) end as changed_columns
from orders s full outer join loaded t on s.o_orderkey = t.o_orderkey
where s.o_orderkey is null or t.o_orderkey is null
  or {" or ".join(f"s.{c} is distinct from t.{c}" for c in _ORDER_VALUES)}"""

_LINE = ", ".join(COLUMNS["lineitem"].split())
COMPARE_ROWS = f"""with lines as (select {_LINE} from lineitem),
loaded as (
  select * from lines where l_returnflag <> 'R'
  union all select * from lines where l_returnflag = 'N' and l_linenumber = 1
),
source as (select {_LINE}, count(*) as n from lines group by all),
target as (select {_LINE}, count(*) as n from loaded group by all)
select {_LINE}, greatest(coalesce(s.n, 0) - coalesce(t.n, 0), 0)::bigint as source_surplus,
  greatest(coalesce(t.n, 0) - coalesce(s.n, 0), 0)::bigint as target_surplus
from source s full outer join target t using ({_LINE})
where coalesce(s.n, 0) <> coalesce(t.n, 0)"""

_SLICED_LINES = """select l_orderkey, (1 + (select count(*) from
    (select loc, min(k) as b from (select l_orderkey as k, ntile(10) over (order by l_orderkey) as loc from lineitem) group by loc)
    where loc > 1 and b <= l_orderkey))::int as slice
  from lineitem"""

ORACLE: dict[str, str] = {
    "lob_columns": _union([_declared(t, c) for t, c in LOBS]),
    "lob_profile": f"with {PROFILE} select * from profile",
    "lob_profile_dedup": _union([_profile(t, c) for t, c in LOBS]),
    "partition_info": f"with {COUNTS}\n{PARTITION_INFO}",
    "size_class": f'with {COUNTS}\nselect object_id, rows, {SIZE_CLASS} as "TableSize" from ({PARTITION_INFO})',
    "tile_count": f"""with {COUNTS}
select object_id, rows, least(10, rows // 10000 + 1)::int as tiles,
  least(10, rows // 100 + 1)::int as tiles_fewer_rows from ({PARTITION_INFO})""",
    "table_report": f"{BASE}\nselect * from report",
    "table_rollup": f"{BASE},\n{ROLLUP}\nselect * from rollup",
    "leading_key": _union([_leading_key(t) for t in TABLES]),
    **{f"case{c}_rules": f"{BASE}\n{sql}" for c, sql in _row_cases(10000, 4).items()},
    "case2_rules": _one_table_case(2, 10000, 4),
    "case4_rules": _one_table_case(4, 10000, 4),
    "case4_rules_tiled": _one_table_case(4, 100, 4),
    "load_rules": _all_rules(10000, 4),
    "load_rules_fewer_rows": _all_rules(100, 4),
    "load_rules_default_limits": _all_rules(10000000, 1024),
    "report_with_rules": WITH_RULES,
    "final_report": WITH_RULES + "\nwhere \"TableName\" <> 'load_report' order by rows desc",
    "final_report_hidden": f"{BASE}\nselect * from report where \"TableName\" <> 'lineitem' order by rows desc",
    "range_boundaries": _ntile("lineitem", "l_orderkey", 7),
    "range_boundaries_ties": _ntile("lineitem", "l_quantity", 7),
    "range_boundaries_text": _ntile("customer", "c_name", 10),
    "range_boundaries_time": _ntile("orders", "o_orderdate", 10),
    "range_boundaries_narrowed": _ntile("lineitem", "l_orderkey", 10),
    "range_boundaries_narrowed_time": _ntile("events", "ts", 10),
    "range_boundaries_narrowed_text": _ntile("events", "event_type", 6),
    "range_boundaries_nulls": """select loc::int as loc, count(*)::bigint as cnt_vals, min(k) as min_val, max(k) as max_val
from (
  select k, ntile(9) over (order by k nulls first) as loc
  from (select case when l_returnflag <> 'N' then l_orderkey end as k from lineitem)
) group by loc""",
    "assign_slices": """with starts as (
  select loc, min(k) as b from (select o_orderdate as k, ntile(10) over (order by o_orderdate) as loc from orders) group by loc
)
select o_orderkey, o_orderdate, (1 + (select count(*) from starts where loc > 1 and b <= o_orderdate))::int as slice
from orders""",
    "slice_balance": f"""select slice, count(*)::bigint as cnt_vals, min(l_orderkey) as min_val, max(l_orderkey) as max_val
from ({_SLICED_LINES}) group by slice""",
    "user_databases": """select name from (
  select case c_nationkey when 0 then 'master' when 1 then 'model' when 2 then 'msdb' when 3 then 'tempdb'
      else c_name end as name,
    case when c_acctbal < 0 then 'OFFLINE' else 'ONLINE' end as state_desc
  from customer)
where state_desc = 'ONLINE' and name not in ('master', 'model', 'msdb', 'tempdb')""",
    "user_pg_databases": """select datname from (
  select 'order_' || o_orderkey as datname, o_orderstatus = 'P' as datistemplate,
    o_orderpriority <> '5-LOW' as datallowconn
  from orders)
where datistemplate = false and datallowconn = true""",
    "user_schemas": """select schema_name from (
  select case when source = 'src0' then 'pg_catalog' when source = 'src1' then 'information_schema'
      when source = 'src2' then 'pgXtoast' || doc_id when lang = 'de' then 'pg_toast_' || doc_id
      when lang = 'es' then 'pg_temp_' || doc_id else lang || '_' || doc_id end as schema_name
  from documents)
where schema_name not in ('information_schema', 'pg_catalog')
  and schema_name not like 'pg_toast%' and schema_name not like 'pg_temp%'""",
    "name_search": "select p_partkey, p_name from part where contains(lower(p_name), lower('RED'))",
    "compare_tables": COMPARE_TABLES,
    "compare_rows": COMPARE_ROWS,
    "compare_tables_repeated": """select l_orderkey, 'changed' as status, count(*) as source_rows,
  count(*) as target_rows, 'l_quantity' as changed_columns
from lineitem where l_returnflag = 'R' group by l_orderkey""",
    "compare_lobs": """select doc_id, 'changed' as status, 1::bigint as source_rows, 1::bigint as target_rows,
  'text' as changed_columns
from documents where lang = 'fr' and text <> upper(text)""",
    "compare_buckets": """select l_orderkey, 'changed' as status, count(*) as source_rows,
  count(*) as target_rows, 'l_quantity' as changed_columns
from lineitem where l_quantity = 50 group by l_orderkey""",
    "compare_buckets_lobs": """select doc_id, case when source = 'src1' then 'missing' else 'changed' end as status,
  1::bigint as source_rows, (case when source = 'src1' then 0 else 1 end)::bigint as target_rows,
  case when source = 'src1' then '' else 'text' end as changed_columns
from documents where source = 'src1' or (lang = 'fr' and text <> upper(text))""",
    "lob_split": """select doc_id, case when text is null or strlen(text) <= 1024 then 'small' else 'large' end as side,
  strlen(text)::int as bytes from documents""",
    "sequence_positions": _union(
        [
            f"""select '{t}' as table_name, '{k}' as key_column, max({k})::bigint as last_value,
  (coalesce(max({k}), 0) + 1)::bigint as next_value from {t}"""
            for t, k in KEY.items()
        ]
    ),
    "column_stats": _union(
        [_stats(t, c, c == "embedding") for t, cs in COLUMNS.items() for c in cs.split()]
    ),
}

ORACLE["report_stored"] = ORACLE["table_report"]
ORACLE["report_updated"] = ORACLE["report_with_rules"]
ORACLE["result_dumped"] = ORACLE["final_report"]
ORACLE["rules_as_text"] = f"""select (row_number() over (order by case_id, rn))::int as line, rule_json
from ({ORACLE["load_rules_fewer_rows"]}) where rule_json is not null"""
ORACLE["slices_written"] = f"""select l_orderkey, l_linenumber, l_quantity, slice
from ({_SLICED_LINES.replace("select l_orderkey, (1", "select l_orderkey, l_linenumber, l_quantity, (1")}) where slice = 4"""
ORACLE["session_schemas"] = "select 'region_' || replace(lower(r_name), ' ', '_') as schema_name from region"

# Two bytes for each character and four for one beyond the basic plane.
_WIDE = "(2 * (length({0}) + length(regexp_replace({0}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g'))))"


def _wide_profile(table: str, text: str) -> str:
    return _profile(table, "text").replace("strlen(text)", _WIDE.format(text)).replace("text is null", f"{text} is null")


ORACLE["lob_profile_wide"] = _union(
    [_wide_profile("benchmark", "text").replace(f"{OBJECT_ID['benchmark']}::int", "1001::int"),
     _wide_profile("conversations", "text").replace(f"{OBJECT_ID['conversations']}::int", "1002::int"),
     _wide_profile("documents", "(case when lang = 'es' then text || '\U0001f600\u20ac\U00010348' else text end)")
     .replace(f"{OBJECT_ID['documents']}::int", "1003::int")]
)

# Texts without a declared length: all those of tables that Spark's catalog holds.
_SESSION_LOBS = [(t, c) for t, names in STRINGS.items() for c in names]
_SESSION_PROFILE = "profile as (\n" + _union([_profile(t, c) for t, c in _SESSION_LOBS]) + "\n)"
_SESSION_COUNTS = COUNTS.replace("'main'", "'tilewright_given'").replace(
    f"count(distinct {PARTITION['events']})", "1"
)
ORACLE["session_report"] = f"with {_SESSION_PROFILE},\n{_SESSION_COUNTS},\n{REPORT}\nselect * from report"


# Columns that hold no whole numbers, and those of times, whose dates are counted.
_NO_NUMBERS = """text role c_name c_acctbal c_mktsegment lang source embedding event_type value props l_quantity
  l_extendedprice l_discount l_tax l_returnflag l_linestatus n_name o_orderstatus o_totalprice o_orderpriority url html
  p_name p_brand p_type p_retailprice r_name s_name s_acctbal""".split()
_TIMES = ["ts", "l_shipdate", "o_orderdate"]
ORACLE["column_stats_bitmap"] = _union(
    [
        f"""select '{t}' as table_name, '{c}' as column_name,
  count(distinct {f"{c}::date" if c in _TIMES else c})::bigint as distinct_count from {t}"""
        for t, cs in COLUMNS.items()
        for c in cs.split()
        if c not in _NO_NUMBERS
    ]
)
ORACLE["column_stats_sketch"] = ORACLE["column_stats"]
