"""DuckDB counterpart of every registered query, written against the same derived views."""

from tallyloom import fixed_values as fixed
from tallyloom.plans import views
from tallyloom.plans.views import duck

_BOARD = duck(views.BOARD_ROWS)
_LEDGER = duck(views.BOARD_LEDGER)
_GLUE = duck(views.GLUE_ROWS)
_DIRTY = duck(views.DIRTY_CELLS)
_TRACKER = duck(views.TRACKER_PREV)
_HEADERS = duck(views.SUPPLIER_HEADERS)
_ITEMS = duck(views.ITEM_TARGET)
_NOW = "timestamp '2024-06-01 00:00:00'"
_THEN = "timestamp '2024-01-01 00:00:00'"
_VALID = r"regexp_full_match(%s, '\d+\s*[Mm]{2}\s*')"


def _long(rows: str, width: int, source: str, sheet: str, idx: str) -> str:
    """Cells of a view with columns t0, v0, t1, v1, ... in long form."""
    parts = [
        f"select {source} as source_id, {sheet} as sheet, {idx} as sheet_idx, row_num, "
        f"cast({i} as bigint) as col_idx, t{i} as dtype, case when t{i}<>'null' then v{i} end as sval from {rows}"
        for i in range(width)
    ]
    return "(" + " union all ".join(parts) + ")"


_BOARD_CELLS = _long(_BOARD, 5, "'boards'", "tab", "tab_idx")
_RAGGED_CELLS = f"""(select source_id, sheet, sheet_idx, row_num, col_idx, case when col_idx<5-row_num%3 then dtype else 'null' end as dtype,
  case when col_idx<5-row_num%3 then sval end as sval from {_BOARD_CELLS}
  qualify col_idx < max(5-row_num%3) over (partition by source_id, sheet, sheet_idx))"""
_EVENT_CELLS = (
    "(select 'events' as source_id, concat('s', sheet_idx) as sheet, sheet_idx, row_num, "
    f"cast(0 as bigint) as col_idx, dtype, case when dtype<>'null' then sval end as sval from {_DIRTY})"
)
_ORDER_TAGS = "o_orderkey:int o_custkey:int o_orderstatus:str o_totalprice:float o_orderdate:datetime o_orderpriority:str".split()
_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
_ORDER_CELLS = "(" + " union all ".join(
    "select 'orders' as source_id, o_orderstatus as sheet, cast(0 as bigint) as sheet_idx, o_orderkey as row_num, "
    f"cast({i} as bigint) as col_idx, "
    + (f"case when o_orderkey%3=0 then 'null' else '{t}' end" if c == "o_totalprice" else f"'{t}'")
    + f" as dtype, cast({c} as varchar) as sval from orders"
    for i, (c, t) in enumerate(x.split(":") for x in _ORDER_TAGS)
) + ")"


def _profile(cells: str, header: str = "k>=2", tokens: bool = False, names: tuple[str, ...] = ()) -> str:
    """Common table expressions of a profile: heads, body, totals, tallies, columns, issues.

    ``names`` are the columns of a table all of whose rows are data.
    """
    words = (
        "count(*) filter (lower(trim(sval)) in ('items','specifications'))" if tokens else "0"
    )
    place = "min(row_num)-1" if names else f"coalesce(min(row_num) filter ({header}), min(row_num))"
    titles = (
        f"select distinct source_id, sheet, sheet_idx, col_idx, {list(names)}[col_idx+1] as \"column\" from cells"
        if names
        else """select c.source_id, c.sheet, c.sheet_idx, c.col_idx,
                 coalesce(trim(c.sval), concat('col_', c.col_idx)) as "column"
          from cells c join heads h using (source_id, sheet, sheet_idx) where c.row_num=h.header_row"""
    )
    return f"""
with cells as materialized {cells},
grid as (select source_id, sheet, sheet_idx, row_num, count(*) filter (dtype<>'null') as k, {words} as w
         from cells group by all),
heads as (select source_id, sheet, sheet_idx, {place} as header_row
          from grid group by all),
body as (select c.* from cells c join heads h using (source_id, sheet, sheet_idx) where c.row_num>h.header_row),
totals as (select source_id, sheet, sheet_idx, h.header_row,
                  count(*) filter (g.row_num>h.header_row) as total,
                  count(*) filter (g.row_num>h.header_row and k>0) as filled
           from grid g join heads h using (source_id, sheet, sheet_idx) group by all),
tallies as (select source_id, sheet, sheet_idx, col_idx, dtype, count(*) as n, min(row_num) as first_row
            from body where dtype<>'null' group by all),
names as ({titles}),
types as (select source_id, sheet, sheet_idx, col_idx, count(*) as kinds,
                 string_agg(concat(dtype,':',n), ',' order by first_row) as types,
                 string_agg(concat('''',dtype,''': ',n), ', ' order by first_row) as shown,
                 first(dtype order by n desc, first_row) as dominant
          from tallies where dtype<>'formula' group by all),
filled as (select source_id, sheet, sheet_idx, col_idx, cast(sum(n) as bigint) as n,
                  cast(coalesce(sum(n) filter (dtype='formula'),0) as bigint) as formulas
           from tallies group by all),
cols as (select n.*, t.total as total_data_rows, t.total-coalesce(f.n,0) as null_count,
                case when t.total=0 then 0.0::double
                     else round((t.total-coalesce(f.n,0))::double/t.total*100,1) end as null_pct,
                coalesce(f.n,0) as non_null_count, coalesce(y.dominant,'unknown') as dominant_type,
                coalesce(y.types,'') as types, y.shown, coalesce(f.formulas,0) as formula_cells,
                coalesce(y.kinds,0)>1 as type_inconsistent
         from names n join totals t using (source_id, sheet, sheet_idx)
         left join filled f using (source_id, sheet, sheet_idx, col_idx)
         left join types y using (source_id, sheet, sheet_idx, col_idx)),
body_rows as (select source_id, sheet, sheet_idx, row_num,
                list(concat(dtype,'|',sval) order by col_idx) as cells_of_row
         from body group by all having count(*) filter (dtype<>'null')>0),
dups as (select source_id, sheet, sheet_idx, cast(sum(n-1) as bigint) as duplicate_row_count
         from (select source_id, sheet, sheet_idx, cells_of_row, count(*) as n from body_rows group by all)
         group by all),
texts as (
  select source_id, sheet, sheet_idx, col_idx, 0 as pos,
         concat('Column ''',"column",''': mixed types {{',shown,'}}') as issue from cols where type_inconsistent
  union all select source_id, sheet, sheet_idx, col_idx, 1,
         concat('Column ''',"column",''': ',null_pct,'% null') from cols where null_pct>50
  union all select source_id, sheet, sheet_idx, col_idx, 2,
         concat('Column ''',"column",''': ',formula_cells,' formula cell(s) (data_only=True may suppress values)')
         from cols where formula_cells>0
  union all select source_id, sheet, sheet_idx, 1000000, 0,
         concat(duplicate_row_count,' duplicate data row(s) detected') from dups where duplicate_row_count>0),
issues as (select source_id, sheet, sheet_idx,
                  row_number() over (partition by source_id, sheet, sheet_idx order by col_idx, pos) as issue_no, issue
           from texts),
widths as (select source_id, sheet, sheet_idx, max(col_idx)+1 as column_count from cells group by all),
report as (select source_id, sheet, sheet_idx, t.header_row, w.column_count, t.total as total_data_rows,
                  t.filled as non_empty_data_rows, coalesce(d.duplicate_row_count,0) as duplicate_row_count,
                  coalesce(i.n,0) as issue_count,
                  case when coalesce(i.n,0)=0 then 'OK' else concat('! ',i.n,' issue(s)') end as flag,
                  cast(null as varchar) as error
           from totals t join widths w using (source_id, sheet, sheet_idx)
           left join dups d using (source_id, sheet, sheet_idx)
           left join (select source_id, sheet, sheet_idx, count(*) as n from issues group by all) i
             using (source_id, sheet, sheet_idx))
""".replace("{{", "{").replace("}}", "}")


_COLUMNS = "select * exclude (shown) from cols"
_TWO_GRIDS = f"(select * from {_BOARD_CELLS} union all select * from {_EVENT_CELLS})"

_REGISTRY = f"""(select concat('glue_',n_nationkey,'.grid') as filename, concat('glue_',n_nationkey) as source_id,
  case when n_nationkey%6=5 then '{fixed.SUPPLIER_SEED}' else '{fixed.GLUE_SEED}' end as seed_type,
  case when n_nationkey%2=0 then 'bags' end as base_uom, n_name as description, n_nationkey from nation)"""
_STATUSES = f"""(select filename, source_id, seed_type, base_uom, description,
  concat('raw/',filename) as file_key, case when b.k is not null then sha256(cast(last as varchar)) end as hash, b.size_bytes,
  case when b.k is null then 'missing' when n_nationkey%9=4 then 'error' else 'ok' end as status,
  case when b.k is null then concat('File not found: raw/',filename) when n_nationkey%9=4 then 'not a workbook' end as error
  from {_REGISTRY} r left join (select s_nationkey as k, count(*)*777 as size_bytes, max(s_suppkey) as last
                               from supplier group by 1) b on b.k=r.n_nationkey)"""

_FILES = """(select cast(doc_id as varchar) as file_key, concat('doc_',doc_id) as filename, source as source_id,
  sha256(text) as hash, cast(strlen(text) as bigint) as size_bytes, doc_id, n_chars from documents)"""
_STATE = f"""(select cast(file_key as varchar) as file_key, hash, status,
  case when status='loaded' then timestamp '2024-01-02 00:00:00' end as loaded_at from {_TRACKER})"""
_FLAGS = f"""(select f.*, coalesce(t.status,'pending') as status,
  t.file_key is null or f.hash<>t.hash or coalesce(t.status,'pending') not in ('processed','loaded') as needs_processing
  from {_FILES} f left join {_STATE} t using (file_key))"""
_INCREMENTAL = f"""(select file_key, case when needs_processing or doc_id%7=0 then size_bytes else n_chars end as size,
  case when needs_processing or doc_id%7=0 then 'processed' else 'skipped' end as outcome from {_FLAGS})"""


def _upserted(chosen: str, source: str, hash_: str, size: str, status: str, processed: str, loaded: str) -> str:
    return f"""select coalesce(t.file_key,f.file_key) as file_key, {source} as source_id, {hash_} as hash,
  {size} as size_bytes, {status} as status, {processed} as processed_at, {loaded} as loaded_at
  from {_STATE} t full join {chosen} f on t.file_key=f.file_key"""


# Names, first rows and variants of the valid board tabs, below the header in row 2.
_TABS = f"""
with body as (select tab as sheet, tab_idx as sheet_idx, row_num,
                     case when t1<>'null' and length(trim(v1))>0 then trim(v1) end as items,
                     case when t2<>'null' and length(trim(v2))>0 then trim(v2) end as spec
              from {_BOARD} where {_VALID % 'tab'} and row_num>2),
tabs as (select sheet, sheet_idx, cast(2 as bigint) as header_row,
                arg_min(items,row_num) filter (items is not null) as items,
                min(row_num) filter (items is not null) as items_row,
                concat(arg_min(items,row_num) filter (items is not null),' MDF') as display_name,
                arg_min(spec,row_num) filter (spec is not null) as spec,
                min(row_num) filter (spec is not null) as spec_row,
                count(distinct spec) as variant_count, cast(null as varchar) as error
         from body group by all),
variants as (select sheet, sheet_idx, spec, min(row_num) as first_row, count(*) as n from body
             where spec is not null group by all),
marked as (select *, count(*) over (partition by sheet) as variant_count,
                  first_row=min(first_row) over (partition by sheet) as is_canonical from variants)
"""


def _board_parse(spec: str) -> tuple[str, list[str]]:
    """Error text and the three values of a board specification."""
    parts = f"string_split({spec},'*')"
    numbers = [f"try_cast(trim({parts}[{i}]) as decimal(12,4))" for i in (1, 2, 3)]
    bad = " or ".join(f"{n} is null" for n in numbers)
    error = (
        f"case when len({parts})<>3 then concat('Expected 3 segments separated by ''*'', got ',len({parts}),': ''',{spec},'''') "
        f"when {bad} then concat('Non-numeric segment in ''',{spec},'''') end"
    )
    return error, [f"case when len({parts})=3 and not ({bad}) then {n} end" for n in numbers]


_ERR, _NUM = _board_parse("spec")
_PARSED = f"{_NUM[0]} as thickness, {_NUM[1]} as width, {_NUM[2]} as length, {_ERR} as error, false as overflow"
_PROPS = (
    _TABS
    + f""", parsed as (select sheet, sheet_idx, display_name, {_PARSED} from tabs where spec is not null),
props as (select sheet_idx as seq, sheet as parent_key, nullif(display_name,' MDF') as display_name,
                 unnest(['thickness','width','length']) as property_name,
                 unnest([thickness,width,length]) as property_value
          from (select * replace (case when display_name=' MDF' then null else display_name end as display_name) from parsed where error is null))
"""
)
_TITLE = (
    "array_to_string(list_transform(regexp_extract_all(%s,'[a-zA-Z]+|[^a-zA-Z]+'), "
    "lambda x: concat(upper(x[1]),lower(x[2:]))),'')"
)
_GLUE_TABS = f"""
with body as (select source_id, row_num,
                     case when t1<>'null' and length(trim(v1))>0 then trim(v1) end as items,
                     case when t2<>'null' and length(trim(v2))>0 then trim(v2) end as spec
              from {_GLUE} where sheet_idx=0 and row_num>2),
tabs as (select source_id, arg_min(items,row_num) filter (items is not null) as items,
                min(row_num) filter (items is not null) as items_row,
                arg_min(spec,row_num) filter (spec is not null) as spec,
                count(distinct spec) as variant_count
         from body group by all),
named as (select *, {_TITLE % 'items'} as display_name from tabs)
"""
_GLUE_RE = r"'^(\d+(?:\.\d+)?)kg/(\d+)bag$'"
_SHEET_KEYS_N = "concat('nation ',n_nationkey) as sheet, cast(n_nationkey as bigint) as sheet_idx"
_EXPECTED = "(values " + ", ".join(
    f"({i},'{n}','{k}','{t}',{str(r).lower()})" for i, (n, k, t, r) in enumerate(fixed.FIELD_MAPPING)
) + ") as m(pos, field_name, field_key, field_type, is_required)"

_THRESHOLD_DOCS = """(select p_partkey as k, p_size,
  case when p_partkey%31=0 then 'not valid JSON' when p_partkey%29=0 then 'not a JSON object at the top level'
       when p_partkey%37=0 then 'missing required key ''thresholds''' when p_partkey%41=0 then '''thresholds'' is not a JSON object' end as shape_error,
  concat(p_partkey,'mm MDF') as name,
  case when p_partkey%6=0 then 'true' when p_partkey%6=1 then '1.5' when p_partkey%6=2 then '"5"'
       when p_partkey%6=3 then concat('-',p_size) when p_partkey%12=4 then '0' else cast(p_size as varchar) end as v,
  p_partkey%6>3 and p_partkey%12<>4 as good from part)"""

# Inputs of the item merge, with the first tab of each name.
_ITEM_MERGE = (
    _TABS
    + f""", target as {_ITEMS},
inputs as (select sheet_idx as seq, sheet as parent_key, case when items is not null then display_name end as display_name from tabs),
ranked as (select *, row_number() over (partition by display_name order by seq) as r from inputs),
actions as (select r.seq, r.parent_key, r.display_name,
                   case when r.display_name is null then 'fail' when r.r>1 then 'skip' when t.item_id is null then 'insert'
                        when t.category is null or t.base_uom is null then 'repair' else 'skip' end as action,
                   r.display_name is not null and r.r>1 as collision,
                   case when r.display_name is null then '{fixed.MSG_NO_ITEMS.replace("'", "''")}' end as reason
            from ranked r left join target t using (display_name))
"""
)
_GLUE_MERGE = (
    _GLUE_TABS
    + f""", target as {_ITEMS},
inputs as (select cast(regexp_extract(source_id,'(\\d+)',1) as bigint) as seq, source_id as parent_key, display_name,
                  coalesce(r.base_uom,'units') as base_uom
           from named join {_REGISTRY} r using (source_id) where r.seed_type='{fixed.GLUE_SEED}'),
ranked as (select *, row_number() over (partition by display_name order by seq) as r from inputs),
actions as (select r.seq, r.parent_key, r.display_name, r.base_uom,
                   case when r.display_name is null then 'fail' when r.r>1 then 'skip' when t.item_id is null then 'insert'
                        when t.category is null or t.base_uom is null then 'repair' else 'skip' end as action,
                   r.display_name is not null and r.r>1 as collision
            from ranked r left join target t using (display_name))
"""
)
_PROPERTY_MERGE = (
    _PROPS
    + f""", target as {_ITEMS},
existing as (select item_id, 'thickness' as property_name,
                    cast(item_id+case when item_id%3=0 then 1 else 0 end as decimal(12,4)) as property_value, {_THEN} as created_at
             from target where item_id%2=0),
found as (select t.item_id, p.* from props p left join target t using (display_name)),
ranked as (select f.*, e.property_value as old, e.item_id is not null as present,
                  row_number() over (partition by f.item_id, f.property_name order by f.seq) as r,
                  first_value(f.property_value) over (partition by f.item_id, f.property_name order by f.seq) as first_value
           from found f left join existing e on e.item_id=f.item_id and e.property_name=f.property_name),
actions as (select item_id, seq, parent_key, display_name, property_name, property_value,
                   case when item_id is null then 'blocked' when present or r>1 then 'skip' else 'insert' end as action,
                   case when item_id is null then false when present then property_value<>old
                        else property_value<>first_value end as value_differs,
                   cast(null as varchar) as reason
            from ranked)
"""
)
_FIELD_MERGE = f"""
with headers as (select trim(header) as h from {_HEADERS}),
mapping as (select field_name, field_key, field_type, is_required<>(pos=2) as is_required from {_EXPECTED}
            union all select 'Remarks', 'remarks', 'text', false),
found as (select * from mapping where field_name in (select h from headers)),
wanted as (select c_custkey as item_id, c_name as display_name, found.* from customer, found),
existing as (select c_custkey as item_id, m.field_name, m.field_key, m.field_type,
                    case (c_custkey+m.pos)%7 when 0 then m.is_required when 1 then not m.is_required end as is_required,
                    {_THEN} as created_at
             from customer, {_EXPECTED} where (c_custkey+m.pos)%7<3),
actions as (select w.item_id, w.display_name, w.field_name, w.field_key, w.field_type, w.is_required,
                   e.is_required as existing_required,
                   case when e.item_id is null then 'insert' when e.is_required is not distinct from w.is_required then 'skip'
                        else 'conflict' end as action
            from wanted w left join existing e on e.item_id=w.item_id and e.field_key=w.field_key)
"""
_THRESHOLD_MERGE = f"""
with target as {_ITEMS},
wanted as (select concat(p_size,'mm MDF') as display_name,
                  cast(case when max(p_partkey)%3=0 then p_size*10 else p_size*7 end as integer) as new_value
           from part group by p_size),
actions as (select w.display_name, t.item_id, t.reorder_threshold as old_value, w.new_value,
                   case when t.item_id is null then 'blocked' when t.reorder_threshold=w.new_value then 'skip' else 'update' end as action
            from wanted w left join target t using (display_name))
"""
_OUTCOMES = """(select event_type as script, concat('tab',user_id%50) as parent_key, concat('p',event_id%3) as child_key,
  event_id%4<>0 as ok, concat('reason ',event_id%5) as reason, concat('event=',event_id) as detail, event_id as seq from events)"""
_PENDING = f"""(select case c_custkey%3 when 0 then 'click' when 1 then 'view' else 'purchase' end as script,
  concat('tab',c_custkey%60) as parent_key, case when c_custkey%5=0 then 'all' else concat('p',c_custkey%4) end as child_key,
  'earlier' as reason, '' as detail, max(-c_custkey) as seq, {_THEN} as ts from customer group by 1,2,3)"""
_LAST = f"""(select script, parent_key, child_key, arg_max(ok,seq) as ok, arg_max(reason,seq) as reason,
  arg_max(detail,seq) as detail, max(seq) as seq from {_OUTCOMES} group by 1,2,3)"""


def _counts(names) -> str:
    return ", ".join(f"count(*) filter (action='{n}') as \"{n}\"" for n in names)


_ITEM_ACTIONS = ["insert", "repair", "skip", "fail"]

ORACLES: dict[str, str] = {
    "sheet_catalog": f"""select 'boards' as source_id, tab as sheet, tab_idx as sheet_idx, count(*) as total_rows,
        count(*) filter (least(t0,t1,t2,t3,t4)<>'null' or greatest(t0,t1,t2,t3,t4)<>'null') as non_empty_rows, cast(5 as bigint) as column_count,
        min(row_num) filter ((t0<>'null')::int+(t1<>'null')::int+(t2<>'null')::int+(t3<>'null')::int+(t4<>'null')::int>=2) as header_row
        from {_BOARD} group by all""",
    "source_status": f"select * from {_STATUSES}",
    "source_catalog": f"""select source_id, filename, seed_type, base_uom, description, status, error,
        case when status='ok' then file_key end as path, case when status='ok' then round(size_bytes/1024,1) end as file_size_kb,
        case when status='ok' then coalesce(n,0) end as sheet_count
        from {_STATUSES} left join (select source_id, count(distinct sheet) as n from {_GLUE} group by 1) using (source_id)""",
    "registry_sources": f"""select filename, source_id, seed_type, coalesce(base_uom,'units') as base_uom, description
        from {_REGISTRY} where seed_type='{fixed.GLUE_SEED}'""",
    "first_sheet_rows": f"select source_id, sheet, count(*) as n from {_GLUE} where sheet_idx=0 group by all",
    "missing_sheets": f"""select r.source_id, 'notes' as sheet, coalesce(n,0) as available_sheets from {_REGISTRY} r
        left join (select source_id, count(distinct sheet) as n, bool_or(sheet='notes') as there from {_GLUE} group by 1) g
        using (source_id) where not coalesce(there,false)""",
    "long_cells": f"select * exclude (source_id) from {_BOARD_CELLS}",
    "sheet_preview": f"select * exclude (source_id) from {_BOARD_CELLS} where row_num<=5",
    "column_types": _profile(_EVENT_CELLS) + "select * from tallies where dtype<>'formula'",
    "column_profile": _profile(_EVENT_CELLS) + _COLUMNS,
    "board_column_profile": _profile(_BOARD_CELLS) + _COLUMNS,
    "ragged_profile": _profile(_RAGGED_CELLS) + _COLUMNS,
    "named_header_profile": _profile(_BOARD_CELLS, "w>=2", tokens=True) + _COLUMNS,
    "typed_table_profile": _profile(_ORDER_CELLS, names=_ORDER_COLUMNS) + _COLUMNS,
    "duplicate_rows": _profile(_EVENT_CELLS) + "select * from dups",
    "document_duplicates": """select 'documents' as source_id, lang as sheet, cast(0 as bigint) as sheet_idx, cast(sum(n-1) as bigint) as duplicate_row_count
        from (select lang, text, source, count(*) as n from documents group by all) group by lang""",
    "quality_issues": _profile(_BOARD_CELLS) + "select * from issues",
    "sheet_report": _profile(_TWO_GRIDS)
    + """select * from report union all select 'blank', r_name, r_regionkey, null, null, null, null, null, null, 'OK', 'empty sheet' from region""",
    "source_report": _profile(_TWO_GRIDS)
    + "select source_id, count(*) as sheet_count, cast(sum(issue_count) as bigint) as total_issues from report group by 1",
    "quality_report": _profile(_EVENT_CELLS)
    + """select source_id, sheet, sheet_idx, flag, non_empty_data_rows, issue_no, issue
        from report left join issues using (source_id, sheet, sheet_idx)""",
    "change_flags": f"select file_key, status, needs_processing from {_FLAGS}",
    "changed_sources": f"select file_key, hash from {_FLAGS} where needs_processing",
    "forced_run": f"select file_key from {_FILES}",
    "ready_to_load": f"select file_key, filename from {_FLAGS} where status='processed'",
    "status_summary": f"select status, count(*) as n from {_STATE} group by 1",
    "tracker_upsert": _upserted(
        f"(select * from {_FLAGS} where needs_processing)", "f.source_id", "coalesce(f.hash,t.hash)", "f.size_bytes",
        "case when f.file_key is not null then 'processed' else t.status end",
        f"case when f.file_key is not null then {_NOW} end", "t.loaded_at",
    ),
    "tracker_keep_loaded": _upserted(
        f"(select * from {_FLAGS} where status<>'loaded')", "f.source_id", "coalesce(f.hash,t.hash)", "f.size_bytes",
        "case when f.file_key is not null then 'processed' else t.status end",
        f"case when f.file_key is not null then {_NOW} end", "t.loaded_at",
    ),
    "tracker_loaded": _upserted(
        f"(select * from {_FLAGS} where status<>'loaded')", "cast(null as varchar)", "t.hash", "cast(null as bigint)",
        "case when f.file_key is not null then 'loaded' else t.status end",
        "cast(null as timestamp)", f"case when f.file_key is not null then {_NOW} else t.loaded_at end",
    ),
    "tracker_reset": _upserted(
        f"(select * from {_FLAGS} where status<>'pending')", "cast(null as varchar)", "t.hash", "cast(null as bigint)",
        "case when f.file_key is not null then 'pending' else t.status end",
        "cast(null as timestamp)", "t.loaded_at",
    ),
    "incremental_carry_forward": f"select * from {_INCREMENTAL}",
    "run_counters": f"select outcome, count(*) as n from {_INCREMENTAL} group by 1",
    "valid_tabs": f"select tab as sheet, {_VALID % 'tab'} as valid, count(*) as n from {_BOARD} group by all",
    "header_rows": f"""select 'boards' as source_id, tab as sheet, tab_idx as sheet_idx,
          min(row_num) filter ((t0<>'null')::int+(t1<>'null')::int+(t2<>'null')::int+(t3<>'null')::int+(t4<>'null')::int>=2) as two_cells,
          min(row_num) filter ((length(trim(v0))>0)::int+coalesce((length(trim(v1))>0)::int,0)+coalesce((length(trim(v2))>0)::int,0)+coalesce((length(trim(v3))>0)::int,0)+coalesce((length(trim(v4))>0)::int,0)>=2) as two_texts,
          min(row_num) filter (lower(trim(v0))='date' and lower(trim(v1))='items') as item_tokens,
          min(row_num) filter (lower(trim(v1))='items' and lower(trim(v2))='specifications') as spec_tokens
        from {_BOARD} group by all
        union all select 'suppliers', concat('nation ',n_nationkey), n_nationkey, 1, 4, null, null from nation""",
    "first_items": _TABS
    + "select sheet, items_row as row_num, display_name from tabs where items is not null",
    "tab_overview": _TABS
    + "select * replace (case when items is not null then display_name end as display_name) from tabs",
    "spec_variants": _TABS + "select * from marked",
    "bad_variants": _TABS
    + f"select sheet, spec, concat(sheet,'.variant_',spec) as key, error from (select sheet, spec, is_canonical, {_ERR} as error from marked) where not is_canonical and error is not null",
    "board_specs": _TABS
    + f"select sheet, case when items is not null then display_name end as display_name, spec, {_PARSED} from tabs where spec is not null",
    "board_properties": _PROPS + "select *, concat(parent_key,'.',property_name) as key from props",
    "all_specs_parsed": f"select row_num, {_PARSED} from {_LEDGER} where spec is not null",
    "glue_names": _GLUE_TABS + "select source_id, items, display_name, items_row from named",
    "glue_specs": _GLUE_TABS
    + f"""select source_id, spec, variant_count,
        try_cast(nullif(regexp_extract(spec,{_GLUE_RE},1,'i'),'') as decimal(12,4)) as weight_per_bag_kg,
        try_cast(nullif(regexp_extract(spec,{_GLUE_RE},2,'i'),'') as decimal(12,4)) as bags_per_unit,
        case when not regexp_matches(spec,{_GLUE_RE},'i') then concat('Unrecognised format ''',spec,''' — expected e.g. ''25kg/1bag''') end as error,
        false as overflow from named where spec is not null""",
    "sheet_headers": f"select {_SHEET_KEYS_N}, cast(4 as bigint) as header_row, rank as col_idx, trim(header) as header from (select *, row_number() over (partition by n_nationkey order by col_idx) as rank from {_HEADERS})",
    "missing_headers": f"""select concat('nation ',n_nationkey) as sheet, m.field_name as header, concat('header::',m.field_name) as key
        from nation, {_EXPECTED} where (n_nationkey, m.field_name) not in (select (n_nationkey, trim(header)) from {_HEADERS})""",
    "mapped_fields": f"""select {_SHEET_KEYS_N}, rank as col_idx, m.field_name, m.field_key, m.field_type, m.is_required
        from (select *, row_number() over (partition by n_nationkey order by col_idx) as rank from {_HEADERS}) h
        join {_EXPECTED} on m.field_name=trim(h.header)""",
    "threshold_errors": f"""select case when shape_error is null then name end as display_name,
          case when shape_error is null then v end as value_text,
          coalesce(shape_error, concat('''',name,''': ',v,' (must be a positive integer)')) as error, count(*) as n
        from {_THRESHOLD_DOCS} where shape_error is not null or not good group by all""",
    "valid_thresholds": f"select name as display_name, p_size as threshold from {_THRESHOLD_DOCS} where shape_error is null and good",
    "repeated_names": f"""select display_name, count(*) as n from (select distinct tab, concat(trim(items),' MDF') as display_name
        from {_LEDGER} where length(trim(items))>0) group by 1 having count(*)>1""",
    "repeated_properties": "select l_orderkey, l_suppkey, count(*) as n from lineitem group by all having count(*)>1",
    "invalid_items": """select item_id, error from (select p_partkey as item_id,
          case when p_partkey%10=0 then 'display_name is null'
               when p_partkey%10=1 and length(p_name)*30>255 then 'display_name longer than 255'
               when p_partkey%7=0 and length(p_type)*10>100 then 'category longer than 100' end as error from part) where error is not null""",
    "orphans": """select o_orderkey, o_custkey as item_id from orders
        where o_custkey not in (select c_custkey from customer where c_custkey%10<>3)""",
    "cascade_delete": """select o_orderkey, o_custkey as item_id from orders
        where o_custkey in (select c_custkey from customer where c_custkey%10<>3)""",
    "column_defaults": f"""select s_suppkey as item_id, case when s_suppkey%2=0 then 'decimal' else 'text' end as field_type,
        s_suppkey%3=0 as is_required, {_NOW} as created_at from supplier""",
    "merge_items": _ITEM_MERGE + "select * from actions",
    "merged_items": _ITEM_MERGE
    + """select t.item_id as old_id, t.display_name, coalesce(t.category,case when a.display_name is not null then 'Raw Material' end) as category,
          coalesce(t.base_uom,case when a.display_name is not null then 'sheets (pcs)' end) as base_uom, t.reorder_threshold,
          a.display_name is not null as touched, true as id_kept
        from target t left join (select * from actions where action='repair') a using (display_name)
        union all select null, display_name, 'Raw Material', 'sheets (pcs)', null, true, true from actions where action='insert'""",
    "item_ids": "select count(*) as n, count(*) as distinct_ids, cast(1001 as bigint) as lowest, 1000+count(*) as highest from customer",
    "merge_glue_items": _GLUE_MERGE + "select * from actions",
    "merge_properties": _PROPERTY_MERGE + "select * exclude (property_value) from actions",
    "merged_properties": _PROPERTY_MERGE
    + f"select * from existing union all select item_id, property_name, property_value, {_NOW} from actions where action='insert'",
    "merge_fields": _FIELD_MERGE + "select * from actions",
    "merged_fields": _FIELD_MERGE
    + f"select * from existing union all select item_id, field_name, field_key, field_type, is_required, {_NOW} from actions where action='insert'",
    "apply_thresholds": _THRESHOLD_MERGE + "select * from actions",
    "items_after_thresholds": _THRESHOLD_MERGE
    + f"""select t.item_id, t.display_name, t.category, t.base_uom, coalesce(a.new_value,t.reorder_threshold) as reorder_threshold,
          {_THEN} as created_at, case when a.new_value is not null then {_NOW} else {_THEN} end as updated_at
        from target t left join (select * from actions where action='update') a using (display_name)""",
    "audit_trail": _THRESHOLD_MERGE
    + f"""select '{fixed.STAGE_THRESHOLDS}' as script, display_name as material, 'reorder_threshold' as field,
        cast(old_value as bigint) as old_value, cast(new_value as bigint) as new_value, action, {_NOW} as ts from actions""",
    "items_by_name": f"select item_id, display_name from {_ITEMS} order by display_name",
    "quarantine_delta": f"""select p.* from {_PENDING} p where (script,parent_key,child_key) not in (select (script,parent_key,child_key) from {_LAST})
        union all select script, parent_key, child_key, reason, detail, seq, {_NOW} from {_LAST} where not ok""",
    "quarantine_by_parent": f"""select p.* from {_PENDING} p
          where not (script='click' and parent_key in (select parent_key from {_OUTCOMES} where script='click'))
        union all select script, parent_key, child_key, arg_max(reason,seq), arg_max(detail,seq), max(seq), {_NOW}
          from {_OUTCOMES} where script='click' and not ok group by 1,2,3""",
    "file_keys": """select page_id, concat(case page_id%4 when 2 then 'rawer/' when 3 then 's3://data/raw/' else 'raw/' end, page_id, ' #', url) as file_key
        from pages""",
    "json_log": "select conv_id, turn::bigint as turn, role, sha256(text) as text_sha256 from conversations",
    "csv_documents": "select doc_id, source, sha256(nullif(text, '')) as text_sha256 from documents",
    "listed_files": """with b as (
            select page_id//100 as book, string_agg(concat(concat_ws('|',printf('%012d',page_id),url),chr(10)),'' order by page_id) as content
            from pages group by 1
        ) select book, sha256(content) as hash, strlen(content)::bigint as size_bytes, null::varchar as error from b""",
    "failure_keys": f"""with k as (
            select c_custkey, replace(c_name,'#','.') as parent, c_custkey%4 as stage,
                case c_nationkey%9 when 0 then 'all' when 1 then 'parse' when 2 then 'thickness' when 3 then 'width' when 4 then 'length'
                    when 5 then 'weight_per_bag_kg' when 6 then 'bags_per_unit' when 7 then c_mktsegment
                    else concat('variant_',c_mktsegment,'.all',c_nationkey) end as child,
                stage=2 or (stage in (1,3) and c_nationkey%9<>7) as apart
            from customer
        ) select c_custkey, case stage when 0 then '{fixed.STAGE_ITEMS}' when 1 then '{fixed.STAGE_SPECS}' when 2 then '{fixed.STAGE_FIELDS}'
                else '{fixed.STAGE_GLUE_SPECS}' end as script,
            case when apart then parent else concat(parent,'.',child) end as parent_key,
            case when apart then child else '' end as child_key,
            concat(parent,case when stage=2 then '::' else '.' end,child) as key from k""",
    "failed_keys": f"select distinct parent_key, child_key from {_PENDING} where script='click'",
    "retry_tabs": f"""select parent_key, seq, parent_key in (select parent_key from {_PENDING} where script='view') as retried from {_OUTCOMES}""",
    "retry_properties": f"""select parent_key, child_key, seq from {_OUTCOMES}
        where parent_key in (select parent_key from {_PENDING} where script='purchase' and child_key='all')
           or (parent_key, child_key) in (select (parent_key, child_key) from {_PENDING} where script='purchase' and child_key<>'all')""",
    "run_summary": _ITEM_MERGE + f"select {_counts(_ITEM_ACTIONS)} from actions",
    "property_counts": _PROPERTY_MERGE
    + f"select parent_key, {_counts(['insert', 'skip', 'blocked', 'fail'])} from actions group by 1",
    "load_manifest": _GLUE_MERGE
    + f"""select '{fixed.STAGE_GLUE_ITEMS}' as script, parent_key as source_id, 'full' as mode, {_NOW} as loaded_at, {_counts(_ITEM_ACTIONS)}
        from actions group by parent_key having count(*) filter (action='fail')=0""",
}
