"""Ledger-shaped inputs derived from the given tables, as SQL both engines understand.

``{S}`` is the text type and ``{H}`` the SHA-256 of ``text``; table names stand in braces.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.fixed_values import FIELD_MAPPING
from tallyloom.functions.cells import make_cell
from tallyloom.sources.grid import grid_from_table

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

BOARD_LEDGER = """
select case when p_size%10=0 then concat('sales form ',cast(p_size as {S}))
            else concat(cast(p_size as {S}), case p_size%3 when 0 then 'MM' when 1 then 'mm' else 'MM ' end) end as tab,
       cast(p_size as bigint) as tab_idx, p_partkey, p_partkey+3 as row_num,
       case when p_partkey%5=0 then null when p_partkey%11=0 then '  '
            else concat(' ',cast(p_size-(case when p_size%7=0 then 1 else 0 end) as {S}),'mm') end as items,
       case when p_partkey%13=0 then null when p_partkey%17=0 then '1*2' when p_partkey%19=0 then 'a*1*2'
            else concat(cast(p_size as {S}),'*122*',cast(244+p_partkey%3 as {S})) end as spec
from {part}
"""

# Board sheets with preamble, header and data rows: tag and text of five cells per row.
BOARD_ROWS = (
    "with ledger as (" + BOARD_LEDGER + """)
select tab, tab_idx, row_num,
       case when p_partkey%23=0 then 'null' else 'datetime' end as t0,
       case when p_partkey%23<>0 then concat('2024-01-0',cast(1+p_partkey%2 as {S}),' 00:00:00') end as v0,
       case when p_partkey%23=0 or items is null then 'null' else 'str' end as t1,
       case when p_partkey%23<>0 then items end as v1,
       case when p_partkey%23=0 or spec is null then 'null' else 'str' end as t2,
       case when p_partkey%23<>0 then spec end as v2,
       case when p_partkey%23=0 then 'null' when p_partkey%4=0 then 'float' else 'int' end as t3,
       case when p_partkey%23<>0 then concat(cast(p_partkey%3 as {S}), case when p_partkey%4=0 then '.0' else '' end) end as v3,
       case when p_partkey%23=0 or p_partkey%2=1 then 'null' else 'formula' end as t4,
       case when p_partkey%23<>0 and p_partkey%2=0 then concat('=D',cast(p_partkey%6 as {S})) end as v4
from ledger
union all
select distinct tab, tab_idx, cast(1 as bigint), 'str','INPUT','null',null,'null',null,'null',null,'str','OUTPUT' from ledger
union all
select distinct tab, tab_idx, cast(2 as bigint), 'str','Date','str',' Items','str','Specifications','str','quantity','str','balance' from ledger
"""
)

GLUE_LEDGER = """
select concat('glue_',cast(s_nationkey as {S})) as source_id, s_suppkey as row_num,
       concat('glue-',lower(s_name)) as items,
       case when s_suppkey%7=0 then null when s_suppkey%9=0 then 'bag of 25'
            else concat(cast(s_suppkey%50 as {S}), case when s_suppkey%2=0 then 'kg/' else 'KG/' end,
                        cast(1+s_suppkey%3 as {S}),'bag') end as spec
from {supplier}
"""

# Glue books: header and data on the first sheet, a second sheet that has to be ignored.
GLUE_ROWS = (
    "with ledger as (" + GLUE_LEDGER + """)
select source_id, 'GLUE' as sheet, cast(0 as bigint) as sheet_idx, row_num+3 as row_num,
       'datetime' as t0, '2024-01-01 00:00:00' as v0,
       case when row_num%4=0 then 'null' else 'str' end as t1, case when row_num%4<>0 then items end as v1,
       case when spec is null then 'null' else 'str' end as t2, spec as v2
from ledger
union all
select distinct source_id, 'GLUE', cast(0 as bigint), cast(1 as bigint), 'str','INPUT','null',null,'str','OUTPUT' from ledger
union all
select distinct source_id, 'GLUE', cast(0 as bigint), cast(2 as bigint), 'str','Date','str','Items','str','Specifications' from ledger
union all
select source_id, 'notes', cast(1 as bigint), row_num, 'str','Date','str','Items','str','Specifications' from ledger where row_num%8=0
"""
)

DIRTY_CELLS = """
select cast(event_id%4 as bigint) as sheet_idx, event_id as row_num,
       case when event_id%8=3 then 'null' when event_id%97=1 then 'str' when event_id%101=2 then 'formula'
            when user_id%2=0 then 'int' else 'float' end as dtype,
       case when event_id%8=3 then null when event_id%97=1 then event_type when event_id%101=2 then '=A1'
            else cast(user_id%20 as {S}) end as sval
from {events}
"""

TRACKER_PREV = """
select doc_id as file_key, case when doc_id%10=0 then 'stale' else h end as hash,
       case doc_id%3 when 0 then 'processed' when 1 then 'loaded' else 'pending' end as status
from (select doc_id, {H} as h from {documents}) as hashed where doc_id%6<>5
"""

# One supplier sheet per nation: title rows, the header in row 4, deliveries below it. The
# header list of nation n lacks every fifth mapped header, counted from n. (For DuckDB;
# ``supplier_grid`` says the same for Spark.)
_MAPPED = ", ".join(
    f"({i}, '{name}{' ' if i % 4 == 1 else ''}')" for i, (name, *_) in enumerate(FIELD_MAPPING)
)
SUPPLIER_HEADERS = f"""
select n_nationkey, cast(h.pos + 1 as bigint) as col_idx, h.name as header
from {{nation}}, (values {_MAPPED}, (17, 'Remarks'), (18, 'date')) as h(pos, name)
where h.pos >= 17 or (n_nationkey + h.pos) % 5 <> 0
"""

ITEM_TARGET = (
    "with ledger as (" + BOARD_LEDGER + """),
names as (select concat(trim(items),' MDF') as display_name, min(tab_idx) as k
          from ledger where items is not null and length(trim(items))>0 group by 1)
select k as item_id, display_name,
       case when k%3=0 then null else 'Raw Material' end as category,
       case when k%4=0 then null else 'pcs' end as base_uom,
       case when k%2=0 then cast(k*10 as int) end as reorder_threshold
from names where k%5<>1
"""
)


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """One of the SQL views above, run on Spark."""
    names = [t for t in TABLES if "{" + t + "}" in text]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names}
    sql = text.format(S="string", H="sha2(text,256)", **{t: "{" + t + "}" for t in names})
    return spark.sql(sql, **tables)


def duck(text: str) -> str:
    """The same view for DuckDB, as a parenthesised query."""
    return "(" + text.format(S="varchar", H="sha256(text)", **{t: t for t in TABLES}) + ")"


def _grid(rows: DataFrame, width: int) -> DataFrame:
    cells = [make_cell(F.col(f"t{i}"), F.col(f"v{i}")) for i in range(width)]
    return rows.select("source_id", "sheet", "sheet_idx", "row_num", F.array(*cells).alias("cells"))


def board_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, BOARD_ROWS)
    return _grid(
        rows.select(
            F.lit("boards").alias("source_id"),
            F.col("tab").alias("sheet"),
            F.col("tab_idx").alias("sheet_idx"),
            "*",
        ),
        5,
    )


def glue_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(view(spark, sf_dir, GLUE_ROWS), 3)


def event_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, DIRTY_CELLS)
    return rows.select(
        F.lit("events").alias("source_id"),
        F.concat(F.lit("s"), F.col("sheet_idx")).alias("sheet"),
        "sheet_idx",
        "row_num",
        F.array(make_cell(F.col("dtype"), F.col("sval"))).alias("cells"),
    )


def document_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return grid_from_table(
        documents, "documents", F.col("lang"), "doc_id", columns=["text", "source"]
    )


def order_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as typed sheets, one per status, with a third of the prices blanked."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    blanked = orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice"))
    )
    return grid_from_table(blanked, "orders", F.col("o_orderstatus"), "o_orderkey")


def supplier_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier sheets: title in row 1, blank rows 2 and 3, header in row 4, deliveries after."""
    from tallyloom.schemas import CELL

    # The header list is unfolded and filtered inside each nation's row.
    names = [n + (" " if i % 4 == 1 else "") for i, (n, *_) in enumerate(FIELD_MAPPING)]
    slots = [F.when((F.col("n_nationkey") + i) % 5 != 0, F.lit(n)) for i, n in enumerate(names)]
    texts = F.array_compact(F.array(*slots, F.lit("Remarks"), F.lit("date")))
    header = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        "n_nationkey",
        F.lit(4).cast("bigint").alias("row_num"),
        F.concat(
            F.array(make_cell("null", None)), F.transform(texts, lambda t: make_cell("str", t))
        ).alias("cells"),
    )
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    top = nation.select(
        "n_nationkey",
        F.inline(
            F.array(
                F.struct(
                    F.lit(1).cast("bigint").alias("row_num"),
                    F.array(make_cell("str", F.col("n_name")), make_cell("str", "  ")).alias("cells"),
                ),
                F.struct(
                    F.lit(2).cast("bigint").alias("row_num"),
                    F.array(make_cell("null", None), make_cell("null", None)).alias("cells"),
                ),
            )
        ),
    )
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    body = supplier.select(
        F.col("s_nationkey").alias("n_nationkey"),
        (F.col("s_suppkey") + 5).alias("row_num"),
        F.array(
            make_cell("null", None),
            make_cell("str", F.col("s_name")),
            make_cell("float", F.col("s_acctbal")),
        ).alias("cells"),
    )
    rows = header.unionByName(top).unionByName(body)
    return rows.select(
        F.lit("suppliers").alias("source_id"),
        F.concat(F.lit("nation "), F.col("n_nationkey")).alias("sheet"),
        F.col("n_nationkey").cast("bigint").alias("sheet_idx"),
        "row_num",
        F.col("cells").cast(f"array<{CELL}>").alias("cells"),
    )


def item_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partly filled item table: gaps in category and unit, every fifth name missing."""
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return view(spark, sf_dir, ITEM_TARGET).select(
        "*", moment.alias("created_at"), moment.alias("updated_at")
    )
