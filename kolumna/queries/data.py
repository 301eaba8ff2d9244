"""The test tables as the queries and their SQL see them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kolumna.operators.cells import all_cells
from kolumna.session import prepare

COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "pages": ["page_id", "url", "html"],
    "embeddings": ["vec_id", "label"],  # vectors of floats are written differently by each engine
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}

# A table with nulls, NaN, odd numbers and dates in several shapes, derived from orders by
# expressions that Spark and DuckDB read alike.
MESSY = {
    "status": "nullif(o_orderstatus, 'P')",
    "amount": """case o_custkey % 7
        when 0 then 'NaN'
        when 1 then concat('$1,', right(concat('000', cast(o_custkey % 1000 as string)), 3), '.50')
        when 2 then concat('+', cast(o_custkey as string))
        when 3 then '-'
        when 4 then null
        when 5 then concat('.0', cast(o_orderkey % 10 as string))
        else '1e5' end""",
    "ordered_day": """case o_orderkey % 9
        when 0 then substr(cast(o_orderdate as string), 1, 10)
        when 1 then concat(substr(cast(o_orderdate as string), 6, 2), '/', substr(cast(o_orderdate as string), 9, 2),
                           '/', substr(cast(o_orderdate as string), 1, 4))
        when 2 then concat(substr(cast(o_orderdate as string), 1, 4), substr(cast(o_orderdate as string), 6, 2))
        when 3 then 'no date'
        when 4 then concat(substr(cast(o_orderdate as string), 6, 2), '/', substr(cast(o_orderdate as string), 9, 2),
                           '/', substr(cast(o_orderdate as string), 3, 2))
        when 5 then substr(cast(o_orderdate as string), 1, 7)
        when 6 then replace(substr(cast(o_orderdate as string), 1, 10), '-', '.')
        when 7 then concat(substr(cast(o_orderdate as string), 9, 2), '-',
                           substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(substr(cast(o_orderdate as string), 6, 2) as int) * 3 - 2, 3),
                           '-', substr(cast(o_orderdate as string), 3, 2))
        else '2031-01-01' end""",
    "market_segment": """case o_orderkey % 6
        when 0 then o_orderpriority
        when 1 then concat('Brand#', cast(o_custkey % 25 as string))
        when 2 then '-'
        when 3 then null
        when 4 then 'furniture'
        else concat('www.site', cast(o_custkey % 10 as string), '.com') end""",
    "nothing": "cast(null as string)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def dataset(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "messy":
        return table(spark, sf_dir, "orders").selectExpr(*[f"{e} as {c}" for c, e in MESSY.items()])
    return table(spark, sf_dir, name).select(*COLUMNS[name])


def dataset_cells(spark: SparkSession, sf_dir: str, *names: str, columns: dict[str, list[str]] | None = None) -> DataFrame:
    return all_cells({name: dataset(spark, sf_dir, name) for name in names}, columns)


def cells_sql(*names: str) -> str:
    parts = []
    for name in names:
        source, columns = ("orders", MESSY) if name == "messy" else (name, {c: c for c in COLUMNS[name]})
        parts += [
            f"select '{name}' as dataset, '{c}' as column_name, cast({e} as varchar) as value from {source}"
            for c, e in columns.items()
        ]
    return "\nunion all\n".join(parts)


def frequencies_sql(*names: str) -> str:
    return f"select dataset, column_name, value, count(*) as n from ({cells_sql(*names)}) group by all"
