"""Queries of the profile: cells, metadata, value types, statistics, itemsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolumna.operators import cells as c
from kolumna.operators import itemsets, metadata, profile
from kolumna.operators.long_integers import long_integer_stats
from kolumna.plans import figures, profile_report
from kolumna.queries.data import cells_sql, dataset, dataset_cells, frequencies_sql, table
from kolumna.session import written

TYPED = ("customer", "part", "orders", "events", "messy")
SMALL = ("nation", "customer", "part", "orders", "messy")
ALL = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "embeddings",
    "benchmark", "labels", "conversations", "messy",
)


def frequencies(spark, sf, *names) -> DataFrame:
    return c.value_frequencies(dataset_cells(spark, sf, *names))


def typed_cells(spark, sf, *names) -> DataFrame:
    return profile.with_types(dataset_cells(spark, sf, *names))


def typed_frequencies(spark, sf, *names) -> DataFrame:
    return profile.with_types(frequencies(spark, sf, *names))


def joined(column: str):
    return F.array_join(column, " | ").alias(column)


def rounded(*columns: str):
    return [F.round(column, 4).alias(column) for column in columns]


def column_metadata(spark, sf):
    records = profile_report.column_metadata(frequencies(spark, sf, *ALL))
    return records.withColumn("frequent_values", joined("frequent_values"))


def text_stats(spark, sf):
    """Three aggregates read the typed values, which are written once."""
    stats = profile.text_stats(written(typed_frequencies(spark, sf, *ALL), "typed-frequencies"))
    return stats.select(
        *c.KEYS, "count", joined("shortest_values"), joined("longest_values"), *rounded("average_length")
    )


def column_records(spark, sf):
    records = profile_report.run(dataset_cells(spark, sf, *ALL))
    return records.select(
        *c.KEYS,
        "number_distinct_values",
        "number_non_empty_cells",
        "number_empty_cells",
        joined("frequent_values"),
        "itemset",
        "number_untyped_cells",
        F.expr("coalesce(aggregate(data_types, 0L, (a, t) -> a + t.count), 0L)").alias("typed_cells"),
        F.expr("array_join(transform(data_types, t -> concat(t.type, ' ', t.count)), ', ')").alias("type_counts"),
        F.expr("round(get(filter(data_types, t -> t.type = 'REAL'), 0).mean, 4)").alias("real_mean"),
        F.expr("round(get(filter(data_types, t -> t.type = 'INTEGER'), 0).stddev, 4)").alias("integer_stddev"),
        F.expr("get(filter(data_types, t -> t.type = 'DATE/TIME'), 0).max_date").alias("last_date"),
        F.expr("array_join(get(filter(data_types, t -> t.type = 'TEXT'), 0).shortest_values, ' | ')").alias(
            "shortest_values"
        ),
    )


def number_stats(stats):
    return stats.select(*c.KEYS, "count", F.col("max_value").cast("double").alias("max_value"),
                        F.col("min_value").cast("double").alias("min_value"), *rounded("mean", "stddev"))


def ordered_dates(spark, sf):
    """Order days as written in two countries: each column is read in its own order."""
    days = table(spark, sf, "orders").selectExpr("date_format(o_orderdate, 'M/d/yyyy') as us_date", "date_format(o_orderdate, 'd/M/yyyy') as eu_date")
    return profile.date_stats(profile.with_types(c.value_frequencies(c.cells(days, "orders")), order_by_column=True))


def long_integers(spark, sf):
    """Extremes of numbers of about 60 digits made from orders."""
    rows = table(spark, sf, "orders").selectExpr(f"{LONG_NUMBER} as long_number")
    found = long_integer_stats(profile.with_types(c.value_frequencies(c.cells(rows, "orders"))))
    return found.drop("total", "mean")


LONG_NUMBER = """concat(case when o_orderkey % 3 = 0 then '-' else '' end, cast(o_custkey + 1 as string),
    repeat('0123456789', 5), lpad(cast(o_orderkey as string), 9, '0'))"""

QUERIES = {
    "profile_figures": lambda spark, sf: figures.profile(dataset_cells(spark, sf, *SMALL))[1],
    "ordered_dates": ordered_dates,
    "long_integers": long_integers,
    "cells": lambda spark, sf: dataset_cells(spark, sf, *SMALL),
    "one_column": lambda spark, sf: dataset_cells(
        spark, sf, "customer", columns={"customer": ["c_mktsegment"]}
    ),
    "column_names": lambda spark, sf: c.column_names(dataset_cells(spark, sf, *SMALL)),
    "value_frequencies": lambda spark, sf: frequencies(spark, sf, *SMALL),
    "column_aggregate": lambda spark, sf: c.aggregate_columns(
        dataset_cells(spark, sf, *SMALL).withColumn("size", F.length("value")), "number_values", F.count, ("size",)
    ),
    "distinct_counts": lambda spark, sf: metadata.cell_counts(frequencies(spark, sf, *ALL)).select(
        *c.KEYS, "number_distinct_values"
    ),
    "cell_counts": lambda spark, sf: metadata.cell_counts(frequencies(spark, sf, *SMALL)),
    "cell_count_errors": lambda spark, sf: metadata.cell_count_errors(
        metadata.cell_counts(frequencies(spark, sf, *SMALL))
    ),
    "frequent_values": lambda spark, sf: metadata.frequent_values(frequencies(spark, sf, *SMALL)).select(
        *c.KEYS, joined("frequent_values")
    ),
    "frequent_value_counts": lambda spark, sf: metadata.frequent_value_counts(frequencies(spark, sf, *SMALL)).select(
        *c.KEYS, F.array_join("frequent_values->counts_(top_10)", " | ").alias("frequent_values")
    ),
    "column_metadata": column_metadata,
    "wide_distinct_counts": lambda spark, sf: metadata.wide_distinct_counts(dataset(spark, sf, "orders"), "orders"),
    "typed_cells": lambda spark, sf: typed_cells(spark, sf, *SMALL)
    .groupBy(*c.KEYS, "type")
    .agg(F.sum("n").alias("n"), F.max("whole").cast("double").alias("max_whole"), F.max("moment").alias("max_moment")),
    "integer_stats": lambda spark, sf: number_stats(profile.integer_stats(typed_cells(spark, sf, *TYPED))),
    "real_stats": lambda spark, sf: number_stats(profile.real_stats(typed_cells(spark, sf, *TYPED))),
    "integer_stats_of_frequencies": lambda spark, sf: number_stats(
        profile.integer_stats(typed_frequencies(spark, sf, *SMALL))
    ),
    "date_stats": lambda spark, sf: profile.date_stats(typed_cells(spark, sf, *TYPED)),
    "text_stats": text_stats,
    "column_records": column_records,
    "column_itemsets": lambda spark, sf: itemsets.column_itemsets(typed_frequencies(spark, sf, *TYPED)),
    "dataset_itemsets": lambda spark, sf: itemsets.dataset_itemsets(
        itemsets.column_itemsets(typed_frequencies(spark, sf, *TYPED))
    ),
    "total_itemsets": lambda spark, sf: itemsets.total_itemsets(
        itemsets.dataset_itemsets(itemsets.column_itemsets(typed_frequencies(spark, sf, *TYPED)))
    ),
    "most_frequent_itemsets": lambda spark, sf: itemsets.most_frequent_itemsets(
        itemsets.total_itemsets(itemsets.dataset_itemsets(itemsets.column_itemsets(typed_frequencies(spark, sf, *TYPED))))
    ),
}

EMPTY = "(value is null or lower(trim(value)) in ('nan', '+nan', '-nan'))"
COUNTS = f"""count(value) as number_distinct_values,
    cast(coalesce(sum(n) filter (not {EMPTY}), 0) as bigint) as number_non_empty_cells,
    cast(coalesce(sum(n) filter ({EMPTY}), 0) as bigint) as number_empty_cells"""


def top_sql(names, k, value="value", by="n desc, value", where="value is not null"):
    return f"""select dataset, column_name, coalesce(string_agg({value}, ' | ' order by rk)
          filter (rk <= {k} and {where}), '') as frequent_values
        from (select *, row_number() over (partition by dataset, column_name
                                           order by value is null, {by}) as rk
              from ({frequencies_sql(*names)})) group by all"""


def typed_sql(*names):
    return f"""select *,
        case when type = 'INTEGER' or type = 'REAL' then try_cast(trim(plain) as double) end as number
      from (select *, translate(value, ',$', '') as plain,
        case when value is null then null
          when date_name then case when year(moment) between 1850 and 2019 then 'DATE/TIME' end
          when regexp_matches(translate(value, ',$', ''), '^[-+]?[0-9]*\\.[0-9]+([eE][-+]?[0-9]+)?$') then 'REAL'
          when regexp_matches(translate(value, ',$', ''), '^\\s*[-+]?[0-9]+\\s*$') then 'INTEGER'
          else 'TEXT' end as type
      from (select *, case when not date_name then null
          when regexp_full_match(value, '\\d{{4}}-\\d{{2}}-\\d{{2}}.*') then try_cast(value as timestamp)
          when regexp_full_match(value, '\\d{{2}}/\\d{{2}}/\\d{{4}}') then try_strptime(value, '%m/%d/%Y')
          when regexp_full_match(value, '\\d{{2}}/\\d{{2}}/\\d{{2}}') then try_strptime(value, '%m/%d/%y')
          when regexp_full_match(value, '\\d{{4}}-\\d{{2}}') then try_strptime(value, '%Y-%m')
          when regexp_full_match(value, '\\d{{4}}\\.\\d{{2}}\\.\\d{{2}}') then try_strptime(value, '%Y.%m.%d')
          when regexp_full_match(value, '\\d{{2}}-[A-Za-z]{{3}}-\\d{{2}}') then try_strptime(value, '%d-%b-%y')
          when regexp_full_match(value, '\\d{{6}}') then try_strptime(value, '%Y%m') end as moment
      from (select *, regexp_matches(lower(column_name), 'date|period|year|month|day|time|interval') as date_name
      from ({cells_sql(*names)}))))"""


def number_sql(kind, *names):
    return f"""select dataset, column_name, count(*) as count, max(number) as max_value, min(number) as min_value,
        round(avg(number), 4) as mean, round(stddev_pop(number), 4) as stddev
      from ({typed_sql(*names)}) where type = '{kind}' group by all"""


def itemset_sql(*names):
    return f"""select dataset, column_name,
        concat(case when bool_or(type = 'REAL') then '-REAL-' else '' end,
               case when bool_or(type = 'DATE/TIME') then '-DATE-' else '' end,
               case when bool_or(type = 'INTEGER') then '-INTEGER-' else '' end,
               case when bool_or(type = 'TEXT') then '-TEXT-' else '' end) as itemset
      from ({typed_sql(*names)}) group by all"""


DATASET_ITEMSETS = f"select dataset, itemset, count(*) as n from ({itemset_sql(*TYPED)}) group by all"
TOTAL_ITEMSETS = f"select itemset, cast(sum(n) as bigint) as n from ({DATASET_ITEMSETS}) group by all"
TEXT_EXTREMES = f"""select dataset, column_name,
        string_agg(value, ' | ' order by s) filter (s <= 5) as shortest_values,
        string_agg(value, ' | ' order by l) filter (l <= 5) as longest_values
      from (select *, row_number() over (partition by dataset, column_name order by length(value), value) as s,
              row_number() over (partition by dataset, column_name order by length(value) desc, value) as l
            from (select distinct dataset, column_name, value from ({typed_sql(*ALL)}) where type = 'TEXT'))
      group by all"""

SQL = {
    "profile_figures": f"""with f as ({frequencies_sql(*SMALL)}), r as (@records)
      select 'cells' as figure, cast(sum(n) as bigint) as value from f
      union all select 'null_cells', cast(coalesce(sum(n) filter (value is null), 0) as bigint) from f
      union all select 'different_values', count(value) from f
      union all select 'columns', count(*) from r
      union all select 'untyped_cells', cast(coalesce(sum(number_untyped_cells), 0) as bigint) from r""",
    "ordered_dates": " union all ".join(
        f"""select 'orders' as dataset, '{name}' as column_name, count(*) as count,
            strftime(max(day), '%m/%d/%Y, 00:00:00') as max_value, strftime(min(day), '%m/%d/%Y, 00:00:00') as min_value
          from (select cast(o_orderdate as date) as day from orders) where year(day) between 1850 and 2019"""
        for name in ("us_date", "eu_date")
    ),
    "long_integers": f"""select 'orders' as dataset, 'long_number' as column_name, count(*) as count, arg_max(v, key) as max_value,
        arg_min(v, key) as min_value
      from (select v, case when v like '-%' then concat('0', lpad(cast(999 - length(v) as varchar), 3, '0'),
          translate(substr(v, 2), '0123456789', '9876543210')) else concat('1', lpad(cast(length(v) as varchar), 3, '0'), v) end as key
        from (select {LONG_NUMBER} as v from orders))""",
    "cells": cells_sql(*SMALL),
    "one_column": "select 'customer' as dataset, 'c_mktsegment' as column_name, c_mktsegment as value from customer",
    "column_names": f"select distinct dataset, column_name from ({cells_sql(*SMALL)})",
    "value_frequencies": frequencies_sql(*SMALL),
    "column_aggregate": f"""select dataset, column_name, length(value) as size, count(value) as number_values
        from ({cells_sql(*SMALL)}) group by all""",
    "distinct_counts": f"""select dataset, column_name, count(distinct value) as number_distinct_values
        from ({cells_sql(*ALL)}) group by all""",
    "cell_counts": f"""select dataset, column_name, {COUNTS}, cast(sum(n) as bigint) as number_cells
        from ({frequencies_sql(*SMALL)}) group by all""",
    "cell_count_errors": f"""select dataset, column_name, {COUNTS}, cast(sum(n) as bigint) as number_cells
        from ({frequencies_sql(*SMALL)}) group by all
        having number_non_empty_cells + number_empty_cells <> number_cells""",
    "frequent_values": top_sql(SMALL, 5),
    "frequent_value_counts": top_sql(SMALL, 10, "concat(value, '->', n)"),
    "column_metadata": f"""select * from (select dataset, column_name, {COUNTS} from ({frequencies_sql(*ALL)})
        group by all) join ({top_sql(ALL, 5)}) using (dataset, column_name)""",
    "wide_distinct_counts": f"""select dataset, column_name, count(distinct value) as number_distinct_values
        from ({cells_sql("orders")}) group by all""",
    "typed_cells": f"""select dataset, column_name, type, count(*) as n,
        max(case when type = 'INTEGER' then number end) as max_whole,
        max(case when type = 'DATE/TIME' then moment end) as max_moment
        from ({typed_sql(*SMALL)}) group by all""",
    "integer_stats": number_sql("INTEGER", *TYPED),
    "real_stats": number_sql("REAL", *TYPED),
    "integer_stats_of_frequencies": number_sql("INTEGER", *SMALL),
    "date_stats": f"""select dataset, column_name, count(*) as count,
        strftime(max(moment), '%m/%d/%Y, %H:%M:%S') as max_value, strftime(min(moment), '%m/%d/%Y, %H:%M:%S') as min_value
        from ({typed_sql(*TYPED)}) where type = 'DATE/TIME' group by all""",
    "text_stats": f"""select dataset, column_name, count, shortest_values, longest_values, average_length
        from (select dataset, column_name, count(*) as count, round(avg(length(value)), 4) as average_length
              from ({typed_sql(*ALL)}) where type = 'TEXT' group by all)
        join ({TEXT_EXTREMES}) using (dataset, column_name)""",
    "column_itemsets": itemset_sql(*TYPED),
    "dataset_itemsets": DATASET_ITEMSETS,
    "total_itemsets": TOTAL_ITEMSETS,
    "most_frequent_itemsets": f"""select itemset, n from ({TOTAL_ITEMSETS})
        where n = (select max(n) from ({TOTAL_ITEMSETS}))""",
    "column_records": f"""with typed as ({typed_sql(*ALL)}),
        by_type as (select dataset, column_name, type, count(*) as n, avg(number) as mean, stddev_pop(number) as sd,
                      max(moment) as last from typed where type is not null group by all),
        untyped as (select dataset, column_name, count(*) filter (type is null and value is not null) as number_untyped_cells
                    from typed group by all),
        types as (select dataset, column_name, cast(sum(n) as bigint) as typed_cells,
                    string_agg(concat(type, ' ', n), ', ' order by type) as type_counts,
                    round(max(case when type = 'REAL' then mean end), 4) as real_mean,
                    round(max(case when type = 'INTEGER' then sd end), 4) as integer_stddev,
                    strftime(max(case when type = 'DATE/TIME' then last end), '%m/%d/%Y, %H:%M:%S') as last_date
                  from by_type group by all),
        freq as (select dataset, column_name, value, count(*) as n from typed group by all),
        meta as (select dataset, column_name, {COUNTS} from freq group by all)
      select dataset, column_name, number_distinct_values, number_non_empty_cells, number_empty_cells,
        frequent_values, itemset, number_untyped_cells, coalesce(typed_cells, 0) as typed_cells, type_counts, real_mean, integer_stddev,
        last_date, shortest_values
      from meta left join types using (dataset, column_name) left join untyped using (dataset, column_name)
        left join ({top_sql(ALL, 5)}) using (dataset, column_name)
        left join ({itemset_sql(*ALL)}) using (dataset, column_name)
        left join ({TEXT_EXTREMES}) using (dataset, column_name)""",
}
SQL["profile_figures"] = SQL["profile_figures"].replace(
    "@records", f"""select * from ({SQL["column_records"]}) where dataset in ({", ".join(f"'{name}'" for name in SMALL)})"""
)
