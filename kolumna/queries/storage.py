"""Queries of sources and sinks: what is written is read back and computed on."""

from __future__ import annotations

from pyspark.sql import functions as F

from kolumna.operators import evaluation as ev
from kolumna.operators import reference_sets as rs
from kolumna.operators.cells import KEYS, value_frequencies
from kolumna.plans import profile_report, profile_runs, semantic_typing
from kolumna.queries import matching
from kolumna.queries.data import COLUMNS, MESSY, dataset, dataset_cells, frequencies_sql, table
from kolumna.queries.profiling import QUERIES as PROFILE
from kolumna.queries.profiling import SQL as PROFILE_SQL
from kolumna.session import scratch_folder, written
from kolumna.sinks import files as sinks
from kolumna.sources import files, listed, tables

# Tables with line breaks in their cells and without.
PLAIN = ("documents", "pages", "conversations", "messy", "supplier")
GROUPED = [("customer", "c_nationkey", "c_nationkey"), ("supplier", "s_nationkey", "s_nationkey"), ("orders", "o_orderdate", "year(o_orderdate)")]
JSON = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"], "events": ["event_id", "user_id", "event_type", "props"],
    "messy": [c for c in MESSY if c != "nothing"], "documents": ["doc_id", "text", "lang"],
}
TSV = ("nation", "customer", "part", "messy", "documents", "conversations", "pages")


def tsv_folder(spark, sf):
    folder = scratch_folder(spark, "tsv")
    for name in TSV:
        sinks.write_tsv(dataset(spark, sf, name), f"{folder}/{name}")
    return folder


def listed_files(spark, sf):
    return files.dataset_files(files.list_files(spark, tsv_folder(spark, sf)))


def folder_name(column):
    return F.regexp_extract(column, r"([^/]+)/[^/]*$", 1)


def dataset_files(spark, sf):
    """The folders of the files written, and whether size order and limits keep every file once."""
    found = listed_files(spark, sf)
    kept = files.within_size(found, files.SIZE_LIMIT).unionByName(files.oversized(found, files.SIZE_LIMIT))
    return kept.groupBy(folder_name("path").alias("dataset")).agg((F.min("length") > 0).alias("filled"))


def first_files(spark, sf):
    """Of the files in size order the first three, and whether the others are as large."""
    found = written(listed_files(spark, sf), "files")
    first = files.first_files(found, 3)
    rest = found.join(first.select("path"), "path", "left_anti").agg(F.min("length").alias("least"), F.count("*").alias("others"))
    return first.agg(F.max("length").alias("most"), F.count("*").alias("files")).join(rest, F.lit(True)).select(
        "files", (F.col("others") > 0).alias("more"), (F.col("most") <= F.col("least")).alias("smallest")
    )


def shuffled_files(spark, sf):
    """Files in random order: the same ones, the order depends on the seed alone."""
    found = written(listed_files(spark, sf), "files")
    return files.shuffled(found, 7).groupBy(folder_name("path").alias("dataset")).agg(F.min(F.col("length") > 0).alias("filled"))


def tsv_frequencies(spark, sf):
    paths = [row.path for row in files.by_size(listed_files(spark, sf)).collect()]
    return files.tsv_frequencies(spark, paths, folder_name("file"))


def split_frequencies(spark, sf):
    """Plain files, as many as a table has parts, each read by as many tasks as it has splits."""
    folder = scratch_folder(spark, "plain")
    for name in PLAIN:
        sinks.write_tsv(dataset(spark, sf, name), f"{folder}/{name}", "none")
    paths = [row.path for row in files.list_files(spark, folder).where("path like '%.csv'").collect()]
    return files.tsv_frequencies(spark, paths, folder_name("file"))


def typed_headers(spark, sf):
    """The headers of the typed tables as their files have them."""
    folder = scratch_folder(spark, "typed")
    for name in matching.TYPED_DATASETS:
        sinks.write_tsv(dataset(spark, sf, name), f"{folder}/{name}")
    paths = [row.path for row in files.dataset_files(files.list_files(spark, folder)).collect()]
    return tables.file_headers(spark, paths, folder_name)


def resolved_from_files(spark, sf):
    """Listed names and the nearest of the columns that the files have."""
    found = rs.resolve_columns(matching.listed(spark, matching.TYPED), written(typed_headers(spark, sf), "headers"))
    return matching.rounded(found, "distance", "adjusted")


def grouped_frequencies(spark, sf):
    """Customers, suppliers and orders as one dataset for each key: few schemas, many datasets."""
    folder = scratch_folder(spark, "grouped")
    for name, key, rule in GROUPED:
        dataset(spark, sf, name).withColumn("key", F.expr(rule)).drop(key).write.partitionBy("key").parquet(f"{folder}/{name}")
    paths = [row.path for row in files.list_files(spark, folder).where("path like '%.parquet'").collect()]
    place = r"([^/]+)/key=([^/]+)/[^/]*$"
    label = lambda path: F.concat(F.regexp_extract(path, place, 1), F.lit("-"), F.regexp_extract(path, place, 2))
    return value_frequencies(tables.file_cells(spark, paths, label))


def json_frequencies(spark, sf):
    """Tables as JSON records, which leave out nulls, all in one scan."""
    folder = scratch_folder(spark, "json")
    for name in JSON:
        dataset(spark, sf, name).select(*JSON[name]).write.json(f"{folder}/{name}")
    return tables.record_frequencies(spark, [f"{folder}/{name}" for name in JSON], folder_name)


def continued_profile(spark, sf):
    """A profile of half a table and of another one, brought up to date when the rest has come."""
    folder, out = scratch_folder(spark, "folder"), scratch_folder(spark, "profile")
    sinks.write_tsv(dataset(spark, sf, "nation").where("n_nationkey < 9"), f"{folder}/nation")
    sinks.write_tsv(dataset(spark, sf, "customer"), f"{folder}/customer")
    profile_runs.update(spark, folder, out, folder_name)
    sinks.write_tsv(dataset(spark, sf, "nation"), f"{folder}/nation")
    sinks.write_tsv(dataset(spark, sf, "messy"), f"{folder}/messy")
    profile_runs.update(spark, folder, out, folder_name, batch_datasets=1, max_batches=1)
    profile_runs.update(spark, folder, out, folder_name)
    return shown_profile(profile_runs.profile(spark, out))


def one_tsv(spark, sf):
    path = scratch_folder(spark, "tsv")
    sinks.write_tsv(table(spark, sf, "customer"), path)
    read = files.read_tsv(spark, path)
    return read.groupBy("c_mktsegment").agg(
        F.sum("c_nationkey").alias("nations"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


def catalog(spark, sf):
    lines = table(spark, sf, "part").select(
        F.expr("concat('d-', p_partkey, '.', replace(p_name, ' ', '_'), '.', p_size, '.txt.gz')").alias("value")
    )
    path = scratch_folder(spark, "catalog")
    lines.write.text(path)
    return listed.read_catalog(spark, path, "/data/in/")


def reference_from_sheet(spark, sf):
    path = scratch_folder(spark, "sheet")
    sinks.write_csv(matching.sheet(spark, sf), path)
    values = rs.reference_set(rs.labelled_values(listed.read_sheet(spark, path)), "frequent_value")
    path = scratch_folder(spark, "reference")
    sinks.write_csv(values, path)
    return listed.read_reference_set(spark, path, "frequent_value")


def predictions_from_results(spark, sf):
    path = scratch_folder(spark, "results")
    sinks.write_json(matching.order_records(spark, sf), path)
    found = ev.predictions(listed.read_results(spark, path))
    return found.groupBy("semantic_type").agg(F.count("*").alias("columns"))


def profile_folder(spark, sf):
    path = scratch_folder(spark, "profile")
    sinks.write_profile(profile_report.run(dataset_cells(spark, sf, "nation", "customer", "messy")), path)
    return shown_profile(spark.read.json(path))


def shown_profile(read):
    statistic = "round(get(filter(data_types, t -> t.type = '{}'), 0).{}, 4)"
    return read.select(
        *KEYS, "number_distinct_values", "itemset", F.coalesce(F.size("data_types"), F.lit(0)).alias("types"),
        "number_untyped_cells", F.expr("coalesce(aggregate(data_types, 0L, (a, t) -> a + t.count), 0L)").alias("typed_cells"),
        F.expr(statistic.format("REAL", "mean")).alias("real_mean"),
        F.expr(statistic.format("INTEGER", "stddev")).alias("integer_stddev"),
        F.expr("get(filter(data_types, t -> t.type = 'DATE/TIME'), 0).max_value").alias("last_date"),
        F.expr("array_join(get(filter(data_types, t -> t.type = 'TEXT'), 0).shortest_values, ' | ')").alias("shortest_values"),
    )


def itemset_tally(spark, sf):
    path = scratch_folder(spark, "itemsets")
    sinks.write_json(PROFILE["total_itemsets"](spark, sf), path)
    return spark.read.json(path, schema="itemset string, n bigint")


def semantic_results(spark, sf):
    """The records of the typed columns, written and read back."""
    path = scratch_folder(spark, "semantic")
    sinks.write_json(semantic_typing.run(*matching.typing_inputs(spark, sf)), path)
    read = spark.read.json(path, schema="dataset string, " + listed.RESULTS)
    shown = "transform(semantic_types, t -> concat(t.semantic_type, ' ', coalesce(t.label, ''), ' ', t.count))"
    return read.select(*KEYS, F.expr(f"array_join({shown}, ', ')").alias("semantic_types"))


def missing_columns_file(spark, sf):
    path = scratch_folder(spark, "missing")
    sinks.write_csv(matching.QUERIES["missing_columns"](spark, sf), path)
    return spark.read.csv(path, header=True, **files.READ_OPTIONS)


def measures_file(name):
    def query(spark, sf):
        path = scratch_folder(spark, name)
        sinks.write_csv(matching.QUERIES[name](spark, sf), path)
        return spark.read.csv(path, header=True, **files.READ_OPTIONS).withColumn(name, F.col(name).cast("double"))

    return query


QUERIES = {
    "dataset_files": dataset_files,
    "tsv_frequencies": tsv_frequencies,
    "file_headers": typed_headers,
    "resolved_from_files": resolved_from_files,
    "split_frequencies": split_frequencies,
    "grouped_frequencies": grouped_frequencies,
    "json_frequencies": json_frequencies,
    "continued_profile": continued_profile,
    "inferred_tsv": one_tsv,
    "listed_columns": catalog,
    "reference_from_sheet": reference_from_sheet,
    "predictions_from_results": predictions_from_results,
    "profile_folder": profile_folder,
    "first_files": first_files,
    "shuffled_files": shuffled_files,
    "itemset_tally": itemset_tally,
    "semantic_results": semantic_results,
    "missing_columns_file": missing_columns_file,
    "precision_file": measures_file("precision"),
    "recall_file": measures_file("recall"),
}

GROUPED_SQL = " union all ".join(
    f"""select concat('{name}-', {rule}) as dataset, '{column}' as column_name, cast({column} as varchar) as value from {name}"""
    for name, key, rule in GROUPED for column in COLUMNS[name] if column != key
)
JSON_SQL = " union all ".join(
    f"""select '{name}' as dataset, '{column}' as column_name, cast({MESSY[column] if name == "messy" else column} as varchar) as value
        from {"orders" if name == "messy" else name}"""
    for name, columns in JSON.items() for column in columns
)

SQL = {
    "file_headers": f"select dataset, column_name, cast(position as integer) as position from {matching.headers_sql(matching.TYPED_DATASETS)}",
    "resolved_from_files": matching.SQL["resolved_columns"],
    "split_frequencies": frequencies_sql(*PLAIN),
    "grouped_frequencies": f"select dataset, column_name, value, count(*) as n from ({GROUPED_SQL}) group by all",
    "json_frequencies": f"select dataset, column_name, value, count(*) as n from ({JSON_SQL}) group by all",
    "dataset_files": " union all ".join(f"select '{name}' as dataset, true as filled" for name in TSV),
    "tsv_frequencies": frequencies_sql(*TSV),
    "inferred_tsv": """select c_mktsegment, cast(sum(c_nationkey) as bigint) as nations,
        round(sum(c_acctbal), 2) as balance from customer group by all""",
    "listed_columns": """select concat('/data/in/d-', p_partkey, '.tsv.gz') as ds_path,
        concat('d-', p_partkey, '.tsv.gz') as dataset, concat(replace(p_name, ' ', '_'), '.', p_size) as col_name_ta,
        concat('d-', p_partkey, '.', replace(p_name, ' ', '_'), '.', p_size, '.txt.gz') as listed from part""",
    "reference_from_sheet": f"select * from {matching.VALUE_SET}",
    "predictions_from_results": """select semantic_type, count(*) as columns from (select distinct l_orderkey,
        unnest([l_linestatus, l_returnflag]) as semantic_type from lineitem) group by all""",
    "profile_folder": f"""select dataset, column_name, number_distinct_values, itemset,
        cast(len(regexp_replace(itemset, '[A-Z]', '', 'g')) / 2 as bigint) as types, number_untyped_cells,
        typed_cells, real_mean, integer_stddev, last_date, shortest_values
      from ({PROFILE_SQL["column_records"]}) where dataset in ('nation', 'customer', 'messy')""",
    "continued_profile": f"""select dataset, column_name, number_distinct_values, itemset,
        cast(len(regexp_replace(itemset, '[A-Z]', '', 'g')) / 2 as bigint) as types, number_untyped_cells,
        typed_cells, real_mean, integer_stddev, last_date, shortest_values
      from ({PROFILE_SQL["column_records"]}) where dataset in ('nation', 'customer', 'messy')""",
    "first_files": "select 3::bigint as files, true as more, true as smallest",
    "shuffled_files": " union all ".join(f"select '{name}' as dataset, true as filled" for name in TSV),
    "itemset_tally": PROFILE_SQL["total_itemsets"],
    "semantic_results": matching.SQL["semantic_records"],
    "missing_columns_file": matching.SQL["missing_columns"],
    "precision_file": matching.SQL["precision"],
    "recall_file": matching.SQL["recall"],
}
