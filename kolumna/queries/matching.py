"""Queries of matching, reference sets, semantic typing and its evaluation."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from kolumna.functions import text as tx
from kolumna.operators import cells as c
from kolumna.operators import evaluation as ev
from kolumna.operators import matching as m
from kolumna.operators import nearest_search, overlap
from kolumna.operators import reference_sets as rs
from kolumna.operators import semantics as sem
from kolumna.plans import semantic_typing
from kolumna.queries.data import COLUMNS, MESSY, dataset, dataset_cells, frequencies_sql, table
from kolumna.session import written
from kolumna.sources.tables import schema_report

# Labels of some columns of the test tables, as a person would note them in the sheet.
LABELLED = [
    ("customer", "c_name", "person_name"),
    ("customer", "c_mktsegment", "segment"),
    ("supplier", "s_name", "business_name,"),
    ("part", "p_name", "part_name"),
    ("part", "p_brand", "car_make, brand"),
    ("part", "p_type", "size_class"),
    ("orders", "o_orderstatus", "status"),
    ("orders", "o_orderpriority", "priority"),
    ("events", "event_type", "event"),
    ("documents", "lang", "language"),
    ("documents", "source", "website, source"),
    ("nation", "n_name", "city"),
    ("region", "r_name", "borough"),
]
DATASETS = sorted({name for name, _, _ in LABELLED})
TYPED = [(name, column) for name, column, _ in LABELLED] + [("messy", "market_segment"), ("messy", "status")]
TYPED_DATASETS = sorted({name for name, _ in TYPED})


def labels(spark):
    return spark.createDataFrame(LABELLED, "dataset string, column_name string, label string")


def headers(spark, sf, names):
    return schema_report(spark, {name: dataset(spark, sf, name) for name in names})


def listed(spark, pairs):
    """Listed names as a catalog would spell them: upper case, blanks for underscores."""
    rows = [(name, column.upper().replace("_", " ")) for name, column in pairs]
    return spark.createDataFrame(rows, "dataset string, col_name_ta string")


def sample(spark, sf):
    wanted = listed(spark, [(name, column) for name, column, _ in LABELLED])
    resolved = written(rs.resolve_columns(wanted, headers(spark, sf, DATASETS)), "resolved")
    cells = dataset_cells(spark, sf, *DATASETS, columns=c.listed_columns(resolved))
    return rs.label_sample(wanted, resolved, c.value_frequencies(cells))


def sheet(spark, sf):
    """The label sample with a person's labels in place of the column name."""
    names = labels(spark).withColumn("col_name_ta", F.upper(F.replace("column_name", F.lit("_"), F.lit(" "))))
    named = names.select(F.col("dataset").alias("ds_path"), "col_name_ta", "label")
    rows = sample(spark, sf).drop("col_name").join(named, ["ds_path", "col_name_ta"])
    return rows.withColumnRenamed("label", "col_name")


def labelled_values(spark, sf):
    return written(rs.labelled_values(sheet(spark, sf)), "labelled")


def value_set(spark, sf, labelled=None):
    return rs.reference_set(labelled or labelled_values(spark, sf), "frequent_value")


def column_set(spark, sf, labelled=None):
    return rs.reference_set(labelled or labelled_values(spark, sf), "col_name_ta")


def value_refs(spark, sf, labelled=None):
    """Reference sets are built once and kept as a table, as they serve many matching steps."""
    refs = m.reference(value_set(spark, sf, labelled), "true_label", "frequent_value", "rank")
    return written(refs, "reference-values")


def column_refs(spark, sf, labelled=None):
    refs = m.reference(column_set(spark, sf, labelled), "true_label", "col_name_ta", "rank")
    return written(refs, "reference-columns")


def part_values(spark, sf):
    """Different strings to match: parts, brands in other spellings, segments."""
    part = table(spark, sf, "part").selectExpr("p_name as value").union(
        table(spark, sf, "part").selectExpr("upper(concat(p_brand, '-', p_type)) as value")
    )
    segment = table(spark, sf, "customer").selectExpr("lower(c_mktsegment) as value")
    return part.union(segment).distinct().withColumn("text", F.col("value"))


def rounded(df, *columns):
    return df.select(*[F.round(x, 6).alias(x) if x in columns else F.col(x) for x in df.columns])


def nearest(spark, sf):
    return rounded(m.nearest(part_values(spark, sf), value_refs(spark, sf), ["value"]), "distance", "adjusted")


def customer_refs(spark, sf):
    """A reference set that grows with the data: all customers, by segment."""
    return written(m.reference(table(spark, sf, "customer"), "c_mktsegment", "c_name"), "customers")


def nearest_customer(spark, sf):
    """Each supplier's name in another spelling and its nearest customer."""
    names = table(spark, sf, "supplier").selectExpr("replace(s_name, '#000', '-') as value").distinct().withColumn("text", F.col("value"))
    return rounded(nearest_search.nearest(names, customer_refs(spark, sf), ["value"]), "distance", "adjusted")


def grown_until_still(spark, sf):
    """The reference set grown by part and segment names until they add nothing."""
    return sem.grown_until_still(part_values(spark, sf), value_refs(spark, sf)).select("s_type", "target", "target_order")


def best_types(**options):
    def query(spark, sf):
        found = m.best_types(part_values(spark, sf), value_refs(spark, sf), ["value"], **options)
        return rounded(found, "distance", "average", "adjusted")

    return query


def typing_inputs(spark, sf):
    labelled = labelled_values(spark, sf)
    tables = {name: dataset(spark, sf, name) for name in TYPED_DATASETS}
    return tables, listed(spark, TYPED), column_refs(spark, sf, labelled), value_refs(spark, sf, labelled)


def typed(spark, sf):
    return semantic_typing.typed_cells(*typing_inputs(spark, sf))


def semantic_records(spark, sf):
    records = semantic_typing.run(*typing_inputs(spark, sf))
    shown = "transform(semantic_types, t -> concat(t.semantic_type, ' ', coalesce(t.label, ''), ' ', t.count))"
    return records.select(*c.KEYS, F.expr(f"array_join({shown}, ', ')").alias("semantic_types"))


def grown(spark, sf):
    refs = value_refs(spark, sf)
    near = m.nearest(part_values(spark, sf), refs, ["value"])
    return sem.grown_reference(refs, near).select("s_type", "target", "target_order")


def grown_from_types(spark, sf):
    """The reference set grown by the values of the typed columns themselves."""
    tables, wanted, _, refs = typing_inputs(spark, sf)
    resolved = written(rs.resolve_columns(wanted, headers(spark, sf, TYPED_DATASETS)), "resolved")
    values = c.all_cells(tables, c.listed_columns(resolved)).where("value is not null").select("value").distinct()
    near = m.nearest(values.withColumn("text", F.col("value")), refs, ["value"])
    return sem.grown_reference(refs, near).select("s_type", "target", "target_order")


def order_truth(spark, sf):
    """A sheet made of orders: each order a column, labelled with its status and priority."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("orders"), F.col("o_orderkey"), F.lit(".tsv.gz")).alias("ds_path"),
        F.lit("state").alias("col_name_ta"),
        F.expr("concat(o_orderstatus, ', ', o_orderpriority)").alias("col_name"),
    )


def order_records(spark, sf):
    """Result records made of line items: the states of an order's lines, returns as ``other``. An order's different
    lines are collected by its number, in partitions that grow with the lines; its name is made once."""
    lines = table(spark, sf, "lineitem")
    kinds = F.array(
        F.struct(F.col("l_linestatus").alias("semantic_type"), F.lit(None).cast("string").alias("label")),
        F.struct(F.lit("other").alias("semantic_type"), F.col("l_returnflag").alias("label")),
    )
    different = overlap.in_parts(lines.select("l_orderkey", "l_linestatus", "l_returnflag").distinct(), lines.count(), "l_orderkey")
    states = different.select("l_orderkey", F.explode(kinds).alias("t")).groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set("t")).alias("semantic_types")
    )
    return states.select(
        ev.catalog_name(F.concat(F.lit("orders"), F.col("l_orderkey")), F.lit("state")).alias("column_name"), "semantic_types"
    )


def aligned(spark, sf):
    return ev.aligned(ev.truth(order_truth(spark, sf)), ev.predictions(order_records(spark, sf)))


def run_log(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("seconds"),
        F.col("event_type").alias("output"),
    )


def file_order(spark, sf):
    """Column records of two datasets in the order of a file list made from the suppliers."""
    files = table(spark, sf, "supplier").select(
        (1000 - F.col("s_suppkey")).alias("pos"), F.concat(F.lit("/data/in/"), F.col("s_name")).alias("path")
    )
    records = table(spark, sf, "supplier").select(F.col("s_name").alias("dataset"), "s_nationkey")
    return ev.in_listed_order(records, files)


def forms(spark, sf):
    """The normal forms of part and brand names and their comparisons."""
    rows = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    a, b = F.col("p_name"), F.concat("p_brand", F.lit(" "), "p_name")
    staged = tx.normal_forms(F.concat("p_brand", F.lit(" "), "p_name"))
    return rows.select(
        "p_partkey",
        *[form.alias(f"form{i}") for i, form in enumerate(staged)],
        tx.standard_form(b).alias("standard"),
        tx.shorter(F.col("p_name"), F.col("p_brand")).alias("shorter"),
        tx.shortest_word_length(b).alias("shortest_word"),
        tx.either_contains(a, b, tx.lower).alias("either"),
        tx.contained_in(b, a, tx.strip_symbols).alias("within"),
        F.round(tx.set_jaccard_distance(a, b), 6).alias("distance"),
        tx.within(tx.set_jaccard_distance(a, b), 0.5).alias("close"),
        tx.is_alphabetic(F.col("p_type")).alias("alphabetic"),
        tx.is_digits(F.substring("p_brand", 7, 2)).alias("digits"),
    )


QUERIES = {
    "string_forms": forms,
    "schema_report": lambda spark, sf: headers(spark, sf, DATASETS),
    "resolved_columns": lambda spark, sf: rounded(
        rs.resolve_columns(listed(spark, TYPED), headers(spark, sf, TYPED_DATASETS)), "distance", "adjusted"
    ),
    "missing_columns": lambda spark, sf: rs.missing_columns(
        listed(spark, TYPED),
        rs.resolve_columns(listed(spark, TYPED), headers(spark, sf, ("part", "orders", "messy"))),
        0.5,
    ),
    "label_sample": lambda spark, sf: sample(spark, sf).select(
        "ds_path", "col_name_ta", "col_name",
        F.array_join("`frequent_values->counts_(top_10)`", " | ").alias("frequent_values"),
    ),
    "reference_values": lambda spark, sf: value_set(spark, sf),
    "reference_columns": lambda spark, sf: column_set(spark, sf),
    "reference_lists": lambda spark, sf: rs.reference_lists(value_set(spark, sf), "frequent_value").select(
        "true_label", F.array_join("targets", " | ").alias("targets")
    ),
    "nearest_target": nearest,
    "nearest_target_raw": lambda spark, sf: rounded(
        m.nearest(part_values(spark, sf), value_refs(spark, sf), ["value"], stages=1), "distance", "adjusted"
    ),
    "nearest_containing": lambda spark, sf: rounded(
        m.nearest_containing(part_values(spark, sf), value_refs(spark, sf), ["value"]), "distance", "adjusted"
    ),
    "nearest_customer": nearest_customer,
    "grown_until_still": grown_until_still,
    "best_types": best_types(),
    "best_types_by_average": best_types(by="avg", weighted=True),
    "column_types": lambda spark, sf: semantic_typing.column_types(
        headers(spark, sf, TYPED_DATASETS), column_refs(spark, sf)
    ).select("dataset", "column_name", "column_type"),
    "semantic_values": typed,
    "semantic_counts": lambda spark, sf: sem.type_counts(typed(spark, sf)),
    "semantic_records": semantic_records,
    "grown_reference": grown,
    "grown_from_types": grown_from_types,
    "aligned_labels": aligned,
    "precision": lambda spark, sf: rounded(ev.precision(aligned(spark, sf)), "precision"),
    "recall": lambda spark, sf: rounded(ev.recall(aligned(spark, sf)), "recall"),
    "listed_order": file_order,
    "run_log_summary": lambda spark, sf: rounded(ev.run_log_summary(run_log(spark, sf)), "total", "mean"),
    "running_means": lambda spark, sf: ev.running_means(run_log(spark, sf), 1000).withColumn(
        "running_mean", F.round("running_mean", 9)
    ),
}

SYMBOLS = "'" + string.punctuation.replace("'", "''") + " ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def strip_sql(x):
    return f"translate({x}, {SYMBOLS}, '')"


def mask_sql(x):
    return f"translate({x}, '0123456789', '**********')"


def forms_sql(x):
    lowered = strip_sql(f"lower({x})")
    return [x, strip_sql(x), lowered, mask_sql(lowered)]


def shingles_sql(x, k=3):
    y = f"regexp_replace({x}, '\\s+', ' ', 'g')"
    return f"list_distinct(list_transform(range(1, length({y}) - {k - 2}), lambda i: substr({y}, i, {k})))"


def distance_sql(a, b, sa, sb):
    union = f"(len({sa}) + len({sb}) - len(list_intersect({sa}, {sb})))"
    return f"""(case when {a} = {b} then 0.0::double when {union} = 0 then 1.0::double
        else 1.0::double - len(list_intersect({sa}, {sb})) / {union} end)"""


def values_sql(rows, *names):
    shown = ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)
    return f"(select * from (values {shown}) as t({', '.join(names)}))"


def headers_sql(names):
    rows = [(n, col, i) for n in names for i, col in enumerate(MESSY if n == "messy" else COLUMNS[n], 1)]
    return values_sql(rows, "dataset", "column_name", "position")


def listed_sql(pairs):
    return values_sql([(n, col.upper().replace("_", " ")) for n, col in pairs], "dataset", "col_name_ta")


LABEL_ROWS = values_sql(
    [(n, col, label) for n, col, labels_ in LABELLED for label in labels_.strip(",").split(", ")],
    "dataset", "column_name", "true_label",
)
TOP10 = f"""(select * from (select *, row_number() over (partition by dataset, column_name
    order by n desc, value) as rk from ({frequencies_sql(*DATASETS)}) where value is not null) where rk <= 10)"""
SET = """(select * from (select true_label, {kind}, cast(sum(n) as bigint) as count,
    row_number() over (partition by true_label order by sum(n) desc, {kind}) as rank
  from (select true_label, value as frequent_value, upper(replace(column_name, '_', ' ')) as col_name_ta, n
        from %s join %s using (dataset, column_name)) group by true_label, {kind}) where rank <= 20)""" % (TOP10, LABEL_ROWS)
VALUE_SET, COLUMN_SET = SET.format(kind="frequent_value"), SET.format(kind="col_name_ta")
PART_VALUES = """(select distinct p_name as value from part union select upper(concat(p_brand, '-', p_type)) from part
    union select lower(c_mktsegment) from customer)"""
WEIGHT = "([0.90, 0.95, 0.97, 1.00][stage + 1])::double"


def staged_sql(source, text, keep):
    parts = [f"select {keep}, {i} as stage, {f} as form from {source}" for i, f in enumerate(forms_sql(text))]
    return f"(select *, {shingles_sql('form')} as sh from ({' union all '.join(parts)}))"


def refs_sql(kind):
    source, column = (VALUE_SET, "frequent_value") if kind == "values" else (COLUMN_SET, "col_name_ta")
    return f"(select true_label as s_type, {column} as target, rank as ord from {source})"


def distances_sql(values, refs, on="", keep="value", text="value"):
    """Every string against every target at every stage."""
    return f"""(select v.* exclude (form, sh), r.* exclude (form, sh, stage{', dataset' if on else ''}), v.form as f0, r.form as f1,
        {distance_sql('v.form', 'r.form', 'v.sh', 'r.sh')} as distance
      from {staged_sql(values, text, keep)} v join {staged_sql(refs, 'target', '*')} r on v.stage = r.stage {on})"""


def choose_stage(source, keys, score, columns):
    return f"""select {keys}, {columns}, round(case when distance = 0 then 0 else {score} end, 6) as adjusted, stage
      from (select * from {source} qualify row_number() over (partition by {keys} order by distance <> 0,
        case when distance = 0 then 0 else round({score}, 12) end, stage) = 1)"""


def nearest_sql(distances, keys, first="round(distance, 12), s_type, ord", where=""):
    best = f"""(select * from {distances} {where} qualify
        row_number() over (partition by {keys}, stage order by {first}) = 1)"""
    return choose_stage(best, keys, f"distance * {WEIGHT}", "s_type, target, round(distance, 6) as distance")


def best_types_sql(distances, keys, where="", by="total", score="average"):
    per_type = f"""(select {keys}, stage, s_type, sum(distance) as total, avg(distance) as mean,
        min(round(distance, 12)) as distance, arg_min(target, (round(distance, 12), ord)) as target
      from {distances} {where} group by all)"""
    best = f"""(select *, case when distance = 0 then 0 else mean end as average from {per_type} qualify row_number() over (
        partition by {keys}, stage order by distance <> 0,
        case when distance = 0 then 0 else round({by}, 12) end, s_type) = 1)"""
    return choose_stage(best, keys, score, "s_type, target, round(distance, 6) as distance, round(average, 6) as average")


PART_DISTANCES = distances_sql(PART_VALUES, refs_sql("values"))


def resolved_sql(pairs, names):
    headers_ = f"(select dataset, '' as s_type, column_name as target, position as ord from {headers_sql(names)})"
    near = nearest_sql(
        distances_sql(listed_sql(pairs), headers_, "and v.dataset = r.dataset", "dataset, col_name_ta", "col_name_ta"),
        "dataset, col_name_ta",
    )
    return f"(select dataset, col_name_ta, target as column_name, distance, adjusted from ({near}))"


COLUMN_TYPES = f"""(select dataset, column_name, s_type as column_type from {headers_sql(TYPED_DATASETS)} join (
    {nearest_sql(distances_sql(f"(select distinct column_name as value from {headers_sql(TYPED_DATASETS)})", refs_sql("columns")), "value")}
    ) t on column_name = t.value)"""

# The rules on a lower-cased value x, as a list of types; types without targets never match.
RULES_SQL = """list_concat(
    case when length(x) = 1 and regexp_full_match(x, '\\p{L}+')
          and column_type in ('person_name (middle_initial)', 'borough') then [column_type] else [] end,
    case when length(x) = 2 and regexp_full_match(x, '\\p{L}+') then ['color'] else [] end,
    case when length(x) = 5 and regexp_full_match(x, '\\p{Nd}+') then ['zip_code'] else [] end,
    case when length(x) >= 3 and regexp_full_match(x, '\\p{Nd}+')
         then ['city_agency', 'street_number', 'phone_number', 'building_classification'] else [] end,
    case when regexp_full_match(x, '\\p{Nd}+') then ['street_number'] else [] end,
    case when regexp_matches(x, 'ps |is |js |hs ') then ['school_name'] else [] end,
    case when length(x) >= 3 and regexp_matches(x, 'llc|inc|co') then ['business_name'] else [] end,
    case when length(x) >= 3 and regexp_matches(x, 'http|www|org|com') then ['website'] else [] end,
    case when length(x) >= 3 and regexp_matches(x, '^\\p{Nd}.*(ave|str)') then ['address'] else [] end)"""

SEMANTIC = f"""with freq as (select f.dataset, f.column_name, f.value, f.n, t.column_type
      from ({frequencies_sql(*TYPED_DATASETS)}) f
      join (select distinct dataset, column_name from {resolved_sql(TYPED, TYPED_DATASETS)}) r using (dataset, column_name)
      join {COLUMN_TYPES} t using (dataset, column_name)),
    vals as (select distinct value, column_type, lower(value) as x from freq
      where value is not null and lower(value) not in ('null', '-', '_', '0', 'none', '')),
    ruled as (select value, column_type, {RULES_SQL} as rules from vals),
    d as materialized ({distances_sql("(select distinct value from vals)", refs_sql("values"))}),
    one as ({best_types_sql("(select d.*, v.column_type from d join vals v using (value))", "value, column_type",
                            "where s_type = column_type")}),
    two as ({best_types_sql("(select d.*, v.column_type, v.rules from d join ruled v using (value))",
                            "value, column_type",
                            "where len(rules) = 0 or s_type = column_type or list_contains(rules, s_type)")}),
    typed as (select v.value, v.column_type, case when one.average is null or (one.average > 0.9
        and two.average <= round(one.average * 0.8, 6)) then coalesce(two.s_type, v.column_type) else v.column_type end as s_type
      from vals v left join one using (value, column_type) left join two using (value, column_type)),
    result as (select f.dataset, f.column_name, f.value, f.n, f.column_type, coalesce(t.s_type, f.column_type) as s_type
      from freq f left join typed t on f.value = t.value and f.column_type = t.column_type),
    counts as (select dataset, column_name, s_type, cast(sum(n) as bigint) as n from result group by all)
    """
LABEL_LIST = ", ".join(f"'{label}'" for label in sem.LABELS)
ALIGNED = """(select column_name, true_label, semantic_type, count(*) as n from
    (select concat('orders', o_orderkey, '.state.txt.gz') as column_name,
            unnest([o_orderstatus, o_orderpriority]) as true_label from orders)
    full outer join (select distinct concat('orders', l_orderkey, '.state.txt.gz') as column_name,
            unnest([l_linestatus, l_returnflag]) as semantic_type from lineitem) using (column_name) group by all)"""


def grown_sql(distances):
    return f"""with refs as {refs_sql("values")},
        near as (select value, s_type, distance from ({nearest_sql(distances, "value")})
          where round(distance, 12) between 0.10 and 0.65),
        fresh as (select s_type, value, distance from near anti join refs on refs.s_type = near.s_type and refs.target = near.value),
        have as (select s_type, max(ord) as have from refs group by all)
      select s_type, target, ord as target_order from refs union all
      select s_type, value, have + row_number() over (partition by s_type order by distance, value) as target_order
      from fresh join have using (s_type) qualify target_order <= 30"""


NAME = "concat(p_brand, ' ', p_name)"
FORM_SQL = forms_sql(NAME)
NAME_DISTANCE = distance_sql("p_name", NAME, shingles_sql("p_name"), shingles_sql(NAME))

SQL = {
    "string_forms": f"""select p_partkey, {", ".join(f"{f} as form{i}" for i, f in enumerate(FORM_SQL))},
        {FORM_SQL[3]} as standard,
        case when length(p_name) < length(p_brand) then p_name else p_brand end as shorter,
        list_min(list_transform(string_split({NAME}, ' '), lambda w: length(w))) as shortest_word,
        contains(lower({NAME}), lower(p_name)) or contains(lower(p_name), lower({NAME})) as either,
        contains({strip_sql("p_name")}, {strip_sql(NAME)}) as within,
        round({NAME_DISTANCE}, 6) as distance, {NAME_DISTANCE} < 0.5 as close,
        regexp_full_match(p_type, '[A-Za-z]+') as alphabetic,
        regexp_full_match(substr(p_brand, 7, 2), '[0-9]+') as digits from part""",
    "resolved_columns": f"select * from {resolved_sql(TYPED, TYPED_DATASETS)}",
    "missing_columns": f"""select dataset as ds_name, col_name_ta from {listed_sql(TYPED)} l anti join
        (select * from {resolved_sql(TYPED, ("part", "orders", "messy"))} where distance <= 0.5)
        using (dataset, col_name_ta)""",
    "label_sample": f"""select dataset as ds_path, upper(replace(column_name, '_', ' ')) as col_name_ta,
        column_name as col_name, string_agg(concat(value, '->', n), ' | ' order by rk) as frequent_values
      from {TOP10} semi join {LABEL_ROWS} using (dataset, column_name) group by all""",
    "reference_values": f"select * from {VALUE_SET}",
    "reference_columns": f"select * from {COLUMN_SET}",
    "reference_lists": f"""select true_label, string_agg(frequent_value, ' | ' order by rank) as targets
        from {VALUE_SET} group by all""",
    "nearest_target": nearest_sql(PART_DISTANCES, "value"),
    "nearest_target_raw": nearest_sql(PART_DISTANCES, "value", where="where stage = 0"),
    "nearest_containing": nearest_sql(
        PART_DISTANCES, "value", "value <> target, round(distance, 12), s_type, ord",
        "where contains(f0, f1) or contains(f1, f0)",
    ),
    "nearest_customer": nearest_sql(distances_sql(
        "(select distinct replace(s_name, '#000', '-') as value from supplier)",
        """(select c_mktsegment as s_type, c_name as target,
            row_number() over (partition by c_mktsegment order by c_name) as ord from customer)"""), "value"),
    "best_types": best_types_sql(PART_DISTANCES, "value"),
    "best_types_by_average": best_types_sql(PART_DISTANCES, "value", by="mean", score=f"average * {WEIGHT}"),
    "column_types": f"select * from {COLUMN_TYPES}",
    "semantic_values": SEMANTIC + "select * from result",
    "semantic_counts": SEMANTIC + "select * from counts",
    "semantic_records": SEMANTIC + f"""select dataset, column_name, string_agg(shown, ', ' order by known, label nulls first)
        as semantic_types from (select *, case when s_type in ({LABEL_LIST}) then s_type else 'other' end as known,
          case when s_type in ({LABEL_LIST}) then null else s_type end as label,
          concat(known, ' ', coalesce(label, ''), ' ', n) as shown from counts) group by all""",
    "grown_reference": grown_sql(PART_DISTANCES),
    "grown_from_types": grown_sql(distances_sql(
        f"""(select distinct value from ({frequencies_sql(*TYPED_DATASETS)}) semi join {resolved_sql(TYPED, TYPED_DATASETS)} r
             using (dataset, column_name) where value is not null)""", refs_sql("values"))),
    "aligned_labels": f"select * from {ALIGNED}",
    "precision": f"""select semantic_type, coalesce(round(sum(n) filter (true_label = semantic_type) /
        nullif(sum(n) filter (true_label is not null), 0), 6), 0) as precision from {ALIGNED}
        where semantic_type is not null group by all""",
    "recall": f"""select true_label as semantic_type, coalesce(round(sum(n) filter (true_label = semantic_type) / sum(n), 6), 0)
        as recall from {ALIGNED} where true_label is not null group by true_label""",
    "listed_order": "select s_name as dataset, s_nationkey, 1000 - s_suppkey as pos from supplier",
    "run_log_summary": """select user_id as run, count(*) as steps, round(sum(value), 6) as total,
        round(avg(value), 6) as mean, max(value) as longest, arg_min(event_type, (-value, event_id)) as slowest_output
        from events group by all""",
    "running_means": """select user_id as run, event_id as step, value as seconds, event_type as output,
        round(avg(value) over (partition by user_id order by event_id), 9) as running_mean from events""",
}
