"""Readers, writers, registry and loading queries (S, K, R, L).

Files and tables are written below the shared scratch folder of the session.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.operators import catalog as C
from terrasift.operators.gate import gate_report, validate
from terrasift.plans import ingest as L
from terrasift.plans import models as M
from terrasift.plans import registry as R
from terrasift.session import scratch_dir
from terrasift.sources import readers, writers
from terrasift.sources.geopackage import decode_geopackages, geopackage_bytes
from terrasift.sources.metadata_files import parse_descriptions
from terrasift.sources.workbook import decode_workbooks, workbook_bytes
from workload.registry import query

c = F.col
SCHEMA = "terrasift_run"

# Rows per generated file: a file never grows with the table, their number does.
FILE_ROWS = 5000


def schema(t) -> str:
    """The database of the generated tables, placed below the shared scratch folder."""
    t.spark.sql(f"create database if not exists {SCHEMA} location '{scratch_dir(t.spark)}'")
    return SCHEMA


def fresh_table() -> str:
    return f"t_{uuid.uuid4().hex}"


# --- S -------------------------------------------------------------------------


def landing(t):
    return t.customer.select(
        "c_custkey",
        F.concat(F.lit('a "quoted", '), "c_name").alias("full name"),
        F.when(c("c_custkey") % 7 == 0, F.lit("NA")).otherwise(c("c_acctbal").cast("string")).alias("balance"),
        F.when(c("c_custkey") % 11 == 0, F.lit("null")).otherwise(c("c_mktsegment")).alias("segment"),
    )


_LANDING = "select c_custkey, 'a \"quoted\", ' || c_name as \"full name\", case when c_custkey % 7 = 0 then null else c_acctbal end as balance, case when c_custkey % 11 = 0 then null else c_mktsegment end as segment from customer"


def write_csv(df, path):
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


@query("s01_csv_scan", _LANDING)
def _(t):
    return readers.read_csv(t.spark, write_csv(landing(t), scratch_dir(t.spark)))


def _two_headers(t) -> str:
    """Landing files of which every other one has its columns in reverse order."""
    folder = scratch_dir(t.spark)
    rows, odd = landing(t), F.pmod(F.hash(*landing(t).columns), F.lit(2)) == 1
    write_csv(rows.where(odd), f"{folder}/in_order")
    write_csv(rows.where(~odd).select(*reversed(rows.columns)), f"{folder}/reversed")
    return f"{folder}/*"


@query("s01_csv_reordered_headers", _LANDING)
def _(t):
    return readers.read_source(t.spark, _two_headers(t), "csv")


@query("v04_repeated_header", "select 'Duplicate column names create ambiguity: [''c_custkey'']' as message, count(*) as checked_rows from customer")
def _(t):
    path = scratch_dir(t.spark)
    text = landing(t).select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("c_custkey", "balance", "c_custkey")]).alias("value"))
    # The writer makes no such header itself, so it is given as the text column's name.
    text.withColumnRenamed("value", "c_custkey,balance,c_custkey").write.options(header=True, quote="", sep="\x01").csv(path)
    layout = readers.csv_layout(t.spark, path)
    outcome = validate(readers.read_source(t.spark, path, "csv", layout=layout), header=layout.repeated)
    return t.spark.createDataFrame([(e, outcome.checked_rows) for e in outcome.errors], "message string, checked_rows long")


@query("s01_csv_scan_with_schema", "select c_custkey, case when c_custkey % 7 = 0 then null else c_acctbal end as balance from customer")
def _(t):
    return readers.read_csv(t.spark, write_csv(landing(t), scratch_dir(t.spark)), "c_custkey bigint, balance double")


def _book(key, pdf):
    rows = list(zip(pdf["c_custkey"].tolist(), pdf["c_name"].tolist(), pdf["balance"].tolist(), (pdf["c_nationkey"] > 12).tolist()))
    content = workbook_bytes(["Key", "Name", "Balance", "Far"], rows)
    return pd.DataFrame({"path": [f"{key[0]}.xlsx"], "content": [content]})


@query("s02_excel_scan", 'select c_custkey as "Key", c_name as "Name", case when c_custkey % 5 = 0 then null else c_acctbal end as "Balance", c_nationkey > 12 as "Far" from customer')
def _(t):
    rows = t.customer.withColumn("balance", F.when(c("c_custkey") % 5 != 0, c("c_acctbal"))).withColumn("file", F.floor(c("c_custkey") / FILE_ROWS))
    # A group is one file of a fixed number of keys.
    return decode_workbooks(rows.groupBy("file").applyInPandas(_book, "path string, content binary"))


def _package(key, pdf):
    rows = list(zip(pdf["s_suppkey"].tolist(), pdf["s_name"].tolist(), pdf["s_acctbal"].tolist(), pdf["w"].tolist()))
    content = geopackage_bytes("sites", ["key", "name", "balance"], rows, srid=32636)
    return pd.DataFrame({"path": [f"{key[0]}.gpkg"], "content": [content]})


@query("s03_geopackage_scan", "select s_suppkey as key, s_name as name, s_acctbal as balance, 32636 as srid, 20.5 + s_nationkey as x, s_acctbal as y from supplier")
def _(t):
    sites = t.supplier.withColumn("w", G.to_wkb(G.make_point(c("s_nationkey") + 20.5, "s_acctbal")))
    files = sites.withColumn("file", F.floor(c("s_suppkey") / FILE_ROWS)).groupBy("file").applyInPandas(_package, "path string, content binary")
    out = decode_geopackages(files)
    return out.select("key", "name", "balance", G.srid_of("geometry").alias("srid"), G.point_x("geometry").alias("x"), G.point_y("geometry").alias("y"))


@query("s04_geojson_scan", "select s_suppkey as key, s_name as name, case when s_suppkey % 3 = 0 then 'Point' else 'Polygon' end as gtype, 4326 as srid, cast(s_nationkey as double) as minx, case when s_suppkey % 3 = 0 then s_nationkey else s_nationkey + 2 end + 0.0 as maxx from supplier")
def _(t):
    n = c("s_nationkey").cast("string")
    m = (c("s_nationkey") + 2).cast("string")
    point = F.format_string('{"type":"Point","coordinates":[%s,7.5]}', n)
    square = F.format_string('{"type":"Polygon","coordinates":[[[%s,0],[%s,0],[%s,1],[%s,1],[%s,0]]]}', n, m, m, n, n)
    feature = F.format_string(
        '{"type":"Feature","properties":%s,"geometry":%s}',
        F.to_json(F.struct(c("s_suppkey").alias("key"), c("s_name").alias("name"))),
        F.when(c("s_suppkey") % 3 == 0, point).otherwise(square),
    )
    docs = t.supplier.groupBy(F.floor(c("s_suppkey") / FILE_ROWS).alias("file")).agg(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("value")
    )
    path = scratch_dir(t.spark)
    docs.select("value").write.option("maxRecordsPerFile", 1).text(path)
    out = readers.read_geojson(t.spark, path)
    b = G.bounds("geometry")
    return out.select("key", "name", c("geometry.gtype").alias("gtype"), G.srid_of("geometry").alias("srid"), b["minx"].alias("minx"), b["maxx"].alias("maxx"))


@query("s05_format_dispatch", _LANDING)
def _(t):
    return readers.read_source(t.spark, write_csv(landing(t), scratch_dir(t.spark)), " .CSV ")


@query("s06_table_scan", "select n_name, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1")
def _(t):
    names = [f"{schema(t)}.{fresh_table()}" for _ in range(2)]
    for name, df in zip(names, (t.customer, t.nation)):
        writers.recreate_table(df, name, scratch_dir(t.spark))
    loaded = C.load_tables(t.spark, names)
    customers, nations = (loaded[n.split(".")[1]] for n in names)
    return customers.join(nations, c("c_nationkey") == c("n_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))


_YAML = (
    "case when s_suppkey % 17 = 16 then 'just text' when s_suppkey % 13 = 12 then 'dataset:\n  owner: x' else "
    "'dataset:\n  name: set_' || s_suppkey || '\n  owner: o' || s_nationkey || '\n  priority: ' || (s_suppkey % 4) || "
    "'\nsource:\n  type: local_file\n  path: p/' || s_suppkey || '.csv\n  file_type: csv\nloader:\n  class: CSVLoader\n  chunk_size: 5000\n"
    "target:\n  database: db\n  schema: raw\n  table: t' || s_suppkey || '\n  load_mode: append' end"
)


@query(
    "s11_description_scan",
    "select 'm/' || s_suppkey as file, case when bad = 1 then 'not a mapping' when bad = 2 then 'missing dataset name' end as error, "
    "case when bad = 0 then 'set_' || s_suppkey end as name, case when bad = 0 then cast(s_suppkey % 4 as int) end as priority, case when bad = 0 then 'append' end as load_mode, case when bad = 0 then 't' || s_suppkey end as \"table\" "
    "from (select *, case when s_suppkey % 17 = 16 then 1 when s_suppkey % 13 = 12 then 2 else 0 end bad from supplier)",
)
def _(t):
    files = t.supplier.select(F.concat(F.lit("m/"), c("s_suppkey").cast("string")).alias("path"), F.expr(_YAML).alias("text"))
    return parse_descriptions(files).select("file", "error", "name", "priority", "load_mode", "table")


@query("s13_model_resolution", "select state_code, state_name, count(*) as n from county_stage group by 1, 2")
def _(t):
    lookup = M.build("int_county_lookup", {"gis.county_boundary": t.counties})
    return lookup.groupBy("state_code", "state_name").agg(F.count(F.lit(1)).alias("n"))


# --- K -------------------------------------------------------------------------


def orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query("k01_replace_load", "select o_orderkey, o_totalprice from orders where o_orderkey % 2 = 0")
def _(t):
    name = fresh_table()
    writers.load_table(orders(t), schema(t), name, location=scratch_dir(t.spark))
    view = t.spark.table(f"{schema(t)}.{name}").select("o_orderkey", "o_totalprice")
    view.createOrReplaceTempView(f"v_{name}")
    writers.load_table(orders(t).where("o_orderkey % 2 = 0"), schema(t), name)
    return t.spark.table(f"v_{name}")


@query("k02_append_load", "select o_orderkey, count(*) as n from (select o_orderkey from orders union all select o_orderkey from orders where o_orderkey % 3 = 0) group by 1")
def _(t):
    name = fresh_table()
    writers.load_table(orders(t), schema(t), name, "append", location=scratch_dir(t.spark))
    writers.load_table(orders(t).where("o_orderkey % 3 = 0"), schema(t), name, "append")
    return t.spark.table(f"{schema(t)}.{name}").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("k03_create_from_types", "select c_custkey, c_acctbal, cast(c_nationkey as bigint) as c_nationkey, c_custkey % 2 = 0 as even from customer")
def _(t):
    name = fresh_table()
    writers.load_table(t.customer.select("c_custkey", c("c_acctbal").cast("float").cast("double").alias("x"), "c_acctbal", "c_nationkey", (c("c_custkey") % 2 == 0).alias("even")).drop("x"), schema(t), name, location=scratch_dir(t.spark))
    return t.spark.table(f"{schema(t)}.{name}")


@query("k04_additive_columns", "select o_orderkey, o_custkey, o_totalprice, null as o_orderstatus from orders where o_orderkey % 2 = 0 union all select o_orderkey, null, null, o_orderstatus from orders where o_orderkey % 2 = 1")
def _(t):
    name = fresh_table()
    writers.load_table(orders(t).where("o_orderkey % 2 = 0"), schema(t), name, location=scratch_dir(t.spark))
    writers.load_table(t.orders.where("o_orderkey % 2 = 1").select("o_orderstatus", "o_orderkey"), schema(t), name, "append")
    return t.spark.table(f"{schema(t)}.{name}")


@query("k05_batched_insert", "select l_orderkey, l_linenumber, case when l_orderkey % 7 = 0 then null else l_tax end as \"tax %\" from lineitem")
def _(t):
    name = fresh_table()
    dirty = t.lineitem.select("l_orderkey", "l_linenumber", F.when(c("l_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(c("l_tax")).alias("tax %"))
    writers.load_table(dirty, schema(t), name, chunk_size=1000, location=scratch_dir(t.spark))
    return t.spark.table(f"{schema(t)}.{name}").withColumn("l_linenumber", c("l_linenumber").cast("int"))


def sites(t):
    return t.facility_a_raw.select("row_id", G.make_point("longitude", "latitude").alias("geometry")).where(c("geometry").isNotNull())


@query("k07_spatial_load", "select row_id, longitude as x, latitude as y, floor(longitude) as cx from facility_a_raw where latitude is not null and longitude is not null")
def _(t):
    name = fresh_table()
    writers.load_spatial(sites(t), schema(t), name, location=scratch_dir(t.spark))
    out = t.spark.table(f"{schema(t)}.{name}")
    return out.select("row_id", G.point_x("geometry").alias("x"), G.point_y("geometry").alias("y"), c("_cell_x").cast("double").alias("cx"))


@query("k08_spatial_layout_box_scan", "select row_id from facility_a_raw where longitude between 25 and 27 and latitude between 4 and 6")
def _(t):
    name = fresh_table()
    writers.recreate_table(writers.spatial_layout(sites(t), "geometry"), f"{schema(t)}.{name}", scratch_dir(t.spark))
    return t.spark.table(f"{schema(t)}.{name}").where("_minx between 25 and 27 and _miny between 4 and 6").select("row_id")


@query("k09_sorted_layout", "select o_orderkey, o_totalprice from orders where o_custkey between 10 and 20")
def _(t):
    name = fresh_table()
    writers.recreate_table(writers.sorted_layout(orders(t), "o_custkey"), f"{schema(t)}.{name}", scratch_dir(t.spark))
    return t.spark.table(f"{schema(t)}.{name}").where("o_custkey between 10 and 20").select("o_orderkey", "o_totalprice")


@query("k09_bucketed_join", "select c_mktsegment, count(*) as n from orders join customer on o_custkey = c_custkey group by 1")
def _(t):
    a, b = fresh_table(), fresh_table()
    writers.bucketed_table(orders(t).withColumnRenamed("o_custkey", "k"), f"{schema(t)}.{a}", 8, "k", location=scratch_dir(t.spark))
    writers.bucketed_table(t.customer.select(c("c_custkey").alias("k"), "c_mktsegment"), f"{schema(t)}.{b}", 8, "k", location=scratch_dir(t.spark))
    joined = t.spark.table(f"{schema(t)}.{a}").join(t.spark.table(f"{schema(t)}.{b}"), "k")
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("k10_drop_and_create", "select o_custkey, sum(o_totalprice) as total from orders group by 1")
def _(t):
    name, where = f"{schema(t)}.{fresh_table()}", scratch_dir(t.spark)
    writers.recreate_table(orders(t), name, where)
    writers.recreate_table(t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total")), name, where)
    return t.spark.table(name)


@query("k11_publish_view", "select county_code, county_name, state_code from county_stage")
def _(t):
    M.materialise("stg_county_boundary", {"gis.county_boundary": t.counties}, schema(t))
    return t.spark.table("stg_county_boundary").select("county_code", "county_name", "state_code")


@query("k12_ordered_table", "select o_orderkey, o_custkey, o_totalprice from orders order by o_custkey, o_orderkey")
def _(t):
    name = f"{schema(t)}.{fresh_table()}"
    writers.write_ordered(orders(t), name, "o_custkey", "o_orderkey", location=scratch_dir(t.spark))
    return t.spark.table(name)


# --- R -------------------------------------------------------------------------


def registry(t):
    return R.register_all(t.descriptions, R.empty_registry(t.spark))


_OK = "descriptions where error is null"
_FIRST = f"(select name, arg_min(description, file) description, arg_min_null(owner, file) owner, arg_min(priority, file) priority, min(file) file from {_OK} group by 1)"


@query("r01_register_datasets", f"select name, description, owner, priority from {_FIRST}")
def _(t):
    return registry(t).dataset.drop("id")


@query("r01_register_again", f"select name from {_FIRST} where name not in (select 'set_' || s_suppkey from supplier where s_suppkey % 2 = 0)")
def _(t):
    known = t.supplier.where("s_suppkey % 2 = 0").select(F.concat(F.lit("set_"), c("s_suppkey").cast("string")).alias("name"))
    return R.new_datasets(t.descriptions, known).select("name")


def _child(flag, cols):
    same = " and ".join(f"(n.{x} is null or n.{x} = e.{x})" for x in cols)
    rows = f"(select * from {_OK} and {flag})"
    return f"select name, {', '.join(cols)} from {rows} n where not exists (select 1 from {rows} e where e.name = n.name and e.file < n.file and {same})"


@query("r02_register_sources", _child("has_source", ("type", "path", "file_type")))
def _(t):
    g = registry(t)
    return g.source.join(g.dataset.select(c("id").alias("dataset_id"), "name"), "dataset_id").select("name", "type", "path", "file_type")


@query("r03_register_targets", _child("has_target", ('"database"', '"schema"', '"table"')))
def _(t):
    g = registry(t)
    return g.target.join(g.dataset.select(c("id").alias("dataset_id"), "name"), "dataset_id").select("name", "database", "schema", "table")


@query("r04_register_configs", f"select name as asset_name, arg_min(priority, file) as priority, arg_min(loader_class, file) as loader_class, 5000 as chunk_size, arg_min_null(load_mode, file) as load_mode from {_OK} group by 1")
def _(t):
    return registry(t).config.select("asset_name", "priority", "loader_class", "chunk_size", "load_mode")


@query("r05_unresolved_files", "select file, error from descriptions where error is not null union all select file, 'dataset not registered: ' || name from descriptions where error is null and name not in (select 'set_' || s_suppkey from supplier where s_suppkey % 2 = 0)")
def _(t):
    known = t.supplier.where("s_suppkey % 2 = 0").select(F.concat(F.lit("set_"), c("s_suppkey").cast("string")).alias("name"))
    return R.unresolved(t.descriptions, known)


@query("r06_list_configs", f"select name as asset_name from {_FIRST}")
def _(t):
    return R.list_configs(registry(t)).select("asset_name")


@query("r07_resolve", f"select name as dataset_name, case when not exists (select 1 from {_OK} and has_source and descriptions.name = f.name) then 'source' when not exists (select 1 from {_OK} and has_target and descriptions.name = f.name) then 'target' end as missing from {_FIRST} f")
def _(t):
    return R.resolve(registry(t)).select("dataset_name", "missing")


# --- L -------------------------------------------------------------------------


def landing_registry(t, parts: int):
    """Customers landed as CSV files, one registered dataset per remainder of the key."""
    base, rows = scratch_dir(t.spark), []
    for i in range(parts):
        path = write_csv(landing(t).where(c("c_custkey") % parts == i), f"{base}/{i}")
        rows.append((f"{i}.yml", None, f"part_{i}", "", "o", i, True, "local_file", path, "csv", "CSVLoader", 5000, "replace", True, "db", schema(t), fresh_table()))
    from terrasift.sources.metadata_files import DESCRIPTION_SCHEMA

    return R.register_all(t.spark.createDataFrame(rows, DESCRIPTION_SCHEMA), R.empty_registry(t.spark))


@query("l01_gated_run", "select count(*) as n, count(*) as rows_loaded, 'part_0' as dataset, true as is_valid from customer")
def _(t):
    done = L.run_dataset(t.spark, landing_registry(t, 1), "part_0", {"c_custkey": {"min": 0, "unique": True}})
    loaded = t.spark.table(f"{done.load.schema}.{done.load.table}")
    return loaded.agg(F.count(F.lit(1)).alias("n"), F.lit(done.load.rows_loaded).cast("bigint").alias("rows_loaded"), F.lit(done.dataset_name).alias("dataset"), F.lit(done.validation.is_valid).alias("is_valid"))


@query("l02_ungated_load", _LANDING)
def _(t):
    name = fresh_table()
    L.ingest(t.spark, write_csv(landing(t), scratch_dir(t.spark)), "csv", "CSVLoader", schema(t), name)
    return t.spark.table(f"{schema(t)}.{name}")


@query("l04_run_all", "select 'part_' || i as dataset, count(*) as n from (select c_custkey % 3 i from customer) group by 1")
def _(t):
    from functools import reduce

    done = L.run_all(t.spark, landing_registry(t, 3))
    counts = [t.spark.table(f"{r.load.schema}.{r.load.table}").agg(F.lit(n).alias("dataset"), F.count(F.lit(1)).alias("n")) for n, r in done.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query("l05_gate_outcomes", "select count(*) filter (c_custkey < 10) as refused, count(*) as loaded_anyway from customer")
def _(t):
    rules = {"c_custkey": {"min": 10}}
    g = landing_registry(t, 1)
    try:
        L.run_dataset(t.spark, g, "part_0", rules)
        refused = t.customer.limit(0).agg(F.count(F.lit(1)).alias("refused"))
    except L.DataQualityError:
        refused = gate_report(landing(t), rules).where("check = 'below_min'").agg(F.sum("violations").alias("refused"))
    done = L.run_dataset(t.spark, g, "part_0", rules, raise_on_invalid=False)
    loaded = t.spark.table(f"{done.load.schema}.{done.load.table}").agg(F.count(F.lit(1)).alias("loaded_anyway"))
    return refused.withColumn("_one", F.lit(1)).join(loaded.withColumn("_one", F.lit(1)), "_one").drop("_one")
