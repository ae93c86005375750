import pytest
from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.operators import catalog as C
from terrasift.operators.gate import DataQualityError
from terrasift.plans import datasets, ingest, models, registry
from terrasift.sources import readers, writers
from terrasift.sources.geopackage import geopackage_bytes
from terrasift.sources.metadata_files import read_descriptions
from terrasift.sources.workbook import workbook_bytes

CSV = "id,name,value\n1,alpha,10.5\n2,beta,20.25\n3,gamma,30.0\n"
GEOJSON = """{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:EPSG::4326"}},"features":[
 {"type":"Feature","properties":{"id":1,"name":"adm1-a"},"geometry":{"type":"Point","coordinates":[31.0,6.5]}},
 {"type":"Feature","properties":{"id":2,"name":"adm1-b"},"geometry":{"type":"Point","coordinates":[32.4,7.9]}}]}"""


@pytest.fixture()
def landing(tmp_path):
    (tmp_path / "t.csv").write_text(CSV)
    rows = [(1, "north", 5.5), (2, "south", 15.75), (3, "east", 25.0), (4, "west", 35.25)]
    (tmp_path / "t.xlsx").write_bytes(workbook_bytes(["id", "name", "value"], rows))
    points = [(1, "site-a", 31.5, 6.8), (2, "site-b", 30.2, 4.85), (3, "site-c", 32.1, 7.6)]
    blobs = [(i, n, G._wkb_encode("Point", [x], [y], [[1]])) for i, n, x, y in points]
    (tmp_path / "t.gpkg").write_bytes(geopackage_bytes("sites", ["id", "name"], blobs))
    (tmp_path / "t.geojson").write_text(GEOJSON)
    return tmp_path


def describe(folder, name, file, file_type, loader, table, mode="replace"):
    (folder / "meta").mkdir(exist_ok=True)
    (folder / "meta" / f"{name}.yml").write_text(
        f"dataset:\n  name: {name}\n  description: d\n  owner: o\n  priority: 1\nsource:\n  type: local_file\n  path: {folder / file}\n"
        f"  file_type: {file_type}\nloader:\n  class: {loader}\n  chunk_size: 500\ntarget:\n  database: db\n  schema: landing\n  table: {table}\n  load_mode: {mode}\n"
    )


FORMATS = {
    "csv": ("t.csv", "CSVLoader", 3), "excel": ("t.xlsx", "ExcelLoader", 4),
    "geopackage": ("t.gpkg", "GeoPackageLoader", 3), "GeoJSON": ("t.geojson", "GeoJSONLoader", 2),
}


def test_four_formats_end_to_end(spark, landing):
    for i, (kind, (file, loader, _)) in enumerate(FORMATS.items()):
        describe(landing, f"set_{i}", file, kind, loader, f"end_{i}")
    (landing / "meta" / "bad.yml").write_text("just text")
    found = read_descriptions(spark, str(landing / "meta"))
    assert found.where("error is not null").count() == 1
    r = registry.register_all(found, registry.empty_registry(spark))
    done = ingest.run_all(spark, r)
    for i, (_, _, rows) in enumerate(FORMATS.values()):
        result = done[f"set_{i}"]
        assert not isinstance(result, Exception), result
        assert result.load.rows_loaded == rows and result.validation.is_valid
        assert spark.table(f"landing.end_{i}").count() == rows
    first = spark.table("landing.end_0").orderBy("id").first()
    assert (first["id"], first["name"], first["value"]) == (1, "alpha", 10.5)
    west = spark.table("landing.end_1").orderBy(F.desc("id")).first()
    assert (west["id"], west["name"], west["value"]) == (4, "west", 35.25)
    for i, x, y in ((2, 31.5, 6.8), (3, 31.0, 6.5)):
        df = spark.table(f"landing.end_{i}").where("id = 1")
        got = df.select(G.point_x("geometry"), G.point_y("geometry"), G.srid_of("geometry"), G.bare_type_name("geometry")).first()
        assert tuple(got) == (x, y, 4326, "POINT")
    # A second run replaces, it does not append.
    ingest.run_dataset(spark, r, "set_0")
    assert spark.table("landing.end_0").count() == 3


def test_na_tokens_and_types(spark, tmp_path):
    (tmp_path / "n.csv").write_text('a,b,c,d,"q, x"\n1,NA,True,5,"say ""hi"""\n2,2.5,False,null,y\n')
    df = readers.read_csv(spark, str(tmp_path / "n.csv"))
    assert [f.dataType.typeName() for f in df.schema.fields] == ["long", "double", "boolean", "double", "string"]
    assert [tuple(r) for r in df.collect()] == [(1, None, True, 5.0, 'say "hi"'), (2, 2.5, False, None, "y")]


def test_dispatch_errors(spark, landing):
    with pytest.raises(FileNotFoundError):
        readers.read_source(spark, str(landing / "none.csv"), "csv")
    with pytest.raises(readers.UnsupportedFileTypeError, match="geojson"):
        readers.read_source(spark, str(landing / "t.csv"), "parquet")
    assert readers.file_kind(" .XLSX ") == "excel"
    (landing / "broken.xlsx").write_bytes(b"not a workbook")
    with pytest.raises(readers.ExtractionError):
        readers.read_source(spark, str(landing / "broken.xlsx"), "xlsx")


def test_excel_gaps_and_text_numbers(spark, tmp_path):
    rows = [(1, "7", None, True), (2, "x", 2.5, False), (None, "NA", 3.0, True)]
    (tmp_path / "g.xlsx").write_bytes(workbook_bytes(["id", "text", "num", "flag"], rows))
    df = readers.read_source(spark, str(tmp_path / "g.xlsx"), "xlsx")
    assert [f.dataType.typeName() for f in df.schema.fields] == ["double", "string", "double", "boolean"]
    assert [tuple(r) for r in df.collect()] == [(1.0, "7", None, True), (2.0, "x", 2.5, False), (None, None, 3.0, True)]


def test_replace_keeps_views_and_reconciles(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    r = writers.load_table(one, "landing", "keep")
    assert (r.rows_loaded, r.load_mode, r.columns) == (2, "replace", ["id", "name"])
    spark.sql("create or replace temp view on_keep as select id from landing.keep")
    wider = spark.createDataFrame([("c", 3, 1.5)], "name string, id bigint, extra double")
    writers.load_table(wider, "landing", "keep")
    assert [tuple(x) for x in spark.table("on_keep").collect()] == [(3,)]
    assert [tuple(x) for x in spark.table("landing.keep").collect()] == [(3, "c", 1.5)]
    writers.load_table(one, "landing", "keep", "append")
    assert spark.table("landing.keep").where("extra is null").count() == 2
    with pytest.raises(writers.LoadError):
        writers.load_table(spark.createDataFrame([("x",)], "id string"), "landing", "keep", "append")


@pytest.mark.parametrize("args", [("s", "t", "upsert", None), ("s", "t; drop", "append", None), ("1s", "t", "append", None), ("s", "t", "append", 0)])
def test_load_guards(args):
    with pytest.raises(writers.LoadError):
        writers.check_load(*args)


def test_empty_and_nonspatial_frames_are_refused(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(writers.LoadError):
        writers.load_table(df.limit(0), "landing", "nothing")
    with pytest.raises(writers.LoadError):
        writers.load_spatial(df, "landing", "nothing")
    with pytest.raises(writers.LoadError):
        writers.load_spatial(df.withColumn("geometry", G.make_point(F.lit(1.0), F.lit(1.0), 0)), "landing", "nothing")


def test_mixed_geometry_is_generic(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (1, 0), (1, 1), (0, 0))])
    df = spark.range(2).withColumn("geometry", F.when(F.col("id") == 0, G.make_point(F.lit(1.0), F.lit(1.0))).otherwise(G.make_polygon(ring)))
    writers.load_spatial(df, "landing", "mixed")
    assert spark.table("landing.mixed").schema["geometry"].metadata["geometry_type"] == "Geometry"


def test_percent_in_names_and_nested_values(spark):
    df = spark.createDataFrame([(1.0, [1, 2])], "`Population %` double, items array<int>")
    writers.load_table(df, "landing", "odd")
    assert tuple(spark.table("landing.odd").first()) == (1.0, "[1,2]")


def test_gate_blocks_or_lets_through(spark, landing):
    describe(landing, "gated", "t.csv", "csv", "CSVLoader", "gated")
    r = registry.register_all(read_descriptions(spark, str(landing / "meta")), registry.empty_registry(spark))
    rules = {"value": {"max": 15}}
    with pytest.raises(DataQualityError):
        ingest.run_dataset(spark, r, "gated", rules)
    assert not spark.catalog.tableExists("landing.gated")
    done = ingest.run_dataset(spark, r, "gated", rules, raise_on_invalid=False)
    assert done.load.rows_loaded == 3 and not done.validation.is_valid


def test_resolution_errors(spark, landing):
    describe(landing, "whole", "t.csv", "csv", "CSVLoader", "x")
    (landing / "meta" / "half.yml").write_text("dataset:\n  name: half\nsource:\n  type: a\n  path: b\n  file_type: csv\n")
    r = registry.register_all(read_descriptions(spark, str(landing / "meta")), registry.empty_registry(spark))
    with pytest.raises(registry.MetadataResolutionError, match="not registered"):
        ingest.run_dataset(spark, r, "nobody")
    with pytest.raises(registry.MetadataResolutionError, match="target"):
        ingest.run_dataset(spark, r, "half")
    with pytest.raises(FileNotFoundError):
        read_descriptions(spark, str(landing / "nowhere"))
    with pytest.raises(ingest.UnsupportedLoaderClassError, match="CSVLoader"):
        ingest.spatial_loader("ParquetLoader")
    with pytest.raises(ingest.IngestionError, match="Extraction failed"):
        ingest.ingest(spark, str(landing / "gone.csv"), "csv", "CSVLoader", "landing", "x")


def test_registering_twice_adds_nothing(spark):
    found = datasets.registered_descriptions(spark, "/landing")
    once = registry.register_all(found, registry.empty_registry(spark))
    assert (once.dataset.count(), once.source.count(), once.target.count(), once.config.count()) == (16, 16, 16, 16)
    twice = registry.register_all(found, once)
    assert (twice.dataset.count(), twice.source.count(), twice.target.count(), twice.config.count()) == (16, 16, 16, 16)
    kinds = {r[0]: r[1] for r in once.source.groupBy(F.lower("file_type")).count().collect()}
    assert kinds == {"excel": 5, "csv": 5, "geopackage": 3, "geojson": 3}
    assert registry.resolve(once).where("missing is null").count() == 16


def test_catalogue(spark):
    writers.recreate_table(spark.range(7).toDF("id"), "cat_test.seven")
    assert [tuple(r) for r in C.table_catalogue(spark, ["cat_test"]).collect()] == [("cat_test", "seven", "MANAGED", 7)]
    assert C.load_tables(spark, ["cat_test.seven"])["seven"].count() == 7


def test_models_resolve_their_inputs(spark):
    with pytest.raises(KeyError):
        models.build("health_facilities", {})
    assert models.build("x", {"x": spark.range(1)}).count() == 1


def test_schemas_replace_inference(spark, landing):
    kinds = {"t.csv": "csv", "t.xlsx": "excel"}
    for file, kind in kinds.items():
        df = readers.read_source(spark, str(landing / file), kind, "id int, value string")
        assert [f.dataType.typeName() for f in df.schema.fields] == ["integer", "string"] and df.count() in (3, 4)
    for file, kind in {"t.gpkg": "gpkg", "t.geojson": "geojson"}.items():
        df = readers.read_source(spark, str(landing / file), kind, "name string, id string")
        assert df.columns == ["name", "id", "geometry"] and df.orderBy("id").first()["id"] == "1"


def test_null_skipping_registration(spark):
    from terrasift.sources.metadata_files import DESCRIPTION_SCHEMA

    def row(file, path, kind):
        return (file, None, "d", "", "o", 1, True, "local", path, kind, "CSVLoader", 1, None, False, None, None, None)

    rows = [row("1", "a", "csv"), row("2", "a", None), row("3", "b", "csv"), row("4", None, None), row("5", "a", "csv"), row("6", None, "excel")]
    r = registry.register_all(spark.createDataFrame(rows, DESCRIPTION_SCHEMA), registry.empty_registry(spark))
    got = {(x["path"], x["file_type"]) for x in r.source.collect()}
    assert got == {("a", "csv"), ("b", "csv"), (None, "excel")}
    later = spark.createDataFrame([row("7", "a", None), row("8", "c", "csv")], DESCRIPTION_SCHEMA)
    assert [x["path"] for x in registry.new_sources(later, r.dataset, r.source).collect()] == ["c"]
