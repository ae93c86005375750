"""The sixteen registered datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.sources.metadata_files import DESCRIPTION_SCHEMA

# Name, description, owner, priority, file, file type, loader, target schema, target table.
DATASETS = (
    ("jiaf_south_sudan_2026", "South Sudan Humanitarian Needs 2026 downloaded from HDX", "HDX", 3,
     "jiaf_south_sudan_2026.xlsx", "excel", "ExcelLoader", "raw_data", "jiaf_south_sudan_2026"),
    ("ssd_2024_population_estimates", "South Sudan Population Estimates 2024 downloaded from HDX", "HDX", 2,
     "ssd_2024_population_estimates_data.xlsx", "excel", "ExcelLoader", "raw_data", "population_estimates_2024"),
    ("health_facilities_2026", "South Sudan Health facilities 2026 downloaded from HDX", "HDX", 2,
     "health_facilities.xlsx", "excel", "ExcelLoader", "raw_data", "health_facilities"),
    ("education_facilities_2026", "South Sudan Education facilities 2026 downloaded from HDX", "HDX", 2,
     "education_facilities.gpkg", "geopackage", "GeoPackageLoader", "raw_data", "education_facilitites"),
    ("ipc_ssd_2026", "South Sudan IPC Area Wide data 2026 downloaded from HDX", "HDX", 2,
     "ipc_ssd_2026.csv", "csv", "CSVLoader", "raw_data", "ipc_ssd_2026"),
    ("food_prices_2026", "South Sudan food prices downloaded from HDX provided by WFP", "WFP", 2,
     "food_prices_2026.csv", "csv", "CSVLoader", "raw_data", "food_prices_2026"),
    ("displacement_2026", "South Sudan displacement data downloaded from HDX", "HDX", 2,
     "displacement.csv", "csv", "CSVLoader", "raw_data", "displacement_2026"),
    ("violence_events_and_fatalities_2026", "South Sudan violence events and fatalities data downloaded from HDX", "HDX", 2,
     "violence_events_and_fatalities.xlsx", "Excel", "ExcelLoader", "raw_data", "conflict_2026"),
    ("rainfall_subnat", "South Sudan rainfall data downloaded from HDX", "HDX", 2,
     "rainfall_subnat.csv", "csv", "CSVLoader", "raw_data", "rainfall_subnat"),
    ("ndvi_subnat", "South Sudan NDVI data downloaded from HDX", "HDX", 2,
     "ndvi_subnat.csv", "csv", "CSVLoader", "raw_data", "ndvi_subnat"),
    ("affected_and_displaced_by_floods_2026", "South Sudan affected and displaced by floods data downloaded from HDX", "HDX", 2,
     "affected_and_displaced_by_floods.xlsx", "excel", "ExcelLoader", "raw_data", "flood_displacement_2026"),
    ("populated_places", "South Sudan populated places data downloaded from HDX", "HDX", 2,
     "populated_places.gpkg", "geopackage", "GeoPackageLoader", "raw_data", "populated_places"),
    ("roads", "South Sudan Roads 2026 downloaded from HDX", "HDX", 2,
     "roads.gpkg", "geopackage", "GeoPackageLoader", "raw_data", "roads"),
    ("ssd_admin1", "South Sudan states data downloaded from HDX", "HDX", 3,
     "ssd_admin1.geojson", "geojson", "GeoJSONLoader", "gis", "state_boundary"),
    ("ssd_admin2", "South Sudan counties data downloaded from HDX", "HDX", 3,
     "ssd_admin2.geojson", "geojson", "GeoJSONLoader", "gis", "county_boundary"),
    ("ssd_admin3", "South Sudan payams data downloaded from HDX", "HDX", 3,
     "ssd_admin3.geojson", "geojson", "GeoJSONLoader", "gis", "payam_boundary"),
)

# Shared by all sixteen.
SOURCE_TYPE, CHUNK_SIZE, LOAD_MODE = "local_file", 5000, "replace"


def registered_descriptions(spark: SparkSession, landing: str, database: str = "landing") -> DataFrame:
    """The descriptions as rows, with file paths below the given landing folder."""
    rows = [
        (f"{name}.yml", None, name, description, owner, priority, True, SOURCE_TYPE, f"{landing.rstrip('/')}/{file}",
         file_type, loader, CHUNK_SIZE, LOAD_MODE, True, database, schema, table)
        for name, description, owner, priority, file, file_type, loader, schema, table in DATASETS
    ]
    return spark.createDataFrame(rows, DESCRIPTION_SCHEMA).where(F.col("error").isNull())
