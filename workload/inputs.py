"""Domain tables derived from the benchmark tables.

The benchmark tables are clean, so dirt is planted by fixed arithmetic on the
keys. Each input is one SQL text that Spark and the comparison engine both
read, which makes the inputs of the two sides equal; what the operators compute
from them is written separately for each side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.operators.joins import estimated_bytes

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_STATE = "'SS' || lpad(cast({n} AS string), 2, '0')"
_COUNTY = "'SS' || lpad(cast({n} % 26 AS string), 2, '0') || lpad(cast({n} AS string), 6, '0')"


def _state(n: str) -> str:
    return _STATE.replace("{n}", n)


def _county(n: str) -> str:
    return _COUNTY.replace("{n}", n)


_GROUPS = (
    "male_under_5", "female_under_5", "male_5_17", "female_5_17",
    "male_18_60", "female_18_60", "male_over_60", "female_over_60",
)

INPUTS: dict[str, str] = {
    # State boundaries: one per nation, some without geometry or centre.
    "state_raw": f"""
        SELECT n_nationkey AS id,
               {_state("(n_nationkey + 1)")} || CASE WHEN n_nationkey % 6 = 5 THEN ' ' ELSE '' END AS adm1_pcode,
               CASE WHEN n_nationkey % 5 = 4 THEN 'north-bank ' ELSE 'State ' END || cast(n_nationkey + 1 AS string) AS adm1_ref_name,
               ' ' || n_name || ' ' AS adm1_name, 'SS ' AS adm0_pcode, ' Country' AS adm0_name,
               ' v' || cast(n_nationkey % 3 AS string) AS version, 'en ' AS lang,
               DATE '2020-01-01' AS valid_on, cast(NULL AS date) AS valid_to,
               CASE WHEN n_nationkey % 11 = 10 THEN NULL ELSE cast(3 + (n_nationkey % 5) * 2 AS double) + 0.5 END AS center_lat,
               cast(24 + n_nationkey - n_nationkey % 5 AS double) / 1 + 0.5 AS center_lon,
               cast(50000 + n_nationkey * 100 AS double) AS area_sqkm,
               n_nationkey % 13 <> 12 AS geom_ok,
               cast(24 + n_nationkey - n_nationkey % 5 AS double) AS x0, cast(3 + (n_nationkey % 5) * 2 AS double) AS y0
        FROM {{nation}}""",
    # County boundaries: one per supplier.
    "county_raw": f"""
        SELECT s_suppkey AS id,
               CASE WHEN s_suppkey % 47 = 46 THEN '  ' ELSE {_county("s_suppkey")} || CASE WHEN s_suppkey % 9 = 8 THEN ' ' ELSE '' END END AS adm2_pcode,
               CASE WHEN s_suppkey % 7 = 3 THEN 'al-jazira ' ELSE 'County ' END || cast(s_suppkey AS string) AS adm2_ref_name,
               s_name || ' ' AS adm2_name, ' ' || {_state("(s_suppkey % 26)")} AS adm1_pcode,
               'State ' || cast(s_suppkey % 26 AS string) AS adm1_name, 'SS' AS adm0_pcode, 'Country' AS adm0_name,
               'v1' AS version, ' en' AS lang, DATE '2021-05-01' AS valid_on, cast(NULL AS date) AS valid_to,
               CASE WHEN s_suppkey % 31 = 30 THEN NULL ELSE cast(30 + s_suppkey % 90 AS double) / 10 END AS center_lat,
               cast(240 + s_suppkey % 100 AS double) / 10 AS center_lon,
               cast(s_suppkey % 60 * 1000 AS double) AS area_sqkm,
               s_suppkey % 37 <> 36 AS geom_ok,
               cast(240 + s_suppkey % 100 AS double) / 10 - CASE WHEN s_suppkey % 8 = 7 THEN 0.5 ELSE 0.25 END AS x0,
               cast(30 + s_suppkey % 90 AS double) / 10 - 0.25 AS y0
        FROM {{supplier}}""",
    # Facility list A: one per order.
    "facility_a_raw": f"""
        SELECT o_orderkey AS row_id,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN 'old state ' || cast(o_custkey % 110 % 26 AS string) WHEN o_orderkey % 5 = 0 THEN 'STATE ' || cast(o_custkey % 110 % 26 AS string) || ' '
                    ELSE 'state ' || cast(o_custkey % 110 % 26 AS string) END AS old_state,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN ' ' || {_state("(o_custkey % 110 % 26)")}
                    WHEN o_orderkey % 23 = 0 THEN 'XX99' ELSE {_state("(o_custkey % 110 % 26)")} END AS state_code,
               CASE WHEN o_orderkey % 29 = 0 THEN 'county b ' ELSE 'county ' END || cast(o_custkey % 110 AS string) AS county,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE {_county("(o_custkey % 110)")} END AS county_code,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'Payam ' || cast(o_custkey % 110 AS string) || '-' || cast(o_orderkey % 10 AS string) END AS payam,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN 'P00'
                    ELSE 'P' || cast(o_custkey % 110 AS string) || '-' || cast(o_orderkey % 10 AS string) END AS payam_code,
               CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN '   '
                    WHEN o_orderkey % 3 = 0 THEN '  Facility ' || cast(o_custkey % 997 AS string) || '​ '
                    WHEN o_orderkey % 4 = 0 THEN 'facility  ' || cast(o_custkey % 997 AS string)
                    ELSE 'Facility ' || cast(o_custkey % 997 AS string) END AS site,
               CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE 'dhis ' || cast(o_orderkey AS string) END AS site_dhis2_name,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE cast(200 + o_custkey * 7 % 1200 AS double) / 100 END AS latitude,
               CASE WHEN o_orderkey % 27 = 0 THEN NULL ELSE cast(2200 + o_custkey * 11 % 1500 AS double) / 100 END AS longitude
        FROM {{orders}}""",
    # Facility list B: one per customer.
    "facility_b_raw": f"""
        SELECT c_custkey AS row_id,
               CASE WHEN c_custkey % 5 = 0 THEN 'State ' ELSE 'STATE ' END || cast(c_custkey % 110 % 26 AS string) AS state,
               CASE WHEN c_custkey % 53 = 0 THEN 'SS77' ELSE {_state("(c_custkey % 110 % 26)")} END AS state_code,
               'County ' || cast(c_custkey % 110 AS string) AS county, {_county("(c_custkey % 110)")} AS county_code,
               'Payam ' || cast(c_custkey % 110 AS string) || '-' || cast(c_custkey % 7 AS string) AS payam,
               'P' || cast(c_custkey % 110 AS string) || '-' || cast(c_custkey % 7 AS string) AS payam_code,
               CASE WHEN c_custkey % 59 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN ' FACILITY  ' || cast(c_custkey % 1009 + 300 AS string)
                    WHEN c_custkey % 3 = 1 THEN 'facility ' || cast(c_custkey % 997 AS string)
                    ELSE 'Facility ' || cast(c_custkey % 1009 + 300 AS string) || CASE WHEN c_custkey % 6 = 0 THEN ' PHCU' ELSE '' END END AS facility_name,
               CASE WHEN c_custkey % 10 = 0 THEN 'PHCC+' WHEN c_custkey % 3 = 0 THEN 'PHCU' WHEN c_custkey % 3 = 1 THEN 'PHCC' ELSE 'Hospital' END AS type,
               {_state("(c_custkey % 110 % 26)")} || '-' || cast(c_custkey - CASE WHEN c_custkey % 61 = 1 THEN 1 ELSE 0 END AS string) AS facilities_code,
               CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE cast(200 + (c_custkey * 7 + c_custkey % 3) % 1200 AS double) / 100 END AS latitude,
               CASE WHEN c_custkey % 24 = 0 THEN NULL ELSE cast(2200 + c_custkey * 11 % 1500 AS double) / 100 END AS longitude
        FROM {{customer}}""",
    # Population estimates: one row per supplier of a line, plus the country total.
    "population_raw": f"""
        SELECT CASE WHEN k % 21 = 20 THEN ' ' ELSE ' State ' || cast(k % 26 AS string) END AS admin1,
               CASE WHEN k % 19 = 18 THEN NULL ELSE lower({_state("(k % 26)")}) || ' ' END AS admin1_pcode,
               'County ' || cast(k AS string) AS admin2,
               CASE WHEN k % 29 = 28 THEN NULL ELSE ' ' || {_county("(k - CASE WHEN k % 40 = 1 THEN 1 ELSE 0 END)")} END AS admin2_pcode,
               total + CASE WHEN k % 15 = 14 THEN 150 WHEN k % 33 = 32 THEN -floor(total * 0.95) ELSE 0 END AS population_2025,
               {", ".join(f"CASE WHEN k % 45 = {40 + i % 4} AND {i} < 4 THEN -g{i} ELSE g{i} END AS {g}" for i, g in enumerate(_GROUPS))},
               {", ".join(f"g{i} / total + CASE WHEN k % 27 = {19 + i} THEN 1 ELSE 0 END AS pct_{g}" for i, g in enumerate(_GROUPS))}
        FROM (SELECT l_suppkey AS k, sum(l_quantity) * 10 + 1 AS total,
                     {", ".join(f"sum(CASE WHEN (l_linenumber + l_orderkey) % 8 = {i} THEN l_quantity * 10 ELSE 0 END) AS g{i}" for i in range(8))}
              FROM {{lineitem}} GROUP BY l_suppkey) s
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, sum(l_quantity) * 10,
               {", ".join(f"sum(CASE WHEN (l_linenumber + l_orderkey) % 8 = {i} THEN l_quantity * 10 ELSE 0 END)" for i in range(8))},
               {", ".join(f"sum(CASE WHEN (l_linenumber + l_orderkey) % 8 = {i} THEN l_quantity ELSE 0 END) / sum(l_quantity)" for i in range(8))}
        FROM {{lineitem}}""",
    # Needs table: everything is text, with a header row and roll-up rows.
    "needs_raw": f"""
        SELECT CASE WHEN c_custkey % 8 = 0 THEN ' n/a ' WHEN c_custkey % 9 = 0 THEN 'north-bank  ' || cast(c_custkey % 26 AS string)
                    ELSE ' stATE   ' || cast(c_custkey % 26 AS string) END AS col_1,
               CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 14 = 0 THEN '-' ELSE lower({_state("(c_custkey % 110 % 26)")}) END AS col_2,
               'county ' || cast(c_custkey % 110 AS string) AS col_3,
               CASE WHEN c_custkey % 16 = 0 THEN 'Unknown' ELSE {_county("(c_custkey % 110)")} || ' ' END AS col_4,
               '1,' || lpad(cast(c_custkey % 1000 AS string), 3, '0') || '.5' AS col_5,
               CASE WHEN c_custkey % 3 = 0 THEN 'idps' WHEN c_custkey % 3 = 1 THEN 'host COMMUNITY' ELSE 'NULL' END AS col_6,
               CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 1 THEN '1e5' ELSE cast(c_custkey % 700 AS string) END AS sectoral_pin_number,
               cast(c_custkey % 900 AS string) AS col_7, '+5' AS col_8, '.5' AS col_9,
               cast(c_custkey % 50 AS string) || '.25' AS col_10, '-' || cast(c_custkey % 40 AS string) AS col_11,
               cast(c_custkey % 1200 AS string) AS col_12, ' 12 ' AS col_13,
               CASE WHEN c_custkey % 25 = 24 THEN '12.5' ELSE cast(c_custkey % 6 AS string) || '.125' END AS col_14,
               cast(c_custkey % 800 AS string) AS col_15, cast(c_custkey * 3 % 1900 AS string) AS col_16
        FROM {{customer}}
        UNION ALL
        SELECT 'Admin 1', 'Admin 1 P-Code', 'Admin 2', 'Admin 2 P-Code', 'Projection', 'Group', 'CCCM', 'a', 'b', 'c', 'd', 'e', 'f', 'g', 'h', 'i', 'j'
        FROM {{region}} WHERE r_regionkey = 0""",
    # Education facilities: one per part; kind says which shape the geometry has.
    "education_raw": f"""
        SELECT ' ' || cast(p_partkey AS string) AS id,
               CASE WHEN p_partkey % 20 = 0 THEN NULL WHEN p_partkey % 21 = 0 THEN ' ' ELSE '﻿' || p_name || '  School ' || cast(p_size AS string) END AS name,
               CASE WHEN p_partkey % 7 = 0 THEN ' ' ELSE ' ' || upper(p_brand) END AS amenity,
               'SS' || lpad(cast(p_size % 26 AS string), 2, '0') || ' ' AS adm1_pcode,
               'State  ' || cast(p_size % 26 + CASE WHEN p_partkey % 100 = 9 THEN 1 ELSE 0 END AS string) AS adm1_name,
               'C' || cast(p_size + CASE WHEN p_partkey % 80 = 4 THEN 1 ELSE 0 END AS string) AS adm2_pcode, ' County ' || cast(p_size + CASE WHEN p_partkey % 70 = 3 THEN 1 ELSE 0 END AS string) AS adm2_name,
               'Y' || cast(p_size AS string) || '-' || cast(p_partkey % 4 AS string) AS adm3_pcode,
               CASE WHEN p_partkey % 90 = 5 THEN 'Payam X' ELSE 'Payam ' || cast(p_partkey % 4 AS string) END AS adm3_name,
               CASE WHEN p_partkey % 2 = 0 THEN p_type END AS name_latin,
               cast(p_partkey % 6 AS int) AS kind, cast(p_size % 10 AS double) + 24 AS x, cast(p_size % 8 AS double) + 4 AS y
        FROM {{part}}""",
    # Metadata descriptions: one per supplier.
    "descriptions": """
        SELECT 'm/' || lpad(cast(s_suppkey AS string), 9, '0') || '.yml' AS file,
               CASE WHEN s_suppkey % 17 = 16 THEN 'not a mapping' END AS error,
               'set_' || cast(s_suppkey - s_suppkey % 3 AS string) AS name, s_name AS description,
               CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'owner ' || cast(s_nationkey AS string) END AS owner,
               cast(s_suppkey % 4 AS int) AS priority, s_suppkey % 12 <> 9 AS has_source,
               'local_file' AS type, CASE WHEN s_suppkey % 3 = 2 THEN NULL ELSE 'p/' || cast(s_suppkey AS string) END AS path,
               CASE WHEN s_suppkey % 2 = 0 THEN 'csv' ELSE 'excel' END AS file_type,
               CASE WHEN s_suppkey % 2 = 0 THEN 'CSVLoader' ELSE 'ExcelLoader' END AS loader_class,
               5000 AS chunk_size, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'replace' END AS load_mode,
               s_suppkey % 15 <> 12 AS has_target, 'db' AS `database`, 'raw' AS `schema`, 't' || cast(s_suppkey % 3 AS string) AS `table`
        FROM {supplier}""",
    # Lines with gaps, odd text and values out of range.
    "dirty_line": """
        SELECT l_orderkey, l_linenumber, l_suppkey,
               CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
               CASE WHEN l_orderkey % 13 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS l_extendedprice,
               CASE WHEN l_orderkey % 17 = 0 THEN 'n.a.' WHEN l_orderkey % 19 = 0 THEN NULL ELSE cast(l_linenumber * 7 AS string) END AS code,
               CASE WHEN l_orderkey % 23 = 0 THEN '' WHEN l_orderkey % 29 = 0 THEN '   ' ELSE l_returnflag END AS flag,
               l_discount
        FROM {lineitem}""",
    # Texts with spacing and casing faults.
    "dirty_text": """
        SELECT doc_id, lang, source,
               CASE WHEN doc_id % 7 = 0 THEN ' ' || text WHEN doc_id % 11 = 0 THEN text || ' ' WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS text,
               CASE WHEN doc_id % 5 = 0 THEN ' N/A' WHEN doc_id % 6 = 0 THEN 'unknown ' WHEN doc_id % 9 = 0 THEN '' WHEN doc_id % 10 = 1 THEN '  '
                    WHEN doc_id % 14 = 0 THEN NULL ELSE lang END AS label,
               cast(n_chars AS string) AS n_text
        FROM {documents}""",
}

_NEEDS = {name: [n for n in (*BASE, *INPUTS) if "{" + n + "}" in sql] for name, sql in INPUTS.items()}


def duck(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql).replace("`", '"')


# Tables behind the text- and geometry-heavy inputs.
_SPREAD = ("customer", "documents", "orders", "part")

# A table above this size that sits in fewer splits than there are cores is dealt out once.
_SPREAD_ABOVE_BYTES = 256 << 10


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table that is one small file; a table of many files is left as it is."""
    sc = df.sparkSession.sparkContext
    if df.rdd.getNumPartitions() >= sc.defaultParallelism or (estimated_bytes(df) or 0) < _SPREAD_ABOVE_BYTES:
        return df
    return df.repartition(sc.defaultParallelism)


class Tables:
    """Benchmark tables and derived inputs of one scale, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            return spread(df) if name in _SPREAD else df
        if name in INPUTS:
            return self.spark.sql(INPUTS[name], **{n: getattr(self, n) for n in _NEEDS[name]})
        if name in SHAPED:
            return SHAPED[name](self)
        raise AttributeError(name)


def _xy(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def polygon(x, y, offsets):
    """A ring from corner offsets around (x, y)."""
    return G.make_polygon(F.array(*[_xy(x + dx, y + dy) for dx, dy in offsets]))


# A corner piece is cut out of every state, so a box test alone is not enough.
NOTCHED = ((0, 0), (5, 0), (5, 1), (2, 1), (2, 2), (0, 2), (0, 0))
SQUARE = ((0, 0), (0.5, 0), (0.5, 0.5), (0, 0.5), (0, 0))
BOWTIE = ((0, 0), (1, 1), (1, 0), (0, 1), (0, 0))
STAR = ((0, 3), (2, -3), (-3, 1), (3, 1), (-2, -3), (0, 3))
OPEN_RING = ((0, 0), (1, 0), (1, 1), (0, 1))


def _states(t: Tables) -> DataFrame:
    shape = polygon(F.col("x0"), F.col("y0"), NOTCHED)
    return t.state_raw.withColumn("geometry", F.when(F.col("geom_ok"), shape)).drop("geom_ok", "x0", "y0")


def _counties(t: Tables) -> DataFrame:
    shape = polygon(F.col("x0"), F.col("y0"), SQUARE)
    return t.county_raw.withColumn("geometry", F.when(F.col("geom_ok"), shape)).drop("geom_ok", "x0", "y0")


def _education(t: Tables) -> DataFrame:
    x, y, kind = F.col("x"), F.col("y"), F.col("kind")
    shape = (
        F.when(kind == 1, polygon(x, y, SQUARE))
        .when(kind == 2, polygon(x, y, BOWTIE))
        .when(kind == 3, polygon(x, y, STAR))
        .when(kind == 4, polygon(x, y, OPEN_RING))
        .otherwise(G.make_point(x, y))
    )
    return t.education_raw.withColumn("geometry", shape).drop("kind", "x", "y")


SHAPED = {"states": _states, "counties": _counties, "education": _education}
