"""Counting operators against brute force over the listed pairs."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from terrasift.operators import reconcile as X
from terrasift.operators.joins import fits_broadcast, hot_keys, lookup_join, salted_join


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)

    def side(n):
        names = [None, "HOT"] + [f"N{i}" for i in range(15)]
        rows = []
        for i in range(n):
            name = "HOT" if rng.random() < 0.35 else rng.choice(names)
            rows.append((i, name, rng.choice(["u", "U", "w", None]), rng.choice(["c", "d", None])))
        return rows

    cols = "row_id int, name string, state string, county string"
    a, b = side(120), side(90)
    return spark.createDataFrame(a, cols), spark.createDataFrame(b, cols), pd.DataFrame(a, columns=["row_id", "name", "state", "county"]), pd.DataFrame(b, columns=["row_id", "name", "state", "county"])


def test_agreement(sides):
    a, b, pa, pb = sides
    m = pa.dropna(subset=["name"]).merge(pb.dropna(subset=["name"]), on="name", suffixes=("", "_b"))
    same = (m["state"].str.upper() == m["state_b"].str.upper()).sum()
    row = X.agreement(a, b, "name", [("state", "state")]).first()
    assert (row["matched"], row["agree"], row["disagree"]) == (len(m), same, len(m) - same)
    by_key = {r["key"]: r["disagree"] for r in X.disagreeing_keys(a, b, "name", "state", "state").collect()}
    assert sum(by_key.values()) == len(m) - same


def test_agreement_with_null_keys(sides):
    a, b, pa, pb = sides
    m = pa.merge(pb, on="name", suffixes=("", "_b"))
    assert X.agreement(a, b, "name", [("state", "state")], null_safe_keys=True).first()["matched"] == len(m)


def test_strategies_and_risk(sides):
    a, b, pa, pb = sides
    sets = {"n": ["name"], "ns": ["name", "state"]}
    got = {r["strategy"]: r["matched"] for r in X.strategies(a, b, sets, null_safe_keys=True).collect()}
    assert got == {k: len(pa.merge(pb, on=v)) for k, v in sets.items()}
    m = pa.dropna().merge(pb.dropna(), on=["name", "state"]).groupby("name").size()
    drop = pa.dropna(subset=["name", "state"]).merge(pb.dropna(subset=["name", "state"]), on=["name", "state"]).groupby("name").size()
    risk = {r["key"]: r["matches"] for r in X.match_risk(a, b, ["name", "state"], "name").collect()}
    assert risk == drop[drop > 1].to_dict() and len(m)


def test_unmatched_sides(spark):
    a = spark.createDataFrame([(1, "x", "p"), (2, "x", None), (3, None, None), (4, "side 0", "q"), (5, "y", "p")], "row_id int, k string, l string")
    b = spark.createDataFrame([(6, "x", "p"), (7, "x", None), (8, "side 0", None), (9, "x", "p")], "row_id int, k string, l string")

    def ids(pair):
        return [sorted(r["row_id"] for r in df.collect()) for df in pair]

    assert ids(X.unmatched_sides(a, b, ["k", "l"])) == [[3, 4, 5], [8]]
    assert ids(X.unmatched_sides(a, b, ["k", "l"], null_safe_keys=False)) == [[2, 3, 4, 5], [7, 8]]
    assert ids(X.unmatched_sides(a, b.limit(0), ["k"])) == [[1, 2, 3, 4, 5], []]


def test_unmatched(sides):
    a, b, pa, pb = sides
    known = {tuple(r) for r in pb[["name", "county"]].where(pb.notna(), None).values.tolist()}
    want = {r.row_id for r in pa.where(pa.notna(), None).itertuples() if (r.name, r.county) not in known}
    got = {r[0] for r in X.unmatched(a, b, ["name", "county"]).select("row_id").collect()}
    assert got == want


def test_overlap(sides):
    a, b, pa, pb = sides
    row = X.overlap(a, b, "name").first()
    sa, sb = set(pa["name"].dropna()), set(pb["name"].dropna())
    assert (row["n_a"], row["n_b"], row["n_common"], row["n_only_a"]) == (len(sa), len(sb), len(sa & sb), len(sa - sb))


def test_containment(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abAB") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    a = spark.createDataFrame([(w,) for w in words[:30]], "x string")
    b = spark.createDataFrame([(w,) for w in words[30:]], "y string")
    got = {tuple(r) for r in X.containment_matches(a, "x", b, "y").collect()}
    want = {(p, q) for p in words[:30] for q in words[30:] if p.upper() in q.upper() or q.upper() in p.upper()}
    assert got == want


def test_coordinates(spark):
    cols = "row_id int, name string, lat double, lon double"
    a = spark.createDataFrame([(1, "A", 5.0, 30.0), (2, "A", 9.0, 9.0), (3, "B", 5.0, 30.0), (4, "C", None, 1.0), (5, "C", 5.0, 5.0)], cols)
    b = spark.createDataFrame([(1, "A", 5.0, 30.0), (2, "B", 5.1, 30.0), (3, "C", 5.0, 5.0)], cols)
    got = {r["key"]: r["band"] for r in X.coordinate_distances(a, b, "name", "lat", "lon", "row_id").collect()}
    assert got == {"A": "exact", "B": "major"}  # the first row of C has no coordinates
    row = X.coordinate_compare(a, b, "name", "lat", "lon", "row_id").first()
    assert (row["n_common"], row["exact_match"], row["major_diff"]) == (2, 1, 1)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i % 20}", i) for i in range(400)] + [(None, 1), ("hot", 0)], "k string, v int")
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("zz", 4)], "k string, w int")
    plain = sorted(map(repr, big.join(small, ["k"], how).collect()))
    assert sorted(map(repr, salted_join(big, small, ["k"], how, salts=5).collect())) == plain
    assert sorted(map(repr, lookup_join(big, small, "k", how).collect())) == plain


def test_hot_keys_are_bounded(spark):
    big = spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i}",) for i in range(3000)], "k string")
    assert [r["k"] for r in hot_keys(big, ["k"], 0.01).collect()] == ["hot"]


def test_fits_broadcast_measures(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 100) as t")
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=999)
    assert not fits_broadcast(df, max_bytes=50_000)


def test_exact_medians_equal_the_gathered_ones(spark):
    from terrasift.operators.quantiles import exact_medians

    rows = [("a", float(i % 97)) for i in range(1000)] + [("b", 3.0), ("b", 4.0), (None, 7.0), ("c", None), ("d", 1.0), ("d", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    plain = df.where("v is not null").groupBy("k").agg(F.median("v").alias("median"))
    assert sorted(map(repr, exact_medians(df, "v", ["k"]).collect())) == sorted(map(repr, plain.collect()))
    assert exact_medians(df, "v").first()[0] == df.agg(F.median("v")).first()[0]
    assert exact_medians(df.where("false"), "v").collect()[0][0] is None
    assert exact_medians(df.where("false"), "v", ["k"]).count() == 0
