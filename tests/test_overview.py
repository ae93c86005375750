"""Description of all columns, and names held by other names, against plain Python."""

import random
import statistics

from terrasift.operators.overview import described
from terrasift.operators.reconcile import STATE_NAMES, containment_summary


def quartile(values, q):
    values = sorted(values)
    at = (len(values) - 1) * q
    low, high = values[int(at)], values[min(int(at) + (at % 1 > 0), len(values) - 1)]
    return low + (high - low) * (at - int(at))


def test_described_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1.5, 2.0, -7.25, float("nan"), rng.random()]), rng.choice([7, 7, 7, rng.randrange(99)]), rng.choice(["b", "a", None, "", "é" * 70]), rng.random() < 0.5) for _ in range(401)]
    # The columns are called like those inside.
    got = {r["column"]: r for r in described(spark.createDataFrame(rows, "num double, part int, text string, `a b` boolean").repartition(5), "t").collect()}
    for k, c in enumerate(("num", "part")):
        values = [r[k] for r in rows if r[k] is not None and r[k] == r[k]]
        assert [round(got[c][f"q{q}"], 9) for q in (25, 50, 75)] == [round(quartile(values, q / 100), 9) for q in (25, 50, 75)]
        assert got[c]["unique"] is None and got[c]["top"] is None
    assert round(got["part"]["mean"], 9) == round(statistics.mean(r[1] for r in rows), 9)
    for k, c in ((2, "text"), (3, "a b")):
        values = [str(r[k]).lower() if k == 3 else r[k] for r in rows if r[k] is not None]
        top = min(set(values), key=lambda v: (-values.count(v), v))
        assert (got[c]["n_values"], got[c]["unique"], got[c]["top"], got[c]["freq"], got[c]["q50"]) == (len(values), len(set(values)), top, values.count(top), None)


def test_described_ties_empty_and_missing(spark):
    ties = described(spark.createDataFrame([("b",), ("a",), ("c",), ("b",), ("a",)], "v string"), "t").first()
    assert (ties["top"], ties["freq"], ties["unique"]) == ("a", 2, 3)
    none = described(spark.createDataFrame([(None, None)], "v string, n int").limit(0), "t").collect()
    assert [(r["n_rows"], r["n_values"], r["top"], r["q50"]) for r in none] == [(0, 0, None, None)] * 2
    missing = described(spark.createDataFrame([(None, None)] * 3, "v string, n int"), "t").collect()
    assert [(r["n_rows"], r["n_values"], r["unique"], r["q25"]) for r in missing] == [(3, 0, None, None)] * 2
    one = described(spark.createDataFrame([(4,)], "n int"), "t").first()
    assert (one["q25"], one["q50"], one["q75"], one["min"], one["max"]) == (4.0, 4.0, 4.0, 4.0, 4.0)


def test_containment_summary(spark):
    rng = random.Random(4)
    a = [*STATE_NAMES, "", None, "x", "lakes", "Lakes"] + ["".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(40)]
    b = [v.upper() if k % 2 else v for k, v in enumerate(STATE_NAMES.values())] + ["Unity State", "", None, "eq"] + ["".join(rng.choice("abAB") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    got = containment_summary(spark.createDataFrame([(x,) for x in a], "n string"), "n", spark.createDataFrame([(x,) for x in b], "n string"), "n", STATE_NAMES)
    values = {x for x in b if x}
    want = []
    for name in {x for x in a if x}:
        full = STATE_NAMES.get(name, name)
        holding = [v for v in values if full.upper() in v.upper()]
        within = [v for v in values if v.upper() in full.upper() and v.upper() != full.upper()]
        want.append((name, full, full in values, len(holding), len(within), min(holding + within, default=None)))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert containment_summary(spark.createDataFrame([], "n string"), "n", spark.createDataFrame([], "n string"), "n").count() == 0
