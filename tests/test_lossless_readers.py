"""Landing files come back without loss: long integers, quoted line breaks, differing headers."""

import pytest

from terrasift.sources.readers import read_csv
from terrasift.sources.typing import infer_types


def test_long_integers_stay_exact(spark, tmp_path):
    rows = ["id,wide,huge,gap", f"1234567890123456789,{10**30},{10**40},1", f"1234567890123456790,{10**30 + 1},{10**40 + 1},"]
    (tmp_path / "a.csv").write_text("\n".join(rows) + "\n")
    df = read_csv(spark, str(tmp_path / "a.csv"))
    assert [t for _, t in df.dtypes] == ["bigint", "decimal(38,0)", "string", "double"]
    assert sorted(r["id"] for r in df.collect()) == [1234567890123456789, 1234567890123456790]
    assert sorted(int(r["wide"]) for r in df.collect()) == [10**30, 10**30 + 1]
    given = read_csv(spark, str(tmp_path / "a.csv"), "id bigint, wide decimal(38,0), huge string, gap double")
    assert sorted(map(tuple, given.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_limits_of_bigint(spark):
    df = spark.createDataFrame([("9223372036854775807",), ("-9223372036854775808",)], "v string")
    assert [r["v"] for r in infer_types(df).collect()] == [2**63 - 1, -(2**63)]
    assert infer_types(spark.createDataFrame([("9223372036854775808",)], "v string")).dtypes == [("v", "decimal(38,0)")]


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "b.csv").write_text('id,note\n1,"two\nlines"\n2,"say ""hi"""\n')
    rows = {r["id"]: r["note"] for r in read_csv(spark, str(tmp_path / "b.csv")).collect()}
    assert rows == {1: "two\nlines", 2: 'say "hi"'}


def test_reordered_headers_are_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text("id,amount\n1,10\n")
    (tmp_path / "2.csv").write_text("amount,id\n20,2\n")
    with pytest.raises(Exception, match="CSV header|column names"):
        read_csv(spark, str(tmp_path)).collect()


def test_reordered_headers_are_read_by_name(spark, tmp_path):
    from terrasift.sources.readers import ExtractionError, csv_layout, read_source

    (tmp_path / "1 [a].csv").write_text('id,"am,ount"\n1,10\n')
    (tmp_path / "2.csv").write_text('"am,ount",id\n20,2\n"3\n0",3\n')
    (tmp_path / "3.csv").write_text('id,"am,ount"\n')
    (tmp_path / "4.csv").write_text("")
    layout = csv_layout(spark, str(tmp_path))
    assert sorted(names for names, _ in layout.headers) == [["am,ount", "id"], ["id", "am,ount"]]
    assert layout.quoted_breaks and layout.repeated is None
    df = read_source(spark, str(tmp_path), "csv")
    assert sorted((r["id"], r["am,ount"]) for r in df.collect()) == [(1, "10"), (2, "20"), (3, "3\n0")]
    (tmp_path / "5.csv").write_text("id,other\n1,2\n")
    with pytest.raises(ExtractionError, match="does not have the columns"):
        read_source(spark, str(tmp_path), "csv")


def test_repeated_header_in_any_file_reaches_the_gate(spark, tmp_path):
    from terrasift.operators.gate import DataQualityError
    from terrasift.plans.ingest import _extract, gated_load

    (tmp_path / "1.csv").write_text("id,amount,id\n1,10,1\n")
    df, header = _extract(spark, str(tmp_path), "csv")
    assert header == ["id", "amount", "id"] and df.count() == 1
    with pytest.raises(DataQualityError, match=r"Duplicate column names create ambiguity: \['id'\]"):
        gated_load(df, {}, header=header)


def test_cells_keep_long_integers(spark):
    from terrasift.sources.cells import cell, type_cells

    cells = [[cell("n", "123456789012345678"), cell("n", "7.0")], [cell("n", "123456789012345679"), cell("n", "8")]]
    df = type_cells(spark.createDataFrame([(c,) for c in cells], "cells array<string>"), ["key", "n"])
    assert [tuple(r) for r in df.orderBy("key").collect()] == [(123456789012345678, 7), (123456789012345679, 8)]
