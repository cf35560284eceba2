"""Row numbers: dense, never missing, in input order, the same for every kind of source."""

import pytest
from pyspark.sql import functions as F

from shockwell import fixed_values as fv
from shockwell.operators.securities import roll_up
from shockwell.sources import numbering, tables
from tests.conftest import rows


def write_lines(path, header, lines):
    path.write_text("\n".join([header, *lines]) + "\n", encoding="ISO-8859-1")
    return str(path)


def test_numbers_of_a_local_file_are_there(spark, tmp_path):
    path = write_lines(tmp_path / "x.csv", "id,name", ["S1,Zeta", "S1,Alpha"])
    for name in (path, f"file:{path}", f"file://{path}"):
        assert rows(tables.read_raw(spark, name), "row_ord", "name") == [(0, "Zeta"), (1, "Alpha")]


def test_the_first_text_is_that_of_the_first_row(spark, tmp_path):
    path = write_lines(tmp_path / "x.csv", "id,name,v", ["S1,Zeta,1", "S1,Alpha,2", "S2,Mid,3"])
    raw = tables.read_raw(spark, path, order="position_ord").withColumn("v", F.col("v").cast("double"))
    assert rows(roll_up(raw, ["id"], ["name"], ["v"])) == [("S1", "Zeta", 3.0), ("S2", "Mid", 3.0)]


def test_several_blocks_of_several_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    lines = [f"{i},{'x' * (i % 50)}" for i in range(6000)]
    for k in range(3):  # later files are larger, so tasks read them first
        write_lines(folder / f"part-{k}.csv", "id,name", lines[1000 * k * (k + 1) // 2:1000 * (k + 1) * (k + 2) // 2])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4k", "64k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            raw = tables.read_raw(spark, str(folder))
            got = raw.select("row_ord", "id").collect()
            assert sorted(got) == [(i, str(i)) for i in range(6000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert dict(raw.dtypes)["row_ord"] == "bigint"


def test_csv_parquet_and_a_table_have_the_same_numbers(spark, tmp_path):
    df = spark.range(0, 3000, 1, 5).select(F.col("id").cast("string").alias("id"), F.lit("a.b").alias("dotted. name"))
    df.write.option("header", True).csv(str(tmp_path / "csv"))
    df.write.parquet(str(tmp_path / "parquet"))
    df.createOrReplaceTempView("some_rows")
    want = [(i, str(i)) for i in range(3000)]
    assert rows(tables.read_raw(spark, str(tmp_path / "csv")), "row_ord", "id") == want
    assert rows(tables.read_raw(spark, str(tmp_path / "parquet"), "parquet"), "row_ord", "id") == want
    assert rows(tables.read_raw(spark, "some_rows", "table"), "row_ord", "id") == want
    assert rows(tables.raw_table(df)[0], "row_ord", "id") == want


def test_parts_go_on_counting(spark, tmp_path):
    header = ",".join(fv.TPT_HEADERS)
    line = ",".join(["F{}"] + ["1"] * (len(fv.TPT_HEADERS) - 1))
    paths = [write_lines(tmp_path / f"{k}.csv", header, [line.format(i) if i % 3 else line.format("")[1:] for i in ids])
             for k, ids in enumerate((range(1, 5), range(5, 12)))]
    got = rows(tables.read_tpt(spark, paths), "holding_ord", f"`{tables.TPT_ID}`")
    assert got == [(i - 1, f"F{i}") for i in range(1, 12) if i % 3]  # rows without a fund keep their number to themselves


def test_many_blocks_are_joined_by_shuffle(spark, monkeypatch):
    df = spark.range(0, 200, 1, 7)
    monkeypatch.setattr(numbering, "MOST_BROADCAST", 0)
    numbered, end = numbering.number_rows(df, "n", start=10)
    assert rows(numbered, "n", "id") == [(i + 10, i) for i in range(200)] and end == 210


@pytest.mark.parametrize("n_rows", [0, 1])
def test_empty_and_single(spark, n_rows):
    numbered, end = numbering.number_rows(spark.range(n_rows), "n", start=5)
    assert rows(numbered, "n") == [(5,)] * n_rows and end == 5 + n_rows
