"""CSV files that many tasks read, types that values allow, and the order of the input."""

import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tourledger.sources.board import import_board_cards
from tourledger.sources.inference import load_inferred, type_report
from tourledger.sources.schemas import BOARD_CARDS
from tourledger.sources.tables import INPUT_ORDER, load_table, read_raw, spans_lines


@pytest.fixture
def small_splits(spark):
    """Files are read in parts of some hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    for name, value in zip(names, ("700", "0")):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def write_csv(path, rows):
    with path.open("w", newline="") as file:
        csv.writer(file).writerows(rows)
    return str(path)


def test_csv_is_split_between_tasks(spark, tmp_path, small_splits):
    rows = [("id", "text")] + [(k, f'say "{k}", or so') for k in range(500)]
    path = write_csv(tmp_path / "t.csv", rows)
    assert not spans_lines(spark, path)
    df = read_raw(spark, path)
    assert df.rdd.getNumPartitions() > 5
    assert sorted((int(r.id), r.text) for r in df.collect()) == rows[1:]


def test_csv_with_line_breaks_is_not(spark, tmp_path, small_splits):
    rows = [("id", "text")] + [(k, f'one "{k}"\ntwo' if k % 50 == 7 else "x") for k in range(300)]
    path = write_csv(tmp_path / "t.csv", rows)
    assert spans_lines(spark, path)
    df = read_raw(spark, path)
    assert df.rdd.getNumPartitions() == 1
    assert sorted((int(r.id), r.text) for r in df.collect()) == rows[1:]
    assert read_raw(spark, path, multi_line=False).rdd.getNumPartitions() > 1  # as told


def test_empty_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    assert not spans_lines(spark, str(tmp_path / "t.csv"))
    assert load_inferred(spark, str(tmp_path / "t.csv")).dtypes == [("a", "string"), ("b", "string")]


VALUES = {
    "flag": (["true", "False", None], "boolean"),
    "small": (["1", "-2147483648", "+7"], "int"),
    "large": (["1", "2147483648", None], "bigint"),
    "number": (["1", "2.5", "-1e3"], "double"),
    "huge": (["9223372036854775808", "1", "2"], "double"),
    "day": (["2020-02-29", "1999-12-31", None], "date"),
    "moment": (["2020-02-29", "2020-02-29 10:11:12", "2020-02-29T10:11:12.5"], "timestamp_ntz"),
    "sentinel": (["1900-01-00", "2020-01-01", "2020-01-02"], "string"),
    "padded": ([" 1", "2", "3"], "string"),
    "nothing": ([None, None, None], "string"),
    "blank": (["", "1", "2"], "string"),
    "dotted": ([".", "1", "2"], "string"),
}


def test_the_narrowest_type_that_all_values_are(spark):
    rows = list(zip(*(values for values, _ in VALUES.values())))
    df = spark.createDataFrame(rows, ", ".join(f"`{name}` string" for name in VALUES)).repartition(2)
    report = {r.column_name: r for r in type_report(df).collect()}
    assert {name: r.inferred_type for name, r in report.items()} == {name: kind for name, (_, kind) in VALUES.items()}
    assert (report["sentinel"].not_date, report["sentinel"].n_values) == (1, 3)
    assert (report["large"].not_int, report["large"].not_bigint, report["large"].n_nulls) == (1, 0, 1)
    plan = type_report(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_inferred_types_are_read(spark, tmp_path):
    path = write_csv(tmp_path / "t.csv", [("Full Name", "Start Date", "n", "x y"), ("a", "2020-01-31", "1", "1.5"), ("b", "", "2", "2")])
    df = load_inferred(spark, path)
    assert df.dtypes == [("full_name", "string"), ("start_date", "date"), ("n", "int"), ("x_y", "double")]
    assert sorted(map(tuple, df.collect())) == [("a", dt.date(2020, 1, 31), 1, 1.5), ("b", None, 2, 2.0)]
    df.write.parquet(str(tmp_path / "p"))
    assert load_inferred(spark, str(tmp_path / "p")).dtypes == df.dtypes
    with pytest.raises(ValueError, match="columns"):
        type_report(spark.createDataFrame([(1,)], "a int").select())


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_input_order_survives_shuffles_and_splits(spark, tmp_path, small_splits, fmt):
    folder = tmp_path / f"t.{fmt}"
    for part in range(3):
        df = spark.range(part * 200, part * 200 + 200, 1, 1).select(F.col("id").cast("string"), (F.col("id") * 7919 % 13).cast("string").alias("k"))
        df.write.mode("append").format(fmt).option("header", True).save(str(folder))
    files = sorted((p for p in folder.iterdir() if p.name.startswith("part")), key=lambda p: p.name)
    by_file = [[r.id for r in spark.read.option("header", True).format(fmt).load(str(p)).collect()] for p in files]
    df = read_raw(spark, str(folder), fmt=fmt, order=True)
    for n in (1, 7):
        found = df.repartition(n, "k").orderBy(INPUT_ORDER).collect()
        assert [r.id for r in found] == [i for ids in by_file for i in ids]


def test_dated_export_is_the_same_on_any_number_of_partitions(spark, tmp_path, small_splits):
    """Forty cards a day, whose order within the day only the file tells."""
    rows = [("Card Name", "Due Date", "Last Activity Date", "List Name")]
    rows += [(f"Person {k * 37 % 400} - Role", "2022-01-02", f"2022-01-{k % 10 + 1:02}", "Done") for k in range(400)]
    path = write_csv(tmp_path / "cards.csv", rows)
    texts = set()
    for n in (1, 3, 8):
        cards = load_table(spark, path, BOARD_CARDS, dates=False, order=True).repartition(n, "card_name")
        out = tmp_path / f"out{n}"
        tours = import_board_cards(cards, dt.date(2022, 9, 20), str(out))
        assert INPUT_ORDER not in tours.columns
        parts = sorted((out / "2022-09-20-tenure-data").glob("part-*.csv"))
        texts.add("".join("".join(p.open().readlines()[1:]) for p in parts))
    text, = texts
    names = [line.split(",")[0] for line in text.splitlines()]
    expected = sorted(rows[1:], key=lambda r: r[2])  # stable: the file's order within a day
    assert names == [r[0].split(" - ")[0] for r in expected]
