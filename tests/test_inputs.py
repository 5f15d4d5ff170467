"""Real files in: quoted text, odd names and types, missing columns, and what a run reports about them."""

import csv
import dataclasses
import datetime as dt

import pytest

from checks import fixtures
from tourledger.operators.progress import latest_attributes, person_progression
from tourledger.plans import quality, reports, run
from tourledger.plans.tables import Tables
from tourledger.sources.schemas import INPUT_SCHEMAS, TENURE
from tourledger.sources.tables import load_table, unparsed_texts

TOURS = [
    ("Ann Lee", 1, 'Design ""UX"", lead', "2020-05-01", None, "onboarded", "one\ntwo, \"three\""),
    ("Bob Ray", 1, "Policy", "2020-06-01", "2021-06-01", "onboarded", None),
    ("Cy Fox", 1, "a\nb", "2019-06-01", "2021-06-01", "onboarded", "x"),
]
COLUMNS = ["full_name", "tour_number", "discipline_initial", "cds_start_date", "cds_end_date", "onboarding_status", "notes"]


def tour_rows():
    place = {name: i for i, name in enumerate(TENURE.names)}
    for tour in TOURS:
        row = [None] * len(place)
        for name, value in zip(COLUMNS, tour):
            row[place[name]] = value
        yield row


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "tours.csv"
    with path.open("w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(TENURE.names)
        writer.writerows(["" if v is None else v for v in row] for row in tour_rows())
    found = load_table(spark, str(path), TENURE).select(COLUMNS).orderBy("full_name").collect()
    date = lambda text: dt.date.fromisoformat(text) if text else None
    assert [tuple(r) for r in found] == [(*t[:3], date(t[3]), date(t[4]), *t[5:]) for t in TOURS]


def test_written_csv_is_read_by_others(spark, make, tmp_path):
    from tourledger.sources.publish import publish

    publish(make("a string, n int", [('say "x", y', 1), ("plain", 2)]), str(tmp_path / "out"), single_file=True)
    part, = (tmp_path / "out").glob("part-*.csv")
    with part.open(newline="") as file:
        assert sorted(csv.reader(file)) == [["a", "n"], ["plain", "2"], ['say "x", y', "1"]]


def test_parquet_names_and_types(spark, tmp_path):
    wide = spark.createDataFrame(list(tour_rows()), ", ".join(f"{n} {'int' if n == 'tour_number' else 'string'}" for n in TENURE.names))
    wide = wide.withColumn("tour_number", wide.tour_number.cast("double")).withColumn("cds_start_date", wide.cds_start_date.cast("timestamp"))
    odd = {"full_name": "Full Name", "tour_number": "Tour Number", "cds_start_date": "CDS Start Date"}
    wide.withColumnsRenamed(odd).write.parquet(str(tmp_path / "tours"))
    found = load_table(spark, str(tmp_path / "tours"), TENURE)
    assert found.columns == TENURE.names
    assert {r.full_name: (r.tour_number, r.cds_start_date) for r in found.collect()} == {t[0]: (1, dt.date.fromisoformat(t[3])) for t in TOURS}


def test_a_missing_column_is_an_error(spark, make, tmp_path):
    make("full_name string", [("x",)]).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="tour_number"):
        load_table(spark, str(tmp_path / "t"), TENURE)


def test_unparsed_texts_are_counted(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("full_name,tour_number,cds_start_date,\"cds_end_date\"\nx,one,2020-13-01,\ny,2.0,2020-01-01,never\n")
    schema = type(TENURE)([f for f in TENURE.fields if f.name in ("full_name", "tour_number", "cds_start_date", "cds_end_date")])
    found = dict(map(tuple, unparsed_texts(spark, str(path), schema).collect()))
    assert found == {"full_name": 0, "tour_number": 1, "cds_start_date": 1, "cds_end_date": 1}


@pytest.fixture
def inputs(spark, sf_dir):
    return fixtures.inputs(spark, sf_dir)


def test_strict_run_fails_on_repeated_keys(inputs, tmp_path):
    twice = dataclasses.replace(inputs, name_harmonization=inputs.name_harmonization.union(inputs.name_harmonization.limit(1)))
    found = {r.check_name: r.problems for r in quality.quality_report(Tables(twice)).collect()}
    assert found["repeated keys in aliases"] == 1
    with pytest.raises(ValueError, match="repeated keys in aliases: 1"):
        run.publish_all(twice, str(tmp_path / "out"), str(tmp_path / "shared"), strict=True)


def test_rows_repeated_in_lookups_change_nothing(inputs):
    tables = Tables(inputs)
    args = [inputs.name_harmonization, tables.roster, tables.pay_medians]
    once = person_progression(latest_attributes(tables.persons), tables.merged, *args)
    again = person_progression(latest_attributes(tables.persons), tables.merged, *[df.union(df) for df in args[:2]], args[2])
    assert once.count() == again.count() and once.exceptAll(again).isEmpty()


def test_outside_government_is_an_input(inputs):
    other = dataclasses.replace(inputs, outside_government=("from_academia",))
    found = reports.departure_type_joined_from_outside_government(Tables(other))
    tours = Tables(inputs).departures.where("arrival_source = 'from_academia'")
    assert found.first().total_count == tours.count() > 0


def test_a_run_from_files_leaves_no_shared_tables(spark, inputs, tmp_path, monkeypatch):
    args = []
    for name in INPUT_SCHEMAS:
        getattr(inputs, name).write.parquet(str(tmp_path / name))
        args += [f"--{name.replace('_', '-')}", str(tmp_path / name)]
    monkeypatch.setattr(run, "shared_folder", lambda spark: str(tmp_path / "shared"))
    run.main([*args, "--as-of", inputs.as_of.isoformat(), "--out", str(tmp_path / "out")])
    assert not (tmp_path / "shared").exists()
    checks = spark.read.option("header", True).csv(str(tmp_path / "out" / "quality"))
    assert checks.where("check_name like 'texts not parsed in tenure_raw.%'").count() == len(INPUT_SCHEMAS["tenure_raw"])
