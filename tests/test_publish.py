"""Reports as they are published: names, columns, formats and arithmetic identities."""

import csv
import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType, TimestampNTZType

from tourledger.plans import reports
from tourledger.plans.run import main, publish_all, shared_folder
from tourledger.sources.board import import_board_cards
from tourledger.sources.publish import publish, publishable
from tourledger.sources.schemas import BOARD_CARDS
from tourledger.sources.tables import load_table

# Report columns in their published order.
HEADERS = {
    "quality": "check_name,problems",
    "arrivals": "total_onboarded",
    "arrivals_by_discipline": "discipline_initial,arrivals_by_discipline_count,total_count,percentage",
    "arrivals_by_fiscal_year": "cds_start_fiscal_year,arrivals",
    "arrivals_by_source": "arrival_source,onboarded_count,total_count,percentage",
    "classification_promotion": "has_promotion_count,total_count,percentage",
    "classification_promotion_by_discipline_initial": "discipline_initial,has_promotion_count,total_count,percentage",
    "classification_promotion_by_duration_years_bins": "duration_years_bins,has_promotion_count,total_count,percentage",
    "classification_promotion_by_in_or_out_of_ncr": "in_or_out_of_national_capital_region,has_promotion_count,total_count,percentage",
    "classification_promotion_by_latest_group": "latest_group,has_promotion_count,total_count,percentage",
    "classification_promotion_excluding_students": "has_promotion_count,total_count,percentage",
    "classification_promotion_excluding_students_by_discipline_initial": "discipline_initial,has_promotion_count,total_count,percentage",
    "classification_promotion_excluding_students_by_in_or_out_of_ncr": "in_or_out_of_national_capital_region,has_promotion_count,total_count,percentage",
    "classification_promotion_excluding_students_by_latest_group": "latest_group,has_promotion_count,total_count,percentage",
    "departure_type": "departure_type,departure_count,total_count,departure_type_percentage,departure_type_combined",
    "departure_type_by_arrival_source": "arrival_source,departure_type,departure_count,total_count,departure_type_percentage",
    "departure_type_by_discipline": "discipline_initial,departure_type,departure_count,total_count,departure_type_percentage",
    "departure_type_joined_from_outside_government": "departure_type,departure_count,total_count,departure_type_percentage",
    "departures": "total_departed",
    "departures_by_fiscal_year": "cds_end_fiscal_year,departures",
    "departures_excluding_students": "total_departed",
    "discipline_count_by_fiscal_year": "fiscal_year,discipline_initial,discipline_count",
    "duration_average": "average_duration_years",
    "duration_average_by_arrival_source": "initial_arrival_source,average_duration_years,arrivals_count",
    "duration_average_by_discipline": "most_recent_discipline_initial,average_duration_years,arrivals_count",
    "duration_quantiles": "duration_years,q",
    "headcount_by_discipline": "discipline_initial,count_by_discipline,total_count,percentage",
    "headcount_by_fiscal_year": "fiscal_year,headcount",
    "headcount_current": "headcount_current",
    "headcount_individual_staff": "total_individual_staff",
    "headcount_joined_within_past_12_months": "headcount_joined_within_past_12_months,headcount_current,percentage",
    "location_changed_while_at_cds": "location_changed_at_cds,count",
    "location_in_out_ncr_by_fiscal_year": "fiscal_year,in_or_out_of_national_capital_region,location_in_out_count,total_staff_count,location_percentage",
    "multiple_tours_by_discipline": "discipline_initial,multiple_tours_by_discipline_count",
    "multiple_tours_by_initial_staffing_program": "initial_staffing_program,multiple_tours_by_initial_staffing_program_count",
    "multiple_tours_students_tour_number": "highest_tour_number,students_count",
    "new_hire_turnover_under_1_year": "departed_under_1_year,departure_count,total_onboarded,departure_percentage",
    "new_hire_turnover_under_1_year_by_discipline": "discipline_initial,departed_under_1_year_count,total_departure_count,arrivals_by_discipline_count,departed_under_1_year_percentage",
    "summary_arrivals_departures_headcount_by_fiscal_year": "fiscal_year,arrivals,departures,new_hires_percentage,replacement_hires_percentage,headcount_arrivals,headcount_adjusted,location_outside_ncr_percentage,headcount_lagged_average,turnover_rate_percentage",
    "summary_departure_type_by_arrival_source_percentages": "arrival_source,to_academia,to_non_profit,to_other_department,to_other_government,to_private_sector,unknown_departure_type,retired",
    "summary_departure_type_by_discipline_percentages": "discipline_initial,to_other_department,to_other_government,to_private_sector,to_non_profit,to_academia,unknown_departure_type,retired",
    "tenure_average": "average_tenure_years",
    "tenure_headcount_bins": "duration_years_bins,headcount",
}


def read_csv(folder):
    parts = sorted(Path(folder).glob("part-*.csv"))
    rows = []
    for part in parts:
        with part.open(newline="") as file:
            found = list(csv.reader(file))
        rows += found if not rows else found[1:]
    return rows


@pytest.fixture(scope="module")
def published(spark, tables, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    publish_all(tables.inputs, str(out), str(tmp_path_factory.mktemp("shared") / "run"))
    return reports_in(out)


def reports_in(folder):
    """Reports are folders; the manifest beside them is a file."""
    return {path.name: read_csv(path) for path in folder.iterdir() if path.is_dir()}


def test_every_report_is_published_with_its_columns(published):
    assert {name: ",".join(rows[0]) for name, rows in published.items()} == HEADERS
    assert {*reports.REPORTS, "quality"} == set(HEADERS)


def column(rows, name, kind=int):
    at = rows[0].index(name)
    return [kind(row[at]) for row in rows[1:]]


@pytest.mark.parametrize(
    ("report", "count", "total"),
    [
        ("arrivals_by_source", "onboarded_count", "total_count"),
        ("arrivals_by_discipline", "arrivals_by_discipline_count", "total_count"),
        ("headcount_by_discipline", "count_by_discipline", "total_count"),
        ("departure_type", "departure_count", "total_count"),
        ("departure_type_joined_from_outside_government", "departure_count", "total_count"),
    ],
)
def test_categories_sum_to_the_stated_total(published, report, count, total):
    rows = published[report]
    assert set(column(rows, total)) == {sum(column(rows, count))}


def single(published, report, name):
    return column(published[report], name)[0]


def test_totals_agree_between_reports(published):
    people = single(published, "headcount_individual_staff", "total_individual_staff")
    departed = single(published, "departures_excluding_students", "total_departed")
    turnover = published["new_hire_turnover_under_1_year"]
    early = published["new_hire_turnover_under_1_year_by_discipline"]
    assert sum(column(published["location_changed_while_at_cds"], "count")) == people
    assert sum(column(turnover, "departure_count")) == departed
    assert sum(column(early, "departed_under_1_year_count")) == column(turnover, "departure_count")[1]
    assert set(column(published["arrivals_by_source"], "total_count")) == {
        single(published, "arrivals", "total_onboarded")
    }
    assert set(column(published["headcount_by_discipline"], "total_count")) == {
        single(published, "headcount_current", "headcount_current")
    }
    assert set(column(published["departure_type"], "total_count")) == {departed}


@pytest.mark.parametrize("students", ["", "excluding_students_"])
@pytest.mark.parametrize("by", ["discipline_initial", "in_or_out_of_ncr"])
def test_promotions_split_into_the_overall_total(published, students, by):
    overall = published[f"classification_promotion_{students}".rstrip("_")]
    split = published[f"classification_promotion_{students}by_{by}"]
    for name in ("has_promotion_count", "total_count"):
        assert sum(column(split, name)) == column(overall, name)[0]


def test_years_agree_between_reports(published):
    headcount = dict(zip(*(column(published["headcount_by_fiscal_year"], c) for c in ("fiscal_year", "headcount"))))
    regions, disciplines = {}, {}
    for year, n in zip(
        *(column(published["location_in_out_ncr_by_fiscal_year"], c) for c in ("fiscal_year", "location_in_out_count"))
    ):
        regions[year] = regions.get(year, 0) + n
    for year, n in zip(
        *(column(published["discipline_count_by_fiscal_year"], c) for c in ("fiscal_year", "discipline_count"))
    ):
        disciplines[year] = disciplines.get(year, 0) + n
    assert regions == headcount
    assert all(disciplines[year] >= n for year, n in headcount.items())
    summary = published["summary_arrivals_departures_headcount_by_fiscal_year"]
    arrivals = published["arrivals_by_fiscal_year"]
    assert column(summary, "fiscal_year") == column(arrivals, "cds_start_fiscal_year")
    assert column(summary, "arrivals") == column(arrivals, "arrivals")
    assert column(summary, "headcount_arrivals") == [headcount[y] for y in column(summary, "fiscal_year")]


def test_most_frequent_first_and_years_in_order(published):
    counts = column(published["arrivals_by_source"], "onboarded_count")
    assert counts == sorted(counts, reverse=True)
    years = column(published["headcount_by_fiscal_year"], "fiscal_year")
    assert years == sorted(years)


def test_a_run_from_files_gives_the_same_reports(spark, tables, published, tmp_path, monkeypatch):
    monkeypatch.setattr("tourledger.plans.run.shared_folder", lambda _: str(tmp_path / "shared"))
    given, arguments = tables.inputs, []
    for name in ("tenure_raw", "level_raw", "name_harmonization", "pay_rates"):
        path = str(tmp_path / f"{name}.csv")
        getattr(given, name).write.option("header", True).csv(path)
        arguments += [f"--{name.replace('_', '-')}", path]
    out, series = tmp_path / "out", tmp_path / "series"
    arguments += ["--out", str(out), "--series-out", str(series), "--home", given.home]
    arguments += ["--as-of", given.as_of.isoformat(), "--first-month", given.first_month.isoformat()]
    main([*arguments, "--slice-discipline", given.slice_discipline])
    found = reports_in(out)
    checks = found.pop("quality")  # which also counts, per column, texts that did not parse
    assert [row for row in checks if not row[0].startswith("texts not parsed")] == published["quality"]
    assert found == {name: rows for name, rows in published.items() if name != "quality"}
    assert set(reports_in(series)) == set(reports.SERIES)
    assert column(read_csv(series / "headcount_by_month"), "headcount")[0] > 0


def test_publishing_formats(make):
    df = make(
        "full_name string, notes string, Average_Years double, grand_total int, share_percentage double, n bigint, end_value string",
        [("a", "b", 2.225, 3, 0.12345678, 7, "x"), ("c", "d", None, None, None, None, None)],
    )
    out = publishable(df)
    assert out.columns == ["Average_Years", "grand_total", "share_percentage", "n", "end_value"]
    assert [tuple(r) for r in out.collect()] == [("2.22", "3.00", 0.1235, 7, "x"), (None, None, None, None, None)]


def test_publish_returns_its_input_unrounded(make, tmp_path):
    df = make("average_years double, label string", [(1.005, None)])
    assert publish(df, str(tmp_path / "r"), single_file=True) is df
    assert read_csv(tmp_path / "r") == [["average_years", "label"], ["1.00", ""]]


def test_shared_folder_is_the_one_the_session_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(base) and first != second


def test_stored_tours_leave_out_the_notes(stored, tables):
    assert set(tables.tours.columns) - set(stored.tours.columns) == {"notes"}


def test_load_csv_and_parquet(spark, tmp_path):
    text = "Full Name,Start Date,n\nJane Doe,2020-01-31,1\nRich Roe,1900-01-00,\n"
    (tmp_path / "t.csv").write_text(text)
    schema = StructType([StructField(n, StringType()) for n in ("Full Name", "Start Date", "n")])
    df = load_table(spark, str(tmp_path / "t.csv"), schema)
    assert df.columns == ["full_name", "start_date", "n"]
    assert [tuple(r) for r in df.collect()] == [
        ("Jane Doe", dt.date(2020, 1, 31), "1"),
        ("Rich Roe", None, None),
    ]
    kept = load_table(spark, str(tmp_path / "t.csv"), schema, dates=False)
    assert kept.collect()[1].start_date == "1900-01-00"

    (tmp_path / "other.csv").write_text("extra,Start Date,Tour Number,Full Name\nx,2020-01-31,2.0,A\ny,,two,B\n")
    fields = [("full_name", StringType()), ("tour_number", IntegerType()), ("start_date", DateType())]
    typed = load_table(spark, str(tmp_path / "other.csv"), StructType([StructField(*f) for f in fields]))
    assert [tuple(r) for r in typed.collect()] == [("A", 2, dt.date(2020, 1, 31)), ("B", None, None)]

    stamped = spark.sql("SELECT TIMESTAMP_NTZ'2020-05-06 07:08:09' AS `Due Date`")
    stamped.write.parquet(str(tmp_path / "p"))
    schema = StructType([StructField("Due Date", TimestampNTZType())])
    loaded = load_table(spark, str(tmp_path / "p"), schema)
    assert loaded.schema["due_date"].dataType == DateType()
    assert loaded.first()[0] == dt.date(2020, 5, 6)


CARDS = "card_name string, due_date string, last_activity_date string, list_name string"


def test_board_cards(make, tmp_path):
    cards = make(
        CARDS,
        [
            ("Jane Doe - Senior - Designer", "2022-01-02T10:00:00Z", "2022-01-03", "Pre-First Day"),
            ("  Rich Roe ", None, "2022-01-01", "Start Date CONFIRMED"),
            ("Template card", "2022-01-02", "2022-01-03", "Pre-First Day"),
            ("PLACEHOLDER - x", "2022-01-02", "2022-01-03", "Pre-First Day"),
            ("Ann Poe - Dev", "soon", None, None),
            (None, "2022-01-02", "2022-01-03", "Done"),
        ],
    )
    out = import_board_cards(cards, dt.date(2022, 9, 20), str(tmp_path))
    found = out.select("full_name", "role", "cds_start_date", "onboarding_status").collect()
    assert [tuple(r) for r in found] == [
        ("Jane Doe", "Senior - Designer", dt.date(2022, 1, 2), "incoming"),
        ("Rich Roe", None, None, "start_date_confirmed"),
        ("Ann Poe", "Dev", None, "onboarded"),
    ]
    written = read_csv(tmp_path / "2022-09-20-tenure-data")
    assert written[0] == out.columns
    assert [row[0] for row in written[1:]] == ["Rich Roe", "Jane Doe", "Ann Poe"]
    with pytest.raises(ValueError):
        import_board_cards(cards, out=str(tmp_path))


def test_board_cards_from_a_file(spark, tmp_path):
    lines = ["Card Name,Labels,Due Date,List Name,Last Activity Date", "Jane Doe - Dev,x,2022-01-02,Done,2022-01-03"]
    (tmp_path / "cards.csv").write_text("\n".join(lines))
    out = import_board_cards(load_table(spark, str(tmp_path / "cards.csv"), BOARD_CARDS))
    row = out.first()
    assert (row.full_name, row.role, row.cds_start_date) == ("Jane Doe", "Dev", dt.date(2022, 1, 2))
