"""Operators on small tables, where the expected numbers can be read off."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tourledger import names
from tourledger.operators import people, progress, shares
from tourledger.operators.spells import expand_fiscal_years, location_for_year
from tourledger.operators.summary import fiscal_summary

AS_OF = dt.date(2022, 10, 1)


def ordered(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    ("years", "label"),
    [
        (0.0, None),
        (-1.0, None),
        (1.0, "Under 1 year"),
        (1.01, "1-2 years"),
        (2.0, "1-2 years"),
        (3.0, "2-3 years"),
        (30.0, "3+ years"),
        (None, None),
    ],
)
def test_bins_are_closed_on_the_right(make, years, label):
    assert make("y double", [(years,)]).select(shares.duration_bin(F.col("y"))).first()[0] == label


def test_bins_in_order(make):
    df = make("duration_years double", [(5.0,), (0.5,), (1.5,), (0.1,), (None,)])
    assert ordered(shares.count_by_bin(df)) == [("Under 1 year", 2), ("1-2 years", 1), ("3+ years", 1), (None, 1)]


def test_exactly_one_year_is_not_early_turnover(tour_rows):
    df = tour_rows([("a", 1, "2021-01-01", "2021-12-31", "x"), ("b", 1, "2021-01-01", "2021-12-30", "x")])
    arrivals = shares.count_distinct_rows(df, ["full_name", "tour_number"], "total_onboarded")
    out = people.early_turnover(people.departure_counts(people.departures_excluding(df)), arrivals)
    assert ordered(out) == [(0, 1, 2, 0.5), (1, 1, 2, 0.5)]


def test_turnover_by_discipline_uses_arrivals_as_denominator(tour_rows):
    df = tour_rows(
        [
            ("a", 1, "2021-01-01", "2021-02-01", "x", "Design"),
            ("b", 1, "2021-01-01", "2022-02-01", "x", "Design"),
            ("c", 1, "2021-01-01", None, None, "Design"),
            ("d", 1, "2021-01-01", "2022-02-01", "x", "Policy"),
            ("e", 1, "2021-01-01", "2021-02-01", "x", "Design", "student"),
        ]
    )
    pairs = df.select("full_name", "discipline_initial").distinct()
    arrivals = shares.category_share(pairs, "discipline_initial", "arrivals_by_discipline_count", digits=4)
    out = people.early_turnover_by_discipline(people.departure_counts(people.departures_excluding(df)), arrivals)
    assert ordered(out) == [("Design", 1, 2, 4, 0.25)]


def test_histogram_bins(make):
    df = make("x double", [(0.25,), (0.26,), (0.75,), (0.76,)])
    assert ordered(shares.histogram(df, "x", 0.5)) == [(0.0, 1), (0.5, 2), (1.0, 1)]


def test_quantiles(make):
    df = make("duration_years double", [(1.0,), (2.0,), (4.0,), (8.0,)])
    assert ordered(people.duration_quantiles(df)) == [(1.0, 0.0), (1.75, 0.25), (3.0, 0.5), (5.0, 0.75), (8.0, 1.0)]


def test_unsure_sources_count_as_unknown(make):
    df = make("s string", [("?x",), (None,), ("from_a",), ("",)])
    found = df.select(shares.known_category(F.col("s"))).collect()
    assert [r[0] for r in found] == ["unknown_arrival_source", "unknown_arrival_source", "from_a", ""]


def test_category_share_orders_ties_by_name(make):
    df = make("k string", [("b",), ("a",), ("c",), ("c",)])
    out = shares.category_share(df, "k", "n", combined="text")
    assert ordered(out) == [("c", 2, 4, 0.5, "50% (2)"), ("a", 1, 4, 0.25, "25% (1)"), ("b", 1, 4, 0.25, "25% (1)")]


def test_pivot_finds_columns_by_itself(make):
    df = make("o string, i string", [("x", "p")] * 2 + [("x", "q"), ("y", "new"), (None, "p")])
    within = shares.share_within(df, "o", "i", "n", "share")
    fixed = shares.share_pivot(within, "o", "i", "n", "share", ["q", "p"], drop="y")
    assert fixed.columns == ["o", "q", "p", "new"]
    assert ordered(fixed) == [("x", "33% (1)", "67% (2)", "0%")]
    found = shares.share_pivot(within, "o", "i", "n", "share")
    assert found.columns == ["o", "new", "p", "q"]
    assert ordered(found)[-1] == (None, "0%", "100% (1)", "0%")


def test_pivot_keeps_every_value(make):
    """Cells of a row add up to the row's total, also with values that no list knows."""
    rows = [("x", "to_other_department")] * 3 + [("x", "retired")] * 2 + [("x", "to_moon")] * 4 + [("y", "retired")]
    within = shares.share_within(make("o string, i string", rows), "o", "i", "n", "share")
    wide = shares.share_pivot(within, "o", "i", "n", "share", names.DEPARTURE_TYPES)
    assert wide.columns == ["o", *names.DEPARTURE_TYPES, "to_moon", "retired"]
    totals = {row[0]: sum(int(cell.partition("(")[2].rstrip(")") or 0) for cell in row[1:]) for row in wide.collect()}
    assert totals == {"x": 9, "y": 1}


def test_distinct_rows_with_nulls_count(make):
    df = make("a string, b string", [("x", None), ("x", None), ("x", "y"), (None, None)])
    assert shares.count_distinct_rows(df, ["a", "b"], "n").first()[0] == 3


def test_labels(make):
    df = make("s string", [("from_academia",), (None,), ("?what",)])
    out = shares.apply_labels(df, "s", {"from_academia": "Academia", "other": "Unknown"}, default="other")
    assert [r[0] for r in out.collect()] == ["Academia", "Unknown", None]


def test_latest_and_earliest_keep_null_values(make):
    df = make("k string, o int, v string", [("a", 1, "x"), ("a", 2, None), ("a", None, "lost"), ("b", 1, None)])
    assert sorted(ordered(people.latest_by(df, "k", "o", {"v": "last"}))) == [("a", None), ("b", None)]
    assert sorted(ordered(people.earliest_by(df, "k", "o", {"v": "first"})), key=repr) == [("a", "x"), ("b", None)]


def test_current_headcount(tour_rows):
    df = tour_rows(
        [
            ("a", 1, "2015-01-01", "2016-01-01", "x"),
            ("a", 2, "2021-10-01", None, None),
            ("b", 1, "2021-09-30", None, None),
            ("c", 1, "2022-01-01", "2022-02-01", "x"),
        ]
    )
    assert ordered(people.current_headcount(people.person_facts(df), AS_OF)) == [(1, 2, 0.5)]


def test_academia_is_not_outside_government():
    from tourledger import names as N

    assert "from_academia" not in N.OUTSIDE_GOVERNMENT_SOURCES


def test_moves_ignore_unknown_locations(tour_rows):
    df = tour_rows(
        [
            ("a", 1, "2020-01-01", "2020-02-01", "x", "Design", "(default)", "p", "q"),
            ("a", 2, "2021-01-01", None, None, "Design", "(default)", "q", "p"),
            ("b", 1, "2021-01-01", None, None, "Design", "(default)", "p", "q"),
            ("c", 1, "2021-01-01", None, None, "Design", "(default)", None, "q"),
        ]
    )
    assert ordered(people.moved_flag_counts(people.person_facts(df))) == [(0, 2), (1, 1)]


def test_fiscal_summary_skips_years_without_arrivals(tour_rows):
    df = tour_rows(
        [
            ("a", 1, "2016-05-01", "2018-05-01", "x", "Design", "(default)", "Home", "Home"),
            ("b", 1, "2018-05-01", "2018-06-01", "x", "Design", "(default)", "Away", "Away"),
            ("c", 1, "2018-05-01", "2019-06-01", "x", "Design", "(default)", "Home", "Home"),
            ("d", 1, "2019-05-01", "2020-05-01", "x", "Design", "(default)", None, None),
        ]
    )
    years = location_for_year(expand_fiscal_years(df))
    assert ordered(fiscal_summary(people.person_years(years, "Home"))) == [
        (2016, 1, None, None, None, 1, None, None, None, None),
        (2018, 2, 2, 0.0, 1.0, 3, 1, 0.3333, None, None),
        (2019, 1, 1, 0.0, 1.0, 2, 1, 0.5, 1.0, 1.0),
    ]


def test_promotion_flags_and_totals(tour_rows, make):
    tours = tour_rows([(n, 1, "2020-01-01", None, None) for n in ("up", "same", "nogrades", "student", "nopay")])
    merged = make("full_name string, tour_number int, duration_days int, duration_years double", [("up", 1, 365, 1.0)])
    aliases = make("tenure_data_full_name string, level_data_full_name string", [])
    roster = make(
        "full_name_uc string, earliest_date date, latest_date date, earliest_group_level string, latest_group_level string",
        [
            ("UP", None, None, "CS-1", "IT-2"),
            ("SAME", None, None, "IT-2", "IT-2"),
            ("STUDENT", None, None, "SU-1", "IT-1"),
            ("NOPAY", None, None, None, "ZZ-1"),
            ("NOPAY", None, None, None, "ZZ-1"),
        ],
    )
    pay = make("group string, level int, median double", [("IT", 1, 10.0), ("IT", 2, 20.0), ("SU", 3, 5.0)])
    people_df = progress.person_progression(progress.latest_attributes(people.person_facts(tours)), merged, aliases, roster, pay)
    flags = {
        r.full_name: (r.has_promotion, r.has_classification_change, r.has_level_increase, r.duration_years)
        for r in people_df.collect()
    }
    assert flags == {
        "up": (True, False, True, 1.0),
        "same": (False, False, False, None),
        "student": (True, True, False, None),
        "nopay": (False, False, False, None),
    }
    assert ordered(progress.promotion_totals(people_df)) == [(2, 4, 0.5)]
    by_group = progress.promotion_totals(people_df, "latest_group", nonzero=True)
    assert ordered(by_group) == [("IT", 2, 3, 2 / 3)]
    assert ordered(progress.promotion_totals(progress.not_from_group(people_df))) == [(1, 2, 0.5)]


def test_breakdowns_agree_with_single_reports(make):
    df = make(
        "a string, b string, has_promotion boolean",
        [("x", "p", True), ("x", None, False), (None, "p", True), ("y", "q", False)],
    )
    every = {(r.breakdown, r.category): (r.has_promotion_count, r.total_count) for r in progress.promotion_breakdowns(df, ["a", "b"]).collect()}
    expected = {("overall", None): (2, 4)}
    for key in ("a", "b"):
        for row in progress.promotion_totals(df, key).collect():
            expected[(key, row[key])] = (row.has_promotion_count, row.total_count)
    assert every == expected
