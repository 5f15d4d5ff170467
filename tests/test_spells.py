import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tourledger.operators import spells

SWITCH = "to_cds_full_time"
AS_OF = dt.date(2022, 10, 1)


def merged_rows(df, **kwargs):
    out = spells.merge_tours(df, AS_OF, **kwargs)
    cols = ["full_name", "tour_number", "cds_start_date", "cds_end_date", "duration_days"]
    return sorted(map(tuple, out.select(*cols).collect()), key=repr)


def d(text):
    return dt.date.fromisoformat(text)


def test_chain_merges_into_one_tour(tour_rows):
    df = tour_rows(
        [
            ("a", 1, "2018-01-01", "2018-06-30", SWITCH),
            ("a", 2, "2018-07-01", "2019-06-30", SWITCH),
            ("a", 3, "2019-07-01", "2019-07-31", "other"),
        ]
    )
    assert merged_rows(df) == [("a", 1, d("2018-01-01"), d("2019-07-31"), 577)]


def test_late_chain_merges_back_to_the_first_tour(tour_rows):
    df = tour_rows(
        [
            ("a", 1, "2015-01-01", "2015-01-31", "other"),
            ("a", 2, "2018-07-01", "2019-06-30", SWITCH),
            ("a", 3, "2019-07-01", None, None),
            ("a", 4, "2022-01-01", "2022-01-31", "other"),
        ]
    )
    assert merged_rows(df) == [
        ("a", 1, d("2015-01-01"), None, 2831),
        ("a", 4, d("2022-01-01"), d("2022-01-31"), 31),
    ]


def test_switch_does_not_reach_the_next_person(tour_rows):
    df = tour_rows(
        [
            ("a", 1, "2015-01-01", "2015-01-31", SWITCH),
            ("b", 1, "2018-07-01", "2018-07-31", "other"),
            ("b", 2, "2019-07-01", "2019-07-31", "other"),
        ]
    )
    assert [row[:2] for row in merged_rows(df)] == [("a", 1), ("b", 1), ("b", 2)]


def test_merged_tour_takes_first_source_and_last_discipline(tour_rows):
    df = tour_rows(
        [
            ("a", 1, "2015-01-01", "2015-01-31", SWITCH, "Design", "(default)", "x", "x", "from_here"),
            ("a", 3, "2016-01-01", "2016-01-31", "other", "Policy", "(default)", "x", "x", "from_there"),
        ]
    )
    row = spells.merge_tours(df, AS_OF).first()
    assert (row.initial_arrival_source, row.most_recent_discipline_initial) == ("from_here", "Policy")


def test_null_person_and_repeated_key(tour_rows):
    df = tour_rows(
        [
            (None, 1, "2015-01-01", "2015-01-31", SWITCH),
            (None, 2, "2016-01-01", "2016-01-31", "other"),
            ("a", 1, "2015-01-01", "2015-01-31", "other"),
            ("a", 1, "2015-01-01", "2015-01-31", "other"),
        ]
    )
    assert [row[:2] for row in merged_rows(df)] == [("a", 1), (None, 1)]


def brute_force_merge(tours):
    """Row by row, as one ordered walk over each person."""
    by_person = {}
    for row in sorted(tours, key=lambda r: (r[0], r[1])):
        by_person.setdefault(row[0], []).append(row)
    out = []
    for person, rows in by_person.items():
        groups, previous = {}, None
        for row in rows:
            joins = row[4] == SWITCH or previous == SWITCH
            groups.setdefault(rows[0][1] if joins else row[1], []).append(row)
            previous = row[4]
        for number, group in groups.items():
            end = group[-1][3]
            days = (d(end) if end else AS_OF) - d(group[0][2])
            out.append((person, number, d(group[0][2]), d(end) if end else None, days.days + 1))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tours_per_piece", [1, 3, 2**15])
def test_merge_against_brute_force_whatever_the_piece_size(tour_rows, tours_per_piece):
    rng = random.Random(7)
    tours = []
    for person in range(150):
        # The first person holds a third of all rows.
        size = 400 if person == 0 else rng.randint(1, 9)
        for number in sorted(rng.sample(range(1, 3 * size + 1), size)):
            start = dt.date(2015, 1, 1) + dt.timedelta(days=rng.randint(0, 2000))
            end = None if rng.random() < 0.2 else (start + dt.timedelta(days=rng.randint(0, 700))).isoformat()
            kind = None if end is None else rng.choice([SWITCH, "other", "other"])
            tours.append((f"p{person}", number, start.isoformat(), end, kind))
    assert merged_rows(tour_rows(tours), tours_per_piece=tours_per_piece) == brute_force_merge(tours)


def test_fiscal_years_of_a_spell(tour_rows):
    df = tour_rows(
        [
            ("edge", 1, "2020-03-31", "2020-04-01", "other"),
            ("day", 1, "2020-04-01", "2020-04-01", "other"),
            ("reversed", 1, "2021-06-01", "2019-06-01", "other"),
            ("open", 1, "2021-06-01", None, None),
            ("nodate", 1, None, None, None),
        ]
    )
    years = {}
    for row in spells.expand_fiscal_years(df).collect():
        years.setdefault(row.full_name, []).append(row.fiscal_year)
    assert {k: sorted(v) for k, v in years.items()} == {
        "edge": [2019, 2020],
        "day": [2020],
        "reversed": [2019, 2020, 2021],
        "open": [2021, 2022],
    }


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [
        # Mean 2018.5 rounds to 2018 and 2019.5 to 2020.
        ("2018-05-01", "2019-05-01", {2018: "last", 2019: "last"}),
        ("2019-05-01", "2020-05-01", {2019: "first", 2020: "last"}),
        ("2018-05-01", "2020-05-01", {2018: "first", 2019: "last", 2020: "last"}),
    ],
)
def test_location_changes_at_the_half_even_mean(tour_rows, start, end, expected):
    df = tour_rows([("a", 1, start, end, "other", "Design", "(default)", "first", "last")])
    years = spells.location_for_year(spells.expand_fiscal_years(df)).collect()
    assert {r.fiscal_year: r.location_averaged for r in years} == expected


def test_duration_counts_both_ends(tour_rows):
    df = tour_rows([("a", 1, "2021-01-01", "2021-12-31", "x"), ("b", 1, "2021-01-01", None, None)])
    found = {r.full_name: (r.duration_days, r.duration_years) for r in df.collect()}
    assert found == {"a": (365, 1.0), "b": (None, None)}


@pytest.mark.parametrize(
    ("date", "names"),
    [("2020-01-01", ["day", "open", "past"]), ("2020-02-01", ["open"]), ("2022-10-01", [])],
)
def test_presence(tour_rows, date, names):
    df = tour_rows(
        [
            ("past", 1, "2019-01-01", "2020-02-01", "x"),
            ("day", 1, "2020-01-01", "2020-01-02", "x"),
            ("zero", 1, "2020-01-01", "2020-01-01", "x"),
            ("open", 1, "2019-05-05", None, None),
        ]
    )
    found = spells.present_on(df, d(date), AS_OF)
    assert sorted(r.full_name for r in found.collect()) == names


def test_monthly_series_against_counting_each_month(tour_rows):
    rng = random.Random(3)
    tours = []
    for i in range(200):
        start = dt.date(2019, 6, 1) + dt.timedelta(days=rng.randint(0, 900))
        end = None if rng.random() < 0.3 else start + dt.timedelta(days=rng.randint(-40, 500))
        tours.append((f"p{i}", 1, start.isoformat(), end and end.isoformat(), "x"))
    first, as_of = dt.date(2020, 1, 1), dt.date(2021, 12, 15)
    series = spells.monthly_headcount(tour_rows(tours, as_of), first, as_of).orderBy("month").collect()
    assert len(series) == 24
    counts = []
    for row in series:
        here = sum(
            d(start) <= row.month < (d(end) if end else as_of) for _, _, start, end, _ in tours
        )
        counts.append(here)
        assert row.headcount == here
    assert [r.change_prev_month for r in series] == [a - b for a, b in zip(counts, [0, *counts])]
    assert [r.change_prev_year for r in series] == [a - b for a, b in zip(counts, [0] * 12 + counts)]


def test_empty_months_stay_and_a_zero_base_gives_null(tour_rows):
    df = tour_rows([("a", 1, "2020-03-10", "2020-05-20", "x")])
    series = spells.monthly_headcount(df, dt.date(2020, 1, 1), dt.date(2020, 8, 1)).orderBy("month").collect()
    assert [r.headcount for r in series] == [0, 0, 0, 1, 1, 0, 0, 0]
    assert [r.pct_change_month for r in series] == [None, None, None, None, 0.0, -100.0, None, None]


def test_open_spell_is_not_counted_on_the_run_date(tour_rows):
    df = tour_rows([("a", 1, "2022-08-15", None, None)])
    series = spells.monthly_headcount(df, dt.date(2022, 8, 1), AS_OF).orderBy("month").collect()
    assert [r.headcount for r in series] == [0, 1, 0]


def test_series_slice_and_first_month(tour_rows):
    df = tour_rows([("a", 1, "2020-01-01", None, None, "Policy"), ("b", 1, "2020-01-01", None, None, "Design")])
    where = F.col("discipline_initial") == "Policy"
    series = spells.monthly_headcount(df, dt.date(2020, 1, 1), dt.date(2020, 2, 1), where)
    assert [r.headcount for r in series.orderBy("month").collect()] == [1, 0]
    with pytest.raises(ValueError):
        spells.monthly_headcount(df, dt.date(2020, 1, 2), AS_OF)


def test_spell_problems(tour_rows):
    df = tour_rows(
        [
            ("a", 1, "2020-01-01", "2020-01-01", "x"),
            ("b", 1, "2020-01-02", "2020-01-01", "x"),
            ("c", 1, None, "2020-01-01", "x"),
            ("d", 1, "2020-01-02", None, None),
        ]
    )
    assert tuple(spells.spell_problems(df).first()) == (4, 1, 1)
