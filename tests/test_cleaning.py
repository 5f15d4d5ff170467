import datetime as dt
import random
import statistics

import pytest

from tourledger.operators import cleaning, salary


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


ROSTER = "name string, earliest_date string, latest_date string, earliest_group_level string, latest_group_level string"


def test_roster(make):
    roster = cleaning.clean_roster(
        make(
            ROSTER,
            [
                ("DOE,Jane", "2020-01-01", "1900-01-00", "CS-1", "CS-2"),
                ("Roe, Rich", "2020-01-01", "2021-01-01", "CS-1", "CS-2"),
                ("Sentinel,Sam", "1900-01-00", "2021-01-01", "CS-1", "CS-2"),
                ("Global Forecast", "2020-01-01", "2021-01-01", "XX-1", "XX-1"),
                ("Bad,Date", "someday", "2021-01-01", "CS-1", "CS-2"),
                (None, "2020-01-01", "2021-01-01", "CS-1", "CS-2"),
            ],
        )
    )
    assert rows(roster, "full_name_uc", "latest_date") == [
        (" RICH ROE", dt.date(2021, 1, 1)),
        ("JANE DOE", None),
    ]


def test_aliases_fall_back_to_the_own_name(make):
    tours = make("full_name string, tour_number int", [("Jane Doe", 1), ("Jane Doe", 2), ("Bob Poe", 1), ("No Body", 1)])
    aliases = make("tenure_data_full_name string, level_data_full_name string", [("BOB POE", "ROBERT POE")])
    roster = make(
        "full_name_uc string, earliest_date date, latest_date date, latest_group_level string",
        [("JANE DOE", None, None, "IT-2"), ("ROBERT POE", None, None, "IT-3"), ("BOB POE", None, None, "XX-9")],
    )
    joined = cleaning.join_with_aliases(tours, aliases, roster)
    assert joined.columns == ["full_name", "tour_number", "latest_group_level"]
    assert rows(joined, "full_name", "tour_number", "latest_group_level") == [
        ("Bob Poe", 1, "IT-3"),
        ("Jane Doe", 1, "IT-2"),
        ("Jane Doe", 2, "IT-2"),
        ("No Body", 1, None),
    ]


def test_repeated_lookup_keys_fan_out_and_are_reported(make):
    tours = make("full_name string", [("A B",)])
    aliases = make("tenure_data_full_name string, level_data_full_name string", [])
    roster = make(
        "full_name_uc string, earliest_date date, latest_date date, latest_group_level string",
        [("A B", None, None, "IT-1"), ("A B", None, None, "IT-2")],
    )
    assert cleaning.join_with_aliases(tours, aliases, roster).count() == 2
    assert rows(cleaning.duplicate_keys(roster, ["full_name_uc"]), "full_name_uc", "row_count") == [("A B", 2)]


def test_name_mismatches(make):
    a = make("full_name_uc string", [("X",), ("X",), ("Y",), (None,)])
    b = make("full_name_uc string", [("Y",), ("Z",), (None,)])
    assert rows(cleaning.name_mismatches(a, b), "full_name_uc", "missing_from") == [("X", "b"), ("Z", "a")]


def test_pay_labels(make):
    labels = ["IT-02", "DA-PRO-2", "PI-1-CGC", "CS-1", "STUDENT-03", "EX", "AS-000", "A-B-3-4"]
    pay = cleaning.parse_pay_rates(make("label string, min double, max double", [(x, 1.0, 2.0) for x in labels]))
    assert [tuple(r) for r in pay.select("group", "level").collect()] == [
        ("IT", 2),
        ("DA-PRO", 2),
        ("PI-1", None),
        ("IT", 1),
        ("SU", 3),
        ("EX", None),
        ("AS", None),
        ("A-B", 3),
    ]


def test_pooled_median(make):
    pay = make(
        "group string, level int, min double, max double",
        [("IT", 1, 1.0, 10.0), ("IT", 1, 3.0, 4.0), ("X", None, 5.0, 7.0), ("N", 1, None, 3.0)],
    )
    out = salary.add_pooled_median(pay, ["group", "level"], ["min", "max"])
    assert rows(out, "group", "min", "median") == [
        ("IT", 1.0, 3.5),
        ("IT", 3.0, 3.5),
        ("N", None, None),
        ("X", 5.0, 6.0),
    ]


def test_pooled_median_against_sorting(make):
    rng = random.Random(5)
    sizes = {"a": 1, "b": 2, "c": 7, "hot": 300}
    pay = [(g, rng.choice([None, 1]), float(rng.randint(1, 40)), float(rng.randint(1, 40))) for g, n in sizes.items() for _ in range(n)]
    groups = {}
    for group, level, low, high in pay:
        groups.setdefault((group, level), []).extend([low, high])
    df = make("group string, level int, min double, max double", pay)
    found = salary.pooled_median(df, ["group", "level"], ["min", "max"])
    assert {(r.group, r.level): r.median for r in found.collect()} == {k: statistics.median(v) for k, v in groups.items()}


def test_salary_joins_null_levels_and_student_grades(make):
    people = make(
        "full_name string, earliest_group_level string, latest_group_level string",
        [("a", "CS-1", "IT-2"), ("s", "SU", "SU-9"), ("x", "X", "X"), ("n", None, "IT-2"), ("z", "Z-1", "IT-2")],
    )
    pay = make(
        "group string, level int, median double",
        [("IT", 1, 100.0), ("IT", 2, 150.0), ("SU", 3, 50.0), ("X", None, 70.0), ("Z", 1, 0.0)],
    )
    out = salary.attach_salary(people, pay)
    assert rows(out, "full_name", "earliest_group", "earliest_level", "latest_level", "salary_change_percentage") == [
        ("a", "IT", 1, 2, 0.5),
        ("n", None, None, 2, None),
        ("s", "SU", 3, 3, 0.0),
        ("x", "X", None, None, 0.0),
        ("z", "Z", 1, 2, None),
    ]


@pytest.fixture
def raw(make):
    schema = (
        "full_name string, tour_number int, discipline_initial string, initial_staffing_program string, "
        "cds_end_date date, departure_type string, onboarding_status string"
    )
    return make(
        schema,
        [
            ("a", None, "admin-operations", None, "2020-01-01", None, "pre_trello_board"),
            ("b", 2, "product management", "student", None, None, "onboarded"),
            ("c", 1, "policy", None, None, None, "not_onboarded"),
            ("d", 1, "policy", None, None, None, "incoming"),
            ("e", 1, "policy", None, None, None, "start_date_confirmed"),
            ("f", 1, "policy", None, None, None, None),
            ("g", 1, None, None, "2020-01-01", "to_academia", "anything_else"),
        ],
    )


def test_clean_tours(raw):
    out = cleaning.clean_tours(raw)
    assert out.columns == raw.columns
    assert sorted(map(tuple, out.drop("cds_end_date").collect())) == [
        ("a", 1, "Admin / Operations", "(default)", "unknown_departure_type", "onboarded"),
        ("b", 2, "Product Management", "student", None, "onboarded"),
        ("g", 1, None, "(default)", "to_academia", "anything_else"),
    ]
