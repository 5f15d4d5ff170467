"""Expected results as DuckDB SQL over the driver tables.

Written the long way round on purpose: spells are expanded day by day, months are counted
by a range join, tours are chained by one global lag, grades are joined to every tour. So
the SQL also checks the shorter plans that the operators use.
"""

from __future__ import annotations

import re

_INPUTS = {
    "tenure_raw": """
SELECT replace(c_name, '#', ' ') AS full_name,
  CASE WHEN o_rank = 1 AND c_custkey % 9 = 0 THEN NULL ELSE o_rank END AS tour_number,
  lower(CASE WHEN o_orderkey % 11 = 0 THEN 'admin-operations' ELSE c_mktsegment END) AS discipline_initial,
  CASE WHEN c_custkey % 10 = 0 THEN 'student'
       WHEN c_custkey % 10 = 1 THEN 'c4c_fellow' END AS initial_staffing_program,
  r1.r_name AS location_initial, r2.r_name AS location_most_recent,
  start_date AS cds_start_date,
  CASE WHEN o_orderstatus <> 'O'
       THEN least(start_date + CAST(o_orderkey * 37 % 1200 AS INT), DATE '2001-12-31') END AS cds_end_date,
  CASE WHEN o_orderstatus = 'O' THEN NULL
       WHEN o_orderkey % 7 = 0 THEN 'to_other_department'
       WHEN o_orderkey % 7 = 1 THEN 'to_other_government'
       WHEN o_orderkey % 7 = 2 THEN 'to_private_sector'
       WHEN o_orderkey % 7 = 3 THEN 'to_non_profit'
       WHEN o_orderkey % 7 = 4 AND o_orderkey % 4 = 0 THEN 'retired'
       WHEN o_orderkey % 7 = 4 THEN 'to_academia'
       WHEN o_orderkey % 7 = 5 THEN 'to_cds_full_time' END AS departure_type,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'from_private_sector'
       WHEN o_orderpriority = '2-HIGH' THEN 'from_other_department'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'from_academia'
       WHEN o_orderpriority = '5-LOW' AND o_orderkey % 5 = 0 THEN 'from_other_staffing_program'
       WHEN o_orderpriority = '5-LOW' THEN 'from_non_profit'
       WHEN o_orderkey % 2 = 0 THEN '?from_somewhere' END AS arrival_source,
  CASE WHEN o_orderkey % 97 = 0 THEN 'not_onboarded'
       WHEN o_orderkey % 97 = 1 THEN 'incoming'
       WHEN o_orderkey % 97 = 2 THEN 'pre_trello_board'
       WHEN o_orderkey % 97 = 3 THEN 'start_date_confirmed'
       ELSE 'onboarded' END AS onboarding_status,
  'private ' || o_orderpriority AS notes
FROM (SELECT *, CAST(o_orderdate AS DATE) AS start_date,
        CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INT) AS o_rank
      FROM orders) o
JOIN customer ON o_custkey = c_custkey
JOIN nation n1 ON n1.n_nationkey = c_nationkey
JOIN region r1 ON r1.r_regionkey = n1.n_regionkey
JOIN nation n2 ON n2.n_nationkey = (c_nationkey + o_orderkey % 3) % 25
JOIN region r2 ON r2.r_regionkey = n2.n_regionkey
""",
    "level_raw": """
SELECT split_part(c_name, '#', 2) ||
         CASE WHEN c_custkey % 13 = 0 THEN ' Forecast'
              WHEN c_custkey % 50 = 0 THEN ',Custom' ELSE ',Customer' END AS name,
  CASE WHEN c_custkey % 23 = 0 THEN '1900-01-00' ELSE '2016-10-03' END AS earliest_date,
  '2022-10-01' AS latest_date,
  CASE WHEN c_custkey % 10 = 0 THEN 'SU'
       WHEN c_custkey % 17 = 0 THEN 'CS-2'
       ELSE 'G' || CAST(c_custkey % 8 AS VARCHAR(9)) || '-' || CAST(c_custkey % 4 + 1 AS VARCHAR(9)) END AS earliest_group_level,
  CASE WHEN c_custkey % 20 = 0 THEN 'SU-2'
       WHEN c_custkey % 17 = 0 THEN 'IT-3'
       ELSE 'G' || CAST((c_custkey + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END) % 8 AS VARCHAR(9)) || '-' ||
            CAST(least(c_custkey % 4 + 1 + c_custkey % 2, 4) AS VARCHAR(9)) END AS latest_group_level
FROM customer
UNION ALL SELECT 'Global Forecast', '2020-01-01', '2020-01-01', 'XX-1', 'XX-1'
""",
    "name_harmonization": """
SELECT upper(replace(c_name, '#', ' ')) AS tenure_data_full_name,
       CASE WHEN c_custkey % 50 = 0 THEN 'CUSTOM ' ELSE 'CUSTOMER ' END || split_part(c_name, '#', 2) AS level_data_full_name
FROM customer WHERE c_custkey % 50 = 0 OR c_custkey % 3 <> 0
""",
    "pay_rates": """
SELECT label, min(p_retailprice) AS min, max(p_retailprice) AS max
FROM (SELECT p_retailprice,
        CASE WHEN p_type = 'PROMO' THEN 'DA-PRO-' || CAST(p_size % 4 + 1 AS VARCHAR(9))
             WHEN p_type = 'ECONOMY' THEN 'CS-0' || CAST(p_size % 4 + 1 AS VARCHAR(9))
             WHEN p_type = 'SMALL' AND p_size % 4 = 0 THEN 'STUDENT-03'
             WHEN p_type = 'SMALL' THEN 'PI-1-CGC'
             ELSE 'G' || CAST(p_partkey % 8 AS VARCHAR(9)) || '-0' || CAST(p_size % 4 + 1 AS VARCHAR(9)) END AS label
      FROM part) p
GROUP BY label
""",
    "board_cards": """
SELECT CASE WHEN o_orderkey % 40 = 0 THEN 'Template card'
            WHEN o_orderkey % 40 = 1 THEN 'PLACEHOLDER - x'
            WHEN o_orderkey % 40 = 2 THEN replace(c_name, '#', ' ')
            ELSE replace(c_name, '#', ' ') || ' - ' || c_mktsegment || ' - ' || o_orderpriority END AS card_name,
  o_orderdate AS due_date, o_orderdate AS last_activity_date,
  CASE WHEN o_orderstatus = 'O' THEN 'Pre-First Day'
       WHEN o_orderstatus = 'P' THEN 'Start Date CONFIRMED' ELSE 'Done' END AS list_name
FROM orders JOIN customer ON o_custkey = c_custkey
""",
}


def _fy(date: str) -> str:
    return f"CAST(CASE WHEN month({date}) <= 3 THEN year({date}) - 1 ELSE year({date}) END AS INTEGER)"


def _quarter(date: str) -> str:
    return (
        f"CASE WHEN month({date}) <= 3 THEN 'Q4' WHEN month({date}) <= 6 THEN 'Q1' "
        f"WHEN month({date}) <= 9 THEN 'Q2' ELSE 'Q3' END"
    )


def _duration(end: str) -> str:
    days = f"CAST({end} - cds_start_date + 1 AS INTEGER)"
    return f"{days} AS duration_days, {days} / 365.0::DOUBLE AS duration_years"


_BIN = """CASE WHEN duration_years <= 0 THEN NULL WHEN duration_years <= 1 THEN 'Under 1 year'
  WHEN duration_years <= 2 THEN '1-2 years' WHEN duration_years <= 3 THEN '2-3 years'
  WHEN duration_years > 3 THEN '3+ years' END"""
_REGION = "CASE WHEN {} = 'AMERICA' THEN 'in_ncr' ELSE 'outside_ncr' END"
_TITLE = """array_to_string(list_transform(string_split(
  CASE WHEN discipline_initial = 'admin-operations' THEN 'admin / operations' ELSE discipline_initial END, ' '),
  lambda w: upper(w[1]) || lower(w[2:])), ' ')"""

_DERIVED = {
    "tours": f"""
SELECT *, {_duration("cds_end_date")} FROM (
  SELECT full_name, CAST(coalesce(tour_number, 1) AS INTEGER) AS tour_number,
    {_TITLE} AS discipline_initial,
    coalesce(initial_staffing_program, '(default)') AS initial_staffing_program,
    location_initial, location_most_recent, cds_start_date, cds_end_date,
    CASE WHEN cds_end_date IS NOT NULL AND departure_type IS NULL THEN 'unknown_departure_type'
         ELSE departure_type END AS departure_type,
    arrival_source,
    CASE WHEN onboarding_status = 'pre_trello_board' THEN 'onboarded' ELSE onboarding_status END AS onboarding_status,
    notes,
    {_fy("cds_start_date")} AS cds_start_fiscal_year,
    CASE WHEN cds_end_date IS NOT NULL THEN {_fy("cds_end_date")} END AS cds_end_fiscal_year,
    coalesce(cds_end_date, DATE '2001-12-31') AS cds_end_date_or_present
  FROM tenure_raw
  WHERE onboarding_status NOT IN ('not_onboarded', 'incoming', 'start_date_confirmed'))
""",
    "tour_days": """
SELECT full_name, tour_number, discipline_initial, location_initial, location_most_recent,
  cds_start_fiscal_year, cds_end_fiscal_year,
  unnest(generate_series(cds_start_date, cds_end_date_or_present, INTERVAL 1 DAY)) AS day
FROM tours
""",
    "tour_years": f"""
SELECT *, CASE WHEN fiscal_year < round_even(avg(fiscal_year) OVER (PARTITION BY full_name, tour_number), 0)
               THEN location_initial ELSE location_most_recent END AS location_averaged
FROM (SELECT DISTINCT * EXCLUDE (day), {_fy("day")} AS fiscal_year FROM tour_days)
""",
    "departed": """
SELECT *, CASE WHEN duration_years < 1 THEN 1 ELSE 0 END AS departed_under_1_year
FROM tours WHERE cds_end_date IS NOT NULL AND initial_staffing_program <> 'student'
  AND departure_type <> 'to_cds_full_time'
""",
    "flagged": """
SELECT *, departure_type = 'to_cds_full_time' OR
    lag(departure_type) OVER (ORDER BY full_name, tour_number) = 'to_cds_full_time' AS flag,
  min(tour_number) OVER (PARTITION BY full_name) AS first_tour
FROM tours
""",
    "merged": f"""
SELECT *, {_duration("cds_end_date_or_present")} FROM (
  SELECT *, coalesce(cds_end_date, DATE '2001-12-31') AS cds_end_date_or_present FROM (
    SELECT DISTINCT full_name, new_tour AS tour_number,
      first_value(cds_start_date) OVER w AS cds_start_date,
      last_value(cds_end_date) OVER w AS cds_end_date,
      last_value(discipline_initial) OVER w AS most_recent_discipline_initial,
      first_value(arrival_source) OVER w AS initial_arrival_source
    FROM (SELECT *, CASE WHEN flag THEN first_tour ELSE tour_number END AS new_tour FROM flagged)
    WINDOW w AS (PARTITION BY full_name, new_tour ORDER BY tour_number
                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)))
""",
    "settled": "SELECT * FROM merged WHERE cds_start_date < DATE '2001-12-31' - 365",
    "roster": """
SELECT upper(split_part(name, ',', 2) || ' ' || split_part(name, ',', 1)) AS full_name_uc,
  TRY_CAST(nullif(earliest_date, '1900-01-00') AS DATE) AS earliest_date,
  TRY_CAST(nullif(latest_date, '1900-01-00') AS DATE) AS latest_date,
  earliest_group_level, latest_group_level
FROM level_raw WHERE contains(name, ',') AND earliest_date <> '1900-01-00'
""",
    "pay": """
SELECT CASE WHEN g = 'CS' THEN 'IT' WHEN g = 'STUDENT' THEN 'SU' ELSE g END AS "group",
  TRY_CAST(ltrim(l, '0') AS INTEGER) AS level, min, max
FROM (SELECT min, max,
        CASE WHEN len(p) > 2 THEN p[1] || '-' || p[2] ELSE p[1] END AS g,
        CASE WHEN len(p) > 2 THEN p[3] ELSE p[2] END AS l
      FROM (SELECT *, string_split(label, '-') AS p FROM pay_rates))
""",
    "pay_median": """
SELECT pay.*, m.median FROM pay
JOIN (SELECT "group", level,
        CASE WHEN count(*) = count(v) THEN median(v) END AS median
      FROM (SELECT "group", level, unnest([min, max]) AS v FROM pay) GROUP BY 1, 2) m
  ON pay."group" = m."group" AND pay.level IS NOT DISTINCT FROM m.level
""",
    "tours_named": """
SELECT t.*, r.earliest_group_level, r.latest_group_level
FROM tours t
LEFT JOIN name_harmonization a ON upper(t.full_name) = a.tenure_data_full_name
LEFT JOIN roster r ON coalesce(a.level_data_full_name, upper(t.full_name)) = r.full_name_uc
""",
    "tours_graded": """
SELECT * EXCLUDE (eg, lg),
  CASE WHEN split_part(eg, '-', 1) = 'CS' THEN 'IT' ELSE split_part(eg, '-', 1) END AS earliest_group,
  TRY_CAST(split_part(eg, '-', 2) AS INTEGER) AS earliest_level,
  CASE WHEN split_part(lg, '-', 1) = 'CS' THEN 'IT' ELSE split_part(lg, '-', 1) END AS latest_group,
  TRY_CAST(split_part(lg, '-', 2) AS INTEGER) AS latest_level
FROM (SELECT *, CASE WHEN contains(earliest_group_level, 'SU') THEN 'SU-3' ELSE earliest_group_level END AS eg,
        CASE WHEN contains(latest_group_level, 'SU') THEN 'SU-3' ELSE latest_group_level END AS lg
      FROM tours_named)
""",
    "tours_paid": """
SELECT t.*, e.median AS earliest_median_salary, l.median AS latest_median_salary,
  (l.median - e.median) / nullif(e.median, 0) AS salary_change_percentage
FROM tours_graded t
LEFT JOIN pay_median e ON t.earliest_group IS NOT DISTINCT FROM e."group" AND t.earliest_level IS NOT DISTINCT FROM e.level
LEFT JOIN pay_median l ON t.latest_group IS NOT DISTINCT FROM l."group" AND t.latest_level IS NOT DISTINCT FROM l.level
""",
    "people": """
SELECT DISTINCT full_name, last_value(discipline_initial) OVER w AS discipline_initial,
  last_value(location_most_recent) OVER w AS location_most_recent,
  last_value(arrival_source) OVER w AS arrival_source,
  earliest_group, earliest_level, latest_group, latest_level,
  earliest_median_salary, latest_median_salary, salary_change_percentage
FROM tours_paid
WINDOW w AS (PARTITION BY full_name ORDER BY tour_number ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""",
    "progression": f"""
SELECT p.*, coalesce(latest_median_salary > earliest_median_salary, false) AS has_promotion,
  coalesce(earliest_group <> latest_group, false) AS has_classification_change,
  coalesce(latest_level > earliest_level, false) AS has_level_increase,
  coalesce(earliest_group <> latest_group, false) OR coalesce(latest_level > earliest_level, false)
    AS has_classification_change_or_level_increase,
  d.duration_days, d.duration_years,
  {_REGION.format("location_most_recent")} AS in_or_out_of_national_capital_region,
  {_BIN} AS duration_years_bins
FROM people p
LEFT JOIN (SELECT DISTINCT full_name,
             last_value(duration_days) OVER w AS duration_days, last_value(duration_years) OVER w AS duration_years
           FROM merged
           WINDOW w AS (PARTITION BY full_name ORDER BY tour_number
                        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) d
  ON p.full_name = d.full_name
WHERE latest_level IS NOT NULL
""",
    "arrivals_fy": """
SELECT cds_start_fiscal_year, count(DISTINCT full_name) AS arrivals FROM tour_years GROUP BY 1
""",
    "departures_fy": """
SELECT cds_end_fiscal_year, count(DISTINCT full_name) AS departures FROM tour_years
WHERE cds_end_fiscal_year IS NOT NULL GROUP BY 1
""",
    "headcount_fy": "SELECT fiscal_year, count(DISTINCT full_name) AS headcount FROM tour_years GROUP BY 1",
    "person_location": """
SELECT DISTINCT full_name, fiscal_year, last_value(location_averaged) OVER (
  PARTITION BY full_name, fiscal_year ORDER BY tour_number
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS location_averaged
FROM tour_years
""",
    "region_fy": f"""
SELECT *, round_even(location_in_out_count / total_staff_count, 4) AS location_percentage
FROM (SELECT *, CAST(sum(location_in_out_count) OVER (PARTITION BY fiscal_year) AS BIGINT) AS total_staff_count
      FROM (SELECT fiscal_year, {_REGION.format("location_averaged")} AS in_or_out_of_national_capital_region,
              count(*) AS location_in_out_count
            FROM person_location GROUP BY 1, 2))
""",
    "staff": """
SELECT full_name, max(cds_start_date) AS most_recent_start_date FROM tours WHERE cds_end_date IS NULL GROUP BY 1
""",
    "discipline_arrivals": """
SELECT discipline_initial, count(*) AS arrivals_by_discipline_count
FROM (SELECT DISTINCT full_name, discipline_initial FROM tours) GROUP BY 1
""",
    "tour_counts": """
SELECT DISTINCT full_name, last_value(tour_number) OVER w AS highest_tour_number,
  first_value(discipline_initial) OVER w AS discipline_initial,
  first_value(initial_staffing_program) OVER w AS initial_staffing_program
FROM tours
WINDOW w AS (PARTITION BY full_name ORDER BY tour_number ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""",
    "fiscal_summary": """
SELECT *, lag(headcount_adjusted) OVER (ORDER BY fiscal_year) AS previous
FROM (SELECT a.cds_start_fiscal_year AS fiscal_year, arrivals, departures,
        (arrivals - departures) / arrivals AS new_hires_percentage,
        1 - (arrivals - departures) / arrivals AS replacement_hires_percentage,
        headcount AS headcount_arrivals, headcount - departures AS headcount_adjusted,
        location_percentage AS location_outside_ncr_percentage
      FROM arrivals_fy a
      LEFT JOIN departures_fy d ON a.cds_start_fiscal_year = d.cds_end_fiscal_year
      LEFT JOIN headcount_fy h ON h.fiscal_year = a.cds_start_fiscal_year
      LEFT JOIN (SELECT * FROM region_fy WHERE in_or_out_of_national_capital_region = 'outside_ncr') r
        ON r.fiscal_year = a.cds_start_fiscal_year)
""",
    "departure_by_discipline": """
SELECT *, departure_count / total_count AS departure_type_percentage
FROM (SELECT *, CAST(sum(departure_count) OVER (PARTITION BY discipline_initial) AS BIGINT) AS total_count
      FROM (SELECT discipline_initial, departure_type, count(*) AS departure_count FROM departed GROUP BY 1, 2))
""",
    "departure_by_source": """
SELECT *, departure_count / total_count AS departure_type_percentage
FROM (SELECT *, CAST(sum(departure_count) OVER (PARTITION BY arrival_source) AS BIGINT) AS total_count
      FROM (SELECT arrival_source, departure_type, count(*) AS departure_count FROM departed GROUP BY 1, 2))
""",
    "source_fy": """
SELECT *, round_even(n / sum(n) OVER (PARTITION BY cds_start_fiscal_year), 2) AS prop
FROM (SELECT cds_start_fiscal_year,
        CASE coalesce(arrival_source, 'other')
          WHEN 'from_academia' THEN 'Academia' WHEN 'from_non_profit' THEN 'Non-profit sector'
          WHEN 'from_other_department' THEN 'Other GC departments'
          WHEN 'from_other_government' THEN 'Other levels of government'
          WHEN 'from_other_staffing_program' THEN 'Other staffing program'
          WHEN 'from_private_sector' THEN 'Private sector' WHEN 'other' THEN 'Unknown' END AS arrival_source,
        count(*) AS n
      FROM tours GROUP BY 1, 2)
""",
    "months": """
SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 MONTH)) AS DATE) AS month
""",
}

_CTES = {**_INPUTS, **_DERIVED}
_WORD = re.compile("|".join(rf"\b{name}\b" for name in sorted(_CTES, key=len, reverse=True)))


def _sql(body: str) -> str:
    """``body`` behind the common tables that it needs."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        for name in set(_WORD.findall(pending.pop())) - needed:
            needed.add(name)
            pending.append(_CTES[name])
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in _CTES.items() if name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


def _category(source: str, key: str, count: str, percentage: str, digits: int | None = None) -> str:
    share = f"{count} / total_count"
    share = share if digits is None else f"round_even({share}, {digits})"
    return f"""SELECT *, {share} AS {percentage}
FROM (SELECT *, CAST(sum({count}) OVER () AS BIGINT) AS total_count
      FROM (SELECT {key}, count(*) AS {count} FROM {source} GROUP BY {key}))"""


def _cells(source: str, key: str, types: tuple[str, ...]) -> str:
    cell = (
        "CAST(CAST(round_even(round_even(departure_type_percentage, 4) * 100, 0) AS BIGINT) AS VARCHAR)"
        " || '% (' || departure_count || ')'"
    )
    columns = ", ".join(f"coalesce(max(CASE WHEN departure_type = '{t}' THEN {cell} END), '0%') AS {t}" for t in types)
    return f"SELECT {key}, {columns} FROM {source} GROUP BY {key}"


def _average(source: str, name: str, by: str | None = None) -> str:
    mean = f"round_even(avg(duration_years), 6) AS {name}"
    return f"SELECT {mean} FROM {source}" if by is None else (
        f"SELECT {by}, {mean}, count(*) AS arrivals_count FROM {source} GROUP BY {by}"
    )


def _promotion(by: str | None = None, where: str = "true", nonzero: bool = False, flag: str = "has_promotion") -> str:
    count = f"{flag}_count" if flag == "has_promotion" else flag
    key = "" if by is None else f"{by}, "
    group = "" if by is None else f"GROUP BY {by}"
    outer = "WHERE percentage <> 0" if nonzero else ""
    return f"""SELECT * FROM (SELECT {key}count(*) FILTER ({flag}) AS {count}, count(*) AS total_count,
    count(*) FILTER ({flag}) / nullif(count(*), 0) AS percentage
  FROM progression WHERE {where} {group}) {outer}"""


def _monthly(where: str = "true") -> str:
    return f"""SELECT month, headcount,
  headcount - previous AS change_prev_month, headcount - year_before AS change_prev_year,
  round_even((headcount - previous) / nullif(previous, 0) * 100, 2) AS pct_change_month,
  round_even((headcount - year_before) / nullif(year_before, 0) * 100, 2) AS pct_change_year
FROM (SELECT *, lag(headcount, 1, 0) OVER (ORDER BY month) AS previous,
        lag(headcount, 12, 0) OVER (ORDER BY month) AS year_before
      FROM (SELECT month, count(t.full_name) AS headcount
            FROM months LEFT JOIN (SELECT * FROM tours WHERE {where}) t
              ON t.cds_start_date <= month AND t.cds_end_date_or_present > month
            GROUP BY month))"""


def _histogram(where: str) -> str:
    return f"""SELECT ceil((duration_years - 0.25::DOUBLE) / 0.5::DOUBLE) * 0.5::DOUBLE AS bin, count(*) AS n
FROM merged WHERE {where} GROUP BY 1"""


_NOT_STUDENTS = "earliest_group <> 'SU'"
_REPEATED = """SELECT 'roster' AS lookup, full_name_uc AS key, count(*) AS row_count FROM roster GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'aliases', tenure_data_full_name, count(*) FROM name_harmonization GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'pay', concat_ws(' ', "group", level), count(*)
FROM (SELECT DISTINCT "group", level, median FROM pay_median) GROUP BY "group", level HAVING count(*) > 1"""
_BY_DISCIPLINE = ("to_other_department", "to_other_government", "to_private_sector", "to_non_profit", "to_academia", "unknown_departure_type", "retired")
_BY_SOURCE = ("to_academia", "to_non_profit", "to_other_department", "to_other_government", "to_private_sector", "unknown_departure_type", "retired")
_REGION_COLUMN = "in_or_out_of_national_capital_region"

# The types that a text can have, narrow ones first, each with a test.
_TYPE_TESTS = {
    "boolean": "lower(value) IN ('true', 'false')",
    "int": "regexp_full_match(value, '[+-]?[0-9]{1,19}') AND TRY_CAST(value AS INT) IS NOT NULL",
    "bigint": "regexp_full_match(value, '[+-]?[0-9]{1,19}') AND TRY_CAST(value AS BIGINT) IS NOT NULL",
    "double": "regexp_full_match(value, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,2})?') AND TRY_CAST(value AS DOUBLE) IS NOT NULL",
    "date": "regexp_full_match(value, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(value AS DATE) IS NOT NULL",
    "timestamp_ntz": "regexp_full_match(value, '[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?') AND TRY_CAST(value AS TIMESTAMP) IS NOT NULL",
}


def _types_of(table: str) -> str:
    narrowest = " ".join(f"WHEN not_{kind} = 0 THEN '{kind}'" for kind in _TYPE_TESTS)
    counts = ", ".join(f"count(*) FILTER (value IS NOT NULL AND NOT ({test})) AS not_{kind}" for kind, test in _TYPE_TESTS.items())
    return f"""SELECT column_name, CASE WHEN n_values = 0 THEN 'string' {narrowest} ELSE 'string' END AS inferred_type, * EXCLUDE (column_name)
FROM (SELECT '{table}.' || name AS column_name, count(value) AS n_values, count(*) - count(value) AS n_nulls, {counts}
      FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM {table}) UNPIVOT INCLUDE NULLS (value FOR name IN (*))
      GROUP BY name)"""


# One join of days with tours for each discipline, where the operator adds up steps.
_AT_ONCE = """SELECT d.discipline_initial, d.date, count(t.full_name) AS tours_at_once
FROM (SELECT DISTINCT discipline_initial, unnest([cds_start_date, cds_end_date_or_present]) AS date FROM tours
      WHERE cds_start_date < cds_end_date_or_present) d
LEFT JOIN tours t ON t.discipline_initial = d.discipline_initial AND t.cds_start_date <= d.date AND t.cds_end_date_or_present > d.date
GROUP BY d.discipline_initial, d.date"""

_BODIES = {
    "arrivals": "SELECT count(*) AS total_onboarded FROM (SELECT DISTINCT full_name, tour_number FROM tours)",
    "headcount_individual_staff": "SELECT count(*) AS total_individual_staff FROM (SELECT DISTINCT full_name FROM tours)",
    "arrivals_by_source": _category(
        """(SELECT CASE WHEN arrival_source IS NULL OR arrival_source[1] = '?' THEN 'unknown_arrival_source'
                   ELSE arrival_source END AS arrival_source
            FROM (SELECT DISTINCT full_name, tour_number, arrival_source FROM tours))""",
        "arrival_source", "onboarded_count", "percentage",
    ),
    "departures": """SELECT count(*) AS total_departed FROM (SELECT DISTINCT full_name, cds_end_date, departure_type
FROM tours WHERE cds_end_date IS NOT NULL AND departure_type <> 'to_cds_full_time')""",
    "arrivals_by_fiscal_year": "SELECT * FROM arrivals_fy",
    "departures_by_fiscal_year": "SELECT * FROM departures_fy",
    "headcount_current": "SELECT count(*) AS headcount_current FROM staff",
    "headcount_joined_within_past_12_months": """SELECT *, headcount_joined_within_past_12_months / headcount_current AS percentage
FROM (SELECT count(*) FILTER (most_recent_start_date >= DATE '2001-12-31' - 365) AS headcount_joined_within_past_12_months,
        count(*) AS headcount_current FROM staff)""",
    "headcount_by_discipline": _category(
        """(SELECT DISTINCT full_name, most_recent AS discipline_initial, cds_end_fiscal_year
            FROM (SELECT *, last_value(discipline_initial) OVER (PARTITION BY full_name ORDER BY tour_number
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS most_recent FROM tour_years)
            WHERE cds_end_fiscal_year IS NULL)""",
        "discipline_initial", "count_by_discipline", "percentage", 4,
    ),
    "headcount_by_fiscal_year": "SELECT * FROM headcount_fy",
    "discipline_count_by_fiscal_year": """SELECT fiscal_year, discipline_initial, count(DISTINCT full_name) AS discipline_count
FROM tour_years GROUP BY 1, 2""",
    "arrivals_by_discipline": _category(
        "(SELECT DISTINCT full_name, discipline_initial FROM tours)",
        "discipline_initial", "arrivals_by_discipline_count", "percentage", 4,
    ),
    "departures_excluding_students": "SELECT count(*) AS total_departed FROM departed",
    "new_hire_turnover_under_1_year": """SELECT *, round_even(departure_count / total_onboarded, 4) AS departure_percentage
FROM (SELECT departed_under_1_year, count(*) AS departure_count FROM departed GROUP BY 1),
     (SELECT count(*) AS total_onboarded FROM (SELECT DISTINCT full_name, tour_number FROM tours))""",
    "new_hire_turnover_under_1_year_by_discipline": """SELECT d.discipline_initial, departed_under_1_year_count, total_departure_count,
  arrivals_by_discipline_count,
  round_even(departed_under_1_year_count / arrivals_by_discipline_count, 4) AS departed_under_1_year_percentage
FROM (SELECT discipline_initial, departed_under_1_year, count(*) AS departed_under_1_year_count,
        CAST(sum(count(*)) OVER (PARTITION BY discipline_initial) AS BIGINT) AS total_departure_count
      FROM departed GROUP BY 1, 2) d
LEFT JOIN discipline_arrivals a ON d.discipline_initial = a.discipline_initial
WHERE departed_under_1_year = 1""",
    "multiple_tours_by_discipline": """SELECT discipline_initial, count(*) AS multiple_tours_by_discipline_count
FROM tour_counts WHERE highest_tour_number > 1 GROUP BY 1""",
    "multiple_tours_by_initial_staffing_program": """SELECT initial_staffing_program,
  count(*) AS multiple_tours_by_initial_staffing_program_count
FROM tour_counts WHERE highest_tour_number > 1 GROUP BY 1""",
    "multiple_tours_students_tour_number": """SELECT highest_tour_number, count(*) AS students_count
FROM tour_counts WHERE initial_staffing_program = 'student' GROUP BY 1""",
    "location_in_out_ncr_by_fiscal_year": f"""SELECT fiscal_year, {_REGION_COLUMN}, location_in_out_count,
  total_staff_count, location_percentage FROM region_fy""",
    "location_changed_while_at_cds": """SELECT CASE WHEN f <> l THEN 1 ELSE 0 END AS location_changed_at_cds, count(*) AS count
FROM (SELECT DISTINCT full_name, first_value(location_initial) OVER w AS f, last_value(location_most_recent) OVER w AS l
      FROM tours WINDOW w AS (PARTITION BY full_name ORDER BY tour_number
                              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) GROUP BY 1""",
    "departure_type": f"""SELECT *, CAST(CAST(round_even(departure_type_percentage * 100, 0) AS BIGINT) AS VARCHAR)
    || '% (' || departure_count || ')' AS departure_type_combined
FROM ({_category("departed", "departure_type", "departure_count", "departure_type_percentage")})""",
    "departure_type_by_discipline": "SELECT * FROM departure_by_discipline",
    "departure_type_by_arrival_source": "SELECT * FROM departure_by_source",
    "summary_departure_type_by_discipline_percentages": _cells(
        "departure_by_discipline", "discipline_initial", _BY_DISCIPLINE
    ),
    "summary_departure_type_by_arrival_source_percentages": f"""SELECT * FROM (
{_cells("departure_by_source", "arrival_source", _BY_SOURCE)}) WHERE arrival_source <> 'from_other_staffing_program'""",
    "departure_type_joined_from_outside_government": _category(
        "(SELECT * FROM departed WHERE arrival_source IN ('from_private_sector', 'from_non_profit', 'from_academia '))",
        "departure_type", "departure_count", "departure_type_percentage",
    ),
    "summary_arrivals_departures_headcount_by_fiscal_year": """SELECT * EXCLUDE (previous),
  (previous + headcount_adjusted) / 2 AS headcount_lagged_average,
  departures / ((previous + headcount_adjusted) / 2) AS turnover_rate_percentage FROM fiscal_summary""",
    "tenure_average": _average("merged WHERE cds_end_date IS NULL", "average_tenure_years"),
    "tenure_headcount_bins": f"""SELECT {_BIN} AS duration_years_bins, count(*) AS headcount
FROM merged WHERE cds_end_date IS NULL GROUP BY 1""",
    "duration_average": _average("settled", "average_duration_years"),
    "duration_average_by_discipline": _average("settled", "average_duration_years", "most_recent_discipline_initial"),
    "duration_quantiles": """SELECT round_even(v, 6) AS duration_years, q
FROM (SELECT unnest(quantile_cont(duration_years, [0, 0.25, 0.5, 0.75, 1])) AS v,
        unnest([0.0, 0.25, 0.5, 0.75, 1.0]::DOUBLE[]) AS q FROM settled)""",
    "duration_average_by_arrival_source": _average(
        "settled WHERE initial_arrival_source IS NOT NULL", "average_duration_years", "initial_arrival_source"
    ),
    "classification_promotion": _promotion(),
    "classification_promotion_excluding_students": _promotion(where=_NOT_STUDENTS),
    "classification_promotion_by_duration_years_bins": _promotion("duration_years_bins"),
    "classification_promotion_by_latest_group": _promotion("latest_group", nonzero=True),
    "classification_promotion_excluding_students_by_latest_group": _promotion(
        "latest_group", _NOT_STUDENTS, nonzero=True
    ),
    "classification_promotion_by_discipline_initial": _promotion("discipline_initial"),
    "classification_promotion_excluding_students_by_discipline_initial": _promotion("discipline_initial", _NOT_STUDENTS),
    "classification_promotion_by_in_or_out_of_ncr": _promotion(_REGION_COLUMN),
    "classification_promotion_excluding_students_by_in_or_out_of_ncr": _promotion(_REGION_COLUMN, _NOT_STUDENTS),
    # Series feeds
    "arrival_source_proportion_series": "SELECT * EXCLUDE (n) FROM source_fy",
    "arrival_source_count_series": "SELECT * FROM source_fy",
    "location_series": f"""SELECT * REPLACE (CASE {_REGION_COLUMN} WHEN 'in_ncr' THEN 'National Capital Region'
  WHEN 'outside_ncr' THEN 'Outside the NCR' END AS {_REGION_COLUMN}) FROM region_fy""",
    "tenure_histogram_current": _histogram("cds_end_date IS NULL"),
    "tenure_histogram_all": _histogram("true"),
    "headcount_by_month": _monthly(),
    "headcount_by_month_slice": _monthly("discipline_initial = 'Building'"),
    # Operators without a report
    "typed_orders": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
    "roster_dates": """SELECT * REPLACE (TRY_CAST(nullif(earliest_date, '1900-01-00') AS DATE) AS earliest_date,
  TRY_CAST(nullif(latest_date, '1900-01-00') AS DATE) AS latest_date) FROM level_raw""",
    "clean_roster": "SELECT * FROM roster",
    "tours_with_roster": "SELECT * FROM tours_named",
    "name_mismatches": """SELECT full_name_uc, 'b' AS missing_from FROM (
  SELECT full_name_uc FROM roster EXCEPT SELECT upper(full_name) FROM tours)
UNION ALL SELECT full_name_uc, 'a' AS missing_from FROM (
  SELECT upper(full_name) AS full_name_uc FROM tours EXCEPT SELECT full_name_uc FROM roster)""",
    "duplicate_lookup_keys": f"SELECT * FROM ({_REPEATED})",
    "data_quality": f"""SELECT 'repeated keys in ' || l AS check_name, (SELECT count(*) FROM ({_REPEATED}) WHERE lookup = l) AS problems
FROM (SELECT unnest(['aliases', 'roster', 'pay']) AS l)
UNION ALL SELECT 'tours without a start', count(*) FILTER (cds_start_date IS NULL) FROM tours
UNION ALL SELECT 'tours that end before they start', count(*) FILTER (cds_end_date < cds_start_date) FROM tours""",
    "parsed_pay_rates": "SELECT * FROM pay",
    "median_pay_rates": 'SELECT "group", level, min, max, round_even(median, 6) AS median FROM pay_median',
    "cleaned_tours": "SELECT * REPLACE (round_even(duration_years, 9) AS duration_years) FROM tours",
    "tour_salaries": """SELECT full_name, tour_number, earliest_group, earliest_level, latest_group, latest_level,
  round_even(earliest_median_salary, 6) AS earliest_median_salary,
  round_even(latest_median_salary, 6) AS latest_median_salary,
  round_even(salary_change_percentage, 6) AS salary_change_percentage FROM tours_paid""",
    "imported_board_cards": """SELECT trim(CASE WHEN cut = 0 THEN card_name ELSE substr(card_name, 1, cut - 1) END) AS full_name,
  CASE WHEN cut > 0 THEN trim(substr(card_name, cut + 2)) END AS role, CAST(NULL AS VARCHAR) AS location,
  CAST(due_date AS DATE) AS cds_start_date,
  CASE WHEN list_name = 'Pre-First Day' THEN 'incoming' WHEN list_name = 'Start Date CONFIRMED'
       THEN 'start_date_confirmed' ELSE 'onboarded' END AS onboarding_status,
  CAST(last_activity_date AS DATE) AS trello_last_activity_date, CAST(due_date AS DATE) AS role_start_date,
  CAST(NULL AS VARCHAR) AS role_end_date, CAST(NULL AS VARCHAR) AS cds_end_date, CAST(NULL AS VARCHAR) AS departure_type
FROM (SELECT *, strpos(card_name, '- ') AS cut FROM board_cards
      WHERE NOT contains(card_name, 'Template') AND NOT contains(card_name, 'PLACEHOLDER'))""",
    "spell_problems": """SELECT count(*) AS tours, count(*) - count(cds_start_date) AS without_start,
  count(*) FILTER (cds_end_date < cds_start_date) AS reversed FROM tours""",
    "fiscal_calendar": f"""SELECT full_name, tour_number, cds_start_date, cds_start_fiscal_year,
  {_quarter("cds_start_date")} AS quarter,
  cds_start_fiscal_year || '-' || (cds_start_fiscal_year + 1) AS fiscal_year_label,
  cds_start_fiscal_year AS label_year,
  cds_start_fiscal_year || '-' || (cds_start_fiscal_year + 1) || '-' || {_quarter("cds_start_date")} AS reporting_period
FROM tours""",
    "tours_by_fiscal_year": """SELECT full_name, tour_number, discipline_initial, cds_start_fiscal_year,
  cds_end_fiscal_year, fiscal_year FROM tour_years""",
    "location_by_fiscal_year": """SELECT full_name, tour_number, fiscal_year, location_initial, location_most_recent,
  location_averaged FROM tour_years""",
    "merged_tours": "SELECT * REPLACE (round_even(duration_years, 9) AS duration_years) FROM merged",
    "tours_present_on_date": """SELECT full_name, tour_number, cds_start_date, cds_end_date FROM tours
WHERE cds_start_date <= DATE '1999-07-01' AND cds_end_date_or_present > DATE '1999-07-01'""",
    "tours_present_on_dates": """SELECT date, full_name, tour_number, cds_start_date, cds_end_date
FROM (SELECT DISTINCT CAST(date_trunc('quarter', cds_start_date) AS DATE) AS date FROM tours) d
JOIN tours ON cds_start_date <= date AND cds_end_date_or_present > date""",
    "densified_assignments": """SELECT g.full_name, g.date AS cds_start_date, o.last.discipline_initial AS discipline_initial,
  o.last.location_most_recent AS location_most_recent, o.date = g.date AS observed
FROM (SELECT full_name, CAST(unnest(generate_series(min(cds_start_date), max(cds_start_date), INTERVAL 28 DAY)) AS DATE) AS date
      FROM tours GROUP BY full_name) g
ASOF JOIN (SELECT full_name, cds_start_date AS date,
             max({'discipline_initial': discipline_initial, 'location_most_recent': location_most_recent}) AS last
           FROM tours GROUP BY full_name, cds_start_date) o
ON g.full_name = o.full_name AND g.date >= o.date""",
    "tours_at_once_by_discipline": _AT_ONCE,
    "most_tours_at_once_by_discipline": f"""SELECT discipline_initial, max(tours_at_once) AS most_tours_at_once,
  arg_min(date, (-tours_at_once, date)) AS first_date FROM ({_AT_ONCE}) GROUP BY discipline_initial""",
    "duration_quantiles_by_discipline": """SELECT most_recent_discipline_initial, CAST(probability AS DOUBLE) AS probability,
  round_even(value, 6) AS duration_years
FROM (SELECT most_recent_discipline_initial, unnest([0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]) AS probability,
        unnest(quantile_cont(duration_years, [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1])) AS value
      FROM merged GROUP BY most_recent_discipline_initial)""",
    "inferred_types": "\nUNION ALL ".join(_types_of(name) for name in _INPUTS if name != "board_cards"),
    "orders_in_input_order": """SELECT o_custkey, arg_min(o_orderkey, place) AS first_order, arg_max(o_orderkey, place) AS last_order, count(*) AS orders
FROM (SELECT *, row_number() OVER () AS place FROM orders) GROUP BY o_custkey""",
    "presence_in_sql": """SELECT discipline_initial AS discipline, fy || '-' || (fy + 1) || '-Q' || quarter(cds_start_date - INTERVAL 3 MONTH) AS arrival_period,
  CAST(fy AS INT) AS arrival_year, count(*) AS tours,
  CAST(round_even(count(*) FILTER (days <= 365) / count(*) * 100, 0) AS BIGINT) || '% (' || count(*) || ')' AS under_1_year,
  format('{:.2f}', round_even(sum(days) / count(*), 2)) AS average_days
FROM (SELECT *, year(cds_start_date - INTERVAL 3 MONTH) AS fy, DATE '1999-07-01' - CAST(cds_start_date AS DATE) + 1 AS days FROM tours)
WHERE cds_start_date <= DATE '1999-07-01' AND cds_end_date_or_present > DATE '1999-07-01' GROUP BY ALL""",
    "first_and_last_attributes": """SELECT DISTINCT full_name, first_value(location_initial) OVER w AS first_location,
  first_value(initial_staffing_program) OVER w AS first_program,
  last_value(discipline_initial) OVER w AS last_discipline, last_value(arrival_source) OVER w AS last_source
FROM tours WINDOW w AS (PARTITION BY full_name ORDER BY tour_number
                        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "person_progression": f"""SELECT * EXCLUDE ({_REGION_COLUMN}, duration_years_bins) REPLACE (
  round_even(earliest_median_salary, 6) AS earliest_median_salary,
  round_even(latest_median_salary, 6) AS latest_median_salary,
  round_even(salary_change_percentage, 6) AS salary_change_percentage,
  round_even(duration_years, 6) AS duration_years) FROM progression""",
    "classification_change_or_level_increase": _promotion(
        "discipline_initial", flag="has_classification_change_or_level_increase"
    ),
    "classification_promotion_breakdowns": "\nUNION ALL ".join(
        f"""SELECT '{name}' AS breakdown, {column} AS category, count(*) FILTER (has_promotion) AS has_promotion_count,
  count(*) AS total_count, count(*) FILTER (has_promotion) / nullif(count(*), 0) AS percentage
FROM progression {group}"""
        for name, column, group in [
            ("overall", "CAST(NULL AS VARCHAR)", ""),
            *[
                (key, key, f"GROUP BY {key}")
                for key in ("latest_group", "discipline_initial", _REGION_COLUMN, "duration_years_bins")
            ],
        ]
    ),
    "published_merged_tours": """SELECT * EXCLUDE (full_name) REPLACE (
  format('{:.2f}', round_even(duration_years, 2)) AS duration_years) FROM merged""",
    "published_summary": """SELECT fiscal_year, arrivals, departures,
  round_even(new_hires_percentage, 4) AS new_hires_percentage,
  round_even(replacement_hires_percentage, 4) AS replacement_hires_percentage,
  headcount_arrivals, headcount_adjusted, location_outside_ncr_percentage,
  (previous + headcount_adjusted) / 2 AS headcount_lagged_average,
  round_even(departures / ((previous + headcount_adjusted) / 2), 4) AS turnover_rate_percentage FROM fiscal_summary""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _sql(body) for name, body in _BODIES.items()}
