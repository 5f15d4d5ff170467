"""Column names and codes that the input tables and reports use."""

PERSON = "full_name"
TOUR = "tour_number"
DISCIPLINE = "discipline_initial"
PROGRAM = "initial_staffing_program"
LOCATION_FIRST = "location_initial"
LOCATION_LAST = "location_most_recent"
START = "cds_start_date"
END = "cds_end_date"
END_OR_PRESENT = "cds_end_date_or_present"
START_FY = "cds_start_fiscal_year"
END_FY = "cds_end_fiscal_year"
DEPARTURE = "departure_type"
SOURCE = "arrival_source"
STATUS = "onboarding_status"
NOTES = "notes"
FISCAL_YEAR = "fiscal_year"
LOCATION_AVERAGED = "location_averaged"
REGION = "in_or_out_of_national_capital_region"
BINS = "duration_years_bins"

SWITCH = "to_cds_full_time"
UNKNOWN_DEPARTURE = "unknown_departure_type"
UNKNOWN_SOURCE = "unknown_arrival_source"
STUDENT = "student"
DEFAULT_PROGRAM = "(default)"
HOME_REGION = "Ottawa-Gatineau"
STUDENT_GROUP = "SU"
DATE_SENTINEL = "1900-01-00"

# The academia code ends in a space, so academia is never counted.
OUTSIDE_GOVERNMENT_SOURCES = ("from_private_sector", "from_non_profit", "from_academia ")

DEPARTURE_TYPES = (
    "to_other_department",
    "to_other_government",
    "to_private_sector",
    "to_non_profit",
    "to_academia",
    "unknown_departure_type",
)
DEPARTURE_TYPES_BY_SOURCE = (
    "to_academia",
    "to_non_profit",
    "to_other_department",
    "to_other_government",
    "to_private_sector",
    "unknown_departure_type",
)

ARRIVAL_SOURCE_LABELS = {
    "from_academia": "Academia",
    "from_non_profit": "Non-profit sector",
    "from_other_department": "Other GC departments",
    "from_other_government": "Other levels of government",
    "from_other_staffing_program": "Other staffing program",
    "from_private_sector": "Private sector",
    "other": "Unknown",
}
LOCATION_LABELS = {
    "in_ncr": "National Capital Region",
    "outside_ncr": "Outside the NCR",
}

DURATION_BINS = ("Under 1 year", "1-2 years", "2-3 years", "3+ years")

SENSITIVE_COLUMNS = ("full_name", "notes")
TWO_DECIMAL_SUFFIXES = ("total", "value", "dollars", "years")
PERCENTAGE_SUFFIX = "percentage"
