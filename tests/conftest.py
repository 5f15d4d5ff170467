import datetime as dt
import os

import pytest
from pyspark.sql import SparkSession

from checks import registry
from checks.compare import connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    return registry.tables(spark, sf_dir)


@pytest.fixture(scope="session")
def stored(tables, tmp_path_factory):
    """The shared tables, written once."""
    return tables.write_to(str(tmp_path_factory.mktemp("tables")))


@pytest.fixture(scope="session")
def make(spark):
    """DataFrame from a DDL schema and rows; ISO text becomes a date in date columns."""

    def build(schema, rows):
        dates = [part.strip().split()[1].lower() == "date" for part in schema.split(",")]
        fixed = [
            tuple(dt.date.fromisoformat(v) if is_date and v else v for v, is_date in zip(row, dates)) for row in rows
        ]
        return spark.createDataFrame(fixed, schema)

    return build


@pytest.fixture(scope="session")
def tour_rows(make):
    """Measured tours from (person, tour, start, end, departure type, ...) rows."""
    from tourledger.operators import spells

    schema = (
        "full_name string, tour_number int, cds_start_date date, cds_end_date date, departure_type string, "
        "discipline_initial string, initial_staffing_program string, location_initial string, "
        "location_most_recent string, arrival_source string, onboarding_status string, notes string"
    )
    defaults = (None, "Design", "(default)", "Here", "Here", "from_academia", "onboarded", "n")

    def build(rows, as_of=dt.date(2022, 10, 1)):
        full = [tuple(row) + defaults[len(row) - 4 :] for row in rows]
        df = make(schema, full)
        return spells.add_duration(spells.add_effective_end(spells.add_fiscal_years(df), as_of))

    return build
