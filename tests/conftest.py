import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from limitlens import schemas  # noqa: E402
from limitlens.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def make_readings(spark):
    """Readings from short tuples: (eqp, spec, value, time text, upper, id)."""

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            eqp, spec, value, when, *rest = row
            upper = rest[0] if rest else 100.0
            reading = rest[1] if len(rest) > 1 else i
            at = datetime.fromisoformat(when)
            full.append(
                (eqp, spec, value, "P1", at, reading, upper, 0.0, "L1", "W1", at.date())
            )
        return spark.createDataFrame(full, schemas.READINGS)

    return build


@pytest.fixture
def make_catalog(spark):
    """Catalog from (eqp, spec, pattern, grade, unit) tuples."""

    def build(rows):
        return spark.createDataFrame(
            rows, "eqp_id STRING, spec_id STRING, pattern STRING, grade STRING, process_unit STRING"
        )

    return build


@pytest.fixture
def days(spark):
    def build(*texts):
        return spark.createDataFrame([(date.fromisoformat(t),) for t in texts], "d DATE")

    return build


def rows_of(df, *order):
    """Rows as plain tuples in a fixed order."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))
