import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyframe.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def bounds(spark):
    """Set `spark.tallyframe.*` bounds for one test."""
    changed = []

    def set_bounds(**values):
        for key, value in values.items():
            name = f"spark.tallyframe.{key}"
            spark.conf.set(name, str(value))
            changed.append(name)

    yield set_bounds
    for name in changed:
        spark.conf.unset(name)


@pytest.fixture
def reports(spark):
    """Four raw reports, reduced to the columns cleaning looks at."""
    names = ["component_name", "product_name", "assignee_name", "resolution_code", "status_code",
             "quantity_of_votes", "quantity_of_comments", "bug_fix_time", "severity_code", "reporter_name"]
    # Fixed values.
    return spark.createDataFrame([
        ("engine", "product_123", "serg.boyko2011", 1, 4, 0, 0, 2, 2, "a"),
        ("UI", "product_69", "sergg.boyko2011", 1, 6, 0, 4, 10, 2, "b"),
        ("UI", "product_69", "jdt-ui-inbox", 1, 4, 0, 3, 777, 1, "c"),
        ("UI", "product_69", "jdt-ui-inbox", 1, 4, 0, 3, 20, 1, "c"),
    ], names)
