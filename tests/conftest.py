import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.sql.codegen.wholeStage": "false"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluates column expressions over one row of literals."""
    from pyspark.sql import functions as F

    def evaluate(*columns):
        row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return row[0] if len(columns) == 1 else tuple(row)

    evaluate.lit = F.lit
    return evaluate
