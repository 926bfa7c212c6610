import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tillmark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        4, **{"spark.checkpoint.dir": f"file:{shared}", "spark.sql.warehouse.dir": str(shared / "warehouse")}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluate a column function on literal rows: one result per input tuple."""

    def run(rows, function, columns=("a",)):
        schema = ", ".join(f"{name} string" if " " not in name else name for name in ("_id long", *columns))
        table = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)
        names = [name.split()[0] for name in columns]
        from pyspark.sql import functions as F

        result = table.select("_id", function(*[F.col(name) for name in names]).alias("result"))
        return [row.result for row in result.orderBy("_id").collect()]

    return run
