import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerlight import session as settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = (
        settings.builder("ledgerlight-tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def frame(spark):
    """A frame from rows whose timestamp columns are given as text."""

    def make(schema, *rows):
        columns = [part.split(" ", 1) for part in schema.split(", ")]
        names, kinds = [c[0] for c in columns], [c[1] for c in columns]
        timed = {n for n, k in zip(names, kinds, strict=True) if k == "timestamp"}
        typed = ", ".join(
            f"{n} {'string' if n in timed else k}" for n, k in zip(names, kinds, strict=True)
        )
        df = spark.createDataFrame(list(rows), typed)
        return df.withColumns({n: df[n].cast("timestamp") for n in timed}) if timed else df

    return make


@pytest.fixture
def rows():
    """Rows as sorted tuples, with timestamps as text."""

    def read(df, *columns):
        timed = [f.name for f in df.schema.fields if f.dataType.simpleString() == "timestamp"]
        df = df.withColumns({c: df[c].cast("string") for c in timed}) if timed else df
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=str)

    return read
