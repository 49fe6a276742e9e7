from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import DataFrame

FOLDER = "/root/testdata/sf0.001"

#: Columns that the operators use inside; a table may have its own of these names.
CLASHING = "row id hash size words w w0 pos fp leaf text_key _id _key _mix _copies _turn spans run kept found target"


@pytest.fixture(scope="session")
def folder() -> str:
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark):
    """Documents of (doc_id, text), with lang and source if given, and with clashing columns."""

    def build(rows: list[tuple], clash: bool = False) -> DataFrame:
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s") for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        if clash:
            for name in CLASHING.split():
                df = df.withColumn(name, df.doc_id)
        return df

    return build


def as_rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]
