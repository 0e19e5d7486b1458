import datetime as dt

import pytest
from pyspark.sql import functions as F

from palaver.session import build_session

UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


@pytest.fixture(scope="session")
def make(spark):
    """Comments from dicts; columns left out get plain values."""

    def build(rows):
        filled = []
        for number, row in enumerate(rows):
            base = {
                "author": "ann",
                "author_flair_text": None,
                "score": 1,
                "id": f"x{number}",
                "permalink": f"/p/{number}",
                "body": "some words",
                "created_utc": at("2024-03-01 12:00:00"),
                "parent_id": "t3_s",
            }
            base.update(row)
            filled.append(tuple(base.values()))
        frame = spark.createDataFrame(
            filled,
            "author string, author_flair_text string, score int, id string, permalink string, body string, "
            "created_utc timestamp, parent_id string",
        )
        return frame.withColumn("dt_date", F.to_date(F.col("created_utc") - F.expr("INTERVAL 7 HOURS")))

    return build


@pytest.fixture(scope="session")
def value(spark):
    """The value of an expression over one text column ``v``."""

    def of(expr, v, kind="string"):
        return spark.createDataFrame([(v,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first()["r"]

    return of


def rows(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
