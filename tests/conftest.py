from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

from salestream.schema import WINDOW_SCHEMA

SF_DIR = "/root/testdata/sf0.001"
SALES = "sale_id string, category string, amount double, event_time timestamp"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")  # whole filters in plan texts
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(clock: str, day: str = "2024-11-25") -> datetime:
    return datetime.fromisoformat(f"{day}T{clock}")


def message(sale_id, category, amount, clock) -> str:
    return json.dumps({
        "id_pedido": sale_id,
        "categoria": category,
        "valor": amount,
        "timestamp": at(clock).isoformat(),
    })


@pytest.fixture
def windows_of(spark):
    """Rows (start clock, category, revenue, count) as one-minute windows."""

    def make(*rows):
        full = []
        for clock, category, revenue, count in rows:
            start = at(clock)
            full.append((start, start + timedelta(minutes=1), category, revenue, count))
        return spark.createDataFrame(full, WINDOW_SCHEMA)

    return make


def write_file(folder, number: int, lines: list[str]) -> None:
    """One input file per micro-batch; the source takes them by modification time."""
    path = os.path.join(folder, f"{number:04}.jsonl")
    with open(path, "w") as out:
        out.write("".join(line + "\n" for line in lines))
    os.utime(path, (1_700_000_000 + number,) * 2)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return [tuple(r) for r in picked.toLocalIterator()]


def rows_scanned(df) -> int:
    """Rows that left the file scans when ``df`` was run."""
    df._jdf.collectToPython()

    def walk(node):
        name = node.nodeName()
        if "Scan" in name:
            return node.metrics().get("numOutputRows").get().value()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        children = node.children()
        return sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())
