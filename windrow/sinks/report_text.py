"""Write a report as text."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame

# Fixed value: the time in the name of a report.
NAME_TIME = "%Y-%m-%d_%H-%M-%S"


def report_name(spark, at: datetime | None = None) -> str:
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    return f"training_metrics_{(at or datetime.now(zone)).strftime(NAME_TIME)}.txt"


def write_report(lines: DataFrame, folder: str, at: datetime | None = None, mode: str = "errorifexists") -> str:
    """Write ``section, item, n, line`` rows in order; returns the path, named after the time.

    The path is a folder with one text file. A report has some lines per epoch, so one task writes it.
    """
    path = f"{folder.rstrip('/')}/{report_name(lines.sparkSession, at)}"
    ordered = lines.repartition(1).sortWithinPartitions("section", "item", "n")
    ordered.select("line").write.mode(mode).text(path)
    return path
