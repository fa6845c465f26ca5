"""The session's settings, and shipping this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable by the Python workers of a session that is already running."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="tramline-code-"), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def session(name: str = "tramline", master: str = "local[8]", **settings: str) -> SparkSession:
    """A local session with the settings that the engine expects: UTC, adaptive plans, Arrow."""
    builder = SparkSession.builder.appName(name).master(master)
    own = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    return builder.config(map=own | settings).getOrCreate()
