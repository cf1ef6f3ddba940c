"""Python tasks import this library, so its sources go to the executors with the application."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent


@functools.cache
def _ship(application_id: str) -> str:
    archive = Path(tempfile.mkdtemp(prefix="library-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(PACKAGE.rglob("*.py")):
            packed.write(source, source.relative_to(PACKAGE.parent))
    return str(archive)


def ship(spark: SparkSession) -> None:
    """Send the sources once for each application; Spark's file server hands them to every executor."""
    spark.sparkContext.addPyFile(_ship(spark.sparkContext.applicationId))
