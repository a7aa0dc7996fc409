"""Makes this package importable in Python workers that do not start beside it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="gablework-")) / "gablework_sources.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
