"""Gives Python workers on other machines this package, where it is not installed there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application: the package's sources, served by the driver to every worker."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="florin-code-")) / "florin_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(_PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
