"""Send this package to the executors of a session, for sessions that were started without it on their path."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Add a zip of the package to the session's Python files, once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_editlake_shipped", False):
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="editlake-")) / "editlake.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(here.rglob("*.py")):
            z.write(path, path.relative_to(here.parent))
    sc.addPyFile(str(target))
    sc._editlake_shipped = True
