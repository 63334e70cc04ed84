"""Make the package importable for the Python workers of any cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send a zip of this package to the workers, once per application. Files the driver adds later are not sent again."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    root = Path(__file__).resolve().parents[1]
    if root.is_dir():
        target = Path(tempfile.mkdtemp(prefix="tarmac-")) / "tarmac.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
            for source in sorted(root.rglob("*.py")):
                archive.write(source, source.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(target))
    _sent.add(app)
