"""Sending this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable in all Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    root = Path(__file__).resolve().parents[1]
    out = os.path.join(tempfile.mkdtemp(prefix="linecorpus-"), "linecorpus.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    spark.sparkContext.addPyFile(out)
    _sent.add(app)
