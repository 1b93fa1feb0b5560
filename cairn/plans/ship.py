"""Sends this package's modules to Python workers that can't import them."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application, unless PYTHONPATH or the working folder leads to the package already."""
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    ways = {Path(p or ".").resolve() for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), "."]}
    if app in _sent or root in ways:
        return
    target = Path(tempfile.mkdtemp(prefix="cairn-")) / "cairn.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.glob("cairn/**/*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
    _sent.add(app)
