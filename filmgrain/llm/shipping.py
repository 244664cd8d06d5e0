"""The package's own modules, sent to the executors that run its Python.

Batches of ten thousand whole texts would be large; where the session leaves Spark's
default, they are made smaller, which bounds a worker's memory and changes no result.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the Python path of all executors, once per application."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))  # Spark serves it to executors that join later, too
        _SHIPPED.add(context.applicationId)
    return spark
