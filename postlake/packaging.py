"""The package as an archive that Spark hands to its executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

#: Rows and bytes that go to a Python worker at a time. Texts and pages are long, and a batch is held on both sides.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, and small batches."""
    context = spark.sparkContext
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    # Code only: the driver serves the archive to the executors, no task reads this folder.
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="postlake-")) / "postlake"), "zip", root.parent, root.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
