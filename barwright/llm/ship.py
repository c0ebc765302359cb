"""Makes this library importable in Python workers that don't have it installed, and bounds what they get at once."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()

#: Texts can be long, so batches for Python are bounded by bytes unless the session says so itself.
_BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, and bound Arrow batches."""
    if spark.conf.get(_BATCH_BYTES[0], None) is None:
        spark.conf.set(*_BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="barwright-code-")
    archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)
    _sent.add(context.applicationId)
