"""Give Python workers on other machines this package, and texts in batches they can hold."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import admere

#: Rows of an Arrow batch.
ROWS = 512
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the session's Python files, once per application."""
    # texts are long: fewer rows to a batch keep workers and Arrow buffers small
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        root = os.path.dirname(os.path.abspath(admere.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="admere-"), "admere.zip")
        with zipfile.ZipFile(path, "w") as file:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith(".py"):
                        whole = os.path.join(folder, name)
                        file.write(whole, os.path.relpath(whole, os.path.dirname(root)))
        context.addPyFile(path)
    return spark
