"""Sends this package to the Python workers of a session.

Operators with Python code need ``cartwright`` wherever a task runs. Jobs that
were submitted with ``--py-files``, or whose executors have it installed, need
nothing; for all others, the registered queries and the pipeline call this.
"""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import cartwright

_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application: the package as a zip file, which Spark hands to every executor."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = Path(cartwright.__file__).parents[1]
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='cartwright-')}/cartwright-package", "zip", root, "cartwright"
    )
    context.addPyFile(archive)
    _sent.add(context.applicationId)
