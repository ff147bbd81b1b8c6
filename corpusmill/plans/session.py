"""What a session needs before queries run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable for the session's Python workers, once per application.

    Nothing is sent where the workers find it by themselves: through PYTHONPATH, or in the folder the
    driver runs in. Otherwise its sources go out as one archive with the application's files.
    """
    context = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    known = {os.path.realpath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p}
    if context.applicationId in _shipped or os.path.realpath(root) in known or not os.path.isdir(package):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="corpusmill-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
