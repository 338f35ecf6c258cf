"""Send this package to Python workers that cannot import it.

Workers import the modules that hold the functions they run. In local mode
they can where the package is installed, on PYTHONPATH or in the working
folder; a cluster's executors share none of these with the driver, so they
always get a copy of the source files by ``addPyFile`` (some 200 kB, once a
session).
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def reachable(home: Path) -> bool:
    """True if workers started from this environment find ``home``."""
    on_path = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    return any(Path(p).resolve() == home for p in [*on_path, os.getcwd()])


def ship_package(spark: SparkSession) -> None:
    package = Path(__file__).resolve().parent
    home, context = package.parent, spark.sparkContext
    if context.applicationId in _SENT or not package.is_dir():
        return
    is_local = context.master.startswith("local") and not context.master.startswith("local-cluster")
    if is_local and reachable(home):
        return
    target = Path(tempfile.mkdtemp(prefix="tallystar-")) / "tallystar_source.zip"
    with zipfile.ZipFile(target, "w") as z:  # the driver serves it to the executors
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(home))
    context.addPyFile(str(target))
    _SENT.add(context.applicationId)
