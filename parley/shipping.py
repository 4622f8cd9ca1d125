"""The package on the executors: functions that run in Python there import it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application; no setting of the session changes."""
    if (app := spark.sparkContext.applicationId) in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    if root.is_dir():  # else it was shipped here itself
        out = Path(tempfile.mkdtemp(prefix="parley-code-")) / "parley-code.zip"
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(out))
        atexit.register(shutil.rmtree, out.parent, ignore_errors=True)
