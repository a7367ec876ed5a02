"""Makes this library importable in Python workers, wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the library to the executors once, unless workers are started where they find it anyway."""
    app = spark.sparkContext.applicationId
    here = [os.path.abspath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    if app in _shipped or ROOT in here or os.path.exists(os.path.join(os.getcwd(), "quotarium", "shipping.py")):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="quotarium-"), "quotarium.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for top in ("quotarium", "corpus_pipeline.py"):
            own = os.path.join(ROOT, top)
            files = [own] if os.path.isfile(own) else [os.path.join(d, n) for d, _, names in os.walk(own) for n in names if n.endswith(".py")]
            for f in files:
                z.write(f, os.path.relpath(f, ROOT))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
