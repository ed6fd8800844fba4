"""Session factory, and shipping of this package to executors."""

from __future__ import annotations

import hashlib
import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(app: str = "evgraph", **conf: str) -> SparkSession:
    """A session with the settings the engine counts on: UTC and adaptive execution."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends the package's source to the executors, once for each context, so that Python workers can import it."""
    context = spark.sparkContext
    if getattr(context, "_evgraph_shipped", False):
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(path.relative_to(root.parent))), path.read_bytes())
    name = Path(tempfile.mkdtemp(prefix="evgraph-ship-"), f"evgraph-{hashlib.sha256(data.getvalue()).hexdigest()[:12]}.zip")
    name.write_bytes(data.getvalue())
    context.addPyFile(str(name))  # the driver serves it to executors
    context._evgraph_shipped = True
