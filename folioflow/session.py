"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
#: Bytes of a batch that goes to Python, unless the session sets them: with rows alone as a bound, long texts make batches of any size.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors once per application, so that their Python finds it, and bounds what a batch for Python weighs."""
    if not spark._jsparkSession.sessionState().conf().contains(BATCH_KEY):
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="folioflow-"), "folioflow.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("folioflow")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.jsonGenerator.ignoreNullFields", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)
