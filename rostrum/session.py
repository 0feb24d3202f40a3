"""Sessions, and the package's own code on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

HERE = Path(__file__).resolve().parent


def session(master: str = "local[*]", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for local work; on a cluster, use the one that is given."""
    b = SparkSession.builder.master(master).appName("rostrum")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in (settings | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Rows and bytes of an Arrow batch that is handed to a Python function, where the session has not set its own: texts and pages can be long.
BATCH_ROWS, BATCH_BYTES = "256", str(4 << 20)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that a worker's memory does not grow with the rows of a task; a value that the session has set itself stays."""
    for key, value, default in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS, "10000"), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES, str(2**31 - 1))):
        if spark.conf.get(key, default) in (default, "-1", "2147483647b", "9223372036854775807", "9223372036854775807b"):
            spark.conf.set(key, value)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a context, so that Python functions can be loaded there, and keep their batches small."""
    small_batches(spark)
    sc = spark.sparkContext
    if getattr(sc, "_rostrum_shipped", False):
        return
    path = Path(tempfile.mkdtemp(prefix="rostrum-code-")) / "rostrum.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(HERE.rglob("*.py")):
            z.write(f, f.relative_to(HERE.parent))
    sc.addPyFile(str(path))
    sc._rostrum_shipped = True
