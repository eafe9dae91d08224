"""Session helpers: a local session for tests and benchmarks, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))


def local_session(cpus: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """In local mode, make this package importable in Python workers however the driver found it; once for each Spark
    context. On a cluster it is installed or passed with ``--py-files`` as usual."""
    sc = spark.sparkContext
    if getattr(sc, "_tallyforge_shipped", False) or not sc.master.startswith("local["):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "tallyforge.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(_HERE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tallyforge", os.path.relpath(full, _HERE)))
    sc.addPyFile(path)
    sc._tallyforge_shipped = True
