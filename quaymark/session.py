"""Session defaults, and shipping of this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Defaults that the library relies on; everything else is the cluster's choice.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles a method of more bytecode than this: such stages run operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
_SHIPPED: set[str] = set()


def build_session(name: str = "quaymark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="quaymark-"), f"{root.name}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark


def in_small_batches(spark: SparkSession, rows: int = 512, size: str = "4m") -> SparkSession:
    """Ship the package, and bound the Arrow batches of the session's queries: a worker holds a batch of pages and its results."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return spark


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, for plans that read it in several branches.

    The folder is the session's ``spark.checkpoint.dir``; a local one is used only where everything runs in
    one process and none is named.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local[") and context.master != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "quaymark-checkpoints"))
    # A checkpoint runs its plan twice, once to count and once to write: the rows are held in between.
    held = df.persist()
    out = held.checkpoint()
    held.unpersist()
    return out
