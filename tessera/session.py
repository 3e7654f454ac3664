"""The session: sources sent to the executors, and tables kept in the shared scratch folder."""

from __future__ import annotations

import atexit
import pathlib
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_SCRATCH: list[str] = []
_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package's sources to the executors, once for each application, so that functions pickled by name load there.

    Unless the session sets it, Arrow batches get 1,000 rows rather than 10,000: texts and pages are long, and a batch is
    in memory on both sides. The archive stays until the driver ends, since executors that join later fetch it from the driver.
    """
    context = spark.sparkContext
    if spark.conf.get(_RECORDS) == "10000":  # Spark's default
        spark.conf.set(_RECORDS, "1000")
    if context.applicationId not in _SHIPPED:
        top = pathlib.Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="tessera-src-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        at = pathlib.Path(folder, "tessera.zip")
        with zipfile.ZipFile(at, "w") as z:
            for source in sorted(top.rglob("*.py")):
                z.write(source, f"tessera/{source.relative_to(top)}")
        context.addPyFile(str(at))
        _SHIPPED.add(context.applicationId)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where the session names none, a temporary one for a local master, as in tests; on a cluster, an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _SCRATCH:
            _SCRATCH.append(tempfile.mkdtemp(prefix="tessera-"))
            atexit.register(shutil.rmtree, _SCRATCH[0], ignore_errors=True)
        at = _SCRATCH[0]
    return at.rstrip("/")


def stored(df: DataFrame, *by: str) -> DataFrame:
    """df written once to the scratch folder and read back: later readers don't compute it again, and a lost executor costs nothing."""
    at = f"{scratch_dir(df.sparkSession)}/tessera-{uuid.uuid4().hex}"
    out = df.write
    (out.partitionBy(*by) if by else out).parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
