"""Session settings and durable intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillroll")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        # recording a stack trace for every column expression slows building plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Needed where the package is not installed on the workers: the Arrow
    functions import it there.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tillroll-zip-")) / "tillroll.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without it; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fresh = tempfile.mkdtemp(prefix="tillroll-")
    spark.conf.set("spark.checkpoint.dir", fresh)
    return fresh


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used for customer-level tables that several later passes or an iterative
    fit read: the upstream scan, joins and shuffles run once and a lost
    executor costs a re-read of Parquet, not a re-run of the history.  The
    tables of an application lie in one folder, which is removed when Python
    exits; ``stored_tables`` removes them earlier.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/tillroll/{spark.sparkContext.applicationId}"
    if folder not in _written:
        atexit.register(_remove, spark, folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(folder, []).append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_written: dict[str, list[str]] = {}


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table; what can't be deleted, as after the session has ended, stays for the folder's owner."""
    with contextlib.suppress(Exception):
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def stored_tables(spark: SparkSession) -> Iterator[None]:
    """Owns the tables that ``durable`` stores inside the block, and removes them at its end or error.

    For work whose results don't read them any more, as when these are written
    elsewhere.
    """
    folder = f"{shared_dir(spark)}/tillroll/{spark.sparkContext.applicationId}"
    before = len(_written.get(folder, []))
    try:
        yield
    finally:
        for path in _written.get(folder, [])[before:]:
            _remove(spark, path)
        del _written.get(folder, [])[before:]
