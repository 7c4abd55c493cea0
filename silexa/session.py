"""Session settings and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import io
import os
import pathlib
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(app: str = "silexa", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library expects; existing sessions are reused.

    Every setting is a default: whatever the cluster has set wins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, from ``spark.checkpoint.dir``.

    Only where the setting is missing on a single machine (tests) a temporary folder is made, which
    is deleted when Python ends; on a cluster, whose executors couldn't reach it, that is an error.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} has to name a folder that all executors can reach")
    made = tempfile.mkdtemp(prefix="silexa-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set(CHECKPOINT_KEY, f"file://{made}")
    return f"file://{made}"


_tables: dict[str, list[str]] = {}


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back.

    Unlike a cached or locally checkpointed frame the result survives the loss of executors,
    and unlike ``checkpoint()`` the files are columnar and compressed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/silexa/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _tables.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> int:
    """Deletes the tables that ``cut`` wrote in this application, when no frame made from them is needed; returns their number."""
    context = spark.sparkContext
    paths = _tables.pop(context.applicationId, [])
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, once per application.

    It goes through the shared folder. Nothing is done where PYTHONPATH already names the folder
    that holds the package.
    """
    context = spark.sparkContext
    package = pathlib.Path(__file__).resolve().parent
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if context.applicationId in _shipped or any(p and pathlib.Path(p).resolve() == package.parent for p in paths):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    target = f"{shared_dir(spark)}/silexa/{uuid.uuid4().hex}/silexa.zip"
    place = context._jvm.org.apache.hadoop.fs.Path(target)
    stream = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(target)
    _shipped.add(context.applicationId)
