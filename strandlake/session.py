"""Session settings that the operators are written for."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "strandlake", master: str | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC; ``extra`` settings have ``_`` for ``.``."""
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("_", "."): v for k, v in extra.items()}
    builder = SparkSession.builder.appName(app).config(map=conf)
    return (builder.master(master) if master else builder).getOrCreate()


#: Bytes that go to a Python worker at once, unless the session says otherwise.
BATCH_BYTES = 4 << 20
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864", "67108864b")


def smaller_batches(spark: SparkSession) -> None:
    """Lower the session's bound on the bytes that a Python worker gets at once, if it is the default.

    Long texts make large batches. Applications call this, the registered queries too; operators
    leave a session's settings as they are.
    """
    if spark.conf.get(_BATCH, _BATCH_DEFAULT[1]) in _BATCH_DEFAULT:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def shipped(df: DataFrame) -> DataFrame:
    """``df`` again, with this package sent to the executors once, for functions that run in Python workers there."""
    context = df.sparkSession.sparkContext
    root = Path(__file__).resolve().parent
    if root.is_dir() and not getattr(context, "_strandlake_shipped", False):
        target = Path(tempfile.mkdtemp(prefix="strandlake-")) / "strandlake.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, Path(root.name) / path.relative_to(root))
        context.addPyFile(str(target))
        context._strandlake_shipped = True
    return df


def scratch_root(spark: SparkSession) -> str:
    """A folder of this application in the one that driver and executors share, named by ``spark.checkpoint.dir``.

    Where that is unset a local folder will do for a local master only; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.gettempdir()
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    return f"{whole}/strandlake-{spark.sparkContext.applicationId}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the scratch folder and read back.

    Cuts the lineage in a way that survives lost executors, and fixes the rows and splits that
    later passes see.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def removed(*frames: DataFrame) -> None:
    """Delete the files of tables given back by ``written`` that nothing reads any more."""
    for df in frames:
        root = scratch_root(df.sparkSession).removeprefix("file://").removeprefix("file:")
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if root in folder:
                _delete(df.sparkSession, folder)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this application has in the scratch folder, when its results are written elsewhere."""
    _delete(spark, scratch_root(spark))
