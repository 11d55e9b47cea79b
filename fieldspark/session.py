"""Session helpers shared by every query: the package on the workers, shared folder, table reads."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ensure_importable(spark: SparkSession) -> SparkSession:
    """Ship this package to the executors, once an application, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        at = os.path.join(tempfile.mkdtemp(prefix="spark-"), "fieldspark.zip")  # the driver's own; Spark serves it
        with zipfile.ZipFile(at, "w") as z:
            for folder, _, files in os.walk(os.path.join(_ROOT, "fieldspark")):
                for f in files:
                    if f.endswith(".py"):
                        z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), _ROOT))
        spark.sparkContext.addPyFile(at)
        _SHIPPED.add(app)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); in local mode only, a temporary one if unset."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    at = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
