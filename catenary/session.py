"""Reading the session's settings and cutting lineage in the shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LIVE: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; only where that is unset and Spark runs on one machine (tests) a local
    one of our own. On a cluster without it nothing can be written that all executors see, which is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="catenary-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Cut:
    """A DataFrame written once as Parquet to the shared folder and read back: its lineage starts at those files.

    Unlike checkpoint() it runs the plan once, is compressed and keeps size statistics; like it, it survives lost executors.
    drop() removes the files when nothing refers to them any more; the rest goes when the program ends. ``rows`` is their number,
    counted while they were written.
    """

    def __init__(self, df: DataFrame, name: str = "cut"):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/catenary-{name}-{uuid.uuid4().hex}"
        self._counted = Observation()
        df.observe(self._counted, F.count(F.lit(1)).alias("rows")).write.parquet(self.path)
        _LIVE[self.path] = self.spark
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    @property
    def rows(self) -> int:
        return self._counted.get["rows"]

    def drop(self) -> None:
        if _LIVE.pop(self.path, None):
            _delete(self.spark, self.path)


@atexit.register
def _clean() -> None:
    for path, spark in list(_LIVE.items()):
        try:
            _delete(spark, path)
        except Exception:  # the session is gone already
            pass


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python, once for each Spark context, by way of the shared folder."""
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_catenary_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("catenary", os.path.relpath(full, root)))
    path = f"{shared_dir(spark)}/catenary-code-{uuid.uuid4().hex}/catenary.zip"
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(path)
    sc._catenary_shipped = True
