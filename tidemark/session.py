"""Session construction and the shared workspace used to cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", name: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings this library expects; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.master(master).appName(name)
    for k, v in (SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a session on this one machine gets a temporary one
    where that is unset (tests); on a cluster it must be set."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own[app] = f"file://{folder}"
    return _own[app]


def _home(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Remove all that this application has left in the shared folder; results that are still to be read need it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_home(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Workspace:
    """Tables written to the shared folder, so that iterative operators survive the loss of executors.

    Every ``save`` writes one Parquet table and reads it back, which ends the lineage; ``drop`` removes it
    once a later round has replaced it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{_home(spark)}/{label}-{uuid.uuid4().hex}"
        self.count = 0

    def path(self, label: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:04d}-{label}"

    def save(self, df: DataFrame, label: str = "t", partition_by: str | None = None, measure: Column | None = None) -> tuple[DataFrame, int]:
        """The stored table and its number of rows, or another aggregate of them, found while it is written."""
        at, seen = self.path(label), Observation()
        writer = df.observe(seen, (F.count(F.lit(1)) if measure is None else measure).alias("n")).write.option("compression", "zstd")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(at)
        back = self.spark.read.schema(df.schema).parquet(at)
        back._tidemark_at = at
        return back, int(seen.get["n"] or 0)

    def read(self, tables: list[DataFrame]) -> DataFrame:
        """Several stored tables of one schema as one scan."""
        return self.spark.read.schema(tables[0].schema).parquet(*(t._tidemark_at for t in tables))

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            self.remove(t._tidemark_at)

    def remove(self, at: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers of the session this package, once; they need it wherever rows pass through Python."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        home = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="tidemark-ship-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        with zipfile.ZipFile(os.path.join(folder, "tidemark.zip"), "w") as z:
            for at, _, names in os.walk(home):
                for n in names:
                    if n.endswith(".py"):
                        z.write(os.path.join(at, n), os.path.relpath(os.path.join(at, n), os.path.dirname(home)))
        spark.sparkContext.addPyFile(os.path.join(folder, "tidemark.zip"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
