"""Session set-up, table loading and the shared scratch folder."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine relies on; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int = 8, app: str = "threadloom", **more: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = SETTINGS | {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    } | more
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_threadloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="threadloom-package-")
    archive = os.path.join(folder, "threadloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for base, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(base, name)
                    out.write(path, os.path.join("threadloom", os.path.relpath(path, package)))
    context.addPyFile(archive)  # the driver serves it to all executors
    context._threadloom_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that setting is absent (tests, local runs) a local folder is
    used, so that a cluster never gets a machine-local path.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), "threadloom-scratch")
    return folder.rstrip("/")


def release(spark: SparkSession) -> None:
    """Give up shuffle files of finished jobs now; they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Written tables that cut lineage and survive the loss of executors.

    Every table goes to the shared folder and is removed when ``drop`` is
    called, or at the latest when the driver ends.
    """

    def __init__(self, spark: SparkSession, label: str = "job"):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/threadloom-{label}-{uuid.uuid4().hex[:12]}"
        self._paths: dict[str, str] = {}
        self._count = 0
        atexit.register(self.close)

    def save(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` and return the written table; an older one of that name goes."""
        self._count += 1
        path = f"{self.root}/{name}-{self._count}"
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        old, self._paths[name] = self._paths.get(name), path
        if old:
            self._delete(old)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, name: str) -> str:
        """Where the table of that name is written."""
        return self._paths[name]

    def drop(self, *names: str) -> None:
        for name in names:
            path = self._paths.pop(name, None)
            if path:
                self._delete(path)

    def close(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # noqa: BLE001 - the session may be gone already
            pass

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
