"""Session settings, shared work folders and table access."""

from __future__ import annotations

import json
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, app: str = "lakekit", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC, AQE with skew-join splitting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # also split a hot key when the next aggregation would otherwise reuse the join's partitioning
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Root for written intermediate results: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there driver and executors share
    one machine; on a cluster a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="lakekit-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing has to be cleared first."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return the read-back table (lineage is cut)."""
    path = work_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    # what was shuffled for the table is of no use once it is written; left alone it fills the disks until the driver's next full GC
    with settings(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` returned, once no frame that reads them will be used again."""
    for table in tables:
        file = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.inputFiles()[0])
        file.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(file.getParent(), True)


def small_rows(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A few metadata rows as a one-partition frame, built in the JVM from one literal."""
    listed = F.from_json(F.lit(json.dumps(rows)), f"ARRAY<STRUCT<{', '.join(_fields(ddl))}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(listed))


def _fields(ddl: str) -> list[str]:
    return [f"{f.name}: {f.dataType.simpleString()}" for f in StructType.fromDDL(ddl).fields]


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings (double underscores for dots) for the duration of a block, then as before."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Schemas of tables by session, path and the state that the file system tells.
_SCHEMAS: dict[tuple, StructType] = {}


def _file_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """Time and length of a file or folder; a table that is written again has another."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(place)
    return status.getModificationTime(), status.getLen()


class Tables:
    """Lazy access to the tables of one data folder: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        file = f"{self.path}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, file, *_file_state(self.spark, file))
        if key not in _SCHEMAS:  # reading a footer is a Spark job of its own, done once per state of a table
            _SCHEMAS[key] = self.spark.read.parquet(file).schema
        return self.spark.read.schema(_SCHEMAS[key]).parquet(file)

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Run SQL over the tables (and extra frames) it names as ``{name}``."""
        used = {name: getattr(self, name) for name in TABLES if "{" + name + "}" in text}
        return self.spark.sql(text, **{**used, **frames})
