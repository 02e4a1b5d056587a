"""Session for local runs, and the two ways intermediate results are made durable.

``stage`` is for tables that several later jobs read: it writes Parquet below the folder named by
``spark.checkpoint.dir``, so lost executors cost a re-read, not a recomputation, and later jobs
still get column pruning.

``pin`` is for fitted summaries (cut points, limits, per-group totals): it is staged as well, and
broadcast in joins if what was written is at most ``PIN_BYTES``; so the large side of the join is
not shuffled on a hot key. A larger summary is joined as Spark sees fit.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

PIN_BYTES = 8 << 20

# Arrow's types for Spark's plain ones.
ARROW = {
    "boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
}

# Runtime settings that pay off for these queries on any cluster. HotSpot never compiles a method
# above 8000 bytes of bytecode; with this limit Spark splits such operators instead of fusing them
# into one method that would stay interpreted.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_dir: str | None = None


def local_session(cores: int | str = "*", app: str = "riskloom", **conf) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", _own_folder())
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session, for instance the one a cluster hands out."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def _own_folder() -> str:
    """A folder for sessions of this process that run in it alone; it goes when the process ends."""
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="riskloom-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def staging_dir(spark: SparkSession) -> str:
    """The folder that the session names, which all executors share.

    A session without one gets a folder of its own where driver and executor are one process, and
    an error anywhere else.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        named = context._jsc.sc().getCheckpointDir()
        configured = named.get() if named.isDefined() else None
    if configured:
        return configured.rstrip("/")
    if context.master.startswith("local-cluster") or not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder()


def store_of(spark: SparkSession, path: str):
    """Spark's own file system for a path, and the path as it takes it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new path below the staging folder."""
    return f"{staging_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pin(df: DataFrame) -> DataFrame:
    """Compute a summary once; broadcast in joins if its written size is at most ``PIN_BYTES``."""
    spark = df.sparkSession
    path = fresh_path(spark, "pin")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    store, place = store_of(spark, path)
    return F.broadcast(back) if store.getContentSummary(place).getLength() <= PIN_BYTES else back


def any_row(pinned: DataFrame, condition: str) -> bool:
    """Does a row of a pinned summary meet the condition."""
    return bool(pinned.filter(condition).limit(1).collect())


def arrow_type(kind: T.DataType) -> pa.DataType:
    """What Spark sends to and takes from Python workers for a column of this type."""
    if isinstance(kind, T.ArrayType):
        return pa.list_(pa.field("element", arrow_type(kind.elementType)))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, arrow_type(f.dataType)) for f in kind])
    return ARROW[kind.simpleString()]


def arrow_schema(ddl: str) -> pa.Schema:
    """Told from the text alone; asking Spark for it takes a job."""
    return pa.schema([pa.field(f.name, arrow_type(f.dataType)) for f in T.StructType.fromDDL(ddl)])


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of parameters or fitted values (a handful of rows) as a local relation."""
    types = arrow_schema(schema)
    columns = [pa.array([row[i] for row in rows], type=f.type) for i, f in enumerate(types)]
    return spark.createDataFrame(pa.table(columns, schema=types), schema=T.StructType.fromDDL(schema))
