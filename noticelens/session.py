"""Session helpers: a local builder for tests and bench, and shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, NullType


def local_session(cpus: str | int = "*", app: str = "noticelens", **conf: str) -> SparkSession:
    """A local session for tests and bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a
    cluster without it is an error, since a machine-local folder dies with its
    executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a table under the shared folder and read it back.

    Unlike a checkpoint it is computed once, and filters and column selection reach the
    files. A table with a column of no type, which no file can hold, is checkpointed.
    """
    if any(isinstance(f.dataType, NullType) for f in df.schema):
        return cut_lineage(df)
    path = shared_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for tables whose partitions and their order matter later."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SMALL_ROWS = 200_000
SMALL_BYTES = 64 * 1024 * 1024


def is_small(table: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """Count a materialised table; if it has few rows, also add up their length as JSON."""
    if table.count() > max_rows:
        return False
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(c) for c in table.columns]))))
    return (table.agg(size).first()[0] or 0) <= SMALL_BYTES


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Materialise a summary table once and mark it for broadcast only if it is small.

    Otherwise the frame comes back without a hint, so the join shuffles and
    adaptive execution may still split its skewed partitions.
    """
    df = written(df, "side")
    return F.broadcast(df) if is_small(df, max_rows) else df


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    max_rows: int = SMALL_ROWS,
    salts: int = 16,
    materialised: bool = False,
    small: bool | None = None,
) -> DataFrame:
    """Join a table that is unique in ``on`` to rows whose keys may be very uneven.

    A small table is broadcast after measuring it. A larger one is repeated once
    per salt, so that a key holding a third of the rows is served by many tasks;
    ``spread`` names row columns that vary within a key, by default all plain ones.
    ``materialised`` says that the table is read from storage as it is, ``small``
    that its size was measured before.
    """
    if small is None:
        if not materialised:
            table = written(table, "lookup")
        small = is_small(table, max_rows)
    if small:
        return df.join(F.broadcast(table), on, how)
    if spread is None:
        plain = [f.name for f in df.schema if isinstance(f.dataType, AtomicType)]
        spread = [c for c in plain if c not in on] or on
    salt = free_name("_salt", df, table)
    salted = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = df.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    # The planner knows the size of the file only, not that of the repeated rows.
    return rows.join(salted.hint("merge"), [*on, salt], how).drop(salt)


def free_name(name: str, *frames: DataFrame) -> str:
    """The name, lengthened until no frame has a column of it; names are told apart without case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
