"""Continuous scoring of arriving notices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from noticelens.sources.tables import complete_folders


def score_stream(
    spark: SparkSession,
    in_dir: str,
    schema: StructType | str,
    score: Callable[[DataFrame], DataFrame],
    out_dir: str,
    checkpoint: str,
    files: str = "*.parquet",
    max_files: int | None = None,
) -> StreamingQuery:
    """Score every new file of a folder and append the results as Parquet.

    ``in_dir`` may be a pattern of folders or files, whose files then have to match ``files``.
    Scoring is stateless, so there is no watermark and duplicate ids are scored
    again. The checkpoint makes a restart go on where the last run stopped.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        score(reader.parquet(in_dir))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", out_dir)
        .trigger(availableNow=True)
        .start()
    )


def write_batch(scored: DataFrame, batch: int, out_dir: str) -> None:
    """One folder a batch. A batch that is played again replaces its folder, so its rows are
    there once; ids that repeat, in a batch or across batches, stay."""
    scored.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch}")


def score_batches(
    spark: SparkSession,
    in_dir: str,
    schema: StructType | str,
    score: Callable[[DataFrame], DataFrame],
    out_dir: str,
    checkpoint: str,
    files: str = "*.parquet",
    max_files: int | None = None,
) -> StreamingQuery:
    """As ``score_stream``, into folders named by the number of the batch.

    A run that dies between a batch's write and its commit plays that batch again, with the
    same files; the folder is written anew and nothing is doubled.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(in_dir)
        .writeStream.foreachBatch(lambda rows, batch: write_batch(score(rows), batch, out_dir))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_batches(spark: SparkSession, out_dir: str) -> DataFrame:
    """The rows of all complete batches, with their number.

    A folder without its mark of success is one that is being written.
    """
    done = complete_folders(spark, f"{out_dir.rstrip('/')}/batch=*")
    if not done:
        raise ValueError(f"no complete batch in {out_dir}")
    return spark.read.option("basePath", out_dir).parquet(*done).withColumn("batch", F.col("batch").cast("long"))
