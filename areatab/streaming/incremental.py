"""Incremental tabulation with Structured Streaming.

Entity files that land in a folder over time (a census delivered in parts)
are counted as they arrive instead of re-running the whole tabulation:

    readStream(files, explicit schema)
      -> stream-static join with the area map   (area key per entity row)
      -> unpivot variables                        (same as batch)
      -> groupBy(id_geo, codigo_variable, valor_categoria).count()   [state]
      -> foreachBatch: write the current table as a new version

The aggregation state is keyed by (area, variable, category), bounded by
geography x questionnaire, not by people. State and source offsets live in
the checkpoint folder on shared storage, so a restarted query (or one whose
executors were lost) resumes from the last committed micro-batch and never
counts a file twice. ``availableNow`` processes what is there and stops,
which makes the same code usable as a scheduled batch job.

Every micro-batch publishes a folder of its own; readers take the newest one
that is complete, so they never meet a table that is being replaced. The
version before it stays for readers that have begun, older ones go.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areatab.operators.frequency import unpivot_variables
from areatab.session import scratch_path

VERSION = "version="
KEPT = 2


def stream_frequencies(
    rows: DataFrame,
    variables: Mapping[str, Column | str],
    area_map: DataFrame | None = None,
    fk: str | None = None,
    key: str | None = None,
    null_policy: str = "keep",
) -> DataFrame:
    """Streaming frequency table (a stateful aggregation) over entity rows.

    With ``area_map`` (static ``(key, id_geo)``), rows get their area by a
    stream-static inner join on ``rows.fk = area_map.key``; otherwise rows
    must carry ``id_geo``.
    """
    src = rows
    if area_map is not None:
        m = area_map.select(F.col(key).alias(fk), "id_geo")
        src = src.join(m, fk, "inner")
    src = src.filter(F.col("id_geo").isNotNull())
    long = unpivot_variables(src, variables, ("id_geo",), null_policy)
    return long.groupBy("id_geo", "codigo_variable", "valor_categoria").agg(F.count(F.lit(1)).alias("conteo"))


def run_incremental(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    variables: Mapping[str, Column | str],
    out_dir: str,
    checkpoint: str,
    area_map: DataFrame | None = None,
    fk: str | None = None,
    key: str | None = None,
    null_policy: str = "keep",
    file_format: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> None:
    """Count everything that arrived in ``source`` since the last run, then stop.

    The full current table is written to ``out_dir`` at the end of each
    micro-batch (complete mode). The area map is worked out once and written
    to the shared folder, so a micro-batch reads it instead of joining it anew.
    """
    if area_map is not None:
        path = scratch_path(spark, "area-map")
        area_map.select(key, "id_geo").write.parquet(path)
        area_map = spark.read.schema(area_map.select(key, "id_geo").schema).parquet(path)
    reader = spark.readStream.schema(schema).format(file_format)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(source)
    agg = stream_frequencies(rows, variables, area_map, fk, key, null_policy)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{out_dir}/{VERSION}{batch_id:012d}")
        fs, path = _folder(spark, out_dir)
        for old in versions(spark, out_dir)[:-KEPT]:
            fs.delete(path(f"{out_dir}/{old}"), True)

    q = (
        agg.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _folder(spark: SparkSession, out_dir: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(out_dir).getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, out_dir: str) -> list[str]:
    """Names of the complete versions, oldest first."""
    fs, path = _folder(spark, out_dir)
    done = fs.globStatus(path(f"{out_dir}/{VERSION}*/_SUCCESS")) or []
    return sorted(f.getPath().getParent().getName() for f in done)


def read_result(spark: SparkSession, out_dir: str) -> DataFrame:
    """The newest complete version of the table."""
    schema = "id_geo string, codigo_variable string, valor_categoria string, conteo long"
    found = versions(spark, out_dir)
    if not found:
        raise FileNotFoundError(f"no complete version in {out_dir}")
    return spark.read.schema(schema).parquet(f"{out_dir}/{found[-1]}")
