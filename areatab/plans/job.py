"""The full, resumable census run.

Stages, each materialised under ``out_dir`` on shared storage:

1. ``frecuencias/``: the frequency table, one folder per fingerprint and
   variable. A variable's fingerprint covers the input files, the rows' plan
   (joins, filters, exclusions), its expression and the NULL policy, and it is
   part of the folder's name, so it is on disk before the first row and no
   crash can part the two. A run takes over just the folders whose fingerprints
   it asks for; whatever was made from other inputs or with other options is
   another folder and is never published. Dynamic partition overwrite publishes
   a variable's folder at job commit, so a crashed run leaves no half-written
   variable. Writing also cuts the lineage: everything after reads this table,
   so a lost executor later costs a re-read, not the fact joins.
2. ``largo/``: the published long table of the requested variables, labelled,
   range-partitioned and sorted by ``id_geo``.
3. ``metadatos/``: the category x variable dictionary.
4. ``manifiesto/``: one row per requested variable with status (success =
   computed now, skipped = reused from an earlier run, empty, error with its
   text), rows and the fingerprint of the inputs.

The last three are published together: each run writes them to a new folder
under ``versiones/`` and then moves the pointer ``actual`` there (see
``operators.snapshot``); ``read_current`` never sees parts of two runs.

The list of variable codes is metadata (bounded by the questionnaire), so
reading the produced partition names on the driver is fine; no data rows and
no list of files go through the driver.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areatab.operators import areas, labels, publish, snapshot
from areatab.operators.broadcast import literal_broadcast
from areatab.operators.frequency import frequencies_multi
from areatab.plans.census import Census

FREQ_SCHEMA = T.StructType(
    [
        T.StructField("id_geo", T.StringType()),
        T.StructField("valor_categoria", T.StringType()),
        T.StructField("conteo", T.LongType()),
        T.StructField("clave", T.StringType()),
        T.StructField("codigo_variable", T.StringType()),
    ]
)


@dataclass
class RunResult:
    frecuencias: str
    largo: str
    metadatos: str
    manifiesto: str
    computed: list[str]
    skipped: list[str]


def _read_freq(spark: SparkSession, path: str) -> DataFrame:
    """The frequency folders; an empty table if nothing has been written yet."""
    try:
        return spark.read.schema(FREQ_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FREQ_SCHEMA)


def fingerprint(spark: SparkSession, frames: Sequence[DataFrame]) -> str:
    """Hash of the input files (path, length, modification time) behind ``frames``.

    File metadata only: the ``binaryFile`` source lists the files and the
    unused ``content`` column is pruned, so no data is read. The files' hashes
    are added up in Spark; one row comes back, however many files there are.
    """
    files = sorted({f for df in frames for f in df.inputFiles()})
    if not files:
        return hashlib.sha256(b"").hexdigest()[:32]
    meta = spark.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
    # four sums of 32-bit parts: independent of the order, no overflow
    hashes = [F.xxhash64("path", "length", F.unix_micros("modificationTime"), F.lit(k)) for k in (1, 2)]
    parts = [F.sum(F.pmod(h, F.lit(1 << 32))) for h in hashes] + [F.sum(F.shiftrightunsigned(h, 32)) for h in hashes]
    row = meta.agg(F.count(F.lit(1)), F.sum("length"), *parts).first()
    return hashlib.sha256("|".join(map(str, row)).encode()).hexdigest()[:32]


def variable_keys(huella: str, sources: Mapping[str, tuple[DataFrame, Mapping]], null_policy: str) -> dict[str, str]:
    """``{code: fingerprint}``: inputs, the rows' canonical plan, the variable's expression and the NULL policy."""
    keys = {}
    for rows, variables in sources.values():
        plan = rows._jdf.queryExecution().analyzed().canonicalized().toString()
        for code, expr in variables.items():
            text = "\n".join((huella, plan, code, str(expr), null_policy))
            keys[code] = hashlib.sha256(text.encode()).hexdigest()[:32]
    return keys


def failing_variables(rows: DataFrame, variables: Mapping) -> dict[str, str]:
    """``{code: message}`` of the expressions that the rows can't provide (analysis only)."""
    errors = {}
    for code, expr in variables.items():
        try:
            rows.select(F.col(expr) if isinstance(expr, str) else expr).schema  # noqa: B018
        except AnalysisException as e:
            errors[code] = str(e).strip().splitlines()[0]
    return errors


def produced_keys(spark: SparkSession, freq_dir: str) -> set[str]:
    """Fingerprints that already have a folder (partition values only)."""
    return {r[0] for r in _read_freq(spark, freq_dir).select("clave").distinct().collect()}


def run_resumable(
    spark: SparkSession,
    sources: Mapping[str, tuple[DataFrame, Mapping]],
    publish_fn: Callable[[DataFrame], DataFrame],
    out_dir: str,
    inputs: Sequence[DataFrame] = (),
    variable_labels: DataFrame | None = None,
    null_policy: str = "keep",
    resume: bool = True,
) -> RunResult:
    """Run (or resume) a tabulation into ``out_dir``; see the module notes.

    ``sources`` maps each entity to ``(rows with id_geo, {code: column})``;
    ``publish_fn`` turns the frequency table into the published long table
    (area and category labels); ``inputs`` are the frames whose files make up
    the input fingerprint. A variable that the rows can't provide is reported
    with status ``error``; the others run.
    """
    freq_dir = os.path.join(out_dir, "frecuencias")
    huella = fingerprint(spark, list(inputs))
    keys = variable_keys(huella, sources, null_policy)
    done = produced_keys(spark, freq_dir) if resume else set()
    computed, skipped, parts, errors = [], [], [], {}
    for rows, variables in sources.values():
        failing = failing_variables(rows, variables)
        errors |= failing
        todo = {code: expr for code, expr in variables.items() if keys[code] not in done and code not in failing}
        skipped += [code for code in variables if keys[code] in done and code not in failing]
        if todo:
            computed += list(todo)
            parts.append((rows, todo))
    if parts:
        new = frequencies_multi(parts, null_policy=null_policy)
        names = spark.createDataFrame([(c, keys[c]) for c in computed], "codigo_variable string, clave string")
        new = new.join(literal_broadcast(names), "codigo_variable")
        publish.write_by_variable(
            new.select("id_geo", "valor_categoria", "conteo", "clave", "codigo_variable"), freq_dir, keys=("clave",)
        )

    wanted = [keys[c] for c in computed + skipped]
    freq = _read_freq(spark, freq_dir).where(F.col("clave").isin(wanted)).drop("clave")
    version = snapshot.new_version(out_dir)
    version_dir = snapshot.folder(out_dir, version)
    long_dir = os.path.join(version_dir, "largo")
    publish.write_long(publish_fn(freq), long_dir)

    long_back = publish.read_long(spark, long_dir)
    meta_dir = os.path.join(version_dir, "metadatos")
    publish.export(publish.to_metadata(long_back, variable_labels), meta_dir)

    man_dir = os.path.join(version_dir, "manifiesto")
    req = spark.createDataFrame([(c,) for c in keys], "codigo_variable string")
    manifest = publish.run_manifest(req, publish.produced_variables(freq), computed + skipped, errors)
    if skipped:
        # produced by an earlier run over the same inputs, with the same options, and reused as is
        manifest = manifest.withColumn(
            "status",
            F.when((F.col("status") == "success") & F.col("codigo_variable").isin(skipped), F.lit("skipped")).otherwise(F.col("status")),
        )
    manifest = manifest.withColumn("huella", F.lit(huella))
    manifest.write.mode("overwrite").parquet(man_dir)
    snapshot.publish(spark, out_dir, version)
    return RunResult(freq_dir, long_dir, meta_dir, man_dir, computed, skipped)


def run_census(
    census: Census,
    out_dir: str,
    entities: Sequence[str] = ("PERSONA", "HOGAR", "VIVIENDA"),
    null_policy: str = "keep",
    resume: bool = True,
    hot_rows: int | None = None,
) -> RunResult:
    """Run (or resume) the census tabulation of the test-table model into ``out_dir``.

    ``hot_rows`` salts entity joins for parents with more children than that
    (explicit skew handling; by default AQE splits skewed partitions).
    """
    sources = {ent: (census.entity(ent, hot_rows=hot_rows), census.variables[ent]) for ent in entities}
    lab = labels.add_sentinel(labels.clean_labels(census.raw_labels(), "linea"), census.variable_codes())

    def publish_fn(freq: DataFrame) -> DataFrame:
        labelled = areas.label_areas(freq, census.provinces(), census.departments())
        return publish.to_long(labels.attach_labels(labelled, lab))

    tables = ["lineitem", "orders", "customer", "nation", "region"]
    return run_resumable(census.spark, sources, publish_fn, out_dir, [census.table(t) for t in tables],
                         census.variable_labels(), null_policy, resume)


def _tables(spark: SparkSession, largo: str, metadatos: str, manifiesto: str) -> dict[str, DataFrame]:
    return {"largo": publish.read_long(spark, largo), "metadatos": spark.read.parquet(metadatos), "manifiesto": spark.read.parquet(manifiesto)}


def read_outputs(spark: SparkSession, result: RunResult) -> dict[str, DataFrame]:
    """The tables that this run has published."""
    return _tables(spark, result.largo, result.metadatos, result.manifiesto)


def read_current(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The tables of the run published last, all of the same run."""
    at = snapshot.current(spark, out_dir)
    if at is None:
        raise FileNotFoundError(f"nothing published in {out_dir}")
    return _tables(spark, *(os.path.join(at, t) for t in ("largo", "metadatos", "manifiesto")))
