"""CSV → Parquet ingest with a load report (S1–S3, S7).

Each dataset's CSV is parsed once, with an explicit schema in PERMISSIVE mode
plus a corrupt-record column; malformed rows are counted and dropped (exactly
the rows DROPMALFORMED would drop, but counted correctly and never turning a
numeric column into text). The good rows go to a Parquet staging table in the
shared folder, from which the raw backup (gzipped CSV) and the cleaned table are written.
Row counts for the report come from ``Observation`` metrics collected by the
writes themselves, so no extra counting jobs re-read the CSV. The clean table is read
back and compared (rows and content hash) before it takes the place of the old one, so a
load that fails leaves the old table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DATASETS, EXPECTED_DATASETS, REQUIRED
from ..session import remove_folder, shared_dir
from .sinks import content_hash, read_back, write_csv
from .versions import replace_folder

CORRUPT = "_corrupt_record"

REPORT_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("size_mb", T.DoubleType()),
    T.StructField("parquet_path", T.StringType()),
    T.StructField("raw_backup_path", T.StringType()),
    T.StructField("original_rows", T.LongType()),
    T.StructField("malformed_rows", T.LongType()),
    T.StructField("cleaned_rows", T.LongType()),
    T.StructField("final_rows", T.LongType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("error", T.StringType()),
])


def header_schema(spark: SparkSession, path: str, known: T.StructType,
                  infer: bool = False) -> T.StructType:
    """The file's header columns, in file order, typed from ``known``. Other columns are
    strings, or with ``infer`` what Spark infers from their values (one more scan of
    the file); without it only the header is read."""
    found = spark.read.option("header", True).option("inferSchema", infer).csv(path).schema
    by_name = {f.name.lower(): f.dataType for f in known.fields}
    return T.StructType([T.StructField(f.name, by_name.get(f.name.lower(), f.dataType))
                         for f in found.fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S1: parse with header and explicit schema; malformed rows keep their raw
    text in ``_corrupt_record`` (NULL for good rows). The header of every part file
    must name the schema's columns in order, else reading fails."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(full)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path))


def drop_malformed(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def clean_dataset(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """S3 + S2: drop rows that lack a ``required`` column's value, then repeated rows."""
    return df.dropna(subset=list(required)).dropDuplicates() if required else df.dropDuplicates()


def file_size_mb(spark: SparkSession, path: str) -> float:
    """Total bytes under ``path`` (file listing only; contents are not read)."""
    total = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    return float(total or 0) / (1024 * 1024)


def ingest_dataset(spark: SparkSession, name: str, csv_path: str, parquet_path: str,
                   backup_path: str, known: T.StructType, required: Sequence[str] = (),
                   infer: bool = False) -> dict:
    report = {"file": f"{name}.csv", "size_mb": None, "parquet_path": parquet_path,
              "raw_backup_path": backup_path, "original_rows": None, "malformed_rows": None,
              "cleaned_rows": None, "final_rows": None, "success": False, "error": None}
    staging = shared_dir(spark, "ingest-staging", name)
    try:
        report["size_mb"] = file_size_mb(spark, csv_path)
        schema = header_schema(spark, csv_path, known, infer)

        # The CSV is parsed once, into a Parquet staging table in the shared
        # folder; the backup and the clean table are both written from it.
        raw_obs = Observation(f"raw_{name}")
        parsed = read_csv(spark, csv_path, schema).observe(
            raw_obs, F.count(F.lit(1)).alias("rows"), F.count(F.col(CORRUPT)).alias("malformed"))
        drop_malformed(parsed).write.parquet(staging)
        raw = raw_obs.get
        report["malformed_rows"] = int(raw["malformed"])
        report["original_rows"] = int(raw["rows"]) - int(raw["malformed"])
        good = spark.read.parquet(staging)
        write_csv(good, backup_path, "gzip")                 # S4, before cleaning

        clean_obs = Observation(f"clean_{name}")
        cleaned = clean_dataset(good, required)
        observed = cleaned.observe(clean_obs, F.count(F.lit(1)).alias("rows"), content_hash(cleaned).alias("content"))

        def save(new: str) -> None:                          # S6, before S5 publishes it
            observed.write.parquet(new)
            seen = clean_obs.get
            report["cleaned_rows"] = int(seen["rows"])
            report["final_rows"], wrong = read_back(spark, new, report["cleaned_rows"], seen["content"])
            if wrong:
                raise OSError(wrong)

        replace_folder(spark, parquet_path, save)
        report["success"] = True
    except Exception as exc:  # noqa: BLE001 - one failing dataset must not stop the rest
        report["error"] = str(exc)
    finally:
        remove_folder(spark, staging)
    return report


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema  # noqa: B018 - resolves the path
        return True
    except AnalysisException:
        return False


def run_loader(spark: SparkSession, raw_dir: str, parquet_dir: str, backup_dir: str,
               datasets: Mapping[str, T.StructType] = DATASETS,
               required: Mapping[str, Sequence[str]] = REQUIRED, infer: bool = False) -> DataFrame:
    """S7: ingest every expected dataset present under ``raw_dir``.

    Returns the load report (one row per dataset found). Raises when no
    expected file is present; a dataset that fails is reported with
    ``success = false`` and its error, and the others still load.
    """
    raw_dir, parquet_dir, backup_dir = (d.rstrip("/") for d in (raw_dir, parquet_dir, backup_dir))
    order = [n for n in EXPECTED_DATASETS if n in datasets] + \
        [n for n in datasets if n not in EXPECTED_DATASETS]
    present = [n for n in order if _exists(spark, f"{raw_dir}/{n}.csv")]
    if not present:
        raise FileNotFoundError(f"no expected CSV file under {raw_dir}: {sorted(datasets)}")
    rows = [ingest_dataset(spark, n, f"{raw_dir}/{n}.csv", f"{parquet_dir}/{n}",
                           f"{backup_dir}/{n}_backup", datasets[n], required.get(n, ()), infer)
            for n in present]
    return spark.createDataFrame([tuple(r[f.name] for f in REPORT_SCHEMA.fields) for r in rows],
                                 REPORT_SCHEMA)
