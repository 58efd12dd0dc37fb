"""CSV input with explicit schemas; records that do not fit are set aside."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import REVISION, LarderError
from larder.sources import parquet
from larder.sources.workspace import file_system
from larder.tables import TableSpec

# Names of the raw-text column and of the quarantine folder.
CORRUPT = "_corrupt_record"
QUARANTINE = "_malformed"

# The column whose two values part the written records, and the folders of its values.
SIDE = "malformed"
VALID, MALFORMED = f"{SIDE}=false", f"{SIDE}=true"
RAW = T.StructType([T.StructField(CORRUPT, T.StringType())])


@dataclass(frozen=True)
class ParsedCsv:
    """Records that fit the schema, and the raw text of those that do not."""

    valid: DataFrame
    malformed: DataFrame


@dataclass(frozen=True)
class IngestCount:
    valid: int
    malformed: int


def require_file(spark: SparkSession, path: str) -> int:
    """Bytes below ``path`` (a file or a folder of part files); none is an error.

    Only file listings are read, and no job is started.
    """
    files, at = file_system(spark, path)
    found = list(files.globStatus(at) or [])
    if not found:
        raise LarderError(f"no such input: {path}")
    size = sum(files.getContentSummary(status.getPath()).getLength() for status in found)
    if not size:
        raise LarderError(f"input is empty: {path}")
    return size


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """The schema with one column, the last, for the raw text of records that do not fit."""
    return T.StructType([f for f in schema if f.name != CORRUPT]).add(CORRUPT, T.StringType())


def scan_csv(spark: SparkSession, path: str, spec: TableSpec, multi_line: bool | None = None):
    """All records, with the corrupt-record column filled where parsing failed.

    ``multi_line`` allows line breaks inside quoted values but makes each file
    one task, so only the tables whose texts may need it turn it on.
    """
    return (
        spark.read.options(
            header=True,
            nullValue="",
            mode="PERMISSIVE",
            quote='"',
            escape='"',
            multiLine=spec.multi_line if multi_line is None else multi_line,
            columnNameOfCorruptRecord=CORRUPT,
        )
        .schema(with_corrupt_column(spec.schema))
        .csv(path)
    )


def _whole_records(scan: DataFrame, spec: TableSpec, watch: Observation) -> DataFrame:
    """Watch every column, so that column pruning cannot hide a bad value.

    Spark parses only the columns a query asks for, and a value that is not
    parsed is never found to be bad.  The counts below depend on all columns
    and are taken ahead of the split into valid and malformed, so each action
    on either side judges whole records, without keeping a parsed copy.
    """
    return scan.observe(
        watch,
        F.count("*").alias("n_records"),
        F.count(CORRUPT).alias("n_malformed"),
        *[F.count(name).alias(f"n_{name}") for name in spec.columns],
    )


def _split(records: DataFrame, spec: TableSpec) -> ParsedCsv:
    corrupt = F.col(CORRUPT)
    return ParsedCsv(
        valid=records.filter(corrupt.isNull()).select(*spec.columns),
        malformed=records.filter(corrupt.isNotNull()).select(CORRUPT),
    )


def read_csv(
    spark: SparkSession, path: str, spec: TableSpec, multi_line: bool | None = None
) -> ParsedCsv:
    scan = scan_csv(spark, path, spec, multi_line)
    return _split(_whole_records(scan, spec, Observation()), spec)


def split_csv(
    spark: SparkSession, path: str, spec: TableSpec, folder: str, multi_line: bool | None = None
) -> tuple[ParsedCsv, IngestCount]:
    """Both sides of a file, parsed once and written below ``folder``, a part for each side.

    All columns are written, so whole records are judged; the counts come out of the write.
    """
    parse = Observation()
    sided = scan_csv(spark, path, spec, multi_line).withColumn(SIDE, F.col(CORRUPT).isNotNull())
    sided.observe(parse, F.count("*").alias("n"), F.count(CORRUPT).alias("bad")).write.partitionBy(
        SIDE
    ).parquet(folder)
    n, bad = parse.get["n"], parse.get["bad"]
    return ParsedCsv(
        valid=_side(spark, f"{folder}/{VALID}", spec.schema, n - bad),
        malformed=_side(spark, f"{folder}/{MALFORMED}", RAW, bad),
    ), IngestCount(n - bad, bad)


def _side(spark: SparkSession, folder: str, schema: T.StructType, rows: int) -> DataFrame:
    """One side; nothing is written for a side without records."""
    return spark.read.schema(schema).parquet(folder) if rows else spark.createDataFrame([], schema)


def ingest_csv(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    bronze: str,
    multi_line: bool | None = None,
) -> IngestCount:
    """CSV to a bronze table; malformed records, if any, to the quarantine.

    Both tables are versions over one parse.  A file that has not changed since it was
    ingested is not read again.
    """
    require_file(spark, path)
    multi_line = spec.multi_line if multi_line is None else multi_line
    inputs = {
        "file": parquet.files_identity(spark, path),
        "multi_line": str(multi_line),
        "larder": REVISION,
    }
    quarantine = f"{bronze}/{QUARANTINE}"
    before = parquet.published(spark, bronze, spec.name)
    if before and dict(before.inputs) == inputs:
        aside = parquet.published(spark, quarantine, spec.name)
        return IngestCount(before.rows, aside.rows if aside else 0)
    folder = parquet.new_version()
    place = f"{spec.name}/{folder}"
    _, count = split_csv(spark, path, spec, f"{bronze}/{place}", multi_line)
    version = parquet.Version(
        folder, f"{place}/{VALID}", spec.schema.json(), count.valid, inputs=inputs
    )
    aside = parquet.Version(
        folder, f"../{place}/{MALFORMED}", RAW.json(), count.malformed, inputs=inputs
    )
    if count.malformed:
        parquet.prepare(spark, quarantine, spec.name, aside)
        parquet.publish(spark, quarantine, spec.name)
    else:
        parquet.withdraw(spark, quarantine, spec.name)
    parquet.prepare(spark, bronze, spec.name, version)
    parquet.publish(spark, bronze, spec.name)
    return count
