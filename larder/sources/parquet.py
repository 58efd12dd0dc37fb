"""Tables kept as Parquet: a folder per version and a manifest that is replaced last.

``root/name/v-…/`` holds the files of one version, ``root/name/_manifest.json`` says which
version readers take.  A write makes a new folder, then ``_ready.json`` beside it, and
publishing renames that to the manifest.  A run that ends half-way leaves the manifest,
and with it the former table, as they were; versions that are ready stay for the next run.
A folder without a manifest is read as it is.  One run at a time writes a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import LarderError
from larder.sources.workspace import file_system, read_text, replace_text

MANIFEST = "_manifest.json"
READY = "_ready.json"
VERSION = "v-"


@dataclass(frozen=True)
class Version:
    """One version of a table: where its files are, what it was made from and how large it is.

    ``octets`` are those of all texts, ``widest`` the sum over text columns of their longest
    text; both were counted while the files were written.
    """

    id: str
    place: str  # below the root
    schema: str  # as JSON
    rows: int
    octets: int = 0
    widest: int = 0
    inputs: Mapping[str, str] = field(default_factory=dict)
    former: str = ""  # the version before this one

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schema))
        if not self.rows:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{root}/{self.place}")


def _version(spark: SparkSession, root: str, name: str, file: str) -> Version | None:
    text = read_text(spark, f"{root}/{name}/{file}")
    return Version(**json.loads(text)) if text else None


def published(spark: SparkSession, root: str, name: str) -> Version | None:
    """The version that readers take, if the table has a manifest."""
    return _version(spark, root, name, MANIFEST)


def prepared(spark: SparkSession, root: str, name: str) -> Version | None:
    """A whole version that is not published yet."""
    return _version(spark, root, name, READY)


def files_identity(spark: SparkSession, path: str) -> str:
    """A digest of the names, lengths and times of all files below ``path``."""
    files, at = file_system(spark, path)
    found, listed = [], files.listFiles(at, True)
    while listed.hasNext():
        status = listed.next()
        found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return sha256("\n".join(sorted(found)).encode()).hexdigest()


def identity(spark: SparkSession, root: str, name: str) -> str:
    """What changes whenever the table does: its version, or a digest of its files."""
    version = published(spark, root, name)
    if version:
        return version.id
    try:
        return files_identity(spark, f"{root}/{name}")
    except Exception as problem:  # no such folder
        raise LarderError(f"cannot read table {name!r} below {root}: {problem}") from problem


def read_table(
    spark: SparkSession, root: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Scan a table, reading only ``columns`` from the files if given."""
    version = published(spark, root, name)
    try:
        table = version.read(spark, root) if version else spark.read.parquet(f"{root}/{name}")
    except AnalysisException as problem:
        raise LarderError(f"cannot read table {name!r} below {root}: {problem}") from problem
    return table.select(*columns) if columns else table


def new_version() -> str:
    return VERSION + uuid.uuid4().hex


def prepare(spark: SparkSession, root: str, name: str, version: Version) -> Version:
    """Note a version whose files are all written."""
    replace_text(spark, f"{root}/{name}/{READY}", json.dumps(asdict(version)))
    return version


def sizes(df: DataFrame, watch: Observation) -> DataFrame:
    """``df`` with its rows and text sizes counted on the way."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    lengths = [F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) for name in texts]
    none = F.lit(0).cast("long")
    return df.observe(
        watch,
        F.count("*").alias("rows"),
        F.coalesce(F.sum(sum(lengths, none)), none).alias("octets"),
        sum((F.coalesce(F.max(n), F.lit(0)) for n in lengths), none).alias("widest"),
    )


def write_version(
    df: DataFrame, root: str, name: str, inputs: Mapping[str, str] | None = None
) -> Version:
    """Write the files of a new version, counted while writing, and note it as ready."""
    written, folder = Observation(), new_version()
    sizes(df, written).write.parquet(f"{root}/{name}/{folder}")
    return prepare(
        df.sparkSession,
        root,
        name,
        Version(folder, f"{name}/{folder}", df.schema.json(), inputs=dict(inputs or {}), **written.get),
    )


def publish(spark: SparkSession, root: str, name: str) -> None:
    """Let readers take the version that is ready; versions before the former one go."""
    ready, before = prepared(spark, root, name), published(spark, root, name)
    if ready is None:
        return
    version = Version(**(asdict(ready) | {"former": before.id if before else ""}))
    replace_text(spark, f"{root}/{name}/{MANIFEST}", json.dumps(asdict(version)))
    files, table = file_system(spark, f"{root}/{name}")
    files.delete(file_system(spark, f"{root}/{name}/{READY}")[1], False)
    for status in files.listStatus(table):
        folder = status.getPath().getName()
        if folder.startswith(VERSION) and folder not in (version.id, version.former):
            files.delete(status.getPath(), True)


def withdraw(spark: SparkSession, root: str, name: str) -> None:
    """Remove a table with all its versions."""
    files, table = file_system(spark, f"{root}/{name}")
    files.delete(table, True)


def write_table(df: DataFrame, root: str, name: str, inputs: Mapping[str, str] | None = None) -> int:
    """Replace a table and return its row count, counted while writing."""
    version = write_version(df, root, name, inputs)
    publish(df.sparkSession, root, name)
    return version.rows


def rewrite_table(df: DataFrame, root: str, name: str) -> tuple[DataFrame, int]:
    """Write a table and go on from the written files instead of the plan behind it."""
    version = write_version(df, root, name)
    publish(df.sparkSession, root, name)
    return version.read(df.sparkSession, root), version.rows
