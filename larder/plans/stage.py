"""Stages that go on where a former run ended."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from larder import REVISION
from larder.sources import parquet
from larder.sources.parquet import Version


@dataclass
class Stage:
    """One run of a stage, whose tables are published together when all are whole.

    A table is made only if no whole version was made from the same versions of its
    inputs by the same revision of this library.  That holds for published versions and
    for those a run that was ended has left ready, so a second run starts no job for them.
    """

    spark: SparkSession
    root: str
    made: dict[str, Version] = field(default_factory=dict)

    def known(self, name: str, inputs: Mapping[str, str]) -> Version | None:
        """A whole version of the table from these inputs, if there is one."""
        wanted = {**inputs, "larder": REVISION}
        for find in (parquet.prepared, parquet.published):
            version = find(self.spark, self.root, name)
            if version and dict(version.inputs) == wanted:
                return version
        return None

    def table(self, name: str, inputs: Mapping[str, str], make: Callable[[], DataFrame]) -> Version:
        """The table's version from these inputs, written now unless it is known."""
        version = self.known(name, inputs)
        if version is None:
            version = parquet.write_version(
                make(), self.root, name, {**inputs, "larder": REVISION}
            )
        self.made[name] = version
        return version

    def read(self, name: str) -> DataFrame:
        """A table of this run, also before it is published."""
        return self.made[name].read(self.spark, self.root)

    def is_new(self, name: str) -> bool:
        """Whether readers do not see this version yet."""
        shown = parquet.published(self.spark, self.root, name)
        return shown is None or shown.id != self.made[name].id

    def publish(self) -> None:
        """Let readers take all tables of this run."""
        for name in self.made:
            if self.is_new(name):
                parquet.publish(self.spark, self.root, name)

    @property
    def rows(self) -> dict[str, int]:
        return {name: version.rows for name, version in self.made.items()}
