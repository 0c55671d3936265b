"""Published versions of a set of tables, for readers in other processes.

A version is one small file that names every table with its folder, schema and
columns.  Version n + 1 is written by whoever creates its file first: a writer
says which version it builds on, and one that comes too late gets an error
instead of hiding the other's work.  Files of versions are never changed or
replaced, and the tables that they name lie in the immutable folders of a run,
so a reader that has opened a version sees this one, whole, until the run is
retired; no metastore is needed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.session import checkpoint_root
from strata.sources.store import create_text, list_names, read_text


class PublishConflict(RuntimeError):
    """Somebody else has published since the version that was built on."""


class Snapshot:
    """One published version."""

    def __init__(self, spark: SparkSession, version: int, content: dict):
        self.spark, self.version, self.content = spark, version, content

    @property
    def run_id(self) -> str:
        return self.content["run_id"]

    def names(self) -> list[str]:
        return sorted(self.content["tables"])

    def table(self, name: str) -> DataFrame:
        t = self.content["tables"].get(name)
        if t is None:
            raise KeyError(f"{name} is not published; there are {', '.join(self.names())}")
        df = self.spark.read.schema(T.StructType.fromJson(t["schema"])).parquet(t["path"])
        return (df.filter(t["where"]) if t["where"] else df).select(*t["columns"])


class Publication:
    def __init__(self, spark: SparkSession, root: str | None = None, name: str = "warehouse"):
        self.spark = spark
        self.folder = f"{root or checkpoint_root(spark)}/strata/published/{name}"

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in list_names(self.spark, self.folder)
                      if n.startswith("v") and n.endswith(".json"))

    def open(self, version: int | None = None) -> Snapshot | None:
        """The given version, or the newest; None if nothing is published."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        text = read_text(self.spark, self._file(version))
        if text is None:
            raise KeyError(f"there is no version {version}")
        return Snapshot(self.spark, version, json.loads(text))

    def publish(self, content: dict, expected: int) -> int:
        """Write the version after ``expected`` (0: the first one)."""
        known = self.versions()
        if (known[-1] if known else 0) != expected or not create_text(
                self.spark, self._file(expected + 1), json.dumps(content)):
            raise PublishConflict(f"version {expected} is not the newest one any more")
        return expected + 1

    def _file(self, version: int) -> str:
        return f"{self.folder}/v{version:012d}.json"
