"""Layer tables: one immutable parquet folder per (run, layer, table).

A load writes a fresh folder and readers switch to it only after the write
committed, so a failed load never exposes a half-written or truncated table
(the stage-then-swap the source procedures lacked).  Folders live under the
shared checkpoint root so they survive executor loss and cut lineage: every
later stage reads files instead of recomputing the plan that made them.

Each run keeps a manifest: one small JSON file per table with its schema, its
buckets and what was counted while it was written, and one that tells the
run's owner and whether it is published.  So a run can be reopened by id, and
clean-up retires only published runs of its own owner.  What happened to each
table is kept in an append-only log, one small file per event.

Small files are replaced in one step (the new one is written aside and renamed
over the old one) or created only if they are not there yet; nothing is deleted
before its successor is in place.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from strata.session import checkpoint_root, partitions


CODEC = "zstd"  # of layer tables and lineage cuts


def hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _raw_path(spark: SparkSession, path: str):
    """As ``hadoop_path``, but on a local disk without the checksum file beside
    each file: two files cannot be replaced in one step."""
    p, fs = hadoop_path(spark, path)
    return p, fs.getRawFileSystem() if fs.getUri().getScheme() == "file" else fs


def _aside(spark: SparkSession, path: str, text: str) -> str:
    aside = f"{path}.{uuid.uuid4().hex[:12]}.tmp"
    p, fs = _raw_path(spark, aside)
    out = fs.create(p, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    return aside


def _rename(spark: SparkSession, src: str, dst: str, how: str) -> None:
    jvm = spark._jvm
    a, fs = hadoop_path(spark, src)
    b, _ = hadoop_path(spark, dst)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = getattr(kind, how)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(a), fs.makeQualified(b), options)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written aside, then renamed over
    the old one in one step, so a reader always finds one of the two."""
    aside = _aside(spark, path, text)
    if _raw_path(spark, aside)[1].getUri().getScheme() == "file":  # Hadoop's local rename deletes first
        jvm = spark._jvm.java.nio.file
        options = spark.sparkContext._gateway.new_array(jvm.CopyOption, 1)
        options[0] = jvm.StandardCopyOption.ATOMIC_MOVE
        jvm.Files.move(_local(spark, aside), _local(spark, path), options)
    else:
        _rename(spark, aside, path, "OVERWRITE")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that is not there yet; False if somebody was faster."""
    aside = _aside(spark, path, text)
    p, fs = _raw_path(spark, aside)
    try:
        if fs.getUri().getScheme() == "file":  # a link fails if the name is taken; a local rename would not
            spark._jvm.java.nio.file.Files.createLink(_local(spark, path), _local(spark, aside))
        else:
            _rename(spark, aside, path, "NONE")
        return True
    except Exception:
        if read_text(spark, path) is None:  # not because it is there
            raise
        return False
    finally:
        fs.delete(p, False)


def _local(spark: SparkSession, path: str):
    none = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
    return spark._jvm.java.nio.file.Path.of(hadoop_path(spark, path)[0].toUri().getPath(), none)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = hadoop_path(spark, folder)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _raw_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def input_state(spark: SparkSession, folder: str) -> str:
    """Digest of names, sizes and times of the files under an input folder."""
    root, fs = hadoop_path(spark, folder)
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        st = files.next()
        found.append(f"{st.getPath().toString()} {st.getLen()} {st.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


class LayerStore:
    def __init__(self, spark: SparkSession, root: str | None = None, run_id: str | None = None,
                 owner: str = "strata"):
        """``run_id`` of an earlier run reopens it: its tables are there."""
        self.spark = spark
        self.owner = owner
        self.run_id = run_id or uuid.uuid4().hex[:12]
        self.folder = root or checkpoint_root(spark)
        self.base = f"{self.folder}/strata"
        self.root = f"{self.base}/run-{self.run_id}"
        self._tables: dict[tuple[str, str], dict] = {}
        self._registered: set[str] = set()
        if run_id and self._manifest(self.run_id) is not None:
            self._reopen()
        else:
            self._mark(published=False)

    # ------------------------------------------------------------ manifest
    def _manifest(self, run_id: str) -> dict | None:
        text = read_text(self.spark, f"{self.base}/run-{run_id}/_manifest/run.json")
        return json.loads(text) if text else None

    def _mark(self, **more) -> None:
        known = self._manifest(self.run_id) or {"owner": self.owner, "published": False}
        write_text(self.spark, f"{self.root}/_manifest/run.json", json.dumps(known | more))

    def note(self, **more) -> None:
        """Keep facts about the run (e.g. what its input was) in the manifest."""
        self._mark(**more)

    def noted(self, key: str):
        return (self._manifest(self.run_id) or {}).get(key)

    def publish(self) -> None:
        """The run is complete: later runs of this owner may retire older ones."""
        self._mark(published=True)

    def _reopen(self) -> None:
        folder = f"{self.root}/_manifest"
        for name in list_names(self.spark, folder):
            if name.endswith(".table.json"):
                m = json.loads(read_text(self.spark, f"{folder}/{name}"))
                self._tables[(m["layer"], m["table"])] = m

    # ------------------------------------------------------------ log
    def log(self, **event) -> None:
        """Append what happened (append-only: a file per event)."""
        at = time.time_ns()
        create_text(self.spark, f"{self.root}/_log/{at:020d}-{uuid.uuid4().hex[:8]}.json",
                    json.dumps({"at": at, **event}))

    def events(self) -> list[dict]:
        """All events of the run, oldest first."""
        folder = f"{self.root}/_log"
        return [json.loads(read_text(self.spark, f"{folder}/{n}"))
                for n in list_names(self.spark, folder) if n.endswith(".json")]

    # ------------------------------------------------------------ tables
    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def write(self, df: DataFrame, layer: str, table: str, observe: dict[str, Column] | None = None,
              buckets: tuple[str, ...] = (), hidden: tuple[str, ...] = ()) -> DataFrame:
        """Full-refresh sink: write the table, then publish it.

        ``observe``: aggregates (named) that are taken while the rows pass to
        the files, without a scan of their own; see ``metrics``.  ``buckets``:
        columns by whose hash the rows are dealt into as many files as there
        are shuffle partitions, so that joins and groupings on them need no
        shuffle.  ``hidden``: columns that are not part of the table's face.
        """
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
        n = partitions(self.spark)
        if buckets:
            df = df.repartition(n, *buckets)
        seen = None
        if observe:  # last, in the stage that writes: a task that is run again counts once
            seen = Observation(f"{layer}.{table}")
            df = df.observe(seen, *[c.alias(k) for k, c in observe.items()])
        if buckets:
            (df.write.format("parquet").mode("overwrite").option("compression", CODEC).bucketBy(n, *buckets)
             .option("path", self.path(layer, table)).saveAsTable(self._name(layer, table)))
        else:
            df.write.mode("overwrite").option("compression", CODEC).parquet(self.path(layer, table))
        entry = {"layer": layer, "table": table, "schema": json.loads(schema.json()),
                 "metrics": seen.get if seen else {}, "buckets": [n, *buckets] if buckets else [],
                 "hidden": list(hidden)}
        write_text(self.spark, f"{self.root}/_manifest/{layer}.{table}.table.json", json.dumps(entry))
        self._tables[(layer, table)] = entry
        return self.read(layer, table)

    def schema(self, layer: str, table: str) -> T.StructType:
        return T.StructType.fromJson(self._tables[(layer, table)]["schema"])

    def columns(self, layer: str, table: str) -> list[str]:
        """The table's columns without the hidden ones."""
        hidden = self._tables[(layer, table)]["hidden"]
        return [f.name for f in self.schema(layer, table) if f.name not in hidden]

    def metrics(self, layer: str, table: str) -> dict:
        """What was counted while the table was written."""
        return self._tables[(layer, table)]["metrics"]

    def _name(self, layer: str, table: str) -> str:
        """The session catalog's name of a bucketed table: only a catalog
        entry tells Spark of buckets.  It is made again from the manifest
        wherever it is missing, over the files as they are."""
        db = f"strata_{self.run_id}".replace("-", "_")
        if db not in self._registered:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{self.root}/_catalog'")
            self._registered.add(db)
        return f"`{db}`.`{layer}_{table}`"

    def read(self, layer: str, table: str) -> DataFrame:
        """With the schema known at write time: no job reads file footers."""
        entry = self._tables[(layer, table)]
        if entry["buckets"]:
            n, *by = entry["buckets"]
            name = self._name(layer, table)
            if name not in self._registered:
                cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema(layer, table))
                self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                               f"CLUSTERED BY ({', '.join(by)}) INTO {n} BUCKETS "
                               f"LOCATION '{self.path(layer, table)}'")
                self._registered.add(name)
            return self.spark.table(name)
        return self.spark.read.schema(self.schema(layer, table)).parquet(self.path(layer, table))

    def has(self, layer: str, table: str) -> bool:
        return (layer, table) in self._tables

    # ------------------------------------------------------------ clean-up
    def drop(self) -> None:
        """Delete this run's folder (a throwaway run, e.g. a benchmark)."""
        for db in [n for n in self._registered if "." not in n]:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
        self._registered.clear()
        delete_folder(self.spark, self.root)
        self._tables.clear()

    def retire_older_runs(self, keep: int = 1, spare: tuple[str, ...] = ()) -> list[str]:
        """Delete earlier published runs of this owner, keeping the newest
        ``keep`` (this run included).

        The counterpart of the source's TRUNCATE: the new run is published
        first, then older copies go.  Runs of other owners, runs that are
        still being written, and runs in ``spare`` (the one that readers are
        sent to) are left alone.
        """
        parent, fs = hadoop_path(self.spark, self.base)
        if not fs.exists(parent):
            return []
        others = []
        for st in fs.listStatus(parent):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("run-") and name.removeprefix("run-") not in (
                    self.run_id, *spare):
                m = self._manifest(name.removeprefix("run-"))
                if m and m["owner"] == self.owner and m["published"]:
                    others.append(st)
        others.sort(key=lambda st: st.getModificationTime(), reverse=True)
        dropped = []
        for st in others[max(keep - 1, 0):]:
            fs.delete(st.getPath(), True)
            dropped.append(st.getPath().toString())
        return dropped


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back: a durable lineage cut."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def run_concurrently(tasks: dict, max_workers: int = 6) -> dict:
    """Run independent Spark actions from a small thread pool.

    Each callable submits its own jobs; the scheduler interleaves them, so
    small tables do not wait behind a large one.  Results keep the keys;
    the first failure is raised.
    """
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        futures = {k: pool.submit(fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}
