"""Versioned tables: partitions in immutable folders, and one small pointer that says which are current.

    <path>/data/version=<id>/<partition column>=<value>/*.parquet
    <path>/pointer/<number>.json

A load writes a new version folder and then publishes a pointer that names, for each
partition value, the version that holds it. Publishing is one rename, so a reader sees the
table as it was before or as it is after, never a mixture, whenever the load dies; files that
no pointer names are never read. Versions that are no longer named are removed by ``vacuum``.

The pointer has one entry for each partition (a day, a month) with the partition's
fingerprint: its row count and the sum of its rows' hashes, which does not depend on their
order. ``replace(changed_only=True)`` compares fingerprints and writes only partitions that
differ, so the others keep their files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ConcurrentCommit(RuntimeError):
    """Another load published first; run the load again."""


@dataclass(frozen=True)
class Pointer:
    """``partitions``: value -> {version, print}; ``schema``: of the rows, partition column last."""

    number: int
    schema: T.StructType
    partitions: dict[str, dict] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"number": self.number, "schema": self.schema.jsonValue(), "partitions": self.partitions}, sort_keys=True)

    @staticmethod
    def parse(text: str) -> "Pointer":
        d = json.loads(text)
        return Pointer(d["number"], T.StructType.fromJson(d["schema"]), d["partitions"])


class Files:
    """The few file operations that a commit needs, on any file system that Spark's Hadoop client reaches."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm = spark.sparkContext._jvm
        self.base = base.rstrip("/")
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """All of the file or nothing; False if there is one of that name already."""
        folder, _, last = name.rpartition("/")
        hidden = f"{folder}/.{last}-{uuid.uuid4().hex}"
        self.write(hidden, text)
        if self.fs.exists(self._path(name)) or not self.fs.rename(self._path(hidden), self._path(name)):
            self.remove(hidden)
            return False
        return True

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partition_col: str):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col
        self.files = Files(spark, self.path)

    @staticmethod
    def exists(spark: SparkSession, path: str) -> bool:
        return any(n.endswith(".json") and not n.startswith(".") for n in Files(spark, path).names("pointer"))

    # ------------------------------------------------------------ reading

    def head(self) -> Pointer | None:
        """The newest pointer; None before the first commit."""
        names = [n for n in self.files.names("pointer") if n.endswith(".json") and not n.startswith(".")]
        return Pointer.parse(self.files.read(f"pointer/{names[-1]}")) if names else None

    def values(self) -> list[str]:
        head = self.head()
        return sorted(head.partitions) if head else []

    def read(self, head: Pointer | None = None) -> DataFrame:
        """The table as the newest (or the given) pointer names it. Partition values stay text; filters on them prune folders."""
        head = head or self.head()
        if head is None:
            raise FileNotFoundError(f"no version of {self.path} has been published")
        return self._rows(head.schema, [(e["version"], v) for v, e in sorted(head.partitions.items())])

    def _rows(self, schema: T.StructType, held: list[tuple[str, str]]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([T.StructField("version", T.StringType()), *schema.fields])
        folders = [f"{self.path}/data/version={version}/{schema.names[-1]}={value}" for version, value in held]
        rows = self.spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*folders)
        return rows.select(*schema.names)

    # ------------------------------------------------------------ writing

    def fingerprints(self, rows: DataFrame) -> dict[str, str]:
        """A print for each partition value: collected, one small row a partition."""
        cols = sorted(c for c in rows.columns if c != self.partition_col)
        h = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in cols]).cast("decimal(20,0)"))
        found = rows.groupBy(self.partition_col).agg(F.count(F.lit(1)).alias("n"), h.alias("h")).collect()
        return {r[0]: f"{r['n']}:{r['h']}" for r in found}

    def schema_of(self, rows: DataFrame) -> T.StructType:
        plain = [T.StructField(f.name, f.dataType) for f in rows.schema if f.name != self.partition_col]
        return T.StructType([*plain, T.StructField(self.partition_col, T.StringType())])

    def write_version(self, rows: DataFrame) -> dict[str, dict]:
        """Write ``rows`` into a folder of their own and return its pointer entries. Nothing is visible yet.

        The ``rebalance`` hint lets AQE split a huge partition value over tasks and merge small
        ones; fingerprints are taken from the files written.
        """
        version = uuid.uuid4().hex
        folder = f"data/version={version}"
        (rows.hint("rebalance", self.partition_col).write.mode("error").partitionBy(self.partition_col)
         .parquet(f"{self.path}/{folder}"))
        mark = f"{self.partition_col}="
        values = [n[len(mark):] for n in self.files.names(folder) if n.startswith(mark)]
        prints = self.fingerprints(self._rows(self.schema_of(rows), [(version, v) for v in values])) if values else {}
        return {v: {"version": version, "print": prints[v]} for v in values}

    def commit(self, schema: T.StructType, entries: dict[str, dict], base: Pointer | None = None, since: str | None = None,
               floor: str = "") -> Pointer:
        """Publish: ``base``'s partitions from ``floor`` to before ``since`` (none of them if that is None) and ``entries``, in one step."""
        kept = {v: e for v, e in base.partitions.items() if floor <= v < since} if base and since is not None else {}
        new = Pointer(base.number + 1 if base else 1, schema, {**kept, **entries})
        if not self.files.put(f"pointer/{new.number:012d}.json", new.text()):
            raise ConcurrentCommit(f"{self.path}: pointer {new.number} is taken")
        return new

    def replace(self, rows: DataFrame, since: str | None = None, changed_only: bool = False, floor: str = "") -> dict[str, list[str]]:
        """Replace all partitions, or those ``>= since``, by ``rows``; partitions that ``rows`` lacks vanish, and those before ``floor``.

        ``changed_only`` takes the fingerprints of the new rows first and writes only partitions
        whose print differs. Returns the values written, kept as they were, and dropped.
        """
        base = self.head()
        if base is None and any(n.startswith(f"{self.partition_col}=") for n in self.files.names("")):
            raise ValueError(f"{self.path} holds plain partitions without a pointer: load it anew into another folder")
        if since is not None:
            rows = rows.where(F.col(self.partition_col) >= since)
        old = {v: e for v, e in (base.partitions if base else {}).items() if since is None or v >= since}
        kept: dict[str, dict] = {}
        if changed_only and old and base.schema == self.schema_of(rows):
            now = self.fingerprints(rows)
            kept = {v: e for v, e in old.items() if now.get(v) == e["print"]}
            rows = rows.where(F.col(self.partition_col).isin(sorted(set(now) - set(kept))))
            fresh = self.write_version(rows) if set(now) - set(kept) else {}
        else:
            fresh = self.write_version(rows)
        self.commit(self.schema_of(rows), {**kept, **fresh}, base, since, floor)
        return {"written": sorted(fresh), "kept": sorted(kept), "dropped": sorted(set(old) - set(kept) - set(fresh))}

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove pointers older than the last ``keep``, and versions that none of those names. Not while a load is running."""
        names = [n for n in self.files.names("pointer") if n.endswith(".json") and not n.startswith(".")]
        named = {e["version"] for n in names[-keep:] for e in Pointer.parse(self.files.read(f"pointer/{n}")).partitions.values()}
        for n in names[:-keep]:
            self.files.remove(f"pointer/{n}")
        gone = [n for n in self.files.names("data") if n.startswith("version=") and n[len("version="):] not in named]
        for n in gone:
            self.files.remove(f"data/{n}")
        return gone


class Ledger:
    """Finished steps of one long build: a small file each, written when the step's tables are on disk.

    ``key`` names the build (its date and what it is made of); a build that was interrupted finds
    its finished steps again, another build does not. ``close`` forgets them.
    """

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.files, self.key = Files(spark, path), key

    def done(self) -> dict[str, dict]:
        return {n[:-len(".json")]: json.loads(self.files.read(f"{self.key}/{n}")) for n in self.files.names(self.key)
                if n.endswith(".json") and not n.startswith(".")}

    def record(self, step: str, what: dict) -> None:
        self.files.put(f"{self.key}/{step}.json", json.dumps(what))

    def close(self) -> None:
        self.files.remove(self.key)
