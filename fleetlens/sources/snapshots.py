"""A snapshot log: several tables that change together, by one commit.

Data files are written once, into folders of their own, and never changed.  A version of
the log is one small JSON file that names the live folders of every table; readers take
the latest version and see all of a commit or nothing of it.  A writer prepares its files
beside the live ones and then puts the next version in place by a rename that fails if
that version exists.  Whoever comes second looks at what the first one changed: other
partitions are fine and the commit is carried on top; the same ones raise ``Conflict``
and the work is done again from the new state.  A run that dies leaves files that no
version names, and the state as it was; a run that is repeated under its id changes nothing.

A version holds a line per partition and table and an entry per run, not per row or file,
so the driver's part is bounded by the days kept.  The file system must refuse a rename
onto an existing file (HDFS, a local disk).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fleetlens.operators.merge import by_schema, dedupe_by_key, merge_by_key, merge_latest

COMMIT = "_commit"


class Conflict(RuntimeError):
    """Another commit changed a partition that this one read and wrote."""


class _Files:
    """The few file operations of the log, through Spark's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path(root).getFileSystem(self.conf)
        self.rename_options = spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Write a file whole and move it into place; False if there is one already."""
        draft = f"{name}.{uuid.uuid4().hex}.tmp"
        out = self.fs.create(self._path(draft), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            target = self.fs.makeQualified(self._path(name))
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf)
            context.rename(self.fs.makeQualified(self._path(draft)), target, self.rename_options)
            return True
        except Py4JJavaError as failed:
            if "FileAlreadyExistsException" not in failed.java_exception.getClass().getName():
                raise
            self.fs.delete(self._path(draft), False)
            return False

    def names(self, pattern: str) -> list[tuple[str, int]]:
        """(name below the pattern's fixed part, time of change) of what matches a glob."""
        found = self.fs.globStatus(self._path(pattern))
        return [(f.getPath().toString(), f.getModificationTime()) for f in found or []]

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class SnapshotLog:
    """The tables under ``root``: ``root/log`` holds the versions, ``root/data/<table>`` the files."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = _Files(spark, self.root)

    def _versions(self) -> list[int]:
        names = (n.rsplit("/", 1)[-1] for n, _ in self.files.names(f"{self.root}/log/*.json"))
        return sorted(int(n.removesuffix(".json")) for n in names)

    def version(self) -> int:
        """The latest version; 0 before the first commit."""
        return max(self._versions(), default=0)

    def state(self, version: int | None = None) -> dict:
        at = self.version() if version is None else version
        if not at:
            return {"version": 0, "tables": {}, "runs": {}, "changed": {}}
        return json.loads(self.files.read(f"{self.root}/log/{at:020d}.json"))

    def read(self, table: str, version: int | None = None, state: dict | None = None) -> DataFrame:
        """A table as of a version (default: the latest).  Partition columns prune folders; only live ones are listed."""
        state = state or self.state(version)
        if table not in state["tables"]:
            raise LookupError(f"no table {table} in version {state['version']}")
        told = state["tables"][table]
        schema = T.StructType.fromJson(told["schema"])
        base = f"{self.root}/data/{table}"
        paths = [f"{base}/{COMMIT}={c}" + (f"/{part}" if part else "") for part, commits in told["parts"].items() for c in commits]
        if not paths:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
        return self.spark.read.schema(whole).option("basePath", base).parquet(*paths).select([f.name for f in schema])

    def begin(self, run_id: str | None = None) -> Transaction:
        return Transaction(self, run_id or uuid.uuid4().hex, self.state())

    def publish(self, run_id: str, build: Callable[[Transaction], None], attempts: int = 5) -> int:
        """Do ``build`` and commit it as one version; again from the new state if another writer was first.

        Returns the version that holds the run; a run id that is in the log already is not done again.
        """
        for attempt in range(attempts):
            work = self.begin(run_id)
            done = work.state["runs"].get(run_id)
            if done:
                return done
            build(work)
            try:
                return work.commit()
            except Conflict:
                if attempt == attempts - 1:
                    raise
        raise AssertionError

    def vacuum(self, keep: int = 10, older_than_s: float = 86_400) -> list[str]:
        """Delete old versions but the last ``keep``, and folders that no kept version names.

        Folders younger than ``older_than_s`` stay: a writer may be about to commit them.
        Returns what was deleted.
        """
        versions = self._versions()
        kept = versions[-keep:]
        live = {(t, c) for v in kept for t, told in self.state(v)["tables"].items() for commits in told["parts"].values() for c in commits}
        before = (time.time() - older_than_s) * 1000
        gone = [f"{self.root}/log/{v:020d}.json" for v in versions[:-keep]]
        for name, changed in self.files.names(f"{self.root}/data/*/{COMMIT}=*"):
            table, commit = name.rsplit("/", 2)[-2:]
            if (table, commit.removeprefix(f"{COMMIT}=")) not in live and changed <= before:
                gone.append(name)
        for name in gone:
            self.files.delete(name)
        return gone


class Transaction:
    """Changes to several tables, made from one state; nothing shows before ``commit``."""

    def __init__(self, log: SnapshotLog, run_id: str, state: dict):
        self.log, self.run_id, self.state = log, run_id, state
        self.commit_id = uuid.uuid4().hex
        self.replaced: dict[str, dict[str, list[str]]] = {}
        self.appended: dict[str, list[str]] = {}
        self.whole: set[str] = set()
        self.made: dict[str, dict] = {}

    def _table(self, name: str) -> dict | None:
        return self.state["tables"].get(name)

    def _write(self, table: str, df: DataFrame, partition_by: list[str], placed: bool = False) -> list[str]:
        if table in self.made:
            raise ValueError(f"{table} is changed twice in one commit")
        known = self._table(table)
        if known:
            schema = T.StructType.fromJson(known["schema"])
            unknown = {c.lower() for c in df.columns} - {f.name.lower() for f in schema}
            if unknown or partition_by != known["partition_by"]:
                raise ValueError(f"{table}: columns {sorted(unknown)} are unknown, or the partitions differ")
            df = by_schema(df, schema)
        order = [c for c in df.columns if c not in partition_by] + partition_by
        base = f"{self.log.root}/data/{table}/{COMMIT}={self.commit_id}"
        out = df.select(*order)
        writer = (out.hint("rebalance", *partition_by) if partition_by and not placed else out).write.option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(base)
        self.made[table] = {"schema": known["schema"] if known else out.schema.jsonValue(), "partition_by": partition_by, "parts": {}}
        if not partition_by:
            return [""]
        pattern = "/".join([base, *[f"{c}=*" for c in partition_by]])
        return [n.split(f"{COMMIT}={self.commit_id}/", 1)[1] for n, _ in self.log.files.names(pattern)]

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows to a table without partitions."""
        self.appended[table] = self._write(table, df, [])

    def replace(self, table: str, df: DataFrame, partition_by: list[str] | None = None, whole: bool = False,
                placed: bool = False) -> None:
        """Replace the partitions that ``df`` has (``whole``: the table) by its rows.

        ``placed`` says that the rows come from files of the same partitions, so each task
        has few of them already and the rows aren't shuffled to be together.
        """
        parts = self._write(table, df, partition_by or [], placed)
        self.replaced[table] = {p: [self.commit_id] for p in parts}
        if whole or not partition_by:
            self.whole.add(table)

    def upsert(self, table: str, incoming: DataFrame, keys: list[str], partition_by: str, order: list[str] | None = None) -> None:
        """Rows replace those of their key; only partitions that ``incoming`` touches are read and written."""
        if self._table(table) is None:
            merged = dedupe_by_key(incoming, keys, prefer="max", order=order)
        else:
            current = self.log.read(table, state=self.state)
            touched = [r[0] for r in incoming.select(partition_by).distinct().collect()]  # a value per partition
            same = F.col(partition_by).isin([v for v in touched if v is not None])
            same = (same | F.col(partition_by).isNull()) if None in touched else same
            unknown = {c.lower() for c in incoming.columns} - {c.lower() for c in current.columns}
            if unknown:
                raise ValueError(f"{table}: columns {sorted(unknown)} are unknown")
            merged = merge_by_key(current.where(same), incoming, keys, order=order)
        self.replace(table, merged, [partition_by])

    def fold_latest(self, table: str, incoming: DataFrame, key: str, order: list[str]) -> None:
        """Keep the row with the greatest ``order`` of each key: a maximum, so late and repeated rows change nothing."""
        current = self.log.read(table, state=self.state) if self._table(table) else None
        self.replace(table, merge_latest(current, incoming, key, order), whole=True)

    def commit(self) -> int:
        """Put the next version in place; ``Conflict`` if a commit since changed the same partitions."""
        changed = {t: sorted(p) for t, p in self.replaced.items()}
        base = self.state["version"]
        while True:
            latest = self.log.state()
            if self.run_id in latest["runs"]:
                return latest["runs"][self.run_id]
            for version in range(base + 1, latest["version"] + 1):
                theirs = self.log.state(version)["changed"]
                for table, parts in changed.items():
                    if table in theirs and (table in self.whole or "*" in theirs[table] or set(parts) & set(theirs[table])):
                        raise Conflict(f"{table} was changed in version {version}")
            tables = dict(latest["tables"])
            for table, told in self.made.items():
                parts = {} if table in self.whole else dict(tables.get(table, told)["parts"])
                parts.update(self.replaced.get(table, {}))
                for p in self.appended.get(table, []):
                    parts[p] = [*parts.get(p, []), self.commit_id]
                tables[table] = {**told, "parts": parts}
            number = latest["version"] + 1
            state = {"version": number, "run": self.run_id, "tables": tables, "runs": {**latest["runs"], self.run_id: number},
                     "changed": {t: ["*"] if t in self.whole else p for t, p in changed.items()}}
            if self.log.files.put_new(f"{self.log.root}/log/{number:020d}.json", json.dumps(state)):
                return number
