"""A commit log over files: what a micro-batch writes is hidden until one manifest names all of it.

A target folder holds tables (`data`, `positions`, ...), each in folders `attempt=...`, and `commits`, with
a numbered manifest for each commit. A manifest appears whole, by a rename that fails if its number is
taken, so commits have one order. Readers take the attempts that manifests name; whatever else lies
there is of batches that never ended. Each run takes a higher epoch than all before it, and a commit of
a run that another has followed is refused. Needs a file system whose rename within a folder is atomic.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "n bigint, epoch bigint, run string, writer string, batch bigint, attempt string, base boolean"


class StaleRun(RuntimeError):
    """Another run has taken over this target."""


class _Files:
    """The few steps on files that commits need, on whatever file system holds the path."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.gateway, self.conf = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def exists(self, text: str) -> bool:
        return self.path(text).getFileSystem(self.conf).exists(self.path(text))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return [s.getPath().getName() for s in self.path(folder).getFileSystem(self.conf).listStatus(self.path(folder))]

    def read(self, text: str) -> str:
        stream = self.path(text).getFileSystem(self.conf).open(self.path(text))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, text: str, content: str) -> bool:
        """Writes a file that appears whole, or not at all where there is one of its name."""
        to, fs = self.path(text), self.path(text).getFileSystem(self.conf)
        made = self.path(f"{to.getParent().toString()}/.{uuid.uuid4().hex}.tmp")
        stream = fs.create(made, True)
        stream.write(bytearray(content.encode()))
        stream.close()
        none = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(to).toUri(), self.conf).rename(fs.makeQualified(made), fs.makeQualified(to), none)
        except Py4JJavaError as e:
            fs.delete(made, False)
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise
        return True

    def delete(self, text: str) -> None:
        self.path(text).getFileSystem(self.conf).delete(self.path(text), True)


class CommitLog:
    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target, self.files = spark, target, _Files(spark)

    def _at(self, n: int) -> str:
        return f"{self.target}/commits/{n:012d}.json"

    def manifests(self) -> DataFrame | None:
        """A row for each commit and each run's start (its attempt is null); None before the first."""
        if not self.files.exists(f"{self.target}/commits"):
            return None
        return self.spark.read.schema(MANIFEST).json(f"{self.target}/commits")

    def read(self, table: str, since: int = 0) -> DataFrame | None:
        """The committed rows of a table, with the number of their commit as `commit`; None where there is
        nothing. Attempts that no manifest names are never read, nor are commits before `since`."""
        known = self.manifests()
        if known is None or not self.files.exists(f"{self.target}/{table}"):
            return None
        named = known.where(F.col("attempt").isNotNull() & (F.col("n") >= since)).select("attempt", F.col("n").alias("commit"))
        return self.spark.read.parquet(f"{self.target}/{table}").join(named, "attempt").drop("attempt")

    def last_base(self) -> int:
        """The newest commit that holds all that was before it; 0 without one."""
        known = self.manifests()
        return (known.where("base").agg(F.max("n")).first()[0] or 0) if known is not None else 0

    def start(self, checkpoint: str) -> Run:
        """A new run, which stops those before it. Its writer is known by a file in the stream's checkpoint:
        with that checkpoint batches keep their numbers, and one that is committed is known again; an
        empty checkpoint is another writer, whose batches are all its own."""
        named = f"{checkpoint}/tidelog-writer.json"
        self.files.publish(named, json.dumps({"writer": uuid.uuid4().hex}))
        writer = json.loads(self.files.read(named))["writer"]
        while True:
            known = self.manifests()
            top = known.agg(F.max("n").alias("n"), F.max("epoch").alias("epoch"), F.max(F.when(F.col("writer") == writer, F.col("batch"))).alias("batch")).first() if known is not None else None
            n, epoch = (top.n or 0, top.epoch or 0) if top else (0, 0)
            last = -1 if top is None or top.batch is None else top.batch
            run = Run(self, writer, uuid.uuid4().hex, n + 1, epoch + 1, last)
            if self.files.publish(self._at(n + 1), run.manifest(-1, None)):
                return run

    def vacuum(self, tables: tuple[str, ...] = ("data", "positions"), before: int = 0) -> int:
        """Deletes what runs before the newest left unfinished, and commits before number `before`; gives how
        many folders went."""
        known = self.manifests()
        if known is None:
            return 0
        newest = known.agg(F.max("epoch")).first()[0]
        kept = {r.attempt for r in known.where(F.col("attempt").isNotNull() & (F.col("n") >= before)).select("attempt").toLocalIterator()}
        gone = 0
        for table in tables:
            for name in self.files.names(f"{self.target}/{table}"):
                attempt = name.removeprefix("attempt=")
                named = attempt in kept
                if name != attempt and not named and (int(attempt[1:].split("-")[0]) < newest or before):
                    self.files.delete(f"{self.target}/{table}/{name}")
                    gone += 1
        return gone


class Run:
    """One start of a stream on a commit log."""

    def __init__(self, log: CommitLog, writer: str, run: str, n: int, epoch: int, last: int):
        self.log, self.writer, self.run, self.n, self.epoch, self.last = log, writer, run, n, epoch, last

    def manifest(self, batch: int, attempt: str | None, base: bool = False) -> str:
        return json.dumps({"n": self.n + (batch >= 0), "epoch": self.epoch, "run": self.run, "writer": self.writer, "batch": batch, "attempt": attempt, "base": base})

    def is_committed(self, batch: int) -> bool:
        return batch <= self.last

    def commit(self, batch: int, tables: dict[str, DataFrame], base: bool = False) -> bool:
        """Writes the tables and then names them, all at once; False where the batch was committed before.
        A run that another has followed gets StaleRun, and what it wrote stays hidden."""
        if self.is_committed(batch):
            return False
        attempt = f"e{self.epoch}-{self.writer[:8]}-{batch}-{uuid.uuid4().hex[:8]}"
        for name, df in tables.items():
            df.write.parquet(f"{self.log.target}/{name}/attempt={attempt}")
        while not self.log.files.publish(self.log._at(self.n + 1), self.manifest(batch, attempt, base)):
            other = json.loads(self.log.files.read(self.log._at(self.n + 1)))
            if other["epoch"] > self.epoch:
                raise StaleRun(f"epoch {self.epoch} of {self.log.target} was followed by {other['epoch']}")
            self.n += 1
        self.n, self.last = self.n + 1, batch
        return True
