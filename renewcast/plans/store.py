"""Steps: tables by name, each written once and read by whatever needs it.

A step's mark is a hash of its code, the settings, the marks of the steps that it reads and, for the first ones, of the
source's files.  A table stands under its name and mark, so what other code, settings or data have left is never read
for it, nor what comes after.  Tables get their name once they are whole, so a run that broke off, or another session
at work in the same folder, leaves nothing half written behind it.
"""
from __future__ import annotations

import hashlib
import inspect
import json
import tempfile
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

from renewcast.config import Config


@dataclass(frozen=True)
class Step:
    """A table by name: how it is made of those that it reads (``make(tables, cfg)``; steps without reads have the
    source, ``make(spark, sf_dir, cfg)``), the modules whose code that is, and its key."""

    name: str
    make: Callable[..., DataFrame]
    reads: tuple[str, ...] = ()
    code: tuple[ModuleType, ...] = ()
    key: tuple[str, ...] = ()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see; a local session without one has a temporary folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("renewcast.steps.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="renewcast-steps-")
        spark.conf.set("renewcast.steps.dir", found)
    return found.rstrip("/")


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def source_mark(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> str:
    """Names, sizes and times of the source's files."""
    found = []
    for t in tables:
        fs, p = _files(spark, f"{sf_dir}/{t}.parquet")
        status = [fs.getFileStatus(p)] if fs.getFileStatus(p).isFile() else list(fs.listStatus(p))
        found += [(t, s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in status]
    return json.dumps(sorted(found))


class Steps(Mapping):
    """The tables of steps over a source, made when they are first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Config, steps: tuple[Step, ...], sources: tuple[str, ...], folder: str | None = None):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg
        self.steps, self.sources = {s.name: s for s in steps}, sources
        self.folder = folder or f"{shared_dir(spark)}/renewcast-steps"
        self.tables: dict[str, DataFrame] = {}
        self.marks: dict[str, str] = {}
        self.made: list[dict] = []

    def __iter__(self):
        return iter(self.steps)

    def __len__(self) -> int:
        return len(self.steps)

    def mark(self, name: str) -> str:
        if name not in self.marks:
            step = self.steps[name]
            parts = [name, inspect.getsource(step.make), *(inspect.getsource(m) for m in step.code), json.dumps(asdict(self.cfg), sort_keys=True)]
            parts += [self.mark(r) for r in step.reads] or [self.sf_dir, source_mark(self.spark, self.sf_dir, self.sources)]
            self.marks[name] = hashlib.sha256("\0".join(parts).encode()).hexdigest()[:16]
        return self.marks[name]

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{self.mark(name)}"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.tables:
            fs, there = _files(self.spark, self.path(name))
            if not fs.exists(there):
                self._write(name, fs, there)
            self.tables[name] = self.spark.read.parquet(self.path(name))
        return self.tables[name]

    def _write(self, name: str, fs, there) -> None:
        step, began = self.steps[name], time.time()
        rows = step.make({r: self[r] for r in step.reads}, self.cfg) if step.reads else step.make(self.spark, self.sf_dir, self.cfg)
        temp = f"{self.folder}/writing-{name}-{uuid.uuid4().hex}"
        rows.write.parquet(temp)
        if step.key and (n := self.spark.read.parquet(temp).groupBy(*step.key).count().where("count > 1").count()):
            raise ValueError(f"{name}: {n} keys are not unique")
        # If another session was faster, its table is the same.
        whole = _files(self.spark, temp)[1]
        if fs.exists(there) or not fs.rename(whole, there):
            fs.delete(whole, True)
            if not fs.exists(there):
                raise OSError(f"{temp} could not be renamed to {self.path(name)}")
        self.made.append({"step": name, "mark": self.mark(name), "seconds": round(time.time() - began, 3)})

    def forget(self, name: str) -> None:
        """Have a step, and all that read it, made again."""
        for s in self.after(name):
            fs, there = _files(self.spark, self.path(s))
            fs.delete(there, True)
            self.tables.pop(s, None)

    def after(self, name: str) -> list[str]:
        """A step and those that read it, directly or not."""
        reached = {name}
        while more := {s.name for s in self.steps.values() if s.name not in reached and reached & set(s.reads)}:
            reached |= more
        return [s for s in self.steps if s in reached]

    def drop_stale(self) -> list[str]:
        """Delete what other settings, code or data have left in the folder under these steps' names."""
        fs, root = _files(self.spark, self.folder)
        current = {self.path(s).rpartition("/")[2] for s in self.steps}
        gone = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name not in current and name.rpartition("-")[0] in self.steps:
                fs.delete(status.getPath(), True)
                gone.append(name)
        return gone
