"""Refresh of derived tables that have gone stale.

The reference keeps derived tables fresh with a managed lag; here a refresh is a batch job over a graph
of tables.  A table's fingerprint covers all it was made from: the files of its source tables (path, size,
modification time), the fingerprints of the derived tables it reads, its layout and its version.  Its rows
live in a folder of that name, so a table is fresh if the folder is complete, whoever wrote it and in
whichever session, and a change of one input makes exactly the tables behind it stale.  A build writes a
folder of its own and leaves the one before it to its readers.  The continuous form of the same chain is the
streaming variant (§2.15).
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ..sources.io import materialize, materialize_bucketed, open_bucketed


@dataclass(frozen=True)
class Derived:
    """A derived table: its inputs (sources or derived tables), ``build(inputs by name)``, optional cluster
    keys (written bucketed by them, so the next aggregation or join on them needs no shuffle) and a version
    to raise when ``build`` changes."""

    inputs: Sequence[str]
    build: Callable[[dict[str, DataFrame]], DataFrame]
    cluster: Sequence[str] = field(default=())
    buckets: int = 16
    version: str = "1"


class Refreshed(NamedTuple):
    tables: dict[str, DataFrame]
    built: list[str]


class _Files:
    def __init__(self, spark: SparkSession):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def fs(self, path: str):
        p = self.path(path)
        return p, p.getFileSystem(self.conf)

    def state(self, df: DataFrame) -> list[str]:
        """Path, size and modification time of every file that ``df`` reads, listed folder by folder."""
        files = {self.path(f).toUri().getPath(): f for f in df.inputFiles()}
        out = []
        for folder in sorted({os.path.dirname(f) for f in files.values()}):
            p, fs = self.fs(folder)
            for st in fs.listStatus(p):
                name = st.getPath().toUri().getPath()
                if name in files:
                    out.append(f"{name} {st.getLen()} {st.getModificationTime()}")
        return sorted(out)

    def done(self, path: str) -> bool:
        p, fs = self.fs(os.path.join(path, "_SUCCESS"))
        return fs.exists(p)

    def older(self, folder: str, keep: int) -> list[str]:
        """Names of all but the newest ``keep`` folders."""
        p, fs = self.fs(folder)
        found = sorted((st.getModificationTime(), st.getPath().getName()) for st in fs.listStatus(p)) if fs.exists(p) else []
        return [name for _, name in found[:-keep]]

    def delete(self, path: str) -> None:
        p, fs = self.fs(path)
        fs.delete(p, True)


def source_state(spark: SparkSession, df: DataFrame) -> list[str]:
    """Path, size and modification time of every file that ``df`` reads."""
    return _Files(spark).state(df)


def refresh_root(spark: SparkSession, name: str) -> str:
    """A lasting folder for derived tables: below the warehouse, not the checkpoint folder."""
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "strata_derived", name)


def refresh(spark: SparkSession, graph: Mapping[str, Derived], sources: Mapping[str, DataFrame], root: str) -> Refreshed:
    """Bring the tables of ``graph`` up to date below ``root``: stale ones are rebuilt after their inputs, fresh
    ones only opened.  Returns all tables and the names of those that were built."""
    files = _Files(spark)
    marks = {name: hashlib.sha256("\n".join(files.state(df)).encode()).hexdigest() for name, df in sources.items()}
    tables, built = dict(sources), []
    for name in TopologicalSorter({k: set(t.inputs) & set(graph) for k, t in graph.items()}).static_order():
        t = graph[name]
        made_of = [name, t.version, ",".join(t.cluster), str(t.buckets), *(marks[i] for i in t.inputs)]
        marks[name] = hashlib.sha256("\n".join(made_of).encode()).hexdigest()
        folder = os.path.join(root, name)
        path, entry = os.path.join(folder, marks[name][:16]), f"strata_{name}_{marks[name][:16]}"
        if files.done(path):
            tables[name] = open_bucketed(spark, path, t.cluster, t.buckets, entry) if t.cluster else spark.read.parquet(path)
            continue
        df = t.build({i: tables[i] for i in t.inputs})
        if t.cluster:
            spark.sql(f"DROP TABLE IF EXISTS {entry}")
            tables[name] = materialize_bucketed(df, path, t.cluster, t.buckets, entry)
        else:
            tables[name] = materialize(df, path)
        built.append(name)
        for old in files.older(folder, keep=2):
            spark.sql(f"DROP TABLE IF EXISTS strata_{name}_{old}")
            files.delete(os.path.join(folder, old))
    return Refreshed({k: tables[k] for k in graph}, built)
