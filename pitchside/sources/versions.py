"""Numbered versions of a folder of tables, switched by one pointer.

A version is a set of tables written under ``d-<number>-<id>/`` and a record
``_versions/<number>.json`` that names their folders. The record is created last, whole and
only if its number is free, so

- readers resolve every table through the newest record and see one version, never a mix;
- a write that fails, in any of the tables, leaves the versions before as they were;
- of two writers that started from the same version the second is refused (``Conflict``).

After a commit the newest ``keep`` versions stay, so a reader that resolved an older one has
``keep - 1`` commits to finish. Folders whose number is taken but which no record names belong
to refused or dead writers and go too.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from pitchside.sources import hadoop, store

KEEP = 2


class Conflict(RuntimeError):
    """Another writer committed the version that this one was to become."""


@dataclass(frozen=True)
class Version:
    number: int
    tables: dict[str, str]  # name -> path
    info: dict = field(default_factory=dict)


class Draft:
    """A version being written: ``path(name)`` is where a table goes; ``commit`` makes it current."""

    def __init__(self, versions: Versions, number: int, folder: str | None = None):
        self.versions, self.number = versions, number
        self.folder = folder or f"d-{number:08d}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.versions.root}/{self.folder}/{name}"

    def commit(self, names: list[str], info: Mapping | None = None) -> Version:
        record = {"tables": {n: f"{self.folder}/{n}" for n in names}, "info": dict(info or {})}
        if not hadoop.create_if_absent(self.versions.spark, self.versions.record_path(self.number), json.dumps(record)):
            raise Conflict(f"{self.versions.root}: version {self.number} was committed by another writer")
        self.versions.prune()
        return self.versions.version(self.number)

    def drop(self) -> None:
        hadoop.delete(self.versions.spark, f"{self.versions.root}/{self.folder}")


class Versions:
    def __init__(self, spark: SparkSession, root: str, keep: int = KEEP):
        if keep < 1:
            raise ValueError("at least the current version is kept")
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def record_path(self, number: int) -> str:
        return f"{self.root}/_versions/{number:08d}.json"

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in hadoop.names(self.spark, f"{self.root}/_versions") if n.endswith(".json") and not n.startswith(".")]

    def version(self, number: int | None = None) -> Version | None:
        """One version (the newest without a number), or None."""
        there = self.numbers()
        number = max(there, default=0) if number is None else number
        if number not in there:
            return None
        record = json.loads(hadoop.read_text(self.spark, self.record_path(number)))
        return Version(number, {n: f"{self.root}/{p}" for n, p in record["tables"].items()}, record["info"])

    def tables(self, number: int | None = None) -> dict[str, DataFrame]:
        """The tables of one version."""
        if (v := self.version(number)) is None:
            raise FileNotFoundError(f"{self.root} has no version" + (f" {number}" if number else ""))
        return {n: self.spark.read.parquet(p) for n, p in v.tables.items()}

    def draft(self) -> Draft:
        """A new version that follows the newest one of now."""
        return Draft(self, max(self.numbers(), default=0) + 1)

    def write(self, tables: Mapping[str, DataFrame], info: Mapping | None = None) -> Version:
        """Write all tables and make them the current version, or leave everything as it was.
        The version's info also has the row count of each, taken while it was written."""
        if not tables:
            raise ValueError("nothing to write")
        draft = self.draft()
        try:
            counts = {name: store.write_observed(df, draft.path(name))["n_rows"] for name, df in tables.items()}
            return draft.commit(list(tables), {**(info or {}), "n_rows": counts})
        except Exception:
            draft.drop()
            raise

    def prune(self) -> None:
        """Delete all but the newest ``keep`` versions, and folders that lost their number."""
        there = sorted(self.numbers())
        kept = there[-self.keep :]
        named = {self.version(n).tables[t].removeprefix(f"{self.root}/").split("/")[0] for n in kept for t in self.version(n).tables}
        for n in there[: -self.keep]:
            hadoop.delete(self.spark, self.record_path(n))  # first: what is listed can be read
        for name in hadoop.names(self.spark, self.root):
            if name.startswith("d-") and name not in named and int(name.split("-")[1]) <= max(there, default=0):
                hadoop.delete(self.spark, f"{self.root}/{name}")
