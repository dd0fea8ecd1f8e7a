"""Partitioned tables whose partitions are replaced all at once, by a record of what counts.

    root/data/v=<version>/<key>=<value>/...   what a run has written, never changed afterwards
    root/_record/<number>.json                which version of each partition counts, and properties

A run writes a version of its own, proves it, and then writes the next record: from that moment on,
and not a file sooner, readers see all of it. A run that dies earlier has changed nothing, one that
dies later leaves only what the next run clears away: versions that the record does not name, and
files that the record says are used up.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from limitlens.storage import drop_folder, file_system, folder_names


@dataclass(frozen=True)
class Record:
    """``parts``: partition path -> version. ``retired``: files that the version before made superfluous."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    properties: dict = field(default_factory=dict)
    retired: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class VersionedTable:
    """A table of declared schema, partitioned by ``keys`` (name, type), the outermost first."""

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: tuple[tuple[str, T.DataType], ...]

    @property
    def names(self) -> list[str]:
        return [k for k, _ in self.keys]

    def part(self, *values) -> str:
        return "/".join(f"{k}={v}" for k, v in zip(self.names, values, strict=True))

    # --- the record -----------------------------------------------------------------------

    def record(self) -> Record:
        """The newest complete record; an empty one before the first run."""
        found = [n for n in folder_names(self.spark, f"{self.root}/_record") if n.endswith(".json")]
        if not found:
            return Record()
        text = bytes(_content(self.spark, f"{self.root}/_record/{found[-1]}")).decode()
        return Record(**json.loads(text))

    def commit(self, before: Record, parts: dict[str, str | None], properties: dict | None = None, retired: Iterable[str] = ()) -> Record:
        """Switch partitions to the versions given (None: the partition goes). ``before`` is what the run
        began with: if another run has committed since, this one fails and changes nothing."""
        merged = {k: v for k, v in {**before.parts, **parts}.items() if v is not None}
        after = replace(
            before, number=before.number + 1, parts=merged, properties={**before.properties, **(properties or {})}, retired=list(retired)
        )
        system, folder = file_system(self.spark, f"{self.root}/_record")
        system.mkdirs(folder)
        _, written = file_system(self.spark, f"{self.root}/_record/.{after.number:09d}-{uuid.uuid4().hex}")
        out = system.create(written, False)
        out.write(bytearray(json.dumps(after.__dict__).encode()))
        out.close()
        _, final = file_system(self.spark, f"{self.root}/_record/{after.number:09d}.json")
        if system.exists(final) or not system.rename(written, final):
            raise RuntimeError(f"{self.root} was changed by another run")
        return after

    def clear(self, sidecars: Iterable[str] = ()) -> None:
        """Delete what the record does not name, here and in the ``sidecars`` that follow it, and used-up files."""
        now = self.record()
        for file in now.retired:
            drop_folder(self.spark, file)
        for root in (self.root, *sidecars):
            for part, versions in self._there(root).items():
                for version in versions - {now.parts.get(part)}:
                    drop_folder(self.spark, f"{root}/data/v={version}/{part}")
            kept = set(now.parts.values())
            for name in folder_names(self.spark, f"{root}/data"):
                if name.removeprefix("v=") not in kept:
                    drop_folder(self.spark, f"{root}/data/{name}")
        for name in folder_names(self.spark, f"{self.root}/_record"):
            if name != f"{now.number:09d}.json":
                drop_folder(self.spark, f"{self.root}/_record/{name}")

    # --- data -----------------------------------------------------------------------------

    def new_version(self) -> str:
        return uuid.uuid4().hex

    def folder(self, version: str, root: str | None = None) -> str:
        return f"{root or self.root}/data/v={version}"

    def _there(self, root: str) -> dict[str, set[str]]:
        """Partition path -> versions that have a folder of it. One listing, no file is opened."""
        pattern = "/".join([f"{root}/data/v=*", *[f"{k}=*" for k in self.names]])
        system, path = file_system(self.spark, pattern)
        out: dict[str, set[str]] = {}
        for status in system.globStatus(path) or []:
            version, *keys = status.getPath().toString().split("/")[-1 - len(self.keys):]
            out.setdefault("/".join(keys), set()).add(version.removeprefix("v="))
        return out

    def folders(
        self, record: Record | None = None, parts: Iterable[str] | None = None, root: str | None = None,
        versions: Iterable[str] | None = None,
    ) -> list[str]:
        """The folders of the partitions that count and exist; of ``parts`` only, or of uncommitted ``versions``."""
        root = root or self.root
        there = self._there(root)
        if versions is not None:
            named = [(p, v) for p, found in there.items() for v in found if v in set(versions)]
        else:
            now = self.record() if record is None else record
            some = None if parts is None else set(parts)
            named = [(p, v) for p, v in now.parts.items() if v in there.get(p, ()) and (some is None or p in some)]
        return [f"{root}/data/v={v}/{p}" for p, v in self._widened(named, there)]

    def read(
        self, record: Record | None = None, parts: Iterable[str] | None = None, root: str | None = None,
        schema: T.StructType | None = None, versions: Iterable[str] | None = None,
    ) -> DataFrame:
        """Rows of :meth:`folders`, with the keys as columns.

        ``root`` and ``schema`` read a table that follows this one's record.
        """
        schema = schema or self.schema
        whole = T.StructType([f for f in schema.fields if f.name not in self.names])
        for name, kind in (("v", T.StringType()), *self.keys):
            whole = whole.add(name, kind)
        columns = [*schema.names, *[n for n in self.names if n not in schema.names]]
        folders = self.folders(record, parts, root, versions)
        if not folders:
            return self.spark.createDataFrame([], whole).select(*columns)
        return self.spark.read.schema(whole).option("basePath", f"{root or self.root}/data").parquet(*folders).select(*columns)

    @staticmethod
    def _widened(named: list[tuple[str, str]], there: dict[str, set[str]]) -> list[tuple[str, str]]:
        """Fewer folders for the same partitions: a version of which every partition is read is one folder."""
        held: dict[str, int] = {}
        for versions in there.values():
            for version in versions:
                held[version] = held.get(version, 0) + 1
        wanted: dict[str, list[str]] = {}
        for part, version in named:
            wanted.setdefault(version, []).append(part)
        out = []
        for version, parts in sorted(wanted.items()):
            out += [("", version)] if len(parts) == held[version] else [(p, version) for p in sorted(parts)]
        return out


def _content(spark: SparkSession, path: str) -> bytes:
    system, target = file_system(spark, path)
    stream = system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
