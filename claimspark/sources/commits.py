"""Commit records: what a table consists of is said by a small file that is written last.

Data goes to folders of its own, each write to a new one, so no reader ever
meets a folder that is still being written.  A record is one JSON file; it
names the folders that make up the table from then on and appears under its
number by renaming a finished file.  A run that breaks before its record
leaves only folders that no record names: readers skip them, and a retry
writes new ones.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer published first."""


class CommitLog:
    """Numbered records under ``root/commits``, data folders under ``root/data``.

    Records are never changed.  File systems whose rename refuses an existing
    name (HDFS) let one of two concurrent writers through; where a rename
    may replace, writers must take turns.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.data = f"{self.root}/data"
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def new_part(self) -> str:
        """Name of a folder that no writer has used."""
        return uuid.uuid4().hex

    def part_path(self, part: str) -> str:
        return f"{self.data}/part={part}"

    def _names(self, folder: str) -> list[tuple[str, int]]:
        path = self._path(folder)
        if not self._files.exists(path):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self._files.listStatus(path)]

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n, _ in self._names(f"{self.root}/commits") if n.endswith(".json") and n[0] != ".")

    def record(self, number: int) -> dict:
        stream = self._files.open(self._path(self._file(number)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _file(self, number: int) -> str:
        return f"{self.root}/commits/{number:012d}.json"

    def records(self) -> list[dict]:
        return [self.record(n) for n in self.numbers()]

    def latest(self) -> dict | None:
        numbers = self.numbers()
        return self.record(numbers[-1]) if numbers else None

    def publish(self, record: dict, after: int | None = None) -> int:
        """Make ``record`` the newest; ``after`` is the number it was prepared on (default: the newest now)."""
        numbers = self.numbers()
        last = numbers[-1] if numbers else -1
        if after is not None and after != last:
            raise CommitConflict(f"record {last} came after {after}")
        number = last + 1
        final, draft = self._path(self._file(number)), self._path(f"{self.root}/commits/.draft-{uuid.uuid4().hex}")
        out = self._files.create(draft, True)
        try:
            out.write(bytearray(json.dumps(record | {"number": number, "at": time.time()}).encode()))
        finally:
            out.close()
        if self._files.exists(final) or not self._files.rename(draft, final):
            self._files.delete(draft, False)
            raise CommitConflict(f"record {number} exists")
        return number

    def expire(self, keep: int, used, orphan_age: float = 86400.0) -> list[str]:
        """Drop all but the newest ``keep`` records and the data that none of those uses; returns what was deleted.

        ``used(record)`` lists folders under ``data``, such as ``part=x`` or
        ``part=x/is_current=true``.  A folder that no record ever named may
        belong to a running writer and stays until it is ``orphan_age``
        seconds old.
        """
        records = self.records()
        kept = {folder for r in records[max(0, len(records) - keep):] for folder in used(r)}
        known = {folder for r in records for folder in used(r)}
        deleted = []
        for name, changed in self._names(self.data):
            inner = {f for f in known if f.startswith(f"{name}/")}
            if name in kept:
                continue
            if name not in known and not inner:
                gone = [name] if time.time() - changed / 1000 >= orphan_age else []
            elif any(f.startswith(f"{name}/") for f in kept):
                gone = [f"{name}/{sub}" for sub, _ in self._names(f"{self.data}/{name}") if "=" in sub and f"{name}/{sub}" not in kept]
            else:
                gone = [name]
            for folder in gone:
                self._files.delete(self._path(f"{self.data}/{folder}"), True)
                deleted.append(folder)
        for r in records[:max(0, len(records) - keep)]:
            self._files.delete(self._path(self._file(r["number"])), False)
        return deleted
