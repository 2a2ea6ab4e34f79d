"""Numbered JSON entries, each created once: how writers that share a table agree (optimistic concurrency).

A writer reads the newest entry, works on top of it, and creates the next number. Only one can; another finds the number
taken, reads again and repeats its work. An entry appears whole: it is written aside and moved to its name by a rename
that never replaces, which HDFS and the like make atomic. On a local disk a lock inside the process stands in for that.
"""

from __future__ import annotations

import json
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_ONE_AT_A_TIME = threading.Lock()


class Files:
    """The few file operations a table needs, on whatever file system Spark reads."""

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def at(self, path: str):
        p = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._spark._jsc.hadoopConfiguration()), p

    def matching(self, pattern: str) -> list:
        fs, p = self.at(pattern)
        return list(fs.globStatus(p) or [])

    def exists(self, path: str) -> bool:
        fs, p = self.at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        fs, p = self.at(path)
        fs.delete(p, True)

    def size(self, path: str) -> int:
        fs, p = self.at(path)
        return fs.getContentSummary(p).getLength()

    def read(self, path: str) -> str:
        fs, p = self.at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Make the file with its whole text, or say that the name is taken."""
        folder, _, name = path.rpartition("/")
        fs, aside = self.at(f"{folder}/_{name}.{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        aside, target = fs.makeQualified(aside), fs.makeQualified(self.at(path)[1])
        gateway, jvm = self._spark.sparkContext._gateway, self._spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._spark._jsc.hadoopConfiguration())
        try:
            with _ONE_AT_A_TIME:
                context.rename(aside, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
            return True
        except Py4JJavaError as e:
            fs.delete(aside, False)
            if not fs.exists(target):
                raise
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False


class CommitLog:
    """Entries `<folder>/<n>.json`."""

    def __init__(self, files: Files, folder: str):
        self._files, self._folder = files, folder

    def _path(self, number: int) -> str:
        return f"{self._folder}/{number}.json"

    def numbers(self) -> list[int]:
        found = (s.getPath().getName().removesuffix(".json") for s in self._files.matching(f"{self._folder}/*.json"))
        return sorted(int(n) for n in found if n.isdigit())

    def read(self, number: int) -> dict:
        return json.loads(self._files.read(self._path(number)))

    def newest(self) -> tuple[int, dict]:
        """(number, entry); (-1, {}) where there is none."""
        while numbers := self.numbers():
            try:
                return numbers[-1], self.read(numbers[-1])
            except Py4JJavaError:
                if self._files.exists(self._path(numbers[-1])):
                    raise
        return -1, {}

    def create(self, number: int, entry: dict) -> bool:
        return self._files.create(self._path(number), json.dumps(entry, sort_keys=True))

    def remove(self, number: int) -> None:
        self._files.delete(self._path(number))


# --- which batches an entry holds ------------------------------------------------------------------
#
# Per stream, as [mark, others]: every batch from 0 to `mark`, and those above it in `others`. Batches of a stream are
# numbered without gaps, so however long it runs the list stays one number a stream.

def holds(held: dict, stream: str, batch: int) -> bool:
    mark, others = held.get(stream, (-1, ()))
    return 0 <= batch <= mark or batch in others


def holding(held: dict, pairs: list[tuple[str, int]]) -> dict:
    """`held` and the (stream, batch) `pairs`."""
    out = {s: (mark, set(others)) for s, (mark, others) in held.items()}
    for stream, batch in pairs:
        out.setdefault(stream, (-1, set()))[1].add(batch)
    for stream, (mark, others) in out.items():
        while mark + 1 in others:
            mark += 1
        out[stream] = [mark, sorted(n for n in others if not 0 <= n <= mark)]
    return out
