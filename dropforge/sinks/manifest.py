"""Versions of a store: which load of each table counts, published by one rename.

A version is a small text file, ``v<number>.json``, in the folder ``_versions`` of the store. It is written under
another name first; renaming it to the next number publishes it. A rename to a number that is there already fails, so of
two writers one comes second; it takes the newer version and applies its own change to it. Nobody sees half a version.
"""

from __future__ import annotations

import copy
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

FOLDER = "_versions"
KEPT = 50  # earlier versions that stay, for readers that are just opening one
ATTEMPTS = 20


def empty() -> dict:
    """``tables``, ``history`` and ``streams``: see ``dropforge.sinks.store``."""
    return {"tables": {}, "history": {}, "streams": {}}


class Manifests:
    def __init__(self, spark: SparkSession, home: str) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.folder = f"{home.rstrip('/')}/{FOLDER}"
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    @staticmethod
    def _name(number: int) -> str:
        return f"v{number:012d}.json"

    def numbers(self) -> list[int]:
        folder = self._path("")
        if not self._fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if re.fullmatch(r"v\d+\.json", n))

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._path(self._name(number)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """The newest version and its number; 0 and an empty one before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, empty())

    def publish(self, change: Callable[[dict], None]) -> dict:
        """Apply ``change`` to the newest version and publish the outcome."""
        for _ in range(ATTEMPTS):
            number, content = self.latest()
            content = copy.deepcopy(content)
            change(content)
            if self._put(number + 1, content):
                self._tidy(number + 1)
                return content
        raise RuntimeError(f"{self.folder}: other writers were first {ATTEMPTS} times")

    def _put(self, number: int, content: dict) -> bool:
        fs = self._jvm.org.apache.hadoop.fs
        aside, target = self._path(f".{uuid.uuid4().hex}"), self._path(self._name(number))
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        out.close()
        plainly = self._gateway.new_array(getattr(fs, "Options$Rename"), 0)  # no overwriting
        try:
            fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(aside, target, plainly)
        except Exception:
            self._fs.delete(aside, False)
            if self._fs.exists(target):
                return False
            raise
        return True

    def _tidy(self, number: int) -> None:
        for old in self.numbers():
            if old <= number - KEPT:
                self._fs.delete(self._path(self._name(old)), False)
