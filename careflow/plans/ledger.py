"""Which steps of a job are done, with the versions that they read and wrote.

A step's entry is one small JSON file, written after the step.  The step counts
as done while its inputs and parameters are those of the entry and its outputs
are still the versions in force; so a changed file, table or parameter, or a
table that somebody else replaced, makes the step and what depends on it run again.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..sources.tables import TableStore


class StepLedger:
    def __init__(self, spark: SparkSession, root: str, store: TableStore):
        self.spark, self.root, self.store = spark, root.rstrip("/"), store

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, tables: list[str]) -> dict[str, str | None]:
        return {name: self.store.current(name) for name in tables}

    def files(self, folder: str) -> dict[str, list]:
        """Length and time of change of every file below a folder."""
        p, fs = self._fs(folder)
        out: dict[str, list] = {}
        if fs.exists(p):
            found = fs.listFiles(p, True)
            while found.hasNext():
                f = found.next()
                name = f.getPath().toString()
                if not f.getPath().getName().startswith((".", "_")):
                    out[name] = [f.getLen(), f.getModificationTime()]
        return out

    def entry(self, step: str) -> dict | None:
        """The entry of a step; None without one, or where its writing broke off."""
        p, fs = self._fs(f"{self.root}/{step}.json")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:
            return None
        finally:
            stream.close()

    def done(self, step: str, inputs: dict) -> dict | None:
        """The result of the step if it need not run again."""
        entry = self.entry(step)
        if entry is None or entry["inputs"] != json.loads(json.dumps(inputs)):
            return None
        return entry["result"] if self.versions(list(entry["outputs"])) == entry["outputs"] else None

    def record(self, step: str, inputs: dict, outputs: list[str], result) -> None:
        text = json.dumps({"inputs": inputs, "outputs": self.versions(outputs), "result": result})
        p, fs = self._fs(f"{self.root}/{step}.json")
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
