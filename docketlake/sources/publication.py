"""Publication of several tables at once: all of them or none, also after a crash.

Tables are written to a stage beside the output; a journal names what is to be put
in place; old tables move to the stage and new ones to the output; then the journal says
``committed`` and the stage goes.  ``recover`` rolls back what was not committed.  All
goes through the Hadoop file system of the path, so any shared storage will do whose
renames of folders are whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


class Publisher:
    """Puts tables in place below ``output``; ``after`` is called with the name of each step done (for tests of crashes)."""

    def __init__(self, spark: SparkSession, output: str, after: Callable[[str], None] | None = None):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.output = output.rstrip("/")
        self._fs = self._path(self.output).getFileSystem(spark._jsc.hadoopConfiguration())
        self._utf8 = lambda text: bytearray(text.encode())
        parent, name = self.output.rsplit("/", 1)
        self.parent, self.journal = parent, f"{parent}/.{name}-publication.json"
        self.after = after or (lambda step: None)

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target.rsplit("/", 1)[0]))
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def _drop(self, path: str) -> None:
        if self._exists(path):
            self._fs.delete(self._path(path), True)

    def _write_journal(self, plan: dict) -> None:
        fresh = f"{self.journal}.{uuid4().hex}"
        out = self._fs.create(self._path(fresh), True)
        out.write(self._utf8(json.dumps(plan)))
        out.close()
        self._drop(self.journal)
        self._move(fresh, self.journal)

    def _read_journal(self) -> dict | None:
        if not self._exists(self.journal):
            # the moment between dropping the old journal and putting the new one in place
            left = [str(s.getPath()) for s in (self._fs.globStatus(self._path(f"{self.journal}.*")) or [])]
            if not left:
                return None
            self._move(left[0], self.journal)
        stream = self._fs.open(self._path(self.journal))
        size = self._fs.getFileStatus(self._path(self.journal)).getLen()
        text = bytes(stream.readNBytes(int(size))).decode()
        stream.close()
        return json.loads(text)

    def recover(self) -> bool:
        """Roll back an interrupted publication, or finish a committed one; True if there was one."""
        plan = self._read_journal()
        if plan is None:
            return False
        if plan["state"] != "committed":
            for entry in reversed(plan["entries"]):
                name, stage = entry["name"], plan["stage"]
                if entry["had_old"]:
                    if self._exists(f"{stage}/old/{name}"):
                        self._drop(f"{self.output}/{name}")
                        self._move(f"{stage}/old/{name}", f"{self.output}/{name}")
                elif not self._exists(f"{stage}/new/{name}"):
                    self._drop(f"{self.output}/{name}")
        self._drop(plan["stage"])
        self._drop(self.journal)
        return True

    def publish(self, tables: dict[str, DataFrame], fresh: bool = False) -> None:
        """Write ``tables`` as parquet below the output, all or none; with ``fresh`` other tables there go in the same step."""
        self.recover()
        stage = f"{self.parent}/.{self.output.rsplit('/', 1)[1]}-stage-{uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{stage}/new/{name}")
        self.after("staged")
        present = [str(s.getPath().getName()) for s in (self._fs.listStatus(self._path(self.output)) if self._exists(self.output) else [])]
        names = sorted({*tables, *(present if fresh else ())})
        plan = {"state": "prepared", "stage": stage, "entries": [{"name": n, "had_old": n in present} for n in names]}
        self._write_journal(plan)
        self.after("prepared")
        for n in names:
            if n in present:
                self._move(f"{self.output}/{n}", f"{stage}/old/{n}")
                self.after(f"old {n}")
            if n in tables:
                self._move(f"{stage}/new/{n}", f"{self.output}/{n}")
                self.after(f"new {n}")
        self._write_journal(plan | {"state": "committed"})
        self.after("committed")
        self.recover()
