"""Steps that resume: a journal of what is done, keyed by its inputs, and a halt that stands until it is lifted.

A step runs if the journal has no entry for its name and key; the entry is written when it has ended. A step that died is run
again, so it must be one that changes nothing when run twice, as all writers here are. A gate that trips leaves a halt: no step
runs until someone has lifted it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from rillflow.operators.integrity import GateError

#: Exit code of a run that finds a halt.
HALTED = 3


class Journal:
    """Entries and halt below a folder, by any path that Spark opens."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p}")
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _put(self, name: str, content: dict) -> None:
        """Whole or not at all: written beside, then moved."""
        staged = self._at(f"staging/{name}")
        self._files.mkdirs(self._at(name).getParent())
        out = self._files.create(staged, True)
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        out.close()
        self._files.delete(self._at(name), False)
        self._files.rename(staged, self._at(name))

    def _get(self, name: str) -> dict | None:
        if not self._files.exists(self._at(name)):
            return None
        file = self._files.open(self._at(name))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()

    @staticmethod
    def entry(name: str, key: Any) -> str:
        """File of a step's entry for what it depends on."""
        return f"done/{name}-{hashlib.sha256(json.dumps(key, sort_keys=True, default=str).encode()).hexdigest()[:16]}"

    def halt(self) -> dict | None:
        """Why nothing may run: step, message and code; None if all may."""
        return self._get("halt")

    def lift(self) -> None:
        """Let steps run again."""
        self._files.delete(self._at("halt"), False)

    def step(self, name: str, key: Any, run: Callable[[], Any]) -> Any:
        """What the step gave for this key: from the journal if it is done, else by running it. The result must be JSON.

        Raises GateError (HALTED) under a halt. A GateError of the step's own leaves a halt and goes on to the caller; any
        other error leaves nothing.
        """
        if (why := self.halt()) is not None:
            raise GateError(f"halted at {why['step']}: {why['message']}", HALTED)
        if (done := self._get(self.entry(name, key))) is not None:
            return done["result"]
        try:
            result = run()
        except GateError as error:
            self._put("halt", {"step": name, "message": str(error), "code": error.code})
            raise
        self._put(self.entry(name, key), {"result": result})
        return result
