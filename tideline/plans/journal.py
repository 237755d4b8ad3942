"""The finished steps of a run, so that another driver can go on after the last one."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession

from tideline.sources.sinks import create_file, files_in, read_file


class Journal:
    """A folder of small files, one per finished step, with what the next steps need of it.

    Steps must be safe to repeat: one that ended just before its file was written runs
    again. A step's file is written once, as a whole, and never changed. Without a folder
    nothing is remembered.
    """

    def __init__(self, spark: SparkSession, folder: str | None) -> None:
        self.spark, self.folder = spark, folder
        self._done: dict[str, dict] = {}
        for name in files_in(spark, folder, ".json") if folder else []:
            self._done[name.removesuffix(".json")] = json.loads(read_file(spark, f"{folder}/{name}"))

    @classmethod
    def of_run(cls, spark: SparkSession, root: str, run_id: str) -> Journal:
        if not re.fullmatch(r"[\w.=-]+", run_id) or run_id.startswith("."):
            raise ValueError(f"A run is named by letters, digits, '_', '.', '=' and '-': {run_id!r}")
        return cls(spark, f"{root.rstrip('/')}/{run_id}")

    @property
    def resumed(self) -> bool:
        """Whether an earlier attempt has finished steps."""
        return bool(self._done)

    def get(self, name: str) -> dict | None:
        return self._done.get(name)

    def record(self, name: str, state: Mapping) -> dict:
        state = dict(state)
        if self.folder and not create_file(
            self.spark, f"{self.folder}/{name}.json", json.dumps(state, default=str)
        ):
            raise RuntimeError(f"Another run with this name has finished step {name}")
        self._done[name] = state
        return state

    def once(self, name: str, work: Callable[[], Mapping | None]) -> dict:
        """The state that the step left, now or in an earlier attempt."""
        found = self.get(name)
        return found if found is not None else self.record(name, work() or {})
