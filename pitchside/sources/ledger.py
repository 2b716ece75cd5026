"""Stage ledger of a batch job: what a finished stage left, keyed by a fingerprint of its inputs.

A stage's record is written when all its outputs are whole. A driver that starts again with the
same input files and parameters skips the stages that have one; other inputs, or outputs that
are gone, run again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from pitchside.sources import hadoop


def fingerprint(spark: SparkSession, folder: str, *parameters) -> str:
    """Digest of the names, sizes and times of all files under ``folder`` and of the parameters."""
    text = json.dumps([hadoop.files(spark, folder), [repr(p) for p in parameters]])
    return hashlib.sha256(text.encode()).hexdigest()[:32]


class Ledger:
    def __init__(self, spark: SparkSession, folder: str, key: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/{key}"

    def record(self, stage: str) -> dict | None:
        path = f"{self.folder}/{stage}.json"
        return json.loads(hadoop.read_text(self.spark, path)) if hadoop.exists(self.spark, path) else None

    def forget(self, *stages: str) -> None:
        for stage in stages:
            hadoop.delete(self.spark, f"{self.folder}/{stage}.json")

    def run(self, stage: str, work: Callable[[], dict], outputs: Callable[[dict], list[str]] = lambda r: []) -> tuple[dict, bool]:
        """(the stage's record, whether it was run now). ``outputs``: paths of a record that must
        still be there for the stage to be skipped."""
        done = self.record(stage)
        if done is not None and all(hadoop.exists(self.spark, p) for p in outputs(done)):
            return done, False
        self.forget(stage)
        made = work()
        if not hadoop.create_if_absent(self.spark, f"{self.folder}/{stage}.json", json.dumps(made)):
            raise RuntimeError(f"stage {stage} was finished by another driver meanwhile")
        return made, True
