"""Stages of a job that can be taken up again: what a stage made is a table under its settings."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dielens.plans.hold import exists, hold, remove


class Stages:
    """Tables of one job in a shared folder, or held for the session where none is given.

    The job's name and a hash of its settings name the place, so a job that runs again with
    the same settings reads the stages that were written to their end and computes the rest;
    other settings have tables of their own. The input belongs to the name: a job over other
    rows is another job.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, job: str = "job", settings: object = None):
        self.spark, self.computed, self.reread = spark, [], []
        mark = hashlib.sha256(repr(settings).encode()).hexdigest()[:16]
        self.place = f"{folder.rstrip('/')}/{job}-{mark}" if folder else None

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if self.place is None:
            self.computed.append(name)
            return hold(make())
        path = f"{self.place}/{name}"
        if exists(self.spark, path):
            self.reread.append(name)
        else:
            self.computed.append(name)
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def value(self, name: str, make: Callable[[], object]) -> object:
        """A small decision, kept as JSON."""
        if self.place is None:
            self.computed.append(name)
            return make()
        rows = self.table(name, lambda: self.spark.createDataFrame([(json.dumps(make()),)], "value string"))
        return json.loads(rows.first()["value"])

    def release(self) -> None:
        """Removes the tables of all stages."""
        if self.place is not None:
            remove(self.spark, self.place)
