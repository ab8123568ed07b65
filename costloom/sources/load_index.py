"""Which days a load touched: a small table kept by the loads themselves.

Every load of a fact writes, before its rows, the pairs of folder day (by which the fact is stored) and usage day that it
brings, with the time of the load. From it follow, without a look at the facts, the usage days that are stale since a
mark and the folders that hold given usage days. A load that is repeated overwrites its own rows; one that stops
before its fact is written leaves days that are recomputed in vain, never days that are missed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .tables import Tables

SCHEMA = "folder_day_dt date, day_dt date, loaded_dt timestamp, load_cd string"


class LoadIndex:
    def __init__(self, tables: Tables, name: str = "_load_index"):
        self.tables, self.name = tables, name

    def _folder(self, fact: str) -> str:
        return f"{self.name}/{fact}"

    def record(self, fact: str, load: str | int, rows: DataFrame, folder_day: Column | str, day: Column | str | None = None) -> None:
        """Note the days of ``rows`` as load ``load`` of ``fact``; ``day`` is the folder day where it is not given.

        Distinct pairs of days only, so the rows are reduced before they are shuffled, and one file holds a load."""
        to = lambda c: (F.col(c) if isinstance(c, str) else c).cast("date")
        pairs = rows.select(to(folder_day).alias("folder_day_dt"), to(folder_day if day is None else day).alias("day_dt")).distinct()
        pairs.withColumn("loaded_dt", F.current_timestamp()).coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{self.tables.folder(self._folder(fact))}/load_cd={load}")

    def known(self, fact: str) -> bool:
        return self.tables.holds(self._folder(fact))

    def read(self, fact: str) -> DataFrame:
        if not self.known(fact):
            return self.tables.spark.createDataFrame([], SCHEMA)
        return self.tables.spark.read.schema(SCHEMA).parquet(self.tables.folder(self._folder(fact)))

    def since(self, fact: str, mark: dt.datetime) -> DataFrame:
        """``day_dt`` of the loads after ``mark``."""
        return self.read(fact).filter(F.col("loaded_dt") > F.lit(mark)).select("day_dt").distinct()

    def folders(self, fact: str, days: Sequence[dt.date]) -> list:
        """Folder days that hold rows of the usage ``days``; a list as long as the table has such folders."""
        return [r[0] for r in self.read(fact).filter(F.col("day_dt").isin(list(days))).select("folder_day_dt").distinct().collect()]

    def reached(self, facts: Sequence[str]) -> dt.datetime | None:
        """The newest load of any of the facts."""
        times = [t for f in facts if self.known(f) and (t := self.read(f).agg(F.max("loaded_dt")).first()[0])]
        return max(times, default=None)
