"""The fields that each landed feed is known to have, kept from run to run.

A feed starts with its declared fields. Before a run reads it, the footers of the files that arrived since the last look are
merged by a Spark job, and fields that are new, also inside structs, are added to what is stored. Fields are never taken
away or given another type, so streams, facts and old files go on; files without a field read it as NULL.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession, functions as F, types as T

from ..operators.merge import union_type
from .tables import Tables

#: Files may be stamped by another clock than the driver's: the footers of the last hours are looked at again.
MARGIN = dt.timedelta(hours=2)


class SeenSchemas:
    def __init__(self, tables: Tables, name: str = "_schemas"):
        self.tables, self.name = tables, name

    def _stored(self) -> dict[str, tuple[T.StructType, dt.datetime]]:
        """Schema of each feed, and the time of the last look, as the session's clock shows it."""
        known = self.tables.read(self.name)
        rows = known.collect() if known is not None else []  # one for each feed
        return {r.feed_lb: (T.StructType.fromJson(json.loads(r.schema_lb)), dt.datetime.fromisoformat(r.seen_lb)) for r in rows}

    def declared(self, ddl: str) -> T.StructType:
        return T.StructType.fromDDL(ddl)

    def schema(self, feed: str, ddl: str) -> T.StructType:
        stored = self._stored().get(feed)
        return stored[0] if stored else self.declared(ddl)

    def extra(self, feed: str, ddl: str) -> list[str]:
        """Fields that were seen and not declared, in the order in which they came."""
        names = {f.name.lower() for f in self.declared(ddl)}
        return [f.name for f in self.schema(feed, ddl) if f.name.lower() not in names]

    def look(self, feeds: dict[str, tuple[str, str]]) -> dict[str, T.StructType]:
        """Widen the schemas of ``feeds`` (name to folder and declared fields) by the new files' fields.

        Nothing is written while no field is new and the last look is recent. Returns the feeds that have new fields."""
        spark: SparkSession = self.tables.spark
        before = self._stored()
        after, widened = dict(before), {}
        clock = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
        now = dt.datetime.fromisoformat(spark.range(1).select(clock).first()[0])
        for feed, (folder, ddl) in feeds.items():
            known, seen = before.get(feed, (self.declared(ddl), None))
            found = self._found(folder, seen - MARGIN if seen else None)
            if found is None:
                continue
            wide = T.StructType([T.StructField(f.name, f.dataType, True) for f in union_type(known, found)])
            after[feed] = (wide, now)
            if wide != known:
                widened[feed] = wide
        if any(f not in before or s != before[f][0] or t - before[f][1] > MARGIN for f, (s, t) in after.items()):
            rows = [(f, json.dumps(s.jsonValue()), t.isoformat()) for f, (s, t) in sorted(after.items())]
            self.tables.replace(self.name, spark.createDataFrame(rows, "feed_lb string, schema_lb string, seen_lb string").coalesce(1))
        return widened

    def _found(self, folder: str, since: dt.datetime | None) -> T.StructType | None:
        reader = self.tables.spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
        if since is not None:
            reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
        try:
            return reader.parquet(folder).schema
        except AnalysisException as error:  # no folder yet, or no file since
            if error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                return None
            raise
