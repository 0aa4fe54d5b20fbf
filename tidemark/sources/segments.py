"""Long jobs in segments with a commit log: what a stopped run finished is not done again.

A table written here is a folder of committed segments. A segment's rows are first written to a folder of the attempt's
own, then published by one rename into ``data/``, whose name carries segment and attempt; the log entry that names it is
a small file, itself written aside and renamed. Readers follow the log alone, so they see a segment whole or not at all,
and a run stopped at any point leaves at most folders no entry names, which the next run of the segment removes.

An entry holds segment, status (``completed`` or ``empty``), data folder, row count and a hash of the job's parameters.
A segment is skipped if its last entry has the same parameters; with others it is done anew, and the newer entry wins.
Files are reached through Hadoop's file systems, so the log works wherever Spark writes. The log has one entry per
segment and run, not per row; one run at a time may write a table.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.shaping import params_hash


class Segments:
    """A table at ``path`` that grows by segments."""

    def __init__(self, spark: SparkSession, path: str, schema: str, params: dict | None = None):
        self.spark, self.path, self.schema = spark, path, T.StructType.fromDDL(schema)
        self.params = params_hash(params or {})
        self._fs = self._at("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def log(self) -> dict[str, dict]:
        """The valid entry of each committed segment."""
        if not self._fs.exists(self._at("log")):
            return {}
        text = self.spark.read.text(f"{self.path}/log", wholetext=True, pathGlobFilter="*.json").collect()
        entries = sorted((json.loads(r.value) for r in text), key=lambda e: e["number"])
        return {e["segment"]: e for e in entries}

    def is_completed(self, segment: str) -> bool:
        return self.log().get(segment, {}).get("params") == self.params

    def run(self, segments: Iterable[str], job: Callable[[str], DataFrame]) -> list[str]:
        """Do the segments that are missing, in order, each committed before the next begins; returns those done."""
        log, done = self.log(), []
        number = 1 + max((e["number"] for e in log.values()), default=0)
        for segment in segments:
            if log.get(segment, {}).get("params") == self.params:
                continue
            self._commit(segment, job(segment), number)
            number += 1
            done.append(segment)
        return done

    def _commit(self, segment: str, rows: DataFrame, number: int) -> None:
        name = f"{re.sub('[^A-Za-z0-9_.-]', '_', segment)}-{params_hash({'segment': segment})[:12]}"
        self._drop_unnamed(name)
        attempt = f"{name}-{uuid.uuid4().hex}"
        aside, place = f"aside/{attempt}", f"data/{attempt}"
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).write.parquet(f"{self.path}/{aside}")
        n = self.spark.read.schema(self.schema).parquet(f"{self.path}/{aside}").count()
        self._rename(aside, place)
        entry = {"segment": segment, "status": "completed" if n else "empty", "place": place, "rows": n, "params": self.params, "number": number}
        out = self._fs.create(self._at(f"aside/{attempt}.json"), True)
        out.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
        out.close()
        self._rename(f"aside/{attempt}.json", f"log/{attempt}.json")

    def _rename(self, a: str, b: str) -> None:
        self._fs.mkdirs(self._at(b).getParent())
        if not self._fs.rename(self._at(a), self._at(b)):
            raise OSError(f"could not publish {b}")

    def _drop_unnamed(self, name: str) -> None:
        """Folders of earlier attempts at a segment that no entry names."""
        named = {e["place"].rsplit("/", 1)[1] for e in self.log().values()}
        for folder in ("aside", "data"):
            for status in self._fs.globStatus(self._at(f"{folder}/{name}-*")) or []:
                if status.getPath().getName() not in named:
                    self._fs.delete(status.getPath(), True)

    def read(self, segments: Iterable[str] | None = None) -> DataFrame:
        """Rows of the committed segments (all, or those named)."""
        log = self.log()
        wanted = log if segments is None else {s: log[s] for s in segments if s in log}
        places = [f"{self.path}/{e['place']}" for e in wanted.values() if e["status"] == "completed"]
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*places)
