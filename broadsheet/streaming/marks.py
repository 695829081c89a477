"""Batches and steps of run logs, paired as their lines come.

State is kept per file, batch and step: the first node, the latest start and the latest end. It doesn't depend on how lines
are dealt into triggers, nor on their order, as far as none comes later than the watermark allows; so the last row of a key equals that of the batch job. A timer
tells of what was begun and hasn't ended within its time, by the clock of the logs; if an end comes later, it counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..plans import logs

#: The state store that states with timers need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SPAN = "file string, batch int, step string, node string, started timestamp, ended timestamp, status string"
_STATE = "first long, node string, started long, ended long, due long"


def marks(events: DataFrame) -> DataFrame:
    """logs.parsed -> file, batch, step ("" for a batch's own marks), node, mark (START or END), ts."""
    m = F.col("message")
    of = lambda pattern, mark, batch, node, step: F.when(m.rlike(pattern), F.struct(F.regexp_extract(m, pattern, mark).alias("mark"), F.regexp_extract(m, pattern, batch).cast("int").alias("batch"), F.regexp_extract(m, pattern, node).alias("node"), step.alias("step")))
    found = F.coalesce(of(logs.STEP, 1, 4, 5, F.regexp_extract(m, logs.STEP, 2)), of(logs.BATCH, 1, 3, 4, F.lit("")))
    return events.withColumn("x", found).filter("x is not null").select("file", "x.batch", "x.step", "x.node", "x.mark", "ts")


class _Pairing(StatefulProcessor):
    def __init__(self, seconds: float):
        self.wait = int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("span", _STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, node, started, ended, due = self.state.get() if self.state.exists() else (None, None, None, None, None)
        for frame in rows:
            for name, mark, ts in zip(frame["node"], frame["mark"], frame["ts"].astype("datetime64[us]").astype("int64").tolist(), strict=True):
                if first is None or (ts, name) < (first, node):
                    first, node = ts, name
                if mark == "START":
                    started = ts if started is None else max(started, ts)
                else:
                    ended = ts if ended is None else max(ended, ts)
        wanted = started // 1000 + self.wait if started is not None and ended is None else None
        if wanted != due:
            if due is not None:
                self.handle.deleteTimer(due)
            if wanted is not None and wanted > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(wanted)
            due = wanted
        self.state.update((first, node, started, ended, due))
        yield self._row(key, node, started, ended, due is not None and due <= timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            _, node, started, ended, _ = self.state.get()
            yield self._row(key, node, started, ended, True)

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key: tuple, node: str, started: int | None, ended: int | None, late: bool) -> pd.DataFrame:
        status = "completed" if ended is not None else "timed out" if late else "running"
        at = lambda us: pd.to_datetime([us], unit="us")
        return pd.DataFrame({"file": [key[0]], "batch": pd.array([key[1]], "Int32"), "step": [key[2]], "node": [node], "started": at(started), "ended": at(ended), "status": [status]})


def spans(events: DataFrame, seconds: float = 3600.0, late: str = "10 minutes") -> DataFrame:
    """A stream of logs.parsed -> rows of spans (file, batch, step, node, started, ended, status), one each time a span changes or times out.

    `late` is how far a line may be behind the latest one; later ones are dropped. The time of a span is up when lines that much
    later have come. The session uses STORE.
    """
    keyed = marks(events).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy("file", "batch", "step")
    return keyed.transformWithStateInPandas(statefulProcessor=_Pairing(seconds), outputStructType=SPAN, outputMode="Update", timeMode="EventTime")


def use_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
