"""Gates over a stream of records: work on a key starts once enough records are there, or is given up at a deadline; each key is decided once.

The state of a key is one value: its first record's time, the ids seen so far (fewer than ``target``, dropped when the key is decided) and the outcome. It is
read and written once a batch, since each access is a message between the worker and the store; a key that opens and is decided in one batch is written once. The deadline
is an event-time timer, so a key without further records is given up too, as soon as the watermark passes it. State and progress lie in the
checkpoint: a query that is started again goes on where it stopped and decides no key again.

Cases: a record that comes twice counts once; records of a decided key are ignored; rows without key, id or time are left out; rows of a batch are taken
in order of their time; a record after the deadline gives the key up, whether or not the timer has run.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: State of this kind needs the store that keeps it on disk.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Gate(StatefulProcessor):
    """outcome (started, given_up), records so far and seconds since the first one, once for each key."""

    def __init__(self, target: int, limit_ms: int):
        self.target, self.limit_ms = target, limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.gate = handle.getValueState("gate", "first long, n long, outcome string, seen array<string>")

    def _decide(self, key: Any, first: int, n: int, outcome: str, at: int) -> pd.DataFrame:
        self.gate.update((first, n, outcome, []))
        return pd.DataFrame({"key": [key[0]], "outcome": [outcome], "records": [n], "waited_s": [(at - first) // 1000]})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first, _, outcome, seen = self.gate.get() or (None, 0, None, ())
        if outcome:
            return
        seen, began = set(seen), first is None
        for ms, rid in sorted(x for some in rows for x in zip(some["ms"].tolist(), some["id"].tolist())):
            first = ms if first is None else first
            if ms > first + self.limit_ms:
                yield self._decide(key, first, len(seen), "given_up", first + self.limit_ms)
                return
            seen.add(rid)
            if len(seen) >= self.target:
                yield self._decide(key, first, len(seen), "started", ms)
                return
        self.gate.update((first, len(seen), "", sorted(seen)))
        if began:
            self.handle.registerTimer(first + self.limit_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        first, n, outcome, _ = self.gate.get()
        if not outcome:
            yield self._decide(key, first, n, "given_up", first + self.limit_ms)

    def close(self) -> None:
        pass


def gated(stream: DataFrame, key: str, record: str, ts: str, target: int, limit: str, late: str = "0 seconds") -> DataFrame:
    """key, outcome, records, waited_s: a row per key when it is decided. limit: longest wait from the key's first record."""
    limit_ms = int(pd.Timedelta(limit).total_seconds() * 1000)
    at = F.col(ts).cast("timestamp")
    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(record).cast("string").alias("id"), at.alias("at"), F.unix_millis(at).alias("ms")).dropna()
    return rows.withWatermark("at", late).groupBy("key").transformWithStateInPandas(Gate(target, limit_ms), "key string, outcome string, records long, waited_s long", "append", "eventTime")


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Processes what has arrived since the checkpoint, appends the outcomes to path, and returns all of them."""
    conf, name = df.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, STORE)
    try:
        df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        conf.set(name, before) if before else conf.unset(name)
    return df.sparkSession.read.schema(df.schema).parquet(path)
