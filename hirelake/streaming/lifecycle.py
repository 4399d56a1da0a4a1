"""Postings in a stream: first seen, expired after days of silence, seen again; a state row for each posting.

The state answers "known already?" without looking at bronze, and event time, not the clock, expires a posting:
when the watermark has passed its last sighting by more than ``days``, as `state.expire_stale` does in a batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hirelake import schemas as S
from hirelake.operators.staging import top_per_key

FIRST, AGAIN = "first seen", "seen again"
KEY = ["source", "job_id"]
EVENTS = T.StructType(
    [
        *[f for f in S.RAW.fields if f.name != "crawl_timestamp"],
        T.StructField("event", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)
_DATA = [f.name for f in S.RAW.fields if f.name not in (*KEY, "crawl_timestamp")]
_STATE = T.StructType([T.StructField("last", T.TimestampType()), T.StructField("gone", T.BooleanType())])


def lifecycle(observations: DataFrame, order: list[str], days: int = 3, delay: str = "1 day") -> DataFrame:
    """Events of a stream of bronze rows: (bronze columns, event, at).

    'first seen' carries the key's first row of its micro-batch in ``order``; 'Expired' and 'seen again' carry
    the key only. Observations later than ``delay`` behind the newest are not looked at. One small state row a
    posting; a replayed micro-batch gives the same events.
    """
    span = dt.timedelta(days=days)

    def step(key: tuple, batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        def event(name: str, at: dt.datetime, row: dict | None = None) -> pd.DataFrame:
            values = {**dict.fromkeys(_DATA), **(row or {}), "source": key[0], "job_id": key[1], "event": name, "at": at}
            return pd.DataFrame([[values[c] for c in EVENTS.names]], columns=EVENTS.names)

        if kept.hasTimedOut:
            last, _ = kept.get
            kept.update((last, True))
            yield event(S.EXPIRED, pd.Timestamp(last) + span)
            return
        rows = pd.concat(list(batches))
        newest = rows["at"].max()
        if not kept.exists:
            first = rows.sort_values(order, kind="stable", na_position="last").iloc[0]
            yield event(FIRST, rows["at"].min(), {c: first[c] if pd.notna(first[c]) else None for c in _DATA})
            last = newest
        else:
            last, gone = kept.get
            last = max(pd.Timestamp(last), newest)
            if gone and last == newest:
                yield event(AGAIN, newest)
        gone = (last + span).timestamp() * 1000 < kept.getCurrentWatermarkMs()
        kept.update((last.to_pydatetime(), gone))
        if gone:
            yield event(S.EXPIRED, last + span)
        else:
            kept.setTimeoutTimestamp(int((last + span).timestamp() * 1000))

    timed = observations.withColumn("at", F.col("crawl_timestamp").cast("timestamp")).drop("crawl_timestamp")
    timed = timed.where(F.col("at").isNotNull()).withWatermark("at", delay)
    return timed.groupBy(*KEY).applyInPandasWithState(step, EVENTS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def follow(
    spark: SparkSession, folder: str, schema: T.StructType, root: str, order: list[str], days: int = 3, delay: str = "1 day"
) -> StreamingQuery:
    """Every new Parquet file of ``folder`` to events below ``<root>/events``; ends when caught up."""
    found = lifecycle(spark.readStream.schema(schema).parquet(folder), order, days, delay)
    return (
        found.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{root}/events")
        .option("checkpointLocation", f"{root}/_checkpoints/events")
        .trigger(availableNow=True)
        .start()
    )


def first_rows(events: DataFrame) -> DataFrame:
    """What insert-if-absent has kept: the first row of each posting, with the time it was seen."""
    rows = events.where(F.col("event") == FIRST).withColumn("crawl_timestamp", F.col("at").cast("timestamp_ntz"))
    return rows.select(S.RAW.names)


def statuses(events: DataFrame) -> DataFrame:
    """(source, job_id, status) by the newest event of each posting."""
    newest = top_per_key(events, KEY, [F.desc("at"), F.desc(F.col("event") == S.EXPIRED)], 1)
    return newest.select(*KEY, F.when(F.col("event") == S.EXPIRED, S.EXPIRED).otherwise(S.ACTIVE).alias("status"))
