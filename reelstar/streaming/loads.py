"""Incremental loads as file streams: each run takes the files that are new since the last.

All streams here run with an ``availableNow`` trigger, the streaming form of a daily job: they
take what has landed, record it in the checkpoint and stop.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelstar.operators import quality, star
from reelstar.operators.latest import latest_by
from reelstar.schemas import (
    BATCHES,
    BROKEN,
    FAILED_CAST_PCT,
    FAILED_CAST_PCT_OF,
    RAW,
    columns,
)
from reelstar.session import stored
from reelstar.sources import bronze
from reelstar.sources.warehouse import Derived, Load, Warehouse


def bronze_stream(
    spark: SparkSession,
    root: str,
    endpoint: str,
    lines: bool = False,
    max_files: int | None = None,
    keep_broken: bool = False,
) -> DataFrame:
    """New bronze documents of an endpoint; ``lines`` for the files ``write_bronze`` stores.

    With ``keep_broken`` the text of a document that is no JSON is in a column ``_broken``.
    """
    schema = bronze.with_broken(RAW[endpoint]) if keep_broken else RAW[endpoint]
    reader = (
        spark.readStream.schema(schema)
        .option("columnNameOfCorruptRecord", BROKEN)
        .option("recursiveFileLookup", True)
        .option("multiLine", not lines)
        .option("pathGlobFilter", "*.txt.gz" if lines else "*.json")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(f"{root.rstrip('/')}/{endpoint}")


def parquet_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _run(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], mode: str):
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(step)
        .start()
    )
    query.awaitTermination()


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint, so it is the same after a restart."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def upsert_stream(
    stream: DataFrame,
    warehouse: Warehouse,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    partition_by: str | None = None,
    sort_by: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    derived: dict[str, Derived] | None = None,
) -> None:
    """Keep the newest row per key in a published table, batch by batch.

    A batch is reduced to its newest row per key, rows older than the published one are left
    out, and the rest is upserted. A deduplicating stream operator would keep the first
    delivery instead of the newest, so the state is the table itself, and no row is too late.
    The stream's id and the batch number go into the commit: a batch that is run again after a
    failure is not applied twice, and batches of other streams are not taken for it.
    """

    def step(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        newest = stored(warehouse.spark, latest_by(rows, keys, order), f"{table}-batch")
        load = Load(newest, keys, partition_by, sort_by, newest_by=order)
        stream_id = _query_id(warehouse.spark, checkpoint)
        warehouse.publish({table: load}, note=f"{table}@{stream_id}#{number}", derived=derived)

    _run(stream, checkpoint, step, "append")


BATCHES_TABLE = "stream_batches"


def gated_upsert_stream(
    stream: DataFrame,
    warehouse: Warehouse,
    resource: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    quarantine: str,
    prepare: Callable[[DataFrame], DataFrame],
    partition_by: str | None = None,
    sort_by: Sequence[str] = (),
    known_media: DataFrame | None = None,
    failed_cast_pct: float = FAILED_CAST_PCT,
    max_broken_pct: float = 100.0,
) -> None:
    """As ``upsert_stream``, into the resource's own table, with a quality gate before every commit.

    ``stream`` keeps broken documents. Those of a batch go to ``broken_<resource>`` in quarantine
    and are counted; beyond ``max_broken_pct`` per cent of the batch they fail it. The rest passes
    the checks of the daily run: null percentages, lengths, unique keys, failed casts and, with
    ``known_media``, orphans. A batch that fails publishes nothing: its documents go to
    ``failed_<resource>``, and the stream stops with the report. Started anew, it takes the same
    files again, so once they are mended, or a limit is raised, it goes on from there. A document
    that was broken in a published batch is to land again under another name, as a stream
    takes a path once.

    The counts of a batch are published with its rows, in ``stream_batches``. Quarantine folders
    bear the stream's id and the batch's number, so a batch that is run again writes them anew.
    """
    spark, table = warehouse.spark, star.ROW_KEYS[resource][0]

    def step(batch: DataFrame, number: int) -> None:
        stream_id = _query_id(spark, checkpoint)

        def aside(rows: DataFrame, kind: str) -> None:
            path = f"{quarantine.rstrip('/')}/{kind}_{resource}/stream={stream_id}/batch={number}"
            rows.write.mode("overwrite").parquet(path)

        seen = Observation()
        counters = [*star.cast_counters(resource).values(), *star.row_counters(batch, resource)]
        raw = stored(spark, batch.observe(seen, *counters), f"{resource}-batch")
        counts = dict(seen.get)
        rows, no_key, broken = (counts.pop(c) for c in ("_rows", "_no_key", "_broken"))
        if broken:
            aside(raw.filter(F.col(BROKEN).isNotNull()).select(BROKEN), "broken")
        intact = raw.filter(F.col(BROKEN).isNull()).drop(BROKEN)
        newest = stored(spark, latest_by(prepare(intact), keys, order), f"{table}-batch")
        share = 100 * broken / max(1, rows + broken)
        lines = [quality.build_line(resource, "broken_documents", None, broken, max_broken_pct, share)]
        for column, n in counts.items():
            limit = FAILED_CAST_PCT_OF.get((resource, column), failed_cast_pct)
            failed = 100 * n / max(1, rows)
            lines.append(quality.build_line(resource, "failed_casts", column, n, limit, failed))
        report = None
        if rows:  # a batch of broken documents only has no rows to check
            report = quality.quality_report({table: newest}, known_media, {table: no_key})
        try:
            quality.gate(report, lines)
        except quality.QualityGateError:
            aside(intact, "failed")
            raise
        log = spark.createDataFrame([(stream_id, number, rows, no_key, broken)], BATCHES)
        loads = {BATCHES_TABLE: Load(log, ["stream", "batch"], buckets=1)}
        if rows:
            loads[table] = Load(newest, keys, partition_by, sort_by, newest_by=order)
        warehouse.publish(loads, note=f"{table}@{stream_id}#{number}")

    _run(stream, checkpoint, step, "append")


TREND = columns("event_date date, media_id string, events long")


def daily_trend_stream(
    events: DataFrame,
    warehouse: Warehouse,
    fact: str,
    trend: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Keep the fact and the events per day and video that it holds.

    The days a batch touches are counted anew from the fact, in the commit that changes it, so
    replays count once and late events count whenever they come.
    """
    recount = Derived(
        fact,
        lambda rows: rows.groupBy("event_date", "media_id").agg(
            F.count(F.lit(1)).alias("events")
        ),
    )
    upsert_stream(
        events, warehouse, fact, ["event_key"], ["received_at"], checkpoint,
        partition_by="event_date", sort_by=("media_id",), prepare=prepare,
        derived={trend: recount},
    )


def read_daily_trend(warehouse: Warehouse, trend: str, dim_media: DataFrame) -> DataFrame:
    per_media = warehouse.read(trend, TREND, "event_date")
    return (
        per_media.join(dim_media.select("media_id", "channel"), "media_id")
        .groupBy("event_date", "channel")
        .agg(F.sum("events").alias("events"))
    )
