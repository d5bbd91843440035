"""Documents written while pages still arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from korpusmill.functions.url import canonical_url
from korpusmill.operators.webdocs import page_records, web_documents
from korpusmill.profiles import SiteProfile
from korpusmill.session import shared_folder

PAGES = "page_id bigint, url string, html string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_pages(spark: SparkSession, path: str, schema: str = PAGES) -> DataFrame:
    """A stream of fetched pages from parquet files as they appear."""
    return spark.readStream.schema(schema).parquet(path)


def stream_documents(
    pages: DataFrame, root_url: Column, category: Column, lang: Column, profile: SiteProfile,
    seen_at: str | None = None, horizon: str = "30 days",
) -> DataFrame:
    """Web documents of a page stream; the first page to arrive for a URL is kept.

    Only the URL is kept as state, in partitions by URL; copies of one page,
    however many, never leave more than that behind, and are dropped before
    their texts are read. With ``seen_at``, a timestamp column, a URL is
    forgotten when it is older than ``horizon``; without it, never. Which of
    several pages of one batch is first is open: ``first_by_ordinal`` goes by
    ordinal, whatever the order of arrival.
    """
    base = F.coalesce(F.col("final_url"), F.col("url")) if "final_url" in pages.columns else F.col("url")
    keyed = pages.where(F.col("html").isNotNull()).withColumn("_key", canonical_url(base, profile.strip_default_ports))
    if seen_at:
        unique = keyed.withWatermark(seen_at, horizon).dropDuplicatesWithinWatermark(["_key"])
    else:
        unique = keyed.dropDuplicates(["_key"])
    return web_documents(page_records(unique.drop("_key"), profile), root_url, category, lang, profile).drop("ordinal")


def save_stream(docs: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Write JSON lines for all pages there are, then stop.

    A later start with the same ``checkpoint`` goes on from there; without one
    it begins anew. State is kept on disk, not in the executors' memory.
    """
    place = checkpoint or shared_folder(docs.sparkSession, "stream")
    docs.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return (
        docs.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", place)
        .option("ignoreNullFields", "false")
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )


def _improve(horizon_ms: int | None):
    """Rows that come before all of their key so far, one a batch at most; the state is the smallest ordinal."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        least, best = state.getOption[0] if state.exists else None, None
        latest = None
        for part in parts:
            row = part.iloc[[part["_place"].argmin()]]
            place = int(row["_place"].iloc[0])
            if least is None or place < least:
                least, best = place, row
            if horizon_ms is not None:
                latest = max(filter(None, (latest, int(part["_seen_ms"].max()))))
        state.update((least,))
        if horizon_ms is not None:
            state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + horizon_ms)
        if best is not None:
            yield best

    return run


def first_by_ordinal(
    records: DataFrame, key: str = "url", ordinal: str = "ordinal", seen_at: str | None = None, horizon: str = "30 days", salts: int = 8,
) -> DataFrame:
    """Of a stream, each row that comes before all rows of its key seen so far, by ordinal and not by arrival.

    A smaller ordinal that arrives later is given out, too, as a correction;
    ``read_saved`` keeps the smallest, so what is read in the end does not hang
    on how rows were dealt to batches. The state is one number a key. With
    ``seen_at``, a timestamp without nulls, a timer forgets keys not seen while
    the watermark moved on by ``horizon``; a key that comes back is given out anew. Rows of a key
    are dealt to ``salts`` states, so a hot key is not one task; each may give
    out a row. A null key is a key, a null ordinal comes last.
    """
    place = F.coalesce(F.col(ordinal).cast("bigint"), F.lit(2**63 - 1))
    fields = [*records.schema.fields, StructField("_place", LongType())]
    rows = records.withColumn("_place", place)
    horizon_ms = None
    if seen_at:
        rows = rows.withWatermark(seen_at, horizon).withColumn("_seen_ms", F.unix_millis(F.col(seen_at)))
        fields.append(StructField("_seen_ms", LongType()))
        horizon_ms = int(pd.Timedelta(horizon).total_seconds() * 1000)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_place"), F.lit(salts)))
    fields.append(StructField("_salt", LongType()))
    timer = GroupStateTimeout.EventTimeTimeout if seen_at else GroupStateTimeout.NoTimeout
    first = salted.groupBy(key, "_salt").applyInPandasWithState(_improve(horizon_ms), StructType(fields), "least bigint", "update", timer)
    # Whole numbers with nulls pass through pandas as floats; the place does not.
    exact = F.nullif(F.col("_place"), F.lit(2**63 - 1)).cast(records.schema[ordinal].dataType)
    return first.withColumn(ordinal, exact).select(*records.columns)


def save_batches(rows: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Write each batch to a folder of its number, for all rows there are, then stop.

    A batch that is run again after a failure replaces its folder, so no row is
    doubled. A later start with the same ``checkpoint`` goes on from there.
    """
    spark = rows.sparkSession
    place = checkpoint or shared_folder(spark, "stream")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{path}/batch=-1")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = rows.writeStream.foreachBatch(save).option("checkpointLocation", place)
    return writer.outputMode("update").trigger(availableNow=True).start()


def read_saved(spark: SparkSession, path: str, schema: StructType, keys: tuple[str, ...] = ("url",)) -> DataFrame:
    """The rows of all saved batches, of each key the one with the smallest ordinal; null comes last."""
    wanted = [f.name for f in schema.fields]
    value, place = F.struct(*[n for n in wanted if n not in keys]), F.struct(F.col("ordinal").isNull(), F.col("ordinal"))
    saved = spark.read.schema(schema).parquet(path).groupBy(*keys).agg(F.min_by(value, place).alias("_value"))
    return saved.select(*keys, "_value.*").select(*wanted)
