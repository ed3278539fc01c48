"""Structured Streaming jobs over arriving text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewell.functions.text import split_spaces, words


def text_stream(spark: SparkSession, path: str, schema: str = "doc_id long, text string", files_per_batch: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def word_counts(stream: DataFrame, text: str = "text") -> DataFrame:
    """Running counts; use update mode."""
    return stream.select(F.explode(words(F.col(text))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


class _WindowBuffer(StatefulProcessor):
    """Keeps the tokens of one shard that do not fill a window yet."""

    def __init__(self, length: int):
        self.length = length

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("next_window", T.LongType()), T.StructField("rest", T.ArrayType(T.LongType()))])
        self.state = handle.getValueState("buffer", schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        have = self.state.get() if self.state.exists() else (0, [])
        number, rest = have[0], list(have[1])
        for batch in rows:
            # a batch may arrive in any order inside one trigger; rows of a shard go by id
            for ids in batch.sort_values("doc_id")["ids"]:
                rest.extend(int(i) for i in ids)
                done = max((len(rest) - 1) // self.length, 0)
                if done:
                    cuts = [rest[i * self.length : i * self.length + self.length + 1] for i in range(done)]
                    yield pd.DataFrame(
                        {
                            "shard": key[0],
                            "window": range(number, number + done),
                            "inputs": [c[:-1] for c in cuts],
                            "targets": [c[1:] for c in cuts],
                        }
                    )
                    number, rest = number + done, rest[done * self.length :]
        self.state.update((number, rest))

    def close(self) -> None:
        pass


def token_windows(stream: DataFrame, vocab: DataFrame, length: int, shards: int = 64, text: str = "text") -> DataFrame:
    """(shard, window, inputs, targets) of fixed length over the tokens of each shard.

    A document's shard follows from its id, so state is spread over ``shards`` keys
    and no key grows: it holds at most one unfinished window.  Words become ids by
    a map built from the (size-checked) vocabulary table.
    """
    from tidewell.operators.wordpiece import MAX_SENT_TOKENS

    entries = vocab.limit(MAX_SENT_TOKENS + 1).collect()
    if len(entries) > MAX_SENT_TOKENS:
        raise ValueError("vocabulary too large to hold in a streaming task")
    lookup = stream.sparkSession.sparkContext.broadcast({r["token"]: r["id"] for r in entries})

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def to_ids(tokens: pd.Series) -> pd.Series:
        ids = lookup.value
        return tokens.map(lambda ts: [ids.get(t, 1) for t in ts])

    rows = stream.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"), "doc_id", to_ids(split_spaces(F.col(text))).alias("ids")
    )
    return rows.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=_WindowBuffer(length),
        outputStructType="shard long, window long, inputs array<long>, targets array<long>",
        outputMode="Append",
        timeMode="None",
    )


def drain_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop.

    ``append`` writes parquet files.  ``update`` keeps one parquet folder per batch,
    so that readers take the latest value of each key.
    """
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    else:

        def save(batch: DataFrame, epoch: int) -> None:
            # replayed epochs overwrite their own folder
            batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{path}/epoch_folder={epoch}")

        q = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).outputMode(mode)
    q.trigger(availableNow=True).start().awaitTermination()


def latest_counts(spark: SparkSession, path: str, key: str = "token", value: str = "n") -> DataFrame:
    """Latest value per key of an ``update`` folder."""
    return spark.read.parquet(path).groupBy(key).agg(F.max_by(value, "epoch").alias(value))
