"""Token records for training: completion-only labels and padded batches. The tokenizer is injected."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routelore.functions.codec import CALL

IGNORED = -100


class PrefixError(ValueError):
    """A compiled text whose prompt is no token prefix of it, or that is too long."""


def completion_only(ids: list[int], prefix: list[int], max_length: int) -> tuple[list[int], list[int]]:
    if not prefix or ids[: len(prefix)] != prefix or len(prefix) >= len(ids):
        raise PrefixError("the prompt's tokens are no true prefix")
    if len(ids) > max_length:
        raise PrefixError(f"more than {max_length} tokens")
    return ids, [IGNORED] * len(prefix) + ids[len(prefix) :]


def token_records(rows: DataFrame, make_tokenizer: Callable[[], Callable[[str], list[int]]], max_length: int, compiled: str = "compiled") -> DataFrame:
    """``rows`` with input_ids, labels and error; each compiled text has exactly one call marker."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make_tokenizer()
        for frame in frames:
            out = []
            for text in frame[compiled]:
                try:
                    if text.count(CALL) != 1:
                        raise PrefixError("not exactly one call")
                    out.append((*completion_only(encode(text), encode(text[: text.index(CALL)]), max_length), None))
                except PrefixError as e:
                    out.append((None, None, str(e)))
            yield pd.concat([frame.reset_index(drop=True), pd.DataFrame(out, columns=["input_ids", "labels", "error"])], axis=1)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "input_ids array<int>, labels array<int>, error string"])
    return rows.mapInPandas(run, schema)


def _padded(values: Column, width: Column, filler: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(filler), (width - F.size(values)).cast("int")))


def collate(records: DataFrame, order: str, batch_size: int, pad_id: int) -> DataFrame:
    """Right-padded batches: ids to pad_id, labels to the ignored value, and a mask. ``order`` numbers records from 0."""
    rows = records.withColumn("batch", F.floor(F.col(order) / batch_size))
    widths = rows.groupBy("batch").agg(F.max(F.size("input_ids")).alias("width"))
    rows = rows.join(widths, "batch")
    mask = F.transform("input_ids", lambda _: F.lit(1))
    width = F.col("width")
    return rows.select("batch", order, _padded(F.col("input_ids"), width, pad_id).alias("input_ids"), _padded(F.col("labels"), width, IGNORED).alias("labels"), _padded(mask, width, 0).alias("attention_mask"))
