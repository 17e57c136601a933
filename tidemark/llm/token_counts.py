"""Token counts of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.encoding import WINDOW_BYTES, text_groups, worker_encoder


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row (id, n_bytes, n_tokens, over_limit) for each row of ``docs``, by the tokenizer file.

    Arrow batches are cut into windows of equal bytes, not rows, so one long text costs no more
    memory than many short ones; it is split where the tokenizer splits words anyway. Only lengths
    leave the task. There is no shuffle. Null and empty texts count 0; repeated rows are counted
    each; columns other than the two named are not read; an empty table gives an empty result.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            for row, data, offsets in text_groups(batch.column(1), WINDOW_BYTES):
                tokens = encoder.lengths_of(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(tokens)), pa.array(np.diff(offsets)), pa.array(tokens)],
                    names=["id", "n_bytes", "n_tokens"],
                )

    schema = T.StructType(
        [
            T.StructField("id", picked.schema["id"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    return picked.mapInArrow(count, schema).select(
        F.col("id").alias(id_col),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
