"""Token counts: Arrow functions that encode in batches and return lengths only.

A task receives Arrow batches, cuts texts at boundaries that cannot change the ids
(:mod:`tillmark.llm.pieces`), encodes new pieces in calls of about equal bytes, and
returns one number per text. No text or id leaves the task, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.pieces import encoder

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The UTF-8 bytes and tokens of every whole text.

    ``path`` names the JSON file of a byte-level BPE, which every executor must have. No
    begin, end or added special token is counted; the string of a special token inside a
    text counts as the library's default does. A null text counts as empty: 0 and 0. Ids
    may be null or repeat, one row comes out per row. Other columns of ``docs`` are not
    read, whatever their names. Texts may be of any length: a long one is cut into pieces
    at white space, and only a single run without white space is encoded as it is.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            sizes = [np.diff(bounds) // 4 for _, bounds in coder.encode(batch.column(1))]
            n_tokens = np.concatenate(sizes) if sizes else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("text"),
        F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)
