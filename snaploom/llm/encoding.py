"""Encoding of the whole corpus with a public tokenizer.

Defined results: empty and null texts have no ids, an empty list; strings that
look like special tokens are ordinary text; a null doc_id is kept; repeated
rows are encoded each; an empty table gives an empty result. Texts may be of
any length: they are never cut or sampled.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaploom.llm import bpe

#: Where the vocabulary files are. A file of the same name in another folder will do if its words are cut alike, which is checked.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.json"


def shared_vocabulary(spark: SparkSession, tokenizers: str = TOKENIZERS, name: str = VOCABULARY) -> Broadcast:
    """The vocabulary file, broadcast; its size doesn't depend on the corpus (1.6 MB), and is checked."""
    data = Path(tokenizers, name).read_bytes()
    if len(data) > 64 << 20:
        raise ValueError(f"{name} has {len(data)} bytes; vocabularies of over 64 MB aren't broadcast")
    return spark.sparkContext.broadcast(data)


def token_ids(documents: DataFrame, key: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, ids) of every document."""
    vocabulary = shared_vocabulary(documents.sparkSession, tokenizers)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder_of(vocabulary.value)
        for batch in batches:
            for part in bpe.slices(batch, "text"):
                ids, at = encoder.words(part.column("text")).ids()
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("key"), lists], ["key", "ids"])

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(encode, schema).withColumnRenamed("key", key)


def token_counts(documents: DataFrame, columns: list[str], text: str = "text", tokenizers: str = TOKENIZERS) -> DataFrame:
    """The given columns of every document with its number of tokens as ``n_tokens``."""
    vocabulary = shared_vocabulary(documents.sparkSession, tokenizers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder_of(vocabulary.value)
        for batch in batches:
            for part in bpe.slices(batch, "text"):
                totals = pa.array(encoder.words(part.column("text")).totals(), pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(f"c{i}") for i in range(len(columns))), totals], [*(f"c{i}" for i in range(len(columns))), "n_tokens"])

    rows = documents.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(text).alias("text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(count, schema).toDF(*columns, "n_tokens")


def texts_of(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, bytes): what the ids of each document stand for, the bytes of its text."""
    vocabulary = shared_vocabulary(encoded.sparkSession, tokenizers)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = bpe.token_bytes(vocabulary.value)
        for batch in batches:
            texts = [b"".join([spelled[i] for i in row]) if row is not None else None for row in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.binary())], ["key", "bytes"])

    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("bytes", T.BinaryType())])
    return rows.mapInArrow(decode, schema).withColumnRenamed("key", key)
