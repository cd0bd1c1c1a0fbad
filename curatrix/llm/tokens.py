"""Token counts of whole texts by a public tokenizer, in Arrow batches."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, SparkSession
from pyspark.sql.functions import pandas_udf

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern of the 50k byte-level vocabulary.
SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(path: str):
    import tiktoken

    # Where a machine lacks the file, the copy that the driver sent along serves.
    with open(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = DEFAULT_VOCABULARY) -> Column:
    """Tokens of a whole text as a long; null for a null text, 0 for an empty one."""

    spark = SparkSession.getActiveSession()
    if spark is not None and os.path.exists(path):
        spark.sparkContext.addFile(path)

    def run(texts: pd.Series) -> pd.Series:
        enc = encoder(path)
        return pd.Series([None if t is None else len(enc.encode_ordinary(t)) for t in texts], dtype="Int64")

    # Marked so that a filter on the count is not pushed below it, which would encode every text twice.
    return pandas_udf(run, "long").asNondeterministic()(text)
