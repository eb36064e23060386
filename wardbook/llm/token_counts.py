"""Token counts by merging pairs from a heap over a linked list, without making tokens."""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm import spans as S
from wardbook.llm.byte_bpe import Memory, Vocabulary, count_merged, values_of


@lru_cache(2)
def _counter(path: str) -> tuple[Vocabulary, Memory]:
    """A worker's vocabulary and its memory of counts."""
    vocabulary = Vocabulary(path)
    return vocabulary, Memory(lambda raw: [count_merged(raw, vocabulary)])


def counts(t: S.Texts, path: str) -> np.ndarray:
    vocabulary, memory = _counter(path)
    at, _, first = values_of(t, vocabulary, memory, lambda _: 1)
    return S.segment_sums(memory.values[at], first)


def counted(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Per row of ``docs`` (``doc_id`` and ``text`` are used): ``doc_id``, ``n_bytes`` of UTF-8, ``n_tokens``
    under the vocabulary file ``path`` (which every worker must have) and ``over_limit``.

    A special token's string in a text counts as that token, as the library has it by default; nothing is
    added around a text. Null and empty texts have no tokens; equal rows are each counted; an empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            yield S.with_column(t.rows, n_bytes=np.diff(t.offsets), n_tokens=counts(t, path))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
