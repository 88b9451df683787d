"""Token counts per document with a shortcut for pre-tokens that are whole tokens."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.tokens import Remembered, vocabulary, whole_tokens

# Where none of these occurs, no two white-space characters of a plain text stand side by side.
SIDE_BY_SIDE = ("  ", "\n ", " \n", "\n\n", "\t", "\r")


class Counter:
    """Counts tokens of texts; one per worker process, so that words met in earlier tasks are known."""

    def __init__(self, path: str, proven: list[str]):
        self.vocabulary = vocabulary(path)
        self.proven = frozenset(proven)
        self.after_space = Remembered(lambda word: self.count(" " + word))

    def count(self, text: str) -> int:
        """Tokens of a plain text: 1 for a proven pre-token, the others merged."""
        cut = self.vocabulary.pattern.findall(text)
        return sum(1 if x in self.proven else len(self.vocabulary.merge(x)) for x in cut)

    def tokens(self, text: str) -> int:
        v = self.vocabulary
        if not v.plain(text):
            return len(v.encode(text))
        if any(x in text for x in SIDE_BY_SIDE):
            return self.count(text)
        # No pre-token reaches over a single space into the next word: each word counts on its own.
        first, *others = text.split(" ")
        return self.count(first) + sum(map(self.after_space.__getitem__, others))


_counters: dict[str, Counter] = {}


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Counts equal the library's for the file at `path`, without added begin or end tokens; special
    strings inside a text count as their one token, as by the library's default. The strings that
    encode alone as one token are proven on the driver (their number is bounded by the vocabulary)
    and broadcast; a pre-token among them counts 1 without a merge, any other is merged. Texts with
    characters whose class depends on the Unicode version are encoded by the library.

    A null text is empty: 0 bytes, 0 tokens. Repeated rows and null ids each give their own row; an
    empty table gives no rows. Only the two named columns are read, so further columns never clash.
    """
    proven = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path, proven.value)
        counter = _counters[path]
        for batch in batches:
            counted = [counter.tokens(x.as_py() or "") for x in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), pa.array(counted, pa.int64()), batch.column(2)],
                names=["id", "n_tokens", "n_bytes"],
            )

    read = docs.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("n_bytes"),
    )
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_column].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_bytes", T.LongType()),
        ]
    )
    return read.mapInArrow(count, schema).select(
        F.col("id").alias(id_column),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
