"""Token counts by a two-tier lookup of pre-token lengths.

A byte-level BPE never merges across pre-tokens, so a text's count is the sum of
its pre-tokens' counts.  Tier one is a broadcast hash table of frequent pre-tokens and
their lengths, of a fixed size; tier two is a table in each worker process for what the
first lacks, and what neither has is encoded and kept.  Every text is counted where it
was read: no pre-token is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pieces import SENT_SLOTS, Pieces, Table, character_classes, frequent_pieces

#: Pre-tokens of the broadcast table at most.
FREQUENT = 50_000
#: They come from so many rows at most, of at most so many characters.  This bounds what reaches the driver and changes speed only.
SAMPLE_ROWS, SAMPLE_CHARS = 512, 20_000


class TokenCounter(Pieces):
    """Counts as ``Tokenizer.encode(text, add_special_tokens=False)`` has them; one a worker process."""

    _made: TokenCounter | None = None

    @classmethod
    def of(cls, path: str, parts: tuple[np.ndarray, Table]) -> TokenCounter:
        """The worker's counter, made anew when other ``counter_parts`` come."""
        if cls._made is None or cls._made.classes is not parts[0]:
            cls._made = cls(path, *parts)
        return cls._made

    def work_out(self, pieces: list[bytes]) -> np.ndarray:
        return np.fromiter(map(len, self.encoded(pieces)), np.int64, len(pieces))

    def count(self, texts: list[str]) -> np.ndarray:
        out = [np.empty(0, np.int64)]
        for values, pieces in self.blocks(texts):
            ends, last = np.concatenate([[0], np.cumsum(values)]), np.cumsum(pieces)
            out.append(ends[last] - ends[last - pieces])
        found = np.concatenate(out)
        if self.special:  # one token each
            found += np.array([len(self.special.findall(t)) for t in texts], np.int64)
        return found


def sample_texts(docs: DataFrame, text: str = "text") -> list[str]:
    """A few rows' texts, those that Spark reads first: one task reads them, however large the table is."""
    column = F.col(f"`{text}`")
    return [r[0] for r in docs.select(column).where(F.char_length(column).between(1, SAMPLE_CHARS)).limit(SAMPLE_ROWS).collect()]


def counter_parts(docs: DataFrame, path: str, text: str = "text") -> tuple[np.ndarray, Table]:
    """The classes of characters, and the table of the most frequent pre-tokens of some rows with their token counts."""
    counter = TokenCounter(path, character_classes(path))
    *key, pieces = frequent_pieces(counter, sample_texts(docs, text), FREQUENT)
    table = Table(SENT_SLOTS)
    table.put(*key, counter.work_out(pieces))
    return counter.classes, table


def token_length(docs: DataFrame, path: str, text: str = "text") -> Column:
    """The tokens of each row's text as a long; null counts as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(counter_parts(docs, path, text))

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(TokenCounter.of(path, sent.value).count(texts.to_pylist()), pa.int64())

    return count(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def count_tokens(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    ``path``: a byte-level BPE of the tokenizers library.  Counts are those of its ``encode`` without added special
    tokens, special strings inside a text included.  A null or empty text has 0 bytes and 0 tokens, a null
    ``doc_id`` stays null, repeated rows give repeated rows, no rows give no rows; other columns are not read.
    A text of any length is worked on in blocks of ``pieces.BLOCK`` characters, or up to the next space after them.
    """
    column = F.col(f"`{text}`")
    out = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.octet_length(column), F.lit(0)).cast("long").alias("n_bytes"),
        token_length(docs, path, text).alias("n_tokens"),
    )
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
