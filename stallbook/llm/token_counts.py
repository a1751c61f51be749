"""Token counts of the sections of a document, from one encoding of the whole document.

A document is encoded whole, so that counts are those a model would see; encoding sections apart
would change tokens at their borders. Tokens of a byte-level vocabulary concatenate to the text, so
their spans follow from their lengths. The spans are then joined to the sections, which are the lines
of the text with the line feed that ends them.

Rule for tokens that cross a border: a token belongs to the section that holds its first character
that is no white space; a token of white space alone to the section in which it begins. Every token is
counted once, so the counts of a document's sections add up to its own.

Cases: a null or empty text is one empty section without tokens. Text after the last line feed is a
section, also if empty. Repeated rows are counted like any. Spans are in code points, the end
exclusive; a code point that is split between tokens is where its first byte is. An empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm.tables import table, texts

AT_ONCE = 64
ROWS = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long, doc_tokens long"


def vocabulary() -> tuple[str, str]:
    """Path of the ranks, and the pattern that splits words."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def attributed(data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the sections in code points, tokens of each, and tokens of each that cross its border."""
    body = np.frombuffer(data, np.uint8)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    feeds = np.flatnonzero(body == 10)
    borders = np.append(feeds + 1, len(body))  # where each section ends
    white = (body == 32) | ((body >= 9) & (body <= 13))
    solid = np.append(np.flatnonzero(~white), len(body))
    first = solid[np.searchsorted(solid, starts)]
    at = np.where(first < ends, first, starts)
    section = np.searchsorted(borders[:-1], at, "right")
    crossing = np.searchsorted(borders[:-1], ends - 1, "right") != np.searchsorted(borders[:-1], starts, "right")
    points = np.concatenate(([0], np.cumsum((body & 0xC0) != 0x80)))
    size = len(borders)
    return points[borders], np.bincount(section, minlength=size), np.bincount(section[crossing], minlength=size)


def section_tokens(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document and section, see ROWS; n_crossing counts those of n_tokens that cross a border."""
    with open(path or vocabulary()[0], "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file of fixed size
    split = pattern or vocabulary()[1]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        known = ranks(content.value)
        lengths = np.zeros(max(known.values()) + 1, np.int64)
        for token, rank in known.items():
            lengths[rank] = len(token)
        encoding = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=known, special_tokens={})
        for batch in batches:
            for low in range(0, len(batch), AT_ONCE):
                part = batch.iloc[low : low + AT_ONCE]
                ids, made = [], []
                for row, text in enumerate(part["text"]):
                    data = (text or "").encode("utf-8", "replace")
                    sizes = lengths[np.asarray(encoding.encode_ordinary(text or ""), np.int64)]
                    ends, tokens, crossing = attributed(data, sizes)
                    ids.append(np.full(len(ends), row))
                    starts = np.concatenate(([0], ends[:-1]))
                    made.append(np.column_stack([np.arange(len(ends)), starts, ends, tokens, crossing, np.full(len(ends), len(sizes))]))
                out = pd.DataFrame(np.concatenate(made), columns=["section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"])
                out.insert(0, "doc_id", part["doc_id"].iloc[np.concatenate(ids)].to_numpy())
                yield out

    return texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(count, ROWS)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every section of every document."""
    return section_tokens(table(spark, folder, "documents"))
