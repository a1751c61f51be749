"""Language identification by compression.

Each language has a raw-content zstandard dictionary of its own text. A text is encoded with every
dictionary, and the language whose dictionary leaves the fewest bytes is its own. A text is rejected, and still gets the better guess,
when the second best is less than MARGIN bytes or RATE of the best size behind it, as for random letters
and languages that were not learnt; and when windows with more than OTHERS of its bytes are as clearly
another language's, as in texts of two languages. These limits were chosen on rows that are learnt from.

Only letters count: a text is lower-cased and its words of letters are joined by spaces, so digits,
markup and symbols say nothing. It is encoded in pieces, as a long piece would find its matches in
itself rather than in the dictionary. Each piece is followed by the same run of spaces, without which
zstandard would store short pieces as they are, at equal length in every language.

Dictionaries are learnt from a bounded sample, SAMPLE_DOCS texts of each language with at most
SAMPLE_CHARS characters of each, chosen by a hash of doc_id. Only rows whose crc32(doc_id as text) is
not divisible by HELD_OUT, with a language and an id, are learnt from. One dictionary of at most
DICTIONARY bytes is kept per language, so the model grows with the number of languages only.

Cases: a null text and one without letters is `und`, score 0, rejected; so is everything when there is
nothing to learn from. Of languages that leave equal bytes the one with more texts in the table wins,
then the first by name. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm.tables import in_small_batches, table

HELD_OUT = 5
SAMPLE_DOCS = 400
SAMPLE_CHARS = 500
DICTIONARY = 1 << 16
PIECE = 2048
PAD = b" " * 128
#: Bytes, and share of its own size, by which the best language must beat the second.
MARGIN = 3
RATE = 0.08
#: Share of the bytes that may be in windows of other languages; a window is a quarter of a text between these sizes.
OTHERS = 0.25
WINDOWS = (48, 512)
UNKNOWN = "und"

PREDICTION = "lang_pred string, score double, accepted boolean"


def letters(text: str | None) -> bytes:
    """Lower-cased words of letters between single spaces."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    return f" {' '.join(words)} ".encode("utf-8", "replace") if words else b""


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def learnt(docs: DataFrame, lang: str = "lang") -> list[tuple[str, bytes]]:
    """Languages, the commonest first, with their dictionaries."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), F.col(lang).cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    # The share of hashes that leaves about twice the sample; then exactly the sample, least hashes first.
    share = F.create_map(*[F.lit(x) for lang_, n in counts.items() for x in (lang_, min(1.0, 2 * SAMPLE_DOCS / n))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40))
    some = rows.withColumn("draw", draw).where(F.col("draw") < F.element_at(share, F.col("lang")) * (1 << 40))
    start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS)).cast("int") + 1
    piece = F.substr("text", start, F.lit(SAMPLE_CHARS))
    picked = some.groupBy("lang").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("draw", piece.alias("piece")))), 1, SAMPLE_DOCS)["piece"].alias("pieces")
    )
    found = {}
    for r in picked.toLocalIterator():
        found[r["lang"]] = b"".join(letters(p) for p in r["pieces"])[:DICTIONARY]
    return sorted(((k, v) for k, v in found.items() if v), key=lambda kv: (-counts[kv[0]], kv[0]))


def compressors(dictionaries: list[bytes]) -> list[zstandard.ZstdCompressor]:
    settings = zstandard.ZstdCompressionParameters(
        window_log=18, chain_log=16, hash_log=16, search_log=4, min_match=3, target_length=16,
        strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    made = []
    for content in dictionaries:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=settings)
        made.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary))
    return made


def encoded_sizes(text: str | None, made: list[zstandard.ZstdCompressor]) -> list[int]:
    """Bytes of the whole text in each language; empty if it has no letters."""
    body = letters(text)
    if not body:
        return []
    pieces = [body[at : at + PIECE] + PAD for at in range(0, len(body), PIECE)]
    return [sum(len(c.compress(p)) for p in pieces) for c in made]


def clear(best: float, second: float) -> bool:
    return second - best >= max(MARGIN, RATE * best)


def foreign(text: str | None, best: int, made: list[zstandard.ZstdCompressor]) -> float:
    """The share of a text's bytes in windows that are clearly of another language than the best."""
    body = letters(text)
    size = min(WINDOWS[1], max(WINDOWS[0], -(-len(body) // 4)))
    others = 0
    for at in range(0, len(body), size):
        window = body[at : at + size]
        sizes = [len(c.compress(window + PAD)) for c in made]
        others += len(window) * clear(min(sizes), sizes[best])
    return others / len(body)


def predictor(model: list[tuple[str, bytes]]):
    """A column function: text to language, score and whether it is accepted."""
    names, dictionaries = [k for k, _ in model], [v for _, v in model]

    def one(text: str | None, made: list[zstandard.ZstdCompressor]) -> tuple[str, float, bool]:
        sizes = encoded_sizes(text, made)
        if not sizes:
            return UNKNOWN, 0.0, False
        best = int(np.argmin(sizes))
        over = np.array(sizes, float) - sizes[best]
        second = min(np.delete(sizes, best), default=float("inf"))
        accepted = clear(sizes[best], second) and foreign(text, best, made) <= OTHERS
        return names[best], float(1 / np.exp(-over).sum()), bool(accepted)

    @F.pandas_udf(PREDICTION)
    def predict(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        made = compressors(dictionaries)
        for column in columns:
            yield pd.DataFrame([one(x, made) for x in column], columns=["lang_pred", "score", "accepted"])


    return predict


def identified(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every document."""
    predict = predictor(learnt(docs, lang))
    return in_small_batches(docs).select(
        F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text")).alias("p")
    ).select("doc_id", "held_out", "p.*")


def keep_identified(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """docs without those whose language is rejected, all columns unchanged."""
    predict = predictor(learnt(docs, lang))
    return in_small_batches(docs).where(predict(F.col("text"))["accepted"])


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    return identified(table(spark, folder, "documents"))
