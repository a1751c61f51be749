"""What tasks hold at once and what they do again."""

import random

import pyarrow as pa
import pytest

from stallbook.llm import packing
from stallbook.llm.tables import BATCH_BYTES, in_small_batches

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_python_workers_get_texts_by_bytes(spark):
    docs = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "repeat(cast(id % 10 AS string), 10000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([len(batch)])], names=["size", "n"])

    spark.conf.unset(SETTING)
    rows = in_small_batches(docs).mapInArrow(sizes, "size long, n long").collect()
    assert sum(r["n"] for r in rows) == 3000
    assert max(r["size"] for r in rows) < BATCH_BYTES * 1.1
    spark.conf.unset(SETTING)


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, 0

    def encode_batch_fast(self, texts, **named):
        self.seen += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **named)


@pytest.fixture(scope="module")
def encoder():
    with open(packing.vocabulary(), encoding="utf-8") as file:
        return packing.Encoder(file.read())


def whole(encoder, text):
    return [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, packing.END]


def test_words_met_of_late_are_not_encoded_again(encoder):
    """Four texts of 45,000 words each, all different, fit what a task remembers."""
    draw = random.Random(3)
    words = list({"".join(draw.choices("abcdefghijklmnop", k=7)) for _ in range(190_000)})[:180_000]
    texts = [" ".join(words[at : at + 45_000]) for at in range(0, 180_000, 45_000)]
    first = [encoder.encode(pa.array([x]))[0].tolist() for x in texts]
    plain, encoder.tokenizer = encoder.tokenizer, Counting(encoder.tokenizer)
    again = [encoder.encode(pa.array([x]))[0].tolist() for x in texts]
    counted, encoder.tokenizer = encoder.tokenizer, plain
    assert counted.seen == 0
    assert first == again and first[0] == whole(encoder, texts[0])


def test_remembered_words_are_bounded_by_bytes(encoder, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50_000)
    draw = random.Random(4)
    for _ in range(12):
        words = ["".join(draw.choices("abcdeé-'0.", k=draw.randint(1, 60))) for _ in range(500)]
        texts = [" ".join(words[:200]), None, "", " ".join(words[200:]), "Don't İstanbul é́ \U0001f600 x !?.. WORD word, word. I'm"]
        ids, ends = encoder.encode(pa.array(texts, pa.string()))
        want = [whole(encoder, x or "") for x in texts]
        assert ids.tolist() == sum(want, []) and ends.tolist() == [sum(map(len, want[: n + 1])) for n in range(len(want))]
    encoder.forget()
    assert encoder.known.nbytes + encoder.pool.nbytes + encoder.sizes.nbytes + encoder.used.nbytes <= 50_000
    ids, ends = encoder.encode(pa.array([], pa.string()))
    assert len(ids) == len(ends) == 0


def test_texts_are_shared_out_evenly():
    texts = pa.array(["x" * 1000] * 4200)
    sizes = [1000 * (high - low) for low, high in packing.groups_of(texts)]
    assert sum(sizes) == 4_200_000 and max(sizes) < 1.2 * min(sizes)
    assert list(packing.groups_of(pa.array(["", None], pa.string()))) == [(0, 2)]
    assert list(packing.groups_of(pa.array([], pa.string()))) == []
