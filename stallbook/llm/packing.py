"""Packing documents into sequences by bin completion.

Documents are tokenized and cut only where they exceed a sequence. Pieces of one length are alike, so
the plan is made from the counts of each length alone, a table of at most as many rows as a sequence
has tokens, whatever the corpus. It is a list of patterns: so many sequences with so many pieces of
these lengths.

The plan is a branch-and-bound. A branch fills a sequence around the largest piece left: fillings that
another one dominates, because one piece takes the place of none, one or several, are not tried, and
all others are, by rising waste. A branch is pruned when the waste so far leaves no room for fewer
sequences than the incumbent, which begins as the best-fit solution, when lengths weighed by a dual feasible
function say that what is left needs too many sequences, or when its remaining counts were met before at no more
waste. Fillings are used as often as the counts allow, then once, so the number
of steps does not grow with the corpus. A narrow search goes ahead, for a good incumbent: it tries WIDTH
fillings, each completed by the largest pieces that fit. The search is done at the lower bound or when no branch is
left; else each of the two ends after NODES fillings beyond its first descent, dominated ones counted. What it then
holds is complete, only not proven least; the column `proven` says which.

Pieces find their place by their rank among those of their length: ranks within (length, salt)
groups, plus running counts of the groups, so a length that very many pieces share is spread out.

Cases: null and empty texts are one token, the end mark. Repeated rows and ties are pieces like any.
A text is tokenized by the tokenizer whole or by its words between white space, which gives the same
ids as this tokenizer never joins across white space. Empty tables give no rows. Other columns are
not read.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallbook.llm.tables import in_small_batches, join_side, table, texts
from stallbook.storage import written

CAPACITY = 4096
END = 1
SALTS = 64
NODES = 20_000
WIDTH = 3
#: A task remembers the words it met last and their ids, up to so many bytes besides those of the texts at hand. Of
#: each word the numbers kept beside its letters and ids take so many.
REMEMBERED, WORD_BYTES = 8 << 20, 12
#: Bytes of text tokenized at once, and words of letters given to the tokenizer together.
AT_ONCE = 2 << 20
JOINED = 256
#: Signs behind a word that are tokens of their own.
PUNCTUATION = '.,;:!?"#%&*$'
#: How the vocabulary marks a token that ends a word.
WORD_END = "</w>"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of whole texts; words met before are not encoded again, if met of late.

    The words that are remembered are one array, their ids lie in one pool, so a word takes its letters, its ids and
    a few numbers.
    """

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word
        self.closes[[n for token, n in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.known = pa.array([], pa.string())
        self.pool, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int32)
        self.used, self.turn = np.zeros(0, np.int32), 0  # the turn in which each word was last met

    def encode_alone(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each word."""
        found = self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)
        ids = [np.array(x.ids, "<u4") for x in found]
        return np.concatenate([np.zeros(0, "<u4"), *ids]), np.fromiter(map(len, ids), np.int32, len(ids))

    def encode_joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for words of letters, many at once, parted where a token ends a word.

        And which words it went well for; a vocabulary that does not mark the ends of words leaves others.
        """
        borders = np.minimum(np.arange(0, len(words) + JOINED, JOINED), len(words)).astype(np.int32)
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(borders), words), " ").to_pylist()
        ids = [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        stops = [np.flatnonzero(self.closes[x]) + 1 for x in ids]
        want = np.diff(borders)
        good = [len(at) == n and at[-1] == len(x) for at, n, x in zip(stops, want, ids)]
        kept = [(x, np.diff(at, prepend=0)) for x, at, well in zip(ids, stops, good) if well]
        return (
            np.concatenate([np.zeros(0, "<u4"), *(x for x, _ in kept)]),
            np.concatenate([np.zeros(0, np.int32), *(n for _, n in kept)]).astype(np.int32),
            np.repeat(np.array(good, bool), want),
        )

    def learn(self, words: pa.Array) -> np.ndarray:
        """Remember different words that are not known; the place of each among the known."""
        letters = pc.ascii_is_alpha(words).to_numpy(zero_copy_only=False)
        for at in np.flatnonzero(~letters).tolist():
            x = words[at].as_py()
            letters[at] = x.isalpha() and max(x) <= "\u024f" and x.lower().isalpha()
        plain = np.flatnonzero(letters)
        ids, sizes, well = self.encode_joined(words.take(pa.array(plain)))
        apart = np.concatenate([np.flatnonzero(~letters), plain[~well]])
        other_ids, other_sizes = self.encode_alone(words.take(pa.array(apart)))
        order = np.concatenate([plain[well], apart])
        places = np.empty(len(words), np.int64)
        places[order] = len(self.known) + np.arange(len(order))
        self.known = pa.concat_arrays([self.known, words.take(pa.array(order))])
        self.pool = np.concatenate([self.pool, ids, other_ids])
        self.sizes = np.concatenate([self.sizes, sizes, other_sizes])
        self.used = np.concatenate([self.used, np.full(len(order), self.turn, np.int32)])
        return places

    def forget(self) -> None:
        """Of more than REMEMBERED bytes, keep the words met last, up to half of them."""
        costs = pc.binary_length(self.known).to_numpy() + 4 * self.sizes + WORD_BYTES
        if costs.sum() <= REMEMBERED:
            return
        latest = np.argsort(-self.used, kind="stable")
        kept = np.sort(latest[np.cumsum(costs[latest]) <= REMEMBERED // 2])
        starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        self.pool = self.pool[runs(starts[kept], self.sizes[kept])]
        self.known = self.known.take(pa.array(kept))
        self.sizes, self.used = self.sizes[kept], self.used[kept]

    def places(self, words: pa.Array) -> np.ndarray:
        """The place of each of different words among the known, which they are from then on."""
        self.turn += 1
        found = pc.index_in(words, self.known)
        unmet = pc.is_null(found)
        places = found.fill_null(0).to_numpy().astype(np.int64)
        missing = unmet.to_numpy(zero_copy_only=False)
        self.used[places[~missing]] = self.turn
        if missing.any():
            places[missing] = self.learn(words.filter(unmet))
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each closed by END, and where each text ends.

        Each different word is looked up once for all texts, its ids are then copied to its places.
        """
        self.forget()
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        placed = split.flatten().dictionary_encode()
        core, tail = (part.dictionary_encode() for part in parted(placed.dictionary))
        both = pa.concat_arrays([core.dictionary, tail.dictionary]).dictionary_encode()
        known = self.places(both.dictionary)[both.indices.to_numpy()]
        n = len(core.dictionary)
        # The ids of each different word with what follows it, in a row, and END after them all.
        halves = np.column_stack([known[core.indices.to_numpy()], known[n + tail.indices.to_numpy()]])
        sizes = self.sizes[halves]
        starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
        pool = np.append(self.pool[runs(starts[halves.ravel()], sizes.ravel())], np.uint32(END))
        sizes = np.append(sizes.sum(axis=1, dtype=np.int32), np.int32(1))
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        # Where each text ends there is one place more.
        last = np.cumsum(pc.list_value_length(split).to_numpy().astype(np.int64)) + np.arange(1, len(split) + 1)
        order = np.full(last[-1] if len(last) else 0, len(sizes) - 1, np.int32)
        inside = np.ones(len(order), bool)
        inside[last - 1] = False
        order[inside] = placed.indices.to_numpy()
        taken = sizes[order]
        ends = np.cumsum(taken, dtype=np.int64)[last - 1]
        return pool[runs(starts[order], taken)], ends


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, so many as its size, in a row."""
    after = np.cumsum(sizes, dtype=np.int64)
    total = int(after[-1]) if len(after) else 0
    kind = np.int32 if total < 1 << 31 else np.int64
    out = np.repeat((starts - after + sizes).astype(kind), sizes)
    out += np.arange(total, dtype=kind)
    return out


def parted(chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words and the punctuation after them, which this tokenizer takes apart anyway.

    ASCII letters are lower-cased, as the tokenizer does. Apostrophes stay, as they may begin a
    token of their own, and so does what follows a letter that may become a letter and a mark.
    """
    cut = pc.utf8_rtrim(chunks, characters=PUNCTUATION)
    last = pc.utf8_slice_codeunits(cut, -1).dictionary_encode()
    apart = pa.array([c != "" and c <= "\u024f" and c.lower().isalpha() for c in last.dictionary.to_pylist()], pa.bool_())
    core = pc.if_else(apart.take(last.indices), cut, chunks)
    sizes = (pc.binary_length(chunks).to_numpy() - pc.binary_length(core).to_numpy()).astype(np.int64)
    ends = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset + 1 : chunks.offset + len(chunks) + 1]
    after = np.cumsum(sizes)
    source = np.repeat(ends - after, sizes) + np.arange(after[-1] if len(after) else 0)
    tails = np.frombuffer(chunks.buffers()[2] or b"", np.uint8)[source]
    offsets = np.concatenate([[0], after]).astype(np.int32)
    tail = pa.StringArray.from_buffers(len(chunks), pa.py_buffer(offsets.tobytes()), pa.py_buffer(tails.tobytes()))
    return pc.if_else(pc.ascii_is_alpha(core), pc.ascii_lower(core), core), tail


def groups_of(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows from and to, of about AT_ONCE bytes of text together; a longer text is alone."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    total = int(sizes[-1]) if len(sizes) else 0
    share = max(1, -(-total // max(1, round(total / AT_ONCE))))  # equal shares, so that none is a small rest
    borders = [0, *(np.flatnonzero(np.diff(np.maximum(sizes - 1, 0) // share)) + 1).tolist(), len(texts)]
    return ((low, high) for low, high in zip(borders, borders[1:]) if low < high)


def pieces(docs: DataFrame, capacity: int, model: Broadcast[str]) -> DataFrame:
    """The pieces of every document with the crc32 of their ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(model.value)
        for batch in batches:
            doc_ids, bodies = batch.column("doc_id"), batch.column("text")
            for low, high in groups_of(bodies):
                ids, ends = encoder.encode(bodies.slice(low, high - low))
                rows, first = [], 0
                for row, end in enumerate(ends.tolist(), low):
                    for number, at in enumerate(range(first, end, capacity)):
                        own = ids[at : min(at + capacity, end)]
                        rows.append((row, number, at - first, len(own), zlib.crc32(own)))
                    first = end
                row, number, start, length, crc = np.array(rows, np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(row)), pa.array(number.astype(np.int32)), *map(pa.array, (start, length, crc))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        # Workers live on for other tasks; what the encoder took goes back.
        del encoder
        pa.default_memory_pool().release_unused()

    return texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, PIECES
    )


def best_fit(counts: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing on counts: patterns as (sequences, [(length, pieces), ...])."""
    left, plan = counts.copy(), []
    while (lengths := np.flatnonzero(left)).size:
        gap, used = len(counts) - 1, {}
        while (fits := lengths[(lengths <= gap) & (left[lengths] > 0)]).size:
            size = int(fits[-1])
            n = min(int(left[size]), gap // size)
            used[size] = n
            left[size] -= n
            gap -= n * size
        times = 1 + min(int(left[s]) // n for s, n in used.items())
        for s, n in used.items():
            left[s] -= n * (times - 1)
        plan.append((times, list(used.items())))
    return plan


def dominated(filling: list[tuple[int, int]], waste: int, lengths: list[int], have: list[int]) -> bool:
    """Whether a piece that is left could take the place of some pieces, or of none, of a filling."""
    used, sums = dict(filling), 1
    for size, n in filling:
        for _ in range(n):
            sums |= sums << size
    spread, width = sums << 1, 1  # sums made larger by 1 to waste
    while width < waste:
        step = min(width, waste - width)
        spread |= spread << step
        width += step
    larger = spread if waste else 0
    return any(
        n > used.get(size, 0) and (larger >> size & 1 or size not in used and sums >> size & 1) for size, n in zip(lengths, have, strict=True)
    )


def largest_first(gap: int, left: np.ndarray, width: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Up to width fillings of a gap, each with the largest pieces, as (waste, [(length, pieces), ...])."""
    if gap and left[gap]:
        return [(0, [(gap, 1)])]
    fits = np.flatnonzero(left[: gap + 1])
    if not fits.size:
        return [(gap, [])]
    larger = fits[fits * 2 >= gap]
    pairs = larger[left[gap - larger] >= np.where(larger * 2 == gap, 2, 1)]
    if pairs.size:
        return [(0, [(int(a), 1), (gap - int(a), 1)] if 2 * a != gap else [(int(a), 2)]) for a in pairs[: -width - 1 : -1]]
    found = []
    for size in fits[: -width - 1 : -1].tolist():
        n = max(1, min(int(left[size]), gap // size - 2))
        left[size] -= n
        waste, rest = largest_first(gap - n * size, left, 1)[0]
        left[size] += n
        found.append((waste, [(size, n), *rest]))
    return sorted(found, key=lambda x: (x[0], len(x[1])))


def completions(gap: int, left: np.ndarray, room: int) -> Iterator[tuple[int, list[tuple[int, int]]] | None]:
    """All undominated fillings of a gap as (waste, [(length, pieces), ...]) by rising waste up to room.

    None stands for a dominated filling that was looked at.
    """
    if gap and left[gap]:
        yield 0, [(gap, 1)]  # one piece for all dominates every other filling
        return
    fits = np.flatnonzero(left[: gap + 1])
    if not fits.size:
        if gap <= room:
            yield gap, []
        return
    lengths, have = fits.tolist(), left[fits].tolist()
    larger = fits[fits * 2 >= gap]
    for a in larger[left[gap - larger] >= np.where(larger * 2 == gap, 2, 1)][::-1].tolist():
        yield 0, [(a, 1), (gap - a, 1)] if 2 * a != gap else [(a, 2)]

    # Bit n of sums[k] says whether the first k lengths can make n; equal sets are one object.
    sums, all_bits = [1], (1 << gap + 1) - 1
    for size, n in zip(lengths, have, strict=True):
        bits, rest, step = sums[-1], min(n, gap // size), 1
        while rest:
            bits |= bits << size * min(step, rest) & all_bits
            rest -= min(step, rest)
            step *= 2
        sums.append(sums[-1] if bits == sums[-1] else bits)

    def exact(target: int, k: int) -> Iterator[list[tuple[int, int]]]:
        """Fillings of just target with the first k lengths, the largest first."""
        if not target:
            yield []
            return
        for at in range(bisect_right(lengths, target, 0, k) - 1, -1, -1):
            if not sums[at + 1] >> target & 1:
                return
            for n in range(min(have[at], target // lengths[at]), 0, -1):
                if sums[at] >> target - n * lengths[at] & 1:
                    for rest in exact(target - n * lengths[at], at):
                        yield [(lengths[at], n), *rest]

    for waste in range(min(gap, room) + 1):
        if sums[-1] >> gap - waste & 1:
            for filling in exact(gap - waste, len(lengths)):
                if waste or sum(n for _, n in filling) != 2:  # pairs without waste were first
                    yield None if dominated(filling, waste, lengths, have) else (waste, filling)


def together(size: int, filling: list[tuple[int, int]]) -> list[tuple[int, int]]:
    used = {size: 1}
    for s, n in filling:
        used[s] = used.get(s, 0) + n
    return list(used.items())


def searched(counts: np.ndarray, nodes: int = NODES) -> tuple[list[tuple[int, list[tuple[int, int]]]], bool]:
    """A plan for counts, where counts[n] pieces have length n and the capacity is the last index.

    And whether it is proven to have the fewest sequences.
    """
    plan, done = improved(counts, best_fit(counts), nodes, WIDTH)
    return (plan, True) if done else improved(counts, plan, nodes)


def weights(counts: np.ndarray) -> tuple[int, np.ndarray, int]:
    """The best lower bound found for counts, and the weight of each length and the capacity's that give it.

    Lengths are weighed so that no sequence holds more weight than the capacity's (dual feasible functions): by themselves;
    by how many parts of a k-th of the capacity they exceed; and, for each e, by how many pieces of at least e they
    keep out of their sequence, which is what counts where two or three pieces make a sequence.
    """
    capacity = len(counts) - 1
    x = np.arange(capacity + 1)

    def functions() -> Iterator[tuple[np.ndarray, int]]:
        yield x, capacity
        for k in range(1, min(capacity, 64)):
            parts = (k + 1) * x
            yield np.where(parts % capacity == 0, k * x, parts // capacity * capacity), k * capacity
        for e in range(1, capacity // 2 + 1):
            whole = capacity // e
            yield np.where(2 * x > capacity, whole - (capacity - x) // e, np.where(x >= e, 1, 0)), whole

    best = (-1, x, capacity)
    for weight, full in functions():
        bound = -(-int(counts @ weight) // full)
        if bound > best[0]:
            best = bound, weight, full
    return best


def improved(
    counts: np.ndarray, incumbent: list[tuple[int, list[tuple[int, int]]]], nodes: int, width: int | None = None
) -> tuple[list[tuple[int, list[tuple[int, int]]]], bool]:
    """The best plan found and whether it is proven least; with a width, by the narrow search."""
    capacity = len(counts) - 1
    total = int((counts * np.arange(len(counts))).sum())
    bound, weight, full = weights(counts)
    unpacked, opened = int(counts @ weight), 0  # weight that is left, and sequences chosen
    least = sum(times for times, _ in incumbent)
    left = counts.copy()
    chosen: list[tuple[int, list[tuple[int, int]], int]] = []
    waste, visited, returned = 0, 0, False
    draw = random.Random(8)
    keys = [draw.getrandbits(128) for _ in range(len(counts))]
    state, met = 0, {}  # pieces used as a sum of keys, and the waste each sum was met with

    def room() -> int:
        """Waste that a better solution may still have."""
        return (least - 1) * capacity - total - waste

    def fillings() -> Iterator[tuple[int, int, list[tuple[int, int]]] | None]:
        """What to try around the largest piece left: how often, the waste of one, and the pieces."""
        size = int(np.flatnonzero(left)[-1])
        left[size] -= 1
        others = left.copy()
        left[size] += 1
        gap = capacity - size
        for found in completions(gap, others, room()) if width is None else largest_first(gap, others, width):
            if found is None:
                yield None
                continue
            spent, used = found[0], together(size, found[1])
            times = min(int(left[s]) // n for s, n in used)
            if times > 1 and times * spent <= room():
                yield times, spent, used
                if width is not None:
                    continue
            yield 1, spent, used

    def use(times: int, used: list[tuple[int, int]]) -> None:
        nonlocal state, unpacked, opened
        opened += times
        for size, n in used:
            left[size] -= times * n
            state += times * n * keys[size]
            unpacked -= times * n * int(weight[size])

    branches = [fillings()] if least > bound else []
    while branches and least > bound and visited <= nodes:
        found = next(branches[-1], False)
        if found is False:
            returned = True
            branches.pop()
            if chosen:
                times, used, spent = chosen.pop()
                waste -= spent
                use(-times, used)
            continue
        if found is None or returned:
            visited += 1
        if found is None or found[0] * found[1] > room():
            continue
        times, spent, used = found
        use(times, used)
        known = met.get(state, waste + times * spent + 1) <= waste + times * spent
        if left.any() and (known or opened - (-unpacked // full) >= least):
            use(-times, used)
            continue
        waste += times * spent
        met[state] = waste
        chosen.append((times, used, times * spent))
        if left.any():
            branches.append(fillings())
            continue
        incumbent = [(times, used) for times, used, _ in chosen]
        least = sum(times for times, _ in incumbent)
        branches.append(iter(()))
    return incumbent, least <= bound or width is None and not branches


def packed(counts: np.ndarray, nodes: int = NODES) -> list[tuple[int, list[tuple[int, int]]]]:
    """The plan that is searched."""
    return searched(counts, nodes)[0]


def places(plan: list[tuple[int, list[tuple[int, int]]]], capacity: int) -> np.ndarray:
    """The plan by length and rank: rows of (length, first rank, first sequence, pieces in it, offset)."""
    ranks, first, rows = np.zeros(capacity + 1, np.int64), 0, []
    for times, used in plan:
        offset = 0
        for size, n in used:
            rows.append((size, ranks[size], first, n, offset))
            ranks[size] += times * n
            offset += size * n
        first += times
    out = np.array(rows, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def ranked(cut: DataFrame) -> DataFrame:
    """Pieces with a gapless rank among those of their length; cut is written."""
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)))
    sizes = written(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "sizes")
    before = sizes.select(
        F.col("length").alias("of_length"),
        F.col("salt").alias("of_salt"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"),
    )
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    numbered = salted.withColumn("within", within - 1)
    side = join_side(written(before, "before"))
    return numbered.join(side, (F.col("length") == F.col("of_length")) & (F.col("salt") == F.col("of_salt"))).select(
        *cut.columns, (F.col("before") + F.col("within")).alias("rank")
    )


def sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Every piece of every document with its sequence and its token offset there."""
    with open(path or vocabulary(), encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file of fixed size
    cut = written(pieces(in_small_batches(docs), capacity, model), "pieces")
    model.unpersist()
    counts = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most capacity rows
        counts[row["length"]] = row["n"]
    plan, proven = searched(counts)
    where = places(plan, capacity)
    sent = docs.sparkSession.sparkContext.broadcast(where)  # as many rows as the plan has, see above

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sent.value
        keys = (known[:, 0] << 48) | known[:, 1]
        for batch in batches:
            rank, length = batch["rank"].to_numpy(), batch["length"].to_numpy()
            row = known[np.searchsorted(keys, (length << 48) | rank, "right") - 1]
            ahead = rank - row[:, 1]
            out = batch.drop(columns="rank")
            out["sequence_id"] = row[:, 2] + ahead // row[:, 3]
            out["offset"] = row[:, 4] + ahead % row[:, 3] * length
            yield out

    placed = ranked(cut).mapInPandas(place, f"{PIECES}, sequence_id long, offset long")
    return placed.withColumn("proven", F.lit(proven))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return sequences(table(spark, folder, "documents"))
