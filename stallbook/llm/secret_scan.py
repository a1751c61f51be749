"""Secrets by one deterministic automaton for all rules.

The rules are regular expressions over bytes. They are compiled together: a nondeterministic
automaton that may begin a match anywhere, made deterministic by subset construction and minimised
by partition refinement, ends as one array of transitions. A text is read once, byte by byte, and the
state tells at each byte which rules have a match ending there. Matches begin where the reversed
automaton of the rule, run back from the first end, last accepts; they end where the rule's own
automaton, run on from there, last accepts. So spans are leftmost, longest and do not overlap within
a rule, and rules with a least length drop shorter ones afterwards.

Rules are the three base kinds and, after them, further kinds that add spans. Spans are in code points.

Cases: null and empty texts have no spans. Repeated rows are scanned like any. Texts are scanned
whole, in memory that does not grow with the number of matches but for the spans themselves. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm.tables import table, texts


@dataclass(frozen=True)
class Rule:
    """A kind of secret; `least` bytes are asked for of its match, or of the value assigned in it."""

    kind: str
    pattern: str
    least: int = 0
    assigned: bool = False


def any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


NAMES = "|".join([*map(any_case, ("password", "passwd", "secret", "token")), any_case("api") + "_?" + any_case("key")])

BASE = (
    Rule("assign", f"({NAMES})[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+", 6, True),
    # At least so many characters from the first AKIA of a run, which is the base kind's own condition.
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", "-----BEGIN\\x20[A-Z\\x20]*PRIVATE\\x20KEY-----"),
    Rule("github", "gh[opsu]_[A-Za-z0-9]+", 40),
)
RULES = BASE + MORE


class Machine:
    """A nondeterministic automaton under construction: edges on sets of bytes and empty moves."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.moves: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.moves.append([])
        return len(self.edges) - 1


def parsed(pattern: str):
    """Syntax tree of a pattern: literals, classes, groups, alternatives, ? * + {m,}."""
    at = 0

    def escape() -> int:
        nonlocal at
        if pattern[at] == "x":
            at += 3
            return int(pattern[at - 2 : at], 16)
        at += 1
        return ord(pattern[at - 1])

    def char() -> int:
        nonlocal at
        at += 1
        return escape() if pattern[at - 1] == "\\" else ord(pattern[at - 1])

    def atom():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            inner = either()
            at += 1
            return inner
        if pattern[at] != "[":
            return ("set", frozenset([char()]))
        at += 1
        found: set[int] = set()
        while pattern[at] != "]":
            low = high = char()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                high = char()
            found.update(range(low, high + 1))
        at += 1
        return ("set", frozenset(found))

    def repeated():
        nonlocal at
        inner = atom()
        while at < len(pattern) and pattern[at] in "?*+{":
            sign = pattern[at]
            at += 1
            if sign == "{":
                end = pattern.index(",}", at)
                inner = ("sequence", [inner] * int(pattern[at:end]) + [("star", inner)])
                at = end + 2
            elif sign == "?":
                inner = ("either", [inner, ("sequence", [])])
            else:
                inner = ("star", inner) if sign == "*" else ("sequence", [inner, ("star", inner)])
        return inner

    def either():
        nonlocal at
        choices = []
        while True:
            parts = []
            while at < len(pattern) and pattern[at] not in "|)":
                parts.append(repeated())
            choices.append(("sequence", parts))
            if at >= len(pattern) or pattern[at] == ")":
                return choices[0] if len(choices) == 1 else ("either", choices)
            at += 1

    return either()


def built(machine: Machine, tree, start: int, backwards: bool = False) -> int:
    """Add a tree to the machine behind a state; the state in which it is matched."""
    kind, inner = tree
    end = machine.state()
    if kind == "set":
        machine.edges[start].append((inner, end))
    elif kind == "sequence":
        last = start
        for part in reversed(inner) if backwards else inner:
            last = built(machine, part, last, backwards)
        machine.moves[last].append(end)
    elif kind == "either":
        for part in inner:
            machine.moves[built(machine, part, start, backwards)].append(end)
    else:
        loop = machine.state()
        machine.moves[start].append(loop)
        machine.moves[built(machine, inner, loop, backwards)].append(loop)
        machine.moves[loop].append(end)
    return end


@dataclass
class Automaton:
    """Transitions as one array, state * 256 + byte; what each state accepts, as a bit for each rule.

    States are numbered so that those that accept come last, from `accepting` on. State `dead`, if
    there is one, is never left.
    """

    table: list[int]
    accepts: list[int]
    start: int
    accepting: int
    dead: int


def determined(machine: Machine, start: int, ends: dict[int, int], anywhere: bool) -> Automaton:
    """Subset construction, then minimisation. anywhere: a match may begin at every byte."""

    def closed(state: int) -> int:
        """The states reached without a byte, those that matter, as bits."""
        todo, seen = [state], {state}
        while todo:
            for x in machine.moves[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return sum(1 << x for x in seen if machine.edges[x] or x in ends)

    # Bytes that no edge tells apart share a column until the end.
    sets = sorted({chars for edges in machine.edges for chars, _ in edges}, key=sorted)
    signs = [tuple(c in chars for chars in sets) for c in range(256)]
    kinds = sorted(set(signs))
    column = np.array([kinds.index(s) for s in signs])
    reached = [[0] * len(kinds) for _ in machine.edges]
    for x, own in enumerate(machine.edges):
        for chars, to in own:
            near = closed(to)
            for k, sign in enumerate(kinds):
                if sign[sets.index(chars)]:
                    reached[x][k] |= near
    first = closed(start)
    numbers, rows, order = {first: 0}, [], [first]
    for subset in order:
        row = [first if anywhere else 0] * len(kinds)
        while subset:
            x = (subset & -subset).bit_length() - 1
            subset &= subset - 1
            row = [a | b for a, b in zip(row, reached[x], strict=True)]
        for to in row:
            if to not in numbers:
                numbers[to] = len(order)
                order.append(to)
        rows.append([numbers[to] for to in row])
    moves = np.array(rows)
    accepts = np.array([sum({1 << k for x, k in ends.items() if s >> x & 1}) for s in order])
    # Partition refinement: states stay together while they accept alike and move to the same parts.
    _, part = np.unique(accepts, return_inverse=True)
    while True:
        named: dict[bytes, int] = {}
        finer = np.array([named.setdefault(row.tobytes(), len(named)) for row in np.column_stack([part, part[moves]])])
        if finer.max() == part.max():
            break
        part = finer
    size = int(part.max()) + 1
    example = np.zeros(size, int)
    example[part] = np.arange(len(part))
    kind = accepts[example]
    rank = np.empty(size, int)
    rank[np.argsort(kind > 0, kind="stable")] = np.arange(size)
    merged, final = np.empty((size, 256), int), np.empty(size, int)
    merged[rank] = rank[part[moves[example]]][:, column]
    final[rank] = kind
    stuck = [s for s in range(size) if final[s] == 0 and (merged[s] == s).all()]
    return Automaton(
        merged.ravel().tolist(), final.tolist(), int(rank[part[0]]), int((final == 0).sum()), stuck[0] if stuck else -1
    )


class Scanner:
    """All rules in one automaton, and for each rule its own: forwards, backwards, and from anywhere on."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        trees = [parsed(r.pattern) for r in rules]
        machine = Machine()
        start = machine.state()
        ends = {built(machine, tree, start): k for k, tree in enumerate(trees)}
        self.all = determined(machine, start, ends, anywhere=True)
        self.own = []
        for tree in trees:
            three = []
            for backwards in (False, True):
                machine = Machine()
                start = machine.state()
                three.append(determined(machine, start, {built(machine, tree, start, backwards): 0}, anywhere=False))
            machine = Machine()
            start = machine.state()
            three.append(determined(machine, start, {built(machine, tree, start): 0}, anywhere=True))
            self.own.append(three)

    @staticmethod
    def furthest(automaton: Automaton, data: bytes, at: int, stop: int, step: int) -> int | None:
        """The last position at which the automaton, run from at, accepts."""
        state, found, moves = automaton.start, None, automaton.table
        while at != stop:
            state = moves[state * 256 + data[at if step > 0 else at - 1]]
            if state == automaton.dead:
                break
            at += step
            if state >= automaton.accepting:
                found = at
        return found

    @staticmethod
    def advanced(automaton: Automaton, data: bytes, alone: list[tuple[int, int] | None], k: int, to: int) -> bool:
        """Run rule k alone from where it stands up to a byte; whether it accepts there."""
        (at, state), moves = alone[k], automaton.table
        for byte in data[at:to]:
            state = moves[state * 256 + byte]
        alone[k] = to, state
        return state >= automaton.accepting

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) of every match, in bytes.

        A rule whose hit proves to have begun inside its match before is run alone, and only onwards, from
        the end of that match until it accepts, so that no byte is read again for every later hit.
        """
        moves, accepting, accepts = self.all.table, self.all.accepting, self.all.accepts
        state, done = self.all.start, [0] * len(self.rules)
        alone: list[tuple[int, int] | None] = [None] * len(self.rules)
        found = []
        for at, byte in enumerate(data, 1):
            state = moves[state * 256 + byte]
            if state >= accepting:
                for k in range(len(done)):
                    if accepts[state] >> k & 1 and at > done[k]:
                        forwards, backwards, anywhere = self.own[k]
                        start = None
                        if alone[k] is None or self.advanced(anywhere, data, alone, k, at):
                            start = self.furthest(backwards, data, at, done[k], -1)
                        if start is None:  # it began inside the match before
                            if alone[k] is None:
                                alone[k] = done[k], anywhere.start
                                self.advanced(anywhere, data, alone, k, at)
                            continue
                        alone[k] = None
                        done[k] = end = self.furthest(forwards, data, start, len(data), 1)
                        rule = self.rules[k]
                        if (value_size(data[start:end]) if rule.assigned else end - start) >= rule.least:
                            found.append((start, end, k))
        return sorted(found, key=lambda x: (x[0], x[2]))


def value_size(match: bytes) -> int:
    """Length of an assigned value: all after the first : or =, spaces and a quote."""
    sign = min(x for x in (match.find(b":"), match.find(b"=")) if x >= 0)
    return len(match[sign + 1 :].lstrip(b" ").lstrip(b"\"'"))


def listed(spans: list[tuple[int, int, int]], kinds: list[str], text: str, data: bytes) -> list[str]:
    """kind:start:end in code points."""
    if len(text) == len(data):
        return [f"{kinds[k]}:{a}:{b}" for a, b, k in spans]
    place = {0: 0}
    last = chars = 0
    for at in sorted({x for a, b, _ in spans for x in (a, b)}):
        chars += len(data[last:at].decode("utf-8", "replace"))
        place[at], last = chars, at
    return [f"{kinds[k]}:{place[a]}:{place[b]}" for a, b, k in spans]


FOUND = "doc_id long, counts array<long>, base array<string>, spans array<string>"


def found_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """doc_id, matches of each rule, and spans as kind:start:end, of the first rules and of all."""
    scanner = Scanner(rules)
    # What is sent depends on the rules only: some thousand states of 256 numbers.
    automata = [scanner.all, *(a for three in scanner.own for a in three)]
    sent = docs.sparkSession.sparkContext.broadcast(
        [(np.array(a.table, np.int32), a.accepts, a.start, a.accepting, a.dead) for a in automata]
    )
    kinds = [r.kind for r in rules]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Scanner.__new__(Scanner)
        own.rules = rules
        own.all, *rest = (Automaton(moves.tolist(), *rest) for moves, *rest in sent.value)
        own.own = list(zip(rest[::3], rest[1::3], rest[2::3], strict=True))
        for batch in batches:
            rows = []
            for text in batch["text"]:
                data = (text or "").encode("utf-8", "replace")
                spans = own.spans(data)
                counts = [0] * len(kinds)
                for _, _, k in spans:
                    counts[k] += 1
                rows.append(
                    (counts, listed([s for s in spans if s[2] < base], kinds, text or "", data), listed(spans, kinds, text or "", data))
                )
            out = pd.DataFrame(rows, columns=["counts", "base", "spans"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(scan, FOUND)


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: counts and spans."""
    found = found_secrets(table(spark, folder, "documents"))
    joined = F.array_join("base", ",")
    return found.select(
        "doc_id",
        *[F.col("counts")[k].alias(f"n_{rule.kind}") for k, rule in enumerate(BASE)],
        F.sha2(joined, 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"),
    )
