"""URL filters by a bit-parallel wildcard automaton.

All rules run at once over each canonical URL, a dot, the host, `#` and the path, in UTF-8. A rule is a
host and the beginning of a path: it fits its host and all subdomains, so it is the glob `*.host#path*`.
In host and path `*` stands for any run of characters and `?` for one; a path that ends with `$` has to end there.
As the canonical URL has one `#` and so has each glob, no wildcard reaches from the host into the path.

Each character of a glob is a bit of a Shift-And mask, a start bit goes before it, and the bits of all
rules lie side by side in as many 64-bit words as they need. A step shifts all words by one, carries from
word to word, and keeps the bits that accept the byte just read; bits with a wildcard behind them also stay
as they are. Steps are taken for all URLs of a batch together, longest first, so that the ones that have
ended fall away from the end. Batches are cut so that the states of one have at most STATE words.

Of the rules that fit, the first counts in the order: rules before guesses (`guess`), longer before shorter (code
points of host and path), longer host before shorter, block before allow, by text. If none fits the verdict is DEFAULT.

Host and path are as written but for A-Z in the host, which are lower-cased: ports and user names are
part of the host, and nothing is decoded.

Cases: a null URL and one without `://` have an empty host and path and get DEFAULT, unless a rule is for any
host and any path. Repeated rows are judged alike, an empty table gives no rows, very long URLs are read
whole. Other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm.tables import table

ALLOW, BLOCK = "allow", "block"
DEFAULT = ALLOW
#: Words of state that a batch of URLs may have, 32 MB.
STATE = 1 << 22


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str
    #: Guesses decide only where no other rule fits, and are not shown as a URL's rule.
    guess: bool = False

    def __post_init__(self) -> None:
        if set("/#") & set(self.host) or "#" in self.path:
            raise ValueError(f"not a host and a path: {self}")
        if self.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"not a verdict: {self}")

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the crawl.
RULES = (
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("com", "/fr/", ALLOW),
    Rule("com", "/de/", BLOCK),
)
#: What pages that no rule speaks of are judged by: names of spam hosts and advert servers, logins, and files that are no pages.
GUESSES = tuple(
    Rule(host, path, BLOCK, guess=True)
    for host, path in (
        ("spam-*", ""),
        ("ads.*", ""),
        ("*", "/*.zip$"),
        ("*", "/*.exe$"),
        ("*", "/*/wp-login.php"),
        ("*", "/wp-login.php"),
    )
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path of a URL; both empty without `://`."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def in_order(rules: tuple[Rule, ...]) -> list[Rule]:
    return sorted(set(rules), key=lambda r: (r.guess, -len(r.text), -len(r.host), r.verdict != BLOCK, r.text))


class Automaton:
    """Masks of all rules: which bits each byte lets in, and which it leaves as they are."""

    def __init__(self, rules: list[Rule]):
        size = sum(len(self.glob(r).encode()) + 1 for r in rules)
        self.words = max(1, -(-size // 64))
        self.enter, self.stay = (np.zeros((256, self.words), np.uint64) for _ in range(2))
        self.start = np.zeros(self.words, np.uint64)
        self.accept: list[tuple[int, np.uint64]] = []
        free = 0
        for rule in rules:
            word, bit = self._bit(free)
            self.start[word] |= bit
            for token in self.glob(rule):
                if token == "*":
                    self.stay[:, word] |= bit
                    continue
                for byte in [None] if token == "?" else token.encode():
                    free += 1
                    word, bit = self._bit(free)
                    if byte is None:  # any character: its first byte enters, further ones stay
                        self.enter[:0x80, word] |= bit
                        self.enter[0xC0:, word] |= bit
                        self.stay[0x80:0xC0, word] |= bit
                    else:
                        self.enter[byte, word] |= bit
            self.accept.append((word, bit))
            free += 1

    @staticmethod
    def _bit(place: int) -> tuple[int, np.uint64]:
        return place >> 6, np.uint64(1 << (place & 63))

    @staticmethod
    def glob(rule: Rule) -> str:
        path = rule.path[:-1] if rule.path.endswith("$") else rule.path + "*"
        return f"*.{rule.host}#{path}"

    def first_fits(self, urls: list[bytes]) -> np.ndarray:
        """For each URL the first rule that fits, or -1."""
        found = np.full(len(urls), -1, np.int64)
        step = max(1, STATE // self.words)
        for low in range(0, len(urls), step):
            found[low : low + step] = self._fits(urls[low : low + step])
        return found

    def _fits(self, urls: list[bytes]) -> np.ndarray:
        sizes = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-sizes, kind="stable")
        data = np.frombuffer(b"".join(urls) or b"\0", np.uint8)
        begins = (np.cumsum(sizes) - sizes)[order]
        running = len(urls) - np.cumsum(np.bincount(sizes))  # URLs longer than 0, 1, 2 ... bytes
        state = np.tile(self.start, (len(urls), 1))
        one, top = np.uint64(1), np.uint64(63)
        for at, n in enumerate(running[:-1]):
            byte, now = data[begins[:n] + at], state[:n]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            moved &= self.enter[byte]
            now &= self.stay[byte]
            now |= moved
        first = np.full(len(urls), -1, np.int64)
        for rule, (word, bit) in reversed(list(enumerate(self.accept))):
            first[(state[:, word] & bit) != 0] = rule
        out = np.empty_like(first)
        out[order] = first
        return out


def _judge(rules: list[Rule]):
    # The last row is for URLs that no rule fits, which have number -1.
    decisions = pa.table(
        {
            "rule": pa.array([*[None if r.guess else r.text for r in rules], None], pa.string()),
            "verdict": pa.array([*[r.verdict for r in rules], DEFAULT], pa.string()),
            "pattern": pa.array([*[r.text for r in rules], None], pa.string()),
        }
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(rules)
        for batch in batches:
            urls = batch.column("canonical").to_pylist()
            chosen = decisions.take(pa.array(automaton.first_fits(urls) % decisions.num_rows)).combine_chunks()
            kept = {name: batch.column(name) for name in ("page_id", "host", "path")}
            yield pa.RecordBatch.from_pydict(kept | {name: chosen.column(name).combine_chunks() for name in chosen.column_names})

    return judge


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES + GUESSES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, and the pattern that decided, be it a rule or a guess."""
    host, path = host_and_path(F.col(url_column))
    urls = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    canonical = F.concat(F.lit("."), "host", F.lit("#"), "path").cast("binary")
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in urls.schema]
    return urls.withColumn("canonical", canonical).mapInArrow(
        _judge(in_order(rules)), ", ".join([*kept, "rule string", "verdict string", "pattern string"])
    )


def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's URL, judged."""
    return judged(table(spark, folder, "pages"))


#: The same without an automaton; guesses as regular expressions.
SQL = r"""
    WITH rests AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), hosts AS (
        SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS written FROM rests
    ), parts AS (
        SELECT page_id,
               translate(written, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(substr(rest, length(written) + 1), '^[^?#]*') AS path
        FROM hosts
    ), fits AS (
        SELECT page_id, host, path,
               CASE
                   WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                   WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                   WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
                   WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                   WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/'
               END AS rule,
               CASE
                   WHEN regexp_matches(path, '(?s)^/.*/wp-login[.]php') THEN '*/*/wp-login.php'
                   WHEN starts_with(path, '/wp-login.php') THEN '*/wp-login.php'
                   WHEN regexp_matches(path, '(?s)^/.*[.]exe$') THEN '*/*.exe$'
                   WHEN regexp_matches(path, '(?s)^/.*[.]zip$') THEN '*/*.zip$'
                   WHEN strpos('.' || host, '.spam-') > 0 THEN 'spam-*'
                   WHEN strpos('.' || host, '.ads.') > 0 THEN 'ads.*'
               END AS guess
        FROM parts
    )
    SELECT page_id, host, path, rule,
           CASE
               WHEN rule IN ('com/de/', 'example.org/en/1', 'example.org/es/') OR (rule IS NULL AND guess IS NOT NULL) THEN 'block'
               ELSE 'allow'
           END AS verdict,
           coalesce(rule, guess) AS pattern
    FROM fits
"""
