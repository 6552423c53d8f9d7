"""URL filters: many wildcard rules run at once by a bit-parallel Shift-And automaton.

A rule is a glob over the canonical URL `.host|path`, where the bar is a symbol that no URL contains: `*` stands for any
run of characters, `?` for any one. Each pattern character owns one bit; all patterns lie side by side in 64-bit words,
and a step over one URL character is a shift with carry between words, an AND with the character's mask and an OR with
the bits that a `*` keeps alive. All URLs of a batch step together, so the work is (longest URL) array operations.

Nulls and URLs without `://` have an empty host and path and meet no rule. Empty tables give empty results; repeated
rows are judged alike; of rules that fit equally long, the first in the order of their names wins; very long URLs are read
whole, in time in proportion to the longest of a batch. Other columns pass through, but for those that bear the name of a
column of the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import lean, without

#: Stands between host and path; outside of Unicode, so that no URL contains it.
BAR = 0x110000
#: URLs handled together; memory is this times (words of state + longest URL) at most, longest first.
LOT = 4096


@dataclass(frozen=True)
class Rule:
    """A rule fits `host` and its subdomains where the path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Site rules of the query's contract.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
#: Globs, over host and path, of URLs to block where no site rule fits.
BLOCKED = (
    "*.*spam*|*", "*.*pills*|*", "*.*casino*|*", "*.*poker*|*", "*.*betting*|*", "*.*viagra*|*", "*.*porn*|*",
    "*.*xxx*|*", "*.*malware*|*", "*.*phish*|*", "*.*warez*|*", "*.*torrent*|*", "*.*adult*|*", "*.*escort*|*",
    "*|*/wp-login*", "*|*/cgi-bin/*", "*|*.exe", "*|*.apk",
)


def rule_glob(rule: Rule) -> str:
    """The glob of a site rule: any subdomain, then the host, the bar, the path and anything; its own signs stand for themselves."""
    host, path = (re.sub(r"([*?|\\])", r"\\\1", x) for x in (rule.host, rule.path))
    return f"*.{host}|{path}*"


class Automaton:
    """Globs compiled into masks; `match` tells for each text which globs it meets as a whole. A sign after a backslash
    stands for itself."""

    def __init__(self, globs: list[str]):
        symbols: list[tuple[int, int]] = []  # of each bit: the code point that it needs (-1: any), its glob
        loops: list[int] = []  # bits that stay alive over any character
        self.starts: list[int] = []  # bits that may follow the empty text
        self.ends: list[int] = []  # of each glob: the bit that is set once it is met
        open_at: list[int] = []  # globs met by nothing or by any text so far
        for g, glob in enumerate(globs):
            first = True
            for c in re.findall(r"\\.|.", glob, re.S):
                if c == "*":
                    (open_at if first else loops).append(g if first else len(symbols) - 1)
                    continue
                if first:
                    self.starts.append(len(symbols))
                symbols.append((-1 if c == "?" else BAR if c == "|" else ord(c[-1]), g))
                first = False
            self.ends.append(-1 if first else len(symbols) - 1)
        self.open = set(open_at)
        self.words = max(1, -(-len(symbols) // 64))
        known = sorted({s for s, _ in symbols if s >= 0})
        self.known = np.array(known, dtype=np.int64)
        # one mask for each known symbol, and one for all others
        self.masks = np.zeros((len(known) + 1, self.words), dtype=np.uint64)
        for bit, (s, _) in enumerate(symbols):
            rows = range(len(known) + 1) if s < 0 else [known.index(s)]
            for r in rows:
                self.masks[r, bit // 64] |= np.uint64(1 << (bit % 64))
        self.stay = self._bits(loops)
        self.first_once = self._bits(self.starts)
        self.first_ever = self._bits([b for b in self.starts if symbols[b][1] in self.open])

    def _bits(self, at: list[int]) -> np.ndarray:
        out = np.zeros(self.words, dtype=np.uint64)
        for bit in at:
            out[bit // 64] |= np.uint64(1 << (bit % 64))
        return out

    def match(self, codes: list[np.ndarray]) -> np.ndarray:
        """A boolean for each text (an array of code points) and glob."""
        n = len(codes)
        lengths = np.array([len(c) for c in codes], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        state = np.zeros((n, self.words), dtype=np.uint64)
        flat = np.concatenate([codes[i] for i in order]) if n else np.zeros(0, dtype=np.int64)
        symbol = np.minimum(np.searchsorted(self.known, flat), max(0, len(self.known) - 1))
        symbol = np.where(self.known[symbol] == flat, symbol, len(self.known)) if len(self.known) else flat * 0
        at = np.concatenate([[0], np.cumsum(lengths[order])[:-1]]) if n else np.zeros(0, dtype=np.int64)
        rows = lengths[order]
        one, top = np.uint64(1), np.uint64(63)
        starts = np.zeros(self.words, dtype=np.uint64)
        # no carry crosses from one glob's last bit into the next glob's first bit
        inner = ~self.first_once
        for j in range(int(rows[0]) if n else 0):
            live = int(np.searchsorted(-rows, -j, side="left"))  # texts longer than j come first
            d = state[:live]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            starts[:] = self.first_once if j == 0 else self.first_ever
            state[:live] = (((moved & inner) | starts) & self.masks[symbol[at[:live] + j]]) | (d & self.stay)
        met = np.zeros((n, len(self.ends)), dtype=bool)
        for g, bit in enumerate(self.ends):
            if bit < 0:  # only stars, or the empty glob
                met[order, g] = True if g in self.open else rows == 0
            else:
                met[order, g] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one == one
        return met


def canonical(host: str, path: str) -> np.ndarray:
    """Code points of `.host|path`."""
    left, right = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64) for x in ("." + host, path))
    return np.concatenate([left, [BAR], right])


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, blocked: tuple[str, ...] = BLOCKED) -> DataFrame:
    """`pages` with host, path, rule (the longest site rule that fits, or null), globs (blocking globs met) and verdict.

    The verdict is the rule's; without one it is block where a blocking glob is met, else allow.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name))
    globs = [rule_glob(r) for r in ranked] + list(blocked)
    automaton = Automaton(globs)

    @F.pandas_udf("struct<rule:string, verdict:string, globs:array<string>>")
    def verdicts(lots: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in lots:
            out = []
            for i in range(0, len(hosts), LOT):
                pairs = zip(hosts.iloc[i : i + LOT], paths.iloc[i : i + LOT], strict=True)
                for row in automaton.match([canonical(h, p) for h, p in pairs]):
                    fits = np.flatnonzero(row[: len(ranked)])
                    met = [blocked[k] for k in np.flatnonzero(row[len(ranked) :])]
                    rule = ranked[fits[0]] if len(fits) else None
                    out.append((rule.name if rule else None, rule.verdict if rule else "block" if met else "allow", met))
            yield pd.DataFrame(out, columns=["rule", "verdict", "globs"])

    pages = without(lean(pages), "host", "path", "rule", "verdict", "globs", "_v")
    found = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return found.withColumn("_v", verdicts("host", "path")).select(
        *found.columns, "_v.rule", "_v.verdict", "_v.globs"
    )
