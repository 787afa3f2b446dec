"""Mapping freely typed place names to the entries of a clean list.

A multi-pattern automaton holds the names and their aliases, with word ends.
It finds the mentions in a typed value; of those, the longest that don't
overlap win. If what is left over only frames a name (``City of``, a state, the
place's own county), the mention decides. Other values go to
token-set similarity: their tokens, spelled out, are held against each entry's
tokens in any order, allowing for a few wrong, missing, doubled or swapped letters, and so are
the tokens run together, for words joined or split. What is similar to no entry
denotes the one mentioned in it after all, unless a word left over makes another
name of it, as Heights does of Convey. Each distinct value is worked out once in a worker.

Defined results: null and blank values have no result; values that name nothing
listed, or several entries equally well, get ``NONE``; the list is checked
against ``MOST_ENTRIES`` before it is sent to the workers; an empty list maps
everything to ``NONE``; entries repeated in the list count once.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaploom.functions.scalars import blank

NONE = "(none)"
MOST_ENTRIES = 100_000
MOST_REMEMBERED = 500_000
# fixed values: how words of place names are shortened
SHORT = {
    "NORTH": ("N", "NO", "NTH"), "SOUTH": ("S", "SO", "STH"), "EAST": ("E",), "WEST": ("W",), "SAINT": ("ST",), "MOUNT": ("MT",), "FORT": ("FT",), "LAKE": ("LK",), "PORT": ("PT", "PRT"),
    "HEIGHTS": ("HTS", "HGTS"), "MEADOWS": ("MDWS", "MDW"), "VALLEY": ("VLY", "VLLY"), "HARBOR": ("HBR",), "GROVE": ("GRV",), "SPRINGS": ("SPGS", "SPG", "SPRS"), "TERRACE": ("TER", "TERR"),
    "BLUFFS": ("BLFS", "BLF"), "CROSSING": ("XING", "CRSG"), "LANDING": ("LNDG", "LDG"), "ORCHARD": ("ORCH",), "HOLLOW": ("HLW",), "JUNCTION": ("JCT",), "SUMMIT": ("SMT",),
    "COUNTY": ("CO", "CNTY", "CTY"),
}
# fixed values: words around a name that say nothing about which place it is, and words that mean a county's own territory
FRAME = ("CITY", "TOWN", "OF", "THE", "CA", "CALIFORNIA")
TERRITORY = ("UNINCORPORATED", "UNINCORP", "UNINC", "AREA", "AREAS")
# fixed values: further words that make a longer name of another place
NAMING = ("NEW", "OLD", "UPPER", "LOWER", "EL", "LA", "LOS", "LAS", "SAN", "SANTA", "VILLAGE", "HILL", "HILLS", "BEACH", "PARK", "CREEK", "RIVER", "ISLAND", "BAY", "CANYON", "RANCH", "ESTATES", "GARDENS", "LAKES", "OAKS", "MESA", "POINT", "RIDGE", "VISTA", "TOWNSHIP", "CORNERS", "FALLS", "HOT")
LONG = {s: w for w, shorts in SHORT.items() for s in shorts}


# fixed values: digits read in place of letters
MISREAD = str.maketrans("01", "OI")


def fold(text: str) -> list[str]:
    """Tokens in capitals without accents; digits among letters are the letters they look like."""
    plain = text if text.isascii() else "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return [t if t.isdigit() else t.translate(MISREAD) for t in re.findall(r"[A-Z0-9]+", plain.upper())]


def edits(a: str, b: str, most: int) -> int:
    """Letters wrong, missing, added or swapped with a neighbour between ``a`` and ``b``; ``most + 1`` if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and y == a[i - 2]:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def allowed(length: int) -> int:
    """Edits that a name of so many letters may have."""
    return 1 if length <= 5 else 2


@dataclass(frozen=True)
class Entry:
    key: str
    display: str
    county: str
    unincorporated: bool


class Matcher:
    def __init__(self, entries: list[Entry]):
        self.entries = {e.key: e for e in entries}
        #: the tokens of each entry's name; a county's end with COUNTY
        self.tokens = {e.key: tuple(fold(e.key)) for e in self.entries.values()}
        self.counties = {e.key: tuple(fold(e.county or "")) for e in self.entries.values()}
        self.exact = {t: e.key for e in self.entries.values() for t in (e.display, e.key)}
        self.automaton = ahocorasick.Automaton()
        aliases: dict[str, set[str]] = defaultdict(set)
        for key, tokens in self.tokens.items():
            for alias in self._aliases(tokens):
                aliases[alias].add(key)
        for alias, keys in aliases.items():
            if len(keys) == 1:
                self.automaton.add_word(f" {alias} ", (len(alias) + 2, next(iter(keys))))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.near: dict[str, set[tuple[str, str]]] = defaultdict(set)
        for key, tokens in self.tokens.items():
            # shorter endings than three letters would come too near to the name without any
            ends = [tokens[-1], *(e for e in SHORT.get(tokens[-1], ()) if len(e) > 2)] if len(tokens) > 1 else tokens[-1:]
            for whole in {"".join((*tokens[:-1], end)) for end in ends}:
                for cut in _shortened(whole, 2):
                    self.near[cut].add((whole, key))
        #: the entries of each word, and the words that a mistyped one may be
        self.having: dict[str, set[str]] = defaultdict(set)
        self.words: dict[str, set[str]] = defaultdict(set)
        for key, tokens in self.tokens.items():
            for t in tokens:
                self.having[t].add(key)
        for t in self.having:
            for cut in _shortened(t, allowed(len(t))):
                self.words[cut].add(t)
        self.longest = max((len("".join(t)) for t in self.tokens.values()), default=0)
        #: words that belong to names of places: general ones and those of several entries
        self.naming = {*SHORT, *NAMING, *(t for t, keys in self.having.items() if len(keys) > 2)}
        self.known: dict[str, str] = {}

    def _aliases(self, tokens: tuple[str, ...]) -> set[str]:
        spelled = [" ".join(c) for c in itertools.product(*[(t, *SHORT.get(t, ())) if len(tokens) > 1 else (t,) for t in tokens])]
        found = {s for s in spelled} | {s.replace(" ", "") for s in spelled if len(s) > 4}
        if tokens[-1:] == ("COUNTY",):
            found |= {f"COUNTY OF {' '.join(tokens[:-1])}"}
        return found

    def _mentions(self, tokens: list[str]) -> tuple[list[str], list[str]]:
        """Keys of the longest mentions that don't overlap, and the tokens outside them."""
        line = f" {' '.join(tokens)} "
        hits = sorted(((end - n + 1, end, key) for end, (n, key) in self.automaton.iter(line)), key=lambda h: (h[0] - h[1], h[0])) if len(self.automaton) else []
        taken: list[tuple[int, int, str]] = []
        for a, b, key in hits:
            if all(b <= x or a >= y for x, y, _ in taken):  # neighbours may share the space between them
                taken.append((a, b, key))
        rest, at = [], 0
        for a, b, _ in sorted(taken):
            rest += line[at:a].split()
            at = b
        return [key for _, _, key in sorted(taken)], rest + line[at:].split()

    def resolve(self, text: str) -> str:
        if text in self.exact:
            return self.exact[text]
        if text not in self.known:
            if len(self.known) >= MOST_REMEMBERED:
                self.known.clear()
            self.known[text] = self._resolve(text)
        return self.known[text]

    def _resolve(self, text: str) -> str:
        tokens = fold(text)
        found, rest = self._mentions(tokens)
        framed = all(t in FRAME or t in TERRITORY for t in rest)
        if found and framed:
            return self._mentioned(found, rest)
        similar = self._similar(tokens)
        if similar != NONE or not found or any(self._names(t) for t in rest):
            return similar
        # a county set off from other words says where a place is that isn't listed
        set_off = all(self.entries[k].unincorporated for k in found) and re.search(r"\w\W*[,(;/]", text)
        return NONE if set_off else self._mentioned(found, rest)

    def _mentioned(self, found: list[str], rest: list[str]) -> str:
        if len(set(found)) == 1:
            return self._territory(found[0], rest)
        # a city followed by its county
        cities = [k for k in found if not self.entries[k].unincorporated]
        others = [k for k in found if self.entries[k].unincorporated]
        if len(set(cities)) == 1 and all(self.counties[cities[0]] == self.counties[k] for k in others):
            return cities[0]
        return NONE

    def _names(self, token: str) -> bool:
        """Whether a word beside a mention makes it part of another name."""
        word = LONG.get(token, token)
        return word in self.naming or (4 < len(word) <= self.longest + 1 and any(_is(word, w, 1) for w in self.naming if len(w) > 4))

    def _territory(self, key: str, rest: list[str]) -> str:
        """A city's name marked as unincorporated territory means the county of that name."""
        if not self.entries[key].unincorporated and any(t in TERRITORY for t in rest):
            return f"{key} COUNTY" if f"{key} COUNTY" in self.entries else NONE
        return key

    def _similar(self, tokens: list[str]) -> str:
        """The entry whose token set is most similar, if it is similar enough and no other is as similar."""
        spelled = [LONG.get(t, t) for t in tokens]
        kept = [t for t in spelled if t not in FRAME and t not in TERRITORY]
        if not kept:
            return NONE
        county = any(_is(t, "COUNTY", 1) for t in kept) or any(t in TERRITORY for t in spelled)
        best = self._by_tokens(["COUNTY" if _is(t, "COUNTY", 1) else t for t in kept] + ["COUNTY"] * (county and not any(_is(t, "COUNTY", 1) for t in kept)))
        for core in self._cores(spelled, kept, county):
            whole = "".join(core)
            if len(whole) > self.longest + 2:
                continue
            most = allowed(len(whole))
            close = set().union(*(self.near.get(cut, ()) for cut in _shortened(whole, most)))
            for name, key in close:
                d = edits(whole, name, most)
                if d <= most:
                    best[key] = min(d, best.get(key, 9))
        agreed = {k: d for k, d in best.items() if self._tokens_agree(kept, k)}
        if not agreed:
            return NONE
        least = min(agreed.values())
        winners = [k for k, d in agreed.items() if d == least]
        return winners[0] if len(winners) == 1 else NONE

    def _by_tokens(self, kept: list[str]) -> dict[str, int]:
        """Edits of the entries all of whose tokens are among the value's, whatever their order.

        What is left of the value may only be the entry's county, or words that name no place beside an entry of several words.
        """
        close: dict[str, dict[int, int]] = defaultdict(dict)
        for i, t in enumerate(kept):
            if len(t) <= self.longest + 2:
                for w in set().union(*(self.words.get(cut, ()) for cut in ({t} if t in SHORT or t in LONG else _shortened(t, allowed(len(t)))))):
                    d = edits(t, w, allowed(len(w)))
                    if d <= allowed(len(w)):
                        close[w][i] = d
        found: dict[str, int] = {}
        for key in set().union(*(self.having[w] for w in close)):
            used: dict[int, int] = {}
            for w in sorted(self.tokens[key], key=lambda w: (len(close.get(w, ())), w)):
                free = [(d, i) for i, d in close.get(w, {}).items() if i not in used]
                if not free:
                    break
                d, i = min(free)
                used[i] = d
            else:
                rest = [t for i, t in enumerate(kept) if i not in used]
                own_county = bool(rest) and set(rest) == {*self.counties[key], "COUNTY"}
                beside = len(used) > 1 and not self.entries[key].unincorporated and not any(self._names(t) for t in rest)
                if sum(used.values()) <= 2 and (not rest or own_county or beside):
                    found[key] = sum(used.values())
        return found

    def _cores(self, spelled: list[str], kept: list[str], county: bool) -> list[list[str]]:
        """What may be the name among the tokens: with and without its frame and its county."""
        cores = [kept]
        if county:
            stem = [t for t in kept if not _is(t, "COUNTY", 1)]
            cores.append([*stem, "COUNTY"])
            for n in (1, 2):  # a city followed by its county
                if len(stem) > n:
                    cores.append(stem[:-n])
        # a frame written wrongly, such as CTIY OF
        if not county and len(spelled) > 2 and spelled[1] == "OF":
            cores.append([t for t in spelled[2:] if t not in FRAME])
        elif not county and len(spelled) > 3 and spelled[2] == "OF" and spelled[0] == "THE":
            cores.append([t for t in spelled[3:] if t not in FRAME])
        return [c for c in cores if c]

    def _tokens_agree(self, kept: list[str], key: str) -> bool:
        """No whole token of the value may contradict the entry: a known word has to be one of the entry's own."""
        own = set(self.tokens[key]) | set(self.counties[key])
        return all(t in own or not any(t == w for w in SHORT) or t == "COUNTY" for t in kept)


def _is(token: str, word: str, most: int) -> bool:
    return token == word or (len(token) > 4 and edits(token, word, most) <= most)


def _shortened(text: str, most: int) -> set[str]:
    """``text`` with up to ``most`` letters taken out: texts within so many edits share one of these."""
    level, found = {text}, {text}
    for _ in range(most):
        level = {t[:i] + t[i + 1 :] for t in level for i in range(len(t))}
        found |= level
    return found


def entries_of(listed: DataFrame, most: int = MOST_ENTRIES) -> list[Entry]:
    rows = listed.select("juris_key", "juris_display", "county", "unincorporated").where("juris_key is not null").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the list has over {most} entries")
    return sorted((Entry(r[0], r[1] or r[0], r[2] or "", bool(r[3])) for r in rows), key=lambda e: e.key)


@lru_cache(2)
def matcher_of(entries: tuple[Entry, ...]) -> Matcher:
    return Matcher(list(entries))


def resolver(listed: DataFrame):
    """A function of columns that maps typed values to keys of ``listed``."""
    shared = listed.sparkSession.sparkContext.broadcast(tuple(entries_of(listed)))

    @F.pandas_udf(T.StringType())
    def resolve(typed: pd.Series) -> pd.Series:
        m = matcher_of(shared.value)
        return pd.Series([m.resolve(t) if t is not None and t.strip() else None for t in typed.tolist()], dtype=object)

    return resolve


def typed_values(rows: DataFrame, listed: DataFrame, value: str = "jurisdiction", key: str = "source_index") -> DataFrame:
    """(source_index, juris_key) of each row whose value is neither blank nor written as in the list."""
    names = listed.select(F.explode(F.array("juris_key", "juris_display")).alias("name")).where("name is not null").distinct()
    typed: Column = F.col("typed")
    odd = rows.select(F.col(key).alias("key"), F.col(value).alias("typed")).where(~blank(typed)).join(names, typed == F.col("name"), "left_anti")
    return odd.select(F.col("key").alias(key), resolver(listed)(typed).alias("juris_key"))
