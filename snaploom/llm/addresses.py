"""Reading postal addresses: house number, direction, street, type and unit.

Parts may come in any usual order: the number first or last, the unit first or
last, the direction before or after the street. A trailing jurisdiction and
state are dropped. What isn't there is null.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

# fixed values: how the parts of an address are written
DIRECTIONS = {"N": "N", "NO": "N", "NORTH": "N", "S": "S", "SO": "S", "SOUTH": "S", "E": "E", "EAST": "E", "W": "W", "WEST": "W", "NE": "NE", "NW": "NW", "SE": "SE", "SW": "SW"}
TYPES = {
    "ST": "ST", "STR": "ST", "STREET": "ST", "AV": "AVE", "AVE": "AVE", "AVEN": "AVE", "AVENUE": "AVE", "BL": "BLVD", "BLV": "BLVD", "BLVD": "BLVD", "BOULEVARD": "BLVD",
    "RD": "RD", "ROAD": "RD", "DR": "DR", "DRV": "DR", "DRIVE": "DR", "LN": "LN", "LANE": "LN", "CT": "CT", "CRT": "CT", "COURT": "CT", "CI": "CIR", "CIR": "CIR", "CIRC": "CIR", "CIRCLE": "CIR",
    "PL": "PL", "PLACE": "PL", "WAY": "WAY", "WY": "WAY", "PKY": "PKWY", "PKWY": "PKWY", "PARKWAY": "PKWY", "TER": "TER", "TERR": "TER", "TERRACE": "TER", "HWY": "HWY", "HIGHWAY": "HWY",
    "ALY": "ALY", "ALLEY": "ALY", "TRL": "TRL", "TRAIL": "TRL", "SQ": "SQ", "SQUARE": "SQ", "LOOP": "LOOP",
}
UNITS = {
    "UNIT": "UNIT", "APT": "UNIT", "APARTMENT": "UNIT", "#": "UNIT", "STE": "UNIT", "SUITE": "UNIT", "RM": "UNIT", "ROOM": "UNIT", "NUM": "UNIT",
    "BLDG": "BLDG", "BLD": "BLDG", "BUILDING": "BLDG", "LOT": "LOT", "SPC": "SPC", "SPACE": "SPC", "FL": "FL", "FLOOR": "FL",
}
STAND_INS = {"", "TBD", "TBA", "NA", "N A", "NONE", "NULL", "NAN", "UNKNOWN", "UNASSIGNED", "VARIOUS", "PENDING", "NOT AVAILABLE", "NO ADDRESS", "SEE NOTES", "MULTIPLE", "NOT PROVIDED", "TO BE DETERMINED", "0"}
STATES = {"CA", "CALIFORNIA"}
MARK = re.compile(r"(?<![A-Z0-9])(UNIT|APARTMENT|APT|SUITE|STE|BUILDING|BLDG|LOT|SPACE|SPC|ROOM|RM)(?![A-Z])[\s.:#-]*#?\s*([A-Z0-9]+)(?![A-Z0-9])|#\s*([A-Z0-9]+)(?![A-Z0-9])")


TOKENS = re.compile(r"[A-Z0-9]+")
SIGNIFICANT = re.compile(r"[1-9]")
WORDS = re.compile("UNIT|AP[AT]|SUITE|STE|B[UL][ID]|LOT|SP[AC]|RO?O?M")


class Address(NamedTuple):
    house: str | None
    direction: str | None
    street: str
    kind: str | None
    unit: str | None


def plain(text: str) -> str:
    if text.isascii():
        return text.upper()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).upper()


@lru_cache(200_000)
def place_tokens(place: str) -> tuple[str, ...]:
    return tuple(re.findall(r"[A-Z0-9]+", plain(re.sub(r"\(.*?\)", " ", place))))


def parse(text: str | None, place: str | None = None) -> Address | None:
    """The parts of an address; none for blanks, stand-ins, and texts without a street."""
    if not text:
        return None
    up = plain(text)
    # no stand-in has a digit but zero
    if not SIGNIFICANT.search(up) and " ".join(TOKENS.findall(up)) in STAND_INS:
        return None
    unit = None
    found = MARK.search(up) if "#" in up or WORDS.search(up) else None
    if found:
        value = (found[2] or found[3]).lstrip("0") or "0"
        kind = UNITS[found[1] or "#"]
        unit = value if kind == "UNIT" else f"{kind} {value}"
        up = f"{up[: found.start()]} , {up[found.end() :]}"
    tokens = TOKENS.findall(up.replace("'", ""))
    while tokens and tokens[-1] in STATES:
        tokens.pop()
    if place:
        own = place_tokens(place)
        n = len(own)
        if n and len(tokens) > n and tuple(tokens[-n:]) == own:
            del tokens[-n:]
        elif n > 1 and own[-1] == "COUNTY" and len(tokens) > n - 1 and tuple(tokens[-n + 1 :]) == own[:-1]:
            del tokens[-n + 1 :]
    house = None
    for at in (0, len(tokens) - 1):
        if tokens and tokens[at][0].isdigit():
            house = tokens.pop(at).lstrip("0") or "0"
            break
    if house is None:
        for at, t in enumerate(tokens):
            if t.isdigit():
                house = tokens.pop(at).lstrip("0") or "0"
                break
    kind = direction = None
    for at in (-1, 0):
        if len(tokens) > 1 and direction is None and tokens[at] in DIRECTIONS:
            direction = DIRECTIONS[tokens.pop(at)]
    if len(tokens) > 1 and tokens[-1] in TYPES:
        kind = TYPES[tokens.pop()]
    for at in (-1, 0):
        if len(tokens) > 1 and direction is None and tokens[at] in DIRECTIONS:
            direction = DIRECTIONS[tokens.pop(at)]
    street = "".join(tokens)
    return Address(house, direction, street, kind, unit) if street else None


def parcel(text: str | None) -> str | None:
    """A parcel number in comparable form: its digits and letters without separators or zeros before a part."""
    if not text:
        return None
    up = plain(text)
    parts = re.findall(r"[A-Z]+|[0-9]+", up.removeprefix("APN"))
    whole = "".join(parts)
    if not any(c.isdigit() for c in whole) or not whole.strip("0") or " ".join(parts) in STAND_INS:
        return None
    if len(parts) == 1 and len(whole) == 9:  # written without separators
        parts = [whole[:3], whole[3:6], whole[6:]]
    return "|".join(p.lstrip("0") or "0" for p in parts)
