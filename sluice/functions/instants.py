"""Reading dates and times in the notations of several languages and systems."""

from __future__ import annotations

import re
from datetime import date
from functools import lru_cache
from typing import NamedTuple

# Names of months, as written in full or shortened to their first letters.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6,
    "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "januar": 1, "jänner": 1, "februar": 2, "märz": 3, "mai": 5, "juni": 6,
    "juli": 7, "oktober": 10, "dezember": 12,
    "janvier": 1, "février": 2, "mars": 3, "avril": 4, "juin": 6, "juillet": 7,
    "août": 8, "septembre": 9, "octobre": 10, "novembre": 11, "décembre": 12,
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6,
    "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
    "mär": 3, "okt": 10, "dez": 12, "janv": 1, "févr": 2, "avr": 4, "juil": 7, "déc": 12,
    "ene": 1, "abr": 4, "ago": 8, "dic": 12,
}

# Minutes east of UTC of zone abbreviations.
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "SGT": 480, "AWST": 480, "JST": 540, "KST": 540,
    "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
    "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "COT": -300, "BRT": -180, "ART": -180,
}


class Reading(NamedTuple):
    """Microseconds on the clock that was read, and what is known of the clock: an offset in seconds, or a zone's name, or neither."""

    micros: int
    offset: int | None
    zone: str | None


_EPOCH = date(1970, 1, 1).toordinal()
_NAME = r"[^\W\d_]+\.?"
_CLOCK = r"(?P<h>\d{1,2})(?::|h)(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d+))?)?"
_HALF = r"(?:\s*(?P<half>[apAP])\.?\s?[mM]\b\.?)?"
_OFFSET = r"(?:(?P<sign>[+\-−])(?P<oh>\d{2})(?::?(?P<om>\d{2}))?(?::?(?P<os>\d{2}))?)"
_ZONE = rf"(?:\s*(?:(?P<abbr>[A-Za-z]{{1,5}})(?![A-Za-z/_]))?\s*{_OFFSET}?\s*(?:\[?(?P<zone>[A-Z][A-Za-z_+\-]+(?:/[A-Za-z0-9_+\-]+)+)\]?)?)?"
_DAYS = rf"(?:{_NAME},?\s+)?"
_SHAPES = [
    re.compile(rf"(?P<y>\d{{4}})[-/.](?P<m>\d{{1,2}})[-/.](?P<d>\d{{1,2}})(?:(?:[Tt]|\s+|,\s*){_CLOCK}{_HALF}{_ZONE})?"),
    re.compile(rf"(?P<y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})(?:[Tt ]?(?P<h>\d{{2}})(?P<mi>\d{{2}})(?:(?P<s>\d{{2}})(?:[.,](?P<f>\d+))?)?{_ZONE})?"),
    re.compile(rf"(?P<p>\d{{1,2}})[-/.](?P<q>\d{{1,2}})[-/.](?P<y>\d{{4}})(?:(?:,\s*|\s+(?:à\s+|um\s+)?){_CLOCK}{_HALF}(?:\s*Uhr)?{_ZONE})?"),
    re.compile(rf"{_DAYS}(?P<d>\d{{1,2}})(?:\.|er|st|nd|rd|th)?[\s\-]+(?:de\s+)?(?P<name>{_NAME})[\s\-]+(?:de\s+)?(?P<y>\d{{4}})(?:(?:,\s*|\s+(?:à\s+|um\s+|a\s+las\s+)?){_CLOCK}{_HALF}(?:\s*Uhr)?{_ZONE})?"),
    re.compile(rf"{_DAYS}(?P<name>{_NAME})\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}})(?:(?:,\s*|\s+(?:at\s+)?){_CLOCK}{_HALF}{_ZONE})?"),
    re.compile(rf"{_NAME}\s+(?P<name>{_NAME})\s+(?P<d>\d{{1,2}})\s+{_CLOCK}(?:\s+(?P<abbr>[A-Z]{{1,5}}))?\s+(?P<y>\d{{4}})"),
]
_HOUR = re.compile(r"^(\d{4}-\d{2}-\d{2}[Tt]\d{2})(?=[Zz]?$|[+\-])")
_SHORT_OFFSET = re.compile(r"((?:UTC|GMT)\s?[+\-])(\d)(?=$|:)")
_COUNT = re.compile(r"(\d{10})(?:[.,](\d+))?|(\d{13})|(\d{16})")


def _possible(year: int, month: int, day: int) -> int | None:
    try:
        return date(year, month, day).toordinal() if year > 1000 else None
    except ValueError:
        return None


@lru_cache(maxsize=50_000)
def read_instant(text: str, day_first: bool = True) -> Reading | None:
    """What a text says, or None if it names no full, possible date after the year 1000.

    `day_first` tells the order of numbers before a year.  Digits beyond microseconds are cut
    off; a missing time of day is midnight.  24:00 and leap seconds are no clock times.
    """
    text = re.sub(r"\s+", " ", text).strip()
    if m := _COUNT.fullmatch(text):
        if m[1]:
            return Reading(int(m[1]) * 1_000_000 + int((m[2] or "0").ljust(6, "0")[:6]), 0, None)
        return Reading(int(m[3]) * 1000 if m[3] else int(m[4]), 0, None)
    for shape in _SHAPES:
        m = shape.fullmatch(text)
        if not m:
            continue
        g = m.groupdict()
        if g.get("name") is not None:
            month = MONTHS.get(g["name"].rstrip(".").lower())
            if month is None:
                continue
            day = int(g["d"])
        elif g.get("p") is not None:
            day, month = (int(g["p"]), int(g["q"])) if day_first else (int(g["q"]), int(g["p"]))
        else:
            day, month = int(g["d"]), int(g["m"])
        days = _possible(int(g["y"]), month, day)
        hour, minute, second = (int(g.get(k) or 0) for k in ("h", "mi", "s"))
        if half := g.get("half"):
            if not 1 <= hour <= 12:
                return None
            hour = hour % 12 + 12 * (half.lower() == "p")
        if days is None or hour > 23 or minute > 59 or second > 59:
            return None
        offset, zone = None, g.get("zone")
        if abbr := g.get("abbr"):
            if abbr.upper() not in ABBREVIATIONS:
                return None
            offset = ABBREVIATIONS[abbr.upper()] * 60
        if g.get("sign"):
            offset = (int(g["oh"]) * 3600 + int(g["om"] or 0) * 60 + int(g["os"] or 0)) * (1 if g["sign"] == "+" else -1)
        fraction = int((g.get("f") or "0").ljust(6, "0")[:6])
        micros = ((days - _EPOCH) * 86400 + hour * 3600 + minute * 60 + second) * 1_000_000 + fraction
        return Reading(micros, offset, None if offset is not None else zone)
    # An hour alone behind a T, and offsets of one digit behind UTC or GMT, written out.
    whole = _SHORT_OFFSET.sub(r"\g<1>0\g<2>", _HOUR.sub(r"\1:00", text))
    return read_instant(whole, day_first) if whole != text else None
