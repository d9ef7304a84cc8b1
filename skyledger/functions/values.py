"""Column functions shared by the operators."""

from __future__ import annotations

import json
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

USABLE = ["valid", "trace"]
UNAVAILABLE = ["missing", "qc_failed", "out_of_bounds", "inconsistent", "unparseable"]
QUARANTINED = ["qc_failed", "out_of_bounds", "inconsistent", "unparseable"]
#: The eight compass points from north clockwise.
POINTS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
#: Quality flags of the published format.
QUALITY_FLAGS = {
    "D": "duplicate", "G": "gap", "I": "internal consistency", "K": "streak/frequent value", "L": "multiday period length",
    "M": "megaconsistency", "N": "naught", "O": "climatological outlier", "R": "lagged range", "S": "spatial consistency",
    "T": "temporal consistency", "W": "too warm for snow", "X": "bounds", "Z": "Datzilla investigation",
}


def obs_day(text: Column) -> Column:
    """The day of eight digits; anything else is null."""
    return F.when(text.rlike("^[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd"))


def flags(prefix: str = "") -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(f"{prefix}{c}"), F.lit("")) for c in ("mflag", "qflag", "sflag", "obs_time")])


def row_hash(prefix: str = "") -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(F.col(f"{prefix}value"), F.lit("")), flags(prefix)))


def compass(degrees: Column) -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in POINTS]), F.pmod(F.round(degrees / 45).cast("int"), F.lit(8)) + 1)


def short(number: Column) -> Column:
    """A number as text without a trailing zero fraction."""
    return F.regexp_replace(number.cast("string"), r"\.0$", "")


def flag_text(flag: Column) -> Column:
    names = F.create_map(*[F.lit(x) for item in QUALITY_FLAGS.items() for x in item])
    return F.coalesce(F.try_element_at(names, flag), F.lit("unknown flag"))


def km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, to a tenth of a kilometre."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.round(6371 * 2 * F.asin(F.sqrt(a)), 1)


def _bare_letters() -> tuple[str, str]:
    """Every accented Latin or phonetic letter whose compatibility form is one ASCII letter and marks, and that letter."""
    pairs = []
    for code in (*range(0xAA, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)):
        plain_form = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if ord(c) < 128)
        if len(plain_form) == 1:
            pairs.append((chr(code), plain_form))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


@cache
def _spelled_out() -> str:
    """As JSON: every other character that has ASCII in its compatibility form, such as ligatures and fractions, and that part of the form."""
    single, _ = _bare_letters()
    forms = {}
    for code in (*range(0xA0, 0xD800), *range(0xE000, 0x10000)):
        plain_form = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if ord(c) < 128)
        if plain_form and chr(code) not in single:
            forms[chr(code)] = plain_form
    return json.dumps(forms)


def plain_name(name: Column) -> Column:
    """A name in capitals without accents: compatibility forms, what isn't ASCII then goes, white space cut at both ends."""
    bare = F.translate(name, *_bare_letters())
    forms = F.from_json(F.lit(_spelled_out()), "map<string,string>")
    spelled = F.array_join(F.transform(F.split(bare, ""), lambda c: F.coalesce(F.try_element_at(forms, c), c)), "")
    text = F.when(bare.rlike(r"[^\x00-\x7F]"), spelled).otherwise(bare)
    return F.trim(F.upper(F.regexp_replace(text, r"[^\x00-\x7F]", "")))
