"""Text columns: stripping, case, accent-free keys, column-name normalisation."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value in the sources.
MISSING_TEXTS = ("", "none", "nan")

WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(c: Column) -> Column:
    """Remove every kind of whitespace at both ends.

    ``trim`` removes spaces only, and quickly. What it leaves is searched for the other kinds
    only where one of its ends is not a printable ASCII character.
    """
    spaced = F.trim(c)
    ends = [F.ascii(spaced), F.ascii(F.right(spaced, F.lit(1)))]
    printable = ends[0].between(33, 126) & ends[1].between(33, 126)
    return F.when(printable, spaced).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def strip_upper(c: Column) -> Column:
    return F.upper(strip(c))


def is_blank(c: Column) -> Column:
    """True for NULL and for text of whitespace only."""
    return F.coalesce(strip(c), F.lit("")) == ""


def missing_to_null(c: Column) -> Column:
    """Stripped text, or NULL where it is blank or spells a missing value."""
    s = strip(c)
    return F.when(~F.lower(s).isin(*MISSING_TEXTS), s)


def blank_to_null(c: Column) -> Column:
    """NULL for blank text; other text is kept as it is, spaces included."""
    return F.when(~is_blank(c), c)


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


@lru_cache(maxsize=1)
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition restricted to ASCII, for the characters that have one.

    Characters with a one-letter form make the two arguments of ``translate``; those with
    a longer form (ligatures, fractions) come as a mapping.
    """
    source, target, longer = [], [], {}
    for ch in map(chr, range(0x80, sys.maxunicode + 1)):
        if not unicodedata.decomposition(ch):
            continue
        form = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(form) == 1:
            source.append(ch)
            target.append(form)
        elif form:
            longer[ch] = form
    return "".join(source), "".join(target), longer


@lru_cache(maxsize=1)
def _longer_ranges() -> list[tuple[str, str]]:
    """Few ranges of characters that cover those with a longer form."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, _ascii_forms()[2])):
        if ranges and code - ranges[-1][1] <= 0x200 and ranges[-1][0] >= 0x100:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return [(chr(low), chr(high)) for low, high in ranges]


def _spell_out(c: Column) -> Column:
    """Replace the characters that stand for several ASCII letters, one character at a time."""
    longer = _ascii_forms()[2]
    forms = F.str_to_map(
        F.lit("\x01".join(f"{k}\x02{v}" for k, v in longer.items())), F.lit("\x01"), F.lit("\x02")
    )
    ranges = _longer_ranges()

    def spelled(ch: Column) -> Column:
        candidate = reduce(Column.__or__, [ch.between(low, high) for low, high in ranges])
        return F.when(candidate, F.coalesce(F.try_element_at(forms, ch), ch)).otherwise(ch)

    return F.array_join(F.transform(F.split(c, ""), spelled), "")


def ascii_fold(c: Column) -> Column:
    """Letters without their accents; what has no ASCII form is dropped.

    ASCII text is passed through, and text that is Latin letters with accents goes through
    one ``translate``; only text with ligatures, fractions and the like is taken apart.
    """
    source, target, _ = _ascii_forms()
    ranges = "".join(f"{low}-{high}" for low, high in _longer_ranges())
    single = F.when(c.rlike(f"[{ranges}]"), _spell_out(c)).otherwise(c)
    folded = F.regexp_replace(F.translate(single, source, target), r"[^\x00-\x7F]+", "")
    return F.when(is_ascii(c), c).otherwise(folded)


def geo_key(c: Column) -> Column:
    """Join key of a place name: stripped, upper case, without accents. NULL stays NULL."""
    return ascii_fold(strip_upper(c))


def snake_name(name: str) -> str:
    """The ASCII words of a column name, in lower case and joined by underscores."""
    source, target, longer = _ascii_forms()
    forms = {**dict(zip(source, target)), **longer}
    plain = "".join(ch if ch.isascii() else forms.get(ch, "") for ch in name)
    return "_".join(re.findall("[a-z0-9]+", plain.lower()))


def strip_label(c: Column, label: str) -> Column:
    """Remove a literal label such as `` Inicio`` and the whitespace around the rest."""
    return strip(F.replace(c, F.lit(label), F.lit("")))
