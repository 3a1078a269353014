"""Detection and repair of text whose UTF-8 bytes were read in a one-byte charset."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.text import is_ascii

# Fixed value: marks of damaged text (lead byte of a two-byte letter in cp1252 and cp437).
DAMAGE_MARKS = "├Ã"

OUTSIDE = "\ufffd"  # any character that Latin-1 does not have
WIDE = r"[^\x00-\xFF]"


@lru_cache(maxsize=None)
def _high_bytes(charset: str) -> dict[int, str]:
    """Character each byte from 0x80 on stands for; bytes the charset leaves open are absent."""
    table = {}
    for byte in range(0x80, 0x100):
        try:
            table[byte] = bytes([byte]).decode(charset)
        except UnicodeDecodeError:
            continue
    return table


def redecode(c: Column, charset: str) -> Column:
    """``c`` turned back to bytes of ``charset`` and read as UTF-8; NULL where that fails.

    Characters are moved to the code points of their bytes and then written as Latin-1.
    Bytes the charset leaves open travel as control characters of the same number; a letter
    the charset lacks is moved out of Latin-1.
    """
    table = _high_bytes(charset)
    moved = {ch: chr(byte) for byte, ch in table.items() if ord(ch) != byte}
    open_bytes = {byte for byte in range(0x80, 0xA0) if byte not in table}
    known = {ord(ch) for ch in table.values()} | (set(range(0x80, 0xA0)) if open_bytes else set())
    moved |= {chr(code): OUTSIDE for code in range(0x80, 0x100) if code not in known}
    as_latin1 = F.translate(c, "".join(moved), "".join(moved.values()))
    if min(moved) > "\xff":  # text that is Latin-1 already has nothing to move
        as_latin1 = F.when(c.rlike(WIDE), as_latin1).otherwise(c)
    decoded = F.try_validate_utf8(F.encode(as_latin1, "ISO-8859-1").cast("string"))
    return F.when(is_ascii(c), c).when(~as_latin1.rlike(WIDE), decoded)


# First bytes (as cp1252 shows them) of the letters up to U+00FF and of typographic marks,
# with the number of bytes that follow. Other first bytes are letters a sound text may well have before a
# quotation mark or the like.
LEADS = {"Â": 1, "Ã": 1, "â": 2}


@lru_cache(maxsize=1)
def _damaged_letter() -> str:
    """Pattern of one damaged letter: a lead and as many characters that stand for bytes 0x80 to 0xBF."""
    table = _high_bytes("cp1252")
    follows = "".join(sorted({ch for byte in range(0x80, 0xC0) for ch in (chr(byte), table.get(byte, chr(byte)))}))
    return "|".join(f"{lead}[{follows}]{{{n}}}" for lead, n in LEADS.items())


def _repair_letters(c: Column) -> Column:
    """Put right each damaged letter of a text that is otherwise sound."""
    letter = _damaged_letter()
    parts = F.regexp_extract_all(c, F.lit(f"(?s)({letter}|.[^{''.join(LEADS)}]*)"), F.lit(1))
    return F.array_join(
        F.transform(parts, lambda p: F.when(p.rlike(f"^(?:{letter})$"), F.coalesce(redecode(p, "cp1252"), p)).otherwise(p)), ""
    )


def repair_mojibake(c: Column) -> Column:
    """Undo a cp1252 misreading of UTF-8; text that is not damaged comes back unchanged.

    A text is first taken as a whole. Where that is not possible because only a part of it
    is damaged, the damaged letters are put right one by one.
    """
    partly = F.when(c.rlike(_damaged_letter()), _repair_letters(c))
    return F.when(is_ascii(c), c).otherwise(F.coalesce(redecode(c, "cp1252"), partly, c))


def looks_damaged(c: Column) -> Column:
    return c.rlike(f"[{DAMAGE_MARKS}]")


def damage(c: Column, charset: str = "cp1252") -> Column:
    """Text as it looks when its UTF-8 bytes are read as ``charset`` (to exercise the repair)."""
    moved = {chr(b): ch for b, ch in _high_bytes(charset).items() if ord(ch) != b}
    return F.translate(
        F.decode(F.encode(c, "UTF-8"), "ISO-8859-1"), "".join(moved), "".join(moved.values())
    )
