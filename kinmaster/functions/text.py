"""Cleaning and formatting as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinmaster import schema as S

WHITESPACE = " \t\n\r\x0b\x0c"

# Letters and marks with no plain base letter to fall back on.
SPECIAL_LETTERS = {
    "ß": "ss", "ẞ": "Ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o",
    "Ð": "D", "ð": "d", "Đ": "D", "đ": "d", "Þ": "Th", "þ": "th", "Ħ": "H",
    "ħ": "h", "ı": "i", "Ł": "L", "ł": "l", "Ŋ": "NG", "ŋ": "ng", "Ŧ": "T",
    "ŧ": "t", "ĸ": "k", "\u00a0": " ", "‘": "'", "’": "'", "“": '"', "”": '"',
    "–": "-", "—": "--", "…": "...",
}


def ascii_tables() -> tuple[str, str, dict[str, str]]:
    """(letters, their single replacements, multi-character replacements).

    Covers Latin-1 and Latin Extended-A by Unicode decomposition.
    """
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for code in range(0xC0, 0x180):
        letter = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", letter) if c.isascii())
        plain = SPECIAL_LETTERS.get(letter, plain)
        if len(plain) == 1:
            single[letter] = plain
        elif plain:
            several[letter] = plain
    for letter, plain in SPECIAL_LETTERS.items():
        (single if len(plain) == 1 else several)[letter] = plain
    return "".join(single), "".join(single.values()), several


def _spell_out(col: Column, several: dict[str, str]) -> Column:
    """Replace letters that need several characters; plain ASCII skips the search."""
    spelled = col
    for letter, replacement in several.items():
        spelled = F.replace(spelled, F.lit(letter), F.lit(replacement))
    return F.when(F.length(col) == F.octet_length(col), col).otherwise(spelled)


def to_ascii(col: Column) -> Column:
    """Latin letters and typographic marks as ASCII; other scripts pass through."""
    letters, plain, several = ascii_tables()
    return _spell_out(F.translate(col, letters, plain), several)


def _ascii_lower(col: Column, marks: dict[str, str]) -> Column:
    """ASCII, lower case and ``marks`` (each to one character or none) in one
    pass over the characters; letters needing several follow where any are left."""
    letters, plain, several = ascii_tables()
    table = dict(marks)
    table.update({a: marks.get(b, b) for a, b in zip(letters, plain)})
    spelled = {}
    for letter, long in several.items():
        long = "".join(marks.get(c, c) for c in long)
        if long.strip(" ") == "" and long:
            table[letter] = " "  # runs of spaces collapse anyway
        else:
            spelled[letter.lower()] = long.lower()
    kept = {a: b for a, b in table.items() if b}
    gone = [a for a, b in table.items() if not b]
    mapped = F.translate(col, "".join([*kept, *gone]), "".join(kept.values()))
    return _spell_out(F.lower(mapped), spelled)


def strip(col: Column, chars: str = WHITESPACE) -> Column:
    return F.btrim(col, F.lit(chars))


def _strip_quotes(col: Column) -> Column:
    return strip(strip(strip(strip(col), '"'), "'"))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def is_blank(col: Column) -> Column:
    """True for NULL and for text of nothing but whitespace."""
    return F.coalesce(strip(col.cast("string")) == "", F.lit(True))


def normalise_key(col: Column, mode: str = "compat") -> Column:
    """Trimmed upper-case key.

    ``compat`` turns a missing key into the text ``NAN``, so missing keys equal
    each other; ``strict`` leaves it NULL, so it equals nothing.
    """
    key = F.upper(strip(col.cast("string")))
    if mode == "compat":
        return F.coalesce(key, F.lit(S.MISSING_KEY))
    if mode == "strict":
        return blank_to_null(key)
    raise ValueError(f"unknown mode {mode!r}")


def normalise_text(col: Column) -> Column:
    """Dedup cleaning: runs of spaces collapse before newlines become spaces."""
    col = F.regexp_replace(_ascii_lower(col, {}), "  +", " ")
    return blank_to_null(_strip_quotes(F.translate(col, "\n", " ")))


def normalise_link_text(col: Column, comma: str = " ") -> Column:
    """Linkage cleaning: punctuation to spaces, then collapse; never NULL.

    ``comma=" "`` spaces a comma like the other marks, ``comma=""`` removes it.
    """
    marks = {**dict.fromkeys("\n-./:", " "), "'": "", ",": comma}
    col = F.regexp_replace(_ascii_lower(col, marks), "  +", " ")
    return F.coalesce(_strip_quotes(col), F.lit(""))


def normalise_zip(col: Column, mode: str = "strict") -> Column:
    """Part before the first hyphen, zero-padded to five and never cut.

    A blank zip is NULL in ``strict`` mode and ``00000`` in ``compat`` mode.
    """
    base = F.substring_index(F.coalesce(col, F.lit("")), "-", 1)
    if mode == "strict":
        base = blank_to_null(strip(base))
    elif mode != "compat":
        raise ValueError(f"unknown mode {mode!r}")
    return strip(F.when(F.length(base) < 5, F.lpad(base, 5, "0")).otherwise(base))


def has_digit(col: Column) -> Column:
    return F.coalesce(col.rlike(r"\p{Nd}"), F.lit(False))


def is_pending(col: Column) -> Column:
    """Contains ``pending`` (case matters), or is NULL or empty."""
    return F.coalesce(col.contains(S.PENDING_TEXT) | (col == ""), F.lit(True))


def status_of(is_new: Column) -> Column:
    return F.when(is_new, F.lit(S.PENDING_STATUS)).otherwise(F.lit(S.NOT_FOUND))


def format_id(number: Column, prefix: str = S.ID_PREFIX, width: int = S.ID_WIDTH) -> Column:
    return F.format_string(f"%s%0{width}d", F.lit(prefix), number)


def id_number(col: Column, prefix: str = S.ID_PREFIX) -> Column:
    """Numeric part of an ID, NULL where there is none."""
    return F.replace(col, F.lit(prefix), F.lit("")).try_cast("bigint")


def address_line(street: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """``street, city, state zip`` with blanks for missing parts."""
    street, city, state, zip_code = (
        F.coalesce(c.cast("string"), F.lit("")) for c in (street, city, state, zip_code)
    )
    return F.concat(street, F.lit(", "), city, F.lit(", "), state, F.lit(" "), zip_code)


def format_time(col: Column, pattern: str = "yyyyMMdd_HHmmss") -> Column:
    return F.date_format(col, pattern)


def version_parts(path: Column) -> tuple[Column, Column]:
    """(major, minor) of the first ``vN.N`` in the file name, 0.0 where absent."""
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    parts = [
        F.coalesce(
            F.regexp_extract(name, r"v(\d+)\.(\d+)", i).try_cast("bigint"), F.lit(0).cast("bigint")
        )
        for i in (1, 2)
    ]
    return parts[0], parts[1]


def version_of(path: Column) -> Column:
    """Version read as a decimal number anywhere in the path, 0 where absent.

    As decimals 1.12 sorts below 1.9; ``version_parts`` orders them properly.
    """
    return F.coalesce(
        F.regexp_extract(path, r"v(\d+\.\d+)", 1).try_cast("double"), F.lit(0.0)
    )
