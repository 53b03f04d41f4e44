"""Strings, identifiers and guarded numbers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed classes: white space and word characters as Python's re has them, written out so that Java agrees.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WORD = r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def collapse(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


# The characters that Windows-1252 has where Latin-1 has controls, and these controls.
_WINDOWS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_CONTROLS = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)).decode("latin-1")


def repair_encoding(text: Column) -> Column:
    """UTF-8 that was read as Latin-1 or Windows-1252 becomes what it was, where the text can be read that way; else it stays."""
    whole, text = text, F.translate(text, _WINDOWS, _CONTROLS)
    narrow = text.rlike(r"^[\x{0}-\x{ff}]*$") & text.rlike(r"[\x{80}-\x{ff}]")
    raw = F.encode(F.when(narrow, text), "ISO-8859-1")
    return F.when(narrow & F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8")).otherwise(whole)


def normalise(text: Column, fix_encoding: bool = True, whitespace: bool = True, lowercase: bool = False, strip_punctuation: bool = False) -> Column:
    """Caption text: repaired, on one line, white space collapsed; lower case and without punctuation if asked for."""
    if fix_encoding:
        text = repair_encoding(text)
    if lowercase:
        text = F.lower(text)
    if strip_punctuation:
        text = F.regexp_replace(text, NOT_WORD, "")
    # Line breaks are white space, so that one pass at the end does for all.
    return collapse(text) if whitespace else F.translate(text, "\n\r", "  ")


def present(text: Column) -> Column:
    """The text, or null where it is missing or blank."""
    return F.nullif(F.trim(text), F.lit(""))


def youtube_id(url: Column) -> Column:
    """The 11 characters of a video id; for other links the last part of the path, cut to 11."""
    query = F.nullif(F.regexp_extract(url, r"[?&]v=([A-Za-z0-9_-]{11})", 1), F.lit(""))
    short = F.nullif(F.regexp_extract(url, r"youtu\.be/([A-Za-z0-9_-]{11})", 1), F.lit(""))
    return F.coalesce(query, short, F.left(F.element_at(F.split(url, "/"), -1), F.lit(11)))


def signer_number(sample_key: Column) -> Column:
    """Digits after a leading ``signer``, or an empty string."""
    return F.regexp_extract(sample_key, r"^signer(\d+)", 1)


def clip_id(raw: Column) -> Column:
    """A clip's path as one name: no wildcard, no outer slashes, slashes and spaces as underscores."""
    return F.translate(F.trim(F.replace(F.trim(raw), F.lit("/*"), F.lit("")), F.lit("/")), "/ ", "__")


def flag(raw: Column) -> Column:
    """Whether a cell says yes: true, 1, yes, or a number other than 0. Missing cells say no."""
    text = F.lower(F.trim(raw.cast("string")))
    number = F.try_to_number(F.when(text.rlike(r"^[+-]?\d{1,18}$"), F.replace(text, F.lit("+"), F.lit(""))), F.lit("S999999999999999999"))
    return F.coalesce(text.isin("true", "1", "yes") | (number != 0), F.lit(False))


def whole(raw: Column) -> Column:
    """An integer, or null where the text is none."""
    return F.trim(raw).try_cast("long")


def real(raw: Column) -> Column:
    """A finite number, or null."""
    x = F.trim(raw.cast("string")).try_cast("double")
    return F.when(~F.isnan(x), x)


def padded(number: Column, width: int) -> Column:
    """Zero-padded to a width; longer numbers stay whole."""
    return F.format_string(f"%0{width}d", number)


def milliseconds(seconds: Column) -> Column:
    """Whole milliseconds, towards zero."""
    return (seconds * 1000).cast("long")


def stem(path: Column) -> Column:
    """File name without folders and without the last suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
