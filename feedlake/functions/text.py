"""Cleaning, picking and hashing of article text, as column expressions."""

from __future__ import annotations

import re
import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import fixed


def _any_of(*characters: str) -> str:
    r"""A pattern for one of the listed characters.

    Java looks a class of listed Latin characters up in one table; ranges and
    classes like \w are tried one after the other, three times slower.
    """
    return "[" + "".join(re.escape(c) for c in "".join(characters)) + "]"


ASCII_SPACE = _any_of(fixed.SPACES_ASCII)
LATIN_SPACE = _any_of(fixed.SPACES_LATIN)
ANY_SPACE = f"[{fixed.SPACES_LATIN}{fixed.SPACES_HIGH}]"
# The range in front rules out most characters at once.
HIGH_SPACE = f"[\u1680-\u3000&&[{fixed.SPACES_HIGH}]]"
DROP_ASCII = "[^" + _any_of(
    fixed.SPACES_ASCII, string.ascii_letters, string.digits, fixed.KEPT_SYMBOLS
)[1:]
DROP_UNICODE = f"[^{fixed.KEPT_UNICODE}{re.escape(fixed.KEPT_SYMBOLS)}]"


def _by_space(text: Column, use: Callable[[str], Column]) -> Column:
    """``use`` with a pattern for runs of white space, a quick one where that will do."""
    return F.when(text.rlike(HIGH_SPACE), use(ANY_SPACE + "+")).otherwise(use(LATIN_SPACE + "+"))


def squeeze(text: Column, blanks_only: bool = False) -> Column:
    """Runs of any white space become one blank; none stays at the ends.

    ``blanks_only`` says that blanks are the only white space in the text, as
    they are in cleaned text.
    """
    if blanks_only:
        double = F.contains(text, F.lit("  "))
        return F.trim(F.when(double, F.regexp_replace(text, " +", " ")).otherwise(text))
    return F.trim(_by_space(text, lambda spaces: F.regexp_replace(text, spaces, " ")))


def words(text: Column, blanks_only: bool = False) -> Column:
    """The words between runs of any white space, none of them empty."""
    if blanks_only:
        return F.array_remove(F.split(text, " "), "")
    return F.array_remove(_by_space(text, lambda spaces: F.split(text, spaces)), "")


def normalize_text(text: Column, unicode: bool = False) -> Column:
    """Squeeze white space, then delete symbols.

    By default only ASCII letters, digits and white space count as such, and
    only blanks are trimmed, before squeezing: a leading newline leaves a blank.
    With ``unicode`` letters and digits of all scripts stay. Deleting a symbol
    between two blanks leaves both.
    """
    if unicode:
        return F.regexp_replace(squeeze(text), DROP_UNICODE, "")
    one_blank = F.regexp_replace(F.trim(text), ASCII_SPACE + "+", " ")
    return F.regexp_replace(one_blank, DROP_ASCII, "")


def first_present(*candidates: Column, skip_empty: bool = False) -> Column:
    """First candidate that is not NULL; with ``skip_empty`` first one with text, else ''."""
    if not skip_empty:
        return F.coalesce(*candidates)
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))


def content_hash(
    text: Column, case_sensitive: bool = False, blanks_only: bool = False
) -> Column:
    """SHA-256 of the text, by default ignoring case and white space; '' for no text."""
    key = text if case_sensitive else F.lower(squeeze(text, blanks_only))
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("")).otherwise(F.sha2(key, 256))


def language_tag(hint: Column, empty_is_unknown: bool = False) -> Column:
    present = F.nullif(hint, F.lit("")) if empty_is_unknown else hint
    return F.coalesce(F.lower(present), F.lit(fixed.UNKNOWN_LANGUAGE))


def long_enough(text: Column, min_chars: int, inclusive: bool = False) -> Column:
    return F.length(text) >= min_chars if inclusive else F.length(text) > min_chars
