"""Text helpers: Column -> Column, built-in expressions only.

Spark runs in ANSI mode, so every cast and array access uses a ``try_`` form
and a bad value becomes NULL instead of failing the task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number as Python's float() reads it: sign, digits, one dot, exponent.
# Guarding the cast with it keeps Spark from reading '5d' or '5f' as 5.0.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"


# Unicode's White_Space characters, which a regular expression's (?U)\s matches.
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Remove white space at both ends (Unicode aware, unlike ``trim``).

    ``btrim`` looks each end up in its list, character by character.  A column (named, so
    that asking its ends first works nothing out twice) that begins and ends with a
    printable ASCII character holds nothing to remove.
    """
    stripped = F.btrim(col(c), F.lit(WHITE_SPACE))
    if not isinstance(c, str):
        return stripped
    clean = F.left(c, F.lit(1)).between("!", "~") & F.right(c, F.lit(1)).between("!", "~")
    return F.when(clean, F.col(c)).otherwise(stripped)


def to_double(c: Column | str) -> Column:
    """Python ``float(text)``; NULL where float() would raise.

    The text is named once: a CASE branch works out what it names twice two times.
    """
    return F.regexp_extract(col(c), _NUMBER, 0).try_cast("double")


def blank_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(c != "", c)


def first_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, NULL when there is none."""
    c = col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def first_text(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of a pattern where an empty text counts as missing:
    one scan instead of ``first_match``'s two."""
    return blank_to_null(F.regexp_extract(col(c), pattern, group))


def all_matches(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(col(c), F.lit(pattern), group)


def last_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Last match of a pattern (``findall(...)[-1]``), NULL when none."""
    return F.try_element_at(all_matches(c, pattern, group), F.lit(-1))


# Marks a word start for ``initcap``; never occurs in page text.
_WORD_MARK = "\u0001 "


def title_case(c: Column | str) -> Column:
    """Python ``str.title()``: upper-case a letter that follows a non-letter.

    ``initcap`` only starts words after a blank ('3d' stays '3d', "l'oreal"
    becomes "L'oreal"), so a marked blank is put after every non-letter,
    ``initcap`` runs, and the marks are taken out again: three built-in,
    code-generated calls instead of a per-character lambda.
    """
    marked = F.regexp_replace(col(c), r"([^\p{L}])", "$1" + _WORD_MARK)
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def slug_to_label(c: Column | str) -> Column:
    """'frutas-y-verduras' -> 'Frutas Y Verduras'."""
    return title_case(F.regexp_replace(col(c), "-", " "))


def text_nodes(markup: Column | str) -> Column:
    """All text nodes of a markup fragment that are not blank, in document order."""
    return F.regexp_extract_all(col(markup), F.lit(r"(?:^|>)(\s*[^<\s][^<]*)"), 1)
