"""Text folding as column expressions.

The fold to ASCII is compatibility decomposition (NFKD) with every non-ASCII character dropped. Spark has no
`normalize` function, so the mapping is derived per code point from the Unicode data Python ships with: one-to-one
mappings go through `translate`, the few one-to-many ones (ligatures, fractions, roman numerals) through a map.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII white space as Python's str.strip() sees it.
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
_NON_ASCII = r"[^\x00-\x7F]"
_MARK, _ENTRY = "\x01", "\x02"
# Up to so many distinct characters are replaced one after the other; more are translated in one pass.
_SHORT_ALPHABET = 48


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """(source chars, target chars, one-to-many map), built from the Unicode decompositions."""
    source, target, many = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if 0xD800 <= code <= 0xDFFF or not unicodedata.decomposition(char):
            continue
        ascii_form = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")
        if len(ascii_form) == 1:
            source.append(char)
            target.append(ascii_form)
        elif ascii_form:
            many[char] = ascii_form
    return "".join(source), "".join(target), many


def strip_blanks(col: Column) -> Column:
    """`str.strip()` for ASCII text; `trim` alone would leave tabs and newlines."""
    return F.btrim(col, F.lit(_BLANKS))


def fold_ascii(col: Column) -> Column:
    """NFKD fold to ASCII. Plain ASCII values skip all of it.

    What a text has to be folded is its alphabet: its few distinct characters beyond ASCII. They are folded one by one and
    then replaced in the text, a byte search each. A text with a large alphabet is translated character by character.
    """
    source, target, many = fold_tables()
    # One literal that the optimizer folds to a map: hundreds of separate literals would cost seconds of planning.
    entries = _ENTRY.join(f"{char}{_MARK}{ascii_form}" for char, ascii_form in many.items())
    lookup = F.str_to_map(F.lit(entries), F.lit(_ENTRY), F.lit(_MARK))
    several = "".join(many)

    def folded(char: Column) -> Column:
        one = F.translate(char, source, target)
        longer = F.when(F.translate(char, several, "") == "", F.try_element_at(lookup, char)).otherwise("")
        return F.when(one.rlike(_NON_ASCII), longer).otherwise(one)

    def by_character(alphabet: Column) -> Column:
        expanded = F.aggregate(F.filter(alphabet, lambda c: F.translate(c, several, "") == ""), col, lambda text, c: F.replace(
            text, c, F.coalesce(F.try_element_at(lookup, c), c)))
        return F.regexp_replace(F.translate(expanded, source, target), _NON_ASCII, "")

    def by_alphabet(alphabet: Column) -> Column:
        return F.aggregate(alphabet, col, lambda text, c: F.replace(text, c, folded(c)))

    alphabet = F.array_remove(F.array_distinct(F.split(F.regexp_replace(col, "[\\x00-\\x7F]+", ""), "")), "")
    # the one-element array names the alphabet, so that it is found once per text
    fold = F.transform(F.array(alphabet), lambda a: F.when(F.size(a) <= _SHORT_ALPHABET, by_alphabet(a)).otherwise(
        by_character(a)))
    return F.when(col.rlike(_NON_ASCII), F.element_at(fold, 1)).otherwise(col)


def normalize_name(col: Column) -> Column:
    """Fold, upper-case, strip, then one pass of two spaces to one."""
    return F.replace(strip_blanks(F.upper(fold_ascii(col))), F.lit("  "), F.lit(" "))


def normalize_text(col: Column) -> Column:
    """Fold, lower-case, and turn every run of other characters into one space; null gives ''."""
    folded = F.lower(fold_ascii(F.coalesce(col, F.lit(""))))
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))


def title_case(col: Column) -> Column:
    """Title case in which any non-letter starts a word. Expects upper-case ASCII.

    `initcap` only starts words at spaces, so a marked space is put behind every other non-letter and removed after.
    """
    spaced = F.regexp_replace(col, "([^A-Z ])", f"$1{_MARK} ")
    return F.replace(F.initcap(spaced), F.lit(f"{_MARK} "), F.lit(""))


def strip_accents(name: str) -> str:
    """Drop combining marks of one identifier (used on column names only)."""
    return "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))


def percent_label(col: Column) -> Column:
    """A ratio as a whole percentage, ties to even: 0.125 gives '12%'."""
    return F.concat(F.bround(col * 100, 0).cast("bigint").cast("string"), F.lit("%"))
