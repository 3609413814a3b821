"""Text columns: accent folding, keys, cleaning, names, keyword rules."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators Python also treats as space.
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]+"
_SPACE_OR_SEPARATOR = r"[\p{IsWhite_Space}\x1c-\x1f;]+"
_SPACES = "".join(chr(p) for p in range(0x3001) if chr(p).isspace())
_NON_ASCII = r"[^\x00-\x7F]"
# No character in these common ranges unfolds to several letters: a quick way out.
_MAY_UNFOLD = r"[^\x00-\xBB\xBF-\x{131}\x{250}-\x{2024}\x{2027}-\x{203B}]"


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """ASCII part of the NFKD form of every character that has one.

    Returns the ``translate`` pair for one-to-one cases and the (char, text) list for
    characters such as ligatures or fractions that unfold to several letters.
    """
    source, target, longer = [], [], []
    for point in range(0x80, 0x20000):
        if 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        ascii_part = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(ascii_part) == 1:
            source.append(char)
            target.append(ascii_part)
        elif ascii_part:
            longer.append((char, ascii_part))
    return "".join(source), "".join(target), tuple(longer)


def _ranges(pairs: tuple[tuple[str, str], ...]) -> str:
    """Character-class body covering the first elements, as ranges (they are in order)."""
    runs: list[list[str]] = []
    for char, _ in pairs:
        if runs and ord(char) == ord(runs[-1][1]) + 1:
            runs[-1][1] = char
        else:
            runs.append([char, char])
    return "".join(a if a == b else f"{a}-{b}" for a, b in runs)


def strip_accents(c: Column) -> Column:
    """Accent folding: compatibility-decompose, then drop whatever is not ASCII.

    Spark has no NFKD function. The fold is context free per character, so a ``translate``
    table generated from the Unicode data gives the exact result. Pure-ASCII text, the usual
    case, only pays for one regular-expression test.
    """
    source, target, longer = _fold_tables()
    # One text literal read as a map; Spark folds it into a constant when it plans the query.
    entries = "\x02".join(f"{char}\x01{letters}" for char, letters in longer)
    table = F.str_to_map(F.lit(entries), F.lit("\x02"), F.lit("\x01"))
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(f"([{_ranges(longer)}])"), F.lit(1)))
    unfolded = F.when(
        c.rlike(_MAY_UNFOLD), F.aggregate(found, c, lambda text, ch: F.replace(text, ch, table[ch]))
    ).otherwise(c)
    folded = F.regexp_replace(F.translate(unfolded, source, target), _NON_ASCII, "")
    return F.when(c.rlike(_NON_ASCII), folded).otherwise(c)


def collapse(c: Column) -> Column:
    """Every run of white space becomes one space; ends trimmed."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def strip(c: Column) -> Column:
    """Trim Unicode white space at both ends, inner spacing kept."""
    return F.btrim(c, F.lit(_SPACES))


def norm_key(c: Column) -> Column:
    """Comparison key: no accents, symbols to space, collapsed, lower case; null gives ''."""
    folded = strip_accents(F.coalesce(c, F.lit("")))
    return F.lower(collapse(F.regexp_replace(folded, r"[^\w\s]", " ")))


def norm_text(c: Column, collapse_spaces: bool = True) -> Column:
    """Display form: no accents, collapsed (or only trimmed), upper case; null stays null."""
    folded = strip_accents(c)
    return F.upper(collapse(folded) if collapse_spaces else strip(folded))


def norm_label(c: Column) -> Column:
    """``norm_text`` that also reads underscores as spaces (column and cell comparisons)."""
    return norm_text(F.translate(c, "_", " "))


def clean_header(c: Column) -> Column:
    """Header text: tabs and newlines to space, ``(*)`` and ``*`` removed, then normalised."""
    text = F.translate(F.coalesce(c, F.lit("")), "\t\r\n", "   ")
    text = F.regexp_replace(text, r"\(\s*\*\s*\)", "")
    return norm_label(F.translate(text, "*", ""))


def clean_cell(c: Column, separators: bool = True) -> Column:
    """Cell text: control characters (and ``;``) to space, collapsed and trimmed."""
    if separators:
        return F.trim(F.regexp_replace(c, _SPACE_OR_SEPARATOR, " "))
    return collapse(c)


def null_tokens(c: Column, tokens: Sequence[str]) -> Column:
    """Null when the value is one of ``tokens`` (the set differs by entity)."""
    return F.when(~c.isin(*tokens), c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def contains_status(c: Column, exact: bool = True) -> Column:
    """ACTIVO / INACTIVO from free text; RETIRADO counts as INACTIVO, anything else is null.

    With ``exact`` the text is read by whole words, so INACTIVO stays INACTIVO. The other
    mode looks for substrings only, where INACTIVO contains ACTIVO and so becomes ACTIVO.
    """
    text = norm_text(c)
    retired = text.contains("RETIRADO")
    if exact:
        return (
            F.when(retired | text.rlike(r"\bINACTIVO\b"), "INACTIVO")
            .when(text.rlike(r"\bACTIVO\b"), "ACTIVO")
        )
    return F.when(retired, "INACTIVO").when(text.contains("ACTIVO"), "ACTIVO")


def keyword_category(
    c: Column,
    whole: Mapping[str, Sequence[str]],
    contains: Mapping[str, Sequence[str]],
    other: str,
    prepared: bool = False,
) -> Column:
    """First matching category: whole-text lists first, then keyword lists in order.

    Text that matches nothing is ``other``; null and blank give null. Every test reads the
    text, so a caller that has it in upper case and trimmed already says ``prepared``.
    """
    text = c if prepared else strip(F.upper(c))
    out = F.when(text.isNull() | (text == ""), None)
    for label, words in whole.items():
        out = out.when(text.isin(*words), label)
    for label, words in contains.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word)
        out = out.when(hit, label)
    return out.otherwise(F.lit(other))


def full_name(
    names: Column | None = None,
    surname: Column | None = None,
    second_surname: Column | None = None,
) -> Column:
    """``SURNAME [SECOND], NAMES``.

    A single surname column that already holds a comma is taken as the whole name, and a
    name that repeats itself around the comma is written once. Without surnames (or without
    names) the available text is used alone.
    """

    def part(c: Column) -> Column:
        return collapse(F.coalesce(c, F.lit("")))

    if names is not None and surname is not None:
        if second_surname is not None:
            text = F.concat(part(surname), F.lit(" "), part(second_surname), F.lit(", "), part(names))
        else:
            text = F.when(part(surname).contains(","), part(surname)).otherwise(
                F.concat(part(surname), F.lit(", "), part(names))
            )
    else:
        text = part(names if names is not None else surname)
    return F.regexp_replace(collapse(text), r"^(.*?),\s*\1$", "$1")


def base_name(c: Column) -> Column:
    """File name without the folders before it."""
    return F.regexp_extract(c, r"([^/]*)$", 1)


def centre_before_dash(file_name: Column) -> Column:
    """Centre name as the part of a file name before `` - ``."""
    return F.trim(F.split_part(file_name, F.lit(" - "), F.lit(1)))


def centre_from_file(
    file_name: Column, prefix: str = "", suffixes: Sequence[str] = (), underscores: bool = False
) -> Column:
    """Centre name from a file name: extension, prefix and suffixes removed."""
    text = F.regexp_replace(file_name, r"\.xlsx$|\.xlsm$|\.xls$", "")
    for piece in (prefix, *suffixes):
        if piece:
            text = F.replace(text, F.lit(piece), F.lit(""))
    if underscores:
        text = F.translate(text, "_", " ")
    return F.trim(text)


def capture_code(c: Column, pattern: str = r"(C\d+)") -> Column:
    """First code matching ``pattern`` in a column name or text, null when absent."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def split_two(c: Column, separator: str = " - ") -> tuple[Column, Column]:
    """Text before and after the first separator; the second part is null when absent."""
    at = F.locate(separator, c)
    head = F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c)
    tail = F.when(at > 0, F.substring(c, at + len(separator), F.length(c)))
    return head, tail


def substring_at(c: Column, position: int, length: int = 1) -> Column:
    return F.substring(c, position, length)
