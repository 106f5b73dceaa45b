"""Cleaning and matching of text columns."""

from __future__ import annotations

import re
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import config

_BLANK = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Strip the whitespace Python strips, not only the space character.

    Text that starts and ends with a printable ASCII character, as most does, is passed through
    without a search among all the blanks there are.
    """
    text = _col(c)
    ends = [F.substr(text, F.lit(position), F.lit(1)) for position in (1, -1)]
    plain = ends[0].between("!", "~") & ends[1].between("!", "~")
    return F.when(plain, text).otherwise(F.btrim(text, F.lit(config.WHITESPACE)))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(clean(c), F.lit(""))


def canonical_class(c: Column | str, allowed: tuple[str, ...] = config.OBJECT_CLASSES) -> Column:
    """``'Nautical chart'`` -> ``'NauticalChart'``; anything that is not an allowed class is null.

    The words of the text, whatever their case, must be the words of the class name, so the single
    word ``'NauticalChart'`` is rejected. The text must be clean; see ``clean``.
    """
    text = _col(c)
    names = [part for name in allowed for part in (F.lit(_words(name)), F.lit(name))]
    # In printable ASCII the only blank is the space; other blanks need the slower replacement.
    spaced = (
        F.when(text.rlike("[^ -~]"), F.regexp_replace(text, f"{_BLANK}+", " "))
        .when(text.contains("  "), F.regexp_replace(text, " +", " "))
        .otherwise(text)
    )
    return F.try_element_at(F.create_map(*names), F.lower(spaced))


def _words(name: str) -> str:
    return re.sub("(?<!^)(?=[A-Z])", " ", name).lower()


def parse_authors(rows: DataFrame, cell: str) -> DataFrame:
    """Replace a column of ``'Name (ID)'`` cells by ``p_identifier`` and ``p_name``.

    Everything between the first opening bracket and a bracket that ends the text is the id, what
    precedes it the name. Cells that read otherwise, or whose id is blank, have no id and no name;
    the name alone is null when only ``'(ID)'`` is given.

    Plain string functions take the text apart, which costs a fraction of matching a pattern for
    each part; only cells with a line break, which must not fall inside either part, need the
    pattern. Each step is a projection of its own, so that nothing is computed twice.
    """
    others = [c for c in rows.columns if c != cell]
    text = rows.select(*others, clean(cell).alias("_text"), F.col(cell).alias("_raw"))
    cut = text.select(*others, "_text", "_raw", F.substring_index("_text", "(", 1).alias("_before"))
    rest = F.length("_text") - F.length("_before")
    closed = F.col("_text").endswith(")") & (rest > 2)
    broken = F.col("_raw").contains("\n")
    # (?d): only the line feed ends a line.
    pattern = "(?d)" + config.AUTHOR_PATTERN.replace(r"\s", _BLANK)
    inside = F.substr("_text", F.length("_before") + 2, rest - 2)
    parts = cut.select(
        *others,
        F.when(broken, clean(F.regexp_extract("_raw", pattern, 2)))
        .when(closed, clean(inside))
        .alias("_id"),
        F.when(broken, clean(F.regexp_extract("_raw", pattern, 1)))
        .otherwise(clean("_before"))
        .alias("_name"),
    )
    known = F.col("_id") != ""
    result = parts.select(
        *others,
        F.when(known, F.col("_id")).alias("p_identifier"),
        F.when(known & (F.col("_name") != ""), F.col("_name")).alias("p_name"),
    )
    return computed_once(result, "p_identifier", "p_name")


def computed_once(rows: DataFrame, *columns: str) -> DataFrame:
    """The same rows, but filters on these columns stay above this point.

    Spark moves a filter below the projections that compute its columns by repeating what they
    compute, nested steps and all. It does not move one below a generator; this generator makes
    exactly one row of each.
    """
    others = [c for c in rows.columns if c not in columns]
    return rows.select(*others, F.stack(F.lit(1), *map(F.col, columns)).alias(*columns))


def ascii_like(c: Column | str, partial: str) -> Column:
    """Contains-match that folds the case of ASCII letters only.

    ``%`` and ``_`` in the argument stay wildcards and nothing escapes them; Spark's own escape
    character is therefore doubled. A null never matches, not even the empty argument.
    """
    fold = str.maketrans(ascii_uppercase, ascii_lowercase)
    pattern = partial.translate(fold).replace("\\", "\\\\")
    folded = F.translate(_col(c), ascii_uppercase, ascii_lowercase)
    return folded.like(f"%{pattern}%")


def iri(entity: str, identifier: Column | str, namespace: str = config.NAMESPACE) -> Column:
    """``loc:Entity-`` plus the percent-encoded id, with Python's choice of safe characters."""
    encoded = F.url_encode(_col(identifier))
    encoded = F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    return F.concat(F.lit(f"{namespace}:{entity}-"), encoded)


def strip_namespace(c: Column | str, namespace: str) -> Column:
    """Literal removal of a namespace, not a pattern."""
    return F.replace(_col(c), F.lit(namespace), F.lit(""))
