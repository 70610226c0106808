"""Name clean-up and name predicates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The clean-up patterns, in the order they apply. Dashes and quotes are written as code
# points, in the one form that Spark's and the comparison engine's patterns both read.
FEATURED = r"(?i)\s+(feat\.?|ft\.?)\s+.*"
CLEANUP = [
    (r"(?i)\s+&\s+", " and "),
    (r"[\x{2010}-\x{2015}\x{2212}]", "-"),
    (r"[\x{2018}-\x{201B}\x{2032}\x{2035}]", "'"),
    (r"\s*\([^)]*\)\s*$", ""),
    (r"^(.+),\s+(The)\s*$", "$2 $1"),
    (r"\s+", " "),
]

# Words that join a guest or mark a backing group.
CONJUNCTIONS = ["&", "and", "feat.", "featuring", "ft.", "+", "vs.", "versus", "et", "und"]
QUALIFIERS = [
    "trio", "quartet", "quintet", "sextet", "quintette", "orchestra", "ensemble",
    "group", "project", "chorus", "incorporated", "band", "ubiquity",
]


def strip_featured(name: Column) -> Column:
    """Cut everything from a `feat.` or `ft.` on; needs white space before it."""
    return F.regexp_replace(name, FEATURED, "")


def clean_name(name: Column) -> Column:
    """Even out ampersands, dashes, quotes, a trailing bracket, `X, The` and white space."""
    for pattern, replacement in CLEANUP:
        name = F.regexp_replace(name, pattern, replacement)
    return F.trim(name)


def match_key(name: Column) -> Column:
    """Lower case, outer space cut, inner white space runs as one blank."""
    return F.regexp_replace(trim_space(F.lower(name)), r"(?U)\s+", " ")


def trim_space(name: Column) -> Column:
    """Cut any kind of white space at both ends, not only blanks."""
    return F.regexp_replace(name, r"(?U)^\s+|\s+$", "")


def case_key(name: Column) -> Column:
    return trim_space(F.lower(name))


def readable(name: Column) -> Column:
    """A real name made of printable characters only; false for null."""
    printable = ~name.rlike(r"[\p{C}\p{Z}&&[^ ]]")
    return F.coalesce(
        (F.length(name) > 0) & ~name.isin("[unknown]", "[no artist]") & printable, F.lit(False)
    )


def is_qualifier(words: Column) -> Column:
    """Do these trailing words name a guest or a backing group?

    The first word decides if, without its dots, it is a conjunction; else the
    last word must be a qualifier (for a single word both are the same word).
    """
    first = F.regexp_replace(F.element_at(words, 1), r"\.+$", "")
    return first.isin(CONJUNCTIONS) | F.element_at(words, -1).isin(QUALIFIERS)


def case_rank(name: Column) -> Column:
    """Sorts the best-cased spelling first: upper initial, letter initial, short, code points."""
    return F.struct(
        (~name.rlike(r"^\p{Lu}")).alias("lower_initial"),
        (~name.rlike(r"^\p{L}")).alias("no_letter"),
        F.length(name).alias("length"),
        name.alias("name"),
    )


def contains_ignoring_case(name: Column, term: str) -> Column:
    return F.lower(name).contains(term.lower())


def shorten(name: Column, length: int) -> Column:
    """A display label of at most `length` characters."""
    return F.substring(name, 1, length)
