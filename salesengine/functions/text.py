"""Text normalisation expressions (JVM built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Every character Python counts as whitespace (str.isspace), built by rule:
# all of them lie below U+3001.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


# Characters without case: letters of caseless scripts count, letter numbers such as ⅷ do not.
UNCASED = r"[^\p{IsLowercase}\p{IsUppercase}\p{Lt}]"


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace (Python's definition, so the
    separator controls U+001C..U+001F count too), without a regex.

    ``trim`` removes ASCII spaces only and is the cheapest; the scan over the
    full whitespace set (``btrim``) runs only when some other whitespace
    character is still at either end."""
    t = F.trim(c)
    ws = list(WHITESPACE)
    edge = F.substring(t, 1, 1).isin(*ws) | F.substring(t, -1, 1).isin(*ws)
    return F.when(edge, F.btrim(t, F.lit(WHITESPACE))).otherwise(t)


def title_case(c: Column) -> Column:
    """Capitalise the first of every run of cased characters, lower-case the rest.

    ``t-shirt x`` -> ``T-Shirt X``, ``5kg rice`` -> ``5Kg Rice``, ``o'neil`` ->
    ``O'Neil``. ``initcap`` alone only starts a word after a space, so a space
    is put after every uncased character first and removed again afterwards (each
    inserted space directly follows its character, and a left-to-right scan
    for "uncased + space" consumes exactly those pairs). Three codegen'd
    built-ins, no per-row arrays or lambdas; title-case letters such as the
    ``ǅ`` digraph come out as Unicode title case.
    """
    spaced = F.regexp_replace(c, f"({UNCASED})", "$1 ")
    general = F.regexp_replace(F.initcap(spaced), f"({UNCASED}) ", "$1")
    # Fast path: for ASCII letters and spaces only, words are exactly the
    # space-separated runs, so initcap alone is already the answer.
    return F.when(c.rlike("^[A-Za-z ]*$"), F.initcap(c)).otherwise(general)


def normalise(c: Column) -> Column:
    return title_case(strip(c))
