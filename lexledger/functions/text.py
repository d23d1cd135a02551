"""Text normalisation as Column expressions (JVM side, no UDF)."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and what they reduce to.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇýÿÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNCyyY"
#: Named entities of HTML: name to character, from the standard library's table; "apos" comes from XML.
ENTITIES = {k: chr(v) for k, v in name2codepoint.items()} | {"apos": "'"}


def unescape(c: Column) -> Column:
    """Named and numeric entities resolved, each once; unknown ones stay."""
    table = F.create_map(*[F.lit(x) for k, v in ENTITIES.items() for x in (k, v)])
    found = F.array_distinct(F.regexp_extract_all(c, F.lit("&(#?[0-9A-Za-z]+);"), F.lit(1)))

    def char(e: Column) -> Column:
        digits = F.when(e.rlike("^#[0-9]{1,5}$"), F.hex(F.substr(e, F.lit(2)).cast("int"))).when(e.rlike("^#[xX][0-9A-Fa-f]{1,4}$"), F.substr(e, F.lit(3)))
        return F.coalesce(F.decode(F.unhex(F.lpad(digits, 4, "0")), "UTF-16BE"), table[e])

    # "&amp;" goes last, so that what it uncovers stays as it is.
    order = F.concat(F.filter(found, lambda e: e != "amp"), F.filter(found, lambda e: e == "amp"))
    done = F.aggregate(order, c, lambda s, e: F.replace(s, F.concat(F.lit("&"), e, F.lit(";")), F.coalesce(char(e), F.concat(F.lit("&"), e, F.lit(";")))))
    return F.when(F.contains(c, F.lit("&")), done).otherwise(c)


def collapse_ws(c: Column) -> Column:
    """Entities resolved, every run of Unicode white space one blank, trimmed."""
    return F.trim(F.regexp_replace(unescape(c), r"(?U)\s+", " "))


def strip_accents(c: Column) -> Column:
    """Base letters only; ñ becomes n, combining marks go."""
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), r"\p{Mn}+", "")


def normalize_key(c: Column) -> Column:
    return F.lower(collapse_ws(strip_accents(c)))


def title_key(c: Column) -> Column:
    """Key of a register title: without a trailing "(BOE ...)" and final full stops."""
    return F.rtrim(normalize_key(F.regexp_replace(c, r"(?iU)\s*\(BOE[^)]*\)\s*\.?\s*$", "")), F.lit("."))


def tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, r"\s+"), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of the token sets; 0.0 if either is empty."""
    x, y = tokens(a), tokens(b)
    both = F.size(F.array_intersect(x, y))
    union = F.size(F.array_union(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(both / union)
