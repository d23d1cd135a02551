"""Legal references and vocabularies as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of instruments by order of preference, with how they are numbered ("" for not at all). The first
# one in this order that a text names counts, wherever it stands.
NAMED = [
    ("Reglamento Delegado (UE)", "number/year"), ("Reglamento de Ejecución (UE)", "number/year"), ("Reglamento (UE)", "number/year"), ("Directiva", "year/number/body"),
    ("Real Decreto-ley", "number/year"), ("Real Decreto Legislativo", "number/year"), ("Real Decreto", "number/year"), ("Ley", "number/year"), ("Directiva", "number/number"),
    ("Ley del Mercado de Valores", ""), ("Ley de Instituciones de Inversión Colectiva", ""), ("Ley de Sociedades de Capital", ""), ("Ley Concursal", ""),
    ("Circular", "number/year"), ("Norma", "number of a Circular"),
]
# Other names of the same.
ALIASES = {"Ley del Mercado de Valores": ["LMV", "LMVSI"]}
NUMBERING = {"number/year": r"\d+/\d{4}", "year/number/body": r"\d{4}/\d+/\w+", "number/number": r"\d+/\d+", "number of a Circular": r"\d+(?=\s+de\s+la\s+Circular)"}


def _pattern(name: str, numbering: str) -> str:
    """A name as a pattern: any white space, "o" with or without accent, blanks inside brackets, "nº" before a number."""
    words = [re.escape(w).replace("ó", "[oó]").replace(r"\(UE\)", r"\(\s*UE\s*\)").replace(r"\-", "-") for w in name.split()]
    other = "|".join([r"\s+".join(words), *map(re.escape, ALIASES.get(name, []))]).replace(r"\s+\(", r"\s*\(")
    number = r"\s*(?:(?:n\.?[ºo]\.?|número|núm\.?)\s*)?" if name.endswith(")") else r"\s+"
    return rf"(?<![\w-])(?:{other})" + (rf"{number}({NUMBERING[numbering]})" if numbering else r"\b()")


#: (pattern whose group is the number, name with a blank before it).
STATUTES = [(_pattern(n, k), f"{n} " if k else n) for n, k in NAMED]
ORDINALS = "bis|ter|quater|quinquies|sexies|septies|octies|nonies|decies"


def normalize_statute(c: Column) -> Column:
    """"Ley 22/2014, de 12 de noviembre" is "Ley 22/2014"."""
    return F.coalesce(*[F.when(c.rlike("(?iu)" + p), F.concat(F.lit(name), F.regexp_extract(c, "(?iu)" + p, 1))) for p, name in STATUTES])


def statute_mentions(c: Column) -> Column:
    """All instruments named in the text, each once, by pattern and place."""

    def of(pattern: str, name: str) -> Column:
        return F.transform(F.regexp_extract_all(c, F.lit("(?iu)" + pattern), F.lit(1)), lambda number: F.concat(F.lit(name), number))

    each = [of(p, name) for p, name in STATUTES]
    return F.array_distinct(F.flatten(F.array(*each)))


def normalize_article(c: Column) -> Column:
    """"99, letra z) bis" is "99.z.bis"; "107 quáter 3.c" is "107.quater.3.c"; null if it is no article."""
    t = F.translate(F.lower(F.trim(c)), "áéíóú", "aeiou")
    t = F.regexp_replace(t, r"[,.]?\s*letras?\s+", ".")
    t = F.regexp_replace(t, r"[)\s]*$", "")
    t = F.regexp_replace(t, r"[)]", "")
    t = F.regexp_replace(t, rf"\s+(?=(?:{ORDINALS}|\d+|[a-zñ])\b)", ".")
    t = F.regexp_replace(F.regexp_replace(t, r"\s+", ""), r"\.+", ".")
    return F.when(t.rlike(rf"(?u)^\d{{1,3}}(\.(\d{{1,3}}|[a-zñ]|{ORDINALS}))*$"), t)


def extract_article(c: Column) -> Column:
    """The article that the text begins with."""
    return normalize_article(F.nullif(F.regexp_extract(c, rf"(?iu)^\s*(?:art[ií]culos?\s+)?(\d{{1,3}}(?:\.[a-zñ0-9]{{1,3}})*(?:\s+(?:{ORDINALS}|quáter))?(?:,?\s*letra\s+[a-zñ]\s*\)?)?)", 1), F.lit("")))


def severity(c: Column) -> Column:
    """Of the infringement named: the typification counts before a bare adjective."""
    word = F.lower(F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in (r"(?iuU)tipificad[ao]s?\s+como\s+(muy\s+grave|grave|leve)", r"(?iuU)infracci[oó]n(?:es)?\s+(?:continuada\s*,?\s*)?(muy\s+grave|grave|leve)")]))
    return F.when(word.startswith("muy"), "VERY_SERIOUS").when(word == "grave", "SERIOUS").when(word == "leve", "MINOR").otherwise("UNKNOWN")


def sanction_type(c: Column) -> Column:
    t = F.regexp_replace(F.lower(F.trim(c)), r"(?u)^(?:(?:una?|dos|tres|la|las|los|de)\s+)*(?:sanci[oó]n(?:es)?\s+(?:de|consistente\s+en)\s+)?(?:una?\s+)?", "")
    return (
        F.when(t.startswith("multa"), "MONETARY_FINE")
        .when(t.rlike(r"^(?:restituci|comiso|confiscaci)"), "DISGORGEMENT")
        .when(t.startswith("amonestaci"), "PUBLIC_REPRIMAND")
        .when(t.startswith("suspensi"), "SUSPENSION")
        .when(t.rlike(r"^(?:inhabilitaci|separaci)"), "DISQUALIFICATION")
        .otherwise("UNKNOWN")
    )


# Marks of who a respondent is, for this and for the grammar's plain Python; both regular dialects read them.
ANONYMOUS = r"(?i)an[oó]nim|se\s+preserva\s+su\s+identidad|no\s+se\s+identifica"
PERSON = r"(?i)^\s*(?:don|doña|dña|d\.)(?:\s+|$)"
#: An abbreviation of a legal form at the end, in any case; or one in capitals, or a word for a company, anywhere.
COMPANY_END = r"(?i)(?<!\w)(?:S\.?\s?A\.?U?|S\.?\s?L\.?U?|SGIIC|SGEIC|SGECR|SICAV|SV|AV|EAFI?|Limited|Ltd)\.?\)?$"
COMPANY_WORD = r"(?<!\w)(?:S\.?\s?A\.?U?|S\.?\s?L\.?U?|SGIIC|SGEIC|SGECR|SGR|FCR|SICAV|SIM|SV|AV|EAFI?|(?i:Banco|Bank|Limited|Ltd|Fondos?|Gestora|Sucursal|Cartera|Caja))(?!\w)"


def respondent_type(c: Column) -> Column:
    """Anonymised before person before entity."""
    has = lambda text, pattern: text.rlike("(?U)" + pattern)
    return (
        F.when(has(c, ANONYMOUS), "ANONYMIZED_PERSON").when(has(c, PERSON), "NATURAL_PERSON")
        .when(has(F.regexp_replace(c, r"[ .]+$", ""), COMPANY_END) | has(c, COMPANY_WORD), "LEGAL_PERSON").otherwise("UNKNOWN")
    )


def appeal_status(retrieval: Column, kinds: Column) -> Column:
    """Three-valued: unseen or unreadable is inconclusive, never a negative."""
    family = F.array(*[F.lit(x) for x in ("APPEAL_NOTICE", "JUDICIAL_APPEAL", "JUDGMENT")])
    return (
        F.when(retrieval.isNull() | (retrieval != "OK"), "INCONCLUSIVE")
        .when(F.arrays_overlap(F.coalesce(kinds, F.array().cast("array<string>")), family), "OBSERVED")
        .otherwise("NOT_OBSERVED_WITHIN_VERIFIED_COVERAGE")
    )


def assess(found: Column, retrievable: Column, complete: Column) -> Column:
    return F.when(found, "OBSERVED").when(~retrievable, "UNAVAILABLE").when(complete, "NOT_OBSERVED_WITHIN_VERIFIED_COVERAGE").otherwise("INCONCLUSIVE")
