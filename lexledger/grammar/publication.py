"""Grammar of sanction publications: XML bytes to a nested record, one document at a time.

The text of a publication is a list of paragraphs, cut into *lines* at embedded list items. A line is normalised and
handed to the rules in ``Reader.RULES``; the first rule that takes it changes the reader's state: open block, subjects
in force, declared responsibilities, successor scope. Lines that look operative and that no rule takes are issues.
Pure Python without Spark; the Arrow UDF around it is in udf.py.
"""

from __future__ import annotations

import hashlib
import html
import re
import xml.etree.ElementTree as ET
from functools import lru_cache

from lexledger.functions.dates import MONTHS
from lexledger.functions.legal import COMPANY_END, ORDINALS, STATUTES
from lexledger.functions.numbers import COUNTS
from lexledger.functions.numbers import amounts_of as amounts

I = re.IGNORECASE | re.DOTALL  # noqa: E741
MARK = r"«\"'\-–—−•·●‘’‚„“”"
LEAD = rf"^(?:[{MARK}\s]|(?:\d{{1,2}}|[a-zñ]|[ivx]{{1,3}})\s*[.)](?!\d)\s*)*"
COUNT = "|".join(COUNTS)
KIND = r"(?:sanci[oó]n(?:es)?|multas?|inhabilitaci[oó]n(?:es)?|amonestaci[oó]n(?:es)?|suspensi[oó]n(?:es)?|separaci[oó]n(?:es)?|confiscaci[oó]n(?:es)?|comiso|restituci[oó]n(?:es)?)"
OFFENCE = re.compile(rf"por\s+la\s+comisi[oó]n\s*,?\s*(?:(?:cada\s+un[oa]\s+de\s+ell[oa]s|respectivamente|(?:en|como|por)\s+[^,]{{1,110}})\s*,?\s*)?de\s+(?P<count>{COUNT}|\d{{1,2}})\s+infracci[oó]n(?:es)?", I)
ARTICLE = re.compile(rf"art[ií]culos?\s+(?P<a>\d{{1,3}}(?:\.[a-zñ0-9]{{1,3}})*(?:\s+(?:{ORDINALS}|qu[aá]ter|[b-df-hj-np-tv-xzñ](?![a-záéíóúñ])))*(?:\s+\d(?:\.[a-zñ])?)?(?:\s*,?\s*letra\s+[a-zñ]\s*\)?\s*(?:bis|ter|qu[aá]ter)?)?)", re.IGNORECASE)
CONDUCT = re.compile(r"[,;.]\s*(?:y\s+)?(?:por\s+(?!la\s+que|el\s+que|l[ao]s\s+que|lo\s+que|tanto\b|ello\b|importe)|al\s+(?=haber|no\b|[a-zñ]+r\b))", I)
ZONE = re.compile(rf"(?:[,;:.]\s*|\s)(?:(?:de\s+|la\s+|las\s+|los\s+)?(?:siguientes?\s+)?(?:{COUNT}|\d{{1,2}})?\s*)(?={KIND}\b(?!\s+(?:impuesta|prevista)))", I)
CLAUSE = re.compile(rf"(?:[,;.:]\s*(?:y\s+)?|\s+y\s+)(?:[a-zñ]\)\s*)?(?=(?:(?:{COUNT}|\d+)\s+|de\s+|la\s+|las\s+)*{KIND}\b)", I)
DURATION = re.compile(r"por\s+(?:un\s+)?(?:plazo|per[ií]odo|tiempo)\s+de\s+([^,.;»]{2,60})", re.IGNORECASE)
SUCCESSOR = re.compile(r",?\s*como\s+sucesor[a-z]*\s+en\s+la\s+responsabilidad\s+declarad[ao]\s+de\s*(?P<name>[^:]*?)\s*(?=:|,\s*(?:una\b|\d)|\.?\s*$)", I)
PERSON = re.compile(r"^(?:don|doña|dña|d\.)\s+", re.IGNORECASE)
COMPANY = re.compile(COMPANY_END)
ROLE = re.compile(r",\s*(?=(?:en\s+su\s+(?:calidad|condici[oó]n)\s+de|como\s+(?:consejer|administrador|director|president|apoderad)|consejer|administrador|director|president|secretari|apoderad|miembros?\b|directiv))", re.IGNORECASE)
DATE = re.compile(r"(\d{1,2})\s+de\s+(" + "|".join(MONTHS) + r")\s+de\s+(\d{4})", re.IGNORECASE)
FLAGS = {
    "administrative_finality_observed": r"firmes?\s+en\s+(?:dicha\s+)?v[ií]a|firme\s+a\s+todos\s+los\s+efectos",
    "judicial_review_mentioned": r"revisi[oó]n\s+jurisdiccional|contencioso-administrativo",
    "administrative_appeal_observed": r"interpuesto\s+recurso\s+de\s+(?:alzada|reposici[oó]n)|recurso\s+extraordinario\s+de\s+revisi[oó]n",
    "renunciation_observed": r"habi[ée]ndose\s+renunciado|renunciado\s+a(?:l\b|\s+interponer|\s+los\b)",
}
LATER = re.compile(r"\b(?:revoca|rectifica|corrige|correcci[oó]n\s+de\s+err|deja\s+sin\s+efecto|anula)", re.IGNORECASE)


IC = re.IGNORECASE
LAWS = [(re.compile(p, IC), name) for p, name in STATUTES]
TYPIFIED = re.compile(r"tipificad[ao]s?\s+como\s+(muy\s+grave|grave|leve)", IC)
ADJECTIVE = re.compile(r"^\W*(?:continuada\s*,?\s*)?(muy\s+grave|grave|leve)", IC)
ARTICLE_FORM = re.compile(rf"\d{{1,3}}(?:\.(?:\d{{1,3}}|[a-zñ]|{ORDINALS}))*")
BEFORE_KIND = re.compile(rf"^(?:(?:{COUNT}|\d+|la|las|los|de)\s+)*(?:sanci[oó]n(?:es)?\s*(?:,[^,]*,\s*)?(?:de|consistente\s+en)\s+)?(?:una?\s+)?")
KINDS = {"MONETARY_FINE": ("multa",), "DISGORGEMENT": ("restituci", "comiso", "confiscaci"), "PUBLIC_REPRIMAND": ("amonestaci",), "SUSPENSION": ("suspensi",), "DISQUALIFICATION": ("inhabilitaci", "separaci")}
RELATED = re.compile(r"en\s+relaci[oó]n\s+con", IC)
A_KIND = re.compile(KIND, IC)
BARE_ZONE = re.compile(r"(?:las?\s+)?(?:siguientes?\s+)?sanci[oó]n(?:es)?(?:\s+siguientes?)?:?", IC)
SO_MANY = re.compile(rf"(?:de\s+|las?\s+)?({COUNT}|\d{{1,2}})\s+(?=multas|sanciones|inhabilitaciones|suspensiones)", IC)
KIND_OR_EUROS = re.compile(rf"(?:,\s*|\s)(?:(?:{COUNT}|la|las|los)\s+)?{KIND}\b|\d[\d.]*\s*(?:de\s+)?euros?\b", IC)
DECLARE = re.compile(LEAD + r"Declarar\s+(?:que\s+(?P<a>.+?)\s+ha\s+incurrido\s+en\s+la\s+comisi[oó]n|la\s+responsabilidad\s+del?\s+(?P<b>.+?)\s*,?\s*por\s+la\s+comisi[oó]n)", I)
DECLARE_LIST = re.compile(LEAD + r"Declarar\s+la\s+responsabilidad\s+del?\s+(.+?)\s*,?\s*por\s*:?\s*$", I)
IMPOSE = re.compile(LEAD + r"Imponer\s+(?:a\s+)?(.*)$", I)
NUMBERED = re.compile(LEAD + r"A\s+(.+?)\s*,?\s*(?=por\s+la\s+comisi[oó]n)", I)
SCOPE = re.compile(LEAD + r"Como\s+sucesor[a-z]*\s+en\s+la\s+responsabilidad\s+declarad[ao]\s+de\s+(.+?)\s*,?\s*por\s*:?\s*$", I)
OWN_SCOPE = re.compile(LEAD + r"Como\s+responsables?\s+de\s*:?\s*$", I)
AND_FOR = re.compile(LEAD + r"Y\s+(?:por|de)\s+la\s+comisi[oó]n", IC)
FOR_OFFENCE = re.compile(LEAD + r"por\s+la\s+comisi[oó]n\b", I)
BARE_SUCCESSOR = re.compile(r"^([A-ZÁÉÍÓÚÑ][^.,;]{2,80}?)\s*,\s*((?:una\s+)?multa\b.*)$", I)
LISTED = re.compile(rf"^[{MARK}]")
FINE_LISTED = re.compile(rf"\b{KIND}\b.*\beuros\b", I)
LINES = re.compile(rf"(?<=[.;:,»])\s+(?=(?:[{MARK}]\s*|[a-h]\)\s*|\d{{1,2}}[.)]\s*)(?:Imponer|Por\s+la\s+comisi|Una?\s+(?:multa|sanci)|A\s+[A-ZÁÉÍÓÚÑd]|Multa|Declarar))")
BARE_OFFENCE = re.compile(rf"^({LEAD[1:]})(?:La\s+comisi[oó]n\s+de\s+(?=(?:{COUNT})\b)|De\s+(?=una\s+infracci))", IC)
AS_RESPONSIBLE = re.compile(r"como\s+responsables?\s+de\s+la\s+comisi[oó]n(?=\s+de\b)", IC)
WITHOUT_THE = re.compile(r"\bpor\s+comisi[oó]n(?=\s+de\b)", IC)
LETTER_FIRST = re.compile(rf"letra\s+([a-zñ](?:\s+(?:{ORDINALS}|qu[aá]ter))?)\s*\)\s*(?:del?\s+)?art[ií]culo\s+(\d+(?:\.\d+)*)", IC)
#: Over lower case, what the three before must have; letters with odd forms in other cases (i, k, s) are not asked for.
MAY_LACK_THE, MAY_BE_LETTER_FIRST = re.compile(r"por\s+com"), re.compile(r"letra\s+[^)]*\)\s*(?:del?\s+)?art")
RESOLUTION = re.compile(r"Resoluci[oó]n(?:es)?\s+(?:del\s+Consejo[^.;]{0,90}?\s+)?de\s+(?:fecha\s+)?(\d{1,2}\s+de\s+[a-zñ]+\s+de\s+\d{4}(?:\s+y\s+\d{1,2}\s+de\s+[a-zñ]+\s+de\s+\d{4})?)", IC)
ORDER = re.compile(r"Orden\s+ministerial\s+de\s+(?:fecha\s+)?(\d{1,2}\s+de\s+[a-zñ]+\s+de\s+\d{4})", IC)
#: Each flag's pattern with parts of words of which, in lower case, one must be there.
FLAGGED = {k: (re.compile(FLAGS[k], IC), parts) for k, parts in {"administrative_finality_observed": ("rme",), "judicial_review_mentioned": ("onal", "contenc"), "administrative_appeal_observed": ("recur",), "renunciation_observed": ("renunc",)}.items()}
#: How kinds of sanctions and euros begin, in lower case; letters that others are taken for in any case.
STEMS, ODD = re.compile("sanci|multa|inhab|amone|suspe|separ|confi|comiso|resti|euro"), "ſKİı"
#: Publications say most things in set phrases: what depends on a phrase alone is worked out once in a worker, the latest
#: PHRASES of each kind are remembered.
PHRASES = 4096


def squeeze(text: str) -> str:
    return " ".join(html.unescape(text).split())


def find(pattern: re.Pattern, text: str, begin: str, at: int = 0):
    """pattern.search(text, at) for a pattern that begins with ``begin``, letters of one form in each case: tried only there."""
    low = text.lower()
    if len(low) != len(text):  # places differ
        return pattern.search(text, at)
    at = low.find(begin, at)
    while at >= 0:
        if m := pattern.match(text, at):
            return m
        at = low.find(begin, at + 1)
    return None


def near_kind(pattern: re.Pattern, text: str, at: int = 0):
    """pattern.search(text, at) for a pattern whose match has a kind of sanction or "euros" behind three words at most: tried
    from six words before the first of them."""
    low = text.lower()
    if len(low) != len(text) or any(c in text for c in ODD):
        return pattern.search(text, at)
    m = STEMS.search(low, at)
    if m is None:
        return None
    words = low[: m.start()].rsplit(None, 6)
    return pattern.search(text, max(at, len(words[0]) if len(words) == 7 else 0))


@lru_cache(PHRASES)
def statute(text: str) -> str | None:
    for p, name in LAWS:
        if m := p.search(text):
            return name + m[1]
    return None


@lru_cache(PHRASES)
def article(raw: str) -> str | None:
    t = raw.lower().strip().translate(str.maketrans("áéíóú", "aeiou"))
    t = re.sub(r"[)\s]+$", "", re.sub(r"[,.]?\s*letras?\s+", ".", t)).replace(")", "")
    t = re.sub(r"\.+", ".", re.sub(rf"\s+(?=(?:{ORDINALS}|\d+|[a-zñ])\b)", ".", t)).replace(" ", "")
    return t if ARTICLE_FORM.fullmatch(t) else None


def severity(text: str) -> str:
    m = ("como" in text.lower() and TYPIFIED.search(text)) or ADJECTIVE.match(text)
    word = re.sub(r"\s+", " ", m[1].lower()) if m else ""
    return {"muy grave": "VERY_SERIOUS", "grave": "SERIOUS", "leve": "MINOR"}.get(word, "UNKNOWN")


@lru_cache(PHRASES)
def sanction_type(text: str) -> str:
    t = BEFORE_KIND.sub("", text.strip().lower())
    for kind, stems in KINDS.items():
        if t.startswith(stems):
            return kind
    return "MONETARY_FINE" if re.match(r"\d", t) and amounts(t) else "UNKNOWN"


@lru_cache(PHRASES)
def day_of(stamp: str) -> str | None:
    """The day of a stamp that begins with eight digits."""
    iso = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}"
    return iso if re.fullmatch(r"\d{8}.*", stamp) and valid_date(iso) else None


def dates_in(text: str) -> list[str]:
    out = []
    for d, m, y in DATE.findall(text):
        iso = f"{int(y):04d}-{MONTHS[m.lower()]:02d}-{int(d):02d}"
        if valid_date(iso):
            out.append(iso)
    return out


@lru_cache(PHRASES)
def valid_date(iso: str) -> bool:
    from datetime import date

    try:
        date.fromisoformat(iso)
    except ValueError:
        return False
    return True


@lru_cache(PHRASES)
def conduct_period(text: str) -> tuple[str | None, str | None, str | None]:
    """(first day, last day, precision): dates that don't belong to an instrument, else the years named."""
    named = r"(?:Ley|Decreto|Reglamento|Circular|Orden|Directiva|BOE)[^.;]{0,120}$"
    days: list[str] = []
    for m in re.finditer(r"((?:\d{1,2}(?:\s+de\s+[a-zñ]+)?\s*(?:,|y)\s*(?:el\s+)?)*\d{1,2})\s+(?:de\s+)?(" + "|".join(MONTHS) + r")\s+de\s+(\d{4})", text, re.IGNORECASE):
        if re.search(named, text[max(0, m.start() - 120) : m.start()], re.IGNORECASE):
            continue
        month = m[2].lower()
        for day, own in reversed(re.findall(r"(\d{1,2})(?:\s+de\s+([a-zñ]+))?", m[1] + f" de {month}")):
            month = own.lower() if own.lower() in MONTHS else month
            iso = f"{int(m[3]):04d}-{MONTHS[month]:02d}-{int(day):02d}"
            if valid_date(iso):
                days.append(iso)
    lead = [m for m in re.finditer(r"entre\s+el\s+(\d{1,2})\s+de\s+([a-zñ]+)\s+y\s+el\s+\d{1,2}\s+de\s+[a-zñ]+\s+de\s+(\d{4})", text, re.IGNORECASE) if m[2].lower() in MONTHS]
    days += [f"{int(m[3]):04d}-{MONTHS[m[2].lower()]:02d}-{int(m[1]):02d}" for m in lead]
    if days := [d for d in days if valid_date(d)]:
        return min(days), max(days), "day"
    years = [m[1] for m in re.finditer(r"\b((?:19|20)\d{2})\b(?!\s*/)", text) if not re.search(named, text[max(0, m.start() - 80) : m.start()], re.IGNORECASE) and text[max(0, m.start() - 1)] != "/"]
    return (f"{min(years)}-01-01", f"{max(years)}-12-31", "year") if years else (None, None, None)


def _mask(text: str) -> str:
    """Parentheses and quotations blotted out, length kept."""
    return re.sub(r"\([^()]*\)|«[^»]*»|“[^”]*”|\"[^\"]*\"", lambda m: "\x01" * len(m[0]), text)


def split_subjects(raw: str) -> list[str]:
    """The names of a list of subjects; "y" inside a company's name stays."""
    return list(_subjects(raw))


@lru_cache(PHRASES)
def _subjects(raw: str) -> tuple[str, ...]:
    text = re.sub(r"^(?:a\s+)?(?:cada\s+un[oa]\s+de\s+(?:los|las)\s+siguientes\s*:?\s*)?", "", raw.strip(" ,;:."), flags=re.IGNORECASE)
    masked, cuts = _mask(text), []
    for m in re.finditer(r"(?:,\s*|;\s*)?\s+y\s+(?:a\s+)?|[,;]\s*(?:a\s+)?", masked, re.IGNORECASE):
        left, right = masked[: m.start()], masked[m.end() :]
        starts = re.match(r"(?:don|doña|dña|d\.)\s|su\s+\w|sus\s+\w|la\s+entidad\s", right, re.IGNORECASE)
        company = COMPANY.search(left.rstrip(" ,").replace("\x01", "").rstrip(" ,")) and re.match(r"[A-ZÁÉÍÓÚÑ]", right) and not COMPANY.fullmatch(re.split(r"[,;]|\sy\s", right)[0].strip())
        if starts and re.match(r"\s*sus?\s", masked[cuts[-1][1] if cuts else 0 : m.start()], re.IGNORECASE):
            continue
        again = re.search(r"\sa\s+$", m[0], re.IGNORECASE) and re.match(r"[A-ZÁÉÍÓÚÑ]", right)
        if (starts and not re.match(r"(?:consejer|administrador)", right, re.IGNORECASE)) or company or again:
            cuts.append((m.start(), m.end()))
    parts, at = [], 0
    for a, b in cuts:
        parts.append(text[at:a])
        at = b
    parts.append(text[at:])
    return tuple(p for p in (re.sub(r"^(?:a\s+)?(?:la\s+entidad\s+)?", "", p.strip(" ,;:."), flags=re.IGNORECASE) for p in parts) if p)


@lru_cache(PHRASES)
def split_role(subject: str) -> tuple[str, str | None]:
    """(name, role): a role in brackets, before the name, or after a comma."""
    if m := re.fullmatch(r"(.+?)\s*\(([^()]*(?:consejer|director|administrador|president|secretari|apoderad)[^()]*)\)\s*", subject, I):
        return m[1].strip(), m[2].strip()
    if m := re.fullmatch(r"(sus?\s+[^,]+?),?\s+((?:don|doña|dña|d\.)\s.+)", subject, I):
        return m[2].strip(), m[1].strip()
    if m := ROLE.search(subject):
        return subject[: m.start()].strip(), subject[m.end() :].strip()
    return subject.strip(), None


def strip_successor(subject: str) -> tuple[str, str | None]:
    m = "uce" in subject.lower() and SUCCESSOR.search(subject)
    return (subject[: m.start()].strip(" ,"), m["name"].strip(" ,.") or None) if m else (subject, None)


def related_refs(text: str, own: str | None) -> list[dict]:
    """Provisions named "en relación con": lists of articles with the instrument that follows them."""
    out = []
    for part in re.split(r"en\s+relaci[oó]n\s+con\s+", text, flags=re.IGNORECASE)[1:]:
        part = CONDUCT.split(part)[0]
        for m in re.finditer(r"art[ií]culos?\s+((?:\d{1,3}[^\s,;]*(?:\s*,?\s*letra\s+[a-zñ]\))?(?:\s*,\s*|\s+y\s+)?)+)(.*?)(?=art[ií]culos?\s|$)", part, I):
            after = m[2]
            law = own if re.match(r"\s*(?:,\s*)?(?:todos\s+)?(?:del?|de\s+la)\s+(?:mism[oa]|citad[oa]|dich[oa])", after, re.IGNORECASE) else statute(after) or own
            for raw in re.split(r"\s*,\s*(?!letra)|\s+y\s+", m[1].strip(" ,")):
                if raw and (a := article(raw)):
                    out.append({"statute_raw": squeeze(after)[:120], "article_raw": raw, "statute": law, "article": a})
    return out


@lru_cache(PHRASES)
def typified(typed: str) -> tuple:
    """(statute_raw, statute, article_raw, article, related provisions) of what typifies an offence."""
    head = RELATED.split(typed)[0]
    a = ARTICLE.search(head)
    rest = head[a.end() :] if a else head
    law = statute(rest)
    return squeeze(rest)[:200], law, a["a"].strip() if a else None, article(a["a"]) if a else None, tuple(related_refs(typed, law))


class Reader:
    """The state of reading one publication."""

    def __init__(self):
        self.blocks: list[dict] = []
        self.issues: list[dict] = []
        self.underlying: list[str] = []
        self.current: dict | None = None
        self.context: list[str] = []
        self.declared: dict[str, list[int]] = {}
        self.declaring: str | None = None
        self.scope: list[int] = []
        self.scope_at = 0
        self.list_successor: str | None = None
        self.ordinal = 0

    # -- building ------------------------------------------------------------------------------------------------------

    def block(self, place: int, text: str, subjects: list[str], declared: bool = False) -> dict:
        m = find(OFFENCE, text, "por")
        rest = text[m.end() :] if m else text
        zone = self.zone(rest)
        body = rest[: zone.start()] if zone else rest
        tail = rest[zone.start() :] if zone else ""
        cut = CONDUCT.search(body)
        typed, conduct = (body[: cut.start()], body[cut.start() :]) if cut else (body, "")
        statute_raw, law, article_raw, norm, related = typified(typed)
        start, end, precision = conduct_period(conduct)
        b = {
            "ordinal": len(self.blocks) + 1, "paragraph": place, "header": text[:500], "severity": severity(rest), "statute_raw": statute_raw, "statute": law,
            "article_raw": article_raw, "article": norm, "related": [dict(r) for r in related], "conduct": squeeze(conduct.strip(" ,.;:")) or None,
            "conduct_start": start, "conduct_end": end, "conduct_precision": precision, "subjects": subjects, "sanctions": [], "declared": declared, "declared_for": None,
        }
        self.blocks.append(b)
        self.current = b
        if tail and not declared:
            self.tail(place, tail, subjects)
        n = (COUNTS.get(m["count"].lower()) or int(m["count"])) if m else 1
        if n > 1 and not declared:
            # So many offences with as many sanctions are blocks of one each; else one block has what there is.
            if len(b["sanctions"]) == n:
                first, *more = b["sanctions"]
                b["sanctions"] = [first]
                for s in more:
                    self.blocks.append(b | {"ordinal": len(self.blocks) + 1, "sanctions": [s]})
                self.current = self.blocks[-1]
            else:
                self.issues.append({"kind": "OFFENCES_AND_SANCTIONS_DIFFER", "detail": f"p[{place}] {n} offences, {len(b['sanctions'])} sanctions"})
        return b

    @staticmethod
    def zone(rest: str):
        """Where the sanction clause begins: a kind of sanction after the typification."""
        typed = find(ARTICLE, rest, "art")
        at = typed.end() if typed else 0
        return near_kind(ZONE, rest, at) or (near_kind(ZONE, rest) if not typed else None)

    def sanction(self, place: int, text: str, subject: str, amount=None, declared: str | None = None) -> None:
        name, predecessor = strip_successor(subject)
        value = amount if amount is not None else next(iter(amounts(text)), None)
        kind = sanction_type(text)
        self.ordinal += 1
        d = find(DURATION, text, "por")
        fine = kind in ("MONETARY_FINE", "UNKNOWN", "DISGORGEMENT") and value is not None
        self.current["sanctions"].append({
            "subject": name, "text": squeeze(text)[:500], "type": "MONETARY_FINE" if kind == "UNKNOWN" and fine else kind, "amount": value[0] if fine else None, "currency": "EUR" if fine else None,
            "amount_raw": value[1] if fine else None, "duration_raw": d[1].strip() if d else None, "paragraph": place, "ordinal": self.ordinal, "declared_subject": declared or predecessor,
        })

    def tail(self, place: int, text: str, subjects: list[str]) -> None:
        """Clauses of a sanction zone, times the subjects; "respectivamente" pairs them in order."""
        for clause in CLAUSE.split(text):
            clause = clause.strip(" ,.;:»")
            if not clause or not (A_KIND.search(clause) or amounts(clause)) or BARE_ZONE.fullmatch(clause):
                continue
            found = amounts(clause)
            if "respectivamente" in clause.lower() and len(found) > 1 and subjects:
                for k, value in enumerate(found):
                    self.sanction(place, clause, subjects[min(k, len(subjects) - 1)], value)
                continue
            m = SO_MANY.match(clause)
            n = (COUNTS.get(m[1].lower()) or int(m[1])) if m else 1
            each = n // len(subjects) if subjects and n % len(subjects) == 0 else n
            for who in subjects or [""]:
                for k in range(max(1, each)):
                    self.sanction(place, clause, who, found[k] if len(found) == each and each > 1 else None)

    def scoped(self) -> int | None:
        if not self.scope:
            return None
        k = self.scope[min(self.scope_at, len(self.scope) - 1)]
        self.scope_at += 1
        return k

    # -- rules: each returns True if it took the line ----------------------------------------------------------------

    def declare(self, place: int, line: str) -> bool:
        m = DECLARE.match(line)
        if not m:
            return False
        name = (m["a"] or m["b"]).strip(" ,")
        offence = line if OFFENCE.search(line) else re.sub(r"en\s+la\s+comisi[oó]n", "por la comisión", line, count=1, flags=re.IGNORECASE)
        for who in split_subjects(name):
            b = self.block(place, offence, [who], declared=True)
            self.declared.setdefault(who.lower().strip(), []).append(b["ordinal"])
        return True

    def declare_list(self, place: int, line: str) -> bool:
        m = DECLARE_LIST.match(line)
        if m:
            self.declaring, self.context, self.current = m[1].strip(" ,").lower(), split_subjects(m[1]), None
        return bool(m)

    def impose(self, place: int, line: str) -> bool:
        m = IMPOSE.match(line)
        if not m:
            return False
        self.declaring, self.scope, self.scope_at, self.list_successor = None, [], 0, None
        rest = m[1]
        offence, kind = find(OFFENCE, rest, "por"), near_kind(KIND_OR_EUROS, rest)
        if not offence and not kind:
            name, before = strip_successor(rest.rstrip(" :.,"))
            self.context, self.current = split_subjects(name), None
            if before:
                self.scope = self.declared.get(before.lower(), [])
            elif SUCCESSOR.search(rest) or re.search(r"declarad[ao]\s+de\s*:?\s*$", rest, re.IGNORECASE):
                self.list_successor = name
            return True
        if not offence:
            subjects = split_subjects(rest[: kind.start()])
            self.context = subjects
            self.block(place, "", subjects)
            self.current["header"] = line[:500]
            self.tail(place, rest[kind.start() :], subjects)
            return True
        stop = min(offence.start(), kind.start()) if kind and kind.start() < offence.start() else offence.start()
        name, before = strip_successor(rest[:stop].rstrip(" ,"))
        subjects = split_subjects(name)
        self.context = subjects
        b = self.block(place, rest[offence.start() :], subjects)
        if before and (known := self.declared.get(before.lower())):
            b["declared_for"] = known[-1]
        if stop < offence.start() and not b["sanctions"]:
            found = amounts(rest[offence.end() :])[-1:]
            text = rest[stop : offence.start()].strip(" ,")
            for who in subjects or [""]:
                self.sanction(place, text, who, (amounts(text) or found or [None])[0])
        return True

    def numbered(self, place: int, line: str) -> bool:
        m = NUMBERED.match(line)
        if not m or not OFFENCE.search(line):
            return False
        self.context = split_subjects(m[1])
        self.block(place, line[m.end() :], self.context)
        return True

    def scope_line(self, place: int, line: str) -> bool:
        if m := SCOPE.match(line):
            self.scope, self.scope_at = self.declared.get(m[1].strip(" ,").lower(), []), 0
            return True
        if OWN_SCOPE.match(line):
            self.scope, self.scope_at = [k for c in self.context for k in self.declared.get(c.lower(), [])], 0
            return True
        return False

    def offence(self, place: int, line: str) -> bool:
        line = AND_FOR.sub("Por la comisión", line) if AND_FOR.match(line) else line
        if not FOR_OFFENCE.match(line) or not OFFENCE.search(line):
            return False
        b = self.block(place, line, list(self.context), declared=self.declaring is not None)
        if self.declaring is not None:
            self.declared.setdefault(self.declaring, []).append(b["ordinal"])
        else:
            b["declared_for"] = self.scoped()
        return True

    def bare_successor(self, place: int, line: str) -> bool:
        m = self.list_successor is not None and BARE_SUCCESSOR.match(line)
        if not m:
            return False
        known = self.declared.get(m[1].strip().lower())
        b = self.block(place, "", [self.list_successor])
        b["declared_for"] = known[-1] if known else None
        self.sanction(place, m[2], self.list_successor, declared=m[1].strip())
        return True

    def without_block(self, place: int, line: str) -> bool:
        if self.current is not None:
            return False
        if LISTED.match(line) and FINE_LISTED.search(line):
            self.issues.append({"kind": "SANCTION_WITHOUT_BLOCK", "detail": f"p[{place}] {line[:200]}"})
        return True

    def amount_for_predecessor(self, place: int, line: str) -> bool:
        m = re.match(LEAD + r"(\d[\d.]*(?:,\d+)?\s*(?:de\s+)?euros?.*?),?\s*como\s+sucesor[a-z]*\s+en\s+la\s+responsabilidad\s+declarad[ao]\s+de\s+(.+?)[.»\s]*$", line, I)
        if not m:
            return False
        for who in self.context or self.current["subjects"] or [""]:
            self.sanction(place, m[1], who, declared=m[2].strip())
        return True

    def fine_line(self, place: int, line: str) -> bool:
        if not re.match(LEAD + rf"(?:(?:una|la|las|{COUNT})\s+)?{KIND}\b", line, I):
            return False
        masked = _mask(line)
        m = re.search(r"\s+a\s+((?:don|doña|d\.|dña|la\s+entidad|cada\s+un[oa]|[A-ZÁÉÍÓÚÑ])[^;]{2,90}?)[.,;»\s]*$", masked)
        text, subjects = line, self.current["subjects"] or self.context
        if m and not amounts(line[m.start() :]):
            text = line[: m.start()]
            if not re.match(r"cada\s+un", m[1], re.IGNORECASE):
                subjects = split_subjects(line[m.start(1) : m.end(1)])
        before = len(self.current["sanctions"])
        self.tail(place, re.sub(LEAD, "", text), subjects)
        return len(self.current["sanctions"]) > before

    def subject_first(self, place: int, line: str) -> bool:
        m = re.match(LEAD + rf"A\s+(?P<s>.+?)\s*[,:]?\s*(?P<t>(?:(?:{COUNT}|la|las)\s+)?{KIND}\b.*|por\s+importe\s+de.*|\d[\d.]*(?:,\d+)?\s*(?:\([^)]*\)\s*)?(?:de\s+)?euros?.*)$", line, I)
        if not m:
            return False
        self.tail(place, m["t"] if re.match(rf"(?:(?:{COUNT}|la|las)\s+)?{KIND}", m["t"], re.IGNORECASE) else f"multa {m['t']}", split_subjects(m["s"]))
        return True

    def other_resolution(self, place: int, line: str) -> bool:
        m = re.match(LEAD + r"((?:Resoluci[oó]n|Orden|Acuerdo)\b.*|Declarar\s+(?:que|al?|la)\b.*)$", line, I)
        if m:
            self.underlying.append(squeeze(m[1])[:300])
        return bool(m)

    def conduct_item(self, place: int, line: str) -> bool:
        if not re.match(rf"^(?:[a-zñ]\)|[ivx]{{1,3}}\)|[{MARK}])\s*", line) or re.search(rf"{KIND}|\beuros?\b", line, re.IGNORECASE):
            return False
        b = self.current
        b["conduct"] = squeeze(f"{b['conduct'] or ''} {line}")
        start, end, precision = conduct_period(line)
        if start:
            b["conduct_start"] = min(filter(None, (b["conduct_start"], start)))
            b["conduct_end"] = max(filter(None, (b["conduct_end"], end)))
            b["conduct_precision"] = b["conduct_precision"] or precision
        return True

    def unread(self, place: int, line: str) -> bool:
        if re.match(rf"^(?:[{MARK}]|\d{{1,2}}\s*[.)]|[a-zñ]\))", line):
            self.issues.append({"kind": "UNREAD_LINE", "detail": f"p[{place}] {line[:200]}"})
        return True

    RULES = [declare, declare_list, impose, numbered, scope_line, offence, bare_successor, without_block, amount_for_predecessor, fine_line, subject_first, other_resolution, conduct_item, unread]

    def read(self, place: int, text: str) -> None:
        for line in LINES.split(text):
            line = self.normal(line.strip())
            if line:
                next(rule for rule in self.RULES if rule(self, place, line))

    @staticmethod
    def normal(line: str) -> str:
        if BARE_OFFENCE.match(line):
            line = BARE_OFFENCE.sub(r"\1Por la comisión de ", line)
        low = line.lower()
        if "pon" in low:
            line = AS_RESPONSIBLE.sub("por la comisión", line)
        if MAY_LACK_THE.search(low):
            line = WITHOUT_THE.sub("por la comisión", line)
        line = re.sub(r"(?<=[a-záéíóú])-\s?(?=lo\b|los\b|culo)", "", line) if "artícu-" in line else line
        return LETTER_FIRST.sub(r"artículo \2, letra \1)", line) if MAY_BE_LETTER_FIRST.search(line.lower()) else line

    def finish(self, preamble: str) -> None:
        """Instruments left open: from the related provisions, the preamble's same article, or the block before."""
        last = None
        for b in self.blocks:
            if b["statute"] is None and b["article"]:
                near = re.search(rf"art[ií]culo\s+{re.escape(b['article_raw'] or '')}(.{{0,160}})", preamble, I)
                b["statute"] = (statute(near[1]) if near else None) or next((r["statute"] for r in b["related"] if r["statute"]), None) or last
            last = b["statute"] or last


def parse(raw: bytes) -> dict:
    """The nested record of a publication; malformed XML and document types raise ValueError."""
    bare = raw.replace(b"\0", b"")  # UTF-16 too
    if b"<!DOCTYPE" in bare or b"<!ENTITY" in bare:
        raise ValueError("document types are not read")
    try:
        root = ET.fromstring(raw)
    except ET.ParseError as e:
        raise ValueError(str(e)) from None
    meta = lambda name: squeeze(root.findtext(f"metadatos/{name}") or "")
    out = {"boe_id": meta("identificador"), "title": meta("titulo"), "publication_date": day_of(meta("fecha_publicacion")), "document_date": day_of(meta("fecha_disposicion")), "raw_sha256": hashlib.sha256(raw).hexdigest()}
    body = root.find("texto")
    reader = Reader()
    if body is None:
        reader.issues.append({"kind": "NO_TEXT", "detail": out["boe_id"]})
    paragraphs = [{"index": i, "css_class": p.get("class"), "text": squeeze("".join(p.itertext()))} for i, p in enumerate(body.findall("p"))] if body is not None else []
    paragraphs = [p for p in paragraphs if p["text"]]
    whole = "\n".join(p["text"] for p in paragraphs)
    for p in paragraphs:
        reader.read(p["index"], p["text"])
    reader.finish(paragraphs[0]["text"] if paragraphs else "")
    dated = find(RESOLUTION, whole, "re") or find(ORDER, whole, "orden")
    found = dates_in(dated[1]) if dated else []
    low = whole.lower()
    return out | {
        "sanctioning_resolution_date": found[-1] if found else None,
        **{k: any(x in low for x in parts) and bool(p.search(whole)) for k, (p, parts) in FLAGGED.items()},
        "document_kind": "SUBSEQUENT_EVENT" if LATER.search(out["title"]) else "SANCTION_PUBLICATION",
        "paragraphs": paragraphs, "blocks": reader.blocks, "issues": reader.issues, "underlying": reader.underlying,
    }
