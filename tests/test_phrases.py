"""The grammar's shortcuts: phrases are worked out once, and searches that begin at known letters find what plain ones do."""

import random

from test_grammar import read

from lexledger.grammar import publication

ACT = "Imponer a Ejemplo {}, S.A., por la comisión de una infracción grave tipificada en el artículo 99, letra o), de la Ley 24/1988, en relación con los artículos 45 y 48 de la misma Ley, por no informar el 3 de marzo de 2007, una multa por importe de {}.000 euros."


def test_set_phrases_are_worked_out_once():
    publication.typified.cache_clear(), publication.conduct_period.cache_clear()
    out = [read(ACT.format(k, 10 + k)) for k in range(20)]
    assert publication.typified.cache_info().misses == 1 and publication.conduct_period.cache_info().misses == 1
    out[0]["blocks"][0]["related"][0]["article"] = "changed"
    assert [r["article"] for r in read(ACT.format(1, 5))["blocks"][0]["related"]] == ["45", "48"]
    publication.split_subjects("Uno, S.A. y Dos, S.A.").append("x")
    assert publication.split_subjects("Uno, S.A. y Dos, S.A.") == ["Uno, S.A", "Dos, S.A"]


def test_shortcuts_find_what_a_plain_search_finds():
    rng = random.Random(3)
    parts = ["por la comisión de una infracción", "POR LA COMİSIÓN DE DOS infracciones", "artículo 99.2", "ARTÍCULO 12, letra a)", "una multa", "las siguientes cuatro  sanciones", ", MULTA", "ſanción", "SANCİÓN", "de 1.000 euros", "comıso", "12 euros", "«multa»", "İ", "de", "la", ",", ".", "  "]
    for _ in range(3000):
        text = rng.choice(["", " "]).join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 9)))
        at = rng.randrange(len(text) + 1)
        span = lambda m: m and m.span()
        for pattern, begin in ((publication.OFFENCE, "por"), (publication.ARTICLE, "art"), (publication.DURATION, "por")):
            assert span(publication.find(pattern, text, begin, at)) == span(pattern.search(text, at))
        for pattern in (publication.ZONE, publication.KIND_OR_EUROS):
            assert span(publication.near_kind(pattern, text, at)) == span(pattern.search(text, at))
