"""Incremental builds beside builds at once."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lexledger.plans import maintenance
from lexledger.schemas import TABLES
from lexledger.sources import readers

AT = datetime(2024, 1, 15)
LAW = "tipificada en el artículo 99, letra o), de la Ley 24/1988, de 28 de julio"


def document(boe, company, amount, shown=None):
    text = f"Imponer a {shown or company}, S.A., por la comisión de una infracción grave {LAW}, por no informar el 3 de marzo de 2007, una multa por importe de {amount} euros."
    return (
        f"<documento><metadatos><identificador>{boe}</identificador><titulo>Resolución por la que se publica la sanción</titulo><fecha_publicacion>20080110</fecha_publicacion></metadatos>"
        f'<texto><p class="parrafo">{text}</p></texto></documento>'
    ).encode()


def files(spark, rows):
    return spark.createDataFrame([(c, f"/{c}/{b}.xml", b, document(b, who, n, shown)) for c, b, who, n, shown in rows], "corpus string, path string, boe_id string, content binary")


A, B, C, D = ("BOE-A-2008-" + str(i) for i in range(1, 5))
FIRST = [("a", A, "Uno", 100, "UNO"), ("b", B, "Uno", 200, None), ("b", A, "Otra", 5, None), ("b", C, "Dos", 300, None)]
LOOKS = "boe_id string, sha256 string, notes array<struct<kind: string, page: int, verbatim: string>>, status string, retrieval string, first_observed_at string, observed_at string"


def look(spark, *ids):
    return spark.createDataFrame([(i, "s", [("APPEAL_NOTICE", 1, "interpuesto recurso")], None, "OK", "2009-01-01", "2010-01-01") for i in ids], LOOKS)


def tables(spark, folder):
    return {k: sorted(map(str, v.collect())) for k, v in readers.ledger_tables(spark, folder).items()}


STEPS = {
    "additions, changes and withdrawals": ([(c, b, who, 999 if b == B else n, s) for c, b, who, n, s in FIRST if b != C] + [("c", D, "Tres", 7, None)], 2),
    # the winner of A goes, so the file that lost is parsed; a file before the winner of B comes, wins, and tells Uno
    "other winners": (FIRST[1:] + [("a", B, "Uno", 1, "uNO")], 2),
}


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("first"))
    assert maintenance.build(spark, files(spark, FIRST), folder, AT, observations=look(spark, A))["n_parsed"] == 3
    return folder


@pytest.mark.parametrize("step", STEPS)
def test_equal_to_a_full_build(spark, first, tmp_path, step):
    rows, parsed = STEPS[step]
    got = maintenance.build(spark, files(spark, rows), f"{tmp_path}/2", AT, previous=first, observations=look(spark, A))
    maintenance.build(spark, files(spark, rows), f"{tmp_path}/full", AT, observations=look(spark, A))
    assert got["n_parsed"] == parsed
    assert tables(spark, f"{tmp_path}/2") == tables(spark, f"{tmp_path}/full")


def test_nothing_new_and_everything_gone(spark, first, tmp_path):
    got = maintenance.build(spark, files(spark, FIRST), f"{tmp_path}/2", AT, previous=first, observations=look(spark, A))
    assert got == {"n_files": 4, "n_parsed": 0, "n_gone": 0, "n_touched": 0} and tables(spark, f"{tmp_path}/2") == tables(spark, first)
    got = maintenance.build(spark, files(spark, FIRST).limit(0), f"{tmp_path}/3", AT, previous=first)
    assert got == {"n_files": 0, "n_parsed": 0, "n_gone": 3, "n_touched": 3} and not any(tables(spark, f"{tmp_path}/3").values())


def test_new_observations_touch_their_case_only(spark, first, tmp_path):
    got = maintenance.build(spark, files(spark, FIRST), f"{tmp_path}/2", AT, previous=first, observations=look(spark, A, B))
    maintenance.build(spark, files(spark, FIRST), f"{tmp_path}/full", AT, observations=look(spark, A, B))
    assert got["n_parsed"] == 0 and got["n_touched"] == 1
    assert tables(spark, f"{tmp_path}/2") == tables(spark, f"{tmp_path}/full")


def test_rows_that_stay_keep_their_time(spark, first, tmp_path):
    maintenance.build(spark, files(spark, [(c, b, who, 999 if b == B else n, s) for c, b, who, n, s in FIRST]), f"{tmp_path}/2", datetime(2025, 1, 1), previous=first, observations=look(spark, A))
    e = readers.ledger_tables(spark, f"{tmp_path}/2")["evidence"]
    assert {(r.document_id, r.y) for r in e.select("document_id", F.year("observed_at").alias("y")).distinct().collect()} == {(A, 2024), (B, 2025), (C, 2024)}


def test_a_build_does_not_overwrite_its_own_source(spark, first):
    with pytest.raises(ValueError):
        maintenance.build(spark, files(spark, FIRST), first, AT, previous=first)


def test_every_table_has_an_owner():
    assert all(k in maintenance.OWNER or "case_id" in v or k in ("respondents", "review_items") for k, v in TABLES.items())


def test_a_first_build_keeps_its_publications_once(first):
    import os

    state = os.listdir(f"{first}/state")
    assert "parsed" in state and "parsed_now" not in state
