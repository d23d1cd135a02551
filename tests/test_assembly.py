"""Assembly at size: parsing is dealt out, and tables that need no shuffle have none."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lexledger.grammar.udf import parse_publications
from lexledger.plans.assembly import assemble, parsed_corpus
from test_grammar import xml

ACT = "Imponer a Sociedad {}, S.A., por la comisión de una infracción grave tipificada en el artículo 99, letra o), de la Ley 24/1988, en relación con los artículos 45 y 48 de la misma Ley, por no comunicar el día 3 de marzo de 2007, una multa por importe de {} euros."


@pytest.fixture(scope="module")
def files(spark):
    rows = [("a", f"/a/{k}.xml", f"BOE-A-2008-{k}", xml(ACT.format(k % 5, 1000 + k), boe=f"BOE-A-2008-{k}")) for k in range(40)]
    # Two files with names of their own whose text names the same publication.
    rows.append(("a", "/a/x.xml", "BOE-A-2008-900", xml(ACT.format(77, 5000), boe="BOE-A-2008-3")))
    return spark.createDataFrame(rows, "corpus string, path string, boe_id string, content binary").coalesce(1)


@pytest.fixture(scope="module")
def tables(files):
    return assemble(parsed_corpus(files), files, datetime(2010, 6, 1))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_partition_is_parsed_by_several_tasks(files):
    one = parse_publications(files).withColumn("task", F.spark_partition_id())
    assert one.count() == 41 and one.select("task").distinct().count() > 2


@pytest.mark.parametrize("name", ["evidence", "related_provisions", "infringements", "sanctions", "documents"])
def test_no_shuffle_of_rows(tables, name):
    rows = plan(tables[name])
    assert "SortMergeJoin" not in rows and "Window" not in rows
    if name != "infringements":  # which joins two small broadcast tables
        assert "Exchange" not in rows


def test_publications_of_one_id_are_counted_together_and_keep_their_rows(tables):
    assert [(r.n_infringements, r.n_sanctions, r.n_respondents) for r in tables["cases"].filter("case_id = 'CNMV-BOE-A-2008-3'").collect()] == [(2, 2, 2)] * 2
    assert tables["cases"].filter("n_sanctions = 1").count() == 39
    assert tables["infringements"].filter("case_id = 'CNMV-BOE-A-2008-3'").count() == 2
    assert tables["infringements"].count() == 41 and tables["related_provisions"].count() == 82 and tables["evidence"].count() == 7 * 41


def test_evidence_is_bound_to_its_own_paragraph(tables):
    of = {r.field_name: r.proof_level for r in tables["evidence"].filter("document_id = 'BOE-A-2008-7'").collect()}
    assert of["sanction_text"] == of["amount"] == "VALUE_BINDING_PROVEN" and of["name"] == "DOCUMENT_BINDING_PROVEN"


def test_texts_of_evidence_are_squeezed_before_facts_are_dealt_out(tables):
    """A paragraph once for each block or sanction, not several times for each fact."""
    above = plan(tables["evidence"].select("proof_level")).split("Generate explode(fs", 1)[0]
    assert "regexp_replace" not in above
