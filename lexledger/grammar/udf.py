"""The grammar as Arrow UDFs: one nested record for each document."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType, _parse_datatype_string

from lexledger.functions import legal
from lexledger.grammar import publication

SANCTION = "struct<subject: string, text: string, type: string, amount: decimal(18,2), currency: string, amount_raw: string, duration_raw: string, paragraph: int, ordinal: int, declared_subject: string, role: string, respondent_type: string, name: string>"
REFERENCE = "struct<statute_raw: string, article_raw: string, statute: string, article: string>"
BLOCK = (
    "struct<ordinal: int, paragraph: int, header: string, severity: string, statute_raw: string, statute: string, article_raw: string, article: string, "
    f"related: array<{REFERENCE}>, conduct: string, conduct_start: string, conduct_end: string, conduct_precision: string, subjects: array<string>, sanctions: array<{SANCTION}>, declared: boolean, declared_for: int>"
)
PUBLICATION = (
    "boe_id string, title string, publication_date string, document_date string, raw_sha256 string, sanctioning_resolution_date string, administrative_finality_observed boolean, judicial_review_mentioned boolean, "
    "administrative_appeal_observed boolean, renunciation_observed boolean, document_kind string, paragraphs array<struct<index: int, css_class: string, text: string>>, "
    f"blocks array<{BLOCK}>, issues array<struct<kind: string, detail: string>>, underlying array<string>, error string"
)


def _type() -> StructType:
    return _parse_datatype_string(PUBLICATION)


def respondent_kind(name: str) -> str:
    """As legal.respondent_type, for plain text."""
    if re.search(legal.ANONYMOUS, name):
        return "ANONYMIZED_PERSON"
    if re.search(legal.PERSON, name):
        return "NATURAL_PERSON"
    return "LEGAL_PERSON" if re.search(legal.COMPANY_END, name.rstrip(" .")) or re.search(legal.COMPANY_WORD, name) else "UNKNOWN"


@lru_cache(publication.PHRASES)
def _who(subject: str) -> tuple[str | None, str, str | None]:
    """(role, kind, name) of a sanction's subject."""
    name, role = publication.split_role(subject)
    return role, respondent_kind(name), publication.PERSON.sub("", name).strip() or None


def record(raw: bytes | None) -> dict:
    """The parsed publication with names, roles and kinds of its subjects; errors are a field, never raised."""
    if raw is None:
        return {"error": "no content", "paragraphs": [], "blocks": [], "issues": [{"kind": "PARSE_FAILED", "detail": "no content"}], "underlying": []}
    try:
        out = publication.parse(raw)
    except ValueError as e:
        return {"error": str(e), "paragraphs": [], "blocks": [], "issues": [{"kind": "PARSE_FAILED", "detail": str(e)}], "underlying": []}
    for b in out["blocks"]:
        for s in b["sanctions"]:
            s["role"], s["respondent_type"], s["name"] = _who(s["subject"])
    return out | {"error": None}


def _each(kind: pa.DataType):
    def run(batches):
        for batch in batches:
            parsed = pa.array([record(x.as_py()) for x in batch.column("content")], kind)
            names = [n for n in batch.schema.names if n != "content"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), parsed], names=[*names, "publication"])

    return run


def spread(df: DataFrame, *key: str) -> DataFrame:
    """The rows dealt out by key to several tasks a core. Parsing takes most of the time and files say little about it: a
    table of one row group would be parsed by one task."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism), *key)


def parse_publications(docs, content: str = "content", key: str = "path", carry: Sequence[str] = (), dealt: bool = False):
    """(key, carried columns, publication) for each document, parsed where it was dealt to; ``dealt``: docs are spread already."""
    base = docs.select(key, *carry, F.col(content).alias("content"))
    base = base if dealt else spread(base, key)
    columns = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in base.schema.fields if f.name != "content")
    return base.mapInArrow(_each(to_arrow_type(_type())), f"{columns}publication struct<{_fields()}>")


def _fields() -> str:
    return _type().simpleString()[len("struct<") : -1]


def _over(f, kind):
    """A Python function of one string as a function of a batch of strings, for SQL."""
    return F.pandas_udf(lambda texts: texts.map(lambda t: None if t is None else f(t)), kind)


def register(spark: SparkSession) -> None:
    """SQL functions over batches: publication_json (the record as JSON), split_subjects, split_subject_role, conduct_period."""
    publication_json = F.pandas_udf(lambda raws: raws.map(lambda raw: json.dumps(record(None if raw is None else bytes(raw)), default=str, ensure_ascii=False)), "string")
    spark.udf.register("publication_json", publication_json)
    spark.udf.register("split_subjects", _over(publication.split_subjects, "array<string>"))
    for name, f, keys in (("split_subject_role", publication.split_role, ("name", "role")), ("conduct_period", publication.conduct_period, ("start", "end", "precision"))):
        spark.udf.register(name, _over(lambda t, f=f, keys=keys: dict(zip(keys, f(t))), "map<string, string>"))
