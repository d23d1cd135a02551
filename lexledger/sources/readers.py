"""Sources: XML corpora, register pages, daily summaries, manifests, snapshots, Parquet tables."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.schemas import TABLES


def xml_corpus(spark: SparkSession, folders: dict[str, str], pattern: str = "BOE-*.xml") -> DataFrame:
    """(corpus, path, boe_id, content, sha256) of XML files; ``folders``: corpus name to folder or glob."""
    out = None
    for corpus, folder in folders.items():
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        one = files.select(F.lit(corpus).alias("corpus"), "path", F.regexp_extract("path", r"([^/]+)\.xml$", 1).alias("boe_id"), "content", F.sha2("content", 256).alias("sha256"))
        out = one if out is None else out.unionByName(one)
    return out


def text_of(content: Column) -> Column:
    """UTF-8 if the bytes are valid, else ISO-8859-1."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))


class _Register(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows, self.cells, self.href, self.in_cell, self.text = [], None, None, False, []

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.cells, self.href = [], None
        elif tag == "td" and self.cells is not None:
            self.in_cell = True
            self.cells.append("")
        elif tag == "a" and self.in_cell and self.href is None:
            self.href = dict(attrs).get("href")

    def handle_endtag(self, tag):
        if tag == "td":
            self.in_cell = False
        elif tag == "tr" and self.cells:
            self.rows.append((self.cells, self.href))
            self.cells = None

    def handle_data(self, data):
        self.text.append(data)
        if self.in_cell and self.cells:
            self.cells[-1] += data


def register_page(html: str) -> tuple[list[dict], int | None]:
    """(rows, declared number of pages) of a register page: date cell with a document link, then the title."""
    p = _Register()
    p.feed(html)
    rows = []
    for cells, href in p.rows:
        day = re.search(r"(\d{2})/(\d{2})/(\d{4})", cells[0])
        if day and len(cells) > 1:
            rows.append({"register_entry_date": f"{day[3]}-{day[2]}-{day[1]}", "title": re.sub(r"\s+", " ", cells[1]).strip(), "document_url": href})
    pages = re.search(r"P[áa]gina\s+\d+\s+de\s+(\d+)", " ".join(p.text))
    return rows, int(pages[1]) if pages else None


REGISTER_ROW = "page_index int, declared_pages int, register_entry_date string, title string, document_url string"


def register_rows(pages: DataFrame, html: str, page: str) -> DataFrame:
    """The rows of all register pages, each with the number of pages that its page declares; a page without rows is one
    row without title."""

    def parse(batches):
        for batch in batches:
            out = []
            for index, text in zip(batch.column("page").to_pylist(), batch.column("html").to_pylist()):
                rows, declared = register_page(text) if text is not None else ([], None)
                out += [{"page_index": index, "declared_pages": declared} | r for r in rows or [{}]]
            yield pa.RecordBatch.from_pylist(out, REGISTER)

    out = pages.select(F.col(page).cast("int").alias("page"), F.col(html).alias("html")).mapInArrow(parse, REGISTER_ROW)
    return out.withColumn("register_entry_date", F.col("register_entry_date").cast("date"))


REGISTER = pa.schema([("page_index", pa.int32()), ("declared_pages", pa.int32()), ("register_entry_date", pa.string()), ("title", pa.string()), ("document_url", pa.string())])


def register_integrity(rows: DataFrame, page_size: int = 5) -> DataFrame:
    """(page_index, n, problem): pages without rows, short pages before the last declared one, declared pages that are
    missing, and pages that declare another number than page 0."""
    sizes = rows.groupBy("page_index").agg(F.count("title").alias("n"), F.max("declared_pages").alias("declared"))
    first = sizes.filter("page_index = 0").select(F.col("declared").alias("pages"))
    every = first.select(F.explode(F.sequence(F.lit(0), F.greatest(F.col("pages"), F.lit(1)) - 1)).alias("page_index"), "pages")
    joined = every.join(sizes, "page_index", "full_outer")
    last = F.col("page_index") == F.col("pages") - 1
    problem = (
        F.when(F.col("pages").isNull(), "NOT_DECLARED").when(F.col("n").isNull(), "MISSING").when(F.col("n") == 0, "EMPTY")
        .when(~last & (F.col("n") != page_size), "SHORT").when(F.col("declared") != F.col("pages"), "OTHER_COUNT")
    )
    return joined.select("page_index", F.coalesce("n", F.lit(0)).alias("n"), problem.alias("problem")).filter("problem IS NOT NULL")


def register_total(rows: DataFrame, page_size: int = 5) -> DataFrame:
    """One row: rows found, and how many the declared pages and the last page's rows say there are."""
    pages = rows.agg(F.max_by("declared_pages", -F.col("page_index")).alias("pages"), F.count("title").alias("n_rows"), F.max("page_index").alias("top"))
    last = rows.groupBy("page_index").agg(F.count("title").alias("n_last"))
    return pages.join(last, F.col("page_index") == F.col("pages") - 1, "left").select("n_rows", ((F.col("pages") - 1) * page_size + F.coalesce("n_last", F.lit(0))).cast("bigint").alias("derived_total"))


def _list(v: Column, path: str) -> Column:
    """What is at the path as an array: an array as it is, anything else as its only element, nothing as none."""
    one = F.try_variant_get(v, path, "variant")
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.when(one.isNotNull(), F.array(one)), F.array().cast("array<variant>"))


def _text(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, f"{path}.texto", "string"), F.try_variant_get(v, path, "string"))


def sumario_items(df: DataFrame, payload: str) -> DataFrame:
    """Items of daily summaries, whatever each level is: object, array, or missing heading."""
    keep = [c for c in df.columns if c != payload]
    level = df.select(*keep, F.try_parse_json(payload).alias("v"))
    for path, name, codes in (("$.data.sumario.diario", "v", []), ("$.seccion", "v", ["seccion_codigo"]), ("$.departamento", "v", ["departamento_codigo"])):
        level = level.select(*[c for c in level.columns if c != "v"], F.explode(_list(F.col("v"), path)).alias(name))
        for c in codes:
            level = level.withColumn(c, F.try_variant_get("v", "$.codigo", "string"))
    nested = F.transform(_list(F.col("v"), "$.epigrafe"), lambda e: F.struct(_text(e, "$.nombre").alias("epigrafe_nombre"), _list(e, "$.item").alias("items")))
    plain = F.array(F.struct(F.lit(None).cast("string").alias("epigrafe_nombre"), _list(F.col("v"), "$.item").alias("items")))
    level = level.withColumn("g", F.explode(F.concat(plain, nested))).withColumn("i", F.explode("g.items"))
    item = lambda name, kind="string": F.try_variant_get("i", f"$.{name}", kind)
    return level.select(
        *keep, item("identificador").alias("identificador"), _text(F.col("i"), "$.titulo").alias("titulo"), "seccion_codigo", "departamento_codigo", F.col("g.epigrafe_nombre").alias("epigrafe_nombre"),
        *[_text(F.col("i"), f"$.url_{x}").alias(f"url_{x}") for x in ("html", "xml", "pdf")],
        *[F.coalesce(item(f"url_pdf.{x}", "int"), item(x, "int")).alias(x) for x in ("pagina_inicial", "pagina_final")],
    )


#: Fixed value: the department of the publications.
DEPARTMENT = "1040"


def of_department(items: DataFrame, code: str = DEPARTMENT) -> DataFrame:
    return items.filter(F.col("departamento_codigo") == code)


#: What titles of sanction publications contain.
MARKERS = ["sanción", "sanciones", "sancion", "infracción", "infracciones", "expediente sancionador", "amonestación", "multa", "inhabilitación", "suspensión", "separación"]


def sanction_like(title: Column) -> Column:
    low = F.lower(title)
    out = F.lit(False)
    for m in MARKERS:
        out = out | F.contains(low, F.lit(m))
    return out


def classify_item(title: Column) -> Column:
    """CORRECTION before ENFORCEMENT before MEASURE."""
    return (
        F.when(title.rlike(r"(?iu)correcci[oó]n\s+de\s+err"), "CORRECTION").when(title.rlike(r"(?iu)sanci[oó]n|infracci[oó]n"), "ENFORCEMENT")
        .when(title.rlike(r"(?iu)medida|suspensi[oó]n|intervenci[oó]n"), "MEASURE").otherwise("OTHER")
    )


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


SIDECAR_JSON = "array<struct<boe_id: string, title: string, register_entry_date: string, method: string, score: double>>"


def sidecar_index(df: DataFrame, payload: str) -> DataFrame:
    """(boe_id, title, register_entry_date, method, score) from an index file's text, a JSON list; of one boe_id the last
    entry counts."""
    each = df.select(F.posexplode(F.from_json(payload, SIDECAR_JSON)).alias("at", "e")).select("at", "e.*")
    last = each.groupBy("boe_id").agg(F.max_by(F.struct("title", "register_entry_date", "method", "score"), "at").alias("e")).select("boe_id", "e.*")
    return last.withColumn("register_entry_date", F.col("register_entry_date").try_cast("date"))


def yaml_records(df: DataFrame, text: str) -> DataFrame:
    """(at, record) of a YAML list of flat mappings ("- key: value", one key a line): rules and defect registries. Quotes
    around a value go, "[a, b]" stays text for yaml_list, comments and empty lines don't count."""
    plain = F.regexp_replace(text, r"(?m)^\s*(?:#.*)?(?:\r?\n|$)", "")
    entries = F.filter(F.split(plain, r"(?m)^\s*-\s+"), lambda e: F.contains(e, F.lit(":")) & (F.trim(e) != ""))
    entry = lambda e: F.map_from_entries(F.transform(F.regexp_extract_all(e, F.lit(r"(?m)^\s*[\w.]+:[^\n]*$"), F.lit(0)), _pair))
    return df.select(F.posexplode(F.transform(entries, entry)).alias("at", "record"))


def _pair(line: Column) -> Column:
    value = F.trim(F.regexp_extract(line, r"^\s*[\w.]+:\s*(.*?)\s*$", 1))
    return F.struct(F.regexp_extract(line, r"^\s*([\w.]+):", 1), F.when(~value.isin("", "null", "~"), F.regexp_replace(value, r"^([\"'])(.*)\1$", "$2")))


def yaml_list(value: Column) -> Column:
    """The elements of "[a, b]"."""
    inner = F.regexp_extract(value, r"^\[(.*)\]$", 1)
    return F.transform(F.filter(F.split(inner, ","), lambda x: F.trim(x) != ""), lambda x: F.regexp_replace(F.trim(x), r"^([\"'])(.*)\1$", "$2"))


RAW_MANIFEST = "source_id string, authority string, canonical_locator string, retrieval_url string, retrieved_at string, sha256 string, content_type string, http_status int, document_type string, raw_path string"
DAY_MANIFEST = "date string, items array<struct<boe_id: string, title: string, seccion: string, epigrafe: string, url_xml: string, sanction_like: boolean>>, error string"
SIDECAR = "boe_id string, title string, register_entry_date date, method string, score double"
OBSERVATION = "map<string, struct<sha256: string, notes: array<struct<kind: string, page: int, verbatim: string>>, status: string, retrieval: string, first_observed_at: string, observed_at: string>>"


def observation_snapshot(df: DataFrame, payload: str) -> DataFrame:
    """(boe_id, sha256, notes, ...) of a snapshot keyed by publication."""
    return df.select(F.explode(F.from_json(payload, OBSERVATION)).alias("boe_id", "o")).select("boe_id", "o.*")


#: Notes on later steps in page texts, by kind.
NOTES = {
    "FIRMNESS": r"(?iuU)(?:es\s+)?firme\s+en\s+v[ií]a\s+administrativa",
    "RENUNCIATION": r"(?iuU)renunciad[oa]\s+a\s+(?:la\s+)?interposici[oó]n\s+de\s+recursos?",
    "APPEAL_NOTICE": r"(?iuU)(?:ha\s+)?interpuesto\s+recurso\s+[^.;]{0,60}",
    "JUDICIAL_APPEAL": r"(?iuU)recurso\s+contencioso-administrativo\s+[^.;]{0,60}",
    "JUDGMENT": r"(?iuU)sentencia\s+(?:de\s+fecha\s+|firme\s+|de\s+)[^.;]{0,60}",
}


def page_notes(pages: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """(key, page, kind, verbatim, position) of every note in page texts."""
    squeezed = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.regexp_extract_all(squeezed, F.lit(p), F.lit(0)).alias("found")) for k, p in NOTES.items()])
    return pages.select(key, F.col(page).alias("page"), F.explode(each).alias("n")).select(key, "page", "n.kind", F.posexplode("n.found").alias("position", "verbatim"))


def ledger_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The ledger's tables from Parquet; tables that aren't there are empty, with their columns."""
    out = {}
    for name, schema in TABLES.items():
        try:
            out[name] = spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            out[name] = spark.createDataFrame([], schema)
    return out
