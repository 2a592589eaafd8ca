"""Readers: markdown collections with frontmatter, JSON lines that may be torn or missing, key lists, and a cached fetch."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trailgrain.functions.urls import canonical_url, site_key, url_host

_INGREDIENT = "array<struct<item:string,amount:string,note:string>>"
# The fields of a record and their types; names in the files are in camel case.
RECORD_FIELDS = {
    "title": "string", "blurb": "string", "tripStyle": "array<string>", "slot": "array<string>", "heatSource": "array<string>", "prepMinutes": "int", "cookMinutes": "int", "caloriesPerServing": "int",
    "ouncesPerServing": "double", "proteinGrams": "int", "water": "string", "waterMl": "int", "cleanup": "string", "dietary": "array<string>", "homePrep": "string", "shelfLife": "string", "servings": "int",
    "scalable": "boolean", "skill": "string", "cost": "string", "ingredients": _INGREDIENT, "steps": "array<string>", "packing": "string", "variations": "array<string>", "source": "string", "updated": "timestamp", "draft": "boolean",
}


def scalar(text: str) -> object:
    """true, false, numbers and inline lists as such; other text without its matching quotes."""
    text = text.strip()
    if text in ("true", "false"):
        return text == "true"
    if re.fullmatch(r"-?\d+(\.\d+)?", text):
        return float(text) if "." in text else int(text)
    if text.startswith("[") and text.endswith("]"):
        return [scalar(x) for x in text[1:-1].split(",") if x.strip()]
    if len(text) > 1 and text[0] == text[-1] and text[0] in "\"'":
        return text[1:-1].replace('\\"', '"')
    return text


def parse_frontmatter(raw: str) -> dict:
    """The record between the first two ``---`` lines; ValueError if there is none."""
    m = re.match(r"﻿?---[ \t]*\r?\n(.*?)\r?\n---[ \t]*(?:\r?\n|$)", raw, re.DOTALL)
    if not m:
        raise ValueError("no frontmatter block")
    record: dict = {}
    key: str | None = None
    for line in m[1].splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if item := re.match(r"\s+-\s+(.*)$", line):
            pair = re.match(r"([A-Za-z_]\w*):\s+(.*)$", item[1])
            if not isinstance(record.get(key), list):
                record[key] = []
            record[key].append({pair[1]: scalar(pair[2])} if pair else scalar(item[1]))
        elif (inner := re.match(r"\s+([A-Za-z_]\w*):\s*(.*)$", line)) and isinstance(record.get(key), list) and record[key] and isinstance(record[key][-1], dict):
            record[key][-1][inner[1]] = scalar(inner[2])
        elif top := re.match(r"([A-Za-z_]\w*):\s*(.*)$", line):
            key = top[1]
            record[key] = scalar(top[2]) if top[2].strip() else None
    return record


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """One row a markdown file: ``id`` (the file's name) and the record's fields in lower case; defaults fill what may be absent."""
    files = spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.md$", 1).alias("id"), "value")
    return parse_records(files)


def parse_records(files: DataFrame, key: str = "id", raw: str = "value") -> DataFrame:
    """``id`` and the record's fields of every markdown text; one without frontmatter raises ValueError."""
    import json

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [json.dumps(parse_frontmatter(v), ensure_ascii=False) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", "record"])

    schema = ", ".join(f"{k} {v}" for k, v in RECORD_FIELDS.items())
    parsed = files.select(F.col(key).cast("string").alias("id"), F.col(raw).alias("value")).mapInArrow(run, "id string, record string").select("id", F.from_json("record", schema).alias("r"))
    fields = [F.col(f"r.{k}").alias(k.lower()) for k in RECORD_FIELDS]
    return with_defaults(parsed.select("id", *fields))


def with_defaults(records: DataFrame) -> DataFrame:
    empty = F.array().cast("array<string>")
    return records.withColumns(
        {"waterml": F.coalesce("waterml", F.lit(0)), "dietary": F.coalesce("dietary", empty), "scalable": F.coalesce("scalable", F.lit(True)), "variations": F.coalesce("variations", empty), "draft": F.coalesce("draft", F.lit(False))}
    )


def _missing(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return found is None or len(found) == 0


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON lines; malformed and blank lines are left out, a missing path is an empty table."""
    if _missing(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_keys(spark: SparkSession, path: str, name: str = "canonical") -> DataFrame:
    """The distinct nonblank lines of text files; a missing path has none."""
    if _missing(spark, path):
        return spark.createDataFrame([], f"{name} string")
    return spark.read.text(path).select(F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias(name)).where(F.col(name) != "").distinct()


def cards_to_rows(cards: DataFrame, arrays: list[str], numbers: list[str]) -> DataFrame:
    """Attributes joined with ``|`` back to arrays, without empty values, and numbers to doubles."""
    split = {c: F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: x != "") for c in arrays}
    return cards.withColumns(split | {c: F.expr(f"try_cast({c} as double)") for c in numbers})


def text_like(content_type: F.Column) -> F.Column:
    """Whether a response's type is text; a missing one counts as HTML."""
    return F.coalesce(content_type, F.lit("text/html")).rlike(r"(?i)^(text/html|application/xhtml\+xml|text/plain|application/xml|text/xml)")


def fetch_pages(requests: DataFrame, cache: DataFrame, fetch: Callable[[list[str]], list[tuple[int, str | None, str | None] | None]], url: str = "url") -> tuple[DataFrame, DataFrame]:
    """(pages, new cache rows) of ``requests``; ``fetch`` gets the URLs of a batch and gives (status, content type, body) or None for each.

    A URL that the cache holds under its canonical form costs no request.  The
    others are shared out by host, so one task speaks to a host; statuses of 400
    and more, types other than text and failures give no page and aren't cached.
    """
    keyed = requests.select(F.col(url).alias("url"), canonical_url(F.col(url)).alias("canonical"))
    held = cache.select("canonical", "body").dropDuplicates(["canonical"])
    hits = keyed.join(held, "canonical").select("url", "canonical", "body", F.lit(True).alias("from_cache"))
    missing = keyed.join(held.select("canonical"), "canonical", "left_anti").dropDuplicates(["canonical"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = fetch(batch.column(0).to_pylist())
            status, kind, body = zip(*((a or (599, None, None)) for a in answers), strict=True) if answers else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(status, pa.int32()), pa.array(kind, pa.string()), pa.array(body, pa.string())], names=["url", "canonical", "status", "content_type", "body"])

    by_host = missing.repartition(site_key(url_host(F.col("url"))))
    answers = by_host.select("url", "canonical").mapInArrow(run, "url string, canonical string, status int, content_type string, body string")
    good = answers.where((F.col("status") < 400) & F.col("body").isNotNull() & text_like(F.col("content_type")))
    pages = hits.unionByName(good.select("url", "canonical", "body", F.lit(False).alias("from_cache")))
    return pages, good.select("canonical", "body")
