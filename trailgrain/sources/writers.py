"""Writers: append-only JSON lines, key lists, the content-addressed cache, cards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trailgrain.functions import vocab
from trailgrain.operators import facets
from trailgrain.operators.ordering import with_position


def append_jsonl(df: DataFrame, path: str) -> None:
    """Add a file of JSON lines to ``path``; null fields are left out of a line."""
    df.write.mode("append").json(path)


def append_keys(df: DataFrame, path: str, key: str = "canonical") -> None:
    df.select(F.col(key).cast("string")).write.mode("append").text(path)


def write_cache(pages: DataFrame, path: str) -> None:
    """Pages in two levels of folders, by the digits of the hash of their canonical URL, one row a URL."""
    hashed = pages.dropDuplicates(["canonical"]).withColumn("hash", F.sha2("canonical", 256))
    hashed.withColumns({"first": F.substring("hash", 1, 2), "second": F.substring("hash", 3, 2)}).write.mode("append").partitionBy("first", "second").parquet(path)


def cards(dishes: DataFrame, columns: Mapping[str, str] = facets.FACET_COLUMNS) -> DataFrame:
    """The derived records as attributes: facets joined with ``|``, the search text and the sort metrics."""
    df = facets.derive(dishes)
    joined = [F.array_join(facets.facet_array(df, c), "|").alias(f"facet_{k}") for k, c in columns.items()]
    text = facets.search_text(F.col("title"), F.col("blurb"), F.col("ingredients")).alias("search_text")
    return df.select("id", "updated", *joined, text, "cal_oz", "ouncesperserving", "total_minutes", "caloriesperserving", F.lower("title").alias("title_key"))


def ounces(x: Column) -> Column:
    """Whole numbers plainly, others with one decimal."""
    return F.when(x == F.floor(x), F.floor(x).cast("string")).when(x.isNotNull(), F.format_string("%.1f", x))


def stat_columns() -> dict[str, Column]:
    """The formatted numbers of a derived record, null where the number is."""

    def unit(column: str, suffix: str = "") -> Column:
        return F.concat(F.col(column).cast("string"), F.lit(suffix))

    return {
        "calories": unit("caloriesperserving"),
        "weight": F.concat(ounces(F.col("ouncesperserving")), F.lit(" oz")),
        "cal_oz_text": unit("cal_oz"),
        "protein": unit("proteingrams", " g"),
        "serves": F.concat(unit("servings"), F.when(F.coalesce("scalable", F.lit(True)), ", scales").otherwise("")),
        "prep": unit("prepminutes", " min"),
        "cook": unit("cookminutes", " min"),
        "total_time": unit("total_minutes", " min"),
        "water_text": F.when((F.col("water") == "none") | F.col("water").isNull(), "none").otherwise(F.concat(F.coalesce("waterml", F.lit(0)).cast("string"), F.lit(" ml "), F.col("water"))),
        "cost_text": F.col("cost"),
    }


def stats(dishes: DataFrame) -> DataFrame:
    """The ten formatted numbers of a record."""
    return facets.derive(dishes).select("id", "updated", *[c.alias(n) for n, c in stat_columns().items()])


# The facets whose values a record's page shows, in their order.
PILLS = ("slot", "heat", "style", "diet", "cleanup", "prep", "shelf", "skill")


def pill_groups(groups: Mapping[str, Column]) -> Column:
    """array<struct<name,values>> of the groups that have values."""
    return F.filter(F.array(*[F.struct(F.lit(k).alias("name"), v.alias("values")) for k, v in groups.items()]), lambda g: F.size(g["values"]) > 0)


def labels(key: str, values: Column) -> Column:
    """The labels of a facet's values; a value that the vocabulary lacks stays as it is."""
    known = next(f.options for f in vocab.FACETS if f.key == key)
    names = F.create_map(*[F.lit(x) for pair in known for x in pair])
    return F.transform(values, lambda v: F.coalesce(F.element_at(names, v), v))


def routes(dishes: DataFrame) -> DataFrame:
    """(slug, record) of every row that isn't a draft."""
    return facets.not_draft(dishes).select(F.col("id").alias("slug"), F.struct("*").alias("record"))


def detail(dishes: DataFrame) -> DataFrame:
    """A record's page: ten formatted numbers, labelled groups of facets without empty ones, ingredients, steps and optional parts."""
    df = facets.derive(dishes)
    groups = {k: labels(k, facets.facet_array(df, facets.FACET_COLUMNS[k])) for k in PILLS}
    numbers = [c.alias(n) for n, c in stat_columns().items()]
    return df.select("id", "updated", *numbers, pill_groups(groups).alias("groups"), "ingredients", "steps", "packing", "variations", "source")


def summary(visible: DataFrame, active: int) -> DataFrame:
    """One row: how many are visible and how that is said, whether to say that there is none, and the badge of ``active`` facets, null if there is none."""
    n = F.count(F.lit(1))
    told = F.concat(n.cast("string"), F.when(n == 1, " meal").otherwise(" meals"))
    badge = F.when(F.lit(active > 0), F.lit(str(active)))
    return visible.agg(n.alias("n"), told.alias("label"), (n == 0).alias("is_empty"), badge.alias("badge"), F.lit(active == 0).alias("badge_hidden"))


def json_array(df: DataFrame, order: list[Column]) -> DataFrame:
    """``position`` and ``line``: the lines of one JSON array of all rows, in ``order``; an empty table is ``[]``.

    Every row writes its own brackets and commas, so no task holds the array;
    null fields are left out of a row's object.
    """
    placed = with_position(df, order)
    size = df.count()
    if size == 0:
        return df.sparkSession.createDataFrame([(0, "[]")], "position long, line string")
    body = F.to_json(F.struct(*df.columns))
    line = F.concat(F.when(F.col("position") == 0, "[").otherwise(""), body, F.when(F.col("position") == size - 1, "]").otherwise(","))
    return placed.select("position", line.alias("line"))


def write_json_array(df: DataFrame, path: str, order: list[Column]) -> None:
    """The array of ``json_array`` in files whose contents, in the order of their names, make it up."""
    json_array(df, order).orderBy("position").select("line").write.text(path)


def job_files(batches: DataFrame, line: str, batch: str = "batch", order: str = "position") -> DataFrame:
    """One row a batch: its lines in order, joined."""
    return batches.groupBy(batch).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(line).alias("line")))), lambda s: s["line"]), "\n").alias("content"))


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` and the observation that has its number of rows and the given aggregates once an action has run."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in metrics.items()]), seen
