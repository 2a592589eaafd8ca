"""Deeply nested JSON records as flat tables that keep their parent-child links.

Every node gets a Dewey label: the ordinals on its path from the root.  A
label's proper prefixes are its ancestors, so a parent link is found by
truncation, and labels in order are the nodes in reading order.  Nodes go to
tables by their schema path, the keys and types on their path without ordinals,
so that a single value and a list of one come out alike.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame

from trailgrain.functions.arrowkit import map_batches

# The schema.org keys of a Recipe that have child tables.
RECIPE_PATHS = {
    "author": "author",
    "recipeIngredient": "ingredient",
    "ingredients": "ingredient",
    "recipeInstructions": "method",
    "review": "review",
}
LINES = {"ingredient", "method"}  # a string under these holds one node a line
CHILDREN = "itemListElement"

Label = tuple[int, ...]
Node = tuple[Label, str, object]


def read_json(text: str | None) -> dict | None:
    """The object in ``text``; None for null, torn or other JSON."""
    try:
        value = json.loads(text) if text else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def has_type(node: object, name: str) -> bool:
    kind = node.get("@type") if isinstance(node, dict) else None
    return kind == name or isinstance(kind, list) and name in kind


def _blank(node: object) -> bool:
    return node is None or isinstance(node, str) and not node.strip()


def _members(value: object, path: str) -> list:
    """A value as a list: lines of a string, a list as it is, a single value as a list of one."""
    if isinstance(value, str) and path in LINES:
        return value.replace("\r", "\n").split("\n")
    return value if isinstance(value, list) else [value]


def _visit(value: object, label: Label, path: str, out: list[Node]) -> None:
    """Append the nodes below ``value`` in reading order; null and blank ones use up an ordinal but give no node.

    What is still to be visited is on a list, so records nested however deep are read.
    """
    waiting: list[Node] = []

    def below(value: object, label: Label) -> None:
        members = _members(value, path)
        waiting.extend(((*label, i), path, members[i]) for i in range(len(members) - 1, -1, -1))

    below(value, label)
    while waiting:
        at, _, node = waiting.pop()
        if _blank(node):
            continue
        if isinstance(node, list):
            below(node, at)
        elif path != "method":
            out.append((at, path, node))
        elif has_type(node, "HowToSection"):
            out.append((at, "section", node))
            below(node.get(CHILDREN), at)
        elif isinstance(node, dict) and CHILDREN in node and not has_type(node, "HowToStep"):
            below(node[CHILDREN], at)  # a plain list in an envelope
        else:
            out.append((at, "step", node))


def dewey_nodes(recipe: dict) -> list[Node]:
    """(label, table, node) of every child node of a Recipe, in reading order."""
    out: list[Node] = []
    for k, (key, value) in enumerate(recipe.items()):
        if path := RECIPE_PATHS.get(key):
            _visit(value, (k,), path, out)
    return out


def child_rows(recipe: dict) -> list[tuple[str, int, int, Label, object]]:
    """(table, parent_no, child_no, label, node): ``child_no`` counts by table, ``parent_no`` is the nearest enclosing section's or -1."""
    counts: dict[str, int] = {}
    sections: dict[Label, int] = {}
    rows = []
    for label, table, node in dewey_nodes(recipe):
        no = counts.get(table, 0)
        counts[table] = no + 1
        parent = -1
        if sections and (table == "step" or table == "section"):
            above = label[:-1]
            while len(above) > 1 and parent < 0:
                parent = sections.get(above, -1)
                above = above[:-1]
        if table == "section":
            sections[label] = no
        rows.append((table, parent, no, label, node))
    return rows


def node_text(node: object) -> str | None:
    """What a reader would see of a node: its text, else its name or body."""
    if isinstance(node, dict):
        node = next((node[k] for k in ("text", "reviewBody", "name") if isinstance(node.get(k), str) and node[k].strip()), None)
    return None if node is None else str(node).encode("utf-8", "replace").decode()


def flatten_recipes(pages: DataFrame, key: str = "page_id", column: str = "jsonld", text: bool = False) -> DataFrame:
    """The child tables of all recipes: ``key``, ``recipe_no``, ``child``, ``parent_no``, ``child_no``.

    ``recipe_no`` is the element's position in ``column``; unreadable elements
    give no rows but keep their position.  Null columns, null or blank values
    and empty lists give none.  With ``text`` also ``dewey`` (the label, joined
    with dots) and ``content``.  Repeated rows give repeated results.
    """
    kind = pages.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, recipe_no, child, parent_no, child_no, dewey, content = [], [], [], [], [], [], []
        for row, elements in enumerate(batch.column(1).to_pylist()):
            for no, element in enumerate(elements or ()):
                recipe = read_json(element)
                for table, parent, at, label, node in child_rows(recipe) if recipe else ():
                    owner.append(row)
                    recipe_no.append(no)
                    child.append(table)
                    parent_no.append(parent)
                    child_no.append(at)
                    if text:
                        dewey.append(".".join(map(str, label)))
                        content.append(node_text(node))
        columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(recipe_no, pa.int32()), pa.array(child, pa.string()), pa.array(parent_no, pa.int32()), pa.array(child_no, pa.int32())]
        names = ["key", "recipe_no", "child", "parent_no", "child_no"]
        if text:
            columns += [pa.array(dewey, pa.string()), pa.array(content, pa.string())]
            names += ["dewey", "content"]
        return pa.RecordBatch.from_arrays(columns, names)

    schema = f"key {kind}, recipe_no int, child string, parent_no int, child_no int" + ", dewey string, content string" * text
    part = pages.where(pages[column].isNotNull()).select(pages[key].alias("key"), pages[column].alias("elements"))
    return map_batches(part, run, schema).withColumnRenamed("key", key)


def shredded(record: object) -> list[tuple[str, Label, dict[str, str]]]:
    """(table, label, values) of every object in ``record``, in reading order, whatever its schema.

    The table is the schema path: the keys from the root, joined with dots; lists
    add ordinals to the label but nothing to the path.  Single values, and lists
    of them, go to a table of their own under the key ``value`` only if they are
    in a list; others are columns of the object around them.
    """
    out: list[tuple[str, Label, dict[str, str]]] = []
    waiting: list[tuple[object, Label, str]] = [(record, (0,), "")]
    while waiting:
        node, label, path = waiting.pop()
        if isinstance(node, dict):
            plain, inner = {}, []
            for k, (key, value) in enumerate(node.items()):
                if isinstance(value, (dict, list)):
                    inner.append((value, (*label, k), f"{path}.{key}" if path else key))
                elif value is not None:
                    plain[key] = _shown(value)
            out.append((path, label, plain))
            waiting += reversed(inner)
        elif isinstance(node, list):
            waiting += [(x, (*label, i), path) for i, x in reversed(list(enumerate(node))) if x is not None]
        else:
            out.append((path, label, {"value": _shown(node)}))
    return out


def _shown(value: object) -> str:
    text = value if isinstance(value, str) else json.dumps(value)
    return text.encode("utf-8", "replace").decode()


def shred(records: DataFrame, key: str = "page_id", column: str = "jsonld") -> DataFrame:
    """Every object of the JSON in an array column as a row of the table of its schema path.

    ``key``, ``recipe_no`` (the element's place), ``table`` (the schema path, ''
    for the root), ``dewey``, ``parent`` (the label of the nearest object around
    it, by truncation; null for a root) and ``fields``, a map of its single values.
    Unreadable elements, nulls and empty lists give no rows; repeated rows give
    repeated results.  ``tables`` splits the result.
    """
    kind = records.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, number, table, dewey, parent, fields = [], [], [], [], [], []
        for row, elements in enumerate(batch.column(1).to_pylist()):
            for no, element in enumerate(elements or ()):
                record = read_json(element)
                nodes = shredded(record) if record is not None else []
                known = {label for _, label, _ in nodes}
                for path, label, values in nodes:
                    above = label[:-1]
                    while above and above not in known:
                        above = above[:-1]
                    owner.append(row)
                    number.append(no)
                    table.append(path)
                    dewey.append(".".join(map(str, label)))
                    parent.append(".".join(map(str, above)) if above else None)
                    fields.append(list(values.items()))
        columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), pa.array(table, pa.string()), pa.array(dewey, pa.string()), pa.array(parent, pa.string()), pa.array(fields, pa.map_(pa.string(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=["key", "recipe_no", "table", "dewey", "parent", "fields"])

    part = records.where(records[column].isNotNull()).select(records[key].alias("key"), records[column].alias("elements"))
    return map_batches(part, run, f"key {kind}, recipe_no int, `table` string, dewey string, parent string, fields map<string,string>").withColumnRenamed("key", key)


def tables(shreds: DataFrame, paths: dict[str, list[str]]) -> dict[str, DataFrame]:
    """A flat table for each schema path of ``paths``: the links and the named fields as columns."""
    links = [c for c in shreds.columns if c not in ("table", "fields")]
    return {path: shreds.where(shreds["table"] == path).select(*links, *[shreds["fields"][f].alias(f) for f in fields]) for path, fields in paths.items()}
