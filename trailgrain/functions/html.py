"""HTML scalars: entities, visible text, title, embedded recipes."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from trailgrain.functions.columns import let

# The named entities (an unbreakable space becomes an ordinary one) and the patterns of entities, hidden elements, titles and blocks.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "amp": "&"}
HEX, DECIMAL = r"(?i)&#x([0-9a-f]+);", r"&#([0-9]+);"
SCRIPT = r"(?is)<(script|style)\b[^>]*>.*?</\1>"
_HEX, _DECIMAL = re.compile(HEX), re.compile(DECIMAL)
_NAMED = re.compile(r"&(" + "|".join(ENTITIES) + ");", re.IGNORECASE)
_SCRIPT = re.compile(SCRIPT)
_TAG = re.compile(r"<[^>]*>")
TITLE_SUFFIX = r"(?U)\s+[|•·»–—]\s+.*$|\s+-\s+.*$"


def decode(text: str) -> str:
    """Hexadecimal, then decimal, then named entities, once each; unknown ones and code points beyond Unicode stay."""

    def point(m: re.Match, base: int) -> str:
        n = int(m[1], base)
        return chr(n) if n <= 0x10FFFF and not 0xD800 <= n <= 0xDFFF else m[0]

    text = _HEX.sub(lambda m: point(m, 16), text)
    text = _DECIMAL.sub(lambda m: point(m, 10), text)
    return _NAMED.sub(lambda m: ENTITIES[m[1].lower()], text)


def visible(html: str) -> str:
    return " ".join(decode(_TAG.sub(" ", _SCRIPT.sub(" ", html))).split())


def _points(text: Column, pattern: str, base: int) -> Column:
    """``text`` with the numeric entities of a base decoded, each once: the pieces between them and their characters in turn."""
    def char(digits: Column) -> Column:
        number = F.try_to_number(F.conv(digits, base, 10), F.lit("99999999999999999999")).cast("long")
        fits = (F.length(F.regexp_replace(digits, "^0+", "")) <= 8) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        return F.when(fits, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))

    def decoded(t: Column) -> Column:
        chars = F.zip_with(F.regexp_extract_all(t, F.lit(pattern), 0), F.regexp_extract_all(t, F.lit(pattern), 1), lambda e, d: F.coalesce(char(d), e))
        joined = F.array_join(F.zip_with(F.split(t, pattern), chars, lambda p, c: F.concat(p, F.coalesce(c, F.lit("")))), "")
        return F.when(F.contains(t, F.lit("&#")) & t.rlike(pattern), joined).otherwise(t)

    return let(text, decoded)


def decode_entities(text: Column) -> Column:
    """Hexadecimal, then decimal, then named entities, once each, in built-in expressions; unknown ones and code points beyond Unicode stay."""
    plain = _points(_points(text, HEX, 16), DECIMAL, 10)
    for name, char in ENTITIES.items():  # the ampersand is last, so that nothing is decoded twice
        plain = F.regexp_replace(plain, f"(?i)&{name};", char)
    return plain


def page_text(html: Column) -> Column:
    """What a page shows: without scripts and styles, a space for each tag, entities decoded, white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(html, SCRIPT, " "), "<[^>]*>", " ")
    return F.trim(F.regexp_replace(decode_entities(bare), r"(?U)\s+", " "))


def page_title(html: Column) -> Column:
    """The text of the first title element, else of the first h1, cut at the first separator; '' if there is neither."""
    title, heading = r"(?is)<title\b[^>]*>(.*?)</title>", r"(?is)<h1\b[^>]*>(.*?)</h1>"
    inner = F.when(html.rlike(title), F.regexp_extract(html, title, 1)).when(html.rlike(heading), F.regexp_extract(html, heading, 1)).otherwise("")
    return F.when(html.isNotNull(), F.trim(F.regexp_replace(page_text(inner), TITLE_SUFFIX, "")))


_JSONLD = re.compile(r"<script\b[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>", re.IGNORECASE | re.DOTALL)


def recipes(html: str) -> list[str]:
    """The JSON of every Recipe node of every block, in document order, nested ones after those around them; malformed blocks are skipped."""
    out: list[str] = []

    for block in _JSONLD.findall(html):
        try:
            waiting = [json.loads(block)]
            while waiting:
                node = waiting.pop()
                if isinstance(node, dict):
                    kind = node.get("@type")
                    if kind == "Recipe" or isinstance(kind, list) and "Recipe" in kind:
                        out.append(json.dumps(node, ensure_ascii=False))
                    node = list(node.values())
                if isinstance(node, list):
                    waiting += reversed(node)
        except (ValueError, RecursionError):  # json.dumps of a node nested beyond the interpreter's depth
            continue
    return out


@pandas_udf(ArrayType(StringType()))
def jsonld_recipes(html: pd.Series) -> pd.Series:
    return html.map(recipes, na_action="ignore")
