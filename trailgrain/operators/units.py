"""Quantities of many units, spellings and number forms, in common base units.

``read_amount`` understands free-form amounts: mixed numbers, ranges (their
mean), counts of a size (their product), sums of two units, equivalents (the
first counts) and words of approximation.  ``unit_shifts`` finds units that no
text tells: it cuts the history of a source's values by exact penalised
changepoint search on their logarithms and reverses level shifts that match the
factor between two units.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailgrain.functions.arrowkit import map_batches
from trailgrain.operators.nested import child_rows, read_json

# Spellings of the units, by the names of the table of units.  Letter case doesn't matter.
SPELLINGS = {
    "gram": "g|gr|gram|grams|gramm|gramme|grammes|gramo|gramos|grammo|grammi|grama|gramas|grammaa|gramma|gramy|gramów|г|гр|грамм|грамма|граммов|グラム",
    "kilogram": "kg|kgs|kilo|kilos|kilogram|kilograms|kilogramm|kilogrammes|kilogramo|kilogramos|chilo|chili|chilogrammo|chilogrammi|quilo|quilos|quilograma|quilogramas|kiloa|кг|килограмм|килограмма|килограммов|キロ|キログラム",
    "milligram": "mg|milligram|milligrams|milligramm|milligrammes|miligramo|miligramos|milligrammi|miligramas|мг|миллиграмм",
    "ounce": "oz|oz.|ounce|ounces|unze|unzen|once|onces|onza|onzas|oncia|once|onça|onças|унция|унции|オンス",
    "pound": "lb|lbs|lb.|lbs.|pound|pounds|libra|libras|libbra|libbre|livre|livres|ポンド",
    "hectogram": "hg|hekto|hektogram|ettogrammo|ettogrammi|etto|etti",
    "decagram": "dag|dkg|deka|dekagramm|dekagram|dekagramy",
    "german pound": "pfund|pfd|pfd.|pond|funt|funty",
    "dutch ons": "ons",
    "milliliter": "ml|cc|milliliter|milliliters|millilitre|millilitres|mililitro|mililitros|millilitri|millilitraa|mililitr|mililitry|мл|миллилитр|миллилитров|ミリリットル|シーシー",
    "centiliter": "cl|centiliter|centilitre|centilitres|centilitro|centilitros|centilitri|сл",
    "deciliter": "dl|deciliter|decilitre|décilitre|décilitres|decilitro|decilitri|desilitra|desilitraa|дл|デシリットル",
    "liter": "l|lt|ltr|liter|liters|litre|litres|litro|litros|litri|litraa|litra|litr|litry|litrów|л|литр|литра|литров|リットル",
    "teaspoon": "tsp|tsp.|tsps|teaspoon|teaspoons|tl|tl.|teelöffel|c. à c.|c.à.c.|c à c|càc|cc.|cuillère à café|cuillères à café|cuil. à café|cdta|cdta.|cdtas|cucharadita|cucharaditas|cucchiaino|cucchiaini|colher de chá|colheres de chá|theelepel|theelepels|tsk|tsk.|tesked|teskedar|teelusikka|teelusikallinen|teelusikallista|łyżeczka|łyżeczki|łyżeczek|ч. л.|ч.л.|ч л|чайная ложка|чайные ложки|чайных ложек|小さじ",
    "tablespoon": "tbsp|tbsp.|tbsps|tbs|tablespoon|tablespoons|el|el.|esslöffel|c. à s.|c.à.s.|c à s|càs|cuillère à soupe|cuillères à soupe|cuil. à soupe|cda|cda.|cdas|cucharada|cucharadas|cucchiaio|cucchiai|colher de sopa|colheres de sopa|eetlepel|eetlepels|msk|msk.|matsked|matskedar|rkl|rkl.|ruokalusikka|ruokalusikallinen|ruokalusikallista|łyżka|łyżki|łyżek|ст. л.|ст.л.|ст л|столовая ложка|столовые ложки|столовых ложек|大さじ",
    "cup": "cup|cups|tasse|tassen|tasses|taza|tazas|tazza|tazze|xícara|xícaras|kopje|kopjes|kop|kopp|koppar|kuppi|kuppia|kupillinen|szklanka|szklanki|szklanek|стакан|стакана|стаканов|カップ",
    "fluid ounce": "fl oz|fl. oz.|fl. oz|fl.oz.|floz|fluid ounce|fluid ounces",
    "pint": "pint|pints|pt|pinte|pintes|pinta|pintas|pinte",
    "spice measure": "krm|krm.|kryddmått|maustemitta|maustemittaa|mm.",
    "kilocalorie": "kcal|kilocalorie|kilocalories|kilokalorien|cal|cal.|cals|calorie|calories|calorías|kalorien|kalorier|calorieën|calorias|ккал|キロカロリー",
    "kilojoule": "kj|kilojoule|kilojoules|кдж",
    "megajoule": "mj|megajoule|megajoules|мдж",
    "second": "s|sec|secs|sec.|second|seconds|sekunde|sekunden|seconde|secondes|segundo|segundos|secondo|secondi|seconden|sekund|sekunder|sekuntia|сек|секунд|秒",
    "minute": "min|mins|min.|mins.|minute|minutes|minuten|minuto|minutos|minuti|minut|minuter|minuuttia|minuty|мин|минут|минуты|分",
    "hour": "h|hr|hrs|hr.|hrs.|hour|hours|stunde|stunden|std|std.|heure|heures|hora|horas|ora|ore|uur|timme|timmar|tunti|tuntia|godzina|godziny|godzin|ч|час|часа|часов|時間",
}
# Numbers in words.
NUMBER_WORDS = {
    "half": "1/2", "half a": "1/2", "half an": "1/2", "a half": "1/2", "one half": "1/2", "a quarter": "1/4", "a quarter of a": "1/4", "quarter": "1/4", "one quarter": "1/4", "three quarters": "3/4", "a third": "1/3", "a third of a": "1/3",
    "two thirds": "2/3", "a dozen": "12", "a": "1", "an": "1", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10", "eleven": "11", "twelve": "12", "a couple of": "2",
    "ein": "1", "eine": "1", "einen": "1", "ein halber": "1/2", "ein halbes": "1/2", "eine halbe": "1/2", "einen halben": "1/2", "zwei": "2", "drei": "3", "vier": "4", "un": "1", "une": "1", "un demi": "1/2", "une demi": "1/2", "deux": "2", "trois": "3", "quatre": "4",
    "una": "1", "uno": "1", "medio": "1/2", "media": "1/2", "dos": "2", "tres": "3", "cuatro": "4", "mezzo": "1/2", "mezza": "1/2", "due": "2", "tre": "3", "quattro": "4", "um": "1", "uma": "1", "meio": "1/2", "meia": "1/2", "dois": "2", "duas": "2", "três": "3",
    "een": "1", "halve": "1/2", "een halve": "1/2", "twee": "2", "drie": "3", "en": "1", "ett": "1", "halv": "1/2", "en halv": "1/2", "två": "2", "yksi": "1", "puoli": "1/2", "kaksi": "2", "kolme": "3", "jeden": "1", "jedna": "1", "pół": "1/2", "dwa": "2", "dwie": "2", "trzy": "3",
    "один": "1", "одна": "1", "пол": "1/2", "полтора": "3/2", "два": "2", "две": "2", "три": "3", "半": "1/2", "一": "1", "二": "2", "三": "3",
}
VULGAR = {"½": "1/2", "¼": "1/4", "¾": "3/4", "⅓": "1/3", "⅔": "2/3", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8", "⅕": "1/5", "⅖": "2/5", "⅗": "3/5", "⅘": "4/5", "⅙": "1/6", "⅚": "5/6"}
APPROXIMATION = r"(?:about|approx\.?|approximately|around|roughly|circa|ca\.?|c\.|scant|heaped|rounded|level|generous|nearly|almost|some|etwa|ungefähr|knapp|gut|environ|unos|unas|aprox\.?|circa|cerca de|ongeveer|ungefär|noin|około|ok\.|около|примерно|約|およそ|~|≈|±|∼)"
#: The units' names that the table of units lacks.
EXTRA = {"milligram": ("mass", Fraction(1))}

Factors = dict[str, tuple[str, Fraction]]


def factors(units: DataFrame) -> Factors:
    """dimension and base value of each unit; the table holds a fixed, small number of rows."""
    rows = units.select("unit", "dimension", "base_value").collect()
    return EXTRA | {r["unit"]: (r["dimension"], Fraction(r["base_value"])) for r in rows if r["unit"] and r["base_value"] is not None}


def _alternatives(words) -> str:
    return "|".join(sorted((re.escape(w).replace(r"\ ", r"\s*") if not w.isascii() or "." in w else re.escape(w).replace(r"\ ", r"\s+") for w in words), key=len, reverse=True))


@lru_cache(maxsize=1)
def _grammar():
    by_word = {re.sub(r"\s+", "", w.lower()): unit for unit, words in SPELLINGS.items() for w in words.split("|")}
    letters = {w for words in SPELLINGS.values() for w in words.split("|")}
    japanese = {w for w in letters if re.search("[ぁ-ヿ一-鿿]", w)}
    unit = rf"(?:(?:{_alternatives(letters - japanese)})(?![^\W\d_])|(?:{_alternatives(japanese)}))"
    number = r"(?:\d+\s+\d+/\d+|\d+/\d+|\d{1,3}(?:[ '’]\d{3})+(?!\d)|\d+[.,]\d+|\d+)"
    spoken = rf"(?:{_alternatives(NUMBER_WORDS)})(?![^\W\d_])"
    approx = rf"(?:{APPROXIMATION}\s*)*"
    span = rf"{number}(?:\s*(?:-|–|—|〜|～|to|bis|à|do|до|a|tot|till|ad|−)\s*{number})?"
    compiled = {
        "times": re.compile(rf"(?P<count>{number})\s*[x×*✕]\s*{approx}(?P<span>{span})\s*(?P<unit>{unit})", re.IGNORECASE),
        "packets": re.compile(rf"(?P<count>{number})\s*(?P<noun>[^\d()]{{0,24}}?)\(\s*{approx}(?:each|je|à)?\s*(?P<span>{span})[\s-]*(?P<unit>{unit})[^)]*\)", re.IGNORECASE),
        "plain": re.compile(rf"(?<![\d/.,])(?P<span>{span})\s*-?\s*(?P<unit>{unit})(?:\s*(?:and|und|et|y|e|en|och|ja|i|и|,|\+)?\s*(?P<second>{number})\s*(?P<unit2>{unit}))?", re.IGNORECASE),
        "spoken": re.compile(rf"(?<![^\W\d_])(?P<word>{spoken})\s+(?:of\s+)?(?P<unit>{unit})", re.IGNORECASE),
        "prefixed": re.compile(rf"(?P<unit>大さじ|小さじ|カップ)\s*{approx}(?P<span>{span}|半)", re.IGNORECASE),
        "bare": re.compile(rf"\s*{approx}(?P<span>{span}|{spoken})\s*", re.IGNORECASE),
        "unit": re.compile(unit, re.IGNORECASE),
        "sides": re.compile(r"\s*(?:-|–|—|〜|～|to|bis|à|do|до|a|tot|till|ad|−)\s*", re.IGNORECASE),
    }
    return compiled, by_word


def _plain(text: str) -> str:
    """Vulgar fractions, full-width digits and unusual spaces in plain characters."""
    if not text.isascii():
        text = re.sub(r"(\d)?([½¼¾⅓⅔⅛⅜⅝⅞⅕⅖⅗⅘⅙⅚])", lambda m: f"{m[1]} {VULGAR[m[2]]}" if m[1] else VULGAR[m[2]], text)
        text = text.translate({0xA0: " ", 0x2009: " ", 0x202F: " ", 0x3000: " ", 0x2044: "/", **{0xFF10 + i: str(i) for i in range(10)}, 0xFF0E: ".", 0xFF0F: "/"})
    return text


def _number(text: str) -> Fraction | None:
    text = text.strip().lower()
    if text in NUMBER_WORDS:
        text = NUMBER_WORDS[text]
    try:
        whole, _, part = text.rpartition(" ")
        if "/" in part:
            return Fraction(part) + (Fraction(whole) if whole else 0)
        text = re.sub(r"[ '’]", "", text)
        if re.fullmatch(r"[1-9]\d{0,2}[.,]\d{3}", text):  # a mark before three digits parts thousands
            text = re.sub("[.,]", "", text)
        return Fraction(text.replace(",", "."))
    except (ValueError, ZeroDivisionError):
        return None


def _mean(span: str) -> Fraction | None:
    """A number, or the mean of a range; mixed numbers and fractions hold no range sign."""
    compiled, _ = _grammar()
    sides = compiled["sides"].split(span.strip(), maxsplit=1)
    values = [_number(s) for s in sides if s]
    return None if None in values or not values else sum(values, Fraction(0)) / len(values)


def read_amount(text: str | None, units: Factors, dimensions: tuple[str, ...] = ("mass", "volume"), unit_from: str | None = None) -> tuple[str, int] | None:
    """(dimension, value in the base unit) of the first amount in ``text``; None if it has no unit of ``dimensions``.

    ``unit_from`` is a neighbouring text that may name the unit of a bare
    number.  Values are rounded to the nearest integer, halves to the even one.
    """
    if not text:
        return None
    compiled, by_word = _grammar()
    text = _plain(text)

    def value(span: str, unit: str) -> tuple[str, Fraction] | None:
        known = units.get(by_word.get(re.sub(r"\s+", "", unit.lower()), ""))
        number = _number(span) if span in NUMBER_WORDS else _mean(span)
        return None if known is None or number is None or known[0] not in dimensions else (known[0], number * known[1])

    def done(found: tuple[str, Fraction]) -> tuple[str, int]:
        return found[0], round(found[1])

    if any(c.isdigit() for c in text) or "半" in text:
        matches = [(m.start(), -m.end(), kind, m) for kind in ("times", "packets", "plain", "prefixed") if (m := compiled[kind].search(text))]
        for _, _, kind, m in sorted(matches, key=lambda x: x[:2]):
            first = value(m["span"].replace("半", "1/2"), m["unit"])
            if kind == "packets" and compiled["unit"].match(m["noun"].strip()):
                continue  # the number before the brackets has a unit of its own, which the plain form reads
            if first is None:
                continue
            if kind in ("times", "packets"):
                count = _number(m["count"])
                if count is not None:
                    return done((first[0], first[1] * count))
            elif kind == "plain" and m["second"] and (other := value(m["second"], m["unit2"])) and other[0] == first[0] and other[1] < first[1]:
                return done((first[0], first[1] + other[1]))
            else:
                return done(first)
    if m := compiled["spoken"].search(text):
        if found := value(re.sub(r"\s+", " ", m["word"].lower()), m["unit"]):
            return done(found)
    if unit_from and (m := compiled["bare"].fullmatch(text)):
        if found := value(m["span"].lower(), unit_from):
            return done(found)
    return None


_NEIGHBOUR = re.compile(r"(?:amount|measured|given|weighed|quantity)?\s*(?:in\s+)?(?P<unit>[^\W\d_]+(?:\s[^\W\d_]+)?\.?)(?:,\s*roughly|\s*approx\.?)?", re.IGNORECASE)
_ITEM_UNIT = re.compile(r"(?:\((?P<in>[^()\d]{1,14})\)|,\s*(?P<after>[^,()\d]{1,14}))\s*$")


def neighbour_unit(item: str | None, note: str | None) -> str | None:
    """The unit that a note or the end of an item's name gives for a bare number."""
    _, by_word = _grammar()
    candidates = []
    if note and (m := _NEIGHBOUR.fullmatch(note.strip())):
        candidates.append(m["unit"])
    if item and (m := _ITEM_UNIT.search(item)):
        candidates.append((m["in"] or m["after"]).strip())
    return next((c for c in candidates if re.sub(r"\s+", "", c.lower()) in by_word), None)


_ISO = re.compile(r"P(?:(\d+(?:[.,]\d+)?)Y)?(?:(\d+(?:[.,]\d+)?)M)?(?:(\d+(?:[.,]\d+)?)W)?(?:(\d+(?:[.,]\d+)?)D)?(?:T(?:(\d+(?:[.,]\d+)?)H)?(?:(\d+(?:[.,]\d+)?)M)?(?:(\d+(?:[.,]\d+)?)S)?)?", re.IGNORECASE)
_CLOCK = re.compile(r"(\d{1,3}):(\d{2})(?::(\d{2}))?\s*(?:h|hr|hrs|hours?|std\.?|uhr|ч)?\.?", re.IGNORECASE)


def read_duration(value: object, units: Factors) -> tuple[str, int] | None:
    """Seconds of an ISO 8601 duration, hours and minutes with a colon, or an amount with units of time."""
    if not isinstance(value, str):
        return None
    text = value.strip()
    if (m := _ISO.fullmatch(text)) and any(m.groups()):
        years, months, weeks, days, hours, minutes, seconds = (Fraction((g or "0").replace(",", ".")) for g in m.groups())
        total = (years * 365 + months * 30 + weeks * 7 + days) * 86400 + hours * 3600 + minutes * 60 + seconds
        return "duration", round(total)
    if m := _CLOCK.fullmatch(text):
        return "duration", int(m[1]) * 3600 + int(m[2]) * 60 + int(m[3] or 0)
    return read_amount(text, units, ("duration",))


def read_quantity(value: object, units: Factors, dimensions: tuple[str, ...]) -> tuple[str, int] | None:
    """A nutrition value: text, or an object whose neighbouring field names the unit."""
    if isinstance(value, list):
        value = next((v for v in value if v is not None), None)
    if isinstance(value, dict):
        number = value.get("value", value.get("amount"))
        unit = next((value[k] for k in ("unitText", "unitCode", "unit") if isinstance(value.get(k), str)), None)
        if isinstance(number, str) and (found := read_amount(number, units, dimensions)):
            return found
        return None if number is None or isinstance(number, bool) or unit is None else read_amount(f"{number} {unit}", units, dimensions)
    return read_amount(value, units, dimensions) if isinstance(value, str) else None


# Fields of nutrition and of the recipe, their names in the result, and the dimensions they can have.
NUTRITION = {"calories": ("calories", ("energy",)), "servingSize": ("servingsize", ("mass", "volume")), "proteinContent": ("protein", ("mass",)), "fatContent": ("fat", ("mass",)), "sodiumContent": ("sodium", ("mass",))}
TIMES = {"prepTime": "preptime", "cookTime": "cooktime"}

Row = tuple[str, int, str, int]


def recipe_amounts(recipe: dict, units: Factors) -> list[Row]:
    """(field_name, item_no, dimension, base_value) of a schema.org Recipe."""
    rows: list[Row] = []
    for table, _, no, _, node in child_rows(recipe):
        if table == "ingredient" and (found := read_amount(node if isinstance(node, str) else node.get("name") if isinstance(node, dict) else None, units)):
            rows.append(("ingredient", no, *found))
    facts = recipe.get("nutrition")
    facts = next((f for f in facts if isinstance(f, dict)), None) if isinstance(facts, list) else facts
    for key, (name, dimensions) in NUTRITION.items() if isinstance(facts, dict) else ():
        if found := read_quantity(facts.get(key), units, dimensions):
            rows.append((name, 0, *found))
    for key, name in TIMES.items():
        value = recipe.get(key)
        if found := read_duration(value[0] if isinstance(value, list) and value else value, units):
            rows.append((name, 0, *found))
    return rows


_SCHEMA = "rec_kind string, rec_key string, recipe_no int, field_name string, item_no int, dimension string, base_value long"


def _batch(kind: str, rows: list[tuple[str, int, Row]]) -> pa.RecordBatch:
    columns = list(zip(*((kind, key, no, *row) for key, no, row in rows), strict=True)) if rows else [()] * 7
    kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in _SCHEMA.split(", ")])


def page_amounts(pages: DataFrame, units: Factors, key: str = "page_id", column: str = "jsonld") -> DataFrame:
    """The amounts of all recipes of ``pages``; null columns and unreadable elements give none."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for owner, elements in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for no, element in enumerate(elements or ()):
                if recipe := read_json(element):
                    out += [(owner, no, row) for row in recipe_amounts(recipe, units)]
        return _batch("page", out)

    part = pages.where(F.col(column).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(column).alias("elements"))
    return map_batches(part, run, _SCHEMA)


def dish_amounts(dishes: DataFrame, units: Factors, key: str = "id", column: str = "ingredients") -> DataFrame:
    """The amounts of ``dishes``, the unit of a bare number from the item's note or name; null parts give none."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for owner, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for no, item in enumerate(items or ()):
                if item and (found := read_amount(item["amount"], units, unit_from=neighbour_unit(item["item"], item["note"]))):
                    out.append((owner, 0, ("ingredient", no, *found)))
        return _batch("dish", out)

    part = dishes.where(F.col(column).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(column).alias("items"))
    return map_batches(part, run, _SCHEMA)


def amounts(pages: DataFrame, dishes: DataFrame, units: DataFrame) -> DataFrame:
    """The distinct amounts of pages and dishes in base units."""
    known = factors(units)
    return page_amounts(pages, known).unionByName(dish_amounts(dishes, known)).distinct()


def bare_energies(pages: DataFrame, key: str = "page_id", column: str = "jsonld", source: str = "domain", order: str = "fetched_at") -> DataFrame:
    """``key``, ``recipe_no``, ``source``, ``order`` and ``value`` of every recipe's energy that is given without a unit."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, numbers, values = [], [], []
        for row, elements in enumerate(batch.column(3).to_pylist()):
            for no, element in enumerate(elements or ()):
                facts = recipe.get("nutrition") if (recipe := read_json(element)) else None
                facts = next((f for f in facts if isinstance(f, dict)), None) if isinstance(facts, list) else facts
                bare = facts.get("calories") if isinstance(facts, dict) else None
                number = _number(str(bare)) if isinstance(bare, (int, float, str)) and not isinstance(bare, bool) else None
                if number is not None and 0 < number < 10**9:
                    rows.append(row)
                    numbers.append(no)
                    values.append(float(number))
        at = pa.array(rows, pa.int64())
        own, *rest = (batch.column(i).take(at) for i in range(3))
        return pa.RecordBatch.from_arrays([own, pa.array(numbers, pa.int32()), *rest, pa.array(values, pa.float64())], names=["key", "recipe_no", "source", "order", "value"])

    part = pages.where(F.col(column).isNotNull()).select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(order).alias("order"), F.col(column).alias("elements"))
    ordered = pages.schema[order].dataType.simpleString()
    return map_batches(part, run, f"key {kind}, recipe_no int, source string, `order` {ordered}, value double").toDF(key, "recipe_no", source, order, "value")


# ---- units that only a source's history tells

#: The penalty of a further segment (in squared log units).
PENALTY = 1.5


def changepoints(values: np.ndarray, penalty: float = PENALTY, least: int = 3) -> list[int]:
    """Starts of the segments of constant mean with the least squared error plus ``penalty`` a segment: exact, by functional pruning.

    A start is kept as long as some mean makes it the best one.  Which of two
    starts is better for a mean never changes afterwards, so the axis of means
    is divided among the starts, and few are left however long the history is.
    """
    n = len(values)
    if n < least:
        return [0]
    values = values - values.mean()
    sums = np.concatenate(([0.0], np.cumsum(values)))
    squares = np.concatenate(([0.0], np.cumsum(values**2)))
    best, last = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
    best[0] = -penalty
    # Pieces of the axis and the start that is best there.
    low, high, owner = np.array([values.min() - 1]), np.array([values.max() + 1]), np.array([0])
    for end in range(least, n + 1):
        new = end - least  # the start that can begin a last segment from here on
        if new and np.isfinite(best[new]):
            size = new - owner
            mean = (sums[new] - sums[owner]) / size
            room = (best[new] - best[owner] - (squares[new] - squares[owner])) / size + mean**2
            reach = np.sqrt(np.maximum(room, 0.0))
            left = np.where(room >= 0, np.clip(mean - reach, low, high), high)  # within [left, right] the owner stays the best
            right = np.where(room >= 0, np.clip(mean + reach, low, high), high)
            low = np.stack((low, left, right), axis=1).ravel()
            high = np.stack((left, right, high), axis=1).ravel()
            owner = np.stack((np.full(len(owner), new), owner, np.full(len(owner), new)), axis=1).ravel()
            some = high > low
            low, high, owner = low[some], high[some], owner[some]
            first = np.concatenate(([True], owner[1:] != owner[:-1]))
            low, high, owner = low[first], high[np.concatenate((first[1:], [True]))], owner[first]
        size = end - owner
        total = best[owner] + penalty + squares[end] - squares[owner] - (sums[end] - sums[owner]) ** 2 / size
        k = int(np.argmin(total))
        best[end], last[end] = total[k], owner[k]
    starts, end = [], n
    while end > 0:
        end = int(last[end])
        starts.append(end)
    return starts[::-1]


def unit_shifts(values: DataFrame, source: str, order: str, value: str, key: str | Sequence[str], factor: float, tolerance: float = 0.15, penalty: float = PENALTY) -> DataFrame:
    """``key`` (one or several columns), ``source``, ``segment``, ``unit_factor`` and ``restored`` of every positive value.

    A source's values in the order of ``order`` (equal ones by ``key``) are one
    history and segmented as a whole, in one task.  A segment whose level lies
    above the source's lowest by ``factor`` (give or take ``tolerance`` in log
    units) is in the other unit, and its values are divided by it.  Null or
    nonpositive values and null sources give no row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    inner = [f"key{i}" for i in range(len(keys))]
    positive = values.where(F.col(value) > 0).select(*(F.col(k).alias(i) for k, i in zip(keys, inner, strict=True)), F.col(source).alias("source"), F.col(order).alias("order"), F.col(value).cast("double").alias("value")).where("source is not null")
    place = F.row_number().over(Window.partitionBy("source").orderBy(F.col("order").asc_nulls_first(), *inner)) - 1
    placed = positive.withColumn("place", place).drop("order")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        logs = np.log(np.asarray(table["value"], dtype=float))
        starts = changepoints(logs, penalty)
        sizes = np.diff([*starts, len(logs)])
        levels = np.array([np.median(part) for part in np.split(logs, starts[1:])])
        shifted = np.abs(levels - levels.min() - math.log(factor)) <= tolerance
        scale = np.repeat(np.where(shifted, factor, 1.0), sizes)
        segment = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
        return pa.table([*(table[i] for i in inner), table["source"], pa.array(segment), pa.array(scale), pa.array(np.exp(logs) / scale)], names=[*inner, "source", "segment", "unit_factor", "restored"])

    types = ", ".join(f"{i} {positive.schema[i].dataType.simpleString()}" for i in inner)
    schema = f"{types}, source {positive.schema['source'].dataType.simpleString()}, segment int, unit_factor double, restored double"
    return placed.groupBy("source").applyInArrow(run, schema).toDF(*keys, source, "segment", "unit_factor", "restored")
