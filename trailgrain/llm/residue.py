"""Template residue and error-page text, found by labelled exemplars.

An inverted index leads from an exemplar's rarest words to the exemplar: from so
many that the pairs without any of them can't make up enough of it, so none is
missed.  The sentences of a page that hold such a word are its passage windows; an exemplar
is found in a window if the pairs of neighbouring words they share make up
enough of the exemplar, weighted by inverse document frequency over all pages.
Unfilled template syntax is one token whatever is in it, so it is an exemplar
of its own; filler is told by how much of a window lies within the filler's
vocabulary.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailgrain.functions.arrowkit import map_batches
from trailgrain.llm.boilerplate import restored
from trailgrain.llm.exemplars import FILLER, FINE, RESIDUE, WHOLE

#: Share of an exemplar's weight that a window must hold.
COVERAGE = 0.8
#: Share of a window's words, and their least number, that make it filler.
FILLER_SHARE, FILLER_WORDS = 0.7, 5

# The syntax of common template languages, and names of fields in them.
TEMPLATE = re.compile(
    r"\{\{\{?[^{}\n]{1,80}\}?\}\}|\{%=?[^%\n]{1,80}%\}|<%=?[^%\n]{1,80}%>|\[\[\s*[\w.]+\s*\]\]|\$\{\s*[\w.]+\s*\}|%%[\w.]+%%|@@[\w.]+@@|\*\|[A-Z_:]+\|\*"
    r"|__[A-Z][A-Z_]+__|#[A-Z]+(?:_[A-Z]+)*#|\[(?:INSERT|YOUR|ENTER|ADD) [A-Z ]+\]"
    r"|\{(?:[a-zA-Z]+[_.][\w.]*|title|author|name|date|year|servings|description|excerpt|content|body|url|email|city|username)\}"
    r"|(?<!\S)recipe_card\.\w+|(?m:^)[a-z]+(?:_[a-z]+)+$"
)
#: What any template has.
_SIGN = re.compile(r"[{%<\[$@*_#]|recipe_card")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s*")
_CJK = re.compile("[ぁ-ヿ一-鿿]")


def words(text: str) -> list[str]:
    """Lower-case words; runs of Japanese give their characters.  NaN keeps its case, as other words are spelt nan too."""
    if "NaN" not in text and (text.isascii() or not _CJK.search(text)):
        return _WORD.findall(text.lower().replace("’", "'"))
    out = []
    for w in _WORD.findall(text):
        if w != "NaN":
            w = w.lower().replace("’", "'")
        if not w.isascii() and _CJK.search(w):
            out.extend(w)
        else:
            out.append(w)
    return out


def pairs(tokens: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(tokens, tokens[1:], strict=False)} if len(tokens) > 1 else set(tokens)


@lru_cache(maxsize=1)
def exemplars() -> list[tuple[bool, frozenset[str], frozenset[str]]]:
    """(is residue, pairs, words) of every exemplar."""
    out = []
    for label, lines in ((True, RESIDUE), (False, FINE)):
        for line in lines.splitlines():
            w = words(line)
            out.append((label, frozenset(pairs(w)), frozenset(w)))
    return out


@lru_cache(maxsize=1)
def vocabulary() -> frozenset[str]:
    """Words and pairs whose document frequencies are needed: bounded by the exemplars."""
    return frozenset().union(*(p | w for _, p, w in exemplars()))


class ResidueIndex:
    """The inverted index under given document frequencies."""

    def __init__(self, frequencies: dict[str, int], documents: int):
        n = max(1, documents)
        self.weight = {t: math.log((n + 1) / (frequencies.get(t, 0) + 0.5)) + 0.1 for t in vocabulary()}
        self.by_word: dict[str, list[int]] = {}
        for i, (_, ps, w) in enumerate(exemplars()):
            total = sum(self.weight[p] for p in ps)
            left = set(ps)
            for word in sorted(w, key=lambda t: (-self.weight[t], t)):
                self.by_word.setdefault(word, []).append(i)
                left = {p for p in left if word not in p.split(" ")}
                if sum(self.weight[p] for p in left) < COVERAGE * total - 1e-9:
                    break  # a window without the words so far can't hold enough of the exemplar
        self.total = [sum(self.weight[p] for p in ps) for _, ps, _ in exemplars()]
        self.whole = frozenset(WHOLE.splitlines())
        self.filler = frozenset(FILLER.split())

    @staticmethod
    @lru_cache(maxsize=1)
    def plain() -> ResidueIndex:
        """The index without frequencies: every word weighs the same."""
        return ResidueIndex({}, 1)

    def window(self, tokens: list[str], found: set[str]) -> bool:
        """Whether a window holds residue, given the index words in it."""
        here = pairs(tokens) | set(tokens)
        best = {True: 0.0, False: 0.0}
        for i in {i for w in found for i in self.by_word[w]}:
            label, wanted, _ = exemplars()[i]
            cover = sum(self.weight[p] for p in wanted if p in here) / self.total[i]
            best[label] = max(best[label], cover)
        return best[True] >= COVERAGE and best[True] > best[False] - 0.05 * (best[False] >= COVERAGE) and best[False] < COVERAGE

    def field(self, text: str, title: bool = False) -> bool:
        """Whether a title or text holds residue."""
        if _SIGN.search(text) and TEMPLATE.search(text):
            return True
        if title and text.strip().lower() in self.whole:
            return True
        tokens = set(words(text))
        found = tokens & self.by_word.keys()
        filler = len(tokens & self.filler) >= FILLER_WORDS - 1
        if not found and not filler and not title:
            return False

        def may_hold(part: str) -> bool:
            """Whether ``part`` has an index word, or can be filler: what has neither isn't split into words."""
            low = part.lower().replace("’", "'")
            return filler or any(w in low for w in found) or "NaN" in found and "NaN" in part

        for line in filter(may_hold, text.split("\n")):
            for window in filter(may_hold, _SENTENCE.split(line)):
                w = words(window)
                if found and (here := found.intersection(w)) and self.window(w, here):
                    return True
                if filler and len(w) >= FILLER_WORDS and sum(t in self.filler for t in w) >= FILLER_SHARE * len(w):
                    return True
        return False

    def page(self, title: str | None, text: str | None) -> bool:
        return bool(title and self.field(restored(title), True)) or bool(text and self.field(restored(text)))


def document_frequencies(pages: DataFrame, title: str = "title", text: str = "text") -> tuple[dict[str, int], int]:
    """Over all pages: in how many each word and pair of the exemplars occurs, and how many pages there are."""
    wanted = vocabulary()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[str, int] = {"": batch.num_rows}
        starts = {p.split(" ")[0] for p in wanted if " " in p}
        for head, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tokens = words(f"{head or ''}\n{body or ''}")
            seen = wanted.intersection(tokens)
            seen = set(seen) | {p for a, b in zip(tokens, tokens[1:], strict=False) if a in starts and (p := f"{a} {b}") in wanted}
            for t in seen:
                counts[t] = counts.get(t, 0) + 1
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "n"])

    part = pages.select(pages[title].alias("title"), pages[text].alias("text"))
    rows = map_batches(part, run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}
    return counts, counts.pop("", 0)


def find_residue(pages: DataFrame, key: str = "page_id", title: str = "title", text: str = "text") -> DataFrame:
    """``key`` of each page with residue in its title or text.

    Null and empty fields hold none; an empty table gives no rows; repeated
    rows give repeated results.  The pages are read twice, first for the
    document frequencies of the exemplars' words, of which there are as many as
    the exemplars have, however large the table.
    """
    frequencies = document_frequencies(pages, title, text)
    kind = pages.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        index = ResidueIndex(*frequencies)
        keep = [index.page(a, b) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_()))], names=["key"])

    part = pages.select(pages[key].alias("key"), pages[title].alias("title"), pages[text].alias("text"))
    return map_batches(part, run, f"key {kind}").withColumnRenamed("key", key)


def without_residue(pages: DataFrame, key: str = "page_id", title: str = "title", text: str = "text") -> DataFrame:
    """``pages`` without those that hold residue."""
    return pages.join(find_residue(pages, key, title, text).distinct(), key, "left_anti")
