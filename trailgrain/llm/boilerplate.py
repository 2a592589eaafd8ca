"""Main content of pages: composite text density over a page's block tree.

The stored text keeps one line per page block, so the tree is page - region -
block - inline node.  A block's inline nodes are the pieces between its
separators; a region is a run of blocks without a block of links between them.
Every node has characters, nodes (tags), characters in links and links, and from
them its composite density: characters per node, times how far its characters
and nodes exceed those in links (``composite``).  Densities are summed up the
tree; the region with the largest sum is the page's body.  The threshold is the
smallest density on the path from it to the page, taken as a part of what the
node would have without links, and blocks below that part are furniture.

The stored text has no markup, so what is a link must be told from the text:

* inline nodes that consist of anchor texts, blocks that begin with a label or
  root of links, and known notices (``furniture``: fixed values);
* labels: blocks of short pieces without a sentence, in a page whose body has
  sentences, that are neither its headline nor filler that stands for content.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailgrain.functions.arrowkit import map_batches
from trailgrain.llm import encoding
from trailgrain.llm.furniture import ANCHORS, LABELS, LISTS, NOTICES, ROOTS

#: The path's threshold is at most so much of a block's density without links.
MOST = 0.5
#: Share of a notice's words that a line must have, and of the line's words that the notice must have.
NOTICE_COVER = 0.8
#: A label has pieces of at most so many characters and words; of scripts without spaces only characters count.
LABEL_CHARS, LABEL_WORDS = 48, 7
MEMO_LINES = 200_000

SUSPECT = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: "\\u%04x" % int(m[1], 16), encoding.SUSPECT))
#: Characters that no rule for garbled text looks for on their own.
_PLAIN = frozenset(map(chr, range(128))) | frozenset(encoding.PLAIN)
_SIGNS = re.compile(r"[{\[<$%@*_#]")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_PLACEHOLDER = re.compile(r"\{\{\{?.*?\}\}\}?|\{%.*?%\}|<%.*?%>|\[\[.*?\]\]|\$\{.*?\}|%%\w+%%|@@[\w.]+@@|\*\|\w+\|\*|__[A-Z_]+__|#[A-Z_]+#|\[INSERT [A-Z ]+\]|\{\w+\}")
_NODES = re.compile(r"\s*[|/·•>»–—,、]\s*|\s*\.\s+|\s*:\s*|\s{2,}")
_WORD = re.compile(r"[^\W_]+|[#@©]")
_LETTER = re.compile(r"[^\W\d_]")
#: A sentence: its stop after a letter, digit or closing sign, at the end of a line or before the next one.
_SENTENCE = re.compile(r"(?:[^\W_]|#)[)”“\"'’»\]%]*[.!?。！？…][)”“\"'’»\]」』]*(?=\s|$|(?<=[。！？]))|。")
_SEPARATED = re.compile(r"[|·•]| > | / | » ")


def _terms(text: str) -> list[str]:
    return [t for line in text.splitlines() for t in line.split("|")]


@dataclass(frozen=True)
class Rules:
    """The compiled vocabulary."""

    anchors: re.Pattern
    labels: re.Pattern
    lists: re.Pattern
    roots: re.Pattern
    notices: list[tuple[str, frozenset[str]]]
    index: dict[str, list[int]]
    triggers: ahocorasick.Automaton


@lru_cache(maxsize=1)
def _rules() -> Rules:
    def any_of(terms) -> str:
        return "|".join(sorted(map(re.escape, set(terms)), key=len, reverse=True))

    anchors = re.compile(rf"(?:{any_of(_terms(ANCHORS))})(?![^\W_])(?:[\s,]+(?:{any_of(_terms(ANCHORS))})(?![^\W_]))*[\s…#@.:!]*")
    labels = re.compile(rf"\s*(?:{any_of(_terms(LABELS))})\s*[:：]")
    lists = re.compile(rf"\s*(?:{any_of(_terms(LISTS))})\s*[:：]")
    roots = re.compile(rf"\s*(?:{ROOTS})\s*[>»›/]\s*\S")
    notices = [(n, frozenset(_WORD.findall(n))) for n in NOTICES.splitlines()]
    index: dict[str, list[int]] = {}
    for i, (_, words) in enumerate(notices):
        for w in words:
            index.setdefault(w, []).append(i)
    # A line that covers a notice lacks at most a fifth of its words, so it has one of any so many and one more.
    needed: dict[str, list[int]] = {}
    for i, (_, words) in enumerate(notices):
        rare = sorted(words - set("#@©"), key=lambda w: (len(index[w]), -len(w), w))
        for w in rare[: int((1 - NOTICE_COVER) * len(words) + 1e-9) + 1]:
            needed.setdefault(w, []).append(i)
    triggers = ahocorasick.Automaton()
    for w in sorted(needed):
        triggers.add_word(w, w)
    triggers.make_automaton()
    return Rules(anchors, labels, lists, roots, notices, needed, triggers)


def site_name(domain: str | None) -> re.Pattern | None:
    """Matches a site's name as its domain spells it: ``fog-pantry7.example`` names Fog Pantry, Fog & Pantry and FogPantry."""
    if not domain:
        return None
    host = domain.strip().lower().removeprefix("www.").split(".")[0]
    letters = re.sub(r"[\d\W_]+$", "", host)
    letters = re.sub(r"[\W_]+", "", letters)
    if len(letters) < 4:
        return None
    return re.compile(r"[ &]*".join(map(re.escape, letters)), re.IGNORECASE)


_site_name = lru_cache(maxsize=50_000)(site_name)


def notice_cover(masked: str) -> float:
    """How far a known notice and the line cover each other's words, 1 if they are the same; of notices that can reach NOTICE_COVER."""
    rules = _rules()
    if masked.startswith(("©", "copyright #")):
        return 1.0
    words = set(_WORD.findall(masked))
    best = 0.0
    for i in {i for w in words & rules.index.keys() for i in rules.index[w]}:
        own = rules.notices[i][1]
        best = max(best, len(words & own) / max(len(words), len(own)))
    return best


def composite(chars: float, tags: float, link_chars: float, link_tags: float, page_links: float) -> float:
    """Composite text density of a node: its characters per tag, adjusted for links.

    ``page_links`` is the share of the page's characters that are in links.  The
    base of the logarithm is the published one with the logarithm inside it left
    out, which is 1, and so no base, where a page has no links.  0 for a node
    that is all links.
    """
    if not chars:
        return 0.0
    gain = math.log(max(1.0, chars / max(1.0, link_chars) * tags / max(1.0, link_tags)))
    base = math.log(math.e + chars / max(1.0, chars - link_chars) * link_chars + page_links * chars)
    return chars / tags * gain / base


class Block(NamedTuple):
    """What a block counts: characters and nodes, those in links, and whether it is a label or has a sentence."""

    chars: int
    tags: int
    link_chars: int
    link_tags: int
    label: bool
    prose: bool


def _size(text: str) -> int:
    return len(text) - text.count(" ")


def read_block(masked: str) -> Block:
    """The counts of a block whose digits stand as # and whose site's name as @, in lower case."""
    rules = _rules()
    chars = _size(masked) or 1
    nodes = [n for n in _NODES.split(masked) if n and not n.isspace()] or [masked]
    prose = bool(_SENTENCE.search(masked))
    if rules.lists.match(masked):
        return Block(chars, len(nodes), 0, 0, False, prose)
    if rules.labels.match(masked) or rules.roots.match(masked) or notice_cover(masked) >= NOTICE_COVER:
        return Block(chars, len(nodes), chars, len(nodes), False, False)
    linked = [n for n in nodes if rules.anchors.fullmatch(n.strip()) or not _LETTER.search(n)]
    if len(linked) < len(nodes) and all(not _LETTER.search(n) for n in linked):
        linked = []  # numbers alone are links only among links
    label = not linked and not prose and all(len(n) <= LABEL_CHARS and n.count(" ") < LABEL_WORDS for n in nodes)
    return Block(chars, len(nodes), chars if len(linked) == len(nodes) else sum(map(_size, linked)), len(linked), label, prose)


def restored(text: str) -> str:
    """``text`` with misread parts put right, line by line the same."""
    if text.isascii() or "?" not in text and not (set(text) - _PLAIN):
        return text
    if SUSPECT.search(text):
        fixed = encoding.repair(text)
        if fixed.count("\n") == text.count("\n"):
            return fixed
    return text


def _same_words(a: str, b: str) -> bool:
    """Whether two headlines share half of the words of the longer one (or the characters, of scripts without spaces)."""
    x, y = set(_WORD.findall(a.lower())), set(_WORD.findall(b.lower()))
    if len(x) < 3 or len(y) < 3:
        x, y = set(a.lower()) - {" "}, set(b.lower()) - {" "}
        return 10 * len(x & y) >= 7 * max(len(x), len(y)) > 0
    return 2 * len(x & y) >= max(len(x), len(y))


class Blocks:
    """Decides the blocks of pages; a worker keeps the counts of lines by their masked form."""

    def __init__(self):
        self.memo: dict[str, Block] = {}

    def masked(self, text: str, site: re.Pattern | None) -> str:
        plain = _PLACEHOLDER.sub("", text) if _SIGNS.search(text) else text
        if site is not None and (m := site.search(plain)):
            plain = plain[: m.start()] + "@" + plain[m.end() :]
        return _SPACE.sub(" ", _DIGITS.sub("#", plain)).strip().lower().replace("’", "'")

    def read(self, line: str, site: re.Pattern | None) -> Block | None:
        """The counts of a line; None for a blank one."""
        text = line.strip()
        if not text:
            return None
        if len(text) > 160 and not _SEPARATED.search(text) and _SENTENCE.search(text, len(text) - 40):
            low, rules = text.lower(), _rules()
            if not rules.labels.match(low, 0, 48) and not rules.roots.match(low, 0, 48) and low[0] not in "©c" and next(rules.triggers.iter(low), None) is None:
                return Block(_size(text), 1 + text.count(". "), 0, 0, False, True)  # ends in a sentence, and has no word that every notice needs
        masked = self.masked(text, site)
        found = self.memo.get(masked)
        if found is None:
            if len(self.memo) > MEMO_LINES:
                self.memo.clear()
            found = self.memo[masked] = read_block(masked)
        return found

    def lines(self, text: str, domain: str | None, chars: int | None, title: str | None = None) -> list[bool]:
        """Whether each line of a page is furniture; a text that is shorter than ``chars`` was cut."""
        return self.plain_lines(restored(text), domain, chars is not None and chars > len(text), restored(title) if title else None)

    def plain_lines(self, text: str, domain: str | None, cut: bool, title: str | None = None) -> list[bool]:
        """The same for a restored text; the last line of a cut text is held against the beginnings of notices too."""
        site = _site_name(domain)
        lines = text.split("\n")
        blocks = [self.read(line, site) for line in lines]
        if cut and blocks[-1] is not None:
            blocks[-1] = blocks[-1]._replace(label=False)  # a cut sentence has no stop
        out = self.decide(blocks, lines, title)
        if cut and len(out) > 1 and not out[-1]:
            out[-1] = self.cut(lines[-1], site)
        return out

    def decide(self, blocks: list[Block | None], lines: list[str], title: str | None) -> list[bool]:
        """The tree, its densities and their threshold, and which blocks are below it."""
        blocks = self.labelled(blocks, lines, title)
        some = [b for b in blocks if b is not None]
        chars, links = sum(b.chars for b in some), sum(b.link_chars for b in some)
        if not links:
            return [False] * len(blocks)
        share = links / chars
        densities = [composite(b.chars, b.tags, b.link_chars, b.link_tags, share) if b else 0.0 for b in blocks]
        regions, own = [], []
        for i, d in enumerate(densities):
            if d > 0:
                own.append(i)
            elif blocks[i] is not None and own:
                regions.append(own)
                own = []
        if own:
            regions.append(own)
        body = max(regions, key=lambda r: sum(densities[i] for i in r), default=[])
        threshold = min([MOST, self.part(some, share)] + ([self.part([blocks[i] for i in body], share)] if body else []))
        return [b is not None and d < threshold * composite(b.chars, b.tags, 0, 0, share) for b, d in zip(blocks, densities, strict=True)]

    @staticmethod
    def part(blocks: list[Block], page_links: float) -> float:
        """A node's density as a part of what it would be without links."""
        chars, tags, link_chars, link_tags = (sum(c) for c in list(zip(*blocks, strict=True))[:4])
        free = composite(chars, tags, 0, 0, page_links)
        return composite(chars, tags, link_chars, link_tags, page_links) / free if free else 0.0

    @staticmethod
    def labelled(blocks: list[Block | None], lines: list[str], title: str | None) -> list[Block | None]:
        """Blocks with the labels among them turned into links, but for the headline and filler; without a sentence in the page they stay."""
        places = [i for i, b in enumerate(blocks) if b is not None and b.label]
        first = next((i for i, b in enumerate(blocks) if b is not None and b.prose), None)
        if not places or first is None:
            return blocks
        from trailgrain.llm.residue import ResidueIndex

        like = [i for i in places if title and _same_words(lines[i], title)]
        above = [i for i in places if i < first]
        head = set(like) if like else {above[-1]} if above else set()
        out = list(blocks)
        for i in places:
            if i not in head and not ResidueIndex.plain().field(lines[i], True):
                out[i] = blocks[i]._replace(link_chars=blocks[i].chars, link_tags=blocks[i].tags)
        return out

    @staticmethod
    def cut(line: str, site: re.Pattern | None) -> bool:
        """Whether a shortened last line is the beginning of furniture."""
        masked = _SPACE.sub(" ", _DIGITS.sub("#", site.sub("@", line) if site else line)).strip().lower().replace("’", "'")
        if not masked:
            return False
        beginnings = [n for n, _ in _rules().notices] + _terms(LABELS)
        if len(masked) > 3 and any(n.startswith(masked) for n in beginnings) or _rules().labels.match(masked):
            return True
        letters = re.sub("[^a-z]", "", site.pattern.lower()) if site else ""
        for head in {n.partition("@")[0] for n in beginnings if "@" in n[6:]}:
            rest = re.sub(r"[\W_]", "", masked[len(head) :])
            if len(head) > 6 and masked.startswith(head) and rest and letters.startswith(rest):
                return True  # cut within the site's name
        return False


def page_batches(batch: pa.RecordBatch):
    """(row, text, domain, chars, title) of the rows of a batch whose text isn't empty."""
    for row, (text, *rest) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:5]), strict=True)):
        if text:
            yield row, text, *rest


@lru_cache(maxsize=1)
def worker_blocks() -> Blocks:
    return Blocks()


def find_furniture(pages: DataFrame, key: str = "page_id", text: str = "text", domain: str = "domain", chars: str = "chars", title: str = "title") -> DataFrame:
    """A row for each furniture line: ``key``, ``line_no`` (from 0).

    Null and empty texts give no row; blank lines are body; a null domain only
    means that the site's own name isn't known, a null ``chars`` that the text
    counts as whole.  Repeated rows give repeated results.
    """
    kind = pages.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks, rows, numbers = worker_blocks(), [], []
        for row, body, host, size, head in page_batches(batch):
            for no, is_furniture in enumerate(blocks.lines(body, host, size, head)):
                if is_furniture:
                    rows.append(row)
                    numbers.append(no)
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32())], names=["key", "line_no"])

    return map_batches(_columns(pages, key, text, domain, chars, title), run, f"key {kind}, line_no int").withColumnRenamed("key", key)


def main_content(pages: DataFrame, key: str = "page_id", text: str = "text", domain: str = "domain", chars: str = "chars", title: str = "title") -> DataFrame:
    """``key`` and ``body``: the text without its furniture lines, null for a null text."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks, bodies = worker_blocks(), np.full(batch.num_rows, None, dtype=object)
        for row, body, host, size, head in page_batches(batch):
            bodies[row] = "\n".join(line for line, drop in zip(body.split("\n"), blocks.lines(body, host, size, head), strict=True) if not drop)
        empty = [("" if t == "" else b) for t, b in zip(batch.column(1).to_pylist(), bodies, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(empty, pa.string())], names=["key", "body"])

    return map_batches(_columns(pages, key, text, domain, chars, title), run, f"key {kind}, body string").withColumnRenamed("key", key)


def _columns(pages: DataFrame, key: str, text: str, domain: str, chars: str, title: str) -> DataFrame:
    head = pages[title] if title in pages.columns else F.lit(None).cast("string")
    return pages.select(pages[key].alias("key"), pages[text].alias("text"), pages[domain].alias("domain"), pages[chars].alias("chars"), head.alias("title"))
