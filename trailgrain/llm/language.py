"""Languages of documents, of the stretches inside them, and of sites.

Each sentence of a page's body is a segment; its likelihood under a language is
that of its words' character n-grams.  A page is a mixture: expectation
maximisation estimates the proportions of the languages, and a language stays in
the page's set only if leaving it out would cost more log-likelihood than the
penalty.  Everything is computed for a batch of pages at once: a worker keeps
the score vector of each word it has met, a segment's scores are a sum of rows,
and the mixtures of all pages are updated together.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailgrain.functions.arrowkit import map_batches
from trailgrain.llm.boilerplate import restored, worker_blocks
from trailgrain.llm.residue import ResidueIndex, document_frequencies

LANGUAGES = ("en", "de", "fr", "es", "it", "pt", "nl", "sv", "fi", "pl", "ru", "ja")

# English and native names and ISO codes of the languages.
NAMES = {
    "en": "en eng english",
    "de": "de deu ger german deutsch",
    "fr": "fr fra fre french français francais",
    "es": "es spa spanish español espanol castellano",
    "it": "it ita italian italiano",
    "pt": "pt por portuguese português portugues",
    "nl": "nl nld dut dutch nederlands flemish",
    "sv": "sv swe swedish svenska",
    "fi": "fi fin finnish suomi",
    "pl": "pl pol polish polski",
    "ru": "ru rus russian русский",
    "ja": "ja jpn japanese 日本語 jp",
}

#: Bounds of ``training_texts``: so many documents a language at most, whole ones of up to so many characters.
TRAINING_DOCS, TRAINING_CHARS = 250, 20_000
#: Part of the training sentences that are less like their language than a sentence of no known language is taken to be.
UNLIKE = 0.01
#: Log-likelihoods of an n-gram, of which that part is taken, are rounded to one of so many steps.
STEPS = 10_000
UNKNOWN = "und"
#: Longest n-grams of the model.
ORDER = 3
#: Log-likelihood that a further language must gain.
PENALTY = 8.0
ROUNDS = 8
MEMO_WORDS = 200_000
#: Words whose scores are added up at once, give or take a text.
PIECE = 50_000

_TOKEN = re.compile(r"[^\W\d_]+")
_CJK = re.compile("[々-ヿ一-鿿]")
#: _TOKEN of texts without _SPECIAL: the letters of the basic plane as one character set, which is found faster.
_BASIC = re.compile("[" + "".join(f"{run[0]}-{run[-1]}" for run in _TOKEN.findall("".join(map(chr, range(0x10000))))) + "]+")
_SPECIAL = re.compile("[々-ヿ一-鿿\U00010000-\U0010ffff]")
_STOP = re.compile("[.!?。！？]")
#: A whole sentence: up to its final stop, with what closes it.
_SENTENCE = re.compile(r"[^.!?。！？]*[.!?。！？]+[”“\"'’»)\]」]*(?=\s|$|(?<=[。！？]))")


def language_code(label: Column) -> Column:
    """The code a label names, whatever its spelling, name, code or country suffix; null if it names none."""
    known = F.create_map(*[F.lit(x) for code, names in NAMES.items() for name in names.split() for x in (name, code)])
    plain = F.lower(F.trim(label))
    return F.coalesce(F.element_at(known, plain), F.element_at(known, F.regexp_extract(plain, r"^(\p{L}+)[-_ (/].*$", 1)))


def site_key(domain: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(domain)), r"^www\.", "")


class NgramModel:
    """Log-probabilities of character n-grams under each language, from how often each occurs in it."""

    def __init__(self, grams: dict[str, Counter[str]]):
        self.languages = tuple(lang for lang in LANGUAGES if grams.get(lang)) or ("en",)
        self.index = {g: i for i, g in enumerate(sorted(set().union(*(grams.get(lang, ()) for lang in self.languages))))}
        table = np.zeros((len(self.index) + 1, len(self.languages)), dtype=np.float32)
        for j, lang in enumerate(self.languages):
            own = grams.get(lang, {})
            total = sum(own.values()) + 0.1 * (len(self.index) + 1)
            column = np.full(len(self.index) + 1, math.log(0.1 / total), dtype=np.float32)
            for g, n in own.items():
                column[self.index[g]] = math.log((n + 0.1) / total)
            table[:, j] = column
        self.table = table
        self.unknown = -math.inf
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.languages)), dtype=np.float32)

    def word(self, w: str) -> int:
        """The row of ``scores`` that holds a word's log-likelihoods."""
        at = len(self.words)
        if at == len(self.scores):
            self.scores = np.concatenate((self.scores, np.zeros_like(self.scores)))
        rows = [self.index.get(g, len(self.index)) for g in ngrams(w)]
        self.scores[at] = self.table[rows].sum(axis=0) / ORDER
        self.words[w] = at
        return at

    def placed(self, lang: str, texts: list[str]) -> np.ndarray:
        """Whether each text is likeliest in ``lang``."""
        return self.segments(texts).argmax(axis=1) == self.languages.index(lang)

    def likeness(self, lang: str, texts: Iterable[str]) -> Counter[int]:
        """How many sentences of ``texts`` have each log-likelihood of an n-gram under ``lang``, in STEPS."""
        own = [s for t in texts for s in sentences(t.split("\n"))]
        sizes = np.array([grams_of(s) for s in own])
        return Counter(np.rint(self.segments(own)[:, self.languages.index(lang)] / np.maximum(sizes, 1) * STEPS).astype(np.int64).tolist())

    def calibrate(self, found: dict[str, Counter[int]]) -> None:
        """Set ``unknown``, the log-likelihood of an n-gram in no language: what only UNLIKE of the training sentences fall below.

        ``found`` has the ``likeness`` of each language's sentences; languages count
        the same, whatever the number of their sentences.
        """
        shares: Counter[int] = Counter()
        own = [found[lang] for lang in self.languages if found.get(lang)]
        for counts in own:
            size = sum(counts.values())
            for step, n in counts.items():
                shares[step] += n / size
        below = 0.0
        for step in sorted(shares):
            below += shares[step]
            if below > UNLIKE * len(own):
                self.unknown = step / STEPS
                break

    def segments(self, texts: list[str]) -> np.ndarray:
        """Log-likelihoods of each text, one row each."""
        if len(self.words) > MEMO_WORDS:
            self.clear()
        out, rows, ends = [np.zeros((0, len(self.languages)))], [], [0]
        for i, t in enumerate(texts):
            words = split_words(t)
            found = list(map(self.words.get, words))
            if None in found:
                known = self.words
                found = [known[w] if w in known else self.word(w) for w in words]
            rows += found
            ends.append(len(rows))
            if len(rows) > PIECE or i + 1 == len(texts):
                sums = np.concatenate((np.zeros((1, len(self.languages))), np.cumsum(self.scores[rows], axis=0, dtype=np.float64)))
                out.append(sums[ends[1:]] - sums[ends[:-1]])
                rows, ends = [], [0]
        return np.concatenate(out)


def split_words(text: str) -> list[str]:
    """Lower-case words; of Japanese, the runs of its characters in pieces of three."""
    low = text.lower()
    if low.isascii() or not _SPECIAL.search(low):
        return _BASIC.findall(low)
    out = []
    for w in _TOKEN.findall(low):
        if not w.isascii() and _CJK.search(w):
            out.extend(w[i : i + 3] for i in range(0, len(w), 2))
        else:
            out.append(w)
    return out


def ngrams(word: str) -> list[str]:
    w = f" {word} "
    return [w[i : i + n] for n in range(1, ORDER + 1) for i in range(len(w) - n + 1)]


def grams_of(text: str) -> int:
    """How many n-grams of the longest order a text's words have."""
    return sum(len(w) for w in split_words(text))


def gram_counts(texts: Iterable[str]) -> Counter[str]:
    """How often each n-gram occurs in ``texts``."""
    words: Counter[str] = Counter()
    for t in texts:
        words.update(split_words(t))
    counts: Counter[str] = Counter()
    for word, n in words.items():
        for g in ngrams(word):
            counts[g] += n
    return counts


def labelled(documents: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """``code`` and ``text`` of all documents with a text whose label names one of the languages."""
    return documents.select(language_code(F.col(label)).alias("code"), F.col(text).alias("text")).where("code is not null and trim(text) <> ''")


def training_texts(documents: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", per_language: int = TRAINING_DOCS) -> dict[str, list[str]]:
    """A sample, which no query uses: up to ``per_language`` labelled texts of each language, those of the least hash, so a table always gives the same.

    Each task keeps the least of its own rows before they are gathered, and the
    sample is all that the driver gets: at most ``per_language`` texts of
    TRAINING_CHARS characters for each language.
    """
    named = documents.where((F.length(F.trim(F.col(text))) > 40) & (F.length(text) <= TRAINING_CHARS)).withColumn("code", language_code(F.col(label))).where("code is not null")
    place = F.xxhash64(F.col(key).cast("string"), text)
    rank = F.row_number().over(Window.partitionBy("code").orderBy(place, text))
    rows = named.withColumn("rank", rank).where(F.col("rank") <= per_language).select("code", F.col(text).alias("text")).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows):
        out.setdefault(r["code"], []).append(r["text"])
    return out


def train(texts: dict[str, list[str]], rounds: int = 2) -> NgramModel:
    """A model of ``texts``; labels can be wrong, so later rounds leave out the texts that the model before puts elsewhere."""
    model = NgramModel({lang: gram_counts(own) for lang, own in texts.items()})
    for _ in range(rounds - 1):
        texts = {lang: [t for t, here in zip(own, model.placed(lang, own), strict=True) if here] or own for lang, own in texts.items() if lang in model.languages}
        model = NgramModel({lang: gram_counts(own) for lang, own in texts.items()})
    model.calibrate({lang: model.likeness(lang, own) for lang, own in texts.items() if lang in model.languages})
    model.clear()
    return model


def _counted(texts: DataFrame, count: Callable[[str, list[str]], Counter], kind: pa.DataType, schema: str) -> list[tuple]:
    """The sums, over all texts of a language, of what ``count`` gives for some of them: (language, counted, number); added up before and after the shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own: dict[str, list[str]] = {}
        for code, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own.setdefault(code, []).append(text)
        rows = [(code, what, n) for code, some in own.items() for what, n in count(code, some).items()]
        code, what, n = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(code, pa.string()), pa.array(what, kind), pa.array(n, pa.int64())], names=["code", "what", "n"])

    return [tuple(r) for r in map_batches(texts, run, f"code string, what {schema}, n long").groupBy("code", "what").agg(F.sum("n")).collect()]


def train_on(documents: DataFrame, calibrated: bool = True) -> NgramModel:
    """The model that ``train`` makes of all labelled documents, each read where it lies.

    The driver gets counts only: of n-grams, of which there are as many as the
    languages' letters make up, and, if ``calibrated``, of rounded likenesses.
    The documents are read twice, for that a third time.
    """
    texts, context = labelled(documents), documents.sparkSession.sparkContext

    def totals(count: Callable[[str, list[str]], Counter], kind: pa.DataType, schema: str) -> dict[str, Counter]:
        out: dict[str, Counter] = {}
        for code, what, n in _counted(texts, count, kind, schema):
            out.setdefault(code, Counter())[what] = n
        return out

    every = totals(lambda code, own: gram_counts(own), pa.string(), "string")
    first = context.broadcast(NgramModel(every))

    def elsewhere(code: str, own: list[str]) -> Counter[str]:
        return gram_counts(t for t, here in zip(own, first.value.placed(code, own), strict=True) if not here) if code in first.value.languages else Counter()

    gone = totals(elsewhere, pa.string(), "string")
    kept = {code: own - gone.get(code, Counter()) for code, own in every.items()}
    whole = frozenset(code for code, own in kept.items() if not own)
    model = NgramModel({code: own or every[code] for code, own in kept.items()})
    if calibrated:
        second = context.broadcast(model)

        def likenesses(code: str, own: list[str]) -> Counter[int]:
            if code not in second.value.languages:
                return Counter()
            here = [True] * len(own) if code in whole else first.value.placed(code, own)
            return second.value.likeness(code, [t for t, h in zip(own, here, strict=True) if h])

        model.calibrate(totals(likenesses, pa.int64(), "long"))
    return model


def mixtures(scores: np.ndarray, page: np.ndarray, pages: int, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Language proportions of each page (0 for languages not in its set), and each segment's posterior."""
    k = scores.shape[1]
    top = scores.max(axis=1, keepdims=True)
    likelihood = np.exp(np.maximum(scores - top, -600))
    share = np.full((pages, k), 1.0 / k)

    def posterior() -> np.ndarray:
        p = share[page] * likelihood
        return p / np.maximum(p.sum(axis=1, keepdims=True), 1e-300)

    def proportions(p: np.ndarray) -> np.ndarray:
        total = np.zeros((pages, k))
        np.add.at(total, page, p)
        return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-300)

    for _ in range(ROUNDS):
        share = proportions(posterior())
    # what it would cost each page to do without a language
    mixed = share[page] * likelihood
    whole = mixed.sum(axis=1)
    without = np.maximum(whole[:, None] - mixed, 1e-280)
    cost = np.zeros((pages, k))
    np.add.at(cost, page, np.log(np.maximum(whole, 1e-280))[:, None] - np.log(without))
    keep = (cost > penalty) | (share >= share.max(axis=1, keepdims=True))
    share = np.where(keep, share, 0)
    for _ in range(2):
        share = proportions(posterior())
    return share, posterior()


def sentences(lines: list[str]) -> list[str]:
    """The whole sentences of body lines; what is left without a final stop, such as headlines and lists, is none."""
    return [s for line in lines if _STOP.search(line) for s in _SENTENCE.findall(line) if len(s) > 3 and _TOKEN.search(s)]


Row = tuple[int, "str | None", str, "str | None", "int | None"]


class PageLanguages:
    """The kernel: pages of a batch, as (row, title, text, domain, chars), to their languages or to those of their sentences."""

    def __init__(self, model: NgramModel, residue: ResidueIndex):
        self.model, self.residue = model, residue

    def read(self, rows: list[Row]) -> tuple[list[int], list[int], list[tuple[int, int, str]], np.ndarray, np.ndarray]:
        """(pages, each sentence's page, its line, place and text, its log-likelihoods, its posterior) of the pages that have a sentence."""
        found, page, ids = [], [], []
        for row, title, text, domain, chars in rows:
            plain, head = restored(text), restored(title) if title else None
            if self.residue.field(plain) or head and self.residue.field(head, True):
                continue
            dropped = worker_blocks().plain_lines(plain, domain, chars is not None and chars > len(text), head)
            own = [(no, k, s) for no, (line, drop) in enumerate(zip(plain.split("\n"), dropped, strict=True)) if not drop for k, s in enumerate(sentences([line]))]
            if own:
                found += own
                page += [len(ids)] * len(own)
                ids.append(row)
        scores = self.model.segments([s for *_, s in found]) if found else np.zeros((0, len(self.model.languages)))
        return ids, page, found, scores, mixtures(scores, np.array(page), len(ids))[1] if found else scores

    def batch(self, rows: list[Row]) -> list[tuple[int, str, float, int]]:
        """(row, language, confidence, sentences)."""
        ids, page, _, _, posterior = self.read(rows)
        best = posterior.argmax(axis=1)
        sure = np.zeros((len(ids), posterior.shape[1]))
        count = np.zeros_like(sure, dtype=np.int64)
        np.add.at(sure, (page, best), posterior.max(axis=1, initial=0))
        np.add.at(count, (page, best), 1)
        return [(ids[i], self.model.languages[j], float(sure[i, j] / count[i, j]), int(count[i, j])) for i, j in zip(*np.nonzero(count), strict=True)]

    def sentence_rows(self, rows: list[Row]) -> list[tuple[int, int, int, str, str, float]]:
        """(row, line, place, sentence, language, confidence); UNKNOWN where a sentence is less like its language than like none."""
        ids, page, found, scores, posterior = self.read(rows)
        out = []
        for i, (line, place, sentence) in enumerate(found):
            j = int(posterior[i].argmax())
            beyond = self.model.unknown * grams_of(sentence) - scores[i, j]  # how much likelier in no language
            odds = 1 / (1 + math.exp(-max(-700.0, min(700.0, beyond))))
            lang, sure = (UNKNOWN, odds) if odds > 0.5 else (self.model.languages[j], float(posterior[i, j]) * (1 - odds))
            out.append((ids[page[i]], line, place, sentence, lang, sure))
        return out


def _kernel(pages: DataFrame, documents: DataFrame, calibrated: bool = False) -> Callable[[], PageLanguages]:
    """The kernel for workers: trained once, on all labelled documents, and broadcast; its size is that of the n-grams there are."""
    held = pages.sparkSession.sparkContext.broadcast((train_on(documents, calibrated), document_frequencies(pages)))
    made: list[PageLanguages] = []

    def get() -> PageLanguages:
        if not made:
            model, frequencies = held.value
            made.append(PageLanguages(model, ResidueIndex(*frequencies)))
        return made[0]

    return get


def _mapped(pages: DataFrame, key: str, rows_of: Callable[[list[Row]], list[tuple]], schema: str, types: list[pa.DataType]) -> DataFrame:
    kind = pages.schema[key].dataType.simpleString()
    names = ["key", *(f.split()[0] for f in schema.split(", "))]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        columns = [c.to_pylist() for c in batch.columns[1:]]
        rows = [(i, *r) for i, r in enumerate(zip(*columns, strict=True)) if r[1]]
        for at in range(0, len(rows), 1000):
            out += rows_of(rows[at : at + 1000])
        at, *rest = zip(*out, strict=True) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(rest, types, strict=True)]], names=names)

    part = pages.select(*[F.col(c).alias(n) for c, n in ((key, "key"), ("title", "title"), ("text", "text"), ("domain", "domain"), ("chars", "chars"))])
    return map_batches(part, run, f"key {kind}, {schema}").withColumnRenamed("key", key)


def page_languages(pages: DataFrame, documents: DataFrame, key: str = "page_id") -> DataFrame:
    """``key``, ``lang``, ``confidence`` and ``sentences`` of each language of each page.

    Null and empty texts, pages of residue and pages without a whole sentence
    give no row.  ``documents`` gives the labelled texts to train on; where it
    has none, every page is taken for English.  Repeated rows give repeated
    results.
    """
    kernel = _kernel(pages, documents)
    return _mapped(pages, key, lambda rows: kernel().batch(rows), "lang string, confidence double, sentences int", [pa.string(), pa.float64(), pa.int32()])


def page_segments(pages: DataFrame, documents: DataFrame, key: str = "page_id") -> DataFrame:
    """``key``, ``line_no``, ``place`` (in the line), ``sentence``, ``lang`` and ``confidence`` of each whole sentence of a page's body.

    Sentences that are like none of the languages have ``und``.  The same pages
    and rows give none as in ``page_languages``.
    """
    kernel = _kernel(pages, documents, calibrated=True)
    types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64()]
    return _mapped(pages, key, lambda rows: kernel().sentence_rows(rows), "line_no int, place int, sentence string, lang string, confidence double", types)


def relabelled_leads(leads: DataFrame, pages: DataFrame, found: DataFrame) -> DataFrame:
    """``lead_id``, ``lang`` and ``confidence`` of the leads whose label names no language or another than their site's.

    A site's language is that of more than half of its pages that have exactly
    one language in ``found``; the confidence is that share.  Sites without such
    pages or majority, and leads without a domain, give no row.
    """
    single = found.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.first("lang").alias("lang")).where("n = 1").select("page_id", "lang")
    sites = pages.where("domain is not null").select("page_id", site_key(F.col("domain")).alias("site"))
    by_lang = sites.join(single, "page_id").groupBy("site", "lang").agg(F.count(F.lit(1)).alias("n"))
    majority = by_lang.groupBy("site").agg(F.sum("n").alias("total"), F.max(F.struct("n", "lang")).alias("top")).where("top.n * 2 > total")
    labelled = leads.where("domain is not null").select("lead_id", site_key(F.col("domain")).alias("site"), language_code(F.col("language")).alias("label"))
    joined = labelled.join(majority, "site").where(~F.col("label").eqNullSafe(F.col("top.lang")))
    return joined.select("lead_id", F.col("top.lang").alias("lang"), (F.col("top.n") / F.col("total")).alias("confidence"))


def language_rows(pages: DataFrame, leads: DataFrame, documents: DataFrame) -> DataFrame:
    """``rec_kind``, ``rec_id``, ``lang``, ``confidence`` of pages and of wrongly labelled leads.

    Both results need the languages of pages, which are found once: the second
    use reads the first one's shuffle.  For that the two exchanges must be the
    same, so every column is a key, which keeps all of them below it, and a
    condition that Spark can't move keeps the join's conditions above it.
    """
    found = page_languages(pages, documents).select("page_id", "lang", "confidence").repartition("page_id", "lang", "confidence")
    page_rows = found.select(F.lit("page").alias("rec_kind"), F.col("page_id").alias("rec_id"), "lang", "confidence")
    lead_rows = relabelled_leads(leads, pages, found.where(F.spark_partition_id() >= 0)).select(F.lit("lead").alias("rec_kind"), F.col("lead_id").alias("rec_id"), "lang", "confidence")
    return page_rows.unionByName(lead_rows)
