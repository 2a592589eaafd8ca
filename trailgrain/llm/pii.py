"""Personal information in free text: found, and replaced by placeholders or surrogates.

Emails, phone and identity numbers and street addresses are found by their
form.  Names have none, so they are learnt: a first pass over all documents
gathers given names and surnames from contexts that introduce a person, the
second finds them together anywhere, in any letter case and in either order.
What a document introduces itself counts in it however rare it is.

Entities are replaced by placeholders, or by keyed surrogates (``surrogates``):
of their type, script, letter case and format, the same for an entity in all
documents, and never the same for two.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailgrain.functions.arrowkit import ensure_checkpoint_dir, map_batches
from trailgrain.llm.surrogates import Cipher

KINDS = ("email", "phone", "identity_number", "street_address", "person_name")
#: A token must be introduced as a name so often to count in documents that don't introduce it themselves.
LEARNT = 3
#: Up to so many learnt names (about 60 bytes each) are sent to every worker, beyond that documents and names are joined.
LEXICON_BROADCAST = 500_000

# ---- fixed values: forms of emails, numbers and addresses

_LOCAL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9](?:[A-Za-z0-9._%+\-]*[A-Za-z0-9])?"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?"
_DOT = r"(?:\.|\s?[\[(]\s?dot\s?[\])]\s?|\s+dot\s+)"
EMAIL = re.compile(rf"{_LOCAL}@(?:{_LABEL}\.)+[A-Za-z]{{2,24}}(?![A-Za-z0-9\-])")
DISGUISED = re.compile(
    rf"{_LOCAL}\s?(?:[\[(]\s?at\s?[\])]|\(a\)|\[a\]|\(@\))\s?{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[A-Za-z]{{2,24}}(?![A-Za-z0-9\-])"
    rf"|{_LOCAL}\s+at\s+{_LABEL}(?:(?:\.|\s+dot\s+){_LABEL})*\s+dot\s+[A-Za-z]{{2,24}}(?![A-Za-z0-9\-])",
    re.IGNORECASE,
)
PHONE = re.compile(
    r"(?<![\w.\-/+])(?:"
    r"(?:\+|00)[1-9]\d{0,2}(?:[ .\-]?\(0\))?(?:[ .\-/]?\(?\d{1,8}\)?){1,6}"
    r"|\(0?\d{2,5}\)[ \-]?\d{3,8}(?:[ .\-]\d{2,6}){0,3}"
    r"|1[\-. ]\d{3}[\-. ]\d{3}[\-. ]\d{4}|\d{3}[\-. ]\d{3}[\-. ]\d{4}"
    r"|0\d(?:[ .\-]\d{2}){4}|0\d{1,5}[ /\-]\d{2,8}(?:[ \-]\d{2,5}){0,3}|0[1-9]\d{8,9}"
    r")(?![\w/])(?!-\d)(?!\.\d)(?:,?\s?(?:ext\.?|extension|x|Durchwahl|poste|anknytning)\s?\d{1,6}(?!\w))?"
)
ID_LABELS = (
    "ssn|social security number|social security no.|id, mine is|id number|id no.|passport number|passport no.|national insurance number|national insurance no.|nino|ausweisnummer|personalausweis|steuer-id|documento|dni|nie|pasaporte"
    "|personnummer|numéro de sécurité sociale|codice fiscale|carta d'identità|cpf|nif|bsn|burgerservicenummer|henkilötunnus|pesel|nr dowodu|паспорт|снилс|инн|マイナンバー"
).split("|")
LABELLED = re.compile(r"\s*[:#]?\s*(?P<value>[A-Z]{6}\d{2}[A-Z]\d{2}[A-Z]\d{3}[A-Z](?![A-Z\d])|[A-Z]{0,3} ?\d[\dA-Z]*(?:[ \-/]\d[\dA-Z]*)*(?: [A-D](?![\w]))?)")
SHAPED = re.compile(r"(?<![\w\-.])(?:\d{3}-\d{2}-\d{4}|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]|\d{8}[A-Z]|(?:19|20)?\d{6}-\d{4}|[1-9](?: \d{2}){3} \d{3} \d{3}(?: \d{2})?)(?![\w\-])")
#: An identity number without a run of digits, so it is looked for on its own.
CODE = re.compile(r"(?<![A-Z\d])[A-Z]{6}\d{2}[A-Z]\d{2}[A-Z]\d{3}[A-Z](?![A-Z\d])")
_CODE_END = re.compile(r"\d{3}[A-Z](?![A-Z\d])")
#: Runs that can hold a number of a person: the longer expressions are tried on these only.
RUN = re.compile(r"[+(]?\d[\d ()./\-]{4,}\d")
_TOWN = r"[A-ZÀ-ÖØ-ÞŁŚŻ][^\W\d_]+(?:[-’'][^\W\d_]+)*"
_WAY = r"(?:Street|St\b\.?|Road|Rd\b(?:\.(?=,))?|Lane|Ln\b(?:\.(?=,))?|Avenue|Ave\b(?:\.(?=,))?|Drive|Dr\b(?:\.(?=,))?|Wynd|Court|Ct\b\.?|Close|Crescent|Row|Terrace|Way|Place|Pl\b\.?|Square|Boulevard|Blvd\b\.?|Trail|Gardens)"
_UK_US = rf"(?:,\s(?!(?:Apt|Unit|Suite|Flat)\b){_TOWN}(?:\s[A-Z]{{1,2}}\d{{1,2}}[A-Z]?\s\d[A-Z]{{2}}(?!\w)|,\s[A-Z]{{2}}\s\d{{5}}(?!\d))?)?"
STREETS = [
    ((" Street", " St", " Road", " Rd", " Lane", " Ln", " Ave", " Drive", " Dr", " Wynd", " Court", " Ct", " Close", " Crescent", " Row", " Terrace", " Way", " Pl", " Square", " Boulevard", " Blvd", " Trail", " Gardens"), re.compile(rf"(?<![\w,.]\d)(?<!\w)(?:Flat\s\d+[A-Za-z]?,\s)?\d{{1,5}}[A-Za-z]?\s(?:[A-Z][\w’']+\s){{1,3}}{_WAY}(?!\w)(?:,?\s(?:Apt|Unit|Suite|Apartment|Flat)\.?\s?\d+[A-Za-z]?)?{_UK_US}")),
    (("Box",), re.compile(rf"(?<!\w)(?:P\.?\s?O\.?\sBox|Box)\s\d+{_UK_US}")),
    (("traße ", "strasse ", "str. ", "weg ", "gasse ", "platz ", "allee ", "ostfach "), re.compile(rf"(?<!\w)(?:[A-ZÄÖÜ][\wäöüß\-]*(?:straße|strasse|str\.|weg|gasse|platz|allee)|Postfach)\s\d+(?:\s?[a-h](?![\w]))?(?:,\s\d{{5}}\s{_TOWN})?")),
    (("rue ", "chemin ", "impasse ", "avenue ", "allée ", "place ", "quai ", "boulevard ", "route ", "BP "), re.compile(rf"(?<!\w)(?:\d+(?:\s(?:bis|ter|quater))?,?\s(?:rue|chemin|impasse|avenue|allée|place|quai|boulevard|route)\s[^,\n.;]{{3,40}}|BP\s\d+)(?:,\s\d{{5}}\s{_TOWN})?", re.IGNORECASE)),
    (("C/", "Calle ", "Avda", "Avenida ", "Plaza ", "Paseo ", "Camino ", "Apdo", "Apartado "), re.compile(rf"(?<!\w)(?:(?:C/|Calle|Avda\.?|Avenida|Plaza|Paseo|Camino)\s?(?:de\s(?:la\s|las\s|los\s)?|del\s)?{_TOWN}(?:\s{_TOWN})?,?\s\d+(?:\s?[A-Za-z]|\sbis)?(?!\w)|(?:Apdo\.?|Apartado)(?:\sde\sCorreos)?\s\d+)(?:,\s\d{{5}}\s{_TOWN})?")),
    (("vägen ", "gatan ", "gränd ", "stigen ", "torget "), re.compile(rf"(?<!\w)[A-ZÅÄÖ][\w]*(?:vägen|gatan|gränd|stigen|torget)\s\d+(?:\s?[A-Za-z](?!\w))?(?:,\s\d{{3}}\s?\d{{2}}\s{_TOWN})?")),
    (("Via ", "Viale ", "Piazza ", "Corso ", "Vicolo "), re.compile(rf"(?<!\w)(?:Via|Viale|Piazza|Corso|Vicolo)\s(?:[^\W\d_]+\s){{0,3}}[A-ZÀ-Þ][^\W\d_]+,?\s\d+(?:\s?[a-z](?!\w))?(?:,\s\d{{5}}\s{_TOWN})?")),
    (("Rua ", "Avenida ", "Travessa ", "Praça "), re.compile(rf"(?<!\w)(?:Rua|Travessa|Praça)\s(?:[^\W\d_]+\s){{0,3}}[A-ZÀ-Þ][^\W\d_]+,?\s\d+(?:,\s\d{{4,5}}-\d{{3}}\s{_TOWN})?")),
    (("straat ", "laan ", "plein ", "gracht ", "pad ", "katu ", "tie ", "polku ", "ul. ", "ул. "), re.compile(rf"(?<!\w)(?:[A-Z]\w*(?:straat|laan|plein|gracht|pad)\s\d+\s?[a-z]?(?:,\s\d{{4}}\s?[A-Z]{{2}}\s{_TOWN})?|[A-ZÅÄÖ]\w*(?:katu|tie|polku)\s\d+(?:\s?[A-Z](?!\w))?(?:,\s\d{{5}}\s{_TOWN})?|ul\.\s{_TOWN}(?:\s{_TOWN})?\s\d+(?:/\d+)?(?:,\s\d{{2}}-\d{{3}}\s{_TOWN})?|ул\.\s[А-ЯЁ][а-яё]+,?\s(?:д\.\s)?\d+(?:,\s\d{{6}}\s[А-ЯЁ][а-яё]+)?)")),
]

# ---- names

# Particles of surnames, and words that introduce a person.
PARTICLES = "van der|van den|van de|van|von der|von|zu|de la|de las|de los|del|de|da|dos|di|della|le|la|ter|ten|bin|al|el|af|av|O’|O'"
INTRODUCTIONS = (
    "thanks to|signed,|sincerely,|regards,|we met|permit holder:|contact:|contact person:|ask for|goes to|booked by|written by|posted by|author:|from:|dear|"
    "danke an|ansprechperson:|ausgestellt auf|grüße,|gruß,|gracias a|a nombre de|firmado,|saludos,|merci à|contact :|signé,|cordialement,|tack till|bokat av|hälsningar,|"
    "grazie a|firmato,|obrigado a|obrigada a|assinado,|bedankt,|met dank aan|groeten,|kiitos,|terveisin,|dziękuję,|dzięki,|pozdrawiam,|спасибо,|с уважением,|"
    "dr.|prof.|mr.|mrs.|ms.|herr|frau|señor|señora|sr.|sra.|mme|dhr.|mevr."
)
_LETTER = r"[A-Za-zÀ-ÖØ-öø-ɏА-Яа-яЁё]"
_NAME_WORD = rf"{_LETTER}+(?:[’']{_LETTER}+)?"
_PARTICLE = r"(?:(?:" + "|".join(p for p in PARTICLES.split("|") if "’" not in p and "'" not in p) + r")\s+)"
_CAPITAL = r"(?=[A-ZÀ-ÖØ-ÞŁŚŻĆĄĘŃÓŹА-ЯЁ])"
_INTRODUCED = re.compile(
    rf"\s+{_CAPITAL}(?P<given>{_NAME_WORD}(?:-{_NAME_WORD})?)(?:\s+{_CAPITAL}[^\W\d_]\.)?\s+(?P<particle>{_PARTICLE}?){_CAPITAL}(?P<surname>{_NAME_WORD}(?:-{_NAME_WORD})?)"
)
_TOKENS = re.compile(rf"{_NAME_WORD}(?:-{_NAME_WORD})*")

_PIECES = re.compile(_NAME_WORD)


def _parts(name: str) -> list[str]:
    return [p for p in name.lower().replace("’", "'").split("-") if len(p) > 1]


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    """All introductions and labels of numbers in one automaton."""
    made = ahocorasick.Automaton()
    for words, is_label in ((INTRODUCTIONS.split("|"), False), (ID_LABELS, True)):
        for w in words:
            made.add_word(w, (len(w), is_label))
    made.make_automaton()
    return made


def lowered(text: str) -> str:
    """In lower case, character by character, so that places stay the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def marks(low: str) -> list[tuple[int, bool]]:
    """(place after it, whether it labels a number) of every introduction and label, in one pass; one that continues a word is none."""
    return [(end + 1, is_label) for end, (size, is_label) in _automaton().iter(low) if not low[end - size : end - size + 1].isalnum() or end < size]


def introduced(text: str, found: list[tuple[int, bool]] | None = None) -> Iterator[tuple[str, str]]:
    """(role, token) of the names that a context introduces; a particle comes with its surname."""
    for after, is_label in marks(lowered(text)) if found is None else found:
        if not is_label and (m := _INTRODUCED.match(text, after)):
            for p in _parts(m["given"]):
                yield "given", p
            own = [p for p in _parts(m["surname"]) if p not in _PARTICLE_WORDS]
            for p in own:
                yield "surname", p
            if m["particle"] and own:
                yield "particle", f"{' '.join(m['particle'].lower().split())}|{own[0]}"


class Names:
    """Finds given names with surnames."""

    def __init__(self, given: dict[str, int], surnames: dict[str, int], particles: dict[str, int]):
        self.particles = set(particles)
        self.given = {t for t, n in given.items() if n >= surnames.get(t, 0)}
        self.surnames = {t for t, n in surnames.items() if n > given.get(t, 0)}

    def _is(self, token: str, names: set[str]) -> bool:
        return all(p in names for p in token.lower().replace("’", "'").split("-"))

    def find(self, text: str, found: list[tuple[int, bool]] | None = None) -> Iterator[tuple[int, int]]:
        """Places of names; ``found`` are the text's ``marks``, if they are known."""
        own: dict[str, set[str]] = {"given": set(), "surname": set(), "particle": set()}
        for role, token in introduced(text, found):
            own[role].add(token)
        here = set("|".join(_PIECES.findall(text)).lower().replace("’", "'").split("|"))
        given, surnames = here & self.given | own["given"], here & self.surnames | own["surname"]
        if not given or not surnames:
            return
        starts = given | surnames | _PARTICLE_WORDS
        tokens = [(m.start(), m.end(), m.group()) for m in _TOKENS.finditer(text)]
        i, n = 0, len(tokens)
        while i < n:
            if "-" not in tokens[i][2] and tokens[i][2].lower().replace("’", "'") not in starts:
                i += 1
                continue
            end = self._forward(text, tokens, i, given, surnames) or self._backward(text, tokens, i, given, surnames, own["particle"])
            if end:
                last = tokens[end - 1]
                yield tokens[i][0], last[1] + (len(last[2]) == 1)  # an initial at the end keeps its dot
            i = end or i + 1

    def _forward(self, text: str, tokens: list, i: int, given: set[str], surnames: set[str]) -> int | None:
        """Given name, initials, particles, surname: the index after the last token."""
        if not self._is(tokens[i][2], given):
            return None
        j = i + 1
        while j < len(tokens) and len(tokens[j][2]) == 1 and text[tokens[j][1] : tokens[j][1] + 1] == "." and text[tokens[j - 1][1] : tokens[j][0]].strip(" .") == "":
            j += 1
        steps = 0
        while j < len(tokens) and steps < 4:
            gap = text[tokens[j - 1][1] : tokens[j][0]]
            if gap.strip(" \t.") or ("." in gap and len(tokens[j - 1][2]) > 1) or "\n" in gap or not gap:
                return None
            if self._is(tokens[j][2], surnames):
                return j + 1
            if tokens[j][2].lower() not in _PARTICLE_WORDS:
                return None
            j, steps = j + 1, steps + 1
        return None

    def _backward(self, text: str, tokens: list, i: int, given: set[str], surnames: set[str], particles: set[str]) -> int | None:
        """Surname (with particles), comma, given name, initials."""
        j, steps = i, 0
        while j < len(tokens) and tokens[j][2].lower() in _PARTICLE_WORDS and steps < 3:
            j, steps = j + 1, steps + 1
        if j >= len(tokens) or not self._is(tokens[j][2], surnames):
            return None
        if j > i:
            particle = f"{' '.join(tokens[k][2].lower() for k in range(i, j))}|{_parts(tokens[j][2])[0]}"
            if particle not in self.particles and particle not in particles or any(text[tokens[k][1] : tokens[k + 1][0]].strip(" ") for k in range(i, j)):
                return None
        if j + 1 < len(tokens) and re.fullmatch(r",[ \t]+|[ \t]+", text[tokens[j][1] : tokens[j + 1][0]]) and self._is(tokens[j + 1][2], given):
            after = self._forward(text, tokens, j + 1, given, surnames)
            if "," not in text[tokens[j][1] : tokens[j + 1][0]] and after:
                return None  # the given name belongs to the surname after it
            k = j + 2
            if k < len(tokens) and len(tokens[k][2]) == 1 and text[tokens[k][1] : tokens[k][1] + 1] == "." and text[tokens[k - 1][1] : tokens[k][0]] == " ":
                return k + 1
            return k
        return None


_PARTICLE_WORDS = {w for p in PARTICLES.split("|") for w in p.split() if w.isalpha()}
_PARTICLE_SET = frozenset(_PARTICLE_WORDS)


def _digits(s: str) -> int:
    return sum(c.isdigit() for c in s)


class Detector:
    """All kinds at once; a part inside a longer item is not found again."""

    def __init__(self, names: Names):
        self.names = names

    def find(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, kind) in the order of the text, without overlaps."""
        if not text:
            return []
        found: list[tuple[int, int, str]] = []
        if "@" in text:
            found += [(*m.span(), "email") for m in EMAIL.finditer(text)]
        low = lowered(text)
        if "at]" in low or "at)" in low or "(a)" in low or "[a]" in low or "(@)" in low or " dot " in low:
            found += [(*m.span(), "email") for m in DISGUISED.finditer(text)]
        runs = [(m.start(), m.end()) for m in RUN.finditer(text)]
        seen = marks(low)
        for after, is_label in seen:
            if is_label and (m := LABELLED.match(text, after)) and _digits(m["value"]) >= 6:
                found.append((*m.span("value"), "identity_number"))
        for a, b in runs:
            for m in SHAPED.finditer(text, max(0, a - 6), min(len(text), b + 4)):
                found.append((*m.span(), "identity_number"))
        for end in _CODE_END.finditer(text):
            if end.end() >= 16 and (m := CODE.match(text, end.end() - 16)):
                found.append((*m.span(), "identity_number"))
        spaced = text.replace("\n", " ").replace("\xa0", " ").replace("\t", " ")
        for gate, pattern in STREETS:
            if any(g in spaced for g in gate) or pattern.flags & re.IGNORECASE and any(g.lower() in low for g in gate):
                found += [(*m.span(), "street_address") for m in pattern.finditer(text)]
        for a, b in runs:
            if _digits(text[a:b]) < 9:
                continue
            for m in PHONE.finditer(text, a, min(len(text), b + 16)):
                main = re.split(r"[a-zA-Z]", m.group(), maxsplit=1)[0]
                if 9 <= _digits(main) <= 15 and not _NOT_PHONE.search(text[max(0, m.start() - 16) : m.start()]):
                    found.append((*m.span(), "phone"))
        found += [(a, b, "person_name") for a, b in self.names.find(text, seen)]
        return self._apart(text, found)

    @staticmethod
    def _apart(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        rank = {k: i for i, k in enumerate(("email", "identity_number", "street_address", "phone", "person_name"))}
        taken: list[tuple[int, int, str]] = []
        for a, b, kind in sorted(found, key=lambda x: (rank[x[2]], x[0] - x[1])):
            if all(b <= c or a >= d for c, d, _ in taken):
                taken.append((a, b, kind))
        return sorted(taken)


_NOT_PHONE = re.compile(r"(?:model|order no\.?|barcode|grid ref|batch|isbn|sections?|score:?|position|no\.)\s*\S{0,6}$", re.IGNORECASE)


def introduced_names(documents: DataFrame, text: str = "text") -> DataFrame:
    """``role``, ``token`` and ``n`` of every given name, surname and particle that the documents introduce at least LEARNT times."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter[tuple[str, str]] = Counter()
        for s in batch.column(0).to_pylist():
            if s:
                counts.update(introduced(s))
        return pa.RecordBatch.from_arrays([pa.array([r for r, _ in counts], pa.string()), pa.array([t for _, t in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["role", "token", "n"])

    counted = map_batches(documents.select(F.col(text).alias("text")), run, "role string, token string, n long").groupBy("role", "token").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEARNT)


def names_of(rows: Iterable[tuple[str, str, int]]) -> Names:
    roles: dict[str, dict[str, int]] = {"given": {}, "surname": {}, "particle": {}}
    for role, token, n in rows:
        roles[role][token] = n
    return Names(*roles.values())


def _row_tokens(text: str | None) -> set[str]:
    """The distinct words of a text, as the lexicon has them."""
    return {p for w in _PIECES.findall(text or "") for p in _parts(w)}


def _detected(documents: DataFrame, key: str, text: str, run: Callable[[pa.RecordBatch, Callable[[int], Detector]], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``run`` to batches of (key, text), with the detector of each row.

    Up to LEXICON_BROADCAST learnt names go to every worker.  Beyond that they
    stay a table: the distinct words of each document meet it in a join, and a
    document gets the learnt names among its own words.
    """
    ensure_checkpoint_dir(documents.sparkSession)
    learnt = introduced_names(documents, text).checkpoint()
    part = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if learnt.count() <= LEXICON_BROADCAST:
        detector = Detector(names_of(zip(*(c.to_pylist() for c in learnt.toArrow().columns), strict=True)))
        return map_batches(part, lambda batch: run(batch, lambda _: detector), schema)

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, tokens = [], []
        for row, s in enumerate(batch.column(1).to_pylist()):
            own = _row_tokens(s)
            rows += [row] * len(own)
            tokens += own
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(tokens, pa.string())], names=["key", "word"])

    def with_own(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [Detector(names_of((n["role"], n["token"], n["n"]) for n in names or ())) for names in batch.column(2).to_pylist()]
        return run(batch, own.__getitem__)

    kind = part.schema["key"].dataType.simpleString()
    entries = learnt.withColumn("word", F.regexp_extract("token", r"([^|]*)$", 1))  # a particle's entry ends in its surname
    met = map_batches(part, words, f"key {kind}, word string").join(entries, "word").groupBy("key").agg(F.collect_set(F.struct("role", "token", "n")).alias("names")).withColumnRenamed("key", "_key")
    joined = part.join(met, part["key"].eqNullSafe(met["_key"]), "left").select("key", "text", "names")
    return map_batches(joined, with_own, schema)


def find_pii(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct ``key``, ``pii_kind``, ``found_text``; null and empty texts hold none."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch, detector_of: Callable[[int], Detector]) -> pa.RecordBatch:
        rows, kinds, texts = [], [], []
        for row, s in enumerate(batch.column(1).to_pylist()):
            for k, t in dict.fromkeys((k, s[a:b]) for a, b, k in detector_of(row).find(s)):
                rows.append(row)
                kinds.append(k)
                texts.append(t)
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(kinds, pa.string()), pa.array(texts, pa.string())], names=["key", "pii_kind", "found_text"])

    return _detected(documents, key, text, run, f"key {kind}, pii_kind string, found_text string").distinct().withColumnRenamed("key", key)


# ---- replacement


def _key(entity: str, kind: str) -> str:
    """What mentions of one entity have in common: letter case, the order of names and the way a number is set don't matter."""
    low = entity.lower().replace("’", "'")
    if kind == "person_name":
        surname, comma, given = low.partition(",")
        low = f"{given.strip()} {surname.strip()}" if comma else low
        return re.sub(r"\s[^\W\d_]\.", "", re.sub(r"\s+", " ", low))
    if kind in ("phone", "identity_number"):
        return re.sub(r"[^\da-z]", "", low)
    if kind == "email":
        return re.sub(r"\s?[\[(]\s?dot\s?[\])]\s?|\s+dot\s+", ".", re.sub(r"\s?[\[(]\s?(?:at|a|@)\s?[\])]\s?|\s+at\s+", "@", low))
    return low


def replace(text: str, found: list[tuple[int, int, str]], cipher: Cipher | None) -> str:
    """``text`` with placeholders (no ``cipher``) or surrogates; the same entity gets the same one, different entities different ones."""
    given: dict[tuple[str, str], str] = {}
    counts: Counter[str] = Counter()
    out, at = [], 0
    for a, b, kind in found:
        if cipher is None:
            entity = (kind, _key(text[a:b], kind))
            if entity not in given:
                counts[kind] += 1
                given[entity] = f"[{kind.upper()}_{counts[kind]}]"
            new = given[entity]
        else:
            new = cipher.surrogate(text[a:b], kind, _PARTICLE_SET)
        out += [text[at:a], new]
        at = b
    return "".join(out) + text[at:]


def redact(documents: DataFrame, key: str = "doc_id", text: str = "text", secret: str | None = None) -> DataFrame:
    """``key``, ``redacted`` and ``n_found``; null stays null, empty stays empty.

    Without ``secret`` entities become placeholders, numbered within a document;
    with it keyed surrogates, the same for an entity in all documents.
    """
    kind = documents.schema[key].dataType.simpleString()
    code = secret.encode() if secret is not None else None
    held: list[Cipher] = []

    def run(batch: pa.RecordBatch, detector_of: Callable[[int], Detector]) -> pa.RecordBatch:
        if code is not None and not held:
            held.append(Cipher(code))
        texts, counts = [], []
        for row, s in enumerate(batch.column(1).to_pylist()):
            found = detector_of(row).find(s)
            texts.append(replace(s, found, held[0] if held else None) if found else s)
            counts.append(len(found))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], names=["key", "redacted", "n_found"])

    return _detected(documents, key, text, run, f"key {kind}, redacted string, n_found int").withColumnRenamed("key", key)
