"""Finding and restoring text that was read in a wrong character encoding.

A candidate is a pair of encodings: the one the text was read in and the one it
was written in.  Characters are mapped back to the bytes of the first; for a
multibyte original a byte-structure automaton (one regular expression over the
byte values) finds the maximal well-formed spans, and only those are decoded,
so text that was read rightly stays as it is.  A single-byte original has no
structure, so its spans are the non-ASCII words.  Every span is decoded only if
that makes it less odd: fewer characters that the supported languages don't
have, or have in another place.  Candidates are tried again on the result, as
texts can have been misread more than once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailgrain.functions.arrowkit import map_batches, spread

# Letters of the supported languages beyond ASCII, Cyrillic and Japanese.
LETTERS = "áàâäãåæçéèêëíìîïñóòôöõøœßúùûüýÿąćęłńśźż" + "ÁÀÂÄÃÅÆÇÉÈÊËÍÌÎÏÑÓÒÔÖÕØŒÚÙÛÜÝŸĄĆĘŁŃŚŹŻ" + "šžŠŽ"
# Signs that such texts use between words.
SIGNS = "’‘“”‚„–—…·•«»‹›°©®™±×÷§¶€£¥¢¼½¾⅓⅔⅛¿¡ºª№→←↑↓★☆✓†‡µ²³¹−′″≈≤≥"
# The encodings that are tried, and single non-ASCII letters that are words.
READ_AS = ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "koi8_r", "cp866", "iso8859_2", "cp932")
WRITTEN_MULTI = ("utf_8", "cp932", "euc_jp")
WRITTEN_SINGLE = ("cp1252", "cp1250", "cp1251", "koi8_r", "mac_roman", "cp437", "cp850", "cp866", "iso8859_2")
WORD_LETTERS = "áàâåæèéêìíîïòóôöùúûyÀÁÂÉÈÊÓÔÅÖÄÍÚ"

#: Characters beyond ASCII that are of no interest on their own.
PLAIN = "áéíóúüñàçèêëïôùûœæäöåøßąćęłńóśźż’‘“”–—…·°½¼¾©"

GAP = "\ue000"  # stands for a character that has no byte

# The automata: well-formed multibyte sequences, one or more in a row.
AUTOMATA = {
    "utf_8": re.compile(
        "(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
        "|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+"
    ),
    "cp932": re.compile("(?:[\x81-\x9f\xe0-\xfc][\x40-\x7e\x80-\xfc]|[\xa1-\xdf](?=[\x81-\x9f\xe0-\xfc\xa1-\xdf]))+"),
    "euc_jp": re.compile("(?:[\xa1-\xfe][\xa1-\xfe]|\x8e[\xa1-\xdf])+"),
}


class _Bytes(dict):
    """str.translate table: characters to characters of their byte values, GAP for those that have none."""

    def __missing__(self, char: int) -> str:
        return GAP


@lru_cache(maxsize=None)
def _bytes_of(read_as: str) -> _Bytes:
    """The table of ``read_as``; bytes that a Windows code page leaves undefined come as C1 controls."""
    table = _Bytes({b: chr(b) for b in range(128)})
    for b in range(128, 256):
        if read_as != "cp932":
            try:
                table[ord(bytes([b]).decode(read_as))] = chr(b)
            except UnicodeDecodeError:
                pass
            if b < 160 and read_as in ("cp1252", "cp1250", "cp1251", "iso8859_2"):
                table.setdefault(b, chr(b))
    return table


@lru_cache(maxsize=None)
def _single(read_as: str, written: str) -> dict[int, str]:
    out = {}
    for c, b in _bytes_of(read_as).items():
        try:
            if b >= "\x80":
                out[c] = b.encode("latin_1").decode(written)
        except UnicodeDecodeError:
            pass
    return out


# How odd a text looks: each match counts once, by its weight.
_L, _S = re.escape(LETTERS), re.escape(SIGNS)
_UPPER = "".join(c for c in LETTERS if c.isupper())
_LOWER = "".join(c for c in LETTERS if c.islower())
_IDEO = "\u3005\u3041-\u30ff\u4e00-\u9fff\uff01-\uff60\u3000-\u3003\u3008-\u301f"
_ODD = [
    (3, re.compile("[\x80-\x9f\ufffd\ue000-\uf8ff]")),
    (2, re.compile(f"[^\x00-\x9f\xa0\xad{_L}{_S}\u0400-\u045f{_IDEO}\u2000-\u200f\u2028-\u202f\u2060\ufe0f\U0001f000-\U0001ffff\u2600-\u27bf\u0300-\u036f\u2070-\u209f\u00b4\u2190-\u21ff\ufeff]")),
    (2, re.compile(f"(?<=[a-z{_LOWER}])[{_UPPER}]")),  # a capital inside a word
    (2, re.compile(f"(?<=[A-Z{_UPPER}])[{_LOWER}](?=[A-Z{_UPPER}])")),
    (2, re.compile("(?<=[a-zA-Zа-яА-Я" + _L + "])[" + re.escape("‚„…·•«‹›°©®™±×÷§¶€£¥¢¼½¾¿¡ºªµ²³¹†‡“‘´≈≤≥−→←↑↓") + "](?=[a-zA-Zа-яА-Я" + _L + "])")),
    (1.5, re.compile("(?<=[a-zA-Z" + _L + "])[" + re.escape("‚„•©®±×÷§¶£¥¢¿¡µ²³¹†‡“‘´ª") + "]")),
    (1, re.compile("[" + re.escape("¿¡") + r"](?=[\W_])")),
    (1.5, re.compile("(?<![\\w])[" + re.escape("³¹²ª¶µ") + "](?=[^\\W\\d_])")),
    (2, re.compile(f"[{_L}]{{4,}}")),  # too many letters beyond ASCII in a row
    (2, re.compile(f"[\u0400-\u045f][a-zA-Z{_L}]|[a-zA-Z{_L}][\u0400-\u045f]")),
    (2, re.compile("[а-яё][А-ЯЁ]")),
    (1, re.compile("[ЀЂ-Џѐђ-џ]")),
    (1, re.compile(f"(?<![\\w’'.-])(?![{WORD_LETTERS}])[{_L}](?![\\w’'.-])")),
    (2, re.compile("[ÃÂâĂÄÅÐÑÎ][" + re.escape(SIGNS) + "\xa0-\xbf\u0160\u0161\u017d\u017e\u0152\u0153\u0178\u0192\u02c6\u02dc]")),
    (2, re.compile("(?<![\\w])[ÃÂ](?![\\w])")),
    (2, re.compile("[РС][\x80-\xbfЀЂ-Џѐђ-џ‚„…†‡€‰‹‘’“”•–—™›№ґ°±µ¶·]")),
    (2, re.compile(r"[≈≤≥][^\W\d_]")),
    (2, re.compile("‚[ÄÅ](?=\\S)")),  # dashes and quotation marks of UTF-8 in Mac Roman
    (2, re.compile("n[íÕÆ]t(?![a-z])|(?<![\\w])ì(?=[A-Z])|[,.!?]î")),  # quotation marks of another code page
    (2, re.compile("[縺繧繝蜿蜊蟆譁譌鬟豢螟]")),
    (1, re.compile("[\uff61-\uff9f]")),
    (2, re.compile("[\u0250-\u03ff\u0460-\u1dff]")),
]

#: What any garbled text has: such characters, or a letter and sign that can be the bytes of one.
SUSPECT = (
    f"[\\x80-\\x9f\\x{{fffd}}]|[^\\x00-\\x9f\\xa0\\xad{LETTERS}’‘“”–—…·•«»°©½¼¾⅓⅔\\x{{400}}-\\x{{45f}}\\x{{3000}}-\\x{{30ff}}\\x{{4e00}}-\\x{{9fff}}\\x{{ff01}}-\\x{{ff60}}]"
    f"|[ÃÂâĂÄÅÐÑÎРСãà][^\\x00-\\x7f]|[a-z{_LOWER}][{_UPPER}]|[{LETTERS}]{{4}}|[а-яё][А-ЯЁ]|[a-zA-Z{LETTERS}]\\?+[a-z{_LOWER}]|\\?\\?[ ,]+\\d*\\s?\\?\\?|(?<!\\w)[ÃÂ](?!\\w)|[a-z][¼½¾«©°·•]|[縺繧繝]|n[íÕÆ]t|ì[A-Z]|[,.!?]î"
    f"|(?<![\\w’'.-])(?![{WORD_LETTERS}])[{LETTERS}](?![\\w’'.-])"
)


_ALONE = "".join(c for c in LETTERS if c in PLAIN and c not in WORD_LETTERS)
#: A quick necessary condition of SUSPECT: a character that isn't plain, or a rule of it that plain characters alone can fulfil.
GATE = f"[\\x{{80}}-\\x{{10ffff}}&&[^{PLAIN}]]|ít|\\?[a-z?{_LOWER}]|\\?\\?[ ,]|à[^\\x00-\\x7f]|[{LETTERS}]{{4}}|[a-z][¼½¾©°·]|(?<![\\w’'.-])[{_ALONE}](?![\\w’'.-])"


def oddness(text: str) -> float:
    if text.isascii():
        return 0.0
    return _short_oddness(text) if len(text) <= MEMO_CHARS else _oddness(text)


def _oddness(text: str) -> float:
    return sum(w * len(rule.findall(text)) for w, rule in _ODD)


#: Words and windows of up to so many characters come again and again, for each pair of encodings and on other pages.
MEMO_CHARS = 64
_short_oddness = lru_cache(maxsize=100_000)(_oddness)


Contexts = frozenset[str]
# Signs between the items of menus, which running text may lack.
SEPARATORS = "·•–—»›…©"


def _context(text: str) -> list[str]:
    """Each character beyond ASCII with its neighbours, as "neighbour, it" and "it, neighbour"; digits stand as 0 and white space as a space."""
    plain = _DIGIT.sub("0", _BLANK.sub(" ", f" {text.lower()} "))
    out = []
    for m in _BEYOND.finditer(plain):
        i = m.start()
        out += (plain[i - 1 : i + 1], plain[i : i + 2])
    return out


_DIGIT, _BLANK, _BEYOND = re.compile(r"\d"), re.compile(r"\s"), re.compile(r"[^\x00-\x7f]")


def contexts(texts: Iterable[str]) -> Contexts:
    """What stands beside the characters beyond ASCII in ``texts``, which should be well read and of all languages."""
    return _separated(c for t in texts for c in _context(t))


def _separated(found: Iterable[str]) -> Contexts:
    found = frozenset(found)
    return found | {pair for sign in SEPARATORS for pair in (f" {sign}", f"{sign} ")} if found else found


def contexts_of(texts: DataFrame, text: str = "text") -> Contexts:
    """The contexts of all ``texts`` but the garbled ones; the driver gets each only once, and there are as many as pairs of the languages' letters.

    Whether a text is garbled is asked only if it has contexts that no text of its batch before it had.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: set[str] = set()
        for t in batch.column(0).to_pylist():
            if not t.isascii() and (new := set(_context(t)) - found) and not diagnose(t)[0]:
                found |= new
        return pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["context"])

    part = texts.where(F.col(text).isNotNull()).select(text)
    return _separated(r["context"] for r in map_batches(part, run, "context string").distinct().collect())


def strangeness(text: str, known: Contexts | None) -> float:
    """Half a point for each side on which a character beyond ASCII has a neighbour that it has nowhere in ``known``."""
    if known is None or text.isascii():
        return 0.0
    return 0.5 * sum(c not in known for c in _context(text))


_KANA, _KANJI = re.compile("[\u3041-\u30ff]"), re.compile("[\u4e00-\u9fff]")
#: Words between ASCII spaces: others can be misread letters.
_WORDS = re.compile(r"[^ \t\r\f\v]*[^\x00-\x7f][^ \t\r\f\v]*")


def _decode_multi(text: str, read_as: str, written: str) -> str:
    if read_as == "cp932":
        return _decode_from_cp932(text) if written == "utf_8" and _CP932_LEADS.search(text) else text
    raw = text.translate(_bytes_of(read_as))
    spans = []
    for m in AUTOMATA[written].finditer(raw):
        a, b = m.span()
        try:
            plain = m.group().encode("latin_1").decode(written)
        except UnicodeDecodeError:
            continue
        if plain != text[a:b]:
            gain = oddness(text[max(0, a - 1) : b + 1]) - oddness(text[max(0, a - 1) : a] + plain + text[b : b + 1])
            spans.append((a, b, plain, gain))
    sure = sum(g > 0 for *_, g in spans)
    out, at, kana, kanji = [], 0, 0, 0
    for a, b, plain, gain in spans:
        if gain > 0 or sure >= 3 and gain == 0:  # in a text that is misread for certain, the rest of it is too
            out += [text[at:a], plain]
            at = b
            kana, kanji = kana + len(_KANA.findall(plain)), kanji + len(_KANJI.findall(plain))
    if not sure or kana < 0.25 * kanji:  # no Japanese is written in kanji alone
        return text
    return "".join(out) + text[at:]


_CP932_LEADS = re.compile("[縺繧繝]")  # how the first two bytes of kana in UTF-8 read in Shift JIS
_CP932_RUN = re.compile("[^\x00-\x7f]+")


def _decode_from_cp932(text: str) -> str:
    """UTF-8 read as Shift JIS: lost bytes show as U+FFFD, what is whole between them is decoded."""

    def fix(m: re.Match) -> str:
        raw = "".join(c.encode("cp932", "replace").decode("latin_1") if c != "\ufffd" else GAP for c in m.group())
        plain = AUTOMATA["utf_8"].sub(lambda x: x.group().encode("latin_1").decode("utf_8"), raw)
        plain = re.sub("[\x80-\xff\ue000]+", "\ufffd", plain)
        return plain if oddness(plain) < oddness(m.group()) else m.group()

    return _CP932_RUN.sub(fix, text)


def _decode_single(text: str, read_as: str, written: str, known: Contexts | None = None) -> str:
    table = _single(read_as, written)

    def measure(s: str) -> float:
        return oddness(s) + strangeness(s, known)

    def fix(m: re.Match) -> str:
        word = m.group()
        plain = word.translate(table)
        return plain if plain != word and measure(plain) <= measure(word) else word

    out = []
    for line in text.split("\n"):  # a misread part is at least a line's worth of words
        plain = line if line.isascii() else _WORDS.sub(fix, line)
        out.append(plain if measure(plain) < measure(line) else line)
    return "\n".join(out)


@lru_cache(maxsize=None)
def _candidates() -> list[tuple[str, str, bool]]:
    multi = [(r, w, True) for w in WRITTEN_MULTI for r in READ_AS if r != w]
    single = [(r, w, False) for w in WRITTEN_SINGLE for r in READ_AS if r not in (w, "cp932")]
    return multi + single


_WINDOW = re.compile("[^\n]{0,12}[^\x00-\x7f][^\n]{0,36}")
#: The pair of encodings is chosen on so many of the oddest windows, or the next ones if there is none, then tried on the whole text.
WINDOWS = 10


def _choose(text: str, failed: set[tuple[str, str, bool]], known: Contexts | None = None) -> tuple[str, str, bool] | None:
    """The pair of encodings, other than those that ``failed``, that makes ``text`` least odd (and, of those, least strange); None if none does."""
    before, low = oddness(text), oddness(text) + strangeness(text, known)
    best, utf_8 = None, False
    odd_chars = sum(c > "\x7f" and c not in PLAIN for c in text)
    plain = _decode_multi(text, "cp1252", "utf_8")
    if len(text) - len(plain) >= 0.4 * odd_chars > 0 and ("cp1252", "utf_8", True) not in failed:
        return "cp1252", "utf_8", True  # most of what is odd is well-formed UTF-8, be it misread once or more
    beyond = {ord(c) for c in text if c > "\x7f" and c not in PLAIN}
    # What is odd itself, window by window, without its clean neighbours.
    signs = [{ord(c) for _, rule in _ODD for m in rule.findall(w) for c in m if c > "\x7f" and c not in PLAIN} for w in text.split("\n")]
    able = {r for r in READ_AS if r == "cp932" or any(sum(c in _bytes_of(r) for c in chars) >= 0.25 * len(chars) for chars in (beyond, *signs))}
    for candidate in _candidates():
        read_as, written, multi = candidate
        if read_as not in able or candidate in failed:
            continue  # it couldn't have produced these characters
        if utf_8 and written != "utf_8" and low < 0.8 * before:
            break  # well-formed UTF-8 is no accident, so it goes before the others
        plain = _decode_multi(text, read_as, written) if multi else _decode_single(text, read_as, written, known)
        if plain is not text and plain != text:
            odd = (oddness(plain) + (0.01 if multi else 0.4)) * (1 if read_as == "cp1252" else 1.1)
            if odd < before and odd + strangeness(plain, known) < low:
                best, low, utf_8 = candidate, odd + strangeness(plain, known), written == "utf_8"
            if low < 0.1:
                break
    return best


def repair(text: str, known: Contexts | None = None) -> str:
    """``text`` with its misread parts restored, as far as their bytes are still there; ``known`` tells the pairs of encodings apart better."""
    before, failed = oddness(text), set()
    while before >= 1:  # each time there is a pair less to try or the text is less odd
        windows = [w for odd, w in sorted(((oddness(w), w) for w in _WINDOW.findall(text)), key=lambda x: -x[0]) if odd]
        best = next(filter(None, (_choose("\n".join(windows[i : i + WINDOWS]), failed, known) for i in range(0, len(windows), WINDOWS))), None)
        if best is None:
            break
        plain = _decode_multi(text, *best[:2]) if best[2] else _decode_single(text, *best[:2], known)
        after = oddness(plain)
        if after >= before:
            failed.add(best)
        else:
            text, before = plain, after
    return text


_LOST = re.compile(f"\ufffd|[a-zA-Z{_L}]\\?+[a-z{_LOWER}]|(?<!\\S)\\?{{2,}}[ ,]+(?:\\d+ )?\\?{{2,}}")
_CONTROLS = re.compile("[\x80-\x9f]")
_ADDRESS = re.compile(r"\S*[/=&]\S*")


def diagnose(text: str | None, known: Contexts | None = None) -> tuple[bool, str | None, bool]:
    """(garbled, restored text, some of it lost) of one field; null and empty texts aren't garbled."""
    if not text:
        return False, text, False
    plain = repair(text, known)
    lost = bool(_LOST.search(_ADDRESS.sub(" ", plain))) or len(_CONTROLS.findall(plain)) > 2
    return plain != text or lost, plain, lost


def find_garbled(pages: DataFrame, key: str = "page_id", fields: tuple[str, ...] = ("title", "text"), known: Contexts | None = None) -> DataFrame:
    """A row for each garbled field: ``key``, ``field_name``, ``restored``, ``lost``.

    ``known``, contexts of characters in well-read texts, decides between pairs of
    encodings that leave a text equally odd.  Fields without a suspect character never leave the JVM; most of them are
    told by one character class, before the longer expression.  Null, empty and
    blank fields give no row; repeated rows give repeated results.
    """
    kind = pages.schema[key].dataType.simpleString()
    cells = spread(pages.select(key, *fields)).select(
        F.col(key).alias("key"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.when(F.col(f).rlike(GATE) & F.col(f).rlike(SUSPECT), F.col(f)).alias("was")) for f in fields])).alias("cell"),
    ).select("key", "cell.*").where(F.col("was").isNotNull())

    held = pages.sparkSession.sparkContext.broadcast(known)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(i, *diagnose(s, held.value)) for i, s in enumerate(batch.column(2).to_pylist())]
        rows = [r for r in rows if r[1]]
        at = pa.array([r[0] for r in rows], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.bool_())],
            names=["key", "field_name", "restored", "lost"],
        )

    return map_batches(cells, run, f"key {kind}, field_name string, restored string, lost boolean").withColumnRenamed("key", key)
