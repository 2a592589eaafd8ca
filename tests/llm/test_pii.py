import re

import pytest

from trailgrain.llm import pii
from trailgrain.llm.surrogates import Cipher

NAMES = pii.Names({"talia": 9, "elske": 9, "osk": 9}, {"tarnbeck": 9, "quaak": 9, "o'tannery": 9, "reve": 9, "oakenshaw": 9}, {"van der|quaak": 9})
CASES = [
    ("Write to l.osk@post.lichen.example if", [("email", "l.osk@post.lichen.example")]),
    ("at a_b9 [at] example [dot] org, or c at hut9 dot test", [("email", "a_b9 [at] example [dot] org"), ("email", "c at hut9 dot test")]),
    ("Follow @tinpot_suppers, meet @ the tarn, 1 tbsp @ 15 ml", []),
    ("Call +44 20 7946 0346 before", [("phone", "+44 20 7946 0346")]), ("ring 503 555 0135 ext. 14 or", [("phone", "503 555 0135 ext. 14")]), ("au 06 39 98 87 82.", [("phone", "06 39 98 87 82")]), ("Ring 08-465 004 07 innan", [("phone", "08-465 004 07")]),
    ("Order no. 4471-0098-22, barcode 0 12345 67890 5, on 2024-05-14, score 900-12-1, model 020-7946", []),
    ("an ID, mine is 924-27-1141. SSN 918804964 by", [("identity_number", "924-27-1141"), ("identity_number", "918804964")]), ("National insurance no. QQ 15 73 69 B, as", [("identity_number", "QQ 15 73 69 B")]), ("documento 00099395P.", [("identity_number", "00099395P")]),
    ("to Flat 6, 53 Old Quarry Drive, Ostergrove ZZ8 7QX, tel", [("street_address", "Flat 6, 53 Old Quarry Drive, Ostergrove ZZ8 7QX")]), ("PO Box 182, Fennmoor.", [("street_address", "PO Box 182, Fennmoor")]), ("an Mühlenstr. 12 b, 99992 Quellingen.", [("street_address", "Mühlenstr. 12 b, 99992 Quellingen")]),
    ("au 430 bis, rue de la Sente, 99399 Saint-Orvain. Grillez", [("street_address", "430 bis, rue de la Sente, 99399 Saint-Orvain")]), ("a C/ de la Senda 450, 99500 Peñalinde.", [("street_address", "C/ de la Senda 450, 99500 Peñalinde")]), ("till Björkvägen 14, 999 38 Älvskog.", [("street_address", "Björkvägen 14, 999 38 Älvskog")]),
    ("Mill Street Stew is named after a road. Granny Smith apples.", []),
    ("Dr. Talia M. Tarnbeck and van der Quaak, Osk met elske o'tannery", [("person_name", "Talia M. Tarnbeck"), ("person_name", "van der Quaak, Osk"), ("person_name", "elske o'tannery")]),
    ("TALIA-ELSKE OAKENSHAW-REVE", [("person_name", "TALIA-ELSKE OAKENSHAW-REVE")]), ("Talia alone, Tarnbeck alone", []), ("", []), (None, []),
]


@pytest.mark.parametrize("text, expected", CASES)
def test_detector(text, expected):
    assert [(k, text[a:b]) for a, b, k in pii.Detector(NAMES).find(text)] == expected


def test_placeholders_keep_coreference():
    text = "Talia Tarnbeck wrote. Tarnbeck, Talia signed. Osk Tarnbeck left."
    assert pii.replace(text, pii.Detector(NAMES).find(text), None) == "[PERSON_NAME_1] wrote. [PERSON_NAME_1] signed. [PERSON_NAME_2] left."


def test_surrogates_are_consistent_and_distinct():
    detector, cipher = pii.Detector(NAMES), Cipher(b"k")
    text = " and ".join(f"user{i}@a.example" for i in range(300)) + " TALIA TARNBECK, tel +44 20 7946 0346, Talia Tarnbeck"
    out = pii.replace(text, detector.find(text), cipher)
    mails = [m for m in out.split() if "@" in m]
    assert len(set(mails)) == 300 and "a.example" not in out and "TALIA" not in out
    upper, lower = out.split(" TARNBECK")[0].split()[-5:], out.split(", ")[-1]
    assert lower.istitle() and lower.upper() in out and upper and "+44 " in out
    assert pii.replace(text, detector.find(text), Cipher(b"other")) != out


FORMS = [
    (("Talia M. Tarnbeck", "TARNBECK, TALIA"), "person_name"), (("van der Quaak, Osk", "Osk van der Quaak"), "person_name"), (("Анна Петрова", "ПЕТРОВА АННА"), "person_name"),
    (("+44 (0)20 7946 0346", "+44-20-7946-0346"), "phone"), (("a_b9 [at] example [dot] org", "A_B9@example.ORG", "a_b9 at example dot org"), "email"), (("QQ 15 73 69 B", "qq157369b"), "identity_number"), (("53 Old Quarry Drive", "53 OLD QUARRY DRIVE"), "street_address"),
]


@pytest.mark.parametrize("mentions, kind", FORMS)
def test_mentions_of_an_entity_stay_mentions_of_one(mentions, kind):
    def plain(s):
        words = sorted(w for w in re.findall(r"[^\W_]+", re.sub(r"\(0\)|\b\w\.\s", "", s.lower())) if w not in ("at", "dot"))
        return "".join(words) if kind in ("phone", "identity_number") else words

    new = [Cipher(b"k").surrogate(m, kind, pii._PARTICLE_SET) for m in mentions]
    if kind in ("phone", "identity_number"):
        assert len({re.sub(r"\(0\)|[^0-9A-Za-z]", "", n).lower() for n in new}) == 1
    else:
        assert len({tuple(plain(n)) for n in new}) == 1
    assert all(n != m and [c.isupper() for c in m if c.isalpha()] == [c.isupper() for c in n if c.isalpha()][: sum(c.isalpha() for c in m)] for m, n in zip(mentions, new, strict=True) if kind != "email")


def test_surrogates_never_collide():
    cipher = Cipher(b"k")
    short = [a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    assert len({cipher.word(w, "name") for w in short}) == len(short) and not any(cipher.word(w, "name") == w for w in short if len(w) > 1)
    numbers = [f"{i:05d}" for i in range(20_000)]
    assert len({cipher.surrogate(n, "identity_number") for n in numbers}) == len(numbers)
    assert sorted(cipher.permute(i, 37, b"t") for i in range(37)) == list(range(37))


def test_a_directory_of_names_ends_and_keeps_them_apart():
    import itertools
    import time

    given = ["".join(p) + "a" for p in itertools.product("bdgklmnrst", "aeiou", "lmnrs")][:100]
    names = [f"{g.title()} {s.title()}" for g in given for s in ["Marlow", "Tarnbeck", "Oakenshaw"] + [f"Quill{c}on" for c in "abcdefghijklmnopqrstuvwxyz"] + ["Reve"] * 0][:5000]
    names += [f"{g.title()} {s.title()}son" for g in given for s in given[:25]]
    begun, cipher = time.time(), Cipher(b"k")
    new = [cipher.surrogate(n, "person_name", pii._PARTICLE_SET) for n in names]
    assert len(set(new)) == len(set(names)) == len(names) and time.time() - begun < 2


def test_surrogates_are_the_same_in_all_documents(spark):
    docs = spark.createDataFrame([(i, f"Signed, Bram Velloway. Note {i}. Call +44 20 7946 0346.") for i in range(5)] + [(9, None), (9, "")], "doc_id long, text string")
    out = [r["redacted"] for r in pii.redact(docs, secret="k").collect()]
    assert len({o.split(" Note")[0] for o in out if o}) == 1 and "Bram" not in str(out) and None in out and "" in out


def test_names_as_a_table_give_the_same(spark, monkeypatch, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").unionByName(spark.createDataFrame([(None, "Signed, Bram Velloway", None, None, 1, None), (None, "we saw bram velloway", None, None, 1, None)], spark.read.parquet(f"{data}/documents.parquet").schema))
    held = sorted(map(str, pii.find_pii(docs).collect()))
    monkeypatch.setattr(pii, "LEXICON_BROADCAST", 0)
    assert sorted(map(str, pii.find_pii(docs).collect())) == held and pii.redact(docs).count() == docs.count()


@pytest.mark.parametrize("text, kind, found", [("codice RSSMRA85T10A562S qui", "identity_number", "RSSMRA85T10A562S"), ("Codice fiscale: RSSMRA85T10A562S", "identity_number", "RSSMRA85T10A562S"), ("write a_b [a] example.org", "email", "a_b [a] example.org"), ("au 12, Rue de la Paix, 75002 Paris", "street_address", "12, Rue de la Paix, 75002 Paris"), ("a Camino Largo 4 hoy", "street_address", "Camino Largo 4"), ("at 53 Old Quarry\nDrive now", "street_address", "53 Old Quarry\nDrive")])
def test_every_form_is_tried(text, kind, found):
    assert (kind, found) in [(k, text[a:b]) for a, b, k in pii.Detector(NAMES).find(text)]


def test_names_are_learnt_and_found(spark, data):
    docs = spark.createDataFrame([(i, f"Thanks to Ines {s} for it. Signed, Bram {s}") for i, s in enumerate(["Velloway"] * 4)] + [(9, "we saw bram velloway"), (10, None), (11, ""), (9, "we saw bram velloway")], "doc_id long, text string")
    got = {(r["doc_id"], r["found_text"]) for r in pii.find_pii(docs).collect()}
    assert (9, "bram velloway") in got and (0, "Ines Velloway") in got and len(got) == 9
    out = {r["doc_id"]: r["redacted"] for r in pii.redact(docs).collect()}
    assert out[10] is None and out[11] == "" and out[9] == "we saw [PERSON_NAME_1]"
    assert pii.find_pii(docs.where("false")).count() == 0


def test_names_introduced_once_are_found_in_their_own_document(spark):
    texts = ["Signed, Zelda Quorin. Later ZELDA QUORIN and Quorin, Zelda came back.", "Zelda Quorin walked on.", "Contact: Ilka van der Murn", "Dear Anna\nThanks a lot"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r["doc_id"], r["found_text"]) for r in pii.find_pii(df).collect()}
    assert found == {(0, "Zelda Quorin"), (0, "ZELDA QUORIN"), (0, "Quorin, Zelda"), (2, "Ilka van der Murn")}


def test_every_learnt_name_is_kept(spark):
    df = spark.createDataFrame([(f"Signed, {g} {s}",) for g, s in [("Ada", "Marl"), ("Bea", "Norn"), ("Cid", "Orp")] * 3], "text string")
    names = pii.names_of(tuple(r) for r in pii.introduced_names(df).collect())
    assert (names.given, names.surnames) == ({"ada", "bea", "cid"}, {"marl", "norn", "orp"})
