import random

import pytest
from pyspark.sql import functions as F

from trailgrain.llm import boilerplate, encoding, language, neardup, residue

TEXTS = ["Die Möhren kochen über der Glut – 80 °C, “langsam”.", "Śliwki suszone i kaszę gryczaną podgrzej, żeby nic się nie przypaliło.", "Jalapeños añade el azúcar después", "Замочите муку и тушёнку, дайте постоять.", "玉ねぎを鍋でさらに41分戻します。冬のくるみサラダ"]
CLEAN = ["£3 for a tin of beans × 2 is robbery – naïve of us.", "HIKER’S JALAPEÑOS", "ser żółty ± 20 g", "Рёбра и мёд", "PÃO E MAÇÃS", "plain", "¿Qué tal? Why? Because.", "½ l crème fraîche · 2", "Ääkköset ja öljy"]


@pytest.mark.parametrize("text", TEXTS[:3])
@pytest.mark.parametrize("read_as", ["cp1252", "latin_1", "cp1250", "mac_roman", "cp437"])
def test_utf8_round_trip(text, read_as):
    try:
        bad = text.encode().decode(read_as)
    except UnicodeDecodeError:
        pytest.skip("bytes that this encoding leaves undefined")
    assert encoding.diagnose(bad)[:2] == (True, text)


@pytest.mark.parametrize("text, written, read_as", [(TEXTS[3], "cp1251", "latin_1"), (TEXTS[3], "utf_8", "cp1251"), (TEXTS[4], "utf_8", "latin_1"), (TEXTS[4], "cp932", "latin_1"), (TEXTS[1], "cp1250", "cp1252"), (TEXTS[2], "cp1252", "mac_roman")])
def test_other_pairs(text, written, read_as):
    assert encoding.diagnose(text.encode(written).decode(read_as, "replace"))[0]


def test_twice_misread():
    bad = TEXTS[2].encode().decode("latin_1").encode().decode("latin_1")
    assert encoding.diagnose(bad)[:2] == (True, TEXTS[2])


@pytest.mark.parametrize("text", CLEAN + TEXTS + ["", None])
def test_clean_text_stays(text):
    assert encoding.diagnose(text) == (False, text, False)


def test_lost_bytes():
    assert encoding.diagnose("Gruy?re and Ghee")[::2] == (True, True) and encoding.diagnose("az�car")[0] and encoding.diagnose("????? ?? ??????.")[0]


def test_find_garbled_agrees_with_the_kernel(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    got = {(r["page_id"], r["field_name"]) for r in encoding.find_garbled(pages).collect()}
    rows = pages.select("page_id", "title", "text").collect()
    assert got == {(r["page_id"], f) for r in rows for f in ("title", "text") if encoding.diagnose(r[f])[0]}


PAGE = ["Home | Recipes | Log in", "© 2020 Tin Pot. All rights reserved.", "Camp Chili", "Stir the beans and serve.", "Menu for day two.", "Gear: one pan, one spoon.", "Ingredients: 2 kg beans, 3 tsp salt", "Related posts: Chili | Stew", "Page not found.", "Subscribe to the TinPot newsletter and never miss a meal", "Page 1 2 3 … Next", "", "Startseite > Rezepte > Kekse", "Serves 4."]


def test_furniture_lines():
    got = boilerplate.Blocks().lines("\n".join(PAGE), "www.tin-pot7.example", 10)
    assert [i for i, f in enumerate(got) if f] == [0, 1, 7, 9, 10, 12]


def test_cut_line():
    blocks = boilerplate.Blocks()
    assert blocks.lines("Boil it.\nSubscribe to the Tin", "tin-pot.example", 99)[1]
    # A page without sentences, as a short line beside sentences is a label whether the text was cut or not.
    assert blocks.lines("Boil it\nSubscribe to the Tin", "tin-pot.example", 99)[1] and not blocks.lines("Boil it\nSubscribe to the Tin", "tin-pot.example", 27)[1]


def test_main_content_odd_rows(spark):
    df = spark.createDataFrame([(1, "\n".join(PAGE), "tin-pot.example", None, "x"), (2, None, None, 5, "y"), (3, "", "a.example", 0, "z"), (None, "x" * 50_000, None, None, None)], "page_id long, text string, domain string, chars int, line_no string")
    body = {r["page_id"]: r["body"] for r in boilerplate.main_content(df).collect()}
    assert body[2] is None and body[3] == "" and "Home" not in body[1] and "Stir the beans" in body[1] and len(body[None]) == 50_000
    assert boilerplate.find_furniture(df).where("page_id is null or page_id > 1").count() == 0


RESIDUE = ["{{ title }} soup", "Stir <%= year %> well", "Lorem dolor amet sint qui velit.", "Serves undefined.", "2 cups oats Weight: NaN oz per serving.", "You need to enable JavaScript to run this app.", "404 – Page not found.", "notes_label", "この画面を表示するにはJavaScriptを有効にしてください。", "Text kommt noch."]
FINE = ["Please enable JavaScript to view the comments", "The title of the dish is a joke {and a bad one}.", "[Optional] a spoon of jam goes on top.", "The menu board said error, but there was no soup left.", "Access to the beach was denied by the tide.", "A null result: the moss broth tasted of nothing.", "Mile 404 is where the water cache was not found by anyone.", "The lake is called Ipsum Pond on the old map.", ""]


@pytest.mark.parametrize("text, expected", [(t, True) for t in RESIDUE] + [(t, False) for t in FINE])
def test_residue(text, expected):
    index = residue.ResidueIndex({}, 100)
    assert index.page(None, "Boil the rice.\n" + text) is expected


def test_residue_titles_and_empty_table(spark):
    index = residue.ResidueIndex({}, 100)
    assert index.page("Not Found", None) and index.page("404", "x") and not index.page("Error-free chili", "x") and not index.page(None, None)
    df = spark.createDataFrame([(1, "Error", "x"), (2, "Soup", None), (2, "Soup", None)], "page_id int, title string, text string")
    assert [r[0] for r in residue.find_residue(df).collect()] == [1] and residue.find_residue(df.where("false")).count() == 0
    assert residue.without_residue(df).count() == 2


SAMPLES = {"en": "Stir the beans and the rice over the fire until the water has gone. ", "de": "Die Bohnen und den Reis über der Glut rühren, bis das Wasser weg ist. ", "fr": "Remuez les haricots et le riz sur la braise jusqu'à ce que l'eau soit absorbée. ", "ru": "Размешайте фасоль и рис над углями, пока вода не уйдёт. "}


def test_mixture_of_languages():
    model = language.train({k: [v * 3] * 5 for k, v in SAMPLES.items()})
    kernel = language.PageLanguages(model, residue.ResidueIndex({}, 1))
    rows = [(0, None, SAMPLES["en"] * 4 + SAMPLES["ru"], None, None), (1, None, SAMPLES["de"] * 2, None, None), (2, "Error", SAMPLES["de"], None, None), (3, None, "Camp Chili", None, None)]
    got = {}
    for row, lang, confidence, _ in kernel.batch(rows):
        got.setdefault(row, set()).add(lang)
        assert confidence > 0.9
    assert got == {0: {"en", "ru"}, 1: {"de"}}


def test_sentences_have_languages_or_none():
    model = language.train({k: [v * 3] * 5 for k, v in SAMPLES.items()})
    kernel = language.PageLanguages(model, residue.ResidueIndex({}, 1))
    text = SAMPLES["en"] * 3 + "\n" + SAMPLES["ru"] + "Ωμέγα ψάρι ξύλο θάλασσα βουνό κρύο νερό."
    got = kernel.sentence_rows([(5, None, text, None, None), (6, None, "Camp Chili", None, None)])
    assert [(line, place, lang) for _, line, place, _, lang, _ in got] == [(0, 0, "en"), (0, 1, "en"), (0, 2, "en"), (1, 0, "ru"), (1, 1, "und")]
    assert all(r[0] == 5 and r[5] > 0.6 for r in got) and got[3][3] == SAMPLES["ru"].strip()


def test_the_training_sample_is_bounded_whole_and_stable(spark):
    rows = [(i % 7, f"{i} " + "stir the beans and wait a while " * 4, "English") for i in range(60)] + [(1, "x" * 30_000, "en"), (None, None, "en"), (2, "Bohnen " * 20, "DE"), (3, "f" * 60, "?")]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    one, two = (language.training_texts(d, per_language=10) for d in (df, df.repartition(7)))
    assert one == two and len(one["en"]) == 10 and one["de"] == ["Bohnen " * 20] and all(len(t) > 120 for t in one["en"])
    assert language.training_texts(df.where("false")) == {}


def test_segments_of_whole_tables(spark, data):
    pages, documents = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("pages", "documents"))
    found = language.page_segments(pages, documents).checkpoint()
    per_page = {r["page_id"]: r["n"] for r in found.groupBy("page_id").agg(F.count("*").alias("n")).collect()}
    by_page = language.page_languages(pages, documents).checkpoint()
    assert per_page == {r["page_id"]: r["n"] for r in by_page.groupBy("page_id").agg(F.sum("sentences").alias("n")).collect()}
    named = found.where("lang <> 'und'").select("page_id", "lang").distinct()
    assert named.join(by_page, ["page_id", "lang"], "left_anti").count() == 0 and found.where("lang = 'und'").count() <= 0.05 * found.count()
    assert found.where("confidence < 0 or confidence > 1 or confidence is null").count() == 0


def test_language_codes(spark):
    labels = [("English", "en"), ("en_GB", "en"), ("fr-CA", "fr"), (" DEUTSCH ", "de"), ("日本語", "ja"), ("n/a", None), ("", None), (None, None), ("und", None), ("swe", "sv")]
    df = spark.createDataFrame(labels, "l string, c string")
    assert df.where(~language.language_code(df["l"]).eqNullSafe(df["c"])).count() == 0


def test_leads_follow_the_majority(spark):
    pages = spark.createDataFrame([(i, f"{'www.' * (i % 2)}A.example") for i in range(4)] + [(9, "b.example"), (10, None)], "page_id long, domain string")
    found = spark.createDataFrame([(0, "en"), (1, "en"), (2, "de"), (3, "en"), (3, "de"), (9, "fr"), (9, "en")], "page_id long, lang string")
    leads = spark.createDataFrame([(1, "a.EXAMPLE", "german"), (2, "www.a.example", "EN"), (3, "a.example", None), (4, "b.example", "x"), (5, None, "en")], "lead_id long, domain string, language string")
    assert sorted((r["lead_id"], r["lang"]) for r in language.relabelled_leads(leads, pages, found).collect()) == [(1, "en"), (3, "en")]


def jaccard(a, b):
    import regex

    def shingles(t):
        w = [x for x in regex.findall(r"[\p{L}\p{N}]+", t.lower()) if len(x) >= 3]
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 80 else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x and y else 0


def test_similar_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvö") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(150)]
        for edits in (0, 3, 10, 18, 40):
            own = list(base)
            for _ in range(edits):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    texts += [texts[0], texts[0], "too short", "", None]
    rows = [(i, None if i % 2 else "Ä ti", t) for i, t in enumerate(texts)]
    pages = spark.createDataFrame(rows, "page_id long, title string, text string")
    full = [f"{a or ''} {b or ''}" for _, a, b in rows]
    expected = {(i, j): s for i in range(len(full)) for j in range(i + 1, len(full)) if (s := jaccard(full[i], full[j])) >= 0.5}
    got = {tuple(r) for r in neardup.similar_pairs(pages).collect()}
    assert got <= expected.keys() and {p for p, s in expected.items() if s >= 0.56} <= got and len(got) >= 0.97 * len(expected)
    groups = {r["page_id"]: r for r in neardup.groups(pages).collect()}
    assert len(groups) == len(rows) and groups[0]["class"] == groups[60]["class"] and groups[62]["class"] is None
    assert groups[61]["representative"] == 0 and groups[62]["representative"] == 62 and groups[61]["cluster"] == groups[0]["cluster"]
    assert neardup.similar_pairs(pages.where("false")).count() == 0


@pytest.mark.parametrize("dealt, hot", [(50, 10**9), (8192, 10**9), (8192, 0)])
def test_pairs_of_a_large_family_all_meet(monkeypatch, dealt, hot):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(neardup, "COST", 16)
    monkeypatch.setattr(neardup, "DEALT", dealt)
    rng = np.random.default_rng(4)
    shared, n = rng.integers(1, 1 << 52, 100, dtype=np.uint64), 400  # each pair has a similarity of 100 / 180
    flat = np.concatenate([np.sort(np.concatenate((shared, rng.integers(1, 1 << 52, 40, dtype=np.uint64)))) for _ in range(n)])
    ids, first = neardup.sketches(flat, np.arange(n + 1) * 140)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array([140] * n, pa.int32()), pa.array([r.tobytes() for r in first], pa.binary())], names=["class", "size", "sketch"])
    slots = [1024] if hot else [1024, *range(1024)]
    rows = pa.Table.from_batches([neardup._band_rows(batch, slots)]).sort_by("band").to_batches(max_chunksize=1000)
    assert sum(r.num_rows for r in rows) == n * neardup.TABLES * (1 if hot else neardup.BLOCKS)
    pairs, blocks = set(), []
    for out in neardup._meeting_pairs(iter(rows)):
        whole = out.filter(out.column(2).is_valid())
        blocks += [whole.select(["block", "other"])] if whole.num_rows else []
        out = out.filter(out.column(2).is_null())
        pairs |= set(zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True))
    assert bool(blocks) == (dealt == 50)
    for out in neardup._dealt_pairs(iter(blocks)):
        pairs |= set(zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True))
    assert len(pairs) >= 0.998 * n * (n - 1) / 2


@pytest.mark.parametrize("n, hot", [(1500, 500), (5000, neardup.HOT)])
def test_clusters_of_pages_of_one_template(spark, monkeypatch, n, hot):
    monkeypatch.setattr(neardup, "HOT", hot)
    rng = random.Random(9)
    template = ["".join(rng.choice("abcdefghijklmnoprstuv") for _ in range(6)) for _ in range(160)]
    rows = []
    for i in range(n):
        own = list(template)
        at = rng.randrange(40, 120)
        own[at : at + 18] = [f"w{i}x{k}" for k in range(rng.randrange(24, 28))]
        rows.append((i, " ".join(own)))
    pages = spark.createDataFrame(rows, "page_id long, text string").withColumn("title", F.lit(None).cast("string")).repartition(8)
    members, links = neardup.join_classes(pages)
    links = links.checkpoint()
    sample = [tuple(rng.sample(range(n), 2)) for _ in range(2000)]
    similar = {p for p in sample if jaccard(rows[p[0]][1], rows[p[1]][1]) >= 0.5}
    asked = spark.createDataFrame(sample, "x long, y long")
    one, two = (members.select(F.col("key").alias(k), F.col("class").alias(c)) for k, c in (("x", "cx"), ("y", "cy")))
    named = asked.join(one, "x").join(two, "y").select("x", "y", F.least("cx", "cy").alias("a"), F.greatest("cx", "cy").alias("b"))
    found = {(r["x"], r["y"]) for r in named.join(links, ["a", "b"]).collect()}
    assert len(similar) > 1000 and found <= similar and len(found) >= 0.99 * len(similar)


def test_clusters_follow_chains_of_links(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 99), (99, 101), (7, 3)]
    got = {r["class"]: r["cluster"] for r in neardup.clusters(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {99: 99, 100: 99, 101: 99}
    assert neardup.clusters(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_garbled_sign_among_clean_cyrillic_letters():
    text = "Замочите гречневую крупу и тушёнку, щавель, ячмень – дайте постоять, объедки выбросьте"
    assert encoding.diagnose(text.replace("–", "–".encode().decode("cp1252")))[:2] == (True, text)


def test_garbled_words_after_many_odd_ones():
    odd = "\n".join(f"{w} λάδι ʃɛʒ ɸβγ ωψχ ɪʊə" for w in "one two three four five six seven eight nine ten eleven twelve".split())
    tail = "Die Möhren kochen"
    assert encoding.diagnose(f"{odd}\n{tail.encode().decode('cp1252')}")[1] == f"{odd}\n{tail}"


def test_the_gate_lets_every_suspect_text_through(spark):
    texts = ["àé", "éèêë", "a?é", "x½", "ein ß hier", "?? ??", "plain é"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t").where(F.col("t").rlike(encoding.SUSPECT))
    assert found.count() == 6 and found.where(~F.col("t").rlike(encoding.GATE)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_the_index_retrieves_every_exemplar_that_a_window_covers(seed):
    rng = random.Random(seed)
    index = residue.ResidueIndex({t: rng.randrange(1000) for t in sorted(residue.vocabulary())}, 1000)
    for i, (_, wanted, own) in enumerate(residue.exemplars()):
        for missing in own:
            held = {p for p in wanted if missing not in p.split(" ")}
            if sum(index.weight[p] for p in held) >= residue.COVERAGE * index.total[i]:
                assert any(i in index.by_word.get(w, ()) for w in own - {missing})


# Pairs of encodings, and the least part of clean texts that comes back exactly after a whole, lossless misreading.
RATES = [("utf_8", "cp1252", 1.0), ("utf_8", "mac_roman", 1.0), ("utf_8", "cp437", 1.0), ("utf_8", "iso8859_2", 0.95), ("cp1252", "cp1250", 0.85), ("mac_roman", "cp1252", 0.7), ("cp1252", "mac_roman", 0.9), ("cp437", "cp1252", 0.5), ("cp1252", "cp437", 0.85), ("cp1251", "koi8_r", 0.95)]


@pytest.fixture(scope="module")
def clean_texts(spark):
    """(known contexts, other clean texts)."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trained = language.training_texts(documents, per_language=40)
    used = {t for own in trained.values() for t in own}
    others = [r["text"][:400] for r in documents.where("length(text) > 60").orderBy("doc_id").select("text").collect() if r["text"] not in used]
    return encoding.contexts(used), [t for t in others if not encoding.diagnose(t)[0]]


@pytest.mark.parametrize("written, read_as, least", RATES)
def test_rates_of_exact_restoration(clean_texts, written, read_as, least):
    known, texts = clean_texts
    pairs = []
    for t in texts:
        try:
            bad = t.encode(written).decode(read_as)
        except UnicodeError:
            continue
        if bad != t:
            pairs.append((bad, t))
    assert len(pairs) >= 40 and sum(encoding.diagnose(bad, known)[1] == t for bad, t in pairs[:80]) >= least * len(pairs[:80])


@pytest.mark.parametrize("written, read_as", [("koi8_r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "koi8_r")])
def test_cyrillic_comes_back(clean_texts, written, read_as):
    assert encoding.diagnose(TEXTS[3].encode(written).decode(read_as), clean_texts[0])[1] == TEXTS[3]


def test_no_contexts_change_nothing(spark):
    assert encoding.contexts([]) == frozenset() and encoding.strangeness("é", None) == 0
    df = spark.createDataFrame([(1, "Die Möhren".encode().decode("cp1252"), None), (1, None, "")], "page_id int, title string, text string")
    known = encoding.contexts(TEXTS)
    assert [r["restored"] for r in encoding.find_garbled(df, known=known).collect()] == [r["restored"] for r in encoding.find_garbled(df).collect()] == ["Die Möhren"]


def test_all_labelled_documents_give_contexts(spark):
    rows = [(i, f"stir the beans and wait {i} minutes or a little longer é", "en") for i in range(300)]
    rows += [(i, f"stir the beans and wait {i} minutes or a little longer {chr(0x4E00 + i)}", "ja") for i in range(300)]
    long = "a plain sentence. " * 2000 + "jalapeños"
    rows += [(700, long, "en"), (701, "kaszę", "Polish"), (702, "garçon", "xx"), (703, "Die Möhren kochen".encode().decode("cp1252"), "de"), (704, None, "de"), (705, "Die Möhren", "DE")]
    documents = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    known = encoding.contexts_of(language.labelled(documents.repartition(5)))
    assert known == encoding.contexts(t for i, t, _ in rows if i not in (702, 703, 704)) and {f" {chr(0x4E00 + i)}" for i in range(300)} < known
    assert encoding.contexts_of(language.labelled(documents.where("false"))) == frozenset()


def test_all_labelled_documents_train_the_model(spark):
    rng = random.Random(3)
    rows = [(i, code, SAMPLES[code] + "".join(rng.choice("abcdefgh") for _ in range(9)) + " wait. " * (i % 5)) for i in range(400) for code in SAMPLES]
    rows += [(1000, "en", SAMPLES["en"] * 400 + "zyxqzj."), (1001, "en", SAMPLES["ru"]), (1002, "de", SAMPLES["fr"] * 2), (1003, "es", "!"), (1004, None, "qqqq"), (1005, "it", SAMPLES["de"]), (1006, "en", None)]
    documents = spark.createDataFrame([(i, text, code) for i, code, text in rows], "doc_id int, text string, lang string")
    texts = {}
    for _, code, text in rows:
        if code and text:
            texts.setdefault(code, []).append(text)
    expected = language.train(texts)
    for part in (documents, documents.repartition(7)):
        model = language.train_on(part)
        assert model.languages == expected.languages == ("en", "de", "fr", "it", "ru") and model.index == expected.index and (model.table == expected.table).all()
        assert model.unknown == expected.unknown > -20 and "zyx" in model.index and "qqq" not in model.index
    assert language.train_on(documents, calibrated=False).index == expected.index
    empty = language.train_on(documents.where("false"))
    assert empty.languages == ("en",) and empty.unknown == float("-inf")


def test_words_are_runs_of_letters_of_any_plane():
    every = " ".join(chr(c) + "x" for c in range(0x30000) if not 0xD800 <= c < 0xE000 and not language._CJK.search(chr(c).lower()))
    assert [w for t in every.split(" ") for w in language.split_words(t)] == language._TOKEN.findall(every.lower())
    assert language.split_words("𝒜b 😀c ねぎ") == ["𝒜b", "c", "ねぎ"]


def test_languages_count_the_same_for_the_threshold():
    model = language.train({"en": [SAMPLES["en"]] * 4, "de": [SAMPLES["de"]] * 4})
    model.calibrate({"en": language.Counter({-10: 10_000}), "de": language.Counter({-50: 3, -30: 97})})
    assert model.unknown == -50 / language.STEPS


@pytest.mark.parametrize("columns", [("rec_kind", "rec_id", "lang"), ("rec_kind", "rec_id", "lang", "confidence")])
def test_both_uses_of_the_languages_of_pages_share_a_shuffle(spark, data, columns):
    pages, leads, documents = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("pages", "leads", "documents"))
    rows = language.language_rows(pages, leads, documents).select(*columns)
    got = sorted(map(tuple, rows.collect()))
    final = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("MapInArrow") == 1 and "ReusedExchange" in final
    found = spark.createDataFrame(language.page_languages(pages, documents).collect(), "page_id long, lang string, confidence double, sentences int")
    expected = found.selectExpr("'page' as rec_kind", "page_id as rec_id", "lang", "confidence").union(language.relabelled_leads(leads, pages, found).selectExpr("'lead'", "lead_id", "lang", "confidence")).select(*columns)
    assert [r[:3] for r in got] == [r[:3] for r in sorted(map(tuple, expected.collect()))] and len(got) > found.count()
