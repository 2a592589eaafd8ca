import random

import numpy as np
import pytest

from trailgrain.llm import packing, tokenizer

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(f"{tokenizer.TOKENIZER_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def bpe():
    return tokenizer.SegmentTreeBPE(f"{tokenizer.TOKENIZER_DIR}/{tokenizer.VOCABULARY}")


def encode(bpe, texts):
    ids, ends = bpe.encode_batch(texts)
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]


def test_random_strings(bpe, reference):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \n\t\x1c\x85\xa0é½日本　​\U0001f600's12") for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["a" * n for n in (1, 2, 3, 5, 257, 20_000)] + ["".join(rng.choice("abcdef") for _ in range(5000)), "<|endoftext|> x", "", None]
    assert encode(bpe, texts) == [reference.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_corpus_round_trip(bpe, spark, data, reference):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r["ids"] for r in tokenizer.encode_column(spark.read.parquet(f"{data}/documents.parquet")).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["doc_id"]] == reference.encode(r["text"] or "", add_special_tokens=False).ids


def test_bounded_memo_changes_nothing(bpe, monkeypatch):
    texts = ["one two three", "four five", "one two"] * 3
    whole = encode(bpe, texts)
    monkeypatch.setattr(tokenizer, "MEMO_WORDS", 1)
    monkeypatch.setattr(tokenizer, "CHUNK_CHARS", 5)
    assert encode(bpe, texts) == whole


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a", "x"), (1, None, "x"), (1, "", None), (1, "a", "x"), (1, "a", "x")], "doc_id long, text string, ids string")
    assert sorted(map(str, (r["ids"] for r in tokenizer.encode_column(df).collect()))) == ["[64]", "[64]", "[64]", "[]", "[]"]
    assert tokenizer.encode_column(df.where("false")).count() == 0


def naive(sizes, capacity):
    bins, out = [], []
    for s in sizes:
        at = next((i for i, room in enumerate(bins) if room >= s), None)
        if at is None:
            bins.append(capacity)
            at = len(bins) - 1
        bins[at] -= s
        out.append(at)
    return out


def test_first_fit_is_exact():
    rng = random.Random(2)
    for n in (0, 1, 2, 100, 700):
        sizes = sorted((rng.randint(1, 100) for _ in range(n)), reverse=True)
        assert packing.first_fit_decreasing(sizes, 100) == naive(sizes, 100)


def test_packing_is_whole(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(1, 900, 5000))] + [(9001, 2048), (9002, 10_000), (9003, 0), (9004, None), (9005, 7), (9005, 7)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens int"), group_size=1000).collect()
    load, tokens = {}, {}
    for r in got:
        load[r["container"]] = load.get(r["container"], 0) + r["n_tokens"]
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["n_tokens"]
    assert max(load.values()) <= 2048 and sum(load.values()) == sum(n or 0 for _, n in rows)
    assert tokens[9002] == 10_000 and tokens[9005] == 14 and 9003 not in tokens and sum(load.values()) / (2048 * len(load)) > 0.98
    pieces = sorted((r["piece_no"], r["first_token"], r["n_tokens"]) for r in got if r["doc_id"] == 9002)
    assert pieces == [(i, 2048 * i, 2048) for i in range(4)] + [(4, 8192, 1808)]
    assert all(r["piece_no"] == 0 for r in got if tokens[r["doc_id"]] <= 2048)
    assert packing.pack(spark.createDataFrame([], "doc_id long, n_tokens int")).count() == 0


def test_a_hot_key_is_shared_out_over_groups(spark):
    df = spark.range(4000).selectExpr("cast(null as bigint) as doc_id", "cast(id % 900 + 1 as int) as n_tokens").repartition(4)
    packed = packing.pack(df, group_size=200).selectExpr("split(container, '/')[0] as g", "n_tokens").groupBy("g").count().collect()
    assert len(packed) == 20 and max(r["count"] for r in packed) < 300 and sum(r["count"] for r in packed) == 4000
