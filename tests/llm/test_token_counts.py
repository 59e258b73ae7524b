import random

import pytest

from riverload.llm.token_counts import Counter, Vocabulary, ranked_vocabulary, token_count

PATH = "/opt/tokenizers/piece_bpe_32k.model"
TEXTS = ["", " ", "  ", "a", " a", "a b", "a  b ", "the cat\nsat", "▁", "a▁b", "▁▁ a", "日本語 テキスト", "𝄞𝄞 x", "<s> <0x0A> <unk>", "é" * 50, "x" * 3000,
         "\x00\x01", "don't stop 123,456", "ñandú über Straße", "\t\n\r", "aaaaaaaaaaaaaaaaaaaa bbbbbb"]


def reference(vocabulary):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(list(vocabulary.pieces), vocabulary.unknown, vocabulary.byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_public_vocabulary_against_tokenizers():
    vocabulary = ranked_vocabulary(PATH)
    count, expected, rng = Counter(vocabulary).text, reference(vocabulary), random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abcdefgh ▁\nthein.,é日𝄞<>") for _ in range(rng.randrange(60))) for _ in range(1500)]
    assert [count(t) for t in texts] == [expected(t) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_ties_and_unknown_runs_against_tokenizers(seed):
    rng = random.Random(seed)
    pieces = {"".join(rng.choice("abc▁") for _ in range(rng.randint(1, 4))) for _ in range(25)} - {"c"}
    vocabulary = Vocabulary((("<unk>", -9.0), *((p, -float(rng.randint(1, 4))) for p in sorted(pieces))))
    count, expected = Counter(vocabulary).text, reference(vocabulary)
    texts = ["".join(rng.choice("abcd  ") for _ in range(rng.randrange(25))) for _ in range(2000)]
    assert [count(t) for t in texts] == [expected(t) for t in texts]


def test_byte_pieces_must_be_whole():
    with pytest.raises(ValueError):
        Vocabulary((("<unk>", 0.0), ("<0x00>", -1.0)), byte_fallback=True)


def test_column(spark):
    rows = [(1, "a b", 5), (1, "a b", 5), (None, None, None), (2, "", 0), (3, "word " * 200_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = df.select("doc_id", token_count("text", ranked_vocabulary, PATH).alias("n"))
    counter = Counter(ranked_vocabulary(PATH))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((i, counter.text(t)) for i, t, _ in rows), key=str)
    assert df.limit(0).select(token_count("text", ranked_vocabulary, PATH)).count() == 0


def test_query_against_tokenizers(spark):
    import __spark_entry__ as contract

    sf = "/root/testdata/sf0.001"
    expected = reference(ranked_vocabulary(PATH))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.n_chars) for r in contract.queries()["op10_token_counts"](spark, sf).collect()}
    assert got == {i: (expected(t), len(t)) for i, t in texts.items()}
