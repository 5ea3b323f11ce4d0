"""Tree concatenation against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from feldspar.llm import bpe
from feldspar.llm.vocab import default_path, vocab

PATH = default_path()
LIB = Tokenizer.from_file(PATH)


def expected(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


ALPHABETS = ["ab", "a b", "abc'st ", " \n\t", "a1!'", "éñ漢字 ", "'s", "aA.,;- \n", "😀a ", "<|endoftext|> a", "0123", "!?'\"", "  \u0085a", "ǅʰͅ "]


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize("leaf", [1, 2, 7, 33])
def test_tree_equals_library(alphabet, leaf):
    v, rng = vocab(PATH), random.Random(leaf)
    units = ["<|endoftext|>", " a", "<|"] if alphabet.startswith("<|") else list(alphabet)
    for n in (0, 1, 2, 3, 5, 17, 80, 300):
        text = "".join(rng.choice(units) for _ in range(n))
        assert bpe.encode_text(v, text, leaf).tolist() == expected(text), (leaf, text)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "漢字" * 1500, " " * 3001, " " * 3000 + "x", "\n" * 2000 + " x", "!" * 4000, "x" * 2000 + "1" * 2000 + "'s" * 900, "é" * 3000, "'" * 2500 + "s"])
def test_long_unsplit_text(text):
    v = vocab(PATH)
    for leaf in (16, 500):
        assert bpe.encode_text(v, text, leaf).tolist() == expected(text)


def test_splitting_of_all_letters_agrees():
    v = vocab(PATH)
    for start in range(0, 0x11000, 0x400):
        chars = [chr(c) for c in range(start, start + 0x400) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b {c}{c}1 " for c in chars)
        assert bpe.encode_text(v, text, 50).tolist() == expected(text), hex(start)


def test_encode_and_decode_frames(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "one two", "x" * 900, "word " * 400, "a<|endoftext|>b" * 60, "\n\n  tail ", "é漢😀 " * 200]
    texts += ["".join(rng.choice("ab 1'!\n") for _ in range(700)) for _ in range(8)]
    rows = [(i % 12, t, "x", "y") for i, t in enumerate(texts)] + [(None, "no id", None, None), (0, "one two", None, None), (0, "one two", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, key string")
    coded = bpe.encode(docs, leaf=20, spread_chars=100)
    got = bpe.decode(coded).toPandas()
    want = sorted((str(d), t or "", expected(t)) for d, t, _, _ in rows)
    have = sorted((str(d) if d == d and d is not None else "None", t, [int(x) for x in i]) for d, i, t in got[["doc_id", "ids", "decoded"]].itertuples(index=False))
    assert [(a.removesuffix(".0"), b, c) for a, b, c in have] == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs)).count() == 0


def test_decode_of_odd_ids(spark):
    coded = spark.createDataFrame([(1, [99999, -1, 128]), (2, None), (3, [])], "doc_id int, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(coded).collect()}
    assert got[2] == got[3] == "" and got[1] == LIB.decode([128], skip_special_tokens=False)


def test_query_is_the_library(spark):
    from feldspar.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op5_bpe_tree_concatenation"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = expected(d.text)
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()
