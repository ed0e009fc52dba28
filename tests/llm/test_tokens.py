import os

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyloom.llm import tokens


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(os.path.join(tokens.TOKENIZERS, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def encode(texts):
    ids, at = tokens.encoder(tokens.TOKENIZERS).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


HARD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "don't 's 'S '' they'll've", "''s", "a's't b", "x  y   z\n\n\nq \n r\t\ts", "1234 5,678.90", "<|endoftext|>", "a<|endoftext|>b", "星を見る。とても良い！ＡＢＣ",
    "été  nbsp x y 　z  w", "👨‍👩‍👧 ok 👍🏽!", "\x1c\x1d a\x1f b\x85c\x0b\x0cd", "x" * 5000, "ab " * 5000, "=" * 3000 + "a", "a  b  c", "1'2'3 '1 'a '_'s", "﻿​ x​", "мир, труд — май!",
]


def test_hard_texts(reference):
    assert encode(HARD) == reference(HARD)
    assert encode([]) == [] and encode([None]) == [[]]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'sStlvremd 1 2.,!?-_<>|\n\t\r  　é星Я́\x1c\x85(‍😀­")), max_size=6))
def test_any_texts(reference, texts):
    assert encode(texts) == reference(texts)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_characters(reference, text):
    text = text.encode("utf-8", "ignore").decode()
    assert encode([text, text + " " + text]) == reference([text, text + " " + text])


def test_no_token_spans_a_cut():
    ranks = tokens.read_ranks(os.path.join(tokens.TOKENIZERS, tokens.VOCABULARY))
    cuts = tokens.certain_pairs(ranks)
    assert not any(cuts[a, b] for t in ranks for a, b in zip(t, t[1:], strict=False))
    assert cuts[ord("a"), ord(" ")] and cuts[ord("a"), ord(",")] and not cuts[ord("'"), ord("s")] and not cuts[ord(" "), ord("a")]


def test_slices_of_arrays(reference):
    texts = ["one two", None, "three, four", "", "fünf"]
    a = pa.array(["zzz", *texts, "zzz"])[1:6]
    ids, at = tokens.encoder(tokens.TOKENIZERS).encode(a)
    assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:], strict=True)] == reference(texts)


def test_all_rows_of_a_table(spark, reference):
    rows = [(i, t, "clash") for i, t in enumerate(HARD)] + [(None, "x y", "c"), (0, None, "c"), (3, "a", "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = tokens.encode_documents(df).collect()
    want = [(r[0], x) for r, x in zip(rows, reference([r[1] for r in rows]), strict=True)]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted([(r.doc_id, r.ids) for r in got], key=key) == sorted(want, key=key)
    assert sorted(r.n_tokens for r in tokens.token_counts(df).collect()) == sorted(len(x) for _, x in want)
    assert tokens.encode_documents(df.limit(0)).collect() == []
