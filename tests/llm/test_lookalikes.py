import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyloom.llm import lookalikes as lk

t = lk.Transducer()


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("Ｆｕｌｌ　ｗｉｄｔｈ１２３！", "Full width123!"), ("café", "café"), ("sсорe", "scope"), ("Ｅ́", "É"), ("zero​width­﻿", "zerowidth"), ("a b c d", "a b c d"), ("Ёж", "Ëж"), ("ё", "ë"),
        ("が", "が"), ("й", "й"), ("e​́", "é"), ("ệ", "ệ"), ("ΑΒΕΟ", "ABEO"), ("한", "한"), ("Å", "Å"), ("Ǖ", "Ǖ"), ("ѐ̣", "ẹ̀"), ("ό", "ό"), ("👨‍👩", "👨👩"),
    ],
)
def test_same_look_same_form(a, b):
    assert t(a) == t(b)


@pytest.mark.parametrize(("a", "b"), [("A", "a"), ("e", "é"), ("1", "l"), ("O", "0"), ("a b", "a  b"), ("a-b", "a–b"), ("к", "k"), ("й", "и"), ("é", "è"), ("ł", "l"), ("ß", "ss"), ("“x”", '"x"'), ("a\nb", "a b"), ("ﬁ", "fi"), ("²", "2"), ("が", "か")])
def test_other_look_other_form(a, b):
    assert t(a) != t(b)


def test_every_mapped_key_goes_to_its_form_and_stays():
    for key, form in t.mapping.items():
        assert t(key) == unicodedata.normalize("NFC", form) == t(form)
    assert all(t(chr(c)) == chr(c) for c in range(128))


@pytest.mark.parametrize(("mapping", "transitions"), [({"а": "о", "о": "o"}, {}), ({"e": "a"}, {}), ({"é": "e"}, {}), ({" ": "​", "​": ""}, {}), ({}, {("e", "\u0301"): "è"})])
def test_conflicts_are_refused(mapping, transitions):
    with pytest.raises(ValueError):
        lk.check_mapping(mapping, transitions)


def test_every_character_has_a_fixed_form():
    everything = [chr(c) for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000]
    forms = t.forms(everything)
    assert t.forms(forms) == forms


def rule(text):
    """The same form by the Unicode library's own composition, character by character."""
    out = []
    for c in text:
        if t.mapping.get(c) == "":
            continue
        c = " " if c in lk.FIXED_SPACES else unicodedata.normalize("NFKC", c) if unicodedata.decomposition(c).startswith(("<wide", "<narrow")) else c
        out += [lk.LOOKALIKES.get(x, x) for x in unicodedata.normalize("NFD", c)]
    return unicodedata.normalize("NFC", "".join(out))


LETTERS = [*map(chr, range(0x300, 0x370)), *"aeoAаеёЁйсорＡｅΟが゙か한!1é", "\u3000", "\u00a0", "\u200b", "\u00ad", "각", "ᄀ", "ᅡ", "ᆨ", "ㄱ", "å", "ồ", "\u09c7", "\u09be", "\u0bc6", "\u0dd9", "\u0dca", "ｶ", "ﾞ"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(LETTERS), max_size=9), max_size=6))
def test_the_tables_do_what_the_rule_says(texts):
    assert t.forms(texts) == [rule(x) for x in texts]


def test_longest_match_and_what_it_passes_on():
    assert t("o\u0302\u0301") == "ố" and t("o\u0302\u0361\u0301") == "ố\u0361" and t("x\u0302\u0323") == "x\u0323\u0302"
    assert t("\u0301e") == "\u0301e" and t.forms(["e", "\u0301"]) == ["e", "\u0301"]


def test_without_the_transitions_accents_stay_in_two(monkeypatch):
    monkeypatch.setattr(lk, "build_transitions", lambda mapping: {("가", "\u11a8"): "각"})
    assert lk.Transducer()("e\u0301") == "e\u0301" != t("e\u0301")


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeoАаеёЁйсор̧̣́̈̆​­  　ＡｅΟόが゙か한!1é﻿"), max_size=12))
def test_forms_are_fixed_points_whatever_the_composition(text):
    assert t(t(text)) == t(text)
    assert t(unicodedata.normalize("NFD", text)) == t(text) == t(unicodedata.normalize("NFC", text))


def brute(rows):
    forms = [(d, x, t(x)) for d, x in rows if d is not None and x is not None and t(x).strip()]
    return {(min(a, b), max(a, b)) for a, x, f in forms for b, y, g in forms if a != b and x != y and f == g}


def test_pairs_against_brute_force(spark):
    rng = random.Random(2)
    swap = {"a": "аａ", "e": "еｅ", "o": "оοｏ", " ": "  ", "c": "с"}
    base = ["a cool scope", "eco ace", "one", "ccc", "", " ", "​ ­", None]
    rows = []
    for i in range(160):
        x = rng.choice(base)
        rows.append((i, x if x is None or rng.random() < 0.4 else "".join(rng.choice(swap[c]) if c in swap and rng.random() < 0.3 else c for c in x)))
    rows += [(500 + i, "a cool scope") for i in range(60)] + [(None, "оne"), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, "f", "r", 1) for r in rows], "doc_id bigint, text string, form string, raw string, salt int").repartition(4)
    assert {tuple(r) for r in lk.lookalike_pairs(df).collect()} == brute(rows)
    assert {tuple(r) for r in lk.lookalike_pairs(df, rows_per_task=7).collect()} == brute(rows)  # copies of a text split into parts
    assert lk.lookalike_pairs(df.limit(0)).collect() == []
    forms = {r.doc_id: r.form for r in lk.uniform_texts(df.filter("doc_id >= 500")).collect()}
    assert set(forms.values()) == {"a cool scope"}


def test_very_long_text():
    text = "sсоре ​" * 200_000
    assert t(text) == "scope " * 200_000
