"""One form for texts that look the same: a compiled longest-match transducer over grapheme clusters.

The mapping is computed once from rules over Unicode data and a fixed list of look-alike letters, checked for
conflicts, and compiled into tables: what each character is replaced by (wide forms, fixed spaces, look-alike letters,
a composed letter's parts, nothing for characters that take no room), and the transitions of an automaton whose states
are composed letters and whose inputs are the marks and letter parts that may follow. A cluster is a base with all that
attaches to it; the automaton takes the longest sequence it has transitions for and passes on what it has none for. All
clusters of a batch go through the tables at once, a place in the cluster at a time; nothing is decided outside of
them. Letter case, accents, digits, punctuation and numbers of spaces stay.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.session import cut_lineage, maybe_broadcast

# Letters of other scripts beside the Latin letters they look like.
LOOKALIKES = {
    # Cyrillic
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Ԍ": "G", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W", "Х": "X", "У": "Y", "Ү": "Y",
    # Greek
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ϲ": "C", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Ϳ": "J", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    # Coptic
    "ⲟ": "o", "ⲣ": "p", "ⲥ": "c", "Ⲃ": "B", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "Ⲣ": "P", "Ⲥ": "C", "Ⲧ": "T", "Ⲭ": "X",
    # Armenian
    "օ": "o", "հ": "h", "ո": "n", "ս": "u", "ց": "g", "Օ": "O", "Տ": "S", "Ս": "U",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮐ": "G", "Ꮓ": "Z", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
}
# First and last of the characters that take no room, and spaces that forbid a break.
ROOMLESS = (("­", "­"), ("͏", "͏"), ("؜", "؜"), ("᠋", "᠎"), ("​", "‏"), ("‪", "‮"), ("⁠", "⁤"), ("⁦", "⁯"), ("︀", "️"), ("﻿", "﻿"))
FIXED_SPACES = "   "
CHARACTERS = 0x110000
AT_ONCE = 1_000_000  # characters of a step


def _known_characters() -> Iterator[str]:
    for code in range(0x80, 0x30000):
        if not 0xD800 <= code < 0xE000:
            yield chr(code)


def build_mapping() -> dict[str, str]:
    """Every character whose parts are others: its wide or narrow form's plain one, decomposed, with look-alike letters replaced."""
    mapping = {chr(c): "" for a, b in ROOMLESS for c in range(ord(a), ord(b) + 1)} | {c: " " for c in FIXED_SPACES}
    for c in _known_characters():
        if c in mapping:
            continue
        tag, _, rest = unicodedata.decomposition(c).rpartition("> ")
        plain = "".join(chr(int(x, 16)) for x in rest.split()) if tag in ("<wide", "<narrow") else c
        form = "".join(LOOKALIKES.get(x, x) for x in unicodedata.normalize("NFD", plain))
        if form != c:
            mapping[c] = form
    return mapping


def build_transitions(mapping: dict[str, str]) -> dict[tuple[str, str], str]:
    """(state, what follows) to the next state: two characters that are written as one."""
    out = {}
    for c in _known_characters():
        parts = unicodedata.decomposition(c)
        if 0xAC00 <= ord(c) < 0xD7A4:  # Hangul syllables: the last part attaches to what the others make
            whole = unicodedata.normalize("NFD", c)
            out[unicodedata.normalize("NFC", whole[:-1]), whole[-1]] = c
        elif parts and "<" not in parts and len(parts.split()) == 2 and unicodedata.normalize("NFC", c) == c:
            a, b = (chr(int(x, 16)) for x in parts.split())
            if unicodedata.normalize("NFD", a)[0] not in LOOKALIKES:
                out[a, b] = c
    return out


def check_mapping(mapping: dict[str, str], transitions: dict[tuple[str, str], str]) -> None:
    """Raise where the mapping would change plain characters, lose or add an accent, map a form again, or join different letters."""
    marks = lambda text: [x for x in unicodedata.normalize("NFD", text) if unicodedata.combining(x)]
    for key, form in mapping.items():
        if not key or key.isascii():
            raise ValueError(f"a plain character is mapped: {key!r}")
        if any(x in mapping for x in form):
            raise ValueError(f"the form of {key!r} is mapped again: {form!r}")
        if sorted(marks(key)) != sorted(marks(form)) and unicodedata.decomposition(key)[:5] not in ("<wide", "<narr") and form:
            raise ValueError(f"an accent is lost or added: {key!r}")
    for (a, b), c in transitions.items():
        if unicodedata.normalize("NFD", a + b) != unicodedata.normalize("NFD", c):
            raise ValueError(f"{a!r} and {b!r} don't make {c!r}")


class Transducer:
    """The compiled mapping: tables over code points, run over whole batches."""

    def __init__(self, mapping: dict[str, str] | None = None):
        self.mapping = build_mapping() if mapping is None else mapping
        self.transitions = build_transitions(self.mapping)
        check_mapping(self.mapping, self.transitions)
        # entry 0 stands for the character itself
        self.entry = np.zeros(CHARACTERS, np.int32)
        self.entry[[ord(k) for k in self.mapping]] = np.arange(1, len(self.mapping) + 1)
        forms = [np.array([ord(x) for x in f], np.uint32) for f in self.mapping.values()]
        self.size = np.array([1, *map(len, forms)])
        self.begin = np.cumsum(self.size) - self.size
        self.parts = np.concatenate([np.zeros(1, np.uint32), *forms])
        self.order = np.zeros(CHARACTERS, np.uint8)  # combining classes; 0 is a base
        for c in _known_characters():
            self.order[ord(c)] = unicodedata.combining(c)
        keys = np.array([(ord(a) << 21) | ord(b) for a, b in self.transitions], np.int64)
        by = np.argsort(keys)
        self.keys, self.next = keys[by], np.array([ord(c) for c in self.transitions.values()], np.uint32)[by]
        self.attaches = self.order > 0
        self.attaches[[ord(b) for _, b in self.transitions]] = True

    def run(self, chars: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forms of texts given one after the other as code points, and where each begins; ``starts`` has one entry more than there are texts."""
        entry = self.entry[chars]
        size = self.size[entry]
        ends = np.cumsum(size)
        at = np.append(0, ends)[starts]
        n = int(at[-1])
        back = np.repeat(np.arange(len(chars)), size)
        out = np.where(entry[back] > 0, self.parts[np.minimum(self.begin[entry[back]] + np.arange(n) - (ends - size)[back], len(self.parts) - 1)], chars[back])
        order = self.order[out]
        first = np.zeros(n + 1, bool)
        first[at] = True
        first = first[:n]
        # marks of a cluster in the order of their classes; those of one class keep theirs
        wrong = np.flatnonzero((order[1:] > 0) & (order[:-1] > order[1:]) & ~first[1:])
        if len(wrong):
            run = np.cumsum((order == 0) | first)
            mine = np.flatnonzero(np.isin(run, run[wrong]) & (order > 0))
            sorted_ = mine[np.lexsort((mine, order[mine], run[mine]))]
            out[mine], order = out[sorted_], order.copy()
            order[mine] = self.order[out[mine]]
        # the automaton, over all clusters of more than one character together
        base = ~self.attaches[out] | first
        heads = np.flatnonzero(base)
        length = np.diff(np.append(heads, n))
        keep = np.ones(n, bool)
        heads, length = heads[length > 1], length[length > 1]
        state, held, last = heads.copy(), out[heads].astype(np.int64), np.zeros(len(heads), np.int64) - 1  # last: class of what stands between, -1 for nothing
        for k in range(1, int(length.max(initial=1))):
            more = length > k
            heads, length, state, held, last = heads[more], length[more], state[more], held[more], last[more]
            c, rank = out[heads + k].astype(np.int64), order[heads + k].astype(np.int64)
            key = (held << 21) | c
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            joins = (self.keys[found] == key) & ((last < 0) | ((rank > last) & (rank > 0)))
            held = np.where(joins, self.next[found], held)
            out[state[joins]] = held[joins]
            keep[(heads + k)[joins]] = False
            # what has no transition passes: a mark stands between, a base begins anew
            anew = ~joins & (rank == 0)
            state, held = np.where(anew, heads + k, state), np.where(anew, c, held)
            last = np.where(joins, last, np.where(anew, -1, rank))
        return out[keep], np.append(0, np.cumsum(keep))[at]

    def forms(self, texts: list[str | None]) -> list[str | None]:
        """The form of each text; null stays null."""
        out: list[str | None] = []
        a = 0
        while a < len(texts):
            b, total = a, 0
            while b < len(texts) and (b == a or total + len(texts[b] or "") <= AT_ONCE):
                total += len(texts[b] or "")
                b += 1
            part = texts[a:b]
            joined = "".join(x or "" for x in part)
            if joined.isascii():
                out += part
            else:
                starts = np.append(0, np.cumsum([len(x or "") for x in part]))
                chars, at = self.run(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), starts)
                whole = chars.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                out += [None if x is None else whole[i:j] for x, i, j in zip(part, at[:-1].tolist(), at[1:].tolist(), strict=True)]
            a = b
        return out

    def __call__(self, text: str) -> str:
        return self.forms([text])[0]


_TRANSDUCER: list[Transducer] = []


def transducer() -> Transducer:
    """One per worker process."""
    if not _TRANSDUCER:
        _TRANSDUCER.append(Transducer())
    return _TRANSDUCER[0]


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = transducer()
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "form": pa.array(t.forms(batch.column("text").to_pylist()), pa.string())})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = transducer()
    digest = lambda x: hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        forms = t.forms(texts)
        held = [i for i, x in enumerate(forms) if x is not None and x.strip()]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id").take(pa.array(held, pa.int64())),
            "form": pa.array([digest(forms[i]) for i in held], pa.binary()),
            "raw": pa.array([digest(texts[i]) for i in held], pa.binary()),
        })


def uniform_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, form`` of every row; a null text has a null form, an empty one the empty form."""
    return docs.select("doc_id", "text").mapInArrow(_forms, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, form string")


def lookalike_pairs(docs: DataFrame, rows_per_task: int = 20_000) -> DataFrame:
    """``doc_id_a, doc_id_b`` (the smaller first) of documents whose texts differ but have one form.

    Null, empty and blank texts and rows without doc_id have no pairs; repeated rows add none; an empty table has
    none. Texts are compared by 128-bit digests. Pairs are found between different texts of a form, which are few
    however often each is copied, and only then spread to the documents that hold them; so copies of one text never
    meet each other, and the work beyond reading is in proportion to the pairs that come out. A text with more than
    ``rows_per_task`` copies is split into parts on both sides.
    """
    # two digests a document stand for the texts from here on, which are read and mapped once
    held = cut_lineage(docs.select("doc_id", "text").filter("doc_id is not null and text is not null").mapInArrow(_digests, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, form binary, raw binary"))
    texts = held.groupBy("form", "raw").agg(F.ceil(F.count(F.lit(1)) / rows_per_task).alias("parts"))
    several = texts.groupBy("form").count().filter("count > 1").select("form")
    texts = cut_lineage(texts.join(several, "form", "left_semi"))
    one, other = (texts.select("form", F.col("raw").alias(f"raw_{x}"), F.col("parts").alias(f"parts_{x}")) for x in "ab")
    part = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    pairs = one.join(other, "form").filter("raw_a < raw_b").select("raw_a", "raw_b", "parts_b", part("parts_a").alias("part_a"))
    # the part of its text that a document lies in
    crowded = maybe_broadcast(texts.filter("parts > 1").select("raw", F.col("parts").alias("of")))
    members = held.join(crowded, "raw", "left").select("doc_id", "raw", F.pmod(F.xxhash64("doc_id"), F.coalesce("of", F.lit(1))).alias("part"))
    half = pairs.join(members.select(F.col("doc_id").alias("a"), F.col("raw").alias("raw_a"), F.col("part").alias("part_a")), ["raw_a", "part_a"]).select("a", "raw_b", part("parts_b").alias("part_b"))
    both = half.join(members.select(F.col("doc_id").alias("b"), F.col("raw").alias("raw_b"), F.col("part").alias("part_b")), ["raw_b", "part_b"]).filter("a != b")
    return both.select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b")).distinct()
