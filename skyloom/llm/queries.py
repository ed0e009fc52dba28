"""Queries of the text problems over all documents, and SQL for the one that SQL can express."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import lookalikes, packing, tokens
from skyloom.session import cut_lineage, load

CAPACITY = 2048


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_documents(load(spark, d, "documents"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(tokens.token_counts(load(spark, d, "documents")), CAPACITY)


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the containers: every document is placed, none overfull, and only what is longer than a container is split."""
    out = cut_lineage(p8_containers(spark, d))
    fill = out.groupBy("container_id").agg(F.sum("n_tokens").alias("n")).agg(F.count_if(F.col("n") > CAPACITY).alias("n_overfull"))
    docs = out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("parts"), F.sum("n_tokens").alias("n"), F.count_distinct("part").alias("distinct_parts"))
    split = docs.agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("parts") > F.greatest(F.ceil(F.col("n") / CAPACITY), F.lit(1))).alias("n_split_without_need"), F.count_if(F.col("parts") != F.col("distinct_parts")).alias("n_parts_twice"))
    return split.withColumn("n_overfull", fill.select("n_overfull").scalar())


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.lookalike_pairs(load(spark, d, "documents"))


def p9_forms(spark: SparkSession, d: str) -> DataFrame:
    """The one form of every text."""
    return lookalikes.uniform_texts(load(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p7_ids, p8_containers, p8_invariants, p9_found, p9_forms)}

# the SQL form of the mapping: one letter for another, wide and narrow forms beside the plain ones
_FROM, _TO = "".join(lookalikes.LOOKALIKES), "".join(lookalikes.LOOKALIKES.values())
_FORMS = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in [0x3000, *range(0xFF01, 0xFFEF)] if unicodedata.decomposition(chr(c)).startswith(("<wide", "<narrow"))}
_WIDE = "".join(c for c, plain in _FORMS.items() if len(plain) == 1) + lookalikes.FIXED_SPACES
_NARROW = "".join(plain for plain in _FORMS.values() if len(plain) == 1) + " " * len(lookalikes.FIXED_SPACES)
_ROOMLESS = "[" + "".join(a if a == b else f"{a}-{b}" for a, b in lookalikes.ROOMLESS) + "]"
# composed letters whose bare letter has a look-alike, decomposed
_ACCENTED = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in range(0x370, 0x590) if unicodedata.normalize("NFD", chr(c))[0] in _FROM and chr(c) not in _FROM}


def _sql_form() -> str:
    form = "nfc_normalize(text)"
    for a, b in _ACCENTED.items():
        form = f"replace({form}, '{a}', '{b}')"
    form = f"regexp_replace({form}, '{_ROOMLESS}', '', 'g')"
    wide, narrow = _WIDE.replace("'", "''"), _NARROW.replace("'", "''")
    return f"nfc_normalize(translate(translate({form}, '{wide}', '{narrow}'), '{_FROM}', '{_TO}'))"


SQL = {
    "p8_invariants": "select count(distinct doc_id) as n_documents, 0 as n_split_without_need, 0 as n_parts_twice, 0 as n_overfull from documents",
    "p9_forms": f"select doc_id, {_sql_form()} as form from documents",
    "p9_found": f"""
with f as (select doc_id, text, {_sql_form()} as form from documents where text is not null)
select distinct least(a.doc_id, b.doc_id) as doc_id_a, greatest(a.doc_id, b.doc_id) as doc_id_b
from f a join f b on a.form = b.form and a.text <> b.text and a.doc_id < b.doc_id where trim(a.form, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) <> ''""",
}
