from pyspark.sql import functions as F

from itemforge.functions import items as I
from itemforge.functions import text as T
from itemforge.operators import joins as J
from itemforge.operators import windows as W
from itemforge.operators.segment import segments

EXAM = """preamble
GRUPO I
PARTE A
1. Leia o texto. ![f](a.png)
1.1. Identifique as três afirmações.
1.2. Explique.
2. Qual das opções? (A) um (B) dois (C) três (D) quatro
GRUPO II
* 3. Redija um texto.
3. Outra pergunta.
PARTE B
tail"""


def values(spark, column, *texts):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(column).collect()]


def test_segments_of_an_exam(spark):
    docs = spark.createDataFrame([(1, EXAM), (2, "no heading\nat all"), (3, None), (4, "")], "doc_id long, text string")
    rows = segments(docs).orderBy("doc_id", "ordem").collect()
    assert [r["item_id"] for r in rows] == ["I-A-1", "I-A-1.1", "I-A-1.2", "I-A-2", "II-1", "II-2", "1"]
    assert [r["tipo"] for r in rows[:6]] == ["context_stem", "multi_select", "open_response", "multiple_choice", "essay", "open_response"]
    assert [(r["line_start"], r["line_end"]) for r in rows] == [(4, 4), (5, 5), (6, 6), (7, 7), (9, 9), (10, 10), (1, 2)]
    assert [r["suspected_reset"] for r in rows] == [False, False, False, False, False, True, False]
    assert rows[0]["images"] == ["a.png"] and rows[4]["optional"] and not rows[0]["optional"]


def test_source_labels(spark):
    good = ["Exame Nacional, Português, 1.ª Fase, 2024", "Exame Nacional, Matemática A, Época Especial, 2014"]
    bad = ["Exame Nacional, Matematica A, 1.ª Fase, 2014", "Exame Nacional, Português, 3.ª Fase, 2024", "Exame Nacional, Português, 1.ª Fase, 1999", "Exame Nacional, Português, 1.ª Fase, 2024, extra", "", None]
    found = values(spark, T.source_label(F.col("t")), *good, *bad)
    assert [f and f["ano"] for f in found] == [2024, 2014, *[None] * len(bad)]


def test_slug_tags_and_numbers(spark):
    assert values(spark, T.slug(F.col("t")), "Transformações de Funções", " --a ", "") == ["transformacoes-de-funcoes", "a", ""]
    assert values(spark, T.item_number(F.col("t")), "2.1", "II-12.3", "x") == [2, 12, None]
    assert values(spark, T.odd_dollars(F.col("t")), "$a", "$a$", r"\$a", "") == [True, False, False, False]
    assert values(spark, F.map_entries(I.key_letters(F.col("t"))), "1. Opção (A) 1. Opção (B)")[0][0]["value"] == "B"


def test_renumbering(spark):
    rows = spark.createDataFrame([([1, 2, 2, 3, 1],)], "n array<int>").select(W.renumbered(F.col("n")).alias("r")).first()["r"]
    assert [(x["n"], x["reset"]) for x in rows] == [(1, False), (2, False), (3, True), (4, True), (5, True)]


def test_upsert_is_idempotent_and_keeps_unsent_columns(spark):
    base = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, w int")
    patch = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    once = J.upsert(base, patch, ["k"])
    wanted = [(1, "a", 10), (2, None, 20), (3, "c", None)]
    assert sorted(map(tuple, once.collect())) == wanted
    assert sorted(map(tuple, J.upsert(once, patch, ["k"]).collect())) == wanted


def test_empty_overlay_changes_nothing(spark):
    base = spark.createDataFrame([(1, 1.0)], "k int, view double")
    none = spark.createDataFrame([], "k int, field string, value double, ts timestamp, seq long")
    assert [tuple(r) for r in J.overlay_apply(base, none, "k", ["view"]).collect()] == [(1, 1.0)]


def test_nearest_prefers_the_smaller_key_on_ties(spark):
    left = spark.createDataFrame([(1, 0, 5.0), (2, 0, 1.0), (3, 9, 1.0)], "l int, g int, at double")
    right = spark.createDataFrame([(7, 0, 4.0), (5, 0, 6.0), (6, 0, 1.0)], "r int, g int, at double")
    assert sorted(map(tuple, J.nearest_in_order(left, right, "g", "at", "l", "r").collect())) == [(1, 5, 1.0), (2, 6, 0.0), (3, None, None)]
