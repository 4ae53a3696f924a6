"""Numbers, brackets and places in recognised texts: literal cases and plain versions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from itemforge.functions import items as I
from itemforge.functions import repairs as P
from itemforge.operators import markers as K
from itemforge.operators import normalise as N
from itemforge.operators import scoring as S
from itemforge.streaming import overlays


def values(spark, column, *texts):
    return [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "k int, t string").orderBy("k").select(column).collect()]


def by_key(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def texts(spark, *some):
    return spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")


def test_brackets(spark):
    got = values(spark, P.mended_brackets(F.col("t")), ", , 0 3 6 ^ h", "f(50 ^ h) e , , 1 2 ^ h.", "5 0 ^ h", "3 ^ hoje", "a, b ^ h", None)
    assert got == ["(0, 3, 6)", "f((50)) e (1, 2).", "(50)", "3 ^ hoje", "a, b ^ h", None]


def test_compact_latex_takes_any_content(spark):
    got = values(
        spark, P.compact_latex(F.col("t")), r"\frac { a + b } { 2 } x ^ { n + 1 } \bigl (", r"\frac{ 1 2 }{ 3 } y _ { 1 0 }", r"\mathrm { s e n } x", r"\sinx + \ln2", r"^ 5 C _ { 2 }", r"{ \left\{ \begin{array} { l l } x", r"a  { } b", r"\times { } 2 { } ^ 3"
    )
    assert got == [r"\frac{a + b}{2} x^{n + 1} \bigl(", r"\frac{12}{3} y_{10}", r"\sin x", r"\sin x + \ln 2", r"^{5} C_{2}", r"\left\{\begin{array}{ll} x", "a b", r"\times 2 ^ 3"]


def test_marked_numbers(spark):
    cases = {
        r"$\star \ 1 .$ Seja": "1. Seja", r"$\bigstar$ 5.1. x": "5.1. x", r"\*2.2. y": "2.2. y", r"$\big \langle \star$ 4.1. z": "4.1. z", "5.Um dia": "5. Um dia", "3.2.Considere": "3.2. Considere", "4 Sendo": "4. Sendo", "4 sendo": "4 sendo",
        # 42 is 4.2 where there is 4.1, and 12 stays where there is no 1.1.
        "4. a\n4.1. b\n42. c\n43. d\n12. e": "4. a\n4.1. b\n4.2. c\n4.3. d\n12. e", "4.1. b\n4.2. c\n43. d": "4.1. b\n4.2. c\n4.3. d",
        "\\* Seja f\ntexto\n2. g": "\\* 1. Seja f\ntexto\n2. g", "\\* Seja f\n1. g": "\\* Seja f\n1. g", "\\* Seja f": "\\* Seja f", "\\* a\n\\* b\n\\* 4. c": "\\* 3. a\n\\* 3. b\n\\* 4. c",
    }
    assert by_key(K.marked(texts(spark, *cases))) == dict(enumerate(cases.values()))


def plain_prose(text):
    """A plain version: one pass over a preamble's numbers."""
    expected, out, pos = None, [], 0
    for m in re.finditer(N.IN_PROSE, text):
        v = int(m[1])
        if v % 5 or not 5 <= v <= 95:
            continue
        start = text[text.rfind("\n", 0, m.start()) + 1 : m.start()].strip() == ""
        if expected is None:
            expected = v + 5 if start else None
        elif v == expected:
            expected = v + 5
            if not start:
                out += [text[pos : m.start()], "\n", m[1]]
                pos = m.end()
    return "".join([*out, text[pos:]])


def test_numbers_in_prose_equal_a_plain_version(spark):
    rng = random.Random(3)
    words = ["e", "casa", "5", "10", "15", "20", "25", "7", "«ai", "100", "05", "fim.", "\n", "\n\n", "\n5", "\n10 ", "3"]
    some = ["\n" + " ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(400)]
    lines = spark.createDataFrame([(k, n, line) for k, t in enumerate(some) for n, line in enumerate(t.split("\n"))], "doc_id long, pos int, line string")
    got = by_key(N.joined(N.prose_numbers(lines, "doc_id"), "doc_id"))
    assert [got[k] for k in range(len(some))] == [plain_prose(t) for t in some]
    assert any(got[k] != t for k, t in enumerate(some))


def test_preambles(spark):
    exam = "antes\n# GRUPO I\n5. Era uma vez\ntexto e 10 outra linha\n15. mais um\n0 vinte depois\n1. Seja\n5. item\nfim. 5 Verso um. 10 Verso dois."
    got = by_key(N.preamble_numbers(texts(spark, exam, "sem grupo\n5. a\n10. b", None)))
    assert got == {0: "antes\n# GRUPO I\n5 Era uma vez\ntexto e \n10 outra linha\n15 mais um\n20 vinte depois\n1. Seja\n5. item\nfim.\n5 Verso um.\n10 Verso dois.", 1: "sem grupo\n5. a\n10. b"}


def test_places_are_told_one_by_one(spark):
    text = r"c0mo l0go \frac{1} x^ab e a Isto. Ilha IVA, \sqrt2 $x"
    got = [tuple(e) for e in values(spark, I.ocr_entries(F.col("t")), text)[0]]
    assert got == [
        ("latex_dollar_impar", r"A, \sqrt2 $x"), ("latex_frac_sem_denom", r"l0go \frac{1} x^ab e a Is"), ("latex_sqrt_sem_chaves", r"A, \sqrt2 $x"), ("ocr_i_maiusculo", "Isto"),
        ("ocr_zero_em_palavra", "c0mo"), ("ocr_zero_em_palavra", "o l0go"), ("latex_exp_sem_chaves", "^ab"),
    ]
    assert values(spark, I.ocr_entries(F.col("t")), "((( a", "$$x$$", " ", None) == [[("parens_imbalanced", "(3 abertos, 0 fechados)")], [], [], []]


def test_expected_criteria_are_looked_for_outside_blocks(spark):
    text = "Introdução\n2.1. Determina o valor\ncom 5 pontos\n\n4. Outra coisa\n3. 10 pontos\ncorpo\n2.2. Dentro do bloco\n5. 5 pontos\nfim"
    docs = texts(spark, text, "6. Sem blocos\nx")
    blocks = S.criteria_blocks(docs)
    expected = spark.createDataFrame([(0, "II-2.1", 15), (0, "2.2", 7), (0, "3", 10), (0, "9", 1), (1, "6", 8), (1, "7", 9)], "doc_id long, item_id string, points int")
    got = S.expected_blocks(docs, blocks, expected)
    assert sorted((r["doc_id"], r["item_id"], r["points"], r["line_start"], r["body"], r["inline"]) for r in got.collect()) == [
        (0, "2.1", 15, 2, "2.1. Determina o valor\ncom 5 pontos", True), (0, "3", 10, 6, "corpo\n2.2. Dentro do bloco", False), (0, "5", 5, 9, "fim", False), (1, "6", 8, 1, "6. Sem blocos\nx", True),
    ]


def test_covered_equals_a_plain_version(spark):
    rng = random.Random(1)
    spans = [(rng.choice("ab"), s := rng.randrange(200), s + rng.randrange(9)) for _ in range(40)]
    points = [(k, rng.choice("abc"), rng.randrange(220)) for k in range(300)]
    got = S.covered(spark.createDataFrame(points, "_row long, g string, at int"), spark.createDataFrame(spans, "g string, s int, e int"), "g", "at", "s", "e")
    assert sorted((r["g"], r["at"], r["covered"]) for r in got.collect()) == sorted((g, p, any(h == g and s <= p <= e for h, s, e in spans)) for _, g, p in points)


@pytest.mark.parametrize("times", [1, 2])
def test_a_stream_that_runs_again_under_its_checkpoint_changes_nothing(spark, tmp_path, times):
    source = tmp_path / "events"
    spark.createDataFrame([(1, 10, "a"), (1, 11, "b"), (2, 5, None)], "k int, at int, v string").coalesce(1).write.parquet(str(source))
    for _ in range(times):
        stream = spark.readStream.schema("k int, at int, v string").parquet(str(source))
        found = overlays.run_upserts(stream, ["k"], "at", f"file://{tmp_path}/t", f"file://{tmp_path}/c")
    assert sorted(map(tuple, found.collect()), key=repr) == [(1, "b"), (2, None)]
    assert len(list((tmp_path / "t").glob("v-*"))) == 1
