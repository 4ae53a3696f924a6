import duckdb
import pytest
from pyspark.sql import functions as F

from itemforge.functions import items as I
from itemforge.functions import repairs as P
from itemforge.operators import aggregates as A
from itemforge.operators import catalogue as C
from itemforge.operators import joins as J
from itemforge.operators import merge as M
from itemforge.operators import normalise as N
from itemforge.operators import rules as R
from itemforge.operators import scoring as S
from itemforge.operators import windows as W
from itemforge.operators import vectors as V
from itemforge.plans import ORACLES, QUERIES


def values(spark, column, *texts):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(column).collect()]


def test_canonical_numbers_reset_sub_items_that_go_back(spark):
    labels = [(1, None), (2, None), (2, None), (3, 1), (1, None)], [(5, None), (2, 1), (7, 1)], [(0, None)], []
    rows = spark.createDataFrame([(list(x),) for x in labels], "l array<struct<raw:int,sub:int>>")
    found = [[(x["main"], x["sub"], x["reset"]) for x in r[0]] for r in rows.select(I.canonical(F.col("l"))).collect()]
    assert found == [[(1, None, False), (2, None, False), (3, None, True), (3, 1, False), (4, None, True)], [(5, None, False), (5, 1, True), (7, 1, False)], [(0, None, False)], []]


def test_lint_leaves_formulas_out(spark):
    assert values(spark, I.ocr_flags(F.col("t")), "a $((($ b", "a ((( b", "$x$ palaIvra", None) == [[], ["parens"], ["capital_i"], []]


def test_rules_count_repeated_rows_once(spark, tmp_path):
    docs = spark.createDataFrame([(k, "same text of some length, more than thirty letters", "en", "web", 5) for k in (1, 1, 2, 2, 3, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["rule_engine"](spark, str(tmp_path)).collect()
    assert len(rows) == 6 and {r["errors"] for r in rows} == {"V22-duplicate"}


def test_except_removes_every_copy(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(1,)], "k int")
    assert [r[0] for r in a.subtract(b).collect()] == [2]


def test_gaps_of_far_numbers_are_laid_out_in_blocks(spark):
    rows = spark.createDataFrame([(1, 3), (1, 1), (1, 50_001), (2, 0), (2, -5), (3, 2), (3, 2)], "g int, n int")
    found = W.gaps(rows, "g", "n")
    assert found.filter("g = 1").agg(F.count("*"), F.min("missing"), F.max("missing")).first()[:] == (49_998, 2, 50_000)
    assert [r[0] for r in found.filter("g > 1").select("missing").collect()] == [1]


def test_nearest_across_stretches_matches_brute_force(spark):
    import random

    rng = random.Random(4)
    left = [(k, rng.randrange(4), rng.randrange(0, 200) / 2) for k in range(300)]
    right = [(k, rng.randrange(3), rng.choice((rng.randrange(0, 20), rng.randrange(150, 200))) / 2) for k in range(80)]
    found = J.nearest_in_order(spark.createDataFrame(left, "l long, g int, at double"), spark.createDataFrame(right, "r long, g int, at double"), "g", "at", "l", "r", width=3.0)
    wanted = {k: min(((abs(at - b), r) for r, h, b in right if h == g), default=(None, None)) for k, g, at in left}
    assert {r["l"]: (r["distance"], r["r"]) for r in found.collect()} == wanted


def test_numbering_by_stretches(spark):
    rows = spark.createDataFrame([(g, k * 7 % 101) for g in range(3) for k in range(50)], "g int, n int")
    found = J.numbered(rows, "g", "n", 10).orderBy("g", "n").collect()
    assert [r["k"] for r in found] == list(range(1, 51)) * 3


def test_first_keys_of_a_large_group(spark):
    rows = spark.createDataFrame([(1, k % 500) for k in range(3000)] + [(2, 9)], "g int, k int")
    assert sorted(map(tuple, A.first_keys(rows, ["g"], "k", "firsts").collect())) == [(1, 3000, "0,1,2"), (2, 1, "9")]


BLANK = {"id_item": "1", "tipo_item": "open_response", "numero_questao": 1, "numero_principal": 1, "subitem": None, "enunciado": "Um enunciado que tem mais de trinta letras ao todo", "texto_original": "x", "alternativas": [], "imagens": [], "imagens_contexto": [], "ficheiros": [], "contexto_pai": None, "span": (1, 2), "trace": None, "tema": "t", "subtema": "s", "descricao_breve": "d", "tags": ["#a"], "reviewed": True, "fonte": "f", "observacoes": [], "palavras_min": None, "palavras_max": None, "tem_numeracao_linhas": None, "linhas_verificadas": None, "portugues": False}
ITEM = "id_item string, tipo_item string, numero_questao int, numero_principal int, subitem string, enunciado string, texto_original string, alternativas array<struct<letra:string,texto:string>>, imagens array<string>, imagens_contexto array<string>, ficheiros array<string>, contexto_pai string, span struct<line_start:int,line_end:int>, trace struct<reset:boolean,implicit:boolean,score:int>, tema string, subtema string, descricao_breve string, tags array<string>, reviewed boolean, fonte string, observacoes array<string>, palavras_min int, palavras_max int, tem_numeracao_linhas boolean, linhas_verificadas boolean, portugues boolean"
ABCD = [("A", "um"), ("B", "dois"), ("C", "tres"), ("D", "quatro")]


@pytest.mark.parametrize(("changes", "errors", "warnings"), [
    ({}, [], []), ({"id_item": None}, ["V5-missing"], []), ({"id_item": "II-A-2.1", "subitem": "1"}, [], []), ({"id_item": "2.1", "subitem": "1"}, ["V5-principal", "V5-number"], []), ({"id_item": "I-ctx1", "tipo_item": "context_stem", "enunciado": None, "span": None}, [], []),
    ({"tipo_item": "multiple_choice", "alternativas": ABCD}, [], []), ({"tipo_item": "multiple_choice", "alternativas": ABCD[:3]}, ["V1-count"], []), ({"tipo_item": "completion", "alternativas": ABCD}, ["V4-type"], []),
    ({"tipo_item": "multiple_choice", "alternativas": [("A", "$e$"), ("B", "7"), ("C", "x"), ("D", None)]}, ["V3-empty", "V3-short"], []), ({"span": (5, 4)}, ["V6-span"], []), ({"enunciado": "Veja a Figura 2 e diga o que nela se mostra, por favor"}, ["V10-figure"], []),
    ({"enunciado": "Veja a Figura 2 ![f](a.png) e diga o que nela se mostra"}, [], []), ({"enunciado": r"Seja $x$ e \frac{1}{2} o valor pedido neste enunciado"}, [], ["V14-latex"]), ({"enunciado": r"Custa \$5 e $x neste enunciado que ainda tem mais letras"}, ["V15-dollars"], ["V14-latex"]),
    ({"observacoes": ["a", "b", "c", "d", "Fornecedor 'x' sem credenciais; y"]}, [], ["V24-notes"]), ({"observacoes": ["a", "b", "c", "Fornecedor 'x' sem credenciais; y"]}, [], []), ({"tema": "Por Categorizar", "tags": None, "reviewed": None}, ["V17-unreviewed"], ["V17-theme", "V17-tags"]),
    ({"tipo_item": "context_stem", "portugues": True, "tem_numeracao_linhas": False, "linhas_verificadas": True, "enunciado": "uma palavra5outra"}, ["VCTX-left-over"], []), ({"tipo_item": "context_stem", "portugues": True}, ["VCTX-undeclared", "VCTX-unchecked"], []),
    ({"trace": (True, True, 2)}, ["V9-boundary-low"], ["V9-reset"]), ({"trace": (False, True, None)}, [], ["V9-boundary"]), ({"imagens": ["a.png"]}, ["V8-image"], []),
])
def test_item_rules(spark, changes, errors, warnings):
    row = spark.createDataFrame([tuple((BLANK | changes).values())], ITEM)
    found = R.judged(row, C.item_rules()).first()
    assert (found["errors"], found["warnings"]) == (errors, warnings)
    assert found["status"] == ("validation_error" if errors else "approved_with_warnings" if warnings else "approved")


def test_merge_keys(spark):
    items = [("I-A-1", 1, "essay"), ("II-3", 3, "essay"), ("I-3", 3, "essay"), (None, 3, "essay"), ("II-B-4", 4, "essay"), ("c", 0, "context_stem"), ("I-9", 9, "multi_select")]
    criteria = [("I-1", "essay", "first", 1), ("i-1 ", "essay", "last", 2), ("3", "essay", "three", 3), ("II-4", "essay", "## 7. 10 pontos", 4), ("I-9", "essay", "x", 5)]
    rows = spark.createDataFrame([(*i, None, []) for i in items], "id_item string, numero_questao int, tipo_item string, resposta_correta string, respostas_corretas array<string>")
    known = spark.createDataFrame([(k, t, None, [], s, n) for k, t, s, n in criteria], "id_item string, tipo string, resposta_correta string, respostas_corretas array<string>, solucao string, at int")
    found = {r["id_item"]: (r["merge"], r["solucao"]) for r in M.merged(rows, known, "at").collect()}
    assert found == {"I-A-1": ("merged", "last"), "II-3": ("merged", "three"), "I-3": ("missing", None), None: ("merged", "three"), "II-B-4": ("foreign", None), "c": ("stem", None), "I-9": ("type", None)}


def test_context_resolution(spark):
    rows = spark.createDataFrame([(1, ["b", "a"], "", "1", None, ""), (2, ["a"], "z", "1", None, ""), (3, [], "", "I-2.1", None, ""), (4, [], "", "9", 7, "II"), (5, [], "", "9", 8, "II"), (6, ["a", "missing"], "", "x", None, "")], "k int, p array<string>, one string, id string, main int, g string")
    known = spark.createDataFrame([("a+b", 10), ("a", 11), ("I-2", 12), ("7", 13), ("II-ctx", 14)], "key string, ctx int")
    keys = M.context_keys(F.col("p"), F.col("one"), F.col("id"), F.col("main"), F.col("g"))
    assert {r["k"]: r["ctx"] for r in M.ranked_lookup(rows, "k", keys, known, "key", "ctx").collect()} == {1: 10, 2: 11, 3: 12, 4: 13, 5: 14, 6: None}


def test_scoring_layouts(spark):
    text = "\n".join(["GRUPO I", "1. a 3. ... 3 × 5 pontos", "4.1. 10 pontos", "", "PARTE B", "# 5. 8 pontos", "GRUPO II", "| 1. | 2. |", "", "| --- | --- |", "| 7 | 9 |", "Destes 2 itens, contribuem para a classificação final os 1 itens", "1. a 2. nada aqui"])
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "só texto")], "doc_id int, text string")
    found = S.scores(docs)
    assert {r["item_id"]: r["points"] for r in found.collect()} == {"I-1": 5, "I-2": 5, "I-3": 5, "I-4.1": 10, "I-B-5": 8, "II-1": 0, "II-2": 0}
    assert [(r["grupo"], r["escolher"], r["itens"]) for r in S.pools(docs, found).collect()] == [("II", 1, ["II-1", "II-2"])]


def test_parts_are_promoted_in_order_only(spark):
    text = "A\n# GRUPO I\nC\nA\nA\n**B**\nB\nC\n# GRUPO II\n## A\nA\nB"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    once = N.normalised(docs)
    wanted = "A\n# GRUPO I\nC\n## A\nA\n## B\nB\n## C\n# GRUPO II\n## A\nA\n## B"
    assert once.first()["text"] == wanted and N.normalised(once).first()["text"] == wanted


def test_stray_ones_and_broken_tens(spark):
    stray = "1 um\na\n5 cinco\n1 fica\nb"
    far = "1 um" + "\nx" * 8 + "\n5 cinco"
    tens = "5 a\n0 b\n15 c\n0 d\n25 e\n0 f"
    docs = spark.createDataFrame([(1, stray), (2, far), (3, tens)], "doc_id int, text string")
    assert {r["doc_id"]: r["text"] for r in N.normalised(docs).collect()} == {1: "um\na\n5 cinco\n1 fica\nb", 2: far, 3: "5 a\n10 b\n15 c\n20 d\n25 e\n30 f"}


def test_prefixes_and_latex(spark):
    fixed, log = P.without_prefix(F.col("t"))
    texts = [r"$\pm 6 . 1 .$ Qual", r"$\pm 8.$ 8. Em", r"$\ast$ 3. Numa", "10.2. Estude", "8.Em", "1Na Figura", " nada"]
    assert values(spark, fixed, *texts) == ["Qual", "Em", "Numa", "Estude", "Em", "Na Figura", "nada"]
    assert values(spark, log, *texts)[1] == ["fused_item", "item"]
    assert values(spark, P.delimited(F.col("t")), r"\frac{1}{2}", r"$a$ \frac{1}{2}", "abc") == [r"$\frac{1}{2}$", r"$a$ \frac{1}{2}", "abc"]
    assert values(spark, P.compact_latex(F.col("t")), r"\frac { 1 2 } { 3 } x ^ { 2 }", r"\mathrm{ s e n } x") == [r"\frac{12}{3} x^{2}", r"\sin x"]


def test_mirroring_twice_changes_nothing(spark):
    rows = spark.createDataFrame([("complete_table", " a) 3 ", [(None, "x", None), (2, "y", None)], 9), ("complete_table", "a", [], 9), ("essay", "a", [(1, "b", None)], 9), ("complete_table", " ", [(1, "b", None)], 9)], "tipo string, s string, p array<struct<pontos:int,descricao:string,nivel:string>>, c int")
    mirror = C.mirrored(F.col("tipo"), F.col("s"), F.col("p"), F.col("c"))
    once = rows.withColumn("p", mirror)
    shown = lambda df: [[(x["pontos"], x["descricao"]) for x in r["p"]] for r in df.collect()]
    assert shown(once) == [[(9, "a) 3"), (2, "y")], [(9, "a")], [(1, "b")], [(1, "b")]]
    assert shown(once.withColumn("p", mirror)) == shown(once)


def test_a_query_that_asks_every_hundredth_vector_matches_sql(spark, sf_dir):
    rows = QUERIES["vector_search"](spark, sf_dir).collect()
    con = duckdb.connect()
    n = con.sql(f"SELECT count(*) FILTER (vec_id % 100 = 0) FROM '{sf_dir}/embeddings.parquet'").fetchall()[0][0]
    assert len(rows) == 20 * n


def test_search_puts_vectors_that_are_missing_last_and_makes_no_pairs_of_rows(spark, tmp_path):
    rows = [(k, None if k % 40 == 3 else [float(k % 7 - 3), 1.0 + k % 3, float(k % 5)]) for k in range(330)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = QUERIES["vector_search"](spark, str(tmp_path))
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(map(tuple, found.collect())) == sorted(con.sql(ORACLES["vector_search"]).fetchall())


def test_search_among_few_vectors_ranks_the_missing_by_id(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, None), (2, [0.0, 1.0]), (3, None)], "vec_id long, embedding array<float>")
    found = V.nearest(rows, rows.selectExpr("vec_id AS asked", "embedding AS q").filter("asked < 2"), 3).collect()
    assert sorted((r.asked, r.vec_id, r.distance) for r in found if r.asked == 0) == [(0, 0, 0.0), (0, 1, None), (0, 2, 1.0)]
    assert sorted(r.vec_id for r in found if r.asked == 1) == [0, 1, 2]
