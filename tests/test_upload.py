import datetime

import duckdb

from pyspark.sql import Window
from pyspark.sql import functions as F

from itemforge.operators import catalogue as C
from itemforge.operators import layout as L
from itemforge.operators import merge as M
from itemforge.operators import upload as U
from itemforge.plans import ORACLES, QUERIES

LABEL = "Exame Nacional, Português, 1.ª Fase, 2024"
ITEM = "ws string, ordem int, tipo_item string, id_item string, grupo string, fonte string, materia string, tema string, subtema string, enunciado string, ids_contexto_pai array<string>, id_contexto_pai string, numero_principal int, observacoes array<string>"


def items(spark, *rows):
    return spark.createDataFrame([("w", n, kind, id_item, "I", LABEL, "Português", theme, sub, "texto", parents, None, None, notes) for n, (kind, id_item, theme, sub, parents, notes) in enumerate(rows)], ITEM)


def empty_bank(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    kinds = {**U.LISTS, **U.OTHERS, **dict.fromkeys((*U.TEXTS, *U.REFERENCES), "string")}
    question = ", ".join(f"{c} {kinds[c]}" for c in U.QUESTION)
    return {
        "fontes": empty("id string, fonte string"), "topicos": empty("id string, materia string, slug string, nome string, nivel int, pai_id string"),
        "contextos": empty(f"id string, fonte_id string, id_item_original string, texto string, imagens {U.LISTS['imagens']}, grupo string, pagina_origem int, notas_rodape {U.NOTE}"), "questoes": empty(f"{question}, created_at timestamp, updated_at timestamp"),
    }


def test_a_second_upload_changes_only_when_rows_were_updated(spark):
    rows = items(spark, ("context_stem", "I-1", "t", None, [], ['notas_rodape: [{"numero":"1","texto":"nota"}]']), ("context_stem", "I-2", "t", None, [], []), ("essay", "I-3", "Funções", "Derivadas", ["I-2", "I-1"], None), ("essay", "I-1.2", "Funções", "FUNÇÕES", [], None), ("essay", "I-4", "Derivadas", "", ["I-9"], None))
    first = U.uploaded(rows, empty_bank(spark), "ws", "ordem", F.lit("2024-01-01").cast("timestamp"))
    kept = {name: spark.createDataFrame(t.collect(), t.schema) for name, t in first.items()}
    second = U.uploaded(rows, kept, "ws", "ordem", F.lit("2024-02-01").cast("timestamp"))
    assert len(U.QUESTION) == 30 and kept["questoes"].columns == second["questoes"].columns
    for name in ("fontes", "topicos", "contextos"):
        assert sorted(map(str, second[name].collect())) == sorted(map(str, kept[name].collect()))
    assert sorted(map(str, second["questoes"].drop("updated_at").collect())) == sorted(map(str, kept["questoes"].drop("updated_at").collect()))
    assert {(r.created_at, r.updated_at) for r in second["questoes"].collect()} == {(datetime.datetime(2024, 1, 1), datetime.datetime(2024, 2, 1))}
    names = {r["id"]: r["id_item_original"] for r in kept["contextos"].collect()}
    topics = {r["id"]: (r["slug"], r["nivel"]) for r in kept["topicos"].collect()}
    assert {r["id_item"]: (names.get(r["contexto_id"]), topics[r["topico_id"]]) for r in kept["questoes"].collect()} == {
        "I-3": ("I-1+I-2", ("derivadas", 2)), "I-1.2": ("I-1", ("funcoes", 1)), "I-4": (None, ("derivadas", 2)),
    }
    both = kept["contextos"].filter("id_item_original = 'I-1+I-2'").first()
    assert both["texto"] == "**[I-1]**\n\ntexto\n\n---\n\n**[I-2]**\n\ntexto" and [n["texto"] for n in both["notas_rodape"]] == ["nota"]


def test_documents_with_faults_and_empty_tables_send_nothing(spark):
    bank = empty_bank(spark)
    bad = items(spark, ("essay", "I-3", "Por categorizar", None, [], None), ("essay", "I-4", "Tema", None, [], None))
    for rows in (bad, items(spark)):
        done = U.uploaded(rows, bank, "ws", "ordem")
        assert [t.count() for t in done.values()] == [0, 0, 0, 0]


def test_many_small_rows_are_dealt_to_tasks_by_their_number(spark):
    """Rows that compress well are few bytes, by which adaptive plans would put them all in one task."""
    one = items(spark, ("essay", "I-3", "Funções", "Derivadas", [], None)).drop("ws", "ordem")
    many = spark.range(3 * U.DEALT_ROWS).select(F.floor(F.col("id") / 40).cast("string").alias("ws"), F.col("id").cast("int").alias("ordem")).crossJoin(F.broadcast(one))
    known, sound = U.sound_rows(many, empty_bank(spark)["fontes"], "ws")
    sizes = [r["n"] for r in sound.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()]
    assert known.count() == 1 and sum(sizes) == 3 * U.DEALT_ROWS and max(sizes) < 2 * U.DEALT_ROWS
    assert [(r["slug"], r["nome"], r["nivel"]) for r in U.topics_named(sound, "ordem").orderBy("slug").collect()] == [("derivadas", "Derivadas", 2), ("funcoes", "Funções", 1)]


def test_sources_of_an_upload_are_read_not_worked_out_again(spark):
    done = U.uploaded(items(spark, ("essay", "I-3", "Funções", "Derivadas", [], None)), empty_bank(spark), "ws", "ordem")
    assert [r["fonte"] for r in done["fontes"].collect()] == [LABEL] and "Join" not in done["fontes"]._jdf.queryExecution().executedPlan().toString()


def test_footnotes_are_read_or_passed_over(spark):
    told = (["notas_rodape: [quebrado", 'notas_rodape: [{"numero":"2","texto":"b"}]'], ["notas_rodape: {}"], ["x"], [], None)
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(told)], "k int, o array<string>")
    found = {r["k"]: [(x["numero"], x["texto"]) for x in r["f"]] for r in rows.select("k", U.footnotes(F.col("o")).alias("f")).collect()}
    assert found == {0: [("2", "b")], 1: [], 2: [], 3: [], 4: []}


def test_solution_leads_the_first_step(spark):
    step = "p array<struct<pontos:bigint,descricao:string,nivel:string>>"
    cases = [("essay", " s ", [(1, "a s b", "")], 9, "x"), ("open_response", "s", [(1, "s a", "")], 9, "x"), ("essay", "s", [], 9, "pending_review"), ("essay", "s", None, None, "reviewed"), ("essay", " ", [], 9, "pending_review"), ("complete_table", "s", [(1, "a", "")], 9, "x"), ("essay", "s", [(1, None, ""), (2, "b", "")], 9, "x"), ("essay", "s+", [(1, "a", "")], 9, "x")]
    rows = spark.createDataFrame(cases, f"t string, s string, {step}, c int, status string")
    lead = C.led_by_solution(F.col("t"), F.col("s"), F.col("p"), F.col("c"))
    once = rows.withColumn("status", C.drafted(F.col("status"), F.col("t"), F.col("s"), F.col("p"))).withColumn("p", lead)
    shown = lambda df: [([(x["pontos"], x["descricao"]) for x in r["p"]], r["status"]) for r in df.collect()]
    assert shown(once) == [([(1, "s\n\na  b")], "x"), ([(1, "s a")], "x"), ([(9, "s")], "draft"), ([(0, "s")], "reviewed"), ([], "pending_review"), ([(1, "a")], "x"), ([(1, "s"), (2, "b")], "x"), ([(1, "s+\n\na")], "x")]
    assert shown(once.withColumn("p", lead)) == shown(once)


def test_images_near_a_block_match_slices(spark):
    import random
    import re

    rng = random.Random(6)
    text = "".join(rng.choice(("![](a.png)", "![x](b.png)", "![](é/𝄞.png)", "palavra ", "\n", "𝄞", "![quebrada](")) * rng.randrange(1, 9) for _ in range(1500))
    cuts = sorted(rng.sample(range(len(text)), 60))
    spans = [("w", n, a, b) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))] + [("w", 99, 0, len(text) + 50), ("v", 0, 0, 10), ("w", 100, None, 5)]
    found = L.nearby_images(spark.createDataFrame([("w", text), ("v", None)], "ws string, text string"), spark.createDataFrame(spans, "ws string, id_item int, first int, last int"))
    images = lambda t: re.findall(r"!\[[^\]]*\]\(([^)]+)\)", t)
    wanted = {(w, n): list(dict.fromkeys(images(text[a:b]) + images(text[max(0, a - 400) : a]) + images(text[b : b + 400]))) for w, n, a, b in spans if w == "w" and a is not None}
    assert {(r["ws"], r["id_item"]): r["imagens"] for r in found.collect()} == {**wanted, ("v", 0): [], ("w", 100): []}


def test_steps_of_another_item_block_a_merge(spark):
    step = "array<struct<pontos:int,descricao:string>>"
    rows = spark.createDataFrame([(i, 1, "multi_select", None, [], [], ["velha"]) for i in ("1", "2", "3")], f"id_item string, numero_questao int, tipo_item string, resposta_correta string, respostas_corretas array<string>, criterios_parciais {step}, resolucoes_alternativas array<string>")
    told = [("1", [(1, "Versão 1: a\nVersão 2: b"), (2, None)], ["x"]), ("2", [(1, "## 7. 10 pontos")], []), ("3", None, None)]
    criteria = spark.createDataFrame([(i, "multi_select", None, [], "s", p, o, 1) for i, p, o in told], f"id_item string, tipo string, resposta_correta string, respostas_corretas array<string>, solucao string, criterios_parciais {step}, resolucoes_alternativas array<string>, at int")
    found = {r["id_item"]: (r["merge"], r["criterios_parciais"] and [s["descricao"] for s in r["criterios_parciais"]], r["resolucoes_alternativas"]) for r in M.merged(rows, criteria, "at").collect()}
    assert found == {"1": ("merged", ["a", ""], ["x"]), "2": ("foreign", [], ["velha"]), "3": ("merged", None, None)}


def test_values_of_documents_that_should_share_one(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("a", "x", 3), ("b", "x", 4), ("c", None, 5), ("c", "", 6)], "ws string, fonte string, id_item int")
    assert {tuple(r) for r in U.source_values(rows, "ws").collect()} == {("a", "x", 2, "1,3"), ("a", "", 1, "2")}
    lists = spark.createDataFrame([(["a", "b"], ["b"]), (["a"], ["a", "c"]), (["a"], []), ([], [])], "h array<string>, q array<string>")
    assert [r[0] for r in lists.select(U.contains_all(F.col("h"), F.col("q"))).collect()] == [True, False, True, True]


def repeated_parts(spark, sf_dir, tmp_path, times):
    """The table of parts so often that several documents share a source (six hundred sources), under keys that go on."""
    one = spark.read.parquet(f"{sf_dir}/part.parquet").limit(40).select("p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    docs = [d + 600 * r for d in range(12) for r in range(times)]
    numbered = one.withColumn("n", F.row_number().over(Window.orderBy("p_name", "p_type", "p_retailprice")) - 1)
    numbered.withColumn("ws", F.explode(F.array(*map(F.lit, docs)))).withColumn("p_partkey", (F.col("ws") * 40 + F.col("n")).cast("long")).drop("ws", "n").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def same_as_sql(spark, folder, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW part AS SELECT * FROM '{folder}/part.parquet/*.parquet'")
    found = QUERIES[name](spark, folder)
    wanted = con.sql(f"SELECT {', '.join(f'"{c}"' for c in found.columns)} FROM ({ORACLES[name]})").fetchall()
    return sorted(map(repr, map(tuple, found.collect()))), sorted(map(repr, wanted))


def test_contexts_of_several_documents_of_one_source_match_sql(spark, sf_dir, tmp_path):
    found, wanted = same_as_sql(spark, repeated_parts(spark, sf_dir, tmp_path, 3), "bank_contexts")
    assert len(found) > 12 * 3 * 5 and found == wanted


def test_items_of_a_source_with_several_ids_are_one_row(spark):
    rows = items(spark, ("context_stem", "I-1", "t", None, [], None), ("essay", "I-2", "Funções", "Derivadas", [], None))
    held = spark.createDataFrame([("f2", LABEL), ("f1", LABEL), ("f3", LABEL)], "id string, fonte string")
    known, sound = U.sound_rows(rows, held, "ws")
    assert sorted(r["id"] for r in known.collect()) == ["f1", "f2", "f3"]
    assert sorted((r["fonte_id"], r["id_item"]) for r in sound.collect()) == [("f1", "I-1"), ("f1", "I-2")]


def test_questions_of_a_source_with_several_ids_are_sent_once(spark, sf_dir, tmp_path):
    sent = QUERIES["bank_questions"](spark, repeated_parts(spark, sf_dir, tmp_path, 3)).filter("updated = 2024")
    assert sent.count() > 12 * 30 and sent.groupBy("fonte", "grupo", "id_item").count().filter("count > 1").isEmpty()
