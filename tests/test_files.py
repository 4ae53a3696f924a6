import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from itemforge.sources import files


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return f"file://{path}"


def test_questions_get_their_defaults(spark, tmp_path):
    path = put(tmp_path / "q.json", [{"id_item": "II-12.1", "observacoes": ["[review-pending] x"]}, {"id_item": "x", "reviewed": False, "id_contexto_pai": " a "}, {"numero_questao": 3, "ids_contexto_pai": [" b ", ""], "alternativas": [{"letra": "A", "texto": "um"}]}])
    rows = files.questions(spark, path).orderBy("numero_questao").collect()
    assert [(r["numero_questao"], r["reviewed"], r["ids_contexto_pai"], r["id_contexto_pai"], r["tags"]) for r in rows] == [(0, False, ["a"], "a", []), (3, True, ["b"], "b", []), (12, False, [], "", [])]
    assert rows[1]["alternativas"][0]["texto"] == "um" and rows[1]["enunciado"] == ""


def test_criteria_need_an_id_and_a_total(spark, tmp_path):
    good = put(tmp_path / "good.json", [{"id_item": "1", "cotacao_total": 10, "tipo": "essay"}])
    bad = put(tmp_path / "bad.json", [{"id_item": "1", "cotacao_total": 10}, {"id_item": "2"}])
    assert files.criteria(spark, good).count() == 1
    with pytest.raises(PySparkException, match="cotacao_total"):
        files.criteria(spark, bad).collect()


@pytest.mark.parametrize(("value", "fault"), [
    ({"cotacoes": {"I-1": 12.5, "I-2": "13.5"}, "estrutura": {"I-1": []}}, None), ([1], "no object"), ({"I-1": 13, "I-2": 5}, "flat map"), ({"I-1": {"tipo": "", "pontos": None}}, "stub"), ({"x": "y"}, "no cotacoes"),
    ({"cotacoes": {}, "confianca": "boa"}, "confianca"), ({"cotacoes": {}, "bypass_validation": True, "bypass_motivo": " "}, "bypass without reason"), ({"cotacoes": {}, "bypass_validation": True, "bypass_motivo": "x"}, None),
])
def test_manifests(spark, tmp_path, value, fault):
    path = put(tmp_path / "m.json", value)
    row = files.manifests(spark, path).first()
    assert row["fault"] == fault
    if "cotacoes" in value and value["cotacoes"]:
        assert row["cotacoes"] == {"I-1": 12, "I-2": 14}
    if fault:
        with pytest.raises(PySparkException, match=fault):
            files.canonical_manifests(spark, path).collect()


def test_traces_keep_the_last_good_record(spark, tmp_path):
    path = put(tmp_path / "t.json", [{"id_item": "1", "ordem_item": 1, "implicit_boundary_score": 1}, {"id_item": "1", "ordem_item": "1", "implicit_boundary_score": 2}, {"id_item": " ", "ordem_item": 2}, {"id_item": "2", "ordem_item": 0}, {"id_item": "3", "ordem_item": "x"}])
    assert [(r["id_item"], r["ordem_item"], r["implicit_boundary_score"]) for r in files.traces(spark, path).collect()] == [("1", 1, 2)]
    assert files.traces(spark, f"file://{tmp_path}/none.json").count() == 0


def test_overlays_may_be_missing_or_broken(spark, tmp_path):
    path = put(tmp_path / "o.json", {"version": 1, "items": {"I-1": {"tema": "x", "tags": ["a"], "solucao": None}}})
    assert {(r["field"], r["value"]) for r in files.overlay(spark, path).collect()} == {("tema", "x"), ("tags", '["a"]'), ("solucao", None)}
    assert files.overlay(spark, put(tmp_path / "b.json", "{broken")).count() == 0
    assert files.overlay(spark, f"file://{tmp_path}/none.json").count() == 0


def test_markdown_and_folders(spark, tmp_path):
    put(tmp_path / "ws1" / "prova.md", "linha um\n\nlinha três")
    put(tmp_path / "ws1" / "questoes.json", [])
    put(tmp_path / "ws2" / "prova.md", "x")
    put(tmp_path / "ws3" / "prova.md", "")
    found = files.markdown(spark, f"file://{tmp_path}/*/prova.md").orderBy("file").collect()
    assert [(r["name"], r["text"]) for r in found][0] == ("prova", "linha um\n\nlinha três")
    states = files.folder_states(spark, f"file://{tmp_path}", ["prova.md", "questoes.json"]).orderBy("workspace").collect()
    assert [(r["workspace"], r["prova"], r["questoes"]) for r in states] == [("ws1", True, True), ("ws2", True, False)]


def test_records_are_written_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("1", None), ("2", "é")], "id_item string, tema string")
    files.write_records(rows, f"file://{tmp_path}/out")
    files.write_records(rows, f"file://{tmp_path}/out")
    assert sorted(map(tuple, files.json_lines(spark, f"file://{tmp_path}/out", "id_item string, tema string").select("id_item", "tema").collect())) == [("1", None), ("2", "é")]


def test_result_lines_and_quarantine(spark):
    lines = spark.createDataFrame([("[resultado] status=ok upserted=18 skipped=0 erros=2",), ("nada",), (None,)], "t string").select(files.upload_result(F.col("t")).alias("r")).collect()
    assert [r["r"] and tuple(r["r"]) for r in lines] == [(18, 0, 2), None, None]
    good, bad = files.quarantined(spark.createDataFrame([(1, "a"), (2, None), (None, None)], "k int, v string"), {"key": F.col("k").isNull(), "value": F.col("v").isNull()})
    assert good.count() == 1 and sorted(r["faults"] for r in bad.collect()) == [["key", "value"], ["value"]]
