"""Pages, blocks and excerpts: literal cases."""

from pyspark.sql import functions as F

from itemforge.operators import layout as L

LONG = "x" * 100


def test_kinds_by_name(spark):
    names = ["EX-MatA635-F1-2024-CC-VD.pdf", "portuguesB639_ccp1_07.pdf", "x_CC.pdf", "Criterios.pdf", "EX-Port639-F1.pdf", "accc1.pdf", "", None]
    found = spark.createDataFrame([(n,) for n in names], "n string").select(L.file_kind(F.col("n"))).collect()
    assert [r[0] for r in found] == ["cc", "cc", "cc", "cc", "prova", "prova", "prova", None]


def test_pages_that_stay(spark):
    files = {
        ("a", "cc"): ["capa", "CRITÉRIOS GERAIS DE CLASSIFICAÇÃO", "Critérios específicos\nde classificação\nE CENÁRIOS\nGRUPO I" + LONG, LONG, "  \n"],
        ("b", "cc"): ["capa", "fatores de Desvalorização", LONG, LONG], ("c", "cc"): ["capa", "x", None], ("d", "prova"): ["instruções", "Grupo II" + LONG, LONG, LONG[:99] + "  "], ("e", "prova"): ["GRUPO I", ""],
    }
    rows = [(f, kind, n, text) for (f, kind), texts in files.items() for n, text in enumerate(texts, 1)]
    roles = L.page_roles(spark.createDataFrame(rows, "f string, kind string, n int, text string"), "f").cache()
    found = {}
    for r in roles.orderBy("f", "n").collect():
        found.setdefault(r.f, []).append(r.dropped)
    assert found == {"a": ["general", "general", None, None, "blank"], "b": ["cover", "general", None, None], "c": [None] * 3, "d": ["instructions", None, None, "blank"], "e": [None, None]}
    told = {r.f: (r.kept, r.dropped, r.confidence, r.needs_review) for r in L.triage(roles, "f").collect()}
    assert told == {"a": (2, 3, "high", False), "b": (2, 2, "medium", True), "c": (3, 0, "low", True), "d": (2, 2, "high", False), "e": (2, 0, "high", False)}


def test_blocks_as_markdown(spark):
    rows = [
        ("title", " T ", 9, None, None, None, "#### T"), ("text", "a", 0, None, None, 2, "## a"), ("text", "# a", 1, None, None, None, "# a"), ("text", "a", None, None, " ", None, ""), ("text", None, 1, "x.png", None, None, ""), ("equation", "$x$", 1, "i/x.png", "", None, "$x$"),
        ("equation", " ", None, "i/x.png", None, None, "![](imagens_extraidas/x.png)"), ("table", "t", None, "a/b/t.png", "m", None, "![](imagens_extraidas/t.png)"), ("image", "t", None, None, None, None, ""), ("footer", "f", None, "x", None, None, ""), (None, "f", None, "x", None, None, ""),
    ]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, k string, t string, l int, i string, m string, ml int, want string")
    found = df.select("n", L.block(*map(F.col, ("k", "t", "l", "i", "m", "ml"))).alias("b"), "want").collect()
    assert [r.b for r in found] == [r.want for r in found]
    blocks = spark.createDataFrame([("d", 1, "a"), ("d", 2, ""), ("d", 3, "a"), ("d", 4, "b"), ("d", 5, "a"), ("d", 6, None), ("e", 1, "")], "d string, n int, block string")
    assert [tuple(r) for r in L.markdown(blocks, "d", "n").collect()] == [("d", "a\n\nb\n\na")]


def test_excerpts_number_lines(spark):
    texts = spark.createDataFrame([("w", "a\r\nb\nc\n\n"), ("v", ""), ("u", None), ("z", "\n".join(map(str, range(1, 10012))))], "ws string, text string")
    spans = spark.createDataFrame([("w", "1", 2, 2), ("w", "2", None, None), ("w", "3", 9, 9), ("v", "1", 1, 1), ("u", "1", 1, 5), ("z", "1", 10005, 10005), ("none", "1", 1, 1)], "ws string, id_item string, line_start int, line_end int")
    found = {(r.ws, r.id_item): (r["first"], r["last"], r.excerpt) for r in L.excerpts(texts, spans, 1).collect()}
    assert found == {
        ("w", "1"): (1, 3, "   1 | a\n   2 | b\n   3 | c"), ("w", "2"): (1, 2, "   1 | a\n   2 | b"), ("w", "3"): (8, 4, ""), ("v", "1"): (1, 0, ""), ("u", "1"): (1, 0, ""),
        ("z", "1"): (10004, 10006, "10004 | 10004\n10005 | 10005\n10006 | 10006"),
    }


def test_likely_pages(spark):
    rows = spark.createDataFrame([(1, 1, 100, 10), (50, 60, 100, 10), (100, 100, 100, 10), (None, None, 0, 3), (5, 2, 10, 4), (1, 1, 10, 0)], "a int, b int, n int, p int")
    found = [r.x and tuple(r.x) for r in rows.select(L.likely_pages(*map(F.col, "abnp")).alias("x")).collect()]
    assert found == [(1, 2), (4, 8), (9, 10), (1, 3), (1, 4), None]


def test_the_first_criterion_of_an_id_with_its_doubts(spark):
    rows = spark.createDataFrame([("w", "1", 2, "second", None), ("w", "1", 1, None, ["OCR-SUSPECT: x", "note"]), ("w", "2", 1, "t", None)], "ws string, id_item string, at int, texto_original string, observacoes array<string>")
    assert sorted(map(tuple, L.criterion_texts(rows, "at").collect())) == [("w", "1", "", ["OCR-SUSPECT: x"]), ("w", "2", "t", [])]
