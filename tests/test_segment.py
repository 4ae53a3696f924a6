"""The segmenter against a plain version on generated exams, and literal cases."""

import random
import re

from pyspark.sql import functions as F

from itemforge.functions import items as I
from itemforge.operators import headings as H
from itemforge.operators import normalise as N
from itemforge.operators import segment as S


def group_at(line):
    m = re.search(H.GROUP_HEADING, line) or re.match(r"\s*grupo\s+(I{1,3}|IV|VI{0,3}|IX|X)\s*$", line, re.I)
    return m and m[1]


def part_at(line):
    m = re.search(H.PART_HEADING, line) or re.match(r"\s*parte\s+([A-C])\s*$", line, re.I)
    return m and m[1]


def plain_cuts(text):
    """Offset to score of all signs of an item without a number."""
    signs = {}

    def sign(at, score):
        signs[at] = max(score, signs.get(at, 0))

    at, gathered = 0, None
    for part in text.split("\n\n"):
        p = part.strip()
        if p:
            if gathered is not None:
                head, tail, low, before = p.split("\n")[0].strip(), gathered.split("\n")[-1].strip(), p.lower(), gathered.lower()
                score = 2 * bool(re.search(S.STARTS, head)) + 2 * bool(re.search(S.PICTURED, head)) + bool(re.search("figura|gr[aá]fico", low)) + 2 * ("complete o texto" in low)
                score -= 2 * p.startswith("![](") + 2 * bool(re.search(S.GOES_ON, head)) + 2 * tail.endswith(":") + tail.endswith(";") + tail.startswith("Sabe-se que") + (tail[-1:] not in ".!?")
                score += bool(re.search(I.IMAGE, p)) and not re.search(I.IMAGE, gathered)
                score += 3 * (("determine o valor de" in before or "mostre que" in before) and ("o gráfico da figura" in low or "para certos valores reais" in low))
                if score >= 3:
                    sign(at, score)
                    gathered = None
            gathered = p if gathered is None else gathered + "\n\n" + p
        at += len(part) + 2
    for m in re.finditer(f"(?m){S.OPENING_LINE}", text):
        if m.start() and re.search(r"(?:[.?!\])]|\$\$)$", text[: m.start()].rstrip()):
            sign(m.start(), 4)
    choices = [m.end() for m in re.finditer(r"\(D\)", text)]
    for end in choices:
        tail = text[end:]
        for m in re.finditer(S.AFTER_CHOICE, tail):
            sign(end + m.start(2), 5 if re.search(S.TASK, text[choices[0] :]) else 4)
    return signs


def plain_segments(text):
    """(id, line_start, line_end, reset, implicit, markdown) of each item."""
    text = re.sub(r"([^\n])\n(\\[*]\s+\d{1,3}\.)", r"\1\n\n\2", re.sub(r"\s+\\[*]\s+(\d{1,3}\.\d{1,2}\.)\s+", r"\n\n\1 ", text))
    lines, offsets = text.split("\n"), [0]
    for line in lines:
        offsets.append(offsets[-1] + len(line) + 1)
    group = part = None
    heads, stops, where = [], [], []
    for line, at in zip(lines, offsets, strict=False):
        if group_at(line):
            group, part = group_at(line), None
        elif part_at(line):
            part = part_at(line)
        if group_at(line) or part_at(line) or re.search(H.SCORING, line):
            stops.append(at)
        if m := re.search(H.ITEM, line + "\n"):
            heads.append((at, int(m[1]), m[2] and int(m[2]), group, part))
            stops.append(at)
        where.append((group, part))
    if not heads:
        return [("1", 1 + text[: len(text) - len(text.lstrip())].count("\n"), 1 + text.rstrip().count("\n"), False, False, text.strip())]
    blocks, now = [], None
    for at, raw, sub, g, p in heads:
        end = min([s for s in stops if s > at], default=len(text))
        main = raw if now is None else max(raw, now + (sub is None))
        reset = now is not None and main != raw
        if sub is None and now is not None and raw <= now:
            reset = True
        now = main
        blocks.append({"at": at, "end": end, "main": main, "sub": sub, "g": g, "p": p, "reset": reset})
    with_parents, known = [], {b["main"] for b in blocks if b["sub"] is None}
    for k, b in enumerate(blocks):
        if b["sub"] is not None and b["main"] not in known:
            known.add(b["main"])
            before = blocks[k - 1]["end"] if k else 0
            free = [m for m in re.finditer(r"(?:[^\n]+\n?)+", text[before : b["at"]]) if m[0].strip() and not re.search(S.NO_CONTEXT.split("|(?iu)")[0], m[0]) and not re.search("(?i)" + S.NO_CONTEXT.split("|(?iu)")[1], m[0])]
            if free:
                with_parents.append(b | {"at": before + free[-1].start(), "end": before + free[-1].end(), "sub": None, "reset": False})
            elif k and (m := re.match(r"(?s).*\(D\)[^\n]*", text[blocks[k - 1]["at"] : blocks[k - 1]["end"]])):
                cut = blocks[k - 1]["at"] + m.end()
                tail = text[cut : blocks[k - 1]["end"]]
                if tail.strip() and not re.match(r"\$\$|#|!\[|\(", tail.strip()):
                    with_parents[-1]["end"] = cut
                    with_parents.append(blocks[k - 1] | {"at": cut, "end": blocks[k - 1]["end"], "main": b["main"], "sub": None, "reset": False})
        with_parents.append(dict(b))
    pieces = []
    for b in with_parents:
        marks = [m for m in re.finditer(rf"(?<=[\s*★]){b['main']}\.(\d{{1,2}})\.(?=\s+(?:{S.INLINE_VERBS})\b)", text[b["at"] : b["end"]]) if m.start()]
        ends = [*(b["at"] + m.start() for m in marks), b["end"]]
        pieces.append(b | {"end": ends[0]})
        pieces += [b | {"at": b["at"] + m.start(), "end": e, "sub": int(m[1])} for m, e in zip(marks, ends[1:], strict=True)]
    out = []
    for k, b in enumerate(pieces):
        later = next((x["main"] for x in pieces[k + 1 :] if x["sub"] is None), None)
        cuts = sorted(plain_cuts(text[b["at"] : b["end"]])) if later is None or later > b["main"] + 1 else []
        cuts = [0, *(cuts if later is None else cuts[: later - b["main"] - 1])]
        for n, (x, y) in enumerate(zip(cuts, [*cuts[1:], b["end"] - b["at"]], strict=True)):
            body = text[b["at"] + x : b["at"] + y]
            start = b["at"] + x + len(body) - len(body.lstrip())
            clean = re.sub(r"\s*\\\s*$", "", re.sub(r"^\*+(?=[A-ZÁÉÍÓÚÀÂÃÇO])", "", body.strip())).strip()
            if clean:
                out.append((b["main"] + n, None if n else b["sub"], b["g"], b["p"], 1 + text[:start].count("\n"), 1 + text[:start].count("\n") + body.strip().count("\n"), b["reset"] or n > 0, n > 0, clean))
    least = {}
    for main, sub, g, *_ in out:
        if sub is None:
            least[g] = min(main, least.get(g, main))
    named = lambda main, sub, g, p: "-".join(x for x in (g, p, f"{main - (least.get(g, 1) - 1 if g else 0)}" + (f".{sub}" if sub is not None else "")) if x)
    return [(named(*r[:4]), *r[4:]) for r in out]


PIECES = [
    "Considere a função f, de domínio R.", "Sabe-se que f é par;", "O gráfico da Figura 2 mostra g.", "![](imagens/a.png)", "Na Figura 1, está representada a reta r.", "Mostre que x = 2", "Determine o valor de k.",
    "Para certos valores reais de a, tem-se b.", "Justifique a resposta.", "Complete o texto seguinte, com as opções.", "Utilize apenas caneta.", "* nota solta", "linha simples", "A reta é: ", "Uma caixa contém doze bolas azuis.", "O valor é positivo e maior do que três.", "$$x$$", "| a | b |", "texto\\",
]


def exam(rng):
    out, number = [], 1
    for _ in range(rng.randrange(1, 4)):
        if rng.random() < 0.7:
            out.append(rng.choice(["# Grupo {}", "GRUPO {}", "## GRUPO {} (50 pontos)", "Grupo {}"]).format(rng.choice(["I", "II", "IV", "VI"])))
        for _ in range(rng.randrange(1, 5)):
            if rng.random() < 0.25:
                out.append(rng.choice(["## {}", "PARTE {}", "# Parte {}", "### PARTE {}"]).format(rng.choice("ABC")))
            if rng.random() < 0.3:
                out += ["", rng.choice(PIECES), ""]
            if rng.random() < 0.6:
                out.append(rng.choice(["{}. ", "{}.  ", "Questão {}. ", "* {}. ", "**{}.** ", r"\* {}. "]).format(number) + rng.choice(PIECES))
                for _ in range(rng.randrange(0, 4)):
                    out += [rng.choice(["", rng.choice(PIECES)]), rng.choice(PIECES)]
                if rng.random() < 0.3:
                    out += ["Qual das opções? (A) um", "(B) dois (C) três", rng.choice(["(D) quatro", "(D) o quarto valor de todos"]), *rng.choices(PIECES, k=rng.randrange(0, 3))]
            for sub in range(1, rng.randrange(1, 4)):
                out.append(f"{number}.{sub}. " + rng.choice(PIECES) + (f" {number}.{sub + 5}. Calcule y." if rng.random() < 0.3 else ""))
            number += rng.choice([1, 1, 2, 4, 0])
    if rng.random() < 0.3:
        out.append("## COTAÇÕES")
        out.append("1. 10 pontos")
    return "\n".join(out)


def test_segments_equal_a_plain_version_on_generated_exams(spark):
    rng = random.Random(7)
    texts = [t for k in range(1000) if (t := exam(rng)).strip()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in S.segments(docs).orderBy("doc_id", "ordem").collect():
        got.setdefault(r["doc_id"], []).append((r["item_id"], r["line_start"], r["line_end"], r["suspected_reset"], r["implicit"], r["markdown"]))
    wrong = [(texts[k], got.get(k), w) for k, t in enumerate(texts) if (w := plain_segments(t)) != got.get(k)]
    assert not wrong, f"{len(wrong)}: {wrong[0]}"
    assert sum(x[4] for rows in got.values() for x in rows) > 100


def rows_of(spark, text):
    return S.segments(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("ordem").collect()


def test_sub_items_at_line_starts_keep_their_lines(spark):
    rows = rows_of(spark, "1. Considere f.\n2.1. Calcule x\n2.2. Mostre y\n3. Determine z.")
    assert [(r["item_id"], r["line_start"], r["line_end"]) for r in rows] == [("1", 1, 1), ("2.1", 2, 2), ("2.2", 3, 3), ("3", 4, 4)]


def test_parts_and_groups_in_all_spellings(spark):
    assert [r["item_id"] for r in rows_of(spark, "GRUPO I\n## A\n1. Seja f.\n## B\n2. Seja g.")] == ["I-A-1", "I-B-2"]
    assert [r["item_id"] for r in rows_of(spark, "# Grupo I\n1. a\n# GRUPO II (50 pontos)\n2. b\n# GRUPO VI\n3. c")] == ["I-1", "II-1", "VI-1"]
    # A lone letter is made a heading first.
    assert [r["item_id"] for r in rows_of(spark, "# GRUPO I\n**A**\n1. Seja f.\nB\n2. Seja g.")] == ["I-A-1", "I-B-2"]


def test_text_behind_the_last_alternative_becomes_the_parent_of_the_next_sub_items(spark):
    rows = rows_of(spark, "2. Qual das opções? (A) um (B) dois\n(C) três\n(D) quatro\nUm saco contém bolas.\n3.1. Calcule a.\n3.2. Mostre b.\n4. fim")
    assert [(r["item_id"], r["tipo"], r["line_start"]) for r in rows] == [("2", "multiple_choice", 1), ("3", "context_stem", 4), ("3.1", "open_response", 5), ("3.2", "open_response", 6), ("4", "open_response", 7)]
    assert rows[0]["markdown"].endswith("(D) quatro") and rows[1]["markdown"] == "Um saco contém bolas."


def test_stems_take_figures_and_optional_items_a_pool(spark):
    rows = rows_of(spark, "# GRUPO I\n1. Veja a Figura.\n1.1. a ![](x.png)\n1.2. b\n* 2. c\n# GRUPO III\nEscreva um texto.\n## COTAÇÕES\nfim")
    assert [(r["item_id"], r["images"], r["pool"]) for r in rows] == [("I-1", ["x.png"], None), ("I-1.1", [], None), ("I-1.2", [], None), ("I-2", [], "I-opt"), ("III-1", [], None)]
    assert rows[-1]["tipo"] == "essay" and (rows[-1]["line_start"], rows[-1]["line_end"]) == (7, 7)


def test_odd_documents(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " \n ", "x"), (None, "1. a", "x"), (4, "\n\nno heading\n", "x"), (5, "1. a\n\\* 2. b c \\* 2.1. d", "x")], "doc_id long, text string, main string")
    assert [(r["doc_id"], r["item_id"], r["line_start"]) for r in S.segments(docs).orderBy("doc_id", "ordem").collect()] == [(4, "1", 3), (5, "1", 1), (5, "2", 3), (5, "2.1", 5)]
    assert S.segments(docs.limit(0)).count() == 0


def test_contexts_of_parts_with_short_headings(spark):
    docs = spark.createDataFrame([(1, "# GRUPO I\nTexto comum a todas as partes do grupo.\n## A\nLeia com toda a atenção este excerto.\n1. item")], "doc_id long, text string")
    first = spark.createDataFrame([(1, "I", "A", 5)], "doc_id long, grupo string, parte string, line int")
    found = {(r["grupo"], r["parte"]): (r["line_start"], r["texto"]) for r in N.group_contexts(docs, first).collect()}
    assert found == {("I", ""): (2, "Texto comum a todas as partes do grupo."), ("I", "A"): (4, "Leia com toda a atenção este excerto.")}


def test_types_need_whole_words_and_read_arrays(spark):
    array = "Qual das seguintes é f?\n$$\\begin{array} { l l } { x + 1234 } & { f ( x ) } \\\\ { y + 1234567 } \\\\ { z - 7654321 } \\\\ { t + 22222 } \\end{array}$$"
    texts = ["Incomplete as afirmações", "Complete as afirmações", array, array.replace("Qual das", "Veja as"), "(A) a (B) b (C) c (D) d"]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(I.item_type(F.col("t"))).collect()]
    assert got == ["open_response", "complete_table", "multiple_choice", "open_response", "multiple_choice"]


def test_texts_are_read_by_expressions_once_and_bare_as_by_the_expression(spark, sf_dir):
    """A plan over what segments returns reads tables alone, and white space at ends goes as `^\\s+|\\s+$` takes it, before rare line breaks too."""
    ends = [(f"{a}x y{b}",) for a in ("", " \n", "  ", " ") for b in ("", "\t\r\n", "  ", " \u0085", "\n ", " ", "   ")] + [("",), (" \n",), (" ",), (None,)]
    rows = spark.createDataFrame(ends, "t string").select(S._bare(F.col("t")).alias("a"), F.regexp_replace("t", r"^\s+|\s+$", "").alias("b"))
    assert all(r["a"] == r["b"] for r in rows.collect())
    plan = S.segments(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "grupo\\s+III" not in plan
