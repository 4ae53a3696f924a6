"""Text functions from columns to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accented letters and what they fold to.
ACCENTED, PLAIN = "ãâàáäêéèëîíïôóõöúûüçñ", "aaaaaeeeeiiioooouuucn"
#: A source label's parts.
KINDS, SUBJECTS, PHASES = ("Exame Nacional",), ("Matemática A", "Português"), ("1.ª Fase", "2.ª Fase", "Época Especial")


def unaccent(x: Column) -> Column:
    return F.translate(x, ACCENTED, PLAIN)


def slug(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(unaccent(F.lower(F.trim(x))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def file_slug(x: Column, fallback: str = "documento") -> Column:
    s = F.regexp_replace(F.regexp_replace(F.trim(x), "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", "")
    return F.when(s == "", F.lit(fallback)).otherwise(s)


def compact(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, r"\s+", " "), "^ | $", "")


def source_label(x: Column) -> Column:
    """struct<tipo, materia, fase, ano> of a label in the canonical form, else null."""
    either = lambda names: "|".join(n.replace(".", r"\.") for n in names)
    pattern = rf"^({either(KINDS)}), ({either(SUBJECTS)}), ({either(PHASES)}), (20\d{{2}})$"
    part = lambda k: F.regexp_extract(x, pattern, k)
    return F.when(part(1) != "", F.struct(part(1).alias("tipo"), part(2).alias("materia"), part(3).alias("fase"), part(4).cast("int").alias("ano")))


def item_number(x: Column) -> Column:
    """The main number of an item's id, with or without a group before it."""
    return F.regexp_extract(x, r"^(?:[IVX]+-)?(\d{1,3})", 1).try_cast("int")


def odd_dollars(x: Column) -> Column:
    """Whether the number of $ without a backslash before is odd."""
    return F.contains(x, F.lit("$")) & (F.pmod(F.regexp_count(x, F.lit(r"(?<!\\)\$")), F.lit(2)) == 1)


def brace_mismatch(x: Column) -> Column:
    return (F.contains(x, F.lit("$")) | F.contains(x, F.lit("\\"))) & (F.regexp_count(x, F.lit(r"\{")) != F.regexp_count(x, F.lit(r"\}")))


def tokens(x: Column) -> Column:
    """Folded alphanumeric tokens in order."""
    return F.filter(F.split(unaccent(F.lower(x)), "[^a-z0-9]+"), lambda t: t != "")


#: Letters that words are made of.
WORD_LETTERS = "a-záàâãéêíóôõúüçA-ZÁÀÂÃÉÊÍÓÔÕÚÜÇ"


def long_words(x: Column) -> Column:
    """Distinct runs of five or more letters, accented ones included, in small letters."""
    return F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit(f"[{WORD_LETTERS}]{{5,}}"), F.lit(0)), F.lower))


def normal_tags(tags: Column) -> Column:
    bare = F.filter(F.transform(tags, lambda t: F.trim(t)), lambda t: t != "")
    return F.array_distinct(F.transform(bare, lambda t: F.when(t.startswith("#"), t).otherwise(F.concat(F.lit("#"), t))))


def fix_steps(x: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """array of a text and what it is after each of the rules (name, pattern, replacement) in turn; every rule is applied once."""
    each = F.array(*(F.struct(F.lit(p).alias("pattern"), F.lit(to).alias("to")) for _, p, to in rules))
    return F.aggregate(each, F.array(x), lambda done, r: F.array_append(done, F.regexp_replace(F.element_at(done, -1), r["pattern"], r["to"])))


def fix_log(steps: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The names of those rules that changed something."""
    return F.array_compact(F.array(*(F.when(steps[k] != steps[k + 1], F.lit(name)) for k, (name, _, _) in enumerate(rules))))


def fix_chain(x: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The text after all rules in turn, and the names of those that changed it."""
    steps = fix_steps(x, rules)
    return F.element_at(steps, -1), fix_log(steps, rules)


def fixed(rows: DataFrame, keep: list[str], x: Column, rules: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """keep, fixed and log; a generator stands between, so the chain is evaluated once for each row."""
    steps = rows.select(*keep, F.inline(F.array(F.struct(fix_steps(x, rules).alias("_steps")))))
    return steps.select(*keep, F.element_at("_steps", -1).alias("fixed"), fix_log(F.col("_steps"), rules).alias("log"))


def outside_math(x: Column, pattern: str, replacement: str) -> Column:
    """Replace only outside $...$ spans."""
    parts = F.regexp_extract_all(x, F.lit(r"(?s)(\$[^$]*\$|[^$]+|\$)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.startswith("$"), p).otherwise(F.regexp_replace(p, pattern, replacement))), "")


def excerpt(x: Column, first: int, count: int) -> Column:
    return F.array_join(F.slice(F.split(x, "\n"), first, count), "\n")


def cosine_distance(a: Column, b: Column) -> Column:
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return 1 - dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


#: Codes of subjects and phases in file names, and words that a search leaves out.
SUBJECT_CODES = {
    "MatA": "Matemática A", "MatB": "Matemática B", "Port": "Português", "FQ": "Física e Química", "Bio": "Biologia e Geologia", "Hist": "História", "Geo": "Geografia", "EF": "Educação Física",
    "Filo": "Filosofia", "Ing": "Inglês", "Fran": "Francês", "Esp": "Espanhol",
}
PHASE_CODES = {"F1": "1.ª Fase", "F2": "2.ª Fase", "FE": "Fase Especial", "FR": "Recurso", "EE": "Época Especial"}
STOP_WORDS = ("de", "que", "a", "o", "e", "the", "of")


def _coded(x: Column, codes: dict[str, str]) -> Column:
    known = F.create_map(*(F.lit(y) for pair in codes.items() for y in pair))
    return F.coalesce(known[x], x)


def exam_label(path: Column) -> Column:
    """The source that a path's codes name, in the file's name or else in the nearest folder that has them; empty if none has."""
    pattern = r"(?i)EX-([A-Za-z]+)\d*-(EE|F\w+?)-(\d{4})"
    folders = F.filter(F.reverse(F.split(path, "/")), lambda p: p.rlike(pattern))
    best = F.coalesce(F.get(folders, F.lit(0)), F.lit(""))
    part = lambda k: F.regexp_extract(best, pattern, k)
    label = F.concat_ws(", ", F.lit("Exame Nacional"), _coded(part(1), SUBJECT_CODES), _coded(F.upper(part(2)), PHASE_CODES), part(3))
    return F.when(best == "", F.lit("")).otherwise(label)


def fts_tokens(x: Column) -> Column:
    """Folded tokens without stop words; words aren't reduced to stems."""
    return F.filter(tokens(x), lambda t: ~t.isin(*STOP_WORDS))


def fts_terms(query: str) -> list[str]:
    return [w for w in query.lower().split() if w not in STOP_WORDS]
