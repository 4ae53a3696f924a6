"""Readers and sinks of the bank's files: JSON arrays with tolerant or strict schemas, overlays, whole Markdown files, folders, exports.

A path that isn't there gives an empty table where the bank treats a missing file as no entries; everything is read by Spark's readers, so any file system will do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from itemforge.operators.merge import parents

#: Question records as they are stored; a field that a record lacks is null.
QUESTION = (
    "id_item string, numero_questao int, numero_principal int, ordem_item int, subitem string, tipo_item string, enunciado string, alternativas array<struct<letra:string,texto:string>>, "
    "materia string, tema string, subtema string, descricao_breve string, tags array<string>, imagens array<string>, fonte string, status string, observacoes array<string>, texto_original string, "
    "source_span struct<line_start:int,line_end:int>, ids_contexto_pai array<string>, id_contexto_pai string, grupo string, parte string, reviewed boolean, pool_opcional string, "
    "palavras_min int, palavras_max int, tem_numeracao_linhas boolean, linhas_verificadas boolean"
)
CRITERION = (
    "id_item string, cotacao_total int, tipo string, resposta_correta string, respostas_corretas array<string>, solucao string, criterios_parciais array<struct<pontos:int,descricao:string,nivel:string>>, "
    "resolucoes_alternativas array<string>, status string, texto_original string, observacoes array<string>, imagens array<string>, reviewed boolean"
)
MANIFEST = "total_itens_principais int, estrutura map<string,array<string>>, cotacoes map<string,string>, confianca string, pool_opcional array<struct<pontos:int,itens:array<string>,escolher:int>>, bypass_validation boolean, bypass_motivo string"
TRACE = "id_item string, ordem_item string, suspected_numbering_reset boolean, inferred_from_implicit_boundary boolean, implicit_boundary_score int"
#: How sure a manifest may be.
CONFIDENCE = ("alta", "media", "baixa", "ausente")
#: Fields whose lists, texts and flags default to empty ones.
EMPTY_LISTS = ("alternativas", "tags", "imagens", "observacoes")
EMPTY_TEXTS = ("enunciado", "id_item", "materia", "tema", "subtema", "descricao_breve", "fonte", "texto_original", "grupo", "parte", "pool_opcional")


def json_records(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """The records of JSON files, each an array of objects, with the file that holds them; what is no object is left out, and so is a file that can't be read as an array."""
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    records = F.filter(F.from_json("value", f"array<struct<{_nested(schema)}>>"), lambda r: r.isNotNull())
    return raw.select("file", F.inline(records)).select(*(c for c in _names(schema)), "file")


def json_lines(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """The records of files with one JSON object a line, with the file that holds them; lines that don't fit are left out."""
    raw = spark.read.text(path).select(F.from_json("value", f"{schema}, _broken string", {"columnNameOfCorruptRecord": "_broken"}).alias("r"), F.col("_metadata.file_path").alias("file"))
    return raw.filter("r._broken IS NULL AND r IS NOT NULL").select(*(F.col("r")[c].alias(c) for c in _names(schema)), "file")


def _names(schema: str) -> list[str]:
    return [f.name for f in StructType.fromDDL(schema).fields]


def _nested(schema: str) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in StructType.fromDDL(schema).fields)


def or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As json_records; a path that isn't there has no records."""
    try:
        return json_records(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, file string")


def with_defaults(records: DataFrame) -> DataFrame:
    """Question records with what a missing field stands for: empty texts and lists, the main number of the id, reviewed unless a note says otherwise, one list of parents."""
    c = F.col
    number = F.regexp_extract(F.coalesce("id_item", F.lit("0")), r"^(?:[IVX]+-)?(\d{1,3})", 1).try_cast("int")
    pending = F.exists(F.coalesce("observacoes", F.array().cast("array<string>")), lambda o: F.contains(o, F.lit("review-pending")))
    of = {f.name: f.dataType for f in records.schema.fields}
    return records.withColumns({
        "numero_questao": F.coalesce("numero_questao", number, F.lit(0)), "reviewed": F.coalesce("reviewed", ~pending), "tipo_item": F.coalesce("tipo_item", F.lit("unknown")), "status": F.coalesce("status", F.lit("pending_review")),
        "ids_contexto_pai": parents(c("ids_contexto_pai"), c("id_contexto_pai")), "linhas_verificadas": F.coalesce("linhas_verificadas", F.lit(False)),
    } | {x: F.coalesce(x, F.lit("")) for x in EMPTY_TEXTS} | {x: F.coalesce(x, F.array().cast(of[x])) for x in EMPTY_LISTS}).withColumn("id_contexto_pai", F.coalesce(F.get("ids_contexto_pai", F.lit(0)), F.lit("")))


def questions(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return with_defaults(json_records(spark, path, QUESTION))


def criteria(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Criteria records; one without an id or a total raises when its id is read."""
    read = json_records(spark, path, CRITERION)
    lacks = F.col("id_item").isNull() | F.col("cotacao_total").isNull()
    return read.withColumn("id_item", F.when(lacks, F.raise_error(F.concat(F.lit("criterion without id_item or cotacao_total in "), "file"))).otherwise(F.col("id_item")))


def manifests(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Manifest files, one object each: their fields, points rounded half to even, and fault, which says why a file isn't in the canonical form; null where it is."""
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    keys = F.json_object_keys("value")
    bare = F.trim(F.regexp_replace("value", r"\s+", " "))
    flat, stub = F.from_json("value", "map<string,double>"), F.from_json("value", "map<string,string>")
    parsed = F.from_json("value", MANIFEST)
    all_of = lambda m, test: (F.size(F.map_keys(m)) > 0) & F.forall(F.map_values(m), test)
    old = F.when(F.coalesce(all_of(flat, lambda v: v.isNotNull()), F.lit(False)), "flat map").when(F.coalesce(all_of(stub, lambda v: F.contains(v, F.lit('"pontos"'))), F.lit(False)), "stub").otherwise("no cotacoes")
    sure = F.coalesce(parsed["confianca"], F.lit("alta"))
    why = F.trim(F.coalesce(parsed["bypass_motivo"], F.lit(""))) == ""
    fault = F.when(~F.startswith(bare, F.lit("{")), "no object").when(~F.coalesce(F.array_contains(keys, "cotacoes"), F.lit(False)), old).when(~sure.isin(*CONFIDENCE), "confianca").when(parsed["bypass_validation"] & why, "bypass without reason")
    points = F.transform_values(parsed["cotacoes"], lambda _, v: F.bround(v.try_cast("double"), 0).cast("int"))
    return raw.select(
        "file", fault.alias("fault"), F.coalesce(parsed["total_itens_principais"], F.lit(0)).alias("total_itens_principais"), parsed["estrutura"].alias("estrutura"), points.alias("cotacoes"), sure.alias("confianca"),
        parsed["pool_opcional"].alias("pool_opcional"), F.coalesce(parsed["bypass_validation"], F.lit(False)).alias("bypass_validation"),
    )


#: Points of an item whose manifest names it without any: those of an essay's group, and all others.
STUB_ESSAY, STUB = 44, 13

#: How a manifest's JSON becomes one: each step a column of SQL over those before it, as only SQL has casts from VARIANT to maps.
_MIGRATION = (
    ("_v", "try_parse_json(_json)"),
    ("_object", "CASE WHEN schema_of_variant(_v) LIKE 'OBJECT%' THEN CAST(_v AS MAP<STRING, VARIANT>) END"),
    ("_canonical", "coalesce(map_contains_key(_object, 'cotacoes'), false)"),
    ("_said", "CASE WHEN _canonical THEN CAST(try_variant_get(_v, '$.cotacoes', 'map<string,variant>') AS MAP<STRING, VARIANT>) ELSE map_filter(_object, (k, x) -> k <> 'pool_opcional') END"),
    ("_points", """map_filter(transform_values(_said, (k, x) -> CASE
        WHEN schema_of_variant(x) RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)' THEN CAST(bround(CAST(x AS DOUBLE), 0) AS INT)
        WHEN _canonical THEN CAST(bround(try_variant_get(x, '$', 'double'), 0) AS INT)
        WHEN schema_of_variant(x) LIKE 'OBJECT%' THEN coalesce(CAST(bround(CASE WHEN schema_of_variant(variant_get(x, '$.pontos')) RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)' THEN try_variant_get(x, '$.pontos', 'double') END, 0) AS INT),
            CASE WHEN k LIKE 'III%' THEN {essay} ELSE {stub} END) END), (k, p) -> p IS NOT NULL)"""),
    ("_pool", "try_variant_get(_v, '$.pool_opcional', 'variant')"),
    ("pools", """transform(CASE WHEN schema_of_variant(_pool) LIKE 'ARRAY%' THEN filter(CAST(_pool AS ARRAY<VARIANT>), e -> schema_of_variant(e) LIKE 'OBJECT%') WHEN schema_of_variant(_pool) LIKE 'OBJECT%' THEN array(_pool) ELSE array() END,
        e -> named_struct('pontos', try_variant_get(e, '$.pontos', 'double'), 'itens', coalesce(try_variant_get(e, '$.itens', 'array<string>'), array()), 'escolher', coalesce(try_variant_get(e, '$.escolher', 'int'), 0)))"""),
    ("_members", """map_from_entries(array_distinct(flatten(transform(pools, e -> transform(filter(e.itens, i -> NOT map_contains_key(_points, i)),
        i -> struct(i, CASE WHEN e.pontos <> 0 AND e.escolher <> 0 THEN CAST(bround(e.pontos / e.escolher, 0) AS INT) ELSE {stub} END))))))"""),
    ("cotacoes", "map_concat(_points, _members)"),
    ("_ids", "array_sort(map_keys(cotacoes))"),
    ("_subs", "filter(_ids, i -> contains(element_at(split(i, '-'), -1), '.'))"),
    ("_tops", "array_sort(array_distinct(concat(filter(_ids, i -> NOT contains(element_at(split(i, '-'), -1), '.')), transform(_subs, i -> regexp_replace(i, '[.][^.]*$', '')))))"),
    ("_built", "map_from_arrays(_tops, transform(_tops, t -> filter(_subs, i -> regexp_replace(i, '[.][^.]*$', '') = t)))"),
    ("_given", "CASE WHEN _canonical THEN try_variant_get(_v, '$.estrutura', 'map<string,array<string>>') END"),
    ("estrutura", "CASE WHEN size(_given) > 0 THEN map_concat(_given, map_filter(map_from_arrays(_tops, transform(_tops, t -> CAST(array() AS ARRAY<STRING>))), (k, x) -> NOT map_contains_key(_given, k) AND map_contains_key(cotacoes, k))) ELSE _built END"),
    ("n", "size(map_filter(estrutura, (k, x) -> NOT contains(element_at(split(k, '-'), -1), '.')))"),
    ("confianca", "CASE WHEN _canonical THEN coalesce(try_variant_get(_v, '$.confianca', 'string'), 'alta') ELSE 'alta' END"),
)


def migrated_manifests(rows: DataFrame, json: str) -> DataFrame:
    """rows with m, a struct<cotacoes, estrutura, n, pools, confianca> of a manifest's JSON, whatever its form; null for what is no object or names no item.

    Forms are told apart by their types, as VARIANT has them: `cotacoes` with or without a tree; a flat map of points; a map of objects with points; one of objects without, which get STUB points,
    in group III STUB_ESSAY; and pools as one object or a list, whose members that have no points share the pool's. Points are rounded half to even. An item with a point in its number hangs under
    the rest of its id, whether that has points or not; a tree that is given stays, with the main items it lacks. Other values are left out.
    """
    # A row travels as one struct, so no name of its columns can meet one of a step.
    now = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_row"), F.col(f"`{json}`").alias("_json"))
    for name, sql in _MIGRATION:
        now = now.withColumn(name, F.expr(sql.format(essay=STUB_ESSAY, stub=STUB)))
    m = F.when(F.size("cotacoes") > 0, F.struct("cotacoes", "estrutura", "n", "pools", "confianca"))
    return now.select(*(F.col("_row")[c].alias(c) for c in rows.columns), m.alias("m"))


def canonical_manifests(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """As manifests, but a file in another form raises when it is read."""
    found = manifests(spark, path)
    return found.withColumn("file", F.when(F.col("fault").isNotNull(), F.raise_error(F.concat("file", F.lit(": "), "fault"))).otherwise(F.col("file"))).drop("fault")


def traces(spark: SparkSession, path: str) -> DataFrame:
    """Side-car records by (id_item, ordem_item), the last of each in the file; those without an id or a positive order are left out. No file, no records."""
    read = or_empty(spark, path, TRACE).withColumn("ordem_item", F.col("ordem_item").try_cast("int"))
    good = read.filter("trim(id_item) <> '' AND ordem_item > 0").withColumn("_at", F.monotonically_increasing_id())
    rest = [c for c in good.columns if c not in ("id_item", "ordem_item", "_at")]
    return good.groupBy("id_item", "ordem_item").agg(F.max_by(F.struct(*rest), "_at").alias("r")).select("id_item", "ordem_item", "r.*")


def overlay(spark: SparkSession, path: str) -> DataFrame:
    """(id_item, field, value): the corrections of an overlay file `{"items": {id: {field: value}}}`; none where it is missing or broken."""
    try:
        raw = spark.read.text(path, wholetext=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "id_item string, field string, value string")
    items = raw.select(F.explode(F.from_json(F.get_json_object("value", "$.items"), "map<string,map<string,string>>")).alias("id_item", "fields"))
    return items.select("id_item", F.explode("fields").alias("field", "value"))


def markdown(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, name, text): each Markdown file as one text."""
    read = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return read.select("file", F.regexp_extract("file", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("name"), "text")


def folder_states(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """(workspace, bytes, changed, name...): a row for each folder under root, with a column for each of these files that says whether it is there.

    Only what the file system lists is read, no file's content. Spark's listing leaves out files without content, so these count as missing.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")
    each = files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("workspace"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length", "modificationTime")
    there = [F.bool_or(F.col("name") == n).alias(n.rsplit(".", 1)[0]) for n in names]
    return each.groupBy("workspace").agg(F.sum("length").alias("bytes"), F.max("modificationTime").alias("changed"), *there)


def stale(states: DataFrame, source: str, derived: str) -> Column:
    """Whether a derived file is missing or older than its source; source and derived are columns of times."""
    return F.col(source).isNotNull() & (F.col(derived).isNull() | (F.col(derived) < F.col(source)))


def write_records(records: DataFrame, path: str) -> None:
    """Records as JSON lines, nulls kept, in place of what is there; json_lines reads them back."""
    records.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def exported(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Write each table under path and return (table, n) as counted from what was written."""
    spark = next(iter(tables.values())).sparkSession
    counts = []
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        counts.append(spark.read.schema(df.schema).parquet(f"{path}/{name}").agg(F.lit(name).alias("table"), F.count("*").alias("n")))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def quarantined(rows: DataFrame, faults: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The rows without a fault, and the others with an array of their faults' names: what can be loaded is, without a second try row by row."""
    named = rows.withColumn("faults", F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in faults.items()))))
    return named.filter(F.size("faults") == 0).drop("faults"), named.filter(F.size("faults") > 0)


def upload_result(line: Column) -> Column:
    """struct<upserted, skipped, errors> of a line `[resultado] … upserted=1 skipped=2 erros=0`; null for other lines."""
    pattern = r"\[resultado\].*?upserted=(\d+)\s+skipped=(\d+)\s+erros=(\d+)"
    part = lambda k: F.regexp_extract(line, pattern, k).try_cast("int")
    return F.when(line.rlike(pattern), F.struct(part(1).alias("upserted"), part(2).alias("skipped"), part(3).alias("errors")))
