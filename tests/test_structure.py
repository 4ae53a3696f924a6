"""Joins, manifests, planes, versions and pages: literal cases and plain versions."""

import json
import random

import pytest

from itemforge.operators import joins as J
from itemforge.operators import manifest as M
from itemforge.operators import plane
from itemforge.operators import windows as W
from itemforge.sources import files, pages
from itemforge.sources.versions import Versions, merged


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ids_of_natural_keys_differ_and_stay(spark):
    none = spark.createDataFrame([], "id string, a string, b string")
    keys = spark.createDataFrame([(None, "x"), ("x", None), ("a|b", "c"), ("a", "b|c"), ("a", "b|c")], "a string, b string")
    once = J.get_or_create(none, keys, ["a", "b"], "id")
    assert once.count() == once.select("id").distinct().count() == 4
    assert rows_of(J.get_or_create(once, keys, ["a", "b"], "id")) == rows_of(once)


def test_upsert_takes_the_last_of_a_key_or_raises(spark):
    base = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    patch = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (None, "m", 1), (3, "z", 1)], "k int, v string, at int")
    assert rows_of(J.upsert(base, patch, ["k"], "at")) == sorted([(1, "y"), (3, "z"), (None, "m")], key=repr)
    with pytest.raises(Exception, match="occurs twice"):
        J.upsert(base, patch.drop("at"), ["k"]).collect()


def test_positional_join_keeps_left_rows_without_group_or_order(spark):
    left = spark.createDataFrame([(1, "g", 5.0), (2, None, 1.0), (3, "g", None)], "l int, g string, at double")
    right = spark.createDataFrame([(7, "g", 4.0), (8, "g", 6.0), (9, None, 1.0)], "r int, g string, place double")
    got = J.positional_join(left, right, "g", "at", "place", 2).select("l", "k", "r")
    assert rows_of(got) == [(1, 2, 8), (2, 1, None), (3, 1, 7)]


ITEMS = "ws int, id_item string, numero int, subitem string, tipo_item string"
MANIFEST = "ws int, estrutura map<string,array<string>>, pools array<struct<itens:array<string>,escolher:int>>, confianca string, bypass boolean"


def checked(spark, items, tree, pool=None, sure="alta", bypass=False):
    found = M.cross_check(spark.createDataFrame([(1, *i) for i in items], ITEMS), spark.createDataFrame([(1, tree, [(pool, 1)] if pool else None, sure, bypass)], MANIFEST))
    return sorted((r["check"], r["item"], r["target"], r["severity"]) for r in found.collect()) if sure == "alta" else rows_of(found)


def test_manifest_checks(spark):
    top, sub = ("1", 1, None, "open_response"), ("I-2.1", 2, "1", "open_response")
    two = ("I-2", 2, None, "context_stem")
    assert checked(spark, [top, two, sub], {"1": [], "I-2": ["I-2.1"]}) == []
    assert [x[:2] for x in rows_of(M.cross_check(spark.createDataFrame([(1, *top)], ITEMS), spark.createDataFrame([(1, {"1": [], "2": None}, None, None, None)], MANIFEST)).select("check", "item"))] == [("missing", "2")]
    assert checked(spark, [top, two, sub], {"1": [], "I-2": ["I-2.1", "I-2.2"]}) == [("missing_sub", "I-2.2", "I-2", "error"), ("missing_sub", "I-2.2", "I-2.1", "error")]
    assert checked(spark, [two, sub], {"I-2": []}) == [("extra_sub", "I-2.1", "I-2.1", "error"), ("simple", "I-2", "I-2", "error"), ("simple", "I-2", "I-2.1", "error")]
    assert checked(spark, [top], {"1": ["1.1"]}) == [("missing_sub", "1.1", "1", "error"), ("no_subs", "1", "1", "error")]
    # A bare number stands for an id with a group; a stem that isn't listed is no fault.
    assert checked(spark, [("I-1", 1, None, "essay"), ("II-9", 9, None, "context_stem"), ("II-8", 8, None, "essay")], {"1": []}) == [("extra", "II-8", "II-8", "error")]


def test_manifest_pools_confidence_and_bypass(spark):
    top = ("1", 1, None, "open_response")
    found = M.cross_check(spark.createDataFrame([(1, *top), (1, "2", 2, None, "context_stem")], ITEMS), spark.createDataFrame([(1, {"1": []}, [(["1", "2", "3"], 2)], "alta", None)], MANIFEST))
    assert rows_of(found) == [(1, "pool", "2", None, "error"), (1, "pool", "3", None, "error")]
    assert checked(spark, [top], {"1": ["1.1"]}, sure="baixa") == [(1, "missing_sub", "1.1", None, "warning"), (1, "no_subs", "1", None, "warning")]
    assert checked(spark, [top], {"4": []}, bypass=True) == []


def brute(left, right):
    out = []
    for key, page, kind, box in left:
        there = [r for r in right if r[1] == page and page is not None]
        some = [r for r in there if r[2] == kind] or there
        best = min(((sum((a - b) ** 2 for a, b in zip(box, r[3], strict=True)), r[0]) for r in some), default=(None, None))
        out.append((key, best[1], None if best[0] is None else float(best[0])))
    return sorted(out)


@pytest.mark.parametrize("spread", [1000, 20])
def test_nearest_boxes_equal_brute_force(spark, spread):
    rng = random.Random(spread)

    def box():
        x, y = rng.randrange(spread), int(rng.paretovariate(0.5)) % spread
        return [x, y, x + rng.randrange(60), y + rng.randrange(60)]

    left = [(k, rng.choice([0, 1, 2, None]), rng.choice("ab"), box()) for k in range(150)]
    right = [(k, rng.choice([0, 0, 0, 1]), rng.choice("aac"), box()) for k in range(2500)]
    kinds = "{} int, page int, kind string, box array<int>"
    got = plane.nearest_boxes(spark.createDataFrame(left, kinds.format("l")), spark.createDataFrame(right, kinds.format("r")), "l", "r")
    assert sorted(tuple(r) for r in got.select("l", "r", "distance").collect()) == brute(left, right)


def test_nearest_boxes_make_no_pairs_of_a_page(spark):
    rows = [(k, 0, "a", [k % 100, k // 100, k % 100 + 1, k // 100 + 1]) for k in range(10_000)]
    boxes = spark.createDataFrame(rows, "r int, page int, kind string, box array<int>").repartition(4)
    left = boxes.withColumnRenamed("r", "l")
    got = plane.nearest_boxes(left, boxes, "l", "r")
    assert got.filter("l = r AND distance = 0").count() == 10_000


def test_versions_keep_the_last_and_survive_a_lost_writer(spark, tmp_path):
    table = Versions(spark, f"file://{tmp_path}/t", keep=3)
    assert table.read() is None
    for k in range(5):
        table.write(spark.range(k + 1))
    assert table.read().count() == 5
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")) == [f"current-0000000{k}" for k in (3, 4, 5)] + [f"v-0000000{k}" for k in (3, 4, 5)]
    # A writer is lost after its files and before its pointer: readers see the version before, the next writer goes on.
    spark.range(99).write.parquet(f"file://{tmp_path}/t/v-00000006")
    assert table.read().count() == 5
    table.write(spark.range(7))
    assert table.read().count() == 7 and table.current()[0] == 7


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    table = Versions(spark, f"file://{tmp_path}/t")
    put = merged(table, ["k"], "at")
    batch = lambda *rows: spark.createDataFrame(rows, "k int, v string, at int")
    put(batch((1, "a", 1), (1, "b", 2), (2, "c", 1)), 0)
    put(batch((2, None, 3), (3, "d", 3)), 1)
    before = table.current()
    put(batch((2, "other", 9)), 1)
    put(batch((1, "other", 9)), 0)
    assert table.current() == before == (2, "1")
    assert rows_of(table.read()) == sorted([(1, "b"), (2, None), (3, "d")], key=repr)


def test_pages_are_read_in_ranges_with_a_short_last_one(spark, tmp_path):
    rows = [{"id_item": f"i{k}", "pontos": k} for k in range(2345)]
    for k in range(0, 2345, 1000):
        (tmp_path / f"page-{k // 1000:05d}.jsonl").write_text("\n".join(map(json.dumps, rows[k : k + 1000])))
    got = pages.paged(spark, str(tmp_path), "id_item string, pontos int, extra string", rows=2345, workers=2)
    assert got.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, got.collect())) == sorted((r["id_item"], r["pontos"], None) for r in rows)
    with pytest.raises(Exception, match="were promised"):
        pages.paged(spark, str(tmp_path), "id_item string", rows=2346).collect()
    assert pages.paged(spark, str(tmp_path), "id_item string", rows=0).count() == 0


def test_older_manifests_by_the_types_of_their_values(spark):
    texts = [
        '{"I-1": 5.5, "I-2.2": 3, "I-2.1": 4}', '{"cotacoes": {"I-1": 6.5, "I-2": "7"}, "confianca": "baixa"}', '{"I-1": {"pontos": 12}, "III-1": {"tipo": ""}, "II-1": {}, "x": "no"}',
        '{"I-1": 10, "pool_opcional": {"pontos": 30, "itens": ["I-2", "I-3"], "escolher": 2}}', '{"cotacoes": {"I-1": 1}, "estrutura": {"I-1": ["I-1.1"]}, "pool_opcional": [{"itens": ["I-4"], "escolher": 1}, 3]}', "[1]", "no", "{}", None,
    ]
    rows = files.migrated_manifests(spark.createDataFrame(list(enumerate(texts)), "_v int, pools string"), "pools").orderBy("_v").collect()
    got = [r["m"] and (r["m"]["cotacoes"], r["m"]["estrutura"], r["m"]["n"], r["m"]["confianca"]) for r in rows]
    assert got == [
        ({"I-1": 6, "I-2.1": 4, "I-2.2": 3}, {"I-1": [], "I-2": ["I-2.1", "I-2.2"]}, 2, "alta"), ({"I-1": 6, "I-2": 7}, {"I-1": [], "I-2": []}, 2, "baixa"), ({"I-1": 12, "II-1": 13, "III-1": 44}, {"I-1": [], "II-1": [], "III-1": []}, 3, "alta"),
        ({"I-1": 10, "I-2": 15, "I-3": 15}, {"I-1": [], "I-2": [], "I-3": []}, 3, "alta"), ({"I-1": 1, "I-4": 13}, {"I-1": ["I-1.1"], "I-4": []}, 2, "alta"), None, None, None, None,
    ]
    assert rows[3]["m"]["pools"][0]["itens"] == ["I-2", "I-3"] and rows[5]["pools"] == "[1]"


def test_ranks_over_ranges_equal_a_sort(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice([None, "", "a", "b"]), rng.randrange(900)) for k in range(3000)]
    df = spark.createDataFrame(rows, "k int, g string, at int").repartition(5)
    got = W.ranked(df, ["g", "at", "k"]).orderBy("n").collect()
    assert [r["k"] for r in got] == [r[0] for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2], r[0]))]
    assert [r["n"] for r in got] == list(range(1, 3001))
