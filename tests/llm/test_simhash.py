import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from itemforge.llm import simhash


def fingerprint(text, size=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force(fps, distance=4):
    """{key: smallest key reachable} over (key, fingerprint) pairs."""
    top = {f: f for _, f in fps}

    def root(f):
        while top[f] != f:
            f = top[f]
        return f

    every = sorted(top)
    for i, a in enumerate(every):
        for b in every[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                top[root(a)] = root(b)
    least = {}
    for k, f in fps:
        least[root(f)] = min(k, least.get(root(f), k))
    return {k: least[root(f)] for k, f in fps}


def test_documents_match_brute_force(spark, sf_dir, documents):
    rows = simhash.op3_simhash_near_dedup(spark, sf_dir).collect()
    fps = [(k, fingerprint(t)) for k, t in documents]
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {k: f"{f:016x}" for k, f in fps}
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_force(fps)


def test_links_of_random_fingerprints(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(150)]
    for v in values[:100]:
        for _ in range(3):
            w = v
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                w ^= 1 << b
            values.append(w)
    values = sorted(set(values))
    nodes = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)], "node long, fp long")
    found = [(r["a"], r["b"], r["distance"]) for r in simhash.links(nodes).collect()]
    wanted = [(i, j, d) for i, a in enumerate(values) for j in range(i + 1, len(values)) if (d := (a ^ values[j]).bit_count()) <= 4]
    assert sorted(found) == wanted


def sent_whole(plan):
    """The generators and Arrow functions of a plan below a broadcast, without a shuffle between that would tell Spark their size."""
    found, at, dealt = [], None, None
    for line in plan.split("== Initial Plan ==")[0].splitlines():
        depth = len(re.match(r"[\s:+-]*", line)[0])
        at = None if at is not None and depth <= at else at
        dealt = None if dealt is not None and depth <= dealt else dealt
        if at is not None and dealt is None and re.search(r"\bGenerate |MapInArrow", line):
            found.append(line.strip())
        if at is None and "BroadcastExchange" in line:
            at = depth
        elif dealt is None and re.match(r"[\s:+-]*(Exchange|ShuffleQueryStage)", line):
            dealt = depth
    return found


def test_links_are_found_by_shuffle(spark):
    nodes = spark.range(100).select(F.col("id").alias("node"), F.xxhash64("id").alias("fp"))
    plan = simhash.links(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_chain_longer_than_a_round_is_one_component(spark):
    values = [(1 << (k * 4)) - 1 for k in range(16)]
    nodes = spark.createDataFrame(list(enumerate(values)), "node long, fp long")
    from itemforge.llm.components import components

    found = {r["node"]: r["component"] for r in components(simhash.links(nodes), "a", "b").collect()}
    assert found == dict.fromkeys(range(16), 0)


def test_odd_rows(make_docs, odd):
    rows = simhash.near_duplicates(make_docs(odd)).collect()
    keyed = [(k, t) for k, t in odd if k is not None]
    assert sorted(r["doc_id"] for r in rows) == sorted(k for k, _ in keyed)
    wanted = brute_force([(k, fingerprint(t)) for k, t in keyed])
    assert {r["doc_id"]: r["component_id"] for r in rows} == wanted
    assert wanted[1] == wanted[2] == wanted[3] == 1


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.similar_groups(make_docs([])).count() == 0


def test_more_than_five_bits_need_more_segments(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "node long, fp long"), 6)


def test_similar_groups_find_near_copies_and_leave_others(make_docs):
    rng = random.Random(2)
    vocabulary = [f"word{k}" for k in range(3000)]
    base = [[rng.choice(vocabulary) for _ in range(300)] for _ in range(40)]
    rows = []
    for k, words in enumerate(base):
        rows.append((k, " ".join(words)))
        near = list(words)
        for at in rng.sample(range(300), 4):  # Jaccard similarity of five-word shingles about 0.87
            near[at] = "changed"
        rows.append((1000 + k, " ".join(near)))
    found = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(make_docs(rows)).collect()}
    assert sum(found[1000 + k] == k for k in range(40)) >= 38
    assert all(found[k] == k for k in range(40))


def test_similar_groups_match_brute_force_around_the_threshold(make_docs):
    rng = random.Random(3)
    vocabulary = [f"word{k}" for k in range(3000)]
    rows = []
    for k in range(60):
        words = [rng.choice(vocabulary) for _ in range(300)]
        near = list(words)
        for at in rng.sample(range(300), 5 + k % 4):  # Jaccard similarity of five-word shingles about 0.76 to 0.85
            near[at] = "changed"
        rows += [(k, " ".join(words)), (1000 + k, " ".join(near))]
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, t in rows for w in [t.split()]}
    near = {k: 5 * len(sets[k] & sets[1000 + k]) >= 4 * len(sets[k] | sets[1000 + k]) for k in range(60)}
    assert 10 < sum(near.values()) < 50
    found = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(make_docs(rows)).collect()}
    assert found == {k: k for k in range(60)} | {1000 + k: k if near[k] else 1000 + k for k in range(60)}


def test_no_index_of_similar_groups_goes_through_the_driver(make_docs, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"word{k}" for k in range(3000)]
    rows = []
    for k in range(40):
        words = [rng.choice(vocabulary) for _ in range(300)]
        rows += [(k, " ".join(words)), (1000 + k, " ".join(["changed", *words[1:150], "changed", *words[151:]]))]
    plans = []

    def stored(df, what, store=simhash.materialise):
        df.collect()
        plans.append((what, df._jdf.queryExecution().executedPlan().toString()))
        return store(df, what)

    monkeypatch.setattr(simhash, "materialise", stored)
    stored(simhash.similar_groups(make_docs(rows)), "groups")
    assert {"nodes", "pairs", "sets", "asks", "links", "groups"} <= {what for what, _ in plans}
    assert sum("Generate explode" in plan for _, plan in plans) > 3
    assert [(what, x) for what, plan in plans for x in sent_whole(plan)] == []
    assert "SortMergeJoin [s0" in dict(plans)["groups"].split("== Initial Plan ==")[0]
