"""HyperMinHash, spelling variants and source divergence against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from itemforge.llm import divergence, hyperminhash, spelling

LOWER = {k: k + 32 for k in range(65, 91)}


# HyperMinHash --------------------------------------------------------------------------------------------------------


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)}


def plain_components(rows):
    sets = [(k, shingles(t)) for k, t in rows if k is not None]
    top = {k: k for k, _ in sets}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                low, high = sorted((find(a), find(b)))
                top[high] = low
    return sorted((k, len(s), find(k)) for k, s in sets)


def as_rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def test_near_duplicates_equal_brute_force(spark, make_docs, documents):
    rng = random.Random(5)
    rows = list(documents[:120])
    vocabulary = [f"w{k}" for k in range(300)]
    for family in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([9, 40, 150]))]
        for copy in range(12):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((10_000 + 100 * family + copy, " ".join(words)))
    assert as_rows(hyperminhash.near_duplicates(make_docs(rows))) == plain_components(rows)


def test_chain_between_components_is_found(make_docs):
    # Each text links only to its neighbours, so that leaders alone join few of them.
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[3 * k : 3 * k + 100])) for k in range(40)]
    assert as_rows(hyperminhash.near_duplicates(make_docs(rows))) == plain_components(rows)


def test_near_duplicates_of_odd_rows_and_none(make_docs, odd):
    assert as_rows(hyperminhash.near_duplicates(make_docs(odd))) == plain_components(odd)
    assert as_rows(hyperminhash.near_duplicates(make_docs([]))) == []
    assert as_rows(hyperminhash.near_duplicates(make_docs([(2, None), (1, "")]))) == [(1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("n", [12, 300, 5000])
def test_estimates_come_near_the_similarity(n):
    rng = np.random.default_rng(n)
    found = []
    for _ in range(60):
        both, x, y = (rng.integers(0, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1) for size in (n, n // 4, n // 4))
        a, b = (np.unique(np.concatenate([both, z])) for z in (x, y))
        found.append(hyperminhash.estimates(hyperminhash.registers(a)[None], hyperminhash.registers(b)[None], np.array([len(a)]), np.array([len(b)]))[0])
    assert abs(np.mean(found) - n / (n + 2 * (n // 4))) < 0.03


def test_collisions_are_what_different_sets_agree_by():
    rng = np.random.default_rng(3)
    n = 20_000
    sets = [np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2)) for _ in range(60)]
    regs = [hyperminhash.registers(s) for s in sets]
    seen = np.mean([(x == y).mean() for k, x in enumerate(regs) for y in regs[:k]])
    assert 0.5 < seen / hyperminhash.collisions(np.array([n]), np.array([n]))[0] < 2


# Spelling variants ---------------------------------------------------------------------------------------------------


def plain_variants(rows):
    n = Counter()
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2 and len(w) >= 7}
    near = {w: set() for w in n}
    wild = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            wild[w[:k] + "*" + w[k + 1 :]].add(w)
            if (u := w[:k] + w[k + 1 :]) in n:
                near[w].add(u)
                near[u].add(w)
    for some in wild.values():
        for w in some:
            near[w] |= some - {w}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), c, len(near[w]), n[form[w]] if w in form else None) for w, c in n.items())


def variant_rows(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


@pytest.mark.parametrize("hot", [spelling.HOT, 15])
def test_variants_equal_brute_force(make_docs, documents, hot):
    assert variant_rows(spelling.variant_groups(make_docs(documents), hot=hot, task_rows=5000)) == plain_variants(documents)


def test_variants_of_repeated_letters_long_words_and_chains(make_docs):
    rng = random.Random(9)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(7, 11))) for _ in range(250)] + ["é" * 7, "é" * 8, "aaaaaaa", "aaaaaaaa", "aaaaaaab", "x" * 3000, "x" * 3001, "x" * 2000 + "y" + "x" * 1000]
    rows = [(k, " ".join(rng.choice(words) for _ in range(60))) for k in range(60)]
    rows += [(k, "Wonderful wonderfl " * 2 + "wonderful " * 30 + "wonderfuls " * 400) for k in range(70, 74)] + [(None, "wonderful " * 9)]
    got = variant_rows(spelling.variant_groups(make_docs(rows), hot=8, task_rows=500))
    assert got == plain_variants(rows)
    assert any(r[1] is not None and r[2] != r[1] for r in got)


def test_variants_of_odd_rows_and_none(make_docs, odd):
    rows = odd * 2
    assert variant_rows(spelling.variant_groups(make_docs(rows))) == plain_variants(rows)
    assert variant_rows(spelling.variant_groups(make_docs([]))) == []


def test_automaton_is_minimal_and_numbers_words():
    words = sorted({a + b + c for a in ("un", "re", "") for b in ("load", "lock", "pack") for c in ("", "ed", "ing")})
    root = spelling.automaton(words)
    assert [spelling._end(root, 0, w) for w in words] == list(range(len(words)))
    assert spelling._end(root, 0, "unloa") == -1
    states, stack = set(), [root]
    while stack:
        s = stack.pop()
        if id(s) not in states:
            states.add(id(s))
            stack += [t for t, _ in s.arcs.values()]
    rights = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert len(states) == len(rights)


# Source divergence ---------------------------------------------------------------------------------------------------


def plain_audit(rows, ranks):
    """rows: (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = [(a, s, Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOWER)))) for a, s, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs = Counter(t for a, _, c in found if a == lang for t in c)
        kept = [t for t, n in docs.items() if n >= 3]
        by = {s: Counter() for a, s, _ in found if a == lang}
        for a, s, c in found:
            if a == lang:
                by[s].update({t: c[t] for t in kept if t in c})
        every = sum(by.values(), Counter())

        def share(c, t, kept=kept):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        p = {s: {t: share(c, t) for t in kept} for s, c in by.items()}
        q = {t: share(every, t) for t in kept}
        f = lambda x, y: (x - y) ** 2 // y
        for s in by:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in by if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if by[s][t] and p[s][t] > q[t]]
            for part, some, most in (("pair", pairs, None), ("term", terms, ranks)):
                some.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, k + 1) for k, (t, v) in enumerate(some[:most])]
    return sorted(out)


def audit_rows(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def made(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", 2, 3) for r in rows], "lang string, source string, text string, n long, term string, p long, value long")


@pytest.mark.parametrize("ranks", [200, 3])
def test_audit_equals_plain_sums(spark, monkeypatch, ranks):
    rng = random.Random(ranks)
    words = [f"{'ab'[k % 2]}{chr(97 + k % 26)}{'é漢'[k % 2]}{chr(97 + k // 26)}" for k in range(200)]
    rows = [(rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", "", None, "é", "z"]), " ".join(rng.choices(words, [1 / (k + 1) for k in range(200)], k=rng.randrange(0, 60))).title()) for _ in range(150)]
    rows += [("en", "empty", ""), ("en", "none", None), ("de", "alone", "ein ein ein"), ("de", "other", "zwei"), ("it", "only", "uno"), ("en", "s1", "ax1bx-cx é")] * 2
    monkeypatch.setattr(divergence, "AT_ONCE", 20)
    assert audit_rows(divergence.audited(made(spark, rows), ranks)) == plain_audit(rows, ranks)


def test_audit_of_no_rows_and_of_groups_without_terms(spark):
    assert audit_rows(divergence.audited(made(spark, []))) == []
    rows = [("en", "a", None), ("en", "b", ""), ("en", "c", "x")]
    assert audit_rows(divergence.audited(made(spark, rows))) == plain_audit(rows, 200)


def test_corrections_in_slices_equal_those_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    starts = np.array([0, 5, 5, 6, 46, 51])
    source, p, z = np.arange(51) % 41, rng.integers(1, 10**9, 51), rng.integers(1, 1000, 51)

    def all_of():
        return sorted(x for part in divergence._corrections(source, p, z, starts) for x in zip(*(c.tolist() for c in part), strict=True))

    whole = all_of()
    monkeypatch.setattr(divergence, "AT_ONCE", 100)
    assert all_of() == whole and len(whole) == 2 * 20 + 40 * 39
