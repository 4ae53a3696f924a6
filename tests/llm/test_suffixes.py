import random
from collections import Counter

import numpy as np

from itemforge.llm import suffixes


def brute_force(rows, length=suffixes.LENGTH):
    """{(key, text): (n_bytes, n_removed, n_spans, kept)} with every string of `length` bytes looked up among the earlier ones."""
    seen, out = set(), []
    for key, text in sorted(((k, (t or "").encode()) for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            window = text[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out.append((key, len(text), sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), kept))
    return Counter(out)


def found(docs, **options):
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffixes.deduplicated(docs, **options).collect())


def test_documents_match_brute_force(make_docs, documents):
    assert found(make_docs(documents)) == brute_force(documents)


def test_odd_rows(make_docs, odd):
    assert found(make_docs(odd)) == brute_force(odd)


def test_empty_table(make_docs):
    assert not found(make_docs([]))


def test_overlapping_repeats_in_one_text_and_across(make_docs):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcde ") for _ in range(400))
    rows = [(k, "".join(rng.choice("abc") for _ in range(rng.randrange(150))) + passage[rng.randrange(200) : 200 + rng.randrange(200)] * rng.randrange(3)) for k in range(80)]
    rows += [(100, "ab" * 400), (101, "a" * 99), (102, "a" * 100), (103, "a" * 101), (104, "b" + "a" * 100)]
    assert found(make_docs(rows)) == brute_force(rows)


def test_shorter_windows_and_small_shards(make_docs):
    rng = random.Random(5)
    rows = [(k, "".join(rng.choice("ab") for _ in range(300))) for k in range(40)]
    assert found(make_docs(rows), length=60) == brute_force(rows, 60)


def test_merge_refines_to_equal_prefixes():
    strings = [[b"banana", b"ananas"], [b"bandana", b"nana"]]
    parts = [suffixes.transform(s)[0] for s in strings]
    rows, block = suffixes.merge(parts, 3)
    where = [suffixes.places(p, np.array([len(x) for x in s])) for p, s in zip(parts, strings, strict=True)]
    flat = [(s[int(k)], int(at)) for (of, offset), s in zip(where, strings, strict=True) for k, at in zip(of, offset, strict=True)]
    prefix = [(flat[r][0][flat[r][1] : flat[r][1] + 3], int(b)) for r, b in zip(rows, block, strict=True)]
    whole = [p for p in prefix if len(p[0]) == 3]
    assert [p for p, _ in whole] == sorted(p for p, _ in whole)
    assert len({p for p, _ in whole}) == len({b for _, b in whole})


def test_common_prefixes_of_merged_rows():
    rng = random.Random(2)
    strings = [[bytes(rng.choice(b"ab") for _ in range(rng.randrange(20, 40))) for _ in range(6)] for _ in range(3)]
    parts = [suffixes.transform(s)[0] for s in strings]
    rows, common = suffixes.refined(parts, 8)
    where = [suffixes.places(p, np.array([len(x) for x in s])) for p, s in zip(parts, strings, strict=True)]
    flat = [s[int(k)][int(at) :] for (of, offset), s in zip(where, strings, strict=True) for k, at in zip(of, offset, strict=True)]
    ordered = [flat[r] for r in rows]
    for i in range(1, len(ordered)):
        a, b = ordered[i - 1][:8], ordered[i][:8]
        if len(a) == len(b) == 8:
            shared = next((k for k in range(8) if a[k] != b[k]), 8)
            assert common[i] <= shared and (common[i] == 8) == (shared == 8)


def test_query(spark, sf_dir, documents):
    rows = suffixes.op2_suffix_dedup(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(k for k, _ in documents)
    assert set(rows[0].asDict()) >= {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"}
