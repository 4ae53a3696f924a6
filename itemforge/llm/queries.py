"""The queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from itemforge.llm import decontaminate, divergence, htmltext, hyperminhash, interpolation, licenses, packing, quality, secrets, simhash, spelling, suffixes, warc

QUERIES = {
    "op1_warc_index": warc.op1_warc_index,
    "op2_suffix_dedup": suffixes.op2_suffix_dedup,
    "op3_simhash_near_dedup": simhash.op3_simhash_near_dedup,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
    "op6_lm_scoring": interpolation.op6_lm_scoring,
    "op7_html_extraction": htmltext.op7_html_extraction,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_best_fit_packing": packing.op9_best_fit_packing,
    "op10_license_scan": licenses.op10_license_scan,
    "op11_minhash_near_dedup": hyperminhash.op11_minhash_near_dedup,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLES = {
    "op8_quality_rules": r"""
        WITH w AS (
            SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: NOT regexp_full_match(x, '[\x20\x09-\x0D]*')) AS ls
            FROM documents),
        g AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
        twice AS (SELECT doc_id, s FROM g GROUP BY doc_id, s HAVING count(*) > 1),
        spots AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM g JOIN twice USING (doc_id, s)),
        reps AS (SELECT doc_id, count(*) AS n FROM spots GROUP BY doc_id),
        m AS (
            SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
                length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                coalesce(reps.n, 0) AS n_repeat_words, len(ls) AS n_lines
            FROM w LEFT JOIN reps USING (doc_id)),
        f AS (
            SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
                + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
                + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS failed
            FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
            failed = 0 AS kept, n_lines, failed
        FROM f""",
    "op11_minhash_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE [array_to_string(list_slice(ws, i, i + 2), ' ') for i in range(1, len(ws) - 1)] END) AS g FROM w WHERE len(ws) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
        edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edges.b FROM reach JOIN edges ON edges.a = reach.b),
        c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM (SELECT doc_id FROM documents) JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
            FROM documents),
        t AS (SELECT k, lang, source, unnest(ts) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
        l AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
        n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
        p AS (
            SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
                1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (coalesce(n.n, 0) + l.v) AS p,
                1 + (1000000000::HUGEINT * (kept.c + 1)) // (l.n + l.v) AS q
            FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
                LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
        pairs AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
        out AS (
            SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
            FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN pairs ON pairs.lang = x.lang AND pairs.source = x.source AND pairs.item = y.source
            UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE c > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM out)
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200""",
}
