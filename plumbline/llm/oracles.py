"""The answers in DuckDB SQL, by plain comparison of everything with everything."""

from __future__ import annotations

import string

from plumbline.llm import urls
from plumbline.llm.licenses import BASE, NOTICES

_LOWER = f"translate(coalesce({{0}}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _alphanumeric(text: str) -> str:
    return rf"regexp_extract_all({_LOWER.format(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _spaced(text: str) -> str:
    return rf"regexp_extract_all({_LOWER.format(text)}, '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


NEAREST = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS code
    FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) = 64
), d AS (
    SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id,
        CAST(list_sum(list_transform(range(1, 65), lambda i: abs(q.code[i] - r.code[i]))) AS INTEGER) AS distance
    FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank FROM d
)
SELECT query_id, rank, neighbour_id, distance FROM ranked WHERE rank <= 10
"""

_TEMPLATES = ", ".join(
    "({}, {}, [{}], [{}], {})".format(
        number, _quoted(t.label), ", ".join(map(_quoted, t.words)), ", ".join(map(_quoted, t.key_phrases)), f"{t.coverage}::DOUBLE")
    for number, t in enumerate(BASE + NOTICES)
)

LICENSES = f"""
WITH t(template, label, words, phrases, coverage) AS (VALUES {_TEMPLATES}),
posting AS (
    SELECT template, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM t
), doc AS (
    SELECT row_number() OVER () AS row, doc_id, {_alphanumeric('text')} AS words FROM documents
), token AS (
    SELECT row, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS spot FROM doc
), same AS (
    SELECT token.row, template, spot - place AS start, count(*) AS same
    FROM token JOIN posting ON token.word = posting.word WHERE spot >= place GROUP BY ALL
), compared AS (
    SELECT s.row, s.template, s.start, s.same, t.label, t.words, t.phrases,
        ' ' || array_to_string(doc.words[s.start + 1 : s.start + len(t.words)], ' ') || ' ' AS found
    FROM same s JOIN t ON s.template = t.template JOIN doc ON s.row = doc.row WHERE s.same >= t.coverage * len(t.words)
), verified AS (
    SELECT *, template < {len(BASE)} AS is_base FROM compared
    WHERE list_bool_and(list_transform(phrases, lambda k: contains(found, ' ' || k || ' ')))
), own AS (
    SELECT row, count(*) FILTER (is_base) AS n_base, min(start) FILTER (is_base) AS first_word,
        max(start) FILTER (is_base) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(same / len(words)) AS score
    FROM verified GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0), 6) AS score
FROM doc LEFT JOIN own USING (row)
"""


def _urls() -> str:
    fits = []
    for rule, verdict in sorted(urls.RULES, key=lambda r: (-len(r[0]), r[0])):
        host, _, path = rule.partition("/")
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')", rule, verdict))
    rule_sql = "CASE " + " ".join(f"WHEN {fit} THEN '{rule}'" for fit, rule, _ in fits) + " END"
    verdict_sql = "CASE " + " ".join(f"WHEN {fit} THEN '{verdict}'" for fit, _, verdict in fits) + " END"
    n = urls.ORDER + 1
    steps, levels = urls.STEPS, []
    p = {side: f"(1.0::DOUBLE / {urls.ALPHABET})" for side in "ar"}
    levels.append(f"p0 AS (SELECT DISTINCT gram, {p['a']} AS a, {p['r']} AS r FROM gram)")
    for k in range(n):
        tail, context = f"substr(gram, {n - k}, {k + 1})", f"substr(gram, {n - k}, {k})"
        smooth = ", ".join(
            f"CASE WHEN coalesce(c.{s}, 0) > 0 THEN (coalesce(l.{s}, 0) + c.k{s} * p.{s}) / (c.{s} + c.k{s}) ELSE p.{s} END AS {s}"
            for s in "ar"
        )
        levels.append(f"""l{k} AS (
    SELECT {tail} AS tail, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS r
    FROM gram WHERE trains GROUP BY ALL
), c{k} AS (
    SELECT substr(tail, 1, {k}) AS context, sum(a) AS a, sum(r) AS r, count(*) FILTER (a > 0) AS ka, count(*) FILTER (r > 0) AS kr
    FROM l{k} GROUP BY ALL
), p{k + 1} AS (
    SELECT p.gram, {smooth} FROM p{k} p LEFT JOIN l{k} l ON {tail} = l.tail LEFT JOIN c{k} c ON {context} = c.context
)""")
    return rf"""
WITH rest AS (
    SELECT page_id, coalesce(url, '') AS url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), page AS (
    SELECT page_id, url, {_LOWER.format(r"regexp_extract(rest, '^[^/?#]*')")} AS host,
        regexp_extract(coalesce(rest, ''), '^([^/?#]*)([^?#]*)', 2) AS path FROM rest
), url AS (
    SELECT DISTINCT url, host, path, {rule_sql} AS rule, {verdict_sql} AS verdict,
        substr(md5(url), 1, 1) < '{urls.CALIBRATION}' AS calibrates FROM page
), chars AS (
    SELECT *, repeat(chr(2), {urls.ORDER}) || url || chr(3) AS s, verdict IS NOT NULL AND NOT calibrates AS trains FROM url
), gram AS (
    SELECT url, verdict, trains, substr(s, i, {n}) AS gram
    FROM (SELECT *, unnest(range(1, length(s) - {urls.ORDER} + 1)) AS i FROM chars)
), {", ".join(levels)}, score AS (
    SELECT url, avg(ln(a / r)) AS score FROM gram JOIN p{n} USING (gram) GROUP BY url
), step AS (
    SELECT CAST(round(least(greatest(score, -{urls.LARGEST}), {urls.LARGEST}) * {steps}) AS INTEGER) AS step,
        count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS r
    FROM score JOIN url USING (url) WHERE verdict IS NOT NULL AND calibrates GROUP BY 1
), below AS (
    SELECT step, (step + coalesce(lag(step) OVER (ORDER BY step), step - 1)) / 2.0::DOUBLE / {steps} AS cut, coalesce(sum(a) OVER before, 0) AS a, coalesce(sum(r) OVER before, 0) AS r,
        sum(a) OVER () AS all_a, sum(r) OVER () AS all_r
    FROM step WINDOW before AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), threshold AS (
    SELECT cut FROM below WHERE all_a > 0 AND all_r > 0
    ORDER BY (all_a - a) / all_a::DOUBLE + r / all_r::DOUBLE DESC, abs(cut), cut DESC LIMIT 1
)
SELECT page_id, page.host, page.path, rule,
    coalesce(verdict, CASE WHEN score >= coalesce((SELECT cut FROM threshold), 0) THEN 'allow' ELSE 'block' END) AS verdict,
    round(score, 6) AS score
FROM page JOIN url USING (url) JOIN score USING (url)
"""


CONVERSATIONS = """
WITH turn AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place FROM turn
), so_far AS (
    SELECT conv_id, place, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY place) AS turns,
        count(*) OVER (PARTITION BY conv_id) AS n_turns
    FROM placed
), content AS (
    SELECT turns, min(conv_id) AS conv_id, n_turns, count(*) AS n_copies FROM so_far WHERE place = n_turns GROUP BY turns, n_turns
), kept AS (
    SELECT * FROM content WHERE NOT EXISTS (
        SELECT 1 FROM so_far WHERE so_far.place < so_far.n_turns AND so_far.turns = content.turns)
)
SELECT placed.conv_id, n_turns, n_copies, string_agg(
    '<|' || coalesce(nullif(lower(trim(role)), ''), 'user') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10),
    '' ORDER BY place) AS rendered
FROM placed JOIN kept ON placed.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY placed.conv_id, n_turns, n_copies
"""

CONTAMINATION = f"""
WITH item AS (
    SELECT item_id, {_alphanumeric('text')} AS words FROM benchmark
), shaped AS (
    SELECT item_id, words, least(13, len(words)) AS n FROM item WHERE len(words) > 0
), item_window AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS text
    FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM shaped)
), doc AS (
    SELECT row_number() OVER () AS row, doc_id, {_alphanumeric('text')} AS words FROM documents
), size AS (
    SELECT DISTINCT n FROM item_window
), found AS (
    SELECT row, i, n, array_to_string(words[i : i + n - 1], ' ') AS text
    FROM (SELECT row, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM doc, size WHERE len(words) >= n)
), hit AS (
    SELECT f.row, f.i, f.n, w.item_id FROM found f JOIN item_window w ON f.text = w.text AND f.n = w.n
), word AS (
    SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS place FROM hit) GROUP BY row
), listed AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN word USING (row) LEFT JOIN listed USING (row)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, {_spaced('text')} AS words FROM documents
), shingle AS MATERIALIZED (
    SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS shingle
        FROM doc WHERE len(words) > 1
        UNION ALL SELECT doc_id, words[1] FROM doc WHERE len(words) = 1)
), size AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingle x JOIN shingle y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM shared JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id
    WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), edge AS MATERIALIZED (
    SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
    SELECT DISTINCT a, a AS b FROM edge
    UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a
), component AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
    doc_id = coalesce(component_id, doc_id) AS kept
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN component USING (doc_id)
"""

NEGATIVES = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, a.vector AS anchor, a.label AS anchor_label, o.vec_id, o.label = a.label AS alike,
        CAST(coalesce(list_sum(list_transform(range(1, len(a.vector) + 1), lambda i: a.vector[i] * o.vector[i])), 0) AS BIGINT) AS score
    FROM v a JOIN v o ON a.vec_id <> o.vec_id AND len(a.vector) = len(o.vector) WHERE a.vec_id % 50 = 0
), positive AS (
    SELECT anchor_id, anchor, anchor_label, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor, anchor_label ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (
        PARTITION BY anchor_id, anchor, anchor_label, positive_id, positive_score ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id, anchor, anchor_label)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

FILTER_AUDIT = r"""
WITH doc AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), mark AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), smallest AS (
    SELECT text, min(doc_id) AS doc_id FROM doc GROUP BY text
), cell AS (
    SELECT part, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
            100 * length(regexp_replace(doc.text, '[^A-Z]', '', 'g')) > 10 * length(doc.text),
            regexp_matches(doc.text, '[#$%&*|]'), coalesce(doc.doc_id > smallest.doc_id, false)] AS fails,
        count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM doc JOIN smallest ON doc.text = smallest.text LEFT JOIN mark ON doc.doc_id = mark.doc_id
    GROUP BY ALL
), letter AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), filter_orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step, instr('ABCDE', filter_order[step]) AS this,
        list_transform(range(1, step), lambda i: instr('ABCDE', filter_order[i])) AS before
    FROM filter_orders, (SELECT unnest(range(1, 6)) AS step)
), judged AS (
    SELECT part, filter_order, step, this, n, good, toxic, fails[this] AS failing,
        len(list_filter(before, lambda f: fails[f])) > 0 AS gone, len(list_filter(fails, lambda f: f)) AS n_fails
    FROM steps, cell
), audited AS (
    SELECT part, filter_order, step, this, sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN failing AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
    FROM judged GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, this) AS BIGINT) AS shapley
FROM audited
"""


def oracles() -> dict[str, str]:
    return {
        "op1_multi_index_hashing": NEAREST,
        "op3_rare_token_licenses": LICENSES,
        "op4_character_model_urls": _urls(),
        "op7_snapshot_collapse": CONVERSATIONS,
        "op8_prefix_filtered_decontamination": CONTAMINATION,
        "op10_tensored_minhash_near_duplicates": NEAR_DUPLICATES,
        "op11_coordinate_pruned_negatives": NEGATIVES,
        "op12_filter_interaction_audit": FILTER_AUDIT,
    }
