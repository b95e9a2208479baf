"""DuckDB twins of the operators' queries (those that SQL can express).

Written from the definitions, not from the operators' code: only parameters are repeated. The
other queries (Aho-Corasick labels, BPE counts, wrapper induction, Viterbi, XXH64 components,
BPE codes) have none; the tests hold them against brute force.
"""

from __future__ import annotations

WORD = r"'[^\x20\x09-\x0D]+'"


def _merkle() -> str:
    blocks = (
        "list_transform(range(1, len(string_split(p, ' ')) + 1, 8), "
        "lambda i: sha256(array_to_string(list_slice(string_split(p, ' '), i, i + 7), ' ')))"
    )
    tree = (
        "list_transform(string_split(txt, chr(10) || chr(10)), "
        f"lambda s: list_transform(string_split(s, chr(10)), lambda p: {blocks}))"
    )
    paragraphs = "list_transform(s, lambda p: sha256('p' || array_to_string(p, '')))"
    sections = f"list_transform(tree, lambda s: sha256('s' || array_to_string({paragraphs}, '')))"

    def like(b: str) -> str:
        shared = f"2::DOUBLE * len(list_intersect(o.tags, {b}.tags)) / (len(o.tags) + len({b}.tags))"
        leaves = f"2::DOUBLE * least(o.n, {b}.n) / (o.n + {b}.n)"
        return f"CASE WHEN o.root = {b}.root THEN 1::DOUBLE ELSE least({shared}, {leaves}, 1 - 1::DOUBLE / (o.n + {b}.n)) END"

    longer = lambda a, b: f"greatest(coalesce(len({a}), 0), coalesce(len({b}), 0))"
    inside = (
        f"list_transform(list_filter(range({longer('o.ph[i + 1]', 'e.ph[i + 1]')}), "
        "lambda j: o.ph[i + 1][j + 1] IS DISTINCT FROM e.ph[i + 1][j + 1]), lambda j: i || ':' || j)"
    )
    edits = (
        f"flatten(list_transform(list_filter(range({longer('o.sh', 'e.sh')}), "
        f"lambda i: o.sh[i + 1] IS DISTINCT FROM e.sh[i + 1]), lambda i: {inside}))"
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
nx AS (
  SELECT doc_id, t, n, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt,
         coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_doc_id
  FROM d WINDOW w AS (ORDER BY doc_id)),
ed AS (SELECT *, substring(t, 1, n - n // 2) || substring(nt, 1, n // 2) AS edited FROM nx),
x AS (SELECT doc_id, 'own' AS part, t AS txt FROM ed UNION ALL SELECT doc_id, 'edited', edited FROM ed
      UNION ALL SELECT doc_id, 'next', nt FROM ed),
tr AS (SELECT doc_id, part, {tree} AS tree FROM x),
h AS (SELECT doc_id, part, sha256('r' || array_to_string({sections}, '')) AS root, {sections} AS sh,
             list_transform(tree, lambda s: {paragraphs}) AS ph, len(flatten(flatten(tree))) AS n,
             list_distinct(list_transform(flatten(flatten(tree)), lambda b: substr(b, 1, 16))) AS tags FROM tr),
l AS (SELECT ed.doc_id, ed.n, ed.edited, ed.next_doc_id, o.root AS own, e.root AS other, {like("e")} AS near_edited,
             {like("s")} AS near_next, {edits} AS edits
      FROM ed JOIN h o ON o.doc_id = ed.doc_id AND o.part = 'own' JOIN h e ON e.doc_id = ed.doc_id AND e.part = 'edited'
      JOIN h s ON s.doc_id = ed.doc_id AND s.part = 'next')
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, own AS fingerprint, other AS edited_fingerprint,
       near_edited, near_next, next_doc_id, CAST(len(edits) AS BIGINT) AS n_edited_paragraphs, edits[1] AS first_edit
FROM l
"""


def _repetition() -> str:
    limits = {5: 20, 6: 19, 7: 18, 8: 17, 9: 16, 10: 15}
    ctes, joins, cols, fails = [], [], [], []
    for n, limit in limits.items():
        gram = " || chr(1) || ".join(["word"] + [f"lead(word, {k}) OVER w" for k in range(1, n)])
        both = ", max(CASE WHEN times > 1 THEN 1 ELSE 0 END) OVER r AS again" if n == 5 else ""
        ctes.append(f"""
g{n} AS (SELECT doc_id, pos, chars, {gram} AS gram FROM w WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
f{n} AS (SELECT doc_id, pos, chars,
           CASE WHEN gram IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY doc_id, gram ORDER BY pos) END AS turn,
           CASE WHEN gram IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY doc_id, gram) END AS times FROM g{n}),
c{n} AS (SELECT doc_id, chars, max(CASE WHEN turn > 1 THEN 1 ELSE 0 END) OVER r AS later{both}
         FROM f{n} WINDOW r AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)),
s{n} AS (SELECT doc_id, sum(chars * later) AS dup{", sum(again) AS again" if n == 5 else ""} FROM c{n} GROUP BY doc_id)""")
        joins.append(f"LEFT JOIN s{n} ON s{n}.doc_id = d.doc_id")
        cols.append(f"CAST(coalesce(s{n}.dup, 0) AS BIGINT) AS dup_chars_{n}")
        fails.append(f"100 * dup_chars_{n} > {limit} * word_chars")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
ws AS (SELECT doc_id, regexp_extract_all(t, {WORD}) AS words FROM d),
w AS (SELECT doc_id, word, length(word) AS chars, pos FROM
      (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM ws)),
wt AS (SELECT doc_id, count(*) AS n_words, sum(chars) AS word_chars FROM w GROUP BY doc_id),
ls AS (SELECT doc_id, string_split(t, chr(10)) AS lines FROM d),
l AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS turn FROM
      (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM ls)
      WHERE regexp_matches(line, {WORD})),
lt AS (SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS chars
       FROM l WHERE turn > 1 GROUP BY doc_id),
{",".join(ctes)},
m AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(lt.n, 0) AS n_dup_lines, CAST(coalesce(s5.again, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(lt.chars, 0) AS BIGINT) AS dup_line_chars, {", ".join(cols)}
      FROM d LEFT JOIN wt ON wt.doc_id = d.doc_id LEFT JOIN lt ON lt.doc_id = d.doc_id {" ".join(joins)}),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * dup_line_chars > 30 * word_chars OR {" OR ".join(fails)}) AS kept, dup_line_chars,
       {", ".join(f"dup_chars_{n}" for n in limits)}
FROM b
"""


def _fixity() -> str:
    def record(html: str) -> str:
        crlf = "chr(13) || chr(10)"
        lines = [
            "'WARC/1.0'",
            "'WARC-Type: response'",
            "'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>'",
            "'WARC-Target-URI: ' || coalesce(url, '')",
            "'Content-Type: text/html'",
            f"'Content-Length: ' || strlen(coalesce({html}, ''))",
        ]
        head = f" || {crlf} || ".join(lines)
        return f"{head} || {crlf} || {crlf} || coalesce({html}, '') || {crlf} || {crlf}"

    def replica(name: str, source: str) -> str:
        """Offsets, stretches and ranges of one replica; ``{name}_range`` lists what each range holds."""
        along = "OVER (ORDER BY page_id, url, place ROWS BETWEEN UNBOUNDED PRECEDING AND {})"
        border = "opens AND ends_with(key, '0')"
        return f"""
{name}_at AS (SELECT *, coalesce(sum(length) {along.format("1 PRECEDING")}, 0) AS pos,
         key IS DISTINCT FROM lag(key) OVER (ORDER BY page_id, url, place) AS opens FROM ({source})),
{name} AS (SELECT *, coalesce(max(CASE WHEN {border} THEN pos END) {along.format("CURRENT ROW")}, 0) AS start,
         coalesce(last_value(CASE WHEN {border} THEN key END IGNORE NULLS) {along.format("CURRENT ROW")}, '') AS name FROM {name}_at),
{name}_range AS (SELECT name, (pos - start) // 65536 AS sub, string_agg((pos - start) || ':' || digest, '|' ORDER BY pos) AS holds
         FROM {name} GROUP BY ALL)"""

    changed = "substring(html, 1, length(html) // 2) || '~' || substring(html, length(html) // 2 + 2)"
    key = "substring(sha256(coalesce(CAST(page_id AS VARCHAR), '') || chr(10) || coalesce(url, '')), 1, 16)"
    return f"""
WITH r AS (SELECT page_id, url, {key} AS key, {record("html")} AS rec,
             {record(f"(CASE WHEN page_id % 97 = 13 THEN {changed} ELSE html END)")} AS held FROM pages),
p AS (SELECT page_id, url, key, CAST(strlen(rec) AS BIGINT) AS length, sha256(rec) AS sha256, CAST(strlen(held) AS BIGINT) AS other_length,
             sha256(held) AS other FROM r),
{replica("a", "SELECT *, sha256 AS place, sha256 AS digest FROM p")},
{replica("b", "SELECT page_id, url, key, sha256 AS place, other_length AS length, other AS digest FROM p WHERE page_id % 389 <> 5")}
SELECT page_id, url, CAST(pos // 1073741824 AS BIGINT) AS segment, CAST(pos % 1073741824 AS BIGINT) AS "offset", length, sha256,
       CASE WHEN page_id % 389 = 5 THEN 'missing' WHEN sha256 <> other THEN 'corrupt' ELSE 'ok' END AS status,
       CAST(start + (pos - start) // 65536 * 65536 AS BIGINT) AS range_start, x.holds IS DISTINCT FROM y.holds AS range_differs
FROM a JOIN a_range x ON x.name = a.name AND x.sub = (a.pos - a.start) // 65536
LEFT JOIN b_range y ON y.name = x.name AND y.sub = x.sub
"""


def _mixing() -> str:
    draw = "('0x' || substr(md5('mix-42|' || CAST(doc_id AS VARCHAR)), 1, 13))::BIGINT / CAST(4503599627370496 AS DOUBLE)"
    return f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORD})) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
k AS (SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS DOUBLE) AS weight,
        CAST(2 * source_size AS DOUBLE) AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS everything FROM s),
f AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source) AS place, (CAST(1.5 AS DOUBLE) * everything
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM k),
v AS (SELECT coalesce(arg_min(level, place) FILTER (weight * level < cap), 0) AS level FROM f),
t AS (SELECT k.source, source_size, least(weight * v.level, cap) AS target FROM k, v),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate, {draw} AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM c)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM n
"""


def _audit() -> str:
    letters = "(VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4)) AS {0}({0}, {0}n)"
    names = ["p", "q", "r", "s", "t"]
    distinct = " AND ".join(f"{x} <> {y}" for i, x in enumerate(names) for y in names[i + 1 :])
    fails = f"""[len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
       100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t), regexp_matches(t, '[#$%&*|]'), later]"""
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORD}) AS words
           FROM documents),
e AS (SELECT *, coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, FALSE) AS later FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, {fails} AS fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM e LEFT JOIN l ON e.doc_id = l.doc_id),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
o AS (SELECT p || q || r || s || t AS filter_order, [pn, qn, rn, sn, tn] AS line FROM {", ".join(letters.format(x) for x in names)}
      WHERE {distinct}),
k AS (SELECT filter_order, step, line[step] + 1 AS own, list_slice(line, 1, step - 1) AS before FROM o, range(1, 6) AS g(step)),
x AS (SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS fail,
             list_bool_or(list_transform(before, lambda b: fails[b + 1])) AS gone,
             len(list_filter(fails, lambda b: b)) AS failed
      FROM m, k),
y AS (SELECT part, filter_order, step, own,
        CAST(sum(CASE WHEN NOT fail AND NOT coalesce(gone, FALSE) THEN n ELSE 0 END) AS BIGINT) AS kept,
        CAST(sum(CASE WHEN fail AND NOT coalesce(gone, FALSE) THEN n ELSE 0 END) AS BIGINT) AS removed,
        CAST(sum(CASE WHEN fail AND coalesce(gone, FALSE) THEN n ELSE 0 END) AS BIGINT) AS redundant,
        CAST(sum(CASE WHEN fail AND failed = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
        CAST(sum(CASE WHEN fail AND NOT coalesce(gone, FALSE) THEN good ELSE 0 END) AS BIGINT) AS good_lost,
        CAST(sum(CASE WHEN fail AND NOT coalesce(gone, FALSE) THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
      FROM x GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM y
"""


SQL: dict[str, str] = {
    "op3_merkle_fingerprint": _merkle(),
    "op5_quality_rules": _repetition(),
    "op6_warc_fixity": _fixity(),
    "op7_source_mix": _mixing(),
    "op12_filter_audit": _audit(),
}
