"""DuckDB SQL twins of the registered queries (the correctness oracle).

Plain CTE chains over the driver's tables. The gain ratio is in textbook form (the DataFrame
code uses counts); fixed values (character classes, stop words, the stemmer's suffix tables) are
shared, so they are checked by the hand cases and the golden stems instead. Regex classes spell Java's ``\\s`` out as ``[ \\t\\n\\x0B\\f\\r]`` because RE2's
``\\s`` lacks ``\\x0B``. The forest twin unrolls the level loop into CTEs.
"""

from __future__ import annotations

from sylvan.functions.text import ACCENT_CLASS, SPARK_ENGLISH_STOP_WORDS, SPLIT_SEED, STOP_ENTROPY, TRAIN_SHARE
from sylvan.sources.tables import PROFILES

WS = "[ \\t\\n\\x0B\\f\\r]"
NOT_LETTER_OR_WS = "[^a-zA-Z \\t\\n\\x0B\\f\\r]"

RAW = {
    "lang": "SELECT doc_id, text, lang AS label FROM documents",
    "toxic": "SELECT d.doc_id, d.text, CAST(l.toxic AS VARCHAR) AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "quality": "SELECT d.doc_id, d.text, CAST(l.quality AS VARCHAR) AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "role": "SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS doc_id, text, role AS label FROM conversations",
}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(xs) -> str:
    return "[" + ", ".join(q(x) for x in xs) + "]"


def clean_text_sql(col: str) -> str:
    inner = f"regexp_replace({col}, '{NOT_LETTER_OR_WS}', '', 'g')"
    return f"trim(lower(regexp_replace({inner}, '{WS}+', ' ', 'g')))"


def tokens_sql(col: str) -> str:
    return f"coalesce(list_filter(string_split({clean_text_sql(col)}, ' '), lambda t: t <> ''), []::VARCHAR[])"


def stop_filter_sql(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({str_list(SPARK_ENGLISH_STOP_WORDS)}, lower(t)))"


def reject_sql(col: str, drop_accented: bool) -> str:
    pred = f"NOT regexp_matches({col}, '[a-zA-Z]')"
    if drop_accented:
        pred = f"({pred} OR regexp_matches({col}, '{ACCENT_CLASS}'))"
    return f"coalesce({pred}, false)"


def is_train_sql(col: str) -> str:
    threshold = int(round(TRAIN_SHARE * 100))
    return f"((('0x' || substr(md5('{SPLIT_SEED}:' || CAST({col} AS VARCHAR)), 1, 8))::BIGINT % 100) < {threshold})"


def prep_ctes(
    profile: str = "lang", min_df: int = 50, stop_words: bool = False, drop_accented: bool | None = None, stem: bool = False
) -> str:
    """CTEs raw, f1, kept, clean, tok, sp, words, posts, vocab, base, dt, trees, sizes.

    With ``stem`` the training words are stemmed (distinct words once) and stop words,
    if on, are removed after stemming; ``tok`` then keeps the unstemmed tokens.
    """
    p = PROFILES[profile]
    acc = p.drop_accented if drop_accented is None else drop_accented
    labels = sorted(p.labels)
    toks = tokens_sql("text")
    if stop_words and not stem:
        toks = stop_filter_sql(toks)
    if stem:
        stop = f"WHERE s.stem NOT IN ({', '.join(q(x) for x in SPARK_ENGLISH_STOP_WORDS)})" if stop_words else ""
        posts = (
            f"rawposts AS (SELECT DISTINCT doc_id, label, term FROM words WHERE NOT regexp_matches(term, '^{WS}*$')),\n"
            f"dwords AS (SELECT DISTINCT term FROM rawposts),\n{stem_ctes('dwords')},\n"
            f"posts AS (SELECT DISTINCT r.doc_id, r.label, s.stem AS term FROM rawposts r JOIN stems s ON s.term = r.term {stop})"
        )
    else:
        posts = f"posts AS (SELECT DISTINCT doc_id, label, term FROM words WHERE NOT regexp_matches(term, '^{WS}*$'))"
    trees_values = ", ".join(f"({q(x)})" for x in labels)
    return f"""
raw AS ({RAW[profile]}),
f1 AS (SELECT * FROM raw WHERE label IN ({", ".join(q(x) for x in labels)})),
kept AS (SELECT * FROM f1 WHERE NOT {reject_sql("text", acc)}),
dedup AS (SELECT min(doc_id) AS doc_id FROM kept GROUP BY text, label),
clean AS (SELECT doc_id, text, label FROM kept WHERE doc_id IN (SELECT doc_id FROM dedup)),
tok AS (SELECT doc_id, label, {toks} AS tokens FROM clean),
sp AS (SELECT doc_id, label, tokens, {is_train_sql("doc_id")} AS is_train FROM tok),
words AS (SELECT doc_id, label, unnest(list_distinct(tokens)) AS term FROM sp WHERE is_train),
{posts},
vocab AS (SELECT term, count(*) AS df FROM posts GROUP BY term HAVING count(*) >= {int(min_df)}),
base AS (SELECT DISTINCT doc_id, label FROM posts),
dt AS (SELECT doc_id, term FROM posts WHERE term IN (SELECT term FROM vocab)),
trees AS (SELECT * FROM (VALUES {trees_values}) AS t(tree)),
sizes AS (SELECT t.tree AS label, CAST(coalesce(c.n, 0) AS BIGINT) AS n_train
          FROM trees t LEFT JOIN (SELECT label, count(*) AS n FROM base GROUP BY label) c ON c.label = t.tree)"""


def with_prep(body: str, **kw) -> str:
    return f"WITH {prep_ctes(**kw)}\n{body}"


# ---- entropy and scores as SQL text ---------------------------------------------------


def _h(r: str) -> str:
    return f"(CASE WHEN ({r}) > 0 THEN -({r}) * log2({r}) ELSE 0.0 END)"


def _ratio(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END)"


def entropy_sql(k: str, n: str) -> str:
    return f"({_h(_ratio(k, n))} + {_h(_ratio(f'({n}) - ({k})', n))})"


def info_sql(nv: str, kv: str, n: str) -> str:
    return f"({_ratio(nv, n)} * {entropy_sql(kv, nv)})"


def gain_ratio_sql(n: str, k: str, n1: str, k1: str) -> str:
    n0, k0 = f"(({n}) - ({n1}))", f"(({k}) - ({k1}))"
    gain = f"({entropy_sql(k, n)} - {info_sql(n1, k1, n)} - {info_sql(n0, k0, n)})"
    return f"(CASE WHEN ({n1}) > 0 AND {n0} > 0 THEN {gain} / {entropy_sql(n1, n)} END)"


def mr_score_sql(n: str, k: str, n1: str, k1: str) -> str:
    n0, k0 = f"(({n}) - ({n1}))", f"(({k}) - ({k1}))"
    has1, has0 = f"(({n1}) - ({k1}) > 0)", f"({n0} - {k0} > 0)"
    return (
        f"(CASE WHEN {has1} AND {has0} THEN {gain_ratio_sql(n, k, n1, k1)} WHEN {has1} THEN {info_sql(n1, k1, n)} "
        f"WHEN {has0} THEN {info_sql(n0, k0, n)} END)"
    )


def majority_sql(n: str, k: str, tree: str) -> str:
    return f"(CASE WHEN ({k}) * 2 > ({n}) THEN {tree} ELSE 'Other' END)"


# ---- the forest, unrolled ---------------------------------------------------------------


def forest_ctes(rule: str, max_depth: int, trees_filter: list[str] | None = None) -> str:
    """CTEs nodes_all (tree, node, depth, term, score, n, k, is_leaf, label) after the prep CTEs."""
    tf = f"WHERE tree IN ({', '.join(q(t) for t in trees_filter)})" if trees_filter else ""
    parts = [
        f"ftrees AS (SELECT tree FROM trees {tf})",
        "vsize AS (SELECT count(*) AS v FROM vocab)",
        "a0 AS (SELECT b.doc_id, t.tree, '' AS node, CASE WHEN b.label = t.tree THEN 1 ELSE 0 END AS y "
        "FROM base b CROSS JOIN ftrees t)",
        "fr0 AS (SELECT t.tree, '' AS node, 0 AS depth, (SELECT count(*) FROM base) AS n, "
        "coalesce((SELECT sum(y) FROM a0 WHERE a0.tree = t.tree), 0) AS k, []::VARCHAR[] AS path_terms FROM ftrees t)",
    ]
    levels = []
    for d in range(max_depth + 1):
        stop = f"(depth >= {max_depth} OR {entropy_sql('k', 'n')} <= {STOP_ENTROPY}"
        if rule == "mr":
            stop += " OR (SELECT v FROM vsize) - depth <= 1"
        stop += ")"
        leaf_cols = (
            f"tree, node, depth, CAST(NULL AS VARCHAR) AS term, CAST(NULL AS DOUBLE) AS score, n, k, true AS is_leaf, "
            f"{majority_sql('n', 'k', 'tree')} AS label, CAST(NULL AS BIGINT) AS n1, CAST(NULL AS BIGINT) AS k1, path_terms"
        )
        parts.append(f"cl{d} AS (SELECT {leaf_cols} FROM fr{d} WHERE {stop})")
        parts.append(f"op{d} AS (SELECT * FROM fr{d} WHERE NOT {stop})")
        parts.append(
            f"st{d} AS (SELECT a.tree, a.node, x.term, count(*) AS n1, sum(a.y) AS k1 FROM a{d} a "
            f"JOIN op{d} o ON a.tree = o.tree AND a.node = o.node JOIN dt x ON x.doc_id = a.doc_id "
            f"GROUP BY a.tree, a.node, x.term)"
        )
        if rule == "c45":
            parts.append(
                f"ca{d} AS (SELECT * FROM (SELECT s.tree, s.node, s.term, s.n1, s.k1, o.n, o.k, 0 AS pseudo, "
                f"{gain_ratio_sql('o.n', 'o.k', 's.n1', 's.k1')} AS score FROM st{d} s JOIN op{d} o "
                f"ON s.tree = o.tree AND s.node = o.node) WHERE score IS NOT NULL AND round(score, 12) > 0)"
            )
        else:
            parts.append(
                f"re{d} AS (SELECT s.tree, s.node, s.term, s.n1, s.k1, o.n, o.k FROM st{d} s JOIN op{d} o "
                f"ON s.tree = o.tree AND s.node = o.node WHERE NOT list_contains(o.path_terms, s.term))"
            )
            parts.append(
                f"ps{d} AS (SELECT o.tree, o.node, CAST(NULL AS VARCHAR) AS term, 0 AS n1, 0 AS k1, o.n, o.k FROM op{d} o "
                f"WHERE (SELECT v FROM vsize) - len(o.path_terms) - "
                f"(SELECT count(*) FROM re{d} r WHERE r.tree = o.tree AND r.node = o.node) > 0)"
            )
            parts.append(
                f"ca{d} AS (SELECT * FROM (SELECT tree, node, term, n1, k1, n, k, 0 AS pseudo, "
                f"{mr_score_sql('n', 'k', 'n1', 'k1')} AS score FROM re{d} UNION ALL "
                f"SELECT tree, node, term, n1, k1, n, k, 1 AS pseudo, {mr_score_sql('n', 'k', 'n1', 'k1')} AS score "
                f"FROM ps{d}) WHERE score IS NOT NULL)"
            )
        parts.append(
            f"bs{d} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree, node "
            f"ORDER BY round(score, 12) DESC, pseudo, term) AS rn FROM ca{d}) WHERE rn = 1)"
        )
        if rule == "c45":
            ok = "b.term IS NOT NULL"
        else:
            ok = (
                "(b.term IS NOT NULL AND b.pseudo = 0 AND b.n1 - b.k1 > 0 AND (o.n - b.n1) - (o.k - b.k1) > 0)"
            )
        parts.append(
            f"dc{d} AS (SELECT o.tree, o.node, o.depth, o.n, o.k, o.path_terms, b.term, b.score, b.n1, b.k1, "
            f"coalesce({ok}, false) AS split FROM op{d} o LEFT JOIN bs{d} b ON b.tree = o.tree AND b.node = o.node)"
        )
        parts.append(
            f"nd{d} AS (SELECT {leaf_cols.replace(', path_terms', ', path_terms')} FROM cl{d} "
            f"UNION ALL SELECT tree, node, depth, CASE WHEN split THEN term END, CASE WHEN split THEN score END, n, k, "
            f"NOT split, CASE WHEN split THEN NULL ELSE {majority_sql('n', 'k', 'tree')} END, "
            f"CASE WHEN split THEN n1 END, CASE WHEN split THEN k1 END, path_terms FROM dc{d})"
        )
        levels.append(f"nd{d}")
        if d == max_depth:
            break
        parts.append(f"sx{d} AS (SELECT * FROM nd{d} WHERE NOT is_leaf)")
        parts.append(
            f"a{d + 1} AS (SELECT a.doc_id, a.tree, a.node || CASE WHEN x.doc_id IS NOT NULL THEN 'L' ELSE 'R' END AS node, a.y "
            f"FROM a{d} a JOIN sx{d} s ON a.tree = s.tree AND a.node = s.node "
            f"LEFT JOIN dt x ON x.doc_id = a.doc_id AND x.term = s.term)"
        )
        parts.append(
            f"fr{d + 1} AS (SELECT tree, node || 'L' AS node, depth + 1 AS depth, n1 AS n, k1 AS k, "
            f"list_append(path_terms, term) AS path_terms FROM sx{d} UNION ALL "
            f"SELECT tree, node || 'R', depth + 1, n - n1, k - k1, list_append(path_terms, term) FROM sx{d})"
        )
    union = " UNION ALL ".join(
        f"SELECT tree, node, depth, term, score, n, k, is_leaf, label FROM {x}" for x in levels
    )
    parts.append(f"nodes_all AS ({union})")
    return ",\n".join(parts)


def forest_sql(body: str, rule: str, max_depth: int, trees_filter=None, **prep) -> str:
    """``body`` may refer to ``nodes_all`` and to every prep CTE."""
    return f"WITH {prep_ctes(**prep)},\n{forest_ctes(rule, max_depth, trees_filter)}\n{body}"


NODE_OUT = (
    "SELECT tree, node, CAST(depth AS BIGINT) AS depth, term, round(score, 6) AS score, CAST(n AS BIGINT) AS n, "
    "CAST(k AS BIGINT) AS k, is_leaf, label FROM nodes_all"
)


def predict_ctes(max_depth: int, stem: bool = False, stop_words: bool = False) -> str:
    """Walk the test rows through ``nodes_all`` (max_depth steps), then vote."""
    if stem:
        stop = f"WHERE s.stem NOT IN ({', '.join(q(x) for x in SPARK_ENGLISH_STOP_WORDS)})" if stop_words else ""
        parts = [
            "tw AS (SELECT doc_id, unnest(list_distinct(tokens)) AS term FROM sp WHERE NOT is_train)",
            "twd AS (SELECT DISTINCT term FROM tw)",
            stem_ctes("twd", "tstems"),
            f"tws AS (SELECT t.doc_id, list(DISTINCT s.stem) AS terms FROM tw t JOIN tstems s ON s.term = t.term {stop} "
            "GROUP BY t.doc_id)",
            "tst AS (SELECT p.doc_id, p.label, coalesce(w.terms, []::VARCHAR[]) AS terms FROM sp p "
            "LEFT JOIN tws w ON w.doc_id = p.doc_id WHERE NOT p.is_train)",
        ]
    else:
        parts = ["tst AS (SELECT doc_id, label, list_distinct(tokens) AS terms FROM sp WHERE NOT is_train)"]
    parts += [
        "w0 AS (SELECT s.doc_id, s.terms, t.tree, '' AS node FROM tst s CROSS JOIN trees t)",
    ]
    for d in range(max_depth):
        parts.append(
            f"w{d + 1} AS (SELECT w.doc_id, w.terms, w.tree, CASE WHEN n.is_leaf OR n.is_leaf IS NULL THEN w.node "
            f"ELSE w.node || CASE WHEN list_contains(w.terms, n.term) THEN 'L' ELSE 'R' END END AS node "
            f"FROM w{d} w LEFT JOIN nodes_all n ON n.tree = w.tree AND n.node = w.node)"
        )
    parts.append(
        f"preds AS (SELECT w.doc_id, w.tree, coalesce(n.label, 'Other') AS pred FROM w{max_depth} w "
        f"LEFT JOIN nodes_all n ON n.tree = w.tree AND n.node = w.node)"
    )
    parts.append(
        "ranked AS (SELECT p.doc_id, p.tree, p.pred, s.n_train FROM preds p JOIN sizes s ON s.label = p.tree)"
    )
    parts.append(
        "voted AS (SELECT doc_id, coalesce("
        "(SELECT r2.tree FROM ranked r2 WHERE r2.doc_id = r.doc_id AND r2.pred <> 'Other' "
        "ORDER BY r2.n_train DESC, r2.tree LIMIT 1), "
        "(SELECT r3.tree FROM ranked r3 WHERE r3.doc_id = r.doc_id ORDER BY r3.n_train DESC, r3.tree LIMIT 1)) AS pred "
        "FROM (SELECT DISTINCT doc_id FROM ranked) r)"
    )
    return ",\n".join(parts)


def scoring_sql(body: str, rule: str, max_depth: int, **prep) -> str:
    pc = predict_ctes(max_depth, prep.get("stem", False), prep.get("stop_words", False))
    return f"WITH {prep_ctes(**prep)},\n{forest_ctes(rule, max_depth)},\n{pc}\n{body}"


# ---- Porter stemming as a CTE chain (one CTE per step) ----------------------------------


def _stem_steps_sql() -> list[str]:
    from sylvan.functions import stem as S

    def split(w, pat, g):
        return f"regexp_extract({w}, '{pat}', {g})"

    def drop_last(w):
        return f"regexp_replace({w}, '.$', '')"

    def suffix_step(table, cond):
        pat = "^(.+?)(" + "|".join(table) + ")$"
        stem, suf = split("w", pat, 1), split("w", pat, 2)
        case = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items())
        return (
            f"CASE WHEN regexp_matches(w, '{pat}') AND regexp_matches({stem}, '{cond}') "
            f"THEN {stem} || (CASE {suf} {case} END) ELSE w END"
        )

    eding = "^(.+?)(ed|ing)$"
    st1b = split("w", eding, 1)
    s1b = (
        f"CASE WHEN regexp_matches(w, '^(.+?)eed$') THEN "
        f"(CASE WHEN regexp_matches({split('w', '^(.+?)eed$', 1)}, '{S.M_GT0}') THEN {drop_last('w')} ELSE w END) "
        f"WHEN regexp_matches(w, '{eding}') AND regexp_matches({st1b}, '{S.HAS_VOWEL}') THEN "
        f"(CASE WHEN regexp_matches({st1b}, '(at|bl|iz)$') THEN {st1b} || 'e' "
        f"WHEN regexp_matches({st1b}, '{S.DOUBLE_END}') THEN {drop_last(st1b)} "
        f"WHEN regexp_matches({st1b}, '{S.CVC}') THEN {st1b} || 'e' ELSE {st1b} END) ELSE w END"
    )
    st1c = split("w", "^(.+?)y$", 1)
    s1c = f"CASE WHEN regexp_matches(w, '^(.+?)y$') AND regexp_matches({st1c}, '{S.HAS_VOWEL}') THEN {st1c} || 'i' ELSE w END"
    p4 = "^(.+?)(" + "|".join(S.STEP4) + ")$"
    p4i = "^(.+?)(s|t)(ion)$"
    st4, st4i = split("w", p4, 1), f"({split('w', p4i, 1)} || {split('w', p4i, 2)})"
    s4 = (
        f"CASE WHEN regexp_matches(w, '{p4}') THEN (CASE WHEN regexp_matches({st4}, '{S.M_GT1}') THEN {st4} ELSE w END) "
        f"WHEN regexp_matches(w, '{p4i}') AND regexp_matches({st4i}, '{S.M_GT1}') THEN {st4i} ELSE w END"
    )
    st5 = split("w", "^(.+?)e$", 1)
    s5 = (
        f"CASE WHEN regexp_matches(w, '^(.+?)e$') AND (regexp_matches({st5}, '{S.M_GT1}') OR "
        f"(regexp_matches({st5}, '{S.M_EQ1}') AND NOT regexp_matches({st5}, '{S.CVC}'))) THEN {st5} ELSE w END"
    )
    s5b = f"CASE WHEN regexp_matches(w, 'll$') AND regexp_matches(w, '{S.M_GT1}') THEN {drop_last('w')} ELSE w END"
    s1a = (
        "CASE WHEN regexp_matches(w, '^(.+?)(ss|i)es$') THEN regexp_replace(w, '^(.+?)(ss|i)es$', '\\1\\2') "
        "WHEN regexp_matches(w, '^(.+?)([^s])s$') THEN regexp_replace(w, '^(.+?)([^s])s$', '\\1\\2') ELSE w END"
    )
    return [s1a, s1b, s1c, suffix_step(S.STEP2, S.M_GT0), suffix_step(S.STEP3, S.M_GT0), s4, s5, s5b]


def stem_ctes(source: str, out: str = "stems") -> str:
    """CTEs ``{out}(term, stem)`` from a CTE/table ``source`` with a ``term`` column (distinct words)."""
    parts = [f"{out}_0 AS (SELECT term, regexp_replace(term, '^y', 'Y') AS w FROM {source})"]
    for i, expr in enumerate(_stem_steps_sql(), start=1):
        parts.append(f"{out}_{i} AS (SELECT term, {expr} AS w FROM {out}_{i - 1})")
    last = len(parts) - 1
    parts.append(f"{out} AS (SELECT term, CASE WHEN length(term) < 3 THEN term ELSE lower(w) END AS stem FROM {out}_{last})")
    return ",\n".join(parts)
