"""DuckDB SQL twin per registered query (same output names and types as ``queries``)."""

from __future__ import annotations

from sylvan.plans.sql_twins import (
    NODE_OUT,
    RAW,
    entropy_sql,
    forest_sql,
    gain_ratio_sql,
    is_train_sql,
    majority_sql,
    mr_score_sql,
    q,
    reject_sql,
    scoring_sql,
    stem_ctes,
    stop_filter_sql,
    clean_text_sql,
    with_prep,
)
from sylvan.functions.text import ACCENT_CLASS, SPARK_ENGLISH_STOP_WORDS
from sylvan.sources.tables import PROFILES

_LANG_LABELS = ", ".join(q(x) for x in sorted(PROFILES["lang"].labels))
_F1 = f"SELECT * FROM ({RAW['lang']}) WHERE label IN ({_LANG_LABELS})"

ROOT = """
root AS (SELECT label AS tree, (SELECT count(*) FROM base) AS n, n_train AS k FROM sizes),
rstats AS (SELECT t.tree, d.term, count(*) AS n1,
                  sum(CASE WHEN b.label = t.tree THEN 1 ELSE 0 END) AS k1
           FROM dt d JOIN base b ON b.doc_id = d.doc_id CROSS JOIN trees t GROUP BY t.tree, d.term),
rs AS (SELECT s.tree, s.term, CAST(r.n AS BIGINT) AS n, CAST(r.k AS BIGINT) AS k,
              CAST(s.n1 AS BIGINT) AS n1, CAST(s.k1 AS BIGINT) AS k1 FROM rstats s JOIN root r ON r.tree = s.tree),
rc AS (SELECT * FROM (SELECT tree, term, {gr} AS score FROM rs) WHERE score IS NOT NULL AND round(score, 12) > 0),
rk AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY round(score, 12) DESC, term) AS rank FROM rc)
""".format(gr=gain_ratio_sql("n", "k", "n1", "k1"))


def _root(body: str) -> str:
    return with_prep("," + ROOT + body)


def _with(body: str, **kw) -> str:
    return with_prep(body, **kw)


_BARE = (
    f"SELECT doc_id, label, CASE WHEN label = 'es' THEN regexp_replace(text, '[a-zA-Z]', '', 'g') ELSE text END AS text FROM ({_F1})"
)


def _stem_stages(stop_first: bool) -> str:
    """Token arrays stemmed word by word, stop words dropped before or after."""
    before = f"WHERE term NOT IN ({_STOP})" if stop_first else ""
    after = "" if stop_first else f" FILTER (WHERE s.stem NOT IN ({_STOP}))"
    return _with(
        ",\ntw AS (SELECT * FROM (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM tok) "
        f"{before}),\ndw AS (SELECT DISTINCT term FROM tw),\n{stem_ctes('dw', 'ts')},\n"
        f"st AS (SELECT w.doc_id, string_agg(s.stem, ' ' ORDER BY w.pos){after} AS tokens FROM tw w JOIN ts s ON s.term = w.term "
        "GROUP BY w.doc_id)\nSELECT t.doc_id, t.label, coalesce(st.tokens, '') AS tokens FROM tok t LEFT JOIN st ON st.doc_id = t.doc_id"
    )


_STOP = ", ".join(q(x) for x in SPARK_ENGLISH_STOP_WORDS)
# every training row with every vocabulary word, numbered in order
_GRID = """
tv AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS id FROM vocab),
grid AS (SELECT b.doc_id, b.label, t.term, t.id, CASE WHEN d.term IS NULL THEN 0 ELSE 1 END AS value
         FROM base b CROSS JOIN tv t LEFT JOIN dt d ON d.doc_id = b.doc_id AND d.term = t.term)"""

_ACC = (
    "SELECT CAST(count(*) AS BIGINT) AS n_test, "
    "CAST(sum(CASE WHEN v.pred = t.label THEN 1 ELSE 0 END) AS BIGINT) AS n_correct, "
    "round(avg(CASE WHEN v.pred = t.label THEN 1.0 ELSE 0.0 END), 6) AS accuracy "
    "FROM tst t LEFT JOIN voted v ON v.doc_id = t.doc_id"
)

_KEPT_IDS = f"""
SELECT own_id, label, md5(text) AS text_md5, row_key, {is_train_sql("row_key")} AS is_train FROM (
  SELECT own_id, label, text,
         sha256('t' || sha256(text) || '|' || coalesce('i' || CAST(own_id AS VARCHAR), '-') || '|' || 'l' || label) AS row_key
  FROM (SELECT min(CASE WHEN doc_id % 7 <> 3 THEN doc_id // 2 END) AS own_id, label, text
        FROM ({_F1}) WHERE NOT {reject_sql("text", False)} GROUP BY label, text))
"""

SQL = {
    "clean_row_identity": _KEPT_IDS,
    "clean_topic_filter": f"SELECT doc_id, label FROM ({_F1})",
    "clean_no_alpha": f"SELECT doc_id, label FROM ({_F1}) WHERE NOT regexp_matches(text, '[a-zA-Z]')",
    "clean_accented": f"SELECT doc_id, label FROM ({_F1}) WHERE regexp_matches(text, '{ACCENT_CLASS}')",
    "clean_rejects": (
        f"SELECT doc_id, label FROM ({_F1}) WHERE NOT regexp_matches(text, '[a-zA-Z]') "
        f"UNION ALL SELECT doc_id, label FROM ({_F1}) WHERE regexp_matches(text, '{ACCENT_CLASS}')"
    ),
    "clean_topic_subset": f"SELECT doc_id, label FROM ({RAW['lang']}) WHERE label IN ('en', 'fr')",
    "clean_no_alpha_caught": f"SELECT doc_id, label FROM ({_BARE}) WHERE NOT regexp_matches(text, '[a-zA-Z]')",
    "clean_rejects_caught": (
        f"SELECT doc_id, label FROM ({_BARE}) WHERE NOT regexp_matches(text, '[a-zA-Z]') "
        f"UNION ALL SELECT doc_id, label FROM ({_BARE}) WHERE regexp_matches(text, '{ACCENT_CLASS}')"
    ),
    "token_stages_stemmed": _stem_stages(False),
    "token_stages_stop_first": _stem_stages(True),
    "clean_except": _with("SELECT doc_id, label FROM clean", drop_accented=True),
    "clean_text": _with(f"SELECT doc_id, label, {clean_text_sql('text')} AS clean_text FROM clean"),
    "tokenize": _with("SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM tok"),
    "remove_stop_words": _with(
        f"SELECT doc_id, CAST(len({stop_filter_sql('tokens')}) AS BIGINT) AS n_tokens, "
        f"array_to_string({stop_filter_sql('tokens')}, ' ') AS tokens FROM tok"
    ),
    "token_stages": _with("SELECT doc_id, label, array_to_string(tokens, ' ') AS tokens FROM tok", stop_words=True),
    "train_test_split": _with("SELECT doc_id, is_train FROM sp"),
    "doc_index": _with(
        "SELECT doc_id, label, md5(array_to_string(tokens, ' ')) AS tokens_md5, "
        "CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS idx FROM tok"
    ),
    "label_index": _with(
        "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS label_index FROM (SELECT DISTINCT label FROM tok)"
    ),
    "postings": _with("SELECT doc_id, label, term FROM posts"),
    "vocabulary": _with("SELECT term, CAST(df AS BIGINT) AS df FROM vocab"),
    "postings_in_vocab": _with("SELECT doc_id, term FROM dt"),
    "doc_terms": _with(
        "SELECT b.doc_id, b.label, coalesce(string_agg(d.term, ' ' ORDER BY d.term), '') AS terms "
        "FROM base b LEFT JOIN dt d ON d.doc_id = b.doc_id GROUP BY b.doc_id, b.label"
    ),
    "class_sizes": _with("SELECT label, n_train FROM sizes"),
    "one_vs_rest": _with(
        "SELECT b.doc_id, t.tree, CASE WHEN b.label = t.tree THEN t.tree ELSE 'Other' END AS ovr_label "
        "FROM base b CROSS JOIN trees t"
    ),
    "matrix_summary": _with(
        "SELECT (SELECT CAST(count(*) AS BIGINT) FROM base) AS n_docs, (SELECT CAST(count(*) AS BIGINT) FROM vocab) AS n_terms, "
        "(SELECT CAST(count(*) AS BIGINT) FROM dt) AS n_postings"
    ),
    "term_pivot": _with(
        "," + _GRID + "\nSELECT doc_id, label, CAST(id // 256 AS BIGINT) AS block, string_agg(CAST(value AS VARCHAR), ' ' ORDER BY id) AS vals "
        "FROM grid GROUP BY doc_id, label, id // 256"
    ),
    "term_unpivot": _with("," + _GRID + "\nSELECT doc_id, label, term, CAST(value AS BIGINT) AS value FROM grid"),
    "label_codes": _with(
        ",\nli AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS i FROM (SELECT DISTINCT label FROM tok))\n"
        "SELECT t.doc_id, CAST(li.i AS BIGINT) AS label_index, t.label AS decoded_label FROM tok t JOIN li ON li.label = t.label"
    ),
    "entropy": _root(f"SELECT tree, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS k, round({entropy_sql('k', 'n')}, 6) AS entropy FROM root"),
    "leaf_label": _root(f"SELECT tree, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS k, {majority_sql('n', 'k', 'tree')} AS label FROM root"),
    "split_stats": _root("SELECT tree, term, n, k, n1, k1 FROM rs"),
    "gain_ratio": _root(
        f"SELECT tree, term, round({gain_ratio_sql('n', 'k', 'n1', 'k1')}, 6) AS score_c45, "
        f"round({mr_score_sql('n', 'k', 'n1', 'k1')}, 6) AS score_mr FROM rs"
    ),
    "best_split": _root("SELECT tree, term, round(score, 6) AS score FROM rk WHERE rank = 1"),
    "top_splits": _root("SELECT tree, CAST(rank AS BIGINT) AS rank, term, round(score, 6) AS score FROM rk WHERE rank <= 5"),
    "forest_c45_depth2": forest_sql(NODE_OUT, "c45", 2),
    "forest_mr_depth3": forest_sql(NODE_OUT, "mr", 3),
    "tree_c45_depth3": forest_sql(NODE_OUT, "c45", 3, trees_filter=["1"], profile="quality", min_df=10),
    "tree_mr_depth3": forest_sql(NODE_OUT, "mr", 3, trees_filter=["user"], profile="role", min_df=10),
    "forest_toxic_c45_depth3": forest_sql(NODE_OUT, "c45", 3, profile="toxic", min_df=10),
    "node_stats": forest_sql(
        f"SELECT tree, node, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS k, round({entropy_sql('k', 'n')}, 6) AS entropy, "
        "is_leaf FROM nodes_all",
        "c45",
        3,
    ),
    "tree_rules": forest_sql("SELECT tree, node, repeat('| ', depth) || coalesce(term, label) AS line FROM nodes_all", "c45", 3),
    "route_level": forest_sql(
        "SELECT doc_id, tree, node FROM a1", "c45", 1
    ),
    "route_two_levels": forest_sql("SELECT doc_id, tree, node FROM a2", "c45", 2),
    "forest_job_defaults": forest_sql(NODE_OUT, "mr", 20, stem=True, stop_words=True, min_df=200),
    "accuracy_job_defaults": scoring_sql(_ACC, "mr", 20, stem=True, stop_words=True, min_df=200),
    "forest_role_c45_depth8": forest_sql(NODE_OUT, "c45", 8, profile="role", min_df=10),
    "job_from_csv": scoring_sql(_ACC, "mr", 3, stem=True, stop_words=True),
    "job_toxic_store": scoring_sql(_ACC, "c45", 3, profile="toxic", min_df=10),
    "tree_predict": scoring_sql("SELECT doc_id, tree, pred FROM preds", "c45", 3),
    "forest_predict": scoring_sql("SELECT doc_id, pred FROM voted", "c45", 3),
    "accuracy": scoring_sql(_ACC, "c45", 3),
    "forest_store_roundtrip": forest_sql(
        "SELECT 'c45' AS rule, tree, node, CAST(depth AS BIGINT) AS depth, term, round(score, 6) AS score, is_leaf, label FROM nodes_all",
        "c45",
        2,
    ),
    "io_csv_roundtrip": _with("SELECT doc_id, label, md5(text) AS text_md5 FROM clean"),
    "stem_vocabulary": _with(",\ndwv AS (SELECT DISTINCT term FROM posts),\n" + stem_ctes("dwv", "sv") + "\nSELECT term, stem FROM sv"),
    "forest_c45_stemmed_depth2": forest_sql(NODE_OUT, "c45", 2, stem=True, stop_words=True),
    "accuracy_mr_stemmed": scoring_sql(_ACC, "mr", 3, stem=True, stop_words=True),
    "job_compute_then_load": scoring_sql(_ACC, "mr", 3, stem=True, stop_words=True),
    "io_json_inferred": (
        "SELECT doc_id, CASE lang WHEN 'en' THEN CAST(n_chars AS DOUBLE) WHEN 'fr' THEN n_chars / CAST(2 AS DOUBLE) END AS n, "
        "CASE WHEN lang = 'en' THEN lang WHEN lang IN ('fr', 'de') THEN NULL ELSE CAST(length(lang) AS VARCHAR) END AS lang, "
        "CASE WHEN lang = 'fr' THEN source END AS source, CASE WHEN lang = 'de' THEN source || ',' || lang END AS tags FROM documents"
    ),
    "io_json_roundtrip": _with("SELECT doc_id, label, array_to_string(tokens, ' ') AS tokens FROM sp WHERE NOT is_train"),
}
