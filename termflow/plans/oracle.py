"""DuckDB SQL oracles for the registered queries.

Each string runs on the driver's parquet tables registered as views and must
give the same rows as the Spark query. Doubles that come from sums are rounded
to 6 decimals on both sides (summation order differs between engines), and
``+ 0.0`` turns a rounded -0.0 into 0.0.
"""

from __future__ import annotations

from termflow.plans.catalog import (BALANCED, CONVERGE_TOL, DROPPED_K, HARD, MAIN, MICRO, NARROW, NO_TRUE_POSITIVE,
                                    SHORT_VOCAB_K, SKETCH_K)
from termflow.params import VARIANCE_KEY_DECIMALS
from termflow.plans.classify import Preset


def _r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"


def _doc_key() -> str:
    return "upper(lang) || CAST(doc_id AS VARCHAR)"


def _line() -> str:
    src = "CAST(doc_id AS VARCHAR)"
    return (f"""'<doc id="' || {_doc_key()} || '" url="doc://' || source || '/' || {src}"""
            f""" || '" title="' || source || ' ' || {src} || '">'"""
            r""" || regexp_replace(text, '[\r\n]', ' ', 'g') || '</doc>'""")


def _label(col: str, prefix: str) -> str:
    return f"CASE WHEN left({col}, {len(prefix)}) = '{prefix}' THEN 1 ELSE 0 END"


def _tokens(name: str, src: str) -> str:
    return (f"{name} AS (SELECT doc_id, lower(w) AS word FROM "
            f"(SELECT doc_id, unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS w FROM {src}))")


def _base(p: Preset) -> list[str]:
    return [
        f"docs AS (SELECT {_doc_key()} AS doc_id, doc_id AS src_id, text FROM documents)",
        f"train AS (SELECT doc_id, text FROM docs WHERE src_id % {p.test_every} <> 0)",
        f"test AS (SELECT doc_id, text FROM docs WHERE src_id % {p.test_every} = 0)",
        _tokens("train_tokens", "train"),
        _tokens("test_tokens", "test"),
        "counts AS (SELECT word, count(*) AS n FROM train_tokens GROUP BY word)",
        ("dict AS (SELECT CAST(pos AS INTEGER) AS pos, word, CAST(n AS BIGINT) AS n FROM "
         "(SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS pos FROM counts) "
         f"WHERE pos < {p.k})"),
    ]


def _tf(name: str, tokens: str) -> list[str]:
    return [
        (f"{name}_pc AS (SELECT t.doc_id, d.pos, count(*) AS n FROM {tokens} t "
         f"JOIN dict d ON t.word = d.word GROUP BY t.doc_id, d.pos)"),
        (f"{name} AS (SELECT doc_id, pos, CAST(n AS BIGINT) AS n, CAST(n AS DOUBLE) / "
         f"CAST(sum(n) OVER (PARTITION BY doc_id) AS DOUBLE) AS tf FROM {name}_pc)"),
    ]


def _selection(p: Preset) -> list[str]:
    return [
        "n_docs AS (SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) AS nd FROM tf_train)",
        "sums AS (SELECT pos, sum(tf) AS sum_tf, sum(tf * tf) AS sum_sq FROM tf_train GROUP BY pos)",
        ("stats AS (SELECT pos, sum_tf, sum_tf / nd AS mean_tf, sum_sq - sum_tf * sum_tf / nd AS ss "
         "FROM sums, n_docs)"),
        ("selected AS (SELECT CAST(new_pos AS INTEGER) AS new_pos, CAST(pos AS INTEGER) AS pos FROM "
         f"(SELECT pos, row_number() OVER (ORDER BY CAST(printf('%.{VARIANCE_KEY_DECIMALS}e', ss) AS DOUBLE) DESC, pos) - 1 "
         "AS new_pos FROM stats) "
         f"WHERE new_pos < {p.m})"),
    ]


def _sigmoid(t: str) -> str:
    return f"(CASE WHEN {t} >= 0 THEN 1.0 / (1.0 + exp(-{t})) ELSE exp({t}) / (1.0 + exp({t})) END)"


def _softplus(t: str) -> str:
    return f"(greatest({t}, 0.0) + ln(1.0 + exp(-abs({t}))))"


def _gd(p: Preset, tol: float) -> list[str]:
    """Gradient descent unrolled: one group of CTEs per iteration. An
    iteration is applied only if its update norm exceeds ``tol`` and every
    earlier one was applied; otherwise the weights stay as they were."""
    ctes = [
        f"lt AS (SELECT doc_id, pos, tf, CAST({_label('doc_id', p.prefix)} AS DOUBLE) AS y FROM tf_train)",
        "w0 AS (SELECT pos, CAST(0.0 AS DOUBLE) AS w FROM dict)",
        "a_prev AS (SELECT TRUE AS applied)",
    ]
    prev = "a_prev"
    for i in range(p.iterations):
        ctes += [
            (f"th{i} AS MATERIALIZED (SELECT lt.doc_id, max(lt.y) AS y, sum(lt.tf * w.w) AS th "
             f"FROM lt JOIN w{i} w USING (pos) GROUP BY lt.doc_id)"),
            (f"g{i} AS MATERIALIZED (SELECT lt.pos, sum(lt.tf * ({_sigmoid('th.th')} - th.y)) AS g "
             f"FROM lt JOIN th{i} th USING (doc_id) GROUP BY lt.pos)"),
            (f"n{i} AS MATERIALIZED (SELECT w.pos, w.w AS old_w, "
             f"w.w - (coalesce(g.g, 0.0) + 2.0 * {p.reg!r} * w.w) * {p.learning_rate!r} AS new_w "
             f"FROM w{i} w LEFT JOIN g{i} g USING (pos))"),
            (f"h{i} AS MATERIALIZED (SELECT {i} AS iteration, "
             f"(SELECT sum({_softplus('th')} - y * th) FROM th{i}) "
             f"+ {p.reg!r} * (SELECT sum(w * w) FROM w{i}) AS cost, "
             f"sqrt((SELECT sum((new_w - old_w) * (new_w - old_w)) FROM n{i})) AS l2)"),
            f"a{i} AS (SELECT (h.l2 > {tol!r}) AND q.applied AS applied FROM h{i} h, {prev} q)",
            (f"w{i + 1} AS MATERIALIZED (SELECT n.pos, CASE WHEN a.applied THEN n.new_w ELSE n.old_w END AS w "
             f"FROM n{i} n, a{i} a)"),
        ]
        prev = f"a{i}"
    history = " UNION ALL ".join(
        f"SELECT h.iteration, h.cost, h.l2 FROM h{i} h, a{i} a WHERE a.applied"
        for i in range(p.iterations))
    ctes.append(f"history AS ({history})")
    ctes.append(f"final_w AS (SELECT pos, w FROM w{p.iterations})")
    ctes.append(
        f"pred AS (SELECT t.doc_id, {_label('t.doc_id', p.prefix)} AS label, "
        "CASE WHEN sum(t.tf * w.w) > 0 THEN 1 ELSE 0 END AS prediction "
        "FROM tf_test t JOIN final_w w USING (pos) GROUP BY t.doc_id)")
    applied = " + ".join(f"(SELECT CAST(applied AS INTEGER) FROM a{i})" for i in range(p.iterations))
    ctes.append(f"converged AS (SELECT CAST({applied} AS INTEGER) AS iterations_applied, "
                f"NOT (SELECT applied FROM a{p.iterations - 1}) AS stopped)")
    return ctes


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _full(p: Preset, tol: float | None = None) -> list[str]:
    return (_base(p) + _tf("tf_train", "train_tokens") + _tf("tf_test", "test_tokens")
            + _selection(p) + _gd(p, p.tol if tol is None else tol))


def _conf() -> str:
    return ("conf AS (SELECT CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS p, "
            "CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n, "
            "CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
            "CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
            "CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
            "CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn "
            "FROM pred)")


def oracle_sql() -> dict[str, str]:
    p = MAIN
    base = _base(p)
    tf_tr = base + _tf("tf_train", "train_tokens")
    tf_te = base + _tf("tf_test", "test_tokens")
    sel = tf_tr + _selection(p)
    full = _full(p)
    q: dict[str, str] = {}

    q["doc_lines_scan"] = (f"SELECT CAST(count(*) AS BIGINT) AS n_lines, "
                           f"CAST(sum(length({_line()})) AS BIGINT) AS n_chars FROM documents")
    q["parse_doc_lines"] = (f"SELECT {_doc_key()} AS doc_id, "
                            r"regexp_replace(text, '[\r\n]', ' ', 'g') AS text FROM documents")
    ok = ("strpos(value, 'id=\"') > 0 AND strpos(value, '\" url=') > 0 "
          "AND strpos(value, '\">') > 0")
    q["malformed_lines"] = (
        f"SELECT CAST(sum(CASE WHEN {ok} THEN 1 ELSE 0 END) AS BIGINT) AS n_ok, "
        f"CAST(sum(CASE WHEN {ok} OR value IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS n_bad, CAST(count(*) - count(value) AS BIGINT) AS n_null FROM "
        f"(SELECT {_line()} AS value FROM documents UNION ALL SELECT html AS value FROM pages)")
    reasons = ("SELECT value, CASE WHEN value IS NULL THEN 'null line' WHEN strpos(value, 'id=\"') = 0 THEN 'no id' "
               "WHEN strpos(value, '\" url=') = 0 THEN 'no url' WHEN strpos(value, '\">') = 0 THEN 'no body' ELSE 'ok' END AS reason "
               f"FROM (SELECT {_line()} AS value FROM documents UNION ALL "
               "SELECT CASE WHEN page_id % 10 <> 0 THEN html END AS value FROM pages)")
    q["line_quarantine"] = (
        f"WITH r AS ({reasons}), n AS (SELECT count(*) FILTER (WHERE reason = 'ok') AS n_ok, "
        "count(*) FILTER (WHERE reason LIKE 'no %') AS n_bad, count(*) FILTER (WHERE value IS NULL) AS n_null FROM r) "
        "SELECT reason, count(*) AS n, any_value(n_ok) AS n_ok, any_value(n_bad) AS n_bad, any_value(n_null) AS n_null "
        "FROM r, n GROUP BY reason")
    q["line_rejects"] = (f"SELECT reason, CAST(length(value) AS BIGINT) AS n_chars, md5(value) AS line "
                         f"FROM ({reasons}) WHERE reason <> 'ok'")
    q["label_by_prefix"] = _with(base, f"SELECT doc_id, {_label('doc_id', p.prefix)} AS label FROM docs")
    q["tokenize"] = _with(base, (
        "SELECT doc_id, CAST(len(words) AS BIGINT) AS n_tokens, words[1] AS first_word, "
        "words[-1] AS last_word FROM (SELECT doc_id, "
        "list_transform(regexp_extract_all(text, '[a-zA-Z]+'), lambda x: lower(x)) AS words FROM docs)"))
    q["token_pairs"] = _with(base + [_tokens("all_tokens", "docs")],
                             "SELECT doc_id, word, count(*) AS n FROM all_tokens GROUP BY doc_id, word")
    q["word_count"] = _with(base, "SELECT word, n FROM counts")
    q["dictionary_topk"] = _with(base, "SELECT pos, word, n FROM dict")
    q["dictionary_sketch"] = _with(_base(Preset(k=SKETCH_K)), "SELECT pos, word, n FROM dict")
    q["dictionary_short_vocab"] = _with(_base(Preset(k=SHORT_VOCAB_K)), "SELECT pos, word, n FROM dict")
    q["dictionary_join"] = _with(tf_tr, "SELECT doc_id, pos, n FROM tf_train")
    q["dictionary_join_shuffled"] = q["dictionary_join"]
    q["tf_train"] = _with(tf_tr, "SELECT doc_id, pos, tf FROM tf_train")
    q["tf_test"] = _with(tf_te, "SELECT doc_id, pos, tf FROM tf_test")
    q["tf_dropped_docs"] = _with(
        _base(Preset(k=DROPPED_K)) + _tf("tf_test", "test_tokens"),
        "SELECT CAST(a.c AS BIGINT) AS n_docs, CAST(b.c AS BIGINT) AS n_with_tf, "
        "CAST(a.c - b.c AS BIGINT) AS n_dropped FROM "
        "(SELECT count(DISTINCT doc_id) AS c FROM test) a, "
        "(SELECT count(DISTINCT doc_id) AS c FROM tf_test) b")
    q["feature_stats"] = _with(sel, (
        f"SELECT pos, {_r('sum_tf')} AS sum_tf, {_r(f'mean_tf * {MICRO!r}')} AS mean_tf_micro, "
        f"{_r(f'ss * {MICRO!r}')} AS ss_micro FROM stats"))
    # Two passes: deviations of the non-zeros from their own mean, and from the mean over all documents.
    q["feature_moments"] = _with(tf_tr + [
        "n_docs AS (SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) AS nd FROM tf_train)",
        "m AS (SELECT pos, count(*) AS nnz, avg(tf) AS mean_nz, sum(tf) / any_value(nd) AS mean FROM tf_train, n_docs GROUP BY pos)"], (
        f"SELECT t.pos, any_value(m.nnz) AS nnz, {_r(f'any_value(m.mean_nz) * {MICRO!r}')} AS mean_nz_micro, "
        f"{_r(f'sum((t.tf - m.mean_nz) * (t.tf - m.mean_nz)) * {MICRO!r}')} AS m2_micro, "
        f"{_r(f'(sum((t.tf - m.mean) * (t.tf - m.mean)) + any_value((nd - m.nnz) * m.mean * m.mean)) * {MICRO!r}')} AS ss_micro "
        "FROM tf_train t JOIN m USING (pos), n_docs GROUP BY t.pos"))
    q["variance_topm"] = _with(sel, "SELECT new_pos, pos FROM selected")
    q["tf_reduced_train"] = _with(sel, "SELECT t.doc_id, s.new_pos, t.tf FROM tf_train t JOIN selected s USING (pos)")
    q["tf_reduced_test"] = _with(sel + _tf("tf_test", "test_tokens"),
                                 "SELECT t.doc_id, s.new_pos, t.tf FROM tf_test t JOIN selected s USING (pos)")
    hist = f"SELECT CAST(iteration AS INTEGER) AS iteration, {_r('cost')} AS cost, {_r('l2')} AS l2 FROM history"
    q["gd_history"] = _with(full, hist)
    q["gd_converged"] = _with(_full(p, CONVERGE_TOL), "SELECT iterations_applied, stopped FROM converged")
    q["gd_weights"] = _with(full, f"SELECT pos, {_r('w')} AS weight FROM final_w")
    q["gd_top_words"] = _with(full, (
        f"SELECT CAST(rank AS INTEGER) AS rank, pos, word, {_r('w')} AS weight FROM "
        "(SELECT row_number() OVER (ORDER BY w.w DESC, w.pos) AS rank, w.pos, d.word, w.w "
        "FROM final_w w JOIN dict d USING (pos)) WHERE rank <= 5"))
    q["gd_predict"] = _with(full, "SELECT doc_id, label, prediction FROM pred")
    for suffix, preset in (("", p), ("_hard", HARD), ("_zero", NO_TRUE_POSITIVE)):
        model = full if preset is p else _full(preset)
        q["gd_outcomes" + suffix] = _with(model, (
            "SELECT doc_id, label, CASE WHEN label = 1 AND prediction = 1 THEN 'TP' "
            "WHEN label = 1 AND prediction = 0 THEN 'FN' WHEN label = 0 AND prediction = 1 THEN 'FP' "
            "ELSE 'TN' END AS outcome FROM pred"))
        q["gd_confusion" + suffix] = _with(model + [_conf()], "SELECT p, n, tp, fn, fp, tn FROM conf")
        q["gd_confusion_matrix" + suffix] = _with(model, (
            "SELECT label, CAST(sum(CASE WHEN prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS pred_0, "
            "CAST(sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pred_1 "
            "FROM pred GROUP BY label"))
        prec = "CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END"
        rec = "CASE WHEN p > 0 THEN CAST(tp AS DOUBLE) / p END"
        q["gd_f1" + suffix] = _with(model + [_conf()], (
            f"SELECT {_r('precision')} AS precision, {_r('recall')} AS recall, "
            f"{_r('CASE WHEN tp > 0 THEN 2.0 * precision * recall / (precision + recall) END')} AS f1 "
            f"FROM (SELECT tp, {prec} AS precision, {rec} AS recall FROM conf)"))
        q["gd_false_positives" + suffix] = _with(model, (
            "SELECT doc_id, text FROM test WHERE doc_id IN (SELECT DISTINCT doc_id FROM pred "
            "WHERE label = 0 AND prediction = 1 ORDER BY doc_id LIMIT 3)"))
        q["class_metrics_gd" + suffix] = _with(model + [_conf()], (
            "SELECT tn, fp, fn, tp, "
            f"{_r('CASE WHEN tp + tn + fp + fn > 0 THEN CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) ELSE 0.0 END')} AS accuracy, "
            f"{_r('pr')} AS precision, {_r('rc')} AS recall, "
            f"{_r('CASE WHEN pr + rc > 0 THEN 2.0 * pr * rc / (pr + rc) ELSE 0.0 END')} AS f_measure "
            "FROM (SELECT tn, fp, fn, tp, "
            "CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS pr, "
            "CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS rc FROM conf)"))
    q["history_sink"] = _with(full, hist)
    for suffix, side in (("", "train"), ("_test", "test")):
        rows = tf_tr + (_tf("tf_test", "test_tokens") if side == "test" else [])
        q["vector_stats" + suffix] = _with(rows, (
            f"SELECT doc_id, {_label('doc_id', p.prefix)} AS label, CAST(count(*) AS BIGINT) AS nnz, "
            f"{_r('sum(tf)')} AS tf_sum FROM tf_{side} GROUP BY doc_id"))
    for suffix, side, preset in (("", "train", p), ("_test", "test", p), ("_narrow", "train", NARROW)):
        rows = tf_tr + _selection(preset) + (_tf("tf_test", "test_tokens") if side == "test" else [])
        q["reduced_vector_stats" + suffix] = _with(rows, (
            f"SELECT t.doc_id, {_label('t.doc_id', preset.prefix)} AS label, CAST(count(s.pos) AS BIGINT) AS nnz, "
            f"{_r('coalesce(sum(CASE WHEN s.pos IS NOT NULL THEN t.tf END), 0.0)')} AS tf_sum "
            f"FROM tf_{side} t LEFT JOIN selected s USING (pos) GROUP BY t.doc_id"))
    q["ml_checks"] = _with(tf_te + [
        f"labels AS (SELECT DISTINCT doc_id, {_label('doc_id', p.prefix)} AS label FROM tf_test)"], (
        "SELECT model, features, CAST((SELECT count(*) FROM labels WHERE label = 1) AS BIGINT) AS p, "
        "CAST((SELECT count(*) FROM labels WHERE label = 0) AS BIGINT) AS n, TRUE AS positives_add_up, "
        "TRUE AS negatives_add_up, TRUE AS accurate, TRUE AS loss_fell FROM "
        "(VALUES ('lr', 'full'), ('svm', 'full'), ('lr', 'reduced'), ('svm', 'reduced')) AS m(model, features)"))
    q["ml_margins"] = _with(tf_tr + [f"labels AS (SELECT DISTINCT doc_id, {_label('doc_id', p.prefix)} AS label FROM tf_train)"], (
        "SELECT model, features, doc_id, CAST(2 * label - 1 AS INTEGER) AS side FROM labels, "
        "(VALUES ('lr', 'full'), ('svm', 'full'), ('lr', 'reduced'), ('svm', 'reduced')) AS m(model, features)"))
    parts = []
    for preset in BALANCED:
        rows = _base(preset) + _tf("tf_train", "train_tokens") + _selection(preset)
        one = _label("doc_id", preset.prefix)
        parts.append("SELECT * FROM (" + _with(rows, (
            f"SELECT '{preset.prefix}' AS prefix, CAST(-1 AS INTEGER) AS new_pos, {_r('CAST(count(DISTINCT doc_id) AS DOUBLE)', 3)} "
            f"AS mass FROM tf_train WHERE {one} = 1 UNION ALL "
            f"SELECT '{preset.prefix}' AS prefix, s.new_pos, {_r(f'coalesce(sum(CASE WHEN {one} = 1 THEN t.tf END), 0.0)', 3)} AS mass "
            "FROM selected s LEFT JOIN tf_train t USING (pos) GROUP BY s.new_pos")) + ")")
    q["lr_mass"] = " UNION ALL ".join(parts)
    q["lines_gd_confusion"] = q["gd_confusion"]
    del q["gd_false_positives_zero"]  # that preset predicts no positives
    return q
