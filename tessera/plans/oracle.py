"""DuckDB SQL for each catalog query (the driver's correctness oracle).

Written independently of the Spark code: where the Spark operator uses
higher-order functions on arrays, the SQL here usually unnests and uses
window functions, so the two are genuinely different derivations.
"""

ORACLE_SQL: dict[str, str] = {}

# Shared CTE fragments ------------------------------------------------------
WS_TOKENS = "list_filter(regexp_split_to_array({col}, '\\s+'), lambda t: t <> '')"

VOCAB_CTE = f"""
doc_tokens AS (SELECT unnest({WS_TOKENS.format(col='text')}) AS token FROM documents),
counts AS (SELECT token, count(*) AS cnt FROM doc_tokens GROUP BY token),
vocab AS (SELECT token, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, token) + 1 AS BIGINT) AS id
          FROM counts QUALIFY row_number() OVER (ORDER BY cnt DESC, token) <= 10000)
"""

ENC_CTE = VOCAB_CTE + """,
pieces AS (SELECT doc_id, generate_subscripts(arr, 1) AS pos, unnest(arr) AS token
           FROM (SELECT doc_id, string_split(text, ' ') AS arr FROM documents)),
enc AS (SELECT p.doc_id, p.pos, coalesce(v.id, 1) AS id FROM pieces p LEFT JOIN vocab v USING (token))
"""

ORACLE_SQL["word_count"] = f"""
SELECT token, count(*) AS cnt
FROM (SELECT unnest({WS_TOKENS.format(col='text')}) AS token FROM documents)
GROUP BY token"""

ORACLE_SQL["vocabulary"] = f"WITH {VOCAB_CTE} SELECT token, id, cnt FROM vocab"

ORACLE_SQL["split_union_vocab"] = f"""
WITH t AS (
  SELECT 'train' AS split, unnest({WS_TOKENS.format(col='text')}) AS token FROM documents
  UNION ALL
  SELECT 'eval' AS split, unnest({WS_TOKENS.format(col='text')}) AS token FROM benchmark)
SELECT token, count(*) AS cnt, count(*) FILTER (WHERE split = 'train') AS n_train,
       count(*) FILTER (WHERE split = 'eval') AS n_eval
FROM t GROUP BY token"""

ORACLE_SQL["encode_tokens"] = f"""
WITH {ENC_CTE}
SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (WHERE id = 1) AS n_unk,
       string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids
FROM enc GROUP BY doc_id"""

ORACLE_SQL["decode_ids"] = f"""
WITH {ENC_CTE}
SELECT e.doc_id, count(v.token) AS n_kept,
       coalesce(string_agg(v.token, ' ' ORDER BY e.pos) FILTER (WHERE v.token IS NOT NULL), '') AS text
FROM enc e LEFT JOIN vocab v ON v.id = e.id AND e.id >= 2
GROUP BY e.doc_id"""

ORACLE_SQL["oov_tokens"] = f"""
WITH {VOCAB_CTE},
b AS (SELECT token, count(*) AS cnt
      FROM (SELECT unnest({WS_TOKENS.format(col='text')}) AS token FROM benchmark) GROUP BY token)
SELECT token, cnt FROM b WHERE token NOT IN (SELECT token FROM vocab)"""

ORACLE_SQL["vocab_coverage"] = f"""
WITH {VOCAB_CTE},
b AS (SELECT DISTINCT unnest({WS_TOKENS.format(col='text')}) AS token FROM benchmark)
SELECT count(*) + 2 AS n_total, count(b.token) AS n_matched,
       round((count(b.token)) / (count(*) + 2), 6) AS coverage
FROM vocab v LEFT JOIN b USING (token)"""

# ---------------------------------------------------------------- labels
LABELS_CTE = """
lab AS (SELECT DISTINCT label FROM (SELECT lang AS label FROM documents UNION ALL SELECT event_type FROM events)),
idx AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS BIGINT) AS idx FROM lab)
"""

ORACLE_SQL["label_index"] = f"WITH {LABELS_CTE} SELECT label, idx FROM idx"

ORACLE_SQL["label_encode"] = f"""
WITH {LABELS_CTE}
SELECT d.doc_id, d.lang, i.idx AS label_id FROM documents d JOIN idx i ON i.label = d.lang"""

ORACLE_SQL["label_drift"] = """
WITH m AS (SELECT DISTINCT lang AS label FROM documents),
d AS (SELECT DISTINCT label FROM (
        SELECT lang AS label FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
        UNION ALL SELECT event_type FROM events))
SELECT coalesce(m.label, d.label) AS label,
       CASE WHEN m.label IS NOT NULL AND d.label IS NOT NULL THEN 'both'
            WHEN m.label IS NOT NULL THEN 'model_only' ELSE 'data_only' END AS status
FROM m FULL OUTER JOIN d ON m.label = d.label"""

ORACLE_SQL["dedupe_predictions"] = """
SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY text"""

# ---------------------------------------------------------------- sequences
TAGS_CTE = """
tok AS (SELECT conv_id, turn, generate_subscripts(arr, 1) - 1 AS pos, unnest(arr) AS token
        FROM (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '') AS arr
              FROM conversations)),
typ AS (SELECT *, CASE WHEN regexp_matches(token, '^[A-Z]') THEN 'CAP'
                       WHEN regexp_matches(token, '[,.]$') THEN 'PUN' ELSE 'O' END AS ty FROM tok),
gl AS (SELECT *, CASE WHEN ty = 'O' THEN 'O'
                      WHEN lag(ty) OVER (PARTITION BY conv_id, turn ORDER BY pos) = ty THEN 'I-' || ty
                      ELSE 'B-' || ty END AS gold FROM typ),
tags AS (SELECT *, CASE WHEN pos % 5 = 2 THEN 'O'
                        WHEN pos % 7 = 3 THEN regexp_replace(gold, '^B-', 'I-') ELSE gold END AS pred FROM gl),
tagidx AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx
           FROM (SELECT DISTINCT gold AS label FROM tags)),
tagids AS (SELECT t.*, g.idx AS gid, p.idx AS pid, coalesce(gi.idx, g.idx) AS gin FROM tags t
           LEFT JOIN tagidx g ON g.label = t.gold LEFT JOIN tagidx p ON p.label = t.pred
           LEFT JOIN tagidx gi ON t.gold LIKE 'B-%' AND gi.label = replace(t.gold, 'B-', 'I-'))
"""


def ents_cte(col: str, name: str, strict: bool) -> str:
    keep = "= 'B'" if strict else "<> 'O'"
    return f"""
{name}_0 AS (SELECT conv_id, turn, pos, {col} AS tag,
                    lag({col}) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS ptag FROM tags),
{name}_1 AS (SELECT *, CASE WHEN tag = 'O' THEN 'O' ELSE substr(tag, 1, 1) END AS pf,
                       CASE WHEN tag = 'O' THEN 'O' ELSE substr(tag, 3) END AS et,
                       CASE WHEN ptag = 'O' THEN 'O' ELSE substr(ptag, 3) END AS pet FROM {name}_0),
{name}_2 AS (SELECT *, sum(CASE WHEN ptag IS NULL OR pf <> 'I' OR ptag = 'O' OR et <> pet THEN 1 ELSE 0 END)
                    OVER (PARTITION BY conv_id, turn ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cid FROM {name}_1),
{name} AS (SELECT conv_id, turn, arg_min(et, pos) AS etype, min(pos) AS start, max(pos) AS "end"
           FROM {name}_2 GROUP BY conv_id, turn, cid
           HAVING arg_min(et, pos) <> 'O' AND arg_min(pf, pos) {keep})
"""


for _mode, _strict in (("strict", True), ("lenient", False)):
    ORACLE_SQL[f"entities_{_mode}"] = f"""
WITH {TAGS_CTE}, {ents_cte('pred', 'pe', _strict)}
SELECT conv_id, turn, etype, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end" FROM pe"""


def entity_counts_cte(strict: bool) -> str:
    return f"""{TAGS_CTE}, {ents_cte('gold', 'ge', strict)}, {ents_cte('pred', 'pe', strict)},
j AS (SELECT coalesce(g.etype, p.etype) AS etype, g.start IS NOT NULL AS ig, p.start IS NOT NULL AS ip
      FROM ge g FULL OUTER JOIN pe p ON g.conv_id = p.conv_id AND g.turn = p.turn AND g.etype = p.etype
           AND g.start = p.start AND g."end" = p."end"),
c AS (SELECT etype, count(*) FILTER (WHERE ig) AS n_gold, count(*) FILTER (WHERE ip) AS n_pred,
             count(*) FILTER (WHERE ig AND ip) AS n_tp FROM j GROUP BY etype),
per0 AS (SELECT etype, n_gold, n_pred, n_tp,
                CASE WHEN n_pred > 0 THEN n_tp / n_pred ELSE 0.0 END AS p,
                CASE WHEN n_gold > 0 THEN n_tp / n_gold ELSE 0.0 END AS r FROM c),
per AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM per0)"""


ORACLE_SQL["entity_f1_strict"] = f"""
WITH {entity_counts_cte(True)},
tot AS (SELECT sum(n_tp) AS tp, sum(n_pred) AS np, sum(n_gold) AS ng, avg(p) AS mp, avg(r) AS mr, avg(f) AS mf,
               sum(p * n_gold) / sum(n_gold) AS wp, sum(r * n_gold) / sum(n_gold) AS wr,
               sum(f * n_gold) / sum(n_gold) AS wf FROM per),
mic0 AS (SELECT ng, CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS p,
                CASE WHEN ng > 0 THEN tp / ng ELSE 0.0 END AS r FROM tot),
mic AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM mic0),
rep AS (SELECT etype AS label, p, r, f, n_gold AS support FROM per
        UNION ALL SELECT 'micro avg', p, r, f, ng FROM mic
        UNION ALL SELECT 'macro avg', mp, mr, mf, ng FROM tot
        UNION ALL SELECT 'weighted avg', wp, wr, wf, ng FROM tot)
SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM rep"""

ORACLE_SQL["entity_f1_lenient"] = f"""
WITH {entity_counts_cte(False)},
tot0 AS (SELECT sum(n_tp) AS tp, sum(n_pred) AS np, sum(n_gold) AS ng FROM c),
tot1 AS (SELECT CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS p, CASE WHEN ng > 0 THEN tp / ng ELSE 0.0 END AS r FROM tot0),
tot AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM tot1),
m AS (SELECT etype || '_precision' AS metric, p AS value FROM per
      UNION ALL SELECT etype || '_recall', r FROM per
      UNION ALL SELECT etype || '_f1', f FROM per
      UNION ALL SELECT etype || '_number', CAST(n_gold AS DOUBLE) FROM per
      UNION ALL SELECT 'overall_precision', p FROM tot
      UNION ALL SELECT 'overall_recall', r FROM tot
      UNION ALL SELECT 'overall_f1', f FROM tot
      UNION ALL SELECT 'overall_accuracy', avg(CASE WHEN pred = gold THEN 1.0 ELSE 0.0 END) FROM tags)
SELECT metric, round(value, 6) AS value FROM m"""

ORACLE_SQL["joint_accuracy"] = f"""
WITH {TAGS_CTE}, s AS (SELECT conv_id, turn, bool_and(pred = gold) AS ok FROM tags GROUP BY conv_id, turn)
SELECT count(*) AS n_seqs, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6) AS joint_acc FROM s"""

ORACLE_SQL["token_accuracy"] = f"""
WITH {TAGS_CTE}
SELECT count(*) AS n_tokens, round(avg(CASE WHEN pred = gold THEN 1.0 ELSE 0.0 END), 6) AS token_acc FROM tags"""

ORACLE_SQL["b_to_i_map"] = f"""
WITH {TAGS_CTE}
SELECT b.label AS b_label, CAST(b.idx AS BIGINT) AS b_idx, i.label AS i_label, CAST(i.idx AS BIGINT) AS i_idx
FROM tagidx b JOIN tagidx i ON i.label = replace(b.label, 'B-', 'I-') WHERE b.label LIKE 'B-%'"""

ORACLE_SQL["masked_token_accuracy"] = f"""
WITH {TAGS_CTE}
SELECT count(*) AS n_tokens, round(avg(CASE WHEN pid = gid THEN 1.0 ELSE 0.0 END), 6) AS token_acc FROM tagids"""

ORACLE_SQL["tag_lines"] = f"""
WITH {TAGS_CTE}
SELECT conv_id, turn, string_agg(pred, ' ' ORDER BY pos) AS tags FROM tags GROUP BY conv_id, turn"""

ORACLE_SQL["encode_tags"] = f"""
WITH {TAGS_CTE},
s AS (SELECT conv_id, turn, count(*) AS length, string_agg(CAST(gid AS VARCHAR), ' ' ORDER BY pos) AS ids
      FROM tagids GROUP BY conv_id, turn),
m AS (SELECT *, max(length) OVER (PARTITION BY conv_id) AS ml FROM s)
SELECT conv_id, turn, CAST(length AS BIGINT) AS length, ids || repeat(' -1', CAST(ml - length AS BIGINT)) AS tag_ids FROM m"""

ORACLE_SQL["encode_tags_fixed"] = f"""
WITH {TAGS_CTE},
s AS (SELECT conv_id, turn, count(*) AS length, string_agg(CAST(gid AS VARCHAR), ' ' ORDER BY pos) FILTER (pos < 40) AS ids
      FROM tagids GROUP BY conv_id, turn)
SELECT conv_id, turn, length, ids || repeat(' -1', CAST(40 - least(length, 40) AS BIGINT)) AS tag_ids FROM s"""

# ---------------------------------------------------------------- QA data
QQ_CTE = """
n_docs AS (SELECT count(*) AS n FROM documents),
hit AS (SELECT b.item_id, d.doc_id, position(b.text IN d.text) - 1 AS cs
        FROM benchmark b JOIN documents d ON position(b.text IN d.text) > 0),
rel AS (SELECT b.item_id, coalesce(min(doc_id), b.item_id % n) AS relevant, arg_min(cs, doc_id) AS char_start
        FROM benchmark b CROSS JOIN n_docs LEFT JOIN hit USING (item_id) GROUP BY b.item_id, n),
q AS (SELECT CAST(r.item_id AS VARCHAR) AS id, r.item_id, b.text AS question, r.relevant,
             b.text AS answer_text, r.char_start AS answer_start, r.item_id % 4 AS rp
      FROM rel r JOIN benchmark b USING (item_id)),
qp AS (SELECT q.*, t.p, CASE WHEN t.p = rp THEN relevant
                           ELSE (relevant + 101 * CASE WHEN t.p < rp THEN t.p + 1 ELSE t.p END + item_id) % n END AS ctx_id
       FROM q CROSS JOIN n_docs CROSS JOIN range(4) t(p)),
qpt AS (SELECT qp.*, d.text FROM qp JOIN documents d ON d.doc_id = qp.ctx_id WHERE item_id % 10 <> 9),
mc AS (SELECT id, question,
              max(text) FILTER (WHERE p = 0) AS ending0, max(text) FILTER (WHERE p = 1) AS ending1,
              max(text) FILTER (WHERE p = 2) AS ending2, max(text) FILTER (WHERE p = 3) AS ending3,
              min(p) FILTER (WHERE ctx_id = relevant) AS labels
       FROM qpt GROUP BY id, question),
sq AS (SELECT q.id, q.question, d.text AS context, q.answer_text, q.answer_start
       FROM q JOIN documents d ON d.doc_id = q.relevant WHERE q.answer_start IS NOT NULL)
"""

ORACLE_SQL["relevant_context"] = """
SELECT b.item_id, d.doc_id, CAST(position(b.text IN d.text) - 1 AS BIGINT) AS char_start
FROM benchmark b JOIN documents d ON position(b.text IN d.text) > 0"""

ORACLE_SQL["mc_rows"] = f"""
WITH {QQ_CTE}
SELECT id AS "video-id", id AS "fold-ind", question AS startphrase, question AS sent1, question AS sent2,
       'gold' AS "gold-source", ending0, ending1, ending2, ending3, CAST(labels AS BIGINT) AS labels FROM mc"""

ORACLE_SQL["mc_rows_unlabeled"] = ORACLE_SQL["mc_rows"].replace("CAST(labels AS BIGINT) AS labels", "0::BIGINT AS labels")

ORACLE_SQL["mc_rejects"] = f"""
WITH {QQ_CTE}
SELECT id, string_agg(CAST(ctx_id AS VARCHAR), ' ' ORDER BY p) AS paragraphs
FROM qp WHERE item_id % 10 = 9 AND p < 3 GROUP BY id"""

ORACLE_SQL["squad_rejects"] = f"""
WITH {QQ_CTE}
SELECT id, relevant, 'no_answer' AS issue FROM q WHERE answer_start IS NULL"""

ORACLE_SQL["squad_rows"] = f"""
WITH {QQ_CTE}
SELECT id, id AS title, question, context, answer_text, CAST(answer_start AS BIGINT) AS answer_start FROM sq"""

ORACLE_SQL["choice_pairs"] = f"""
WITH {QQ_CTE}
SELECT qpt.id, CAST(qpt.p AS BIGINT) AS choice, qpt.question AS first, qpt.question || ' ' || qpt.text AS second,
       CAST(mc.labels AS BIGINT) AS labels
FROM qpt JOIN mc USING (id)"""

CHOOSE_CTE = QQ_CTE + """,
ew AS (SELECT id, p, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '')) AS word FROM qpt),
et AS (SELECT id, p, word, count(*) AS tf FROM ew GROUP BY ALL),
qw AS (SELECT id, unnest(list_filter(regexp_split_to_array(question, '\\s+'), lambda t: t <> '')) AS word FROM mc),
qt AS (SELECT id, word, count(*) AS qtf FROM qw GROUP BY ALL),
nd AS (SELECT count(*) AS n FROM qpt),
df AS (SELECT word, count(*) AS df FROM et GROUP BY word),
wt0 AS (SELECT et.*, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM et JOIN df USING (word) CROSS JOIN nd),
wq AS (SELECT qt.*, qtf * (ln((1 + n) / (1 + coalesce(df, 0))) + 1) AS w FROM qt LEFT JOIN df USING (word) CROSS JOIN nd),
dot AS (SELECT wt0.id, p, sum(wt0.w * wq.w) AS dot FROM wt0 JOIN wq ON wq.id = wt0.id AND wq.word = wt0.word GROUP BY 1, 2),
nr AS (SELECT id, p, sqrt(sum(w * w)) AS norm FROM wt0 GROUP BY 1, 2),
nq AS (SELECT id, sqrt(sum(w * w)) AS qnorm FROM wq GROUP BY 1),
sc AS (SELECT qpt.id, qpt.p, round(coalesce(dot / (norm * qnorm), 0.0), 9) AS score, text
       FROM qpt LEFT JOIN dot USING (id, p) LEFT JOIN nr USING (id, p) LEFT JOIN nq USING (id)),
ch AS (SELECT id, p AS pred, score, text FROM sc
       QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, p) = 1)
"""

ORACLE_SQL["choose_context"] = f"""
WITH {CHOOSE_CTE}
SELECT id, CAST(pred AS BIGINT) AS pred, round(score, 6) AS score FROM ch"""

ORACLE_SQL["choices_regrouped"] = f"""
WITH {CHOOSE_CTE}
SELECT id, {", ".join(f"round(max(sc.score) FILTER (p = {i}), 6) AS score{i}" for i in range(4))},
       CAST(max(ch.pred) AS BIGINT) AS pred FROM sc JOIN ch USING (id) GROUP BY id"""

ORACLE_SQL["mc_selected_context"] = f"""
WITH {CHOOSE_CTE}
SELECT id, CAST(pred AS BIGINT) AS pred, text AS context FROM ch"""

TOKROWS = """
pieces AS (SELECT {key} AS k, generate_subscripts(arr, 1) - 1 AS pos, unnest(arr) AS piece
           FROM (SELECT {key}, regexp_extract_all({text}, '\\s*\\S+') AS arr FROM {src})),
toks AS (SELECT k, pos, regexp_replace(piece, '^\\s+', '') AS token,
                sum(length(piece)) OVER (PARTITION BY k ORDER BY pos ROWS UNBOUNDED PRECEDING) AS e FROM pieces),
tokrows AS (SELECT k, pos, token, e - length(token) AS s, e FROM toks)
"""

WINDOWS = """
ntok AS (SELECT k, count(*) AS n FROM tokrows GROUP BY k),
wins AS (SELECT k, n, w.k2 AS win
         FROM ntok CROSS JOIN LATERAL (SELECT unnest(range(CAST(1 + ceil(greatest(n - {w}, 0) / {step}) AS BIGINT))) AS k2) w),
wt AS (SELECT wins.k, wins.win, t.pos, t.s, t.e FROM wins JOIN tokrows t
       ON t.k = wins.k AND t.pos >= wins.win * {step} AND t.pos < wins.win * {step} + {w})
"""

QA_CTE = f"""
{TOKROWS.format(key='doc_id', text='text', src='documents')}, {WINDOWS.format(w=384, step=256)},
qd AS (SELECT doc_id, len(regexp_extract_all(text, '\\S+')) AS n FROM documents),
f AS (SELECT doc_id AS example_id, u.win, doc_id * 100000 + u.win AS feature_id
      FROM qd CROSS JOIN LATERAL (SELECT unnest(range(CAST(1 + ceil(greatest(n - 384, 0) / 256) AS BIGINT))) AS win) u),
lg AS (SELECT k AS example_id, k * 100000 + win AS feature_id, CAST(pos - win * 256 + 1 AS BIGINT) AS pos, s AS cs, e AS ce,
              CAST((7919 * k + 10473 * pos + 31 * pos * pos) % 997 AS DOUBLE) / 100 - 5 AS sv,
              CAST((5501 * k + 7727 * pos + 17 * pos * pos) % 991 AS DOUBLE) / 100 - 5 AS ev FROM wt
       UNION ALL
       SELECT example_id, feature_id, 0, NULL, NULL, CAST((13 * example_id + 7 * win) % 400 AS DOUBLE) / 100,
              CAST((11 * example_id + 5 * win) % 400 AS DOUBLE) / 100 - 2 FROM f),
sr AS (SELECT *, sv AS v, row_number() OVER (PARTITION BY feature_id ORDER BY sv DESC, pos) - 1 AS rk FROM lg),
er AS (SELECT *, ev AS v, row_number() OVER (PARTITION BY feature_id ORDER BY ev DESC, pos) - 1 AS rk FROM lg),
c AS (SELECT st.example_id, st.feature_id, st.pos AS sp, en.pos AS ep, st.rk AS srk, en.rk AS erk, st.cs, en.ce,
             st.v AS start_logit, en.v AS end_logit, st.v + en.v AS score
      FROM sr st JOIN er en ON st.feature_id = en.feature_id AND st.rk < 20 AND en.rk < 20
      WHERE st.pos >= 1 AND en.pos >= st.pos AND en.pos - st.pos + 1 <= 30),
cf AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY feature_id ORDER BY score DESC, srk, erk) <= 20),
ct AS (SELECT cf.*, substr(d.text, CAST(cs + 1 AS BIGINT), CAST(ce - cs AS BIGINT)) AS text
       FROM cf JOIN documents d ON d.doc_id = cf.example_id)
"""

# examples without any candidate get the made-up first row
NBEST = """
r AS (SELECT example_id, text, start_logit, end_logit, score,
             row_number() OVER (PARTITION BY example_id ORDER BY score DESC, feature_id, srk, erk) AS rank
      FROM ct QUALIFY rank <= 20),
a AS (SELECT r.* FROM r UNION ALL
      SELECT doc_id, 'empty', 0.0, 0.0, 0.0, 1 FROM documents WHERE doc_id NOT IN (SELECT example_id FROM r)),
m AS (SELECT *, exp(score - max(score) OVER (PARTITION BY example_id)) AS ex FROM a)
"""
NBEST_OUT = """round(start_logit, 6) AS start_logit, round(end_logit, 6) AS end_logit,
       round(ex / sum(ex) OVER (PARTITION BY example_id), 6) AS probability"""

ORACLE_SQL["qa_nbest"] = f"""
WITH {QA_CTE}, {NBEST}
SELECT example_id, CAST(rank AS BIGINT) AS rank, text, {NBEST_OUT} FROM m"""

ORACLE_SQL["qa_nbest_max_context"] = ORACLE_SQL["qa_nbest"].replace("WHERE st.pos >= 1 AND", """WHERE st.pos >= 1
        AND (st.example_id + st.pos - 1 + (st.feature_id - st.example_id * 100000) * 256) % 3 <> 0 AND""")

REPAIR = """CASE WHEN contains({x}, ',') THEN replace({x}, ',', '')
            WHEN contains({x}, '《') AND NOT contains({x}, '》') THEN {x} || '》'
            WHEN contains({x}, '》') AND NOT contains({x}, '《') THEN '《' || {x}
            WHEN contains({x}, '「') AND NOT contains({x}, '」') THEN {x} || '」'
            WHEN contains({x}, '」') AND NOT contains({x}, '「') THEN '「' || {x}
            ELSE {x} END"""

ORACLE_SQL["qa_predictions"] = f"""
WITH {QA_CTE}, {NBEST}
SELECT example_id, text AS prediction, {REPAIR.format(x='text')} AS answer FROM m WHERE rank = 1"""

# the null candidate of an example: its smallest CLS score, the first feature on ties; it
# ranks after candidates of the same score and is added back where it is not among the best
NEGATIVE = """
nl AS (SELECT l.example_id, l.feature_id, l.sv AS start_logit, l.ev AS end_logit, l.sv + l.ev AS score
       FROM lg l JOIN documents d ON d.doc_id = l.example_id WHERE l.pos = 0
       QUALIFY row_number() OVER (PARTITION BY l.example_id ORDER BY l.sv + l.ev, l.feature_id) = 1),
al AS (SELECT example_id, text, start_logit, end_logit, score, FALSE AS is_null, feature_id, srk, erk FROM ct
       UNION ALL SELECT example_id, '', start_logit, end_logit, score, TRUE, feature_id, -1, -1 FROM nl),
rk AS (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY score DESC, is_null, feature_id, srk, erk) AS rank FROM al),
kp AS (SELECT *, count(*) OVER (PARTITION BY example_id) AS n FROM rk WHERE rank <= 20 OR is_null),
fk AS (SELECT example_id, rank, text, start_logit, end_logit, score, is_null FROM kp
       UNION ALL SELECT example_id, 0, 'empty', 0.0, 0.0, 0.0, FALSE FROM kp WHERE n = 1 AND text = ''),
m AS (SELECT *, exp(score - max(score) OVER (PARTITION BY example_id)) AS ex,
             row_number() OVER (PARTITION BY example_id ORDER BY rank) AS place FROM fk)
"""

ORACLE_SQL["qa_nbest_negative"] = f"""
WITH {QA_CTE}, {NEGATIVE}
SELECT example_id, CAST(place AS BIGINT) AS rank, text, {NBEST_OUT}, is_null FROM m"""

ORACLE_SQL["qa_null_odds"] = f"""
WITH {QA_CTE}, {NEGATIVE},
b AS (SELECT * FROM m WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY example_id ORDER BY place) = 1)
SELECT nl.example_id, round(nl.score, 6) AS null_score, coalesce(b.text, '') AS best_text,
       round(nl.score - b.start_logit - b.end_logit, 6) AS score_diff,
       CASE WHEN nl.score - b.start_logit - b.end_logit > 0 THEN '' ELSE coalesce(b.text, '') END AS prediction
FROM nl LEFT JOIN b USING (example_id)"""

BEAM = """
slot AS (SELECT s.example_id, s.feature_id, s.rk AS i, s.pos AS sp, s.v AS start_logit, s.cs,
                x.pos AS ep, x.v AS end_logit, x.ce,
                row_number() OVER (PARTITION BY s.feature_id, s.rk ORDER BY x.rk) - 1 AS j
         FROM sr s JOIN er x ON x.feature_id = s.feature_id AND x.pos >= s.pos AND s.rk < 5
         QUALIFY j < 5),
bc AS (SELECT *, start_logit + end_logit AS score FROM slot WHERE sp >= 1 AND ep - sp + 1 <= 30),
r AS (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY score DESC, feature_id, i, j) AS rank
      FROM bc QUALIFY rank <= 20),
t AS (SELECT r.example_id, r.rank, substr(d.text, CAST(cs + 1 AS BIGINT), CAST(ce - cs AS BIGINT)) AS text,
             start_logit, end_logit, score FROM r JOIN documents d ON d.doc_id = r.example_id
      UNION ALL SELECT doc_id, 1, '', -1e-6, -1e-6, -2e-6 FROM documents WHERE doc_id NOT IN (SELECT example_id FROM bc)),
m AS (SELECT *, exp(score - max(score) OVER (PARTITION BY example_id)) AS ex FROM t)
"""

ORACLE_SQL["qa_beam_nbest"] = f"""
WITH {QA_CTE}, {BEAM}
SELECT example_id, CAST(rank AS BIGINT) AS rank, text, {NBEST_OUT} FROM m"""

ORACLE_SQL["qa_beam_null_odds"] = f"""
WITH {QA_CTE}, {BEAM},
lo AS (SELECT example_id, min(sv + ev) AS low FROM lg WHERE pos = 0 GROUP BY example_id)
SELECT m.example_id, m.text AS prediction,
       round(CASE WHEN m.example_id NOT IN (SELECT example_id FROM bc) THEN -2e-6 ELSE low END, 6) AS null_score
FROM m JOIN lo USING (example_id) WHERE rank = 1"""

ORACLE_SQL["repair_answers"] = f"""
WITH r AS (SELECT item_id, CASE item_id % 5 WHEN 0 THEN '《' || text WHEN 1 THEN text || '》'
                                       WHEN 2 THEN '「' || text WHEN 3 THEN text || '」' ELSE text END AS raw FROM benchmark)
SELECT item_id, raw, {REPAIR.format(x='raw')} AS answer FROM r"""

ORACLE_SQL["token_offsets"] = f"""
WITH {TOKROWS.format(key='doc_id', text='text', src='documents')}
SELECT k AS doc_id, CAST(pos AS BIGINT) AS pos, token, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM tokrows"""

ORACLE_SQL["context_windows"] = f"""
WITH {TOKROWS.format(key='doc_id', text='text', src='documents')}, {WINDOWS.format(w=128, step=96)}
SELECT k AS doc_id, CAST(win AS BIGINT) AS win, CAST(min(pos) AS BIGINT) AS first_tok,
       CAST(count(*) AS BIGINT) AS n_tok, CAST(min(s) AS BIGINT) AS start_char, CAST(max(e) AS BIGINT) AS end_char
FROM wt GROUP BY k, win"""

ORACLE_SQL["answer_token_span"] = f"""
WITH {QQ_CTE}, {TOKROWS.format(key='id', text='context', src='sq')}, {WINDOWS.format(w=64, step=48)},
a AS (SELECT id AS k, answer_start AS a_start, answer_start + length(answer_text) AS a_end FROM sq),
agg AS (SELECT wt.k, wt.win, min(wt.pos) AS first, min(s) AS sc, max(e) AS ec,
               max(pos) FILTER (WHERE s <= a.a_start) AS st, min(pos) FILTER (WHERE e >= a.a_end) AS en,
               any_value(a.a_start) AS a_start, any_value(a.a_end) AS a_end
        FROM wt JOIN a ON a.k = wt.k GROUP BY wt.k, wt.win)
SELECT k AS id, CAST(win AS BIGINT) AS win,
       CAST(CASE WHEN sc <= a_start AND ec >= a_end THEN st - first + 1 ELSE 0 END AS BIGINT) AS start_position,
       CAST(CASE WHEN sc <= a_start AND ec >= a_end THEN en - first + 1 ELSE 0 END AS BIGINT) AS end_position
FROM agg"""

ORACLE_SQL["argmax_label"] = """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS pred,
       CAST(label AS BIGINT) AS label FROM embeddings"""

ORACLE_SQL["span_accuracy"] = """
WITH nemb AS (SELECT count(*) AS n FROM embeddings),
x AS (SELECT list_position(a.embedding, list_max(a.embedding)) - 1 AS ps,
             list_position(b.embedding, list_max(b.embedding)) - 1 AS pe, a.label AS gs, a.label + a.vec_id % 3 AS ge
      FROM embeddings a CROSS JOIN nemb JOIN embeddings b ON b.vec_id = (a.vec_id + 1) % nemb.n)
SELECT count(*) AS n, round(avg(CASE WHEN ps = gs AND pe = ge THEN 1.0 ELSE 0.0 END), 6) AS span_acc FROM x"""

# ---------------------------------------------------------------- summaries
STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
WS = "list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"
ROUGE_WORDS = ("flatten(list_transform(list_filter(string_split({x}, '.'), lambda p: length(p) > 0), "
               "lambda p: CASE WHEN len(" + WS.format(x="p") + ") = 0 THEN [''] ELSE " + WS.format(x="p") + " END))")
ALNUM_WORDS = WS.format(x="regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')")
BIGRAMS = "list_transform(range(len({t}) - 1), lambda i: {t}[i + 1] || chr(31) || {t}[i + 2])"

SP_CTE = f"""
sp AS (SELECT r.conv_id, r.turn, {STRIP.format(x='r.text')} AS ref, {STRIP.format(x='h.text')} AS pred
       FROM conversations r JOIN conversations h ON h.conv_id = r.conv_id AND h.turn = r.turn + 1
       WHERE r.role = 'user' AND h.role = 'assistant')
"""

CHARS = "list_filter(string_split({x}, ''), lambda t: NOT regexp_full_match(t, '\\s*'))"
CHAR_PAIRS = ("CASE WHEN len(" + CHARS + ") < 2 THEN " + CHARS + " ELSE list_transform(range(len(" + CHARS + ") - 1), "
              "lambda i: " + CHARS + "[i + 1] || " + CHARS + "[i + 2]) END")


def rouge_set_cte(words: str) -> str:
    return SP_CTE + f""",
rt0 AS (SELECT conv_id, turn, {words.format(x='pred')} AS ht, {words.format(x='ref')} AS rt FROM sp),
rg AS (SELECT conv_id, turn, list_distinct(ht) AS h1, list_distinct(rt) AS r1,
              list_distinct({BIGRAMS.format(t='ht')}) AS h2, list_distinct({BIGRAMS.format(t='rt')}) AS r2 FROM rt0),
ro AS (SELECT conv_id, turn,
              CASE WHEN len(h1) > 0 THEN len(list_intersect(h1, r1)) / len(h1) ELSE 0.0 END AS p1,
              CASE WHEN len(r1) > 0 THEN len(list_intersect(h1, r1)) / len(r1) ELSE 0.0 END AS q1,
              CASE WHEN len(h2) > 0 THEN len(list_intersect(h2, r2)) / len(h2) ELSE 0.0 END AS p2,
              CASE WHEN len(r2) > 0 THEN len(list_intersect(h2, r2)) / len(r2) ELSE 0.0 END AS q2 FROM rg),
rf AS (SELECT conv_id, turn, 2.0 * (p1 * q1) / (p1 + q1 + 1e-8) AS f1, 2.0 * (p2 * q2) / (p2 + q2 + 1e-8) AS f2 FROM ro)
"""


ROUGE_SET_CTE = rouge_set_cte(ROUGE_WORDS)
for _name, _words in (("char", CHARS), ("char_bigram", CHAR_PAIRS)):
    ORACLE_SQL[f"rouge_n_{_name}"] = f"""
WITH {rouge_set_cte(_words)}
SELECT conv_id, turn, round(f1, 6) AS rouge1_f, round(f2, 6) AS rouge2_f FROM rf"""

ORACLE_SQL["summary_projection"] = """
SELECT CAST(doc_id AS VARCHAR) AS id,
       CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1) ELSE text END AS title,
       CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS maintext
FROM documents"""

ORACLE_SQL["pair_by_id"] = f"""
SELECT r.conv_id, r.turn, {STRIP.format(x='r.text')} AS ref, {STRIP.format(x='h.text')} AS pred, h.conv_id IS NOT NULL AS matched
FROM conversations r LEFT JOIN conversations h ON h.conv_id = r.conv_id AND h.turn = r.turn + 1 AND h.role = 'assistant'
WHERE r.role = 'user'"""

ORACLE_SQL["paired_summaries"] = f"WITH {SP_CTE} SELECT conv_id, turn, ref, pred FROM sp"

ORACLE_SQL["strip_text"] = f"SELECT conv_id, turn, {STRIP.format(x='text')} AS text FROM conversations"

ORACLE_SQL["sentence_lines"] = f"""
WITH s AS (SELECT doc_id, list_filter(list_transform(
             string_split(regexp_replace(text, '([.!?。！？])', '\\1' || chr(1), 'g'), chr(1)),
             lambda p: {STRIP.format(x='p')}), lambda p: p <> '') AS s FROM documents)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, array_to_string(s, chr(10)) AS lines FROM s"""

SUMMARY_CTE = """
sm AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS id,
              CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1) ELSE text END AS title,
              CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS maintext
       FROM documents)
"""

ORACLE_SQL["truncate_pairs"] = f"""
WITH {SUMMARY_CTE}, t AS (SELECT id, {WS.format(x='maintext')} AS s, {WS.format(x='title')} AS t FROM sm)
SELECT id, CAST(len(s) AS BIGINT) AS n_src, CAST(least(len(s), 512) AS BIGINT) AS n_src_kept,
       CAST(len(t) AS BIGINT) AS n_tgt, CAST(least(len(t), 64) AS BIGINT) AS n_tgt_kept,
       coalesce(array_to_string(s[1:512], ' '), '') AS src_text, coalesce(array_to_string(t[1:64], ' '), '') AS tgt_text FROM t"""

ORACLE_SQL["mask_labels"] = f"""
WITH {VOCAB_CTE}, {SUMMARY_CTE},
p AS (SELECT doc_id, generate_subscripts(arr, 1) AS pos, unnest(arr) AS token
      FROM (SELECT doc_id, string_split(title, ' ') AS arr FROM sm)),
e AS (SELECT p.doc_id, p.pos, coalesce(v.id, 1) AS id FROM p LEFT JOIN vocab v USING (token)),
g AS (SELECT doc_id, count(*) AS n, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE pos <= 64) AS ids
      FROM e GROUP BY doc_id)
SELECT doc_id, ids || repeat(' -100', CAST(64 - least(n, 64) AS BIGINT)) AS labels FROM g"""

ORACLE_SQL["rouge_n"] = f"""
WITH {ROUGE_SET_CTE}
SELECT conv_id, turn, round(f1, 6) AS rouge1_f, round(f2, 6) AS rouge2_f FROM rf"""

ORACLE_SQL["rouge_scores"] = f"""
WITH {ROUGE_SET_CTE}
SELECT count(*) AS n_pairs, round(avg(f1) * 100, 6) AS rouge1, round(avg(f2) * 100, 6) AS rouge2 FROM rf"""

ORACLE_SQL["rouge_n_multiset"] = f"""
WITH {SP_CTE},
t AS (SELECT conv_id, turn, {ALNUM_WORDS.format(x='pred')} AS ht, {ALNUM_WORDS.format(x='ref')} AS rt FROM sp),
gr AS (SELECT conv_id, turn, 1 AS n, 1 AS h, unnest(ht) AS g FROM t
       UNION ALL SELECT conv_id, turn, 1, 0, unnest(rt) FROM t
       UNION ALL SELECT conv_id, turn, 2, 1, unnest({BIGRAMS.format(t='ht')}) FROM t
       UNION ALL SELECT conv_id, turn, 2, 0, unnest({BIGRAMS.format(t='rt')}) FROM t),
c AS (SELECT conv_id, turn, n, g, count(*) FILTER (WHERE h = 1) AS ch, count(*) FILTER (WHERE h = 0) AS cr
      FROM gr GROUP BY ALL),
s AS (SELECT conv_id, turn, n, sum(least(ch, cr)) AS ov, sum(ch) AS nh, sum(cr) AS nr FROM c GROUP BY ALL),
k AS (SELECT t.conv_id, t.turn, x.n FROM t CROSS JOIN (VALUES (1), (2)) x(n)),
pr AS (SELECT k.conv_id, k.turn, k.n,
              CASE WHEN coalesce(nh, 0) > 0 THEN ov / nh ELSE 0.0 END AS p,
              CASE WHEN coalesce(nr, 0) > 0 THEN ov / nr ELSE 0.0 END AS r
       FROM k LEFT JOIN s USING (conv_id, turn, n)),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM pr)
SELECT conv_id, turn, round(max(f) FILTER (WHERE n = 1) * 100, 6) AS rouge1,
       round(max(f) FILTER (WHERE n = 2) * 100, 6) AS rouge2
FROM f GROUP BY conv_id, turn"""

# ---------------------------------------------------------------- metrics
ORACLE_SQL["accuracy"] = """
SELECT CAST(toxic AS VARCHAR) AS gold, count(*) AS n,
       round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM labels GROUP BY toxic
UNION ALL
SELECT 'all', count(*), round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 6) FROM labels"""

ORACLE_SQL["prefixed_metrics"] = """
WITH r AS (SELECT avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END) AS accuracy,
                  CAST(count(*) AS DOUBLE) AS n, avg(toxic) AS eval_toxic_rate FROM labels)
SELECT 'eval_accuracy' AS metric, round(accuracy, 6) AS value FROM r
UNION ALL SELECT 'eval_n', round(n, 6) FROM r
UNION ALL SELECT 'eval_toxic_rate', round(eval_toxic_rate, 6) FROM r"""

ORACLE_SQL["epoch_metrics"] = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_steps, round(sum(value), 6) AS loss_sum,
       round(avg(value), 6) AS loss_mean FROM events GROUP BY 1"""

ORACLE_SQL["best_epoch"] = """
WITH p AS (SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS metric FROM events GROUP BY 1, 2)
SELECT event_type, CAST(day AS VARCHAR) AS day, round(metric, 6) AS metric,
       metric > coalesce(max(metric) OVER (PARTITION BY event_type ORDER BY day
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS is_best
FROM p"""

ORACLE_SQL["split_counts"] = """
SELECT 'train' AS split, count(*) AS n_rows FROM documents
UNION ALL SELECT 'eval', count(*) FROM benchmark
UNION ALL SELECT 'test', count(*) FROM conversations"""

ORACLE_SQL["metric_log"] = """
WITH d AS (SELECT CAST(ts AS DATE) AS day,
                  avg(value) FILTER (WHERE event_type = 'click') AS rouge1,
                  avg(value) FILTER (WHERE event_type = 'view') AS rouge2,
                  avg(value) FILTER (WHERE event_type = 'purchase') AS rougeL,
                  avg(value) FILTER (WHERE event_type = 'signup') AS rougeLsum,
                  avg(value) AS train_loss, count(*) AS step FROM events GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY day) - 1 AS BIGINT) AS row_no, round(rouge1, 6) AS rouge1,
       round(rouge2, 6) AS rouge2, round(rougeL, 6) AS rougeL, round(rougeLsum, 6) AS rougeLsum,
       round(train_loss, 6) AS train_loss, CAST(date_diff('day', DATE '2000-01-01', day) AS DOUBLE) AS epoch,
       CAST(step AS DOUBLE) AS step
FROM d"""

# ---------------------------------------------------------------- ordering
ORACLE_SQL["predictions_indexed"] = """
SELECT 'test-' || CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS id, lang AS intent FROM documents"""

ORACLE_SQL["padded_batches"] = """
WITH n AS (SELECT doc_id, len(string_split(text, ' ')) AS n,
                  (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch_id FROM documents),
m AS (SELECT *, CAST(ceil(max(n) OVER (PARTITION BY batch_id) / 8) * 8 AS BIGINT) AS padded_len FROM n)
SELECT doc_id, CAST(batch_id AS BIGINT) AS batch_id, padded_len, CAST(padded_len - n AS BIGINT) AS n_pad FROM m"""

ORACLE_SQL["first_n_features"] = f"""
WITH d100 AS (SELECT * FROM documents ORDER BY doc_id LIMIT 100),
{TOKROWS.format(key='doc_id', text='text', src='d100')}, {WINDOWS.format(w=128, step=96)},
wa AS (SELECT k AS doc_id, CAST(win AS BIGINT) AS win, CAST(min(s) AS BIGINT) AS start_char,
              CAST(max(e) AS BIGINT) AS end_char FROM wt GROUP BY k, win)
SELECT * FROM wa ORDER BY doc_id, win LIMIT 200"""

ORACLE_SQL["max_length"] = "SELECT CAST(max(len(string_split(text, ' '))) AS BIGINT) AS max_len FROM documents"

EM_CORE = """
nz AS (SELECT id,
         list_filter(@P@,
                     lambda t: t NOT IN ('a', 'an', 'the')) AS pt,
         list_filter(@G@,
                     lambda t: t NOT IN ('a', 'an', 'the')) AS gt FROM pr),
c AS (SELECT id, pt, gt, array_to_string(pt, ' ') = array_to_string(gt, ' ') AS em,
             coalesce(list_sum(list_transform(list_distinct(pt), lambda t:
                 least(len(list_filter(pt, lambda x: x = t)), len(list_filter(gt, lambda x: x = t))))), 0) AS common
      FROM nz),
f AS (SELECT id, CASE WHEN em THEN 1.0 ELSE 0.0 END AS em,
             CASE WHEN len(pt) = 0 OR len(gt) = 0 THEN CASE WHEN len(pt) = len(gt) THEN 1.0 ELSE 0.0 END
                  WHEN common = 0 THEN 0.0
                  ELSE 2 * (common / len(pt)) * (common / len(gt)) / (common / len(pt) + common / len(gt)) END AS f1
      FROM c)
"""
for _mark, _col in (("@P@", "prediction"), ("@G@", "answer_text")):
    EM_CORE = EM_CORE.replace(_mark, WS.format(x=f"regexp_replace(lower({_col}), '[!-/:-@\\[-`{{-~]', '', 'g')"))

ORACLE_SQL["qa_em_f1"] = f"""
WITH {QQ_CTE},
pr AS (SELECT id, substr(context, answer_start + CAST(id AS INTEGER) % 3 + 1, length(answer_text)) AS prediction, answer_text FROM sq),
{EM_CORE}
SELECT count(*) AS n, round(avg(em) * 100, 6) AS exact_match, round(avg(f1) * 100, 6) AS f1 FROM f"""

ORACLE_SQL["qa_em_f1_v2"] = f"""
WITH {QQ_CTE},
pr AS (SELECT q.id, coalesce(q.answer_start IS NOT NULL, FALSE) AS has,
              CASE WHEN q.answer_start IS NULL THEN '' ELSE q.answer_text END AS answer_text,
              CASE WHEN CAST(q.id AS INTEGER) % 2 = 0 THEN ''
                   ELSE coalesce(substr(sq.context, sq.answer_start + CAST(q.id AS INTEGER) % 3 + 1, length(sq.answer_text)),
                                 'some text') END AS prediction
       FROM q LEFT JOIN sq ON sq.id = q.id),
{EM_CORE},
g AS (SELECT f.*, has FROM f JOIN pr USING (id))
SELECT count(*) AS n, round(avg(em) * 100, 6) AS exact_match, round(avg(f1) * 100, 6) AS f1,
       count(*) FILTER (has) AS has_answer_n, round(avg(em) FILTER (has) * 100, 6) AS has_answer_exact_match,
       round(avg(f1) FILTER (has) * 100, 6) AS has_answer_f1,
       count(*) FILTER (NOT has) AS no_answer_n, round(avg(em) FILTER (NOT has) * 100, 6) AS no_answer_exact_match,
       round(avg(f1) FILTER (NOT has) * 100, 6) AS no_answer_f1
FROM g"""

# ---------------------------------------------------------------- sources / ML
ORACLE_SQL["concat_json"] = """
SELECT event_id // 8 AS line_id, count(*) AS n_objects,
       CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k FROM events GROUP BY 1"""

ORACLE_SQL["word_vectors_scan"] = """
SELECT 'w' || CAST(vec_id AS VARCHAR) AS token, CAST(len(embedding) AS BIGINT) AS dim,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS vsum FROM embeddings
WHERE vec_id % 50 <> 7
UNION ALL
SELECT 'w' || CAST(vec_id AS VARCHAR), 3, 6.0 FROM embeddings WHERE vec_id % 50 = 7 AND vec_id % 20 = 3"""

ORACLE_SQL["word_vector_rejects"] = """
SELECT 'w' || CAST(vec_id AS VARCHAR) AS token, CAST(len(embedding) + 2 AS BIGINT) AS n_fields FROM embeddings
WHERE vec_id % 50 = 7"""

ORACLE_SQL["vector_dim_check"] = """
SELECT count(*) AS n_rows, CAST(min(len(embedding)) AS BIGINT) AS min_dim, CAST(max(len(embedding)) AS BIGINT) AS max_dim,
       count(*) FILTER (WHERE len(embedding) <> 64) AS n_bad FROM embeddings"""

ORACLE_SQL["logit_feature_audit"] = """
WITH l AS (SELECT vec_id // 2 AS example_id, vec_id AS feature_id FROM embeddings),
f AS (SELECT doc_id AS example_id, doc_id * 2 AS feature_id FROM documents
      UNION ALL SELECT doc_id, doc_id * 2 + 1 FROM documents)
SELECT example_id, feature_id, 'missing_logits' AS issue FROM f
WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.example_id = f.example_id AND l.feature_id = f.feature_id)
UNION ALL
SELECT example_id, feature_id, 'missing_feature' FROM l
WHERE NOT EXISTS (SELECT 1 FROM f WHERE l.example_id = f.example_id AND l.feature_id = f.feature_id)"""

MD5 = "('0x' || substr(md5({x}), 1, 8))::BIGINT"

ORACLE_SQL["max_pool_vectors"] = f"""
WITH n AS (SELECT count(*) AS n FROM embeddings),
w AS (SELECT doc_id, list_distinct({WS_TOKENS.format(col='text')}) AS ts FROM documents),
t AS (SELECT DISTINCT doc_id, {MD5.format(x='token')} % n.n AS vec_id
      FROM (SELECT doc_id, unnest(CASE WHEN len(ts) = 0 THEN ['[PAD]'] ELSE ts END) AS token FROM w) CROSS JOIN n),
x AS (SELECT t.doc_id, generate_subscripts(e.embedding, 1) - 1 AS dim, unnest(e.embedding) AS v
      FROM t JOIN embeddings e USING (vec_id))
SELECT doc_id, CAST(dim AS BIGINT) AS dim, round(CAST(max(v) AS DOUBLE), 6) AS value FROM x GROUP BY doc_id, dim"""

ORACLE_SQL["sample_rows"] = f"""
SELECT doc_id, lang FROM documents ORDER BY {MD5.format(x="'7:' || doc_id")}, doc_id LIMIT 20"""

ORACLE_SQL["shuffled_order"] = f"""
SELECT doc_id, lang, {MD5.format(x="'11:' || doc_id")} AS shuffle_key FROM documents"""

ORACLE_SQL["map_batches"] = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line FROM l"""

ORACLE_SQL["embedding_matrix"] = f"""
WITH {VOCAB_CTE},
a AS (SELECT token, id FROM vocab UNION ALL SELECT '[PAD]', 0 UNION ALL SELECT '[UNK]', 1),
j AS (SELECT a.id, a.token, e.embedding FROM a LEFT JOIN embeddings e ON e.vec_id = a.id - 2 AND a.id >= 2),
r AS (SELECT id, sum(CAST(CAST({MD5.format(x="'13:' || token || ':' || d")} % 1048576 / 1048576.0 * 2.0 - 1.0 AS FLOAT) AS DOUBLE)) AS s
      FROM a CROSS JOIN range(64) t(d) GROUP BY id)
SELECT CAST(j.id AS INTEGER) AS id, j.token, embedding IS NOT NULL AS matched,
       round(CASE WHEN embedding IS NOT NULL THEN list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE)))
                  ELSE r.s END, 6) AS vsum
FROM j JOIN r USING (id)"""

ORACLE_SQL["score_batches"] = """
WITH e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
s AS (SELECT vec_id, any_value(label) AS label, j, sum(x * (((7 * i + 13 * j) % 11 - 5) / 4.0)) AS z
      FROM e CROSS JOIN range(10) t(j) GROUP BY vec_id, j)
SELECT vec_id, label, j AS pred FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, j) = 1"""

TWO_STAGE_CTE = f"""{CHOOSE_CTE}, chosen AS (SELECT ch.id, ch.text AS context FROM ch),
{TOKROWS.format(key='id', text='context', src='chosen')}, {WINDOWS.format(w=128, step=64)},
qs AS (SELECT DISTINCT id, word FROM qw),
dfw AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({WS_TOKENS.format(col='text')}) AS word FROM documents)
        WHERE word IN (SELECT word FROM qs) GROUP BY 1),
qwt AS (SELECT id, word, CAST(round(ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + coalesce(df, 0))) * 1000) AS BIGINT) AS w
        FROM qs LEFT JOIN dfw USING (word)),
lg AS (SELECT wt.k, wt.win, pos - wt.win * 64 + 1 AS p, wt.s AS cs, wt.e AS ce, coalesce(qwt.w, -1000) AS x
       FROM wt JOIN tokrows t USING (k, pos) LEFT JOIN qwt ON qwt.id = wt.k AND qwt.word = t.token),
pf AS (SELECT *, sum(x) OVER (PARTITION BY k, win ORDER BY p) AS pe FROM lg),
se AS (SELECT *, -(pe - x)::DOUBLE / 1000 AS sv, pe::DOUBLE / 1000 AS ev FROM pf),
st AS (SELECT *, row_number() OVER (PARTITION BY k, win ORDER BY sv DESC, p) - 1 AS rk FROM se),
en AS (SELECT *, row_number() OVER (PARTITION BY k, win ORDER BY ev DESC, p) - 1 AS rk FROM se),
pairs AS (SELECT a.k, a.win, a.sv + b.ev AS score, a.rk AS srk, b.rk AS erk, a.cs, b.ce
      FROM st a JOIN en b ON a.k = b.k AND a.win = b.win AND b.p >= a.p AND b.p - a.p + 1 <= 64),
top AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, win, srk, erk) = 1),
two AS (SELECT chosen.id, CASE WHEN top.k IS NULL THEN 'empty'
                              ELSE substr(context, CAST(cs + 1 AS BIGINT), CAST(ce - cs AS BIGINT)) END AS text
       FROM chosen LEFT JOIN top ON top.k = chosen.id)"""
ORACLE_SQL["qa_two_stage"] = f"""
WITH {TWO_STAGE_CTE}
SELECT id, text AS prediction, {REPAIR.format(x='text')} AS answer FROM two"""

ORACLE_SQL["qa_two_stage_scores"] = f"""
WITH {TWO_STAGE_CTE},
pr AS (SELECT two.id, two.text AS prediction, mc.question AS answer_text FROM two JOIN mc ON mc.id = two.id),
{EM_CORE}
SELECT count(*) AS n, round(avg(em) * 100, 6) AS exact_match, round(avg(f1) * 100, 6) AS f1 FROM f"""

from tessera.plans import oracle_text  # noqa: E402, F401  adds its queries
