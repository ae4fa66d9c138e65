"""DuckDB SQL of the queries on learnt words and pieces; adds to the oracle's table."""

from __future__ import annotations

from tessera.plans.catalog import PIECE_FILE
from tessera.plans.oracle import (ALNUM_WORDS, ORACLE_SQL, ROUGE_SET_CTE, ROUGE_WORDS, SP_CTE, STRIP, TAGS_CTE, WS, WS_TOKENS,
                                  rouge_set_cte)

# Word segmentation: the dictionary by n-gram counts, the cheapest path by a
# recursion over a run's letters that carries costs and last words as lists.
DICT_CTE = r"""
runs AS (SELECT run, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{M}]+')) AS run FROM documents)
         GROUP BY run),
gram AS (SELECT substr(run, i, n) AS g, n, sum(cnt) AS f
         FROM (SELECT run, cnt, unnest(range(1, length(run) + 1)) AS i FROM runs), (SELECT unnest([1, 2, 3, 4, 5]) AS n)
         WHERE i + n - 1 <= length(run) GROUP BY 1, 2),
nxt AS (SELECT substr(g, 1, n - 1) AS g, sum(f) AS t, sum(f * ln(f)) AS w FROM gram WHERE n > 1 GROUP BY 1),
prv AS (SELECT substr(g, 2, n - 1) AS g, sum(f) AS t, sum(f * ln(f)) AS w FROM gram WHERE n > 1 GROUP BY 1),
sums AS (SELECT gram.g, gram.n, gram.f, coalesce(nxt.w, 0) AS nw, f - coalesce(nxt.t, 0) AS ne, coalesce(prv.w, 0) AS pw,
           f - coalesce(prv.t, 0) AS pe
         FROM gram LEFT JOIN nxt USING (g) LEFT JOIN prv USING (g) WHERE n <= 4 AND f >= 20),
fig AS MATERIALIZED (
  SELECT g, n, CAST(f AS BIGINT) AS f, round(least(ln(f) - (nw + CASE WHEN ne > 0 THEN ne * ln(ne) ELSE 0 END) / f,
    ln(f) - (pw + CASE WHEN pe > 0 THEN pe * ln(pe) ELSE 0 END) / f), 6) AS freedom FROM sums),
letters AS (SELECT sum(f) AS c FROM fig WHERE n = 1),
coh AS (SELECT a.g, round(min(ln(a.f::DOUBLE / h.f * (SELECT c FROM letters) / t.f)), 6) AS cohesion
        FROM (SELECT g, f, unnest(range(1, n)) AS k FROM fig WHERE n > 1) a
        JOIN fig h ON h.g = substr(a.g, 1, k) JOIN fig t ON t.g = substr(a.g, k + 1) GROUP BY a.g),
dict0 AS (SELECT fig.g AS word, f AS cnt, cohesion, freedom FROM fig LEFT JOIN coh USING (g)
          WHERE n = 1 OR cohesion >= 1.0 AND freedom >= 0.5
          QUALIFY row_number() OVER (ORDER BY f DESC, fig.g) <= 20000),
dict AS MATERIALIZED (SELECT *, CAST(round(ln((SELECT sum(cnt) FROM dict0)::DOUBLE / cnt) * 1000) AS BIGINT) AS cost FROM dict0),
unknown AS (SELECT CAST(round(1000 * ln(2 * sum(cnt))) AS BIGINT) AS u FROM dict)
"""
ORACLE_SQL["segment_dictionary"] = f"WITH {DICT_CTE} SELECT word, cnt, cohesion, freedom, cost FROM dict"

PIECES = r"regexp_extract_all({x}, '[\p{{L}}\p{{M}}]+|[^\p{{L}}\p{{M}}\p{{Z}}\x09-\x0D\x{{85}}]+')"


def segment_cte(source: str) -> str:
    """cutrun(run, words): the words of every run of letters of ``source``, a query with one column x of texts."""
    return DICT_CTE + r""",
mine AS MATERIALIZED (SELECT DISTINCT unnest(regexp_extract_all(x, '[\p{L}\p{M}]+')) AS run FROM (SOURCE)),
edge AS (SELECT run, j, n, coalesce(d.cost, CASE WHEN n = 1 THEN (SELECT u FROM unknown) END) AS cost
         FROM (SELECT run, j, n, substr(run, j - n + 1, n) AS part
               FROM (SELECT run, unnest(range(1, length(run) + 1)) AS j FROM mine), (SELECT unnest([1, 2, 3, 4]) AS n) WHERE n <= j)
         LEFT JOIN dict d ON d.word = part),
lat AS MATERIALIZED (SELECT run, j, list([n, cost]) AS e FROM edge WHERE cost IS NOT NULL GROUP BY run, j),
allsteps AS MATERIALIZED (SELECT run, list(e ORDER BY j) AS steps FROM lat GROUP BY run),
walk AS (
  SELECT run, steps, 0::BIGINT AS j, [0::BIGINT] AS best, [0::BIGINT] AS back FROM allsteps
  UNION ALL
  SELECT run, steps, j + 1, list_append(best, c[1]), list_append(back, -c[2]) FROM (
    SELECT *, list_sort([[best[j + 2 - x[1]] + x[2], -x[1]] FOR x IN steps[j + 1]])[1] AS c FROM walk WHERE j < len(steps))),
paths AS (
  SELECT run, back, len(steps)::BIGINT AS j, []::VARCHAR[] AS words FROM walk WHERE j = len(steps)
  UNION ALL
  SELECT run, back, j - back[j + 1], list_prepend(substr(run, j - back[j + 1] + 1, back[j + 1]), words) FROM paths WHERE j > 0),
cutrun AS MATERIALIZED (SELECT run, words FROM paths WHERE j = 0)
""".replace("SOURCE", source)


ORACLE_SQL["segment_text"] = f"""
WITH RECURSIVE {segment_cte("SELECT text AS x FROM documents")},
p AS (SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS piece
      FROM (SELECT doc_id, {PIECES.format(x='text')} AS a FROM documents)),
w AS (SELECT doc_id, i, coalesce(c.words, [piece]) AS words FROM p LEFT JOIN cutrun c ON c.run = piece),
t AS (SELECT doc_id, flatten(list(words ORDER BY i)) AS words FROM w GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(words), 0)::BIGINT AS n_words, coalesce(array_to_string(words, ' '), '') AS text
FROM documents d LEFT JOIN t USING (doc_id)"""

_SEGMENTED_SP = """
sp AS (SELECT q.conv_id, q.turn, coalesce(a.x, '') AS ref, coalesce(b.x, '') AS pred FROM sides q
       LEFT JOIN sw a ON a.conv_id = q.conv_id AND a.turn = q.turn AND a.s = 'ref'
       LEFT JOIN sw b ON b.conv_id = q.conv_id AND b.turn = q.turn AND b.s = 'pred')
"""
ORACLE_SQL["rouge_n_segmented"] = f"""
WITH RECURSIVE {segment_cte("SELECT text AS x FROM conversations")},
sides AS (SELECT r.conv_id, r.turn, {STRIP.format(x='r.text')} AS ref, {STRIP.format(x='h.text')} AS pred
       FROM conversations r JOIN conversations h ON h.conv_id = r.conv_id AND h.turn = r.turn + 1
       WHERE r.role = 'user' AND h.role = 'assistant'),
side AS (SELECT conv_id, turn, 'ref' AS s, ref AS x FROM sides UNION ALL SELECT conv_id, turn, 'pred', pred FROM sides),
pc AS (SELECT conv_id, turn, s, generate_subscripts(a, 1) AS i, unnest(a) AS piece
       FROM (SELECT *, {PIECES.format(x='x')} AS a FROM side)),
sw AS (SELECT conv_id, turn, s, array_to_string(flatten(list(coalesce(c.words, [piece]) ORDER BY i)), ' ') AS x
       FROM pc LEFT JOIN cutrun c ON c.run = piece GROUP BY 1, 2, 3),
{rouge_set_cte(ROUGE_WORDS).replace(SP_CTE, _SEGMENTED_SP)}
SELECT conv_id, turn, round(f1, 6) AS rouge1_f, round(f2, 6) AS rouge2_f FROM rf"""


# Sub-word pieces: the longest match from every place of every distinct word,
# then the chain of places that begins at the word's first letter.
def pieces_cte(source: str) -> str:
    """piece(word, i, id): the pieces of the words of ``source``, a query with one column word."""
    return r"""
vb AS (SELECT TRY(decode(from_base64(b))) AS p, id FROM read_csv('FILE', delim=' ', header=false, quote='', escape='',
         auto_detect=false, columns={'b': 'VARCHAR', 'id': 'BIGINT'})),
pt AS MATERIALIZED (
  SELECT CASE WHEN starts_with(p, ' ') THEN substr(p, 2) ELSE p END AS p, starts_with(p, ' ') AS first, id, length(p) AS len
  FROM vb WHERE p IS NOT NULL AND p <> ' '),
words AS MATERIALIZED (SELECT DISTINCT word FROM (SOURCE)),
place AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
match AS MATERIALIZED (
  SELECT word, i, max(l) AS l, arg_max(id, l) AS id FROM (
    SELECT word, i, l, pt.id FROM (SELECT word, i, unnest(range(1, least((SELECT max(len) FROM pt), length(word) - i + 1) + 1)) AS l FROM place) x
    JOIN pt ON pt.p = substr(x.word, x.i, x.l) AND pt.first = (x.i = 1)) GROUP BY 1, 2),
step AS MATERIALIZED (SELECT place.word, place.i, coalesce(l, 1) AS l, id FROM place LEFT JOIN match USING (word, i)),
piece AS (
  SELECT word, 1::BIGINT AS i FROM words
  UNION ALL
  SELECT p.word, p.i + s.l FROM piece p JOIN step s USING (word, i) WHERE p.i + s.l <= length(p.word)),
cut AS MATERIALIZED (SELECT word, list(id ORDER BY i) AS ids, count(*) AS np FROM piece JOIN step USING (word, i) GROUP BY word)
""".replace("FILE", PIECE_FILE).replace("SOURCE", source)


_DOC_WORDS = f"SELECT doc_id, unnest({WS_TOKENS.format(col='text')}) AS word, generate_subscripts({WS_TOKENS.format(col='text')}, 1) AS pos FROM documents"
ORACLE_SQL["word_pieces"] = f"""
WITH RECURSIVE tok AS MATERIALIZED ({_DOC_WORDS}), {pieces_cte("SELECT word FROM tok")},
d AS (SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids FROM tok JOIN cut USING (word) GROUP BY doc_id)
SELECT doc_id, coalesce(len(ids), 0)::BIGINT AS n_pieces, coalesce(len([x FOR x IN ids IF x IS NULL]), 0)::BIGINT AS n_unknown,
       coalesce(array_to_string([coalesce(x::VARCHAR, '?') FOR x IN ids], ' '), '') AS ids
FROM documents LEFT JOIN d USING (doc_id)"""

_TAG_PIECES = f"WITH RECURSIVE {TAGS_CTE}, {pieces_cte('SELECT token AS word FROM tags')}, " \
    "w AS (SELECT conv_id, turn, pos, np, gid, gin FROM tagids JOIN cut ON cut.word = token)"
ORACLE_SQL["align_labels"] = f"""
{_TAG_PIECES}
SELECT conv_id, turn, CAST(2 + sum(np) AS BIGINT) AS n_pieces, count(*) FILTER (WHERE np > 0) AS n_labeled,
       '-100 ' || string_agg(CAST(gid AS VARCHAR) || repeat(' -100', CAST(np - 1 AS BIGINT)), ' ' ORDER BY pos)
       || ' -100' AS labels
FROM w GROUP BY conv_id, turn"""

ORACLE_SQL["align_labels_all"] = f"""
{_TAG_PIECES}
SELECT conv_id, turn, '-100 ' || string_agg(CAST(gid AS VARCHAR) || repeat(' ' || CAST(gin AS VARCHAR), CAST(np - 1 AS BIGINT)),
       ' ' ORDER BY pos) || ' -100' AS labels
FROM w GROUP BY conv_id, turn"""


# Longest common subsequences: the table's rows one after another, then the way
# back through it.
def lcs_cte(name: str, up_on_tie: bool) -> str:
    """{name}_on(conv_id, turn, rs, place): the places of reference sentence rs on an LCS with some other sentence;
    {name}_len: the lengths.  Reads {name}_in(conv_id, turn, rs, hs, rw, hw)."""
    return r"""
NAME_dp AS (
  SELECT *, 0 AS i, [[0 FOR j IN range(0, len(hw) + 1)]] AS t FROM NAME_in
  UNION ALL
  SELECT conv_id, turn, rs, hs, rw, hw, i + 1, list_append(t, list_reduce([[j] FOR j IN range(0, len(hw) + 1)],
    lambda done, x: list_append(done, CASE WHEN rw[i + 1] = hw[x[1]] THEN t[i + 1][x[1]] + 1
                                           ELSE greatest(t[i + 1][x[1] + 1], done[x[1]]) END)))
  FROM NAME_dp WHERE i < len(rw)),
NAME_len AS MATERIALIZED (SELECT conv_id, turn, rs, hs, rw, hw, t, t[len(rw) + 1][len(hw) + 1] AS lcs FROM NAME_dp WHERE i = len(rw)),
NAME_bt AS (
  SELECT conv_id, turn, rs, hs, rw, hw, t, len(rw) AS i, len(hw) AS j, []::BIGINT[] AS places FROM NAME_len
  UNION ALL
  SELECT conv_id, turn, rs, hs, rw, hw, t, CASE WHEN same OR up THEN i - 1 ELSE i END, CASE WHEN same OR NOT up THEN j - 1 ELSE j END,
    CASE WHEN same THEN list_append(places, i) ELSE places END
  FROM (SELECT *, rw[i] = hw[j] AS same, t[i][j + 1] > t[i + 1][j] OR (TIE AND t[i][j + 1] = t[i + 1][j]) AS up
        FROM NAME_bt WHERE i > 0 AND j > 0)),
NAME_on AS (SELECT DISTINCT conv_id, turn, rs, rw, unnest(places) AS place FROM NAME_bt WHERE i = 0 OR j = 0)
""".replace("NAME", name).replace("TIE", str(up_on_tie).upper())


DOT_SENTENCES = ("list_transform(list_filter(string_split({x}, '.'), lambda p: length(p) > 0), "
                 "lambda p: CASE WHEN len(" + WS.format(x="p") + ") = 0 THEN [''] ELSE " + WS.format(x="p") + " END)")
LINES = "list_filter(list_transform(string_split({x}, chr(10)), lambda p: " + ALNUM_WORDS.format(x="p") + "), lambda s: len(s) > 0)"


def sentence_pairs(name: str, split: str) -> str:
    return f"""
{name}_s AS (SELECT conv_id, turn, {split.format(x='ref')} AS rs, {split.format(x='pred')} AS hs FROM sp),
{name}_r AS (SELECT conv_id, turn, generate_subscripts(rs, 1) AS rs, unnest(rs) AS rw FROM {name}_s),
{name}_h AS (SELECT conv_id, turn, generate_subscripts(hs, 1) AS hs, unnest(hs) AS hw FROM {name}_s),
{name}_in AS (SELECT r.conv_id, r.turn, rs, hs, rw, hw FROM {name}_r r JOIN {name}_h h ON h.conv_id = r.conv_id AND h.turn = r.turn)"""


ROUGE_L_CTE = f"""{ROUGE_SET_CTE}, {sentence_pairs('set', DOT_SENTENCES)}, {lcs_cte('set', False)},
set_words AS (SELECT conv_id, turn, count(DISTINCT rw[place]) AS u FROM set_on GROUP BY 1, 2),
set_f AS (SELECT s.conv_id, s.turn, coalesce(u, 0) AS u, len(list_distinct(flatten(hs))) AS n, len(list_distinct(flatten(rs))) AS m
          FROM set_s s LEFT JOIN set_words w ON w.conv_id = s.conv_id AND w.turn = s.turn),
set_pq AS (SELECT conv_id, turn, CASE WHEN n > 0 THEN u / n ELSE 0.0 END AS p, CASE WHEN m > 0 THEN u / m ELSE 0.0 END AS q FROM set_f),
set_l AS (SELECT conv_id, turn, 2.0 * (p * q) / (p + q + 1e-8) AS fl FROM set_pq)"""
ORACLE_SQL["rouge_l"] = f"WITH RECURSIVE {ROUGE_L_CTE} SELECT conv_id, turn, round(fl, 6) AS rougeL_f FROM set_l"

ORACLE_SQL["quality_gate"] = f"""
WITH RECURSIVE {ROUGE_L_CTE},
mean AS (SELECT (SELECT avg(f1) * 100 FROM rf) AS r1, (SELECT avg(f2) * 100 FROM rf) AS r2, (SELECT avg(fl) * 100 FROM set_l) AS rl)
SELECT round(r1, 6) AS rouge1, round(r2, 6) AS rouge2, round(rl, 6) AS rougeL, r1 > 22.0 AND r2 > 8.5 AND rl > 20.5 AS passed FROM mean"""

_PLAIN_F = "CASE WHEN {h} > 0 AND {r} > 0 AND {o} > 0 THEN 2 * ({o} / {h}) * ({o} / {r}) / ({o} / {h} + {o} / {r}) ELSE 0.0 END"


def logged_cte(words: str, lines: str) -> str:
    """scores(conv_id, turn, rouge1, rouge2, rougel, rougelsum) of the multiset family."""
    return f"""{SP_CTE},
tk AS (SELECT conv_id, turn, {words.format(x='pred')} AS h, {words.format(x='ref')} AS r FROM sp),
ng AS (SELECT conv_id, turn, n, side, array_to_string(w[i:i + n - 1], chr(31)) AS g
       FROM (SELECT conv_id, turn, side, n, w, unnest(range(1, len(w) - n + 2)) AS i
             FROM (SELECT conv_id, turn, 'h' AS side, h AS w FROM tk UNION ALL SELECT conv_id, turn, 'r', r FROM tk),
                  (SELECT unnest([1, 2]) AS n) WHERE len(w) >= n)),
nc AS (SELECT conv_id, turn, n, g, count(*) FILTER (side = 'h') AS h, count(*) FILTER (side = 'r') AS r FROM ng GROUP BY 1, 2, 3, 4),
no AS (SELECT conv_id, turn, n, sum(least(h, r)) AS o, sum(h) AS h, sum(r) AS r FROM nc GROUP BY 1, 2, 3),
nf AS (SELECT conv_id, turn, n, {_PLAIN_F.format(o='o', h='h', r='r')} AS f FROM no),
one_in AS (SELECT conv_id, turn, 1 AS rs, 1 AS hs, r AS rw, h AS hw FROM tk), {lcs_cte('one', True)},
ol AS (SELECT conv_id, turn, {_PLAIN_F.format(o='lcs', h='len(hw)', r='len(rw)')} AS f FROM one_len),
{sentence_pairs('ln', lines)}, {lcs_cte('ln', True)},
lw AS (SELECT conv_id, turn, rw[place] AS w, count(*) AS c FROM ln_on GROUP BY 1, 2, 3),
lh AS (SELECT conv_id, turn, w, count(*) AS c FROM (SELECT conv_id, turn, unnest(hw) AS w FROM ln_h) GROUP BY 1, 2, 3),
lo AS (SELECT lw.conv_id, lw.turn, sum(least(lw.c, lh.c)) AS o FROM lw JOIN lh USING (conv_id, turn, w) GROUP BY 1, 2),
lf AS (SELECT s.conv_id, s.turn, {_PLAIN_F.format(o='coalesce(o, 0)', h='len(flatten(hs))', r='len(flatten(rs))')} AS f
       FROM ln_s s LEFT JOIN lo ON lo.conv_id = s.conv_id AND lo.turn = s.turn),
scores AS (SELECT tk.conv_id, tk.turn, coalesce(a.f, 0) AS rouge1, coalesce(b.f, 0) AS rouge2, ol.f AS rougel, lf.f AS rougelsum FROM tk
           LEFT JOIN nf a ON a.conv_id = tk.conv_id AND a.turn = tk.turn AND a.n = 1
           LEFT JOIN nf b ON b.conv_id = tk.conv_id AND b.turn = tk.turn AND b.n = 2
           JOIN ol ON ol.conv_id = tk.conv_id AND ol.turn = tk.turn JOIN lf ON lf.conv_id = tk.conv_id AND lf.turn = tk.turn)"""


_MEANS = ("SELECT " + ", ".join(f"round(avg({c.lower()}) * 100, 4) AS {c}" for c in ("rouge1", "rouge2", "rougeL", "rougeLsum"))
          + " FROM scores")
ORACLE_SQL["rouge_logged"] = f"WITH RECURSIVE {logged_cte(ALNUM_WORDS, LINES)} {_MEANS}"


# Sentence boundaries: counts of words before periods, then every token's ending
# and the next one's opening.
SENTENCE_CTE = r"""
tok AS MATERIALIZED (
  SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS token FROM (
    SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(text, '([。！？])', '\1 ', 'g'), '\s+'), lambda t: t <> '') AS a FROM documents)),
bare AS (SELECT *, regexp_replace(regexp_replace(lower(token), '^["''(\[{«“„‘]+', ''), '["'')\]}»”’,;:]+$', '') AS bare FROM tok),
kind AS MATERIALIZED (SELECT *, ends_with(bare, '.') AS dot, regexp_replace(bare, '\.$', '') AS word,
    lead(token) OVER w AS next FROM bare WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
nxt AS MATERIALIZED (SELECT *, lead(word) OVER (PARTITION BY doc_id ORDER BY i) AS next_word FROM kind),
cnt AS MATERIALIZED (SELECT word, count(*) AS n, count(*) FILTER (dot) AS dotted FROM kind GROUP BY word),
tot AS (SELECT sum(n) AS n, sum(dotted) AS d FROM cnt),
abbr0 AS (SELECT word, cnt.n, dotted, length(replace(word, '.', '')) AS l,
    2 * (dotted * ln(0.99 / (tot.d / tot.n)) + (cnt.n - dotted) * ln(0.01 / (1 - tot.d / tot.n))) AS ratio
  FROM cnt, tot WHERE dotted > 0 AND regexp_matches(word, '^\p{L}+([.''-]\p{L}+)*$')),
abbr AS MATERIALIZED (SELECT word, n, dotted, round(ratio * exp(-l) * (length(word) - l + 1) * pow(l::DOUBLE, -(n - dotted)), 6) AS score
  FROM abbr0 WHERE round(ratio * exp(-l) * (length(word) - l + 1) * pow(l::DOUBLE, -(n - dotted)), 6) >= 0.3
  QUALIFY row_number() OVER (ORDER BY dotted DESC, word) <= 20000),
aft AS (SELECT next_word AS word, count(*) AS k FROM nxt
  WHERE dot AND next IS NOT NULL AND NOT regexp_matches(word, '^[0-9]') AND NOT regexp_full_match(word, '\p{L}')
    AND word NOT IN (SELECT word FROM abbr) GROUP BY 1),
atot AS (SELECT sum(k) AS a FROM aft),
st0 AS (SELECT word, n::DOUBLE AS b, k::DOUBLE AS k, (SELECT n FROM tot)::DOUBLE AS n, (SELECT a FROM atot)::DOUBLE AS a FROM aft JOIN cnt USING (word)
  WHERE regexp_matches(word, '\p{L}') AND k * (SELECT n FROM tot) > n * (SELECT a FROM atot)),
st1 AS (SELECT word, b, k, round(2 * (
    CASE WHEN k > 0 THEN k * ln(k / a) ELSE 0 END + CASE WHEN a > k THEN (a - k) * ln(1 - k / a) ELSE 0 END
    + CASE WHEN b > k THEN (b - k) * ln((b - k) / (n - a)) ELSE 0 END + CASE WHEN n - a > b - k THEN (n - a - (b - k)) * ln(1 - (b - k) / (n - a)) ELSE 0 END
    - CASE WHEN k > 0 THEN k * ln(b / n) ELSE 0 END - CASE WHEN a > k THEN (a - k) * ln(1 - b / n) ELSE 0 END
    - CASE WHEN b > k THEN (b - k) * ln(b / n) ELSE 0 END - CASE WHEN n - a > b - k THEN (n - a - (b - k)) * ln(1 - b / n) ELSE 0 END), 6) AS score FROM st0),
starts AS MATERIALIZED (SELECT word, b::BIGINT AS n, k::BIGINT AS k, score FROM st1 WHERE score >= 30 QUALIFY row_number() OVER (ORDER BY k DESC, word) <= 20000)
"""
ORACLE_SQL["sentence_model"] = f"""
WITH {SENTENCE_CTE}
SELECT 'abbreviation' AS kind, word, n, dotted AS marked, score FROM abbr UNION ALL SELECT 'starter', word, n, k, score FROM starts"""

ORACLE_SQL["sentences_learned"] = "WITH " + SENTENCE_CTE + r""",
shut AS (SELECT *, regexp_replace(token, '["'')\]}»”’,;:]+$', '') AS shut, regexp_replace(next, '^["''(\[{«“„‘]+', '') AS first FROM nxt),
e AS (SELECT *, regexp_matches(first, '^\p{Lu}') AS capital,
    CASE WHEN regexp_matches(token, '[。！？]$') OR regexp_matches(shut, '[!?]$') THEN 1 WHEN NOT ends_with(shut, '.') THEN 0
         WHEN word IN (SELECT word FROM abbr) OR regexp_full_match(word, '\p{L}') THEN 2
         WHEN regexp_matches(word, '^[0-9]') THEN 3 ELSE 1 END AS ending FROM shut),
c AS (SELECT doc_id, i, token, next IS NULL OR ending = 1 OR ending = 2 AND capital AND next_word IN (SELECT word FROM starts)
             OR ending = 3 AND capital AS cut FROM e),
g AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nr FROM c),
s AS (SELECT doc_id, nr, string_agg(token, ' ' ORDER BY i) AS line FROM g GROUP BY 1, 2),
l AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY nr) AS lines FROM s GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(lines, '') AS lines FROM documents LEFT JOIN l USING (doc_id)"""
