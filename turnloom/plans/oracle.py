"""Independent DuckDB SQL for each registered query (the driver's correctness gate).

Written from the rules, not from the Spark code: plain window functions,
self-joins for message ranges and correlated counts for best-k.
"""

from __future__ import annotations

from ..functions.text import duckdb_ws_literal
from ..operators.tokens import TOKEN_PATTERN

WS = duckdb_ws_literal()
NL = "chr(10)"
SOT, EOT = "'<start_of_turn>'", "'<end_of_turn>'"

EV_TURNS = f"""
SELECT user_id AS conv_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS turn,
       CASE WHEN event_type IN ('view', 'click') THEN 'user'
            WHEN event_type IN ('purchase', 'error') THEN 'model' END AS role,
       CASE WHEN value < 20 THEN ''
            ELSE event_type || ':' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS content
FROM events"""

EV_RAW = f"SELECT * FROM ({EV_TURNS}) WHERE role IS NOT NULL"

CONV_TURNS = f"""
SELECT conv_id, turn,
       CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'model' WHEN 'model' THEN 'model' END AS role,
       coalesce(trim(text, {WS}), '') AS content
FROM conversations WHERE role IN ('user', 'assistant', 'model')"""


def filled(src: str) -> str:
    return (
        "SELECT conv_id, turn, role, CASE WHEN content = '' THEN "
        "CASE WHEN role = 'user' THEN 'continue' ELSE 'huh?...' END ELSE content END AS content "
        f"FROM ({src})"
    )


def runs_ctes(turns_sql: str) -> str:
    """CTEs t (turns), rt (turns + h + rid), runs, merged."""
    return f"""
t AS ({turns_sql}),
rt AS (
  SELECT *, sum(h) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS rid
  FROM (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 0 ELSE 1 END AS h FROM t)
),
runs AS (
  SELECT conv_id, rid, min(role) AS role, string_agg(content, {NL} ORDER BY turn) AS content,
         arg_min(content, turn) AS head_content, count(*) AS n_raw
  FROM rt GROUP BY conv_id, rid
),
merged AS (
  SELECT r.conv_id, r.rid, r.role, r.content, r.n_raw,
         CAST(r.rid - 1 - CASE WHEN f.role = 'model' THEN 1 ELSE 0 END AS INTEGER) AS idx
  FROM runs r JOIN runs f ON f.conv_id = r.conv_id AND f.rid = 1
  WHERE NOT (r.rid = 1 AND r.role = 'model')
)"""


def pairs_sql(mode: str) -> str:
    u = "CASE WHEN t.h = 1 THEN ru.content ELSE t.content END" if mode == "observed" else "t.content"
    m = "rm.content" if mode == "observed" else "rm.head_content"
    return f"""
SELECT t.conv_id, 'pair' AS method, 0 AS method_ord, CAST(t.turn AS BIGINT) AS start_idx, 2 AS n_msgs,
       [{{'role': 'user', 'content': {u}}}, {{'role': 'model', 'content': {m}}}] AS msgs
FROM rt t JOIN runs ru ON ru.conv_id = t.conv_id AND ru.rid = t.rid
          JOIN runs rm ON rm.conv_id = t.conv_id AND rm.rid = t.rid + 1
WHERE t.role = 'user'"""


def range_sql(method: str, ord_: int, length: int | None, step: int | None = None) -> str:
    """Samples that end at a model turn: prefixes (length None) or fixed-length windows."""
    if length is None:
        lo, where, start, n = "0", "", "0", "m.idx + 1"
    else:
        lo, start, n = f"m.idx - {length - 1}", f"m.idx - {length - 1}", str(length)
        where = f" AND m.idx >= {length - 1}" + (f" AND (m.idx - {length - 1}) % {step} = 0" if step else "")
    return f"""
SELECT m.conv_id, '{method}' AS method, {ord_} AS method_ord, CAST({start} AS BIGINT) AS start_idx, CAST({n} AS INTEGER) AS n_msgs,
       list({{'role': x.role, 'content': x.content}} ORDER BY x.idx) AS msgs
FROM merged m JOIN merged x ON x.conv_id = m.conv_id AND x.idx BETWEEN {lo} AND m.idx
WHERE m.role = 'model'{where}
GROUP BY m.conv_id, m.idx"""


def dedup(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id, msgs ORDER BY method_ord, start_idx, n_msgs) AS rn FROM ({src})
) WHERE rn = 1"""


RENDER = f"array_to_string(list_transform(msgs, lambda m: {SOT} || m.role || {NL} || m.content || {EOT} || {NL}), '')"


def report(src: str) -> str:
    return f"SELECT conv_id, method, start_idx, n_msgs, md5({RENDER}) AS sample_md5 FROM ({src})"


def with_runs(turns_sql: str, body: str) -> str:
    return f"WITH {runs_ctes(turns_sql)}\n{body}"


def samples_sql(turns_sql: str, mode: str = "observed", pairs=(8, 16), do_dedup: bool = True) -> str:
    parts = [pairs_sql(mode), range_sql("prefix", 1, None)]
    parts += [range_sql(f"window{p}", 2 + j, 2 * p, 2) for j, p in enumerate(pairs)]
    union = "\nUNION ALL\n".join(parts)
    return with_runs(turns_sql, f"SELECT * FROM ({dedup(union) if do_dedup else union})")


EV_FILLED = filled(EV_RAW)
CONV_FILLED = filled(CONV_TURNS)


def keyed_sql(samples: str, seed: int, cap: int | None, percent: float | None, part: str) -> str:
    """Order by md5(seed:sample_id); cap; eval = first ceil(n*p/100.0) keys."""
    k = "CAST(ceil(least(n, cap) * ({p} / 100.0)) AS BIGINT)".format(p=percent) if percent else "0"
    capv = str(cap) if cap else "n"
    cond = {"cap": "rk <= least(n, cap)", "train": f"rk > {k} AND rk <= least(n, cap)", "eval": f"rk <= {k}"}[part]
    return f"""
WITH s AS ({samples}),
ks AS (SELECT *, CAST(conv_id AS VARCHAR) || ':' || method || ':' || CAST(start_idx AS VARCHAR) || ':' || CAST(n_msgs AS VARCHAR) AS sample_id FROM s),
kk AS (SELECT *, md5('{seed}:' || sample_id) AS shuffle_key FROM ks),
rk AS (SELECT *, row_number() OVER (ORDER BY shuffle_key, sample_id) AS rk, count(*) OVER () AS n, {capv} AS cap FROM kk)
SELECT conv_id, method, start_idx, n_msgs, shuffle_key FROM rk WHERE {cond}"""


def eval_subsample_sql(samples: str) -> str:
    return f"""
WITH s AS ({samples}),
ks AS (SELECT *, CAST(conv_id AS VARCHAR) || ':' || method || ':' || CAST(start_idx AS VARCHAR) || ':' || CAST(n_msgs AS VARCHAR) AS sample_id FROM s),
r0 AS (SELECT *, md5('0:' || sample_id) AS shuffle_key,
             row_number() OVER (ORDER BY md5('0:' || sample_id), sample_id) AS rk, count(*) OVER () AS n FROM ks),
ev AS (SELECT * FROM r0 WHERE rk <= CAST(ceil(n * (5 / 100.0)) AS BIGINT)),
r1 AS (SELECT *, md5('42:' || sample_id) AS k42, count(*) OVER () AS m FROM ev),
r2 AS (SELECT *, row_number() OVER (ORDER BY k42, sample_id) AS rk2 FROM r1)
SELECT conv_id, method, start_idx, n_msgs, shuffle_key FROM r2 WHERE m <= 200 OR rk2 <= 200"""


def conv_pairs_sql() -> str:
    return f"""
WITH t AS (SELECT * FROM ({CONV_TURNS}) WHERE content <> ''),
l AS (SELECT *, lag(role) OVER w AS prole, lag(content) OVER w AS pcontent, lag(turn) OVER w AS pturn
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, pturn AS user_turn, turn AS model_turn, pcontent AS instruction, content AS response, CAST(NULL AS VARCHAR) AS context
FROM l WHERE role = 'model' AND prole = 'user'"""


EV_PAIRS = f"""
WITH t AS (SELECT * FROM ({EV_RAW}) WHERE content <> ''),
l AS (SELECT *, lag(role) OVER w AS prole, lag(content) OVER w AS pcontent, lag(turn) OVER w AS pturn
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, pturn AS user_turn, turn AS model_turn, pcontent AS instruction, content AS response, CAST(NULL AS VARCHAR) AS context
FROM l WHERE role = 'model' AND prole = 'user'"""

CONV_RENDERED = f"""SELECT conv_id, method, start_idx, n_msgs, {RENDER} AS text FROM ({samples_sql(CONV_FILLED)})"""

PATTERN = TOKEN_PATTERN.replace("'", "''")
SPECIALS = "('<pad>', 0), ('<eos>', 1), ('<bos>', 2), ('<unk>', 3), ('<start_of_turn>', 4), ('<end_of_turn>', 5)"

VOCAB = f"""
WITH r AS ({CONV_RENDERED}),
tok AS (SELECT unnest(regexp_extract_all(text, '{PATTERN}')) AS token FROM r),
c AS (SELECT token, count(*) AS n FROM tok
      WHERE token NOT IN ('<pad>', '<eos>', '<bos>', '<unk>', '<start_of_turn>', '<end_of_turn>') GROUP BY token),
top AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token ASC) + 5 AS INTEGER) AS id FROM c)
SELECT token, id FROM top WHERE id < 2000
UNION ALL SELECT token, CAST(id AS INTEGER) FROM (VALUES {SPECIALS}) v(token, id)"""

ENCODED = f"""
WITH r AS (SELECT *, CAST(conv_id AS VARCHAR) || ':' || method || ':' || CAST(start_idx AS VARCHAR) || ':' || CAST(n_msgs AS VARCHAR) AS sid
           FROM ({CONV_RENDERED})),
v AS ({VOCAB}),
tl AS (SELECT sid, regexp_extract_all(text, '{PATTERN}') AS toks FROM r),
tok AS (SELECT sid, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM tl),
ids AS (SELECT tok.sid, [2] || list(coalesce(v.id, 3) ORDER BY tok.pos) AS input_ids
        FROM tok LEFT JOIN v ON v.token = tok.token GROUP BY tok.sid)
SELECT r.conv_id, r.method, r.start_idx, r.n_msgs, ids.input_ids FROM r JOIN ids USING (sid)"""

EVALS = """SELECT user_id AS run_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS step,
       value AS eval_loss FROM events"""

DECISIONS = f"""
WITH e AS ({EVALS}),
d AS (SELECT i.run_id, i.step, i.eval_loss,
             (SELECT count(*) FROM e j WHERE j.run_id = i.run_id AND j.step < i.step AND j.eval_loss <= i.eval_loss) AS a
      FROM e i WHERE i.eval_loss IS NOT NULL AND NOT isnan(i.eval_loss))"""

ARTIFACTS = """
SELECT 'runs/c' || CAST(o_custkey AS VARCHAR) AS root,
       CASE WHEN o_orderstatus = 'P' AND starts_with(o_orderpriority, '1') THEN 'runs/c' || CAST(o_custkey AS VARCHAR)
            ELSE 'runs/c' || CAST(o_custkey AS VARCHAR) || '/' ||
                 CASE WHEN o_orderstatus = 'P' THEN 'final_model'
                      WHEN starts_with(o_orderpriority, '5') THEN 'best'
                      ELSE 'checkpoint-' || CAST(o_orderkey AS VARCHAR) END END AS path
FROM orders"""


ORACLE_SQL: dict[str, str] = {
    "turns_normalise": CONV_TURNS,
    "json_docs_to_turns": f"""
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS turn, role, content
FROM (SELECT conv_id, turn,
             CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'model' END AS role,
             coalesce(trim(text, {WS}), '') AS content, role AS r0 FROM conversations)
QUALIFY r0 IN ('user', 'assistant')""",
    "json_dialogue_instruct_pairs": None,  # filled below (needs renumbered turns)
    "json_quarantine": """
SELECT 'doc:' || CAST(doc_id AS VARCHAR) AS doc_key, CASE WHEN json_valid(text) THEN 'parsed' ELSE 'invalid_json' END AS status FROM documents
UNION ALL
SELECT DISTINCT 'conv:' || CAST(conv_id AS VARCHAR) AS doc_key, 'parsed' AS status FROM conversations""",
    "instruct_json_pairs": f"""
SELECT doc_key, turn, trim(p_name, {WS}) AS instruction, trim(p_type, {WS}) AS response, CAST(NULL AS VARCHAR) AS context
FROM (SELECT CAST(CAST(floor(p_partkey / 16) AS BIGINT) AS VARCHAR) AS doc_key,
             CAST(row_number() OVER (PARTITION BY floor(p_partkey / 16) ORDER BY p_partkey) - 1 AS BIGINT) AS turn, * FROM part)
WHERE p_size > 10 AND p_size <> 50 AND trim(p_name, {WS}) <> '' AND trim(p_type, {WS}) <> ''""",
    "instruct_pairs": EV_PAIRS,
    "placeholder_fill": EV_FILLED,
    "role_runs": with_runs(EV_FILLED, "SELECT conv_id, turn, role, CAST(rid AS INTEGER) AS rid, h = 1 AS is_head FROM rt"),
    "merge_runs": with_runs(EV_FILLED, "SELECT conv_id, idx, CAST(rid AS INTEGER) AS rid, role, content, CAST(n_raw AS INTEGER) AS n_raw FROM merged"),
    "block_pairs_observed": with_runs(EV_FILLED, report(pairs_sql("observed"))),
    "block_pairs_raw": with_runs(EV_FILLED, report(pairs_sql("raw"))),
    "expanding_history": with_runs(EV_FILLED, report(range_sql("prefix", 1, None))),
    "expanding_history_conversations": with_runs(CONV_FILLED, report(range_sql("prefix", 1, None))),
    "pair_windows": with_runs(EV_FILLED, report(range_sql("window8", 2, 16, 2) + "\nUNION ALL\n" + range_sql("window16", 3, 32, 2))),
    "pair_windows_conversations": with_runs(CONV_FILLED, report(range_sql("window2", 2, 4, 2) + "\nUNION ALL\n" + range_sql("window3", 3, 6, 2))),
    "strided_windows": with_runs(
        EV_FILLED,
        report(dedup("\nUNION ALL\n".join([
            range_sql("prefix", 0, None),
            range_sql("stride4", 1, 4, 2),
            range_sql("stride8", 2, 8, 6),
            range_sql("stride16", 3, 16, 14),
        ]))),
    ),
    "conversational_samples": report(samples_sql(EV_FILLED, "observed")),
    "conversational_samples_raw": report(samples_sql(EV_FILLED, "raw")),
    "conversational_samples_conversations": report(samples_sql(CONV_FILLED, "observed")),
    "pool_stats": f"""
WITH es AS ({samples_sql(EV_FILLED)}), cs AS ({samples_sql(CONV_FILLED)}),
et AS ({EV_FILLED}), ct AS ({CONV_FILLED})
SELECT 'events.turns' AS stage, conv_id, count(*) AS n FROM et GROUP BY ROLLUP (conv_id)
UNION ALL SELECT 'events.samples', conv_id, count(*) FROM es GROUP BY ROLLUP (conv_id)
UNION ALL SELECT 'conversations.turns', conv_id, count(*) FROM ct GROUP BY ROLLUP (conv_id)
UNION ALL SELECT 'conversations.samples', conv_id, count(*) FROM cs GROUP BY ROLLUP (conv_id)
UNION ALL SELECT 'pool.samples', CAST(NULL AS BIGINT), (SELECT count(*) FROM es) + (SELECT count(*) FROM cs)""",
    "shuffle_cap": keyed_sql(samples_sql(EV_FILLED), 0, 4000, None, "cap"),
    "split_train": keyed_sql(samples_sql(EV_FILLED), 0, 4000, 5, "train"),
    "split_eval": keyed_sql(samples_sql(EV_FILLED), 0, 4000, 5, "eval"),
    "eval_subsample": eval_subsample_sql(samples_sql(EV_FILLED)),
    "render_instruct": f"""
SELECT conv_id, user_turn,
       md5({SOT} || 'user' || {NL} || instruction || {EOT} || {NL} || {SOT} || 'model' || {NL} || response || {EOT}) AS text_md5,
       CAST(length({SOT} || 'user' || {NL} || instruction || {EOT} || {NL} || {SOT} || 'model' || {NL} || response || {EOT}) AS INTEGER) AS n_chars
FROM ({conv_pairs_sql()})""",
    "render_messages": f"SELECT conv_id, method, start_idx, n_msgs, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS n_chars FROM ({CONV_RENDERED})",
    "vocab": VOCAB,
    "encode": f"SELECT conv_id, method, start_idx, n_msgs, CAST(len(input_ids) AS INTEGER) AS n_ids, md5(array_to_string(input_ids, ',')) AS ids_md5 FROM ({ENCODED})",
    "truncate_pad_mask": f"""
WITH e AS (SELECT conv_id, method, start_idx, n_msgs, input_ids[1:512] AS ids FROM ({ENCODED})),
p AS (SELECT *, list_concat(ids, list_transform(range(512 - len(ids)), lambda x: 0)) AS padded,
             list_concat(list_transform(range(len(ids)), lambda x: 1), list_transform(range(512 - len(ids)), lambda x: 0)) AS mask FROM e)
SELECT conv_id, method, start_idx, n_msgs, CAST(len(padded) AS INTEGER) AS n_ids, CAST(list_sum(mask) AS INTEGER) AS n_attended,
       md5(array_to_string(padded, ',')) AS ids_md5,
       md5(array_to_string(list_transform(padded, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END), ',')) AS labels_md5,
       md5(array_to_string(mask, ',')) AS mask_md5
FROM p""",
    "length_report": f"""
SELECT method, count(*) AS n_samples, count(*) FILTER (WHERE len(input_ids) > 512) AS n_truncated,
       CAST(max(len(input_ids)) AS INTEGER) AS max_tokens, CAST(min(len(input_ids)) AS INTEGER) AS min_tokens,
       CAST(sum(len(input_ids)) AS BIGINT) AS total_tokens,
       round(quantile_cont(CAST(len(input_ids) AS DOUBLE), 0.5), 4) AS p50, round(quantile_cont(CAST(len(input_ids) AS DOUBLE), 0.9), 4) AS p90,
       round(quantile_cont(CAST(len(input_ids) AS DOUBLE), 0.95), 4) AS p95, round(quantile_cont(CAST(len(input_ids) AS DOUBLE), 0.99), 4) AS p99
FROM ({ENCODED}) GROUP BY method""",
    "length_sketch": f"""
SELECT method, count(*) AS n_samples, percentile, true AS within
FROM ({ENCODED}) CROSS JOIN (SELECT unnest([50, 90, 95, 99]) AS percentile) GROUP BY method, percentile""",
    "validate_samples": f"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_unparsable, CAST(0 AS BIGINT) AS n_missing_keys, true AS is_valid, 'events.conversational' AS dataset
FROM ({samples_sql(EV_FILLED)})
UNION ALL
SELECT count(*), 0, 0, true, 'conversations.instruct' FROM ({conv_pairs_sql()})
UNION ALL
SELECT count(*), 0, count(*), count(*) = 0, 'instruct lines read as conversational' FROM ({conv_pairs_sql()})
UNION ALL
SELECT count(*), count(*) FILTER (WHERE NOT coalesce(json_valid(text), false)), count(*) FILTER (WHERE coalesce(json_valid(text), false)), count(*) = 0, 'documents.prose' FROM documents""",
    "best_k_decisions": f"{DECISIONS} SELECT run_id, step, eval_loss, a < 2 AS saved FROM d",
    "best_k_prunes": f"""{DECISIONS},
s AS (SELECT * FROM d WHERE a < 2),
later AS (SELECT s.run_id, s.step, j.step AS jstep, s.a,
                 row_number() OVER (PARTITION BY s.run_id, s.step ORDER BY j.step) AS r
          FROM s JOIN (SELECT * FROM e WHERE eval_loss IS NOT NULL AND NOT isnan(eval_loss)) j
            ON j.run_id = s.run_id AND j.step > s.step AND j.eval_loss < s.eval_loss)
SELECT s.run_id, s.step, s.eval_loss, l.jstep AS pruned_at_step
FROM s LEFT JOIN later l ON l.run_id = s.run_id AND l.step = s.step AND l.r = 2 - s.a""",
    "best_k_final": f"""
SELECT run_id, CAST(rk AS INTEGER) AS rank, step, eval_loss FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) AS rk FROM ({EVALS})
  WHERE eval_loss IS NOT NULL AND NOT isnan(eval_loss)) WHERE rk <= 2""",
    "last_n": f"""
SELECT run_id, CAST(rk AS INTEGER) AS rank, step FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS rk FROM ({EVALS}) WHERE step % 20 = 0) WHERE rk <= 2""",
    "resolve_artifact": f"""
WITH a AS ({ARTIFACTS}),
k AS (SELECT root, path,
             CASE WHEN path = root THEN 0 WHEN path = root || '/final_model' THEN 1 ELSE 2 END AS prio,
             coalesce(TRY_CAST(trim(string_split(path, 'checkpoint-')[-1]) AS BIGINT), -1) AS step FROM a)
SELECT root, path, step FROM k
QUALIFY row_number() OVER (PARTITION BY root ORDER BY prio, step DESC, path) = 1""",
    "runs": f"""
SELECT run_id, count(*) AS n_evals, min(step) AS first_step, max(step) AS last_step,
       arg_max(eval_loss, step) AS last_loss, min(eval_loss) AS best_loss
FROM ({EVALS}) WHERE eval_loss IS NOT NULL AND NOT isnan(eval_loss) GROUP BY run_id""",
    "eval_log": """
SELECT run_id, step, metric, value FROM (
  SELECT user_id AS run_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS step,
         CASE event_type WHEN 'view' THEN 'loss' WHEN 'click' THEN 'grad_norm' WHEN 'purchase' THEN 'eval_loss'
                         WHEN 'error' THEN 'learning_rate' WHEN 'signup' THEN 'epoch' END AS metric, value FROM events)
WHERE metric = 'eval_loss'""",
    "eval_schedule": f"SELECT run_id, step, eval_loss FROM ({EVALS}) WHERE step % 20 = 0",
}

_DIALOGUE_TURNS = f"""
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS turn,
       CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'model' END AS role,
       coalesce(trim(text, {WS}), '') AS content, role AS r0
FROM conversations"""

ORACLE_SQL["json_dialogue_instruct_pairs"] = f"""
WITH t AS (SELECT conv_id, turn, role, content FROM ({_DIALOGUE_TURNS}) WHERE r0 IN ('user', 'assistant') AND content <> ''),
l AS (SELECT *, lag(role) OVER w AS prole, lag(content) OVER w AS pcontent, lag(turn) OVER w AS pturn
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, pturn AS user_turn, turn AS model_turn, pcontent AS instruction, content AS response, CAST(NULL AS VARCHAR) AS context
FROM l WHERE role = 'model' AND prole = 'user'"""
ORACLE_SQL["json_docs_to_turns"] = f"SELECT conv_id, turn, role, content FROM ({_DIALOGUE_TURNS}) WHERE r0 IN ('user', 'assistant')"

ORACLE_SQL["encode_by_join"] = ORACLE_SQL["encode"]
_SESSIONS = """
WITH e AS (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS arrival,
                  (CAST(floor(epoch(ts)) AS BIGINT) % 86400) // 60 AS step, value AS eval_loss FROM events),
l AS (SELECT *, lag(step) OVER (PARTITION BY run_id ORDER BY arrival) AS earlier FROM e),
s AS (SELECT run_id, step, eval_loss,
             CAST(1 + sum(CASE WHEN step <= earlier THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY arrival) AS BIGINT) AS session FROM l),
ok AS (SELECT * FROM s WHERE eval_loss IS NOT NULL AND NOT isnan(eval_loss)),
d AS (SELECT a.run_id, a.session, a.step, a.eval_loss, count(b.step) AS a
      FROM ok a LEFT JOIN ok b ON b.run_id = a.run_id AND b.session = a.session AND b.step < a.step AND b.eval_loss <= a.eval_loss
      GROUP BY ALL),
later AS (SELECT c.run_id, c.session, c.step, j.step AS jstep,
                 row_number() OVER (PARTITION BY c.run_id, c.session, c.step ORDER BY j.step) AS r, c.a
          FROM d c JOIN ok j ON j.run_id = c.run_id AND j.session = c.session AND j.step > c.step AND j.eval_loss < c.eval_loss
          WHERE c.a < 2)"""
_PRUNED = "SELECT d.*, l.jstep AS pruned_at_step FROM d LEFT JOIN later l ON l.run_id = d.run_id AND l.session = d.session AND l.step = d.step AND l.r = 2 - d.a"
ORACLE_SQL["best_k_sessions"] = f"{_SESSIONS} SELECT run_id, session, step, eval_loss, a < 2 AS saved, pruned_at_step FROM ({_PRUNED})"
ORACLE_SQL["best_k_final_sessions"] = f"""{_SESSIONS}
SELECT run_id, session, CAST(rk AS INTEGER) AS rank, step, eval_loss FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, session ORDER BY eval_loss, step) AS rk FROM ok) WHERE rk <= 2"""
ORACLE_SQL["session_best_k_stream"] = f"""{_SESSIONS}
SELECT d.run_id, d.session, d.step, d.eval_loss, d.a < 2 AS saved, p.step AS pruned_step
FROM d LEFT JOIN ({_PRUNED}) p ON p.run_id = d.run_id AND p.session = d.session AND p.pruned_at_step = d.step"""

ORACLE_SQL["json_large_docs"] = f"""
SELECT doc, turn, CASE role WHEN 'user' THEN 'user' ELSE 'model' END AS role, coalesce(trim(text, {WS}), '') AS content
FROM (SELECT doc, role, text, CAST(row_number() OVER (PARTITION BY doc ORDER BY conv_id, turn) - 1 AS BIGINT) AS turn
      FROM (SELECT *, 'd' || CAST(CAST(floor(conv_id / 64) AS BIGINT) AS VARCHAR) || 'p' || CAST(CAST(floor(turn / 10000) AS BIGINT) AS VARCHAR) AS doc FROM conversations))
WHERE role IN ('user', 'assistant')"""

ORACLE_SQL["best_k_stream"] = f"""
SELECT b.run_id, b.step, b.eval_loss, b.saved, coalesce(p.steps, '') AS pruned_steps
FROM ({ORACLE_SQL["best_k_decisions"]}) b
LEFT JOIN (SELECT run_id, pruned_at_step, string_agg(CAST(step AS VARCHAR), ',' ORDER BY step) AS steps
           FROM ({ORACLE_SQL["best_k_prunes"]}) WHERE pruned_at_step IS NOT NULL GROUP BY run_id, pruned_at_step) p
  ON p.run_id = b.run_id AND p.pruned_at_step = b.step"""
ORACLE_SQL["jsonl_roundtrip"] = f"""
WITH s AS ({samples_sql(CONV_FILLED)}),
ks AS (SELECT *, CAST(conv_id AS VARCHAR) || ':' || method || ':' || CAST(start_idx AS VARCHAR) || ':' || CAST(n_msgs AS VARCHAR) AS sample_id FROM s),
rk AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || sample_id), sample_id) AS rk, count(*) OVER () AS n FROM ks)
SELECT CASE WHEN rk <= CAST(ceil(least(n, 4000) * (5 / 100.0)) AS BIGINT) THEN 'eval' ELSE 'train' END AS split,
       md5({RENDER}) AS sample_md5
FROM rk WHERE rk <= least(n, 4000)"""


# Trainer logs: the last checkpoint of a run holds every step; NaN norms show as NULL.
_METRICS = """
SELECT 'runs/c' || CAST(user_id AS VARCHAR) AS run_id, 'checkpoint-' || CAST(max(step) OVER (PARTITION BY user_id) AS VARCHAR) AS checkpoint, step, metric,
       CASE WHEN metric = 'grad_norm' AND value < 20 THEN NULL ELSE value END AS value
FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step, value,
             CASE event_type WHEN 'view' THEN 'loss' WHEN 'click' THEN 'grad_norm' WHEN 'purchase' THEN 'eval_loss' WHEN 'error' THEN 'learning_rate' WHEN 'signup' THEN 'epoch' END AS metric
      FROM events)
WHERE metric IS NOT NULL"""
_ORDER_PATHS = """
SELECT 'runs/c' || CAST(o_custkey AS VARCHAR) AS root,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority LIKE '1%' THEN 'runs/c' || CAST(o_custkey AS VARCHAR)
            ELSE 'runs/c' || CAST(o_custkey AS VARCHAR) || '/' || CASE WHEN o_orderstatus = 'P' THEN 'final_model' WHEN o_orderpriority LIKE '5%' THEN 'best' ELSE 'checkpoint-' || CAST(o_orderkey AS VARCHAR) END END AS path
FROM orders"""
_LISTED = f"""
SELECT DISTINCT root, dir AS path
FROM (SELECT root, path || CASE WHEN length(path) % 3 = 0 THEN '/old' ELSE '' END AS dir FROM ({_ORDER_PATHS}))
WHERE dir = root OR regexp_replace(dir, '/[^/]+$', '') = root"""
_RUN_EVALS = f"SELECT run_id, step, value AS eval_loss FROM ({_METRICS}) WHERE metric = 'eval_loss'"

ORACLE_SQL["run_metrics"] = f"SELECT run_id, checkpoint, CAST(step AS BIGINT) AS step, metric, value FROM ({_METRICS})"
ORACLE_SQL["artifact_listing"] = _LISTED
ORACLE_SQL["run_report"] = f"""
WITH e AS ({_RUN_EVALS}),
r AS (SELECT run_id, count(*) AS n_evals, CAST(min(step) AS BIGINT) AS first_step, CAST(max(step) AS BIGINT) AS last_step,
             arg_max(eval_loss, step) AS last_loss, min(eval_loss) AS best_loss FROM e GROUP BY run_id),
b AS (SELECT run_id, string_agg(CAST(step AS VARCHAR), ',' ORDER BY rk) AS best_steps
      FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) AS rk FROM e) WHERE rk <= 2 GROUP BY run_id),
k AS (SELECT root, path, CASE WHEN path = root THEN 0 WHEN path = root || '/final_model' THEN 1 ELSE 2 END AS prio,
             coalesce(TRY_CAST(trim(string_split(path, 'checkpoint-')[-1]) AS BIGINT), -1) AS step FROM ({_LISTED})),
a AS (SELECT root, path FROM k QUALIFY row_number() OVER (PARTITION BY root ORDER BY prio, step DESC, path) = 1)
SELECT r.*, b.best_steps, a.path AS artifact FROM r LEFT JOIN b ON b.run_id = r.run_id LEFT JOIN a ON a.root = r.run_id"""
ORACLE_SQL["jsonl_order"] = f"""
WITH s AS ({samples_sql(CONV_FILLED)}),
ks AS (SELECT *, CAST(conv_id AS VARCHAR) || ':' || method || ':' || CAST(start_idx AS VARCHAR) || ':' || CAST(n_msgs AS VARCHAR) AS sample_id FROM s),
rk AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || sample_id), sample_id) AS rk, count(*) OVER () AS n FROM ks),
k AS (SELECT *, CAST(ceil(least(n, 4000) * (5 / 100.0)) AS BIGINT) AS k FROM rk WHERE rk <= least(n, 4000))
SELECT CASE WHEN rk <= k THEN 'eval' ELSE 'train' END AS split, CASE WHEN rk <= k THEN rk ELSE rk - k END AS place, md5({RENDER}) AS sample_md5 FROM k"""
