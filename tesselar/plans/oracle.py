"""DuckDB SQL twins of the registered queries."""

from __future__ import annotations

from tesselar.functions.text import HEXTET, IPV4, IPV6_FULL, IPV6_SHORT
from tesselar.operators.alarms import DEFAULT_RULES
from tesselar.operators.scaling import PolicyParams
from tesselar.plans.queries import (
    BLOCKS,
    HEALTH_RUNS,
    LINE_ORDER,
    NO_BALANCER,
    OFFSET,
    PERIOD,
    PHRASE,
    RANK,
    SCALING,
    SEED,
)
from tesselar.plans.views import AGE_CODES

EPOCH = "TIMESTAMP '1970-01-01'"

RATINGS = """ratings AS (
  SELECT o_custkey AS i, l_partkey AS j, CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS r
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

EXTENT = f"""{RATINGS},
extent AS (SELECT max(i) AS max_i, max(j) AS max_j FROM ratings),
dims AS (SELECT (max_i + {BLOCKS}) // {BLOCKS} AS di, (max_j + {BLOCKS}) // {BLOCKS} AS dj FROM extent)"""

BLOCKED = f"""{EXTENT},
blocked AS (
  SELECT i, j, r, CAST(i // di AS INTEGER) AS rb, CAST(j // dj AS INTEGER) AS cb,
         CAST((j // dj - i // di + {BLOCKS}) % {BLOCKS} AS INTEGER) AS s
  FROM ratings, dims)"""

IDS = """ids AS (
  SELECT DISTINCT 'W' AS role, i AS id FROM ratings
  UNION ALL SELECT DISTINCT 'H' AS role, j AS id FROM ratings)"""


def _value(seed: str, k: str) -> str:
    digits = f"substr(md5(concat_ws(':', {seed}, id, {k})), 1, 13)"
    return f"(CAST('0x' || {digits} AS BIGINT) / CAST(4503599627370496 AS DOUBLE))"


def _vec(role: str, seed: int) -> str:
    seeds = f"CASE WHEN {role} = 'W' THEN {seed} ELSE {seed + 1} END"
    return f"[{', '.join(_value(f'({seeds})', str(k)) for k in range(RANK))}]"


FACTORS = f"""{IDS},
factors AS (SELECT role, id, {_vec('role', SEED)} AS vec FROM ids)"""

JOINED = """joined AS (
  SELECT b.*, w.vec AS w, h.vec AS h, list_dot_product(w.vec, h.vec) AS prediction
  FROM {side} b
  JOIN factors w ON w.role = 'W' AND w.id = b.i
  JOIN factors h ON h.role = 'H' AND h.id = b.j)"""

KEYED = f"""{BLOCKED},
w AS (SELECT DISTINCT i AS id, rb AS key FROM blocked),
h AS (SELECT DISTINCT j AS id, cb, CAST((cb - {OFFSET} + {BLOCKS}) % {BLOCKS} AS INTEGER) AS key FROM blocked)"""

BLOCK_JOIN = f"""{KEYED},
ws AS (SELECT key, count(*) AS w_rows, min(id) AS w_first, max(id) AS w_last FROM w GROUP BY key),
hs AS (SELECT key, count(*) AS h_rows, min(id) AS h_first, max(id) AS h_last FROM h GROUP BY key),
wh AS (SELECT key, w_rows, w_first, w_last, h_rows, h_first, h_last FROM ws JOIN hs USING (key))"""


def _stats(period: int) -> str:
    return f"""(
  SELECT event_type AS dim, time_bucket(INTERVAL {period} SECOND, ts, {EPOCH}) AS t,
         avg(value) AS average, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration
  FROM events GROUP BY 1, 2)"""


STATS = f"stats AS {_stats(PERIOD)}"

LABELLED = f"""{STATS},
recent AS (
  SELECT dim, t, avg(average) OVER (PARTITION BY dim ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS last_avg
  FROM stats),
labelled AS (
  SELECT dim, t, last_avg,
         CASE WHEN last_avg >= {SCALING.upper} THEN 'up' WHEN last_avg <= {SCALING.lower} THEN 'down'
              ELSE 'neutral' END AS label
  FROM recent)"""

MEMBERS = """members AS (
  SELECT event_id AS seq, user_id % 4 AS balancer,
         CASE WHEN event_type = 'signup' THEN 'add' ELSE 'remove' END AS op,
         '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip
  FROM events WHERE event_type IN ('signup', 'error'))"""

ACTIVE = f"""{MEMBERS},
levels AS (
  SELECT *, CAST(sum(CASE WHEN op = 'add' THEN 1 ELSE -1 END) OVER (PARTITION BY balancer, ip ORDER BY seq) AS BIGINT) AS level
  FROM members),
kept AS (
  SELECT balancer, ip, arg_max(level, seq) - least(0, min(level)) AS n FROM levels GROUP BY balancer, ip),
newest AS (
  SELECT balancer, ip, seq, row_number() OVER (PARTITION BY balancer, ip ORDER BY seq DESC) AS back
  FROM members WHERE op = 'add'),
active AS (
  SELECT balancer, seq, ip FROM newest JOIN kept USING (balancer, ip) WHERE back <= n)"""

LOG = """log AS (
  SELECT strftime(ts, '%Y-%m-%d') AS run_id, epoch_us(ts) * 2 + 1 AS seq,
         'ec2-' || user_id || '=' || value AS line
  FROM events
  UNION ALL
  SELECT strftime(ts, '%Y-%m-%d'), min(epoch_us(ts)) * 2, '[Minute ' || hour(ts) || ']'
  FROM events GROUP BY strftime(ts, '%Y-%m-%d'), hour(ts))"""

ALARMS = "alarms AS (" + " UNION ALL ".join(
    f"""
  SELECT '{rule.name}' AS rule, dim, t, average, CAST({rule.adjustment} AS INTEGER) AS adjustment
  FROM {_stats(rule.period)} WHERE average {rule.comparison} {rule.threshold}"""
    for rule in DEFAULT_RULES
) + ")"


def _health(up: int, down: int) -> str:
    """Runs by grouped islands, states by the last flip."""
    return f"""WITH probes AS (
  SELECT ts, event_id AS seq, user_id AS instance, event_type <> 'error' AS ok FROM events),
islands AS (
  SELECT *, row_number() OVER (PARTITION BY instance ORDER BY ts, seq)
          - row_number() OVER (PARTITION BY instance, ok ORDER BY ts, seq) AS island
  FROM probes),
runs AS (
  SELECT *, row_number() OVER (PARTITION BY instance, ok, island ORDER BY ts, seq) AS run FROM islands),
flips AS (
  SELECT *, CASE WHEN ok AND run >= {up} THEN 'healthy' WHEN NOT ok AND run >= {down} THEN 'unhealthy' END AS flip
  FROM runs)
SELECT instance, ts, seq,
       coalesce(last_value(flip IGNORE NULLS) OVER (
         PARTITION BY instance ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'unknown') AS state
FROM flips"""


def _scaling() -> str:
    p = SCALING
    down = f"n.down >= {p.count} AND n.size > {p.min_size}"
    up = f"n.up >= {p.count} AND n.size < {p.max_size}"
    return f"""WITH RECURSIVE {LABELLED},
ticks AS (
  SELECT dim, t, label, epoch_us(t) AS us, row_number() OVER (PARTITION BY dim ORDER BY t) AS k FROM labelled),
walk AS (
  SELECT dim, CAST(0 AS BIGINT) AS k, CAST(NULL AS TIMESTAMP) AS t, CAST(NULL AS VARCHAR) AS label,
         CAST(0 AS BIGINT) AS up, CAST(0 AS BIGINT) AS down, CAST({p.min_size} AS BIGINT) AS size,
         CAST(-1 AS BIGINT) AS resume, CAST(0 AS BIGINT) AS action
  FROM (SELECT DISTINCT dim FROM ticks)
  UNION ALL
  SELECT dim, k, t, label, up, down, CAST(size + action AS BIGINT),
         CAST(CASE WHEN live AND action <> 0 AND {p.delta} = 1 AND down >= {p.count}
              THEN us + {(p.cooldown + p.period) * 1_000_000} ELSE resume END AS BIGINT), CAST(action AS BIGINT)
  FROM (
    SELECT n.*, CASE WHEN NOT live THEN 0 WHEN {down} THEN -1 WHEN {up} THEN 1 ELSE 0 END AS action
    FROM (
      SELECT w.dim, x.k, x.t, x.us, x.label, w.size, w.resume, x.us >= w.resume AS live,
             CAST(CASE WHEN x.us < w.resume OR x.label = 'down' THEN w.up WHEN x.label = 'up' THEN w.up + 1 ELSE 0 END AS BIGINT) AS up,
             CAST(CASE WHEN x.us < w.resume OR x.label = 'up' THEN w.down WHEN x.label = 'down' THEN w.down + 1 ELSE 0 END AS BIGINT) AS down
      FROM walk w JOIN ticks x ON x.dim = w.dim AND x.k = w.k + 1) n))
SELECT dim, t, label, size, action FROM walk WHERE k > 0"""


def _policy() -> str:
    p = PolicyParams()
    names = [rule.name for rule in p.rules]
    cooldown = {rule.name: rule.cooldown * 1_000_000 for rule in p.rules}
    resumes = ", ".join(f"CAST(-1 AS BIGINT) AS resume_{name}" for name in names)
    resume = "CASE x.rule " + " ".join(f"WHEN '{n}' THEN w.resume_{n}" for n in names) + " END"
    kept = ", ".join(
        f"CAST(CASE WHEN action <> 0 AND rule = '{n}' THEN us + {cooldown[n]} ELSE resume_{n} END AS BIGINT)"
        for n in names
    )
    carried = ", ".join(f"w.resume_{n}" for n in names)
    return f"""WITH RECURSIVE {ALARMS},
steps AS (
  SELECT dim, t, rule, adjustment, epoch_us(t) AS us,
         row_number() OVER (PARTITION BY dim ORDER BY t, rule) AS k FROM alarms),
walk AS (
  SELECT dim, CAST(0 AS BIGINT) AS k, CAST(NULL AS TIMESTAMP) AS t, CAST(NULL AS VARCHAR) AS rule,
         CAST({p.min_size} AS BIGINT) AS size, CAST(0 AS BIGINT) AS action, {resumes}
  FROM (SELECT DISTINCT dim FROM steps)
  UNION ALL
  SELECT dim, k, t, rule, CAST(size + action AS BIGINT), CAST(action AS BIGINT), {kept}
  FROM (
    SELECT w.dim, x.k, x.t, x.us, x.rule, w.size, {carried},
           CASE WHEN x.us < {resume} THEN 0
                ELSE least(greatest(w.size + x.adjustment, {p.min_size}), {p.max_size}) - w.size END AS action
    FROM walk w JOIN steps x ON x.dim = w.dim AND x.k = w.k + 1))
SELECT dim, t, rule, size, action FROM walk WHERE k > 0"""


def _closed(column: str, period: int, delay: str = "10 minutes") -> str:
    return f"{column} + INTERVAL {period} SECOND <= (SELECT max(ts) - INTERVAL {delay} FROM events)"


def _streamed_alarms() -> str:
    rules = " OR ".join(
        f"(rule = '{rule.name}' AND {_closed('t', rule.period)})" for rule in DEFAULT_RULES
    )
    return (
        f"WITH {ALARMS} SELECT rule, dim, t, round(average, 6) AS average, adjustment "
        f"FROM alarms WHERE {rules}"
    )


def _addresses() -> str:
    hexed = "hex(user_id)"
    spellings = [
        "'10.0.' || (user_id // 256) || '.' || (user_id % 256)",
        "'10.' || user_id || '.0.1'",
        f"'2001:db8::' || {hexed}",
        f"'1:2:3:4:5:6:7:' || {hexed}",
        "'::ffff:10.0.0.' || user_id",
        f"'1::2::' || {hexed}",
        "'host-' || user_id",
    ]
    hexed_sql = ", ".join(spellings).replace(hexed, "lower(to_hex(user_id))")
    return f"""WITH asked AS (
  SELECT event_id AS seq, [{hexed_sql}][CAST(event_id % {len(spellings)} AS INTEGER) + 1] AS ip FROM events),
plain AS (SELECT seq, ip, regexp_replace(ip, ':{IPV4}$', ':0:0') AS groups FROM asked)
SELECT seq, ip, CAST(CASE WHEN regexp_matches(ip, '^{IPV4}$') OR regexp_matches(groups, '{IPV6_FULL}')
    OR (regexp_matches(groups, '{IPV6_SHORT}') AND len(regexp_extract_all(groups, '{HEXTET}')) <= 7)
  THEN 200 ELSE 400 END AS INTEGER) AS status
FROM plain"""


def _vector_rows(source: str, digits: int = 9, table: str = "factors") -> str:
    return (
        f"WITH {source} SELECT role, id, CAST(k AS INTEGER) AS k, round(vec[k + 1], {digits}) AS value "
        f"FROM {table}, range({RANK}) AS positions(k)"
    )


def _steps(
    chosen: str, epochs: int, eta: float = 0.015, turn: str = "s", order: str = "i, j, r", factors: str = FACTORS
) -> str:
    """Samples in block order, and the step at which each is learned.

    A sample comes one level after the last earlier sample of its block with the same user or item;
    the samples of a level do not affect each other and make one step.
    """
    return f"""{BLOCKED}, {factors},
numbered AS MATERIALIZED (
  SELECT {turn} AS s, rb, i, j, r, row_number() OVER (ORDER BY {turn}, rb, {order}) AS n
  FROM blocked WHERE {chosen}),
samples AS MATERIALIZED (
  SELECT *, lag(n) OVER (PARTITION BY s, rb, i ORDER BY n) AS before_i,
            lag(n) OVER (PARTITION BY s, rb, j ORDER BY n) AS before_j FROM numbered),
levels(n, lvl) USING KEY (n) AS (
  SELECT n, 1 FROM samples WHERE before_i IS NULL AND before_j IS NULL
  UNION
  SELECT x.n, 1 + greatest(coalesce(a.lvl, 0), coalesce(b.lvl, 0))
  FROM samples x LEFT JOIN recurring.levels a ON a.n = x.before_i
                 LEFT JOIN recurring.levels b ON b.n = x.before_j
  WHERE (a.n IS NOT NULL OR x.before_i IS NULL) AND (b.n IS NOT NULL OR x.before_j IS NULL)
    AND x.n NOT IN (SELECT n FROM recurring.levels)),
steps AS MATERIALIZED (
  SELECT i, j, r, CAST({eta} AS DOUBLE) * pow(CAST(0.99 AS DOUBLE), epoch) AS eta,
         dense_rank() OVER (ORDER BY epoch, s, lvl) AS n
  FROM samples JOIN levels USING (n), range({epochs}) AS epochs(epoch))"""


def _model(name: str, last_step: str, w_used: str = "w") -> str:
    return f"""{name}(role, id, vec, n) USING KEY (role, id) AS (
  SELECT role, id, vec, CAST(0 AS BIGINT) FROM factors
  UNION
  SELECT changed.role, changed.id, changed.vec, n FROM (
    SELECT n, unnest([{{'role': 'W', 'id': i, 'vec': w_new}},
                      {{'role': 'H', 'id': j, 'vec': list_transform(list_zip(h, {w_used}), lambda x: x[1] + step * x[2])}}]) AS changed
    FROM (
      SELECT *, list_transform(list_zip(w, h), lambda x: x[1] + step * x[2]) AS w_new
      FROM (
        SELECT x.i, x.j, x.n, w.vec AS w, h.vec AS h, 2 * x.eta * (x.r - list_dot_product(w.vec, h.vec)) AS step
        FROM steps x
        JOIN recurring.{name} w ON w.role = 'W' AND w.id = x.i
        JOIN recurring.{name} h ON h.role = 'H' AND h.id = x.j
        WHERE x.n = (SELECT max(n) + 1 FROM {name}) AND x.n <= {last_step}))))"""


def _learned(
    chosen: str,
    epochs: int,
    w_used: str = "w",
    eta: float = 0.015,
    turn: str = "s",
    more: str = "",
    order: str = "i, j, r",
    factors: str = FACTORS,
) -> str:
    return (
        f"WITH RECURSIVE {_steps(chosen, epochs, eta, turn, order, factors)}, {_model('model', '(SELECT max(n) FROM steps)', w_used)} "
        f"SELECT role, id, {more}CAST(k AS INTEGER) AS k, round(vec[k + 1], 6) AS value FROM model, range({RANK}) AS positions(k)"
    )


def _log(epochs: int) -> str:
    """Every epoch's model is learned from the start again, up to the last step of the epoch."""
    parts, rows = [_steps("true", epochs)], []
    for epoch in range(epochs):
        name = f"model{epoch}"
        parts.append(_model(name, f"(SELECT max(n) * {epoch + 1} // {epochs} FROM steps)"))
        rows.append(f"""SELECT CAST({epoch} AS INTEGER) AS iteration, round(sum(d * d), 6) AS squared_error,
  round(sqrt(sum(d * d) / count(*)), 6) AS rmse
FROM (SELECT r - list_dot_product(w.vec, h.vec) AS d FROM ratings
      JOIN {name} w ON w.role = 'W' AND w.id = i JOIN {name} h ON h.role = 'H' AND h.id = j)""")
    return f"WITH RECURSIVE {', '.join(parts)} {' UNION ALL '.join(rows)}"


RESPONSES = """responses AS (
  SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN text || chr(10) || 'started test.' || doc_id || '.log test.0.log' ELSE text END AS text
  FROM documents)"""

DENSE_FACTORS = f"""factors AS (
  SELECT role, id, {_vec('role', SEED)} AS vec
  FROM (SELECT 'W' AS role, unnest(range(max_i + 1)) AS id FROM extent
        UNION ALL SELECT 'H', unnest(range(max_j + 1)) FROM extent))"""
DENSE = f"{EXTENT}, {DENSE_FACTORS}"

LIVE = """asked AS (
  SELECT event_id AS seq, user_id % 4 AS balancer, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 END AS kind,
         '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip
  FROM events WHERE event_type IN ('signup', 'purchase', 'error') AND event_id % 17 <> 0),
stretches AS (
  SELECT *, count(*) FILTER (kind = 1) OVER key AS adds, count(*) FILTER (kind = 3) OVER key - CAST(kind = 3 AS INTEGER) AS fails
  FROM asked WINDOW key AS (PARTITION BY balancer, ip ORDER BY seq)),
sums AS (
  SELECT *, sum(CASE kind WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END) OVER (PARTITION BY balancer, ip, fails ORDER BY seq) AS total FROM stretches),
queue AS (
  SELECT *, adds - CASE WHEN kind = 3 THEN 0 ELSE total - least(0, min(total) OVER (PARTITION BY balancer, ip, fails ORDER BY seq)) END AS gone FROM sums),
drops AS (
  SELECT balancer, ip, gone AS number, seq AS removed_at
  FROM (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY balancer, ip ORDER BY seq) AS before FROM queue) WHERE kind = 2 AND gone > before),
fails AS (SELECT balancer, ip, fails, seq AS evicted_at FROM queue WHERE kind = 3),
live AS (
  SELECT q.balancer, q.seq, q.ip, 'DC-' || (row_number() OVER (PARTITION BY q.balancer ORDER BY q.seq) - 1) AS name,
         coalesce(removed_at, evicted_at) AS left_at,
         CASE WHEN removed_at IS NOT NULL THEN 'removed' WHEN evicted_at IS NOT NULL THEN 'evicted' END AS reason
  FROM queue q LEFT JOIN drops d ON d.balancer = q.balancer AND d.ip = q.ip AND d.number = q.adds
  LEFT JOIN fails f ON f.balancer = q.balancer AND f.ip = q.ip AND f.fails = q.fails
  WHERE kind = 1)"""

ORACLE: dict[str, str] = {
    "ratings_scan": f"WITH {RATINGS} SELECT i, j, r FROM ratings",
    "movielens_scan": """SELECT o_custkey AS user_id, l_partkey AS movie_id,
  CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating,
  CAST(date_trunc('second', l_shipdate) AS TIMESTAMP) AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "movielens_scan_users": f"""SELECT c_custkey AS user_id,
  CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CAST([{', '.join(map(str, AGE_CODES))}][c_custkey % {len(AGE_CODES)} + 1] AS INTEGER) AS age,
  CAST(c_nationkey % 21 AS INTEGER) AS occupation,
  lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS zip_code
FROM customer""",
    "movielens_scan_movies": """SELECT p_partkey AS movie_id, p_name || ' (' || (1950 + p_size) || ')' AS title,
  unnest(string_split(p_type, ' ')) AS genre FROM part""",
    "line_count": f"WITH {RATINGS} SELECT count(*) AS lines FROM ratings",
    "factors_to_csv": f"""WITH {RATINGS}, {FACTORS}
SELECT role, row_number() OVER (PARTITION BY role ORDER BY id) - 1 AS number, array_to_string(list_transform(vec, lambda v: CAST(CAST(round(v, 6) AS DECIMAL(18, 6)) AS VARCHAR)), ',') AS line
FROM factors""",
    "factors_from_csv": f"""WITH {RATINGS}, {FACTORS},
placed AS (SELECT role, row_number() OVER (PARTITION BY role ORDER BY id) - 1 AS id, vec FROM factors)
SELECT role, id, CAST(k AS INTEGER) AS k, round(vec[k + 1], 6) AS value
FROM placed, range({RANK}) AS positions(k)""",
    "blocks_write": f"WITH {BLOCKED} SELECT i, j, r, rb, cb FROM blocked",
    "load_log_scan": """WITH split AS (
  SELECT doc_id AS run_id, string_split(text, chr(10)) AS lines FROM documents)
SELECT run_id, unnest(range(len(lines) - 1)) AS seq, unnest(lines[1:len(lines) - 1]) AS line FROM split""",
    "row_block": f"WITH {BLOCKED} SELECT i, rb FROM blocked",
    "col_block": f"WITH {BLOCKED} SELECT j, cb FROM blocked",
    "block_one_based": f"""WITH {EXTENT},
ones AS (SELECT greatest((max_i + {BLOCKS} - 1) // {BLOCKS}, 1) AS di,
                greatest((max_j + {BLOCKS} - 1) // {BLOCKS}, 1) AS dj FROM extent)
SELECT i, j, CAST(greatest(i - 1, 0) // di AS INTEGER) AS rb, CAST(greatest(j - 1, 0) // dj AS INTEGER) AS cb
FROM ratings, ones""",
    "stratum_select": f"WITH {BLOCKED} SELECT i, j, r, rb, cb, s FROM blocked WHERE s = {OFFSET}",
    "rotate_item_blocks": f"WITH {KEYED} SELECT id, cb, key FROM h",
    "predict": f"""WITH {RATINGS}, {FACTORS}, {JOINED.format(side='ratings')}
SELECT i, j, r, round(prediction, 6) AS prediction FROM joined""",
    "log_id_extract": f"""WITH {RESPONSES}
SELECT id, regexp_extract(text, '(test\\.\\d{{1,}}\\.log)', 1) AS log_name FROM responses""",
    "text_contains_flag": f"WITH {RESPONSES} SELECT id, contains(text, '{PHRASE}') AS found FROM responses",
    "threshold_label": f"WITH {LABELLED} SELECT dim, t, label FROM labelled",
    "member_ip_check": _addresses(),
    "block_factor_join": f"WITH {BLOCK_JOIN} SELECT * FROM wh",
    "block_data_right_join": f"""WITH {BLOCK_JOIN},
samples AS (SELECT rb AS key, count(*) AS samples FROM blocked WHERE s = {OFFSET} GROUP BY rb)
SELECT key, samples, w_rows, h_rows FROM samples RIGHT JOIN wh USING (key)""",
    "block_cogroup": f"""WITH {KEYED},
tagged AS (SELECT rb AS key, 'z' AS side FROM blocked WHERE s = {OFFSET}
  UNION ALL SELECT key, 'w' FROM w UNION ALL SELECT key, 'h' FROM h)
SELECT key, count(*) FILTER (side = 'z') AS samples, count(*) FILTER (side = 'w') AS w_rows,
       count(*) FILTER (side = 'h') AS h_rows FROM tagged GROUP BY key""",
    "rating_factor_join": f"""WITH {RATINGS}, {FACTORS}, {JOINED.format(side='ratings')}
SELECT i, j, r, CAST(k AS INTEGER) AS k, round(w[k + 1], 6) AS w, round(h[k + 1], 6) AS h
FROM joined, range({RANK}) AS positions(k)""",
    "matrix_extent": f"WITH {RATINGS} SELECT max(i) AS max_i, max(j) AS max_j FROM ratings",
    "distinct_entities": f"WITH {RATINGS}, {IDS} SELECT role, id FROM ids",
    "block_sizes": f"WITH {BLOCKED} SELECT rb, cb, count(*) AS samples FROM blocked GROUP BY rb, cb",
    "block_error": f"""WITH {BLOCKED}, {FACTORS}, {JOINED.format(side='blocked')}
SELECT rb, cb, round(sum((r - prediction) ** 2), 6) AS squared_error, count(*) AS n FROM joined GROUP BY rb, cb""",
    "model_error": f"""WITH {RATINGS}, {FACTORS}, {JOINED.format(side='ratings')}
SELECT round(sum((r - prediction) ** 2), 6) AS squared_error, count(*) AS n,
       round(sqrt(sum((r - prediction) ** 2) / count(*)), 6) AS rmse FROM joined""",
    "last_minute_rps": f"""WITH {LOG},
headers AS (SELECT run_id, max(seq) FILTER (starts_with(line, '[Min')) AS header FROM log GROUP BY run_id)
SELECT run_id, round(coalesce(sum(CASE WHEN starts_with(line, 'ec2') AND seq > coalesce(header, -1)
       THEN CAST(string_split(line, '=')[2] AS DOUBLE) END), 0), 6) AS rps
FROM log JOIN headers USING (run_id) GROUP BY run_id""",
    "metric_period_stats": f"""WITH {STATS}
SELECT dim, t, round(average, 6) AS average, round(duration, 6) AS duration FROM stats""",
    "tumbling_alarm": f"""WITH {ALARMS}
SELECT rule, dim, t, round(average, 6) AS average, adjustment FROM alarms""",
    "first_reach": """WITH hourly AS (
  SELECT strftime(ts, '%Y-%m-%d') AS run_id, CAST(hour(ts) AS INTEGER) AS step, sum(value) AS load FROM events GROUP BY 1, 2),
steps AS (SELECT run_id, step, sum(load) OVER (PARTITION BY run_id ORDER BY step) AS load FROM hourly)
SELECT run_id, CAST(min(step) FILTER (load >= 4000) AS INTEGER) AS first_step,
       CAST(min(step) FILTER (load >= 4000) - min(step) + 1 AS INTEGER) AS steps_used
FROM steps GROUP BY run_id HAVING max(load) >= 4000""",
    "last3_avg": f"WITH {LABELLED} SELECT dim, t, round(last_avg, 6) AS last_avg FROM recent",
    "breach_counters": f"""WITH {LABELLED},
islands AS (
  SELECT *, sum(CASE WHEN label = 'neutral' THEN 1 ELSE 0 END) OVER (PARTITION BY dim ORDER BY t) AS island FROM labelled)
SELECT dim, t, label,
  CAST(sum(CASE WHEN label = 'up' THEN 1 ELSE 0 END) OVER (PARTITION BY dim, island ORDER BY t) AS BIGINT) AS up,
  CAST(sum(CASE WHEN label = 'down' THEN 1 ELSE 0 END) OVER (PARTITION BY dim, island ORDER BY t) AS BIGINT) AS down
FROM islands""",
    "health_state": _health(*HEALTH_RUNS),
    "health_state_default": _health(3, 5),
    "evict_first_failure": """WITH adds AS (
  SELECT user_id AS instance, ts AS added_at,
         row_number() OVER (PARTITION BY user_id ORDER BY ts) AS episode
  FROM events WHERE event_type = 'signup')
SELECT a.instance, a.episode, a.added_at, min(e.ts) AS evicted_at
FROM adds a LEFT JOIN events e ON e.user_id = a.instance AND e.event_type = 'error'
  AND e.ts >= a.added_at
GROUP BY a.instance, a.episode, a.added_at""",
    "active_members": f"WITH {ACTIVE} SELECT balancer, seq, ip FROM active",
    "member_names": f"""WITH {MEMBERS}
SELECT balancer, seq, ip, 'DC-' || (row_number() OVER (PARTITION BY balancer ORDER BY seq) - 1) AS name
FROM members WHERE op = 'add'""",
    "member_list": f"""WITH {ACTIVE}
SELECT balancer, coalesce(string_agg('http://' || ip, ',' ORDER BY seq), '') || chr(10) AS members
FROM (SELECT DISTINCT balancer FROM members UNION SELECT {NO_BALANCER}) LEFT JOIN active USING (balancer) GROUP BY balancer""",
    "live_members": f"WITH {LIVE} SELECT * REPLACE (coalesce(left_at, -1) AS left_at) FROM live",
    "live_member_list": f"""WITH {LIVE}
SELECT balancer, coalesce(string_agg('http://' || ip, ',' ORDER BY seq), '') || chr(10) AS members
FROM (SELECT DISTINCT user_id % 4 AS balancer FROM events) LEFT JOIN (FROM live WHERE left_at IS NULL) USING (balancer) GROUP BY balancer""",
    "round_robin_assign": f"""WITH {ACTIVE},
slots AS (
  SELECT balancer, ip, row_number() OVER (PARTITION BY balancer ORDER BY seq) - 1 AS slot,
         count(*) OVER (PARTITION BY balancer) AS n FROM active),
asked AS (
  SELECT event_id AS seq, user_id % 4 AS balancer,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS k
  FROM events WHERE event_type IN ('view', 'click', 'purchase'))
SELECT balancer, slot, seq, ip FROM asked JOIN slots USING (balancer) WHERE slot = k % n""",
    "factors_sorted": _vector_rows(f"{RATINGS}, {FACTORS}", 6),
    "factors_head": _vector_rows(
        f"{RATINGS}, {FACTORS}, heads AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY id) AS place FROM factors), "
        "head AS (SELECT * FROM heads WHERE place <= 15)", 6, "head"
    ),
    "init_factors": _vector_rows(f"{RATINGS}, {FACTORS}"),
    "init_factors_dense": _vector_rows(DENSE),
    "fill_missing_factors": _vector_rows(f"""{RATINGS}, {IDS},
known AS (SELECT DISTINCT 'W' AS role, i AS id FROM ratings WHERE r >= 5
  UNION ALL SELECT DISTINCT 'H', j FROM ratings WHERE r >= 5),
factors AS (SELECT role, id, CASE WHEN k.id IS NULL THEN {_vec('role', SEED + 2)} ELSE {_vec('role', SEED)} END AS vec
  FROM ids LEFT JOIN known k USING (role, id))"""),
    "dsgd_update": _learned(f"s = {OFFSET}", 1),
    "sgd_update_sequential": _learned(f"s = {OFFSET}", 1, "w_new"),
    "train_factors": _learned("true", 2),
    "train_row_major": _learned("true", 2, "w_new", 0.001, "rb + cb"),
    "factor_regroup": _learned(
        f"s = {OFFSET}", 1, more=f"""CAST(CASE WHEN role = 'W' THEN id // (SELECT di FROM dims)
  ELSE (id // (SELECT dj FROM dims) - {OFFSET + 1} + {BLOCKS}) % {BLOCKS} END AS INTEGER) AS key, """
    ),
    "train_line_order": _learned("true", 1, order=LINE_ORDER),
    "train_files": _learned("true", 1, factors=DENSE_FACTORS),
    "training_log": _log(2),
    "scaling_decisions": _scaling(),
    "policy_actions": _policy(),
    "stream_metric_alarm": _streamed_alarms(),
    "stream_scaling_decisions": f"SELECT * FROM ({_scaling()}) WHERE {_closed('t', PERIOD)}",
}
ORACLE["score_files"] = ORACLE["model_error"]
for _name in ("dsgd_update", "sgd_update_sequential", "train_factors"):
    ORACLE[f"{_name}_refined"] = ORACLE[_name]
for _name in (
    "last3_avg",
    "breach_counters",
    "active_members",
    "member_names",
    "scaling_decisions",
    "model_error",
    "live_members",
    "health_state",
    "round_robin_assign",
    "policy_actions",
    "last_minute_rps",
):
    ORACLE[f"{_name}_hot"] = ORACLE[_name]
