"""DuckDB SQL equal in meaning to each query of :mod:`clvspark.plans.registry`.

The SQL is written from the operator definitions, not generated from the
Spark plans. Common table expressions are shared through small builders so
that each statement stays readable. Views ``orders``, ``lineitem`` and
``events`` (and the other test tables) are registered by the caller.
"""

from __future__ import annotations

from clvspark.functions.dates import expand_partial_date, parse_period
from clvspark.plans import registry as reg

SEED = reg.SPLIT_SEED
FRACTION = reg.SPLIT_FRACTION


def money_sum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def money_mean(c: str) -> str:
    return f"({money_sum(c)} / CAST(COUNT({c}) AS DOUBLE))"


ORDERS_TX = """tx AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS date,
         CAST(1.0 AS DOUBLE) AS quantity, CAST(o_totalprice AS DOUBLE) AS price
  FROM orders
  WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
    AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice))"""

EVENTS_TX = """tx AS (
  SELECT user_id AS customer_id, CAST(ts AS DATE) AS date,
         CAST(1.0 AS DOUBLE) AS quantity, CAST(value AS DOUBLE) AS price
  FROM events
  WHERE event_type = 'purchase' AND user_id IS NOT NULL AND ts IS NOT NULL
    AND value IS NOT NULL AND NOT isnan(value))"""


def _days(assess: str) -> int:
    p = parse_period(assess)
    if p.unit == "day":
        return p.n
    if p.unit == "week":
        return 7 * p.n
    raise ValueError("oracle SQL covers day/week periods only")


def flow_ctes(tx_cte: str, cohort: tuple[str, str], assess: str) -> str:
    """tx -> cohort -> customer split -> time split per side -> reference date."""
    lo = expand_partial_date(cohort[0], "start").isoformat()
    hi = expand_partial_date(cohort[1], "end").isoformat()
    days = _days(assess)
    return f"""{tx_cte},
firsts AS (SELECT customer_id, min(date) AS first_date FROM tx GROUP BY customer_id),
coh_ids AS (SELECT customer_id FROM firsts
            WHERE first_date BETWEEN DATE '{lo}' AND DATE '{hi}'),
coh AS (SELECT * FROM tx WHERE customer_id IN (SELECT customer_id FROM coh_ids)),
ranked AS (
  SELECT customer_id,
         row_number() OVER (ORDER BY md5('{SEED}:' || CAST(customer_id AS VARCHAR)),
                                     customer_id) AS rn,
         count(*) OVER () AS n
  FROM (SELECT DISTINCT customer_id FROM coh) d),
train_ids AS (SELECT customer_id FROM ranked WHERE rn <= round_even({FRACTION} * n, 0)),
tr AS (SELECT * FROM coh WHERE customer_id IN (SELECT customer_id FROM train_ids)),
te AS (SELECT * FROM coh WHERE customer_id NOT IN (SELECT customer_id FROM train_ids)),
tr_cut AS (SELECT max(date) - {days} AS cutoff FROM tr),
te_cut AS (SELECT max(date) - {days} AS cutoff FROM te),
tr_training AS (SELECT * FROM tr WHERE date <= (SELECT cutoff FROM tr_cut)),
tr_assess AS (SELECT * FROM tr WHERE date > (SELECT cutoff FROM tr_cut)),
te_training AS (SELECT * FROM te WHERE date <= (SELECT cutoff FROM te_cut)),
te_assess AS (SELECT * FROM te WHERE date > (SELECT cutoff FROM te_cut)),
ref AS (SELECT max(date) AS ref FROM tr_training)"""


def rfm_sql(part: str) -> str:
    return f"""SELECT customer_id,
       CAST(datediff('day', (SELECT ref FROM ref), max(date)) AS DOUBLE) AS recency,
       count(*) AS frequency,
       {money_sum('price')} AS price_sum,
       {money_mean('price')} AS price_mean
FROM {part} GROUP BY customer_id"""


def targets_sql(part: str) -> str:
    return f"""SELECT customer_id, {money_sum('price')} AS spend_90_total,
       1 AS spend_90_flag
FROM {part} GROUP BY customer_id"""


def table_sql(side: str) -> str:
    """Modelling table of one side ('tr' or 'te')."""
    return f"""SELECT f.customer_id, f.recency, f.frequency, f.price_sum, f.price_mean,
       COALESCE(t.spend_90_total, CAST(0 AS DOUBLE)) AS spend_90_total,
       CAST(COALESCE(t.spend_90_flag, 0) AS DOUBLE) AS spend_90_flag
FROM ({rfm_sql(side + '_training')}) f
LEFT JOIN ({targets_sql(side + '_assess')}) t USING (customer_id)"""


ORDERS_FLOW = flow_ctes(ORDERS_TX, reg.ORDERS_COHORT, reg.ORDERS_ASSESS)
EVENTS_FLOW = flow_ctes(EVENTS_TX, reg.EVENTS_COHORT, reg.EVENTS_ASSESS)


def with_orders(body: str) -> str:
    return f"WITH {ORDERS_FLOW}\n{body}"


def standin_sql(source: str) -> str:
    """The stand-in score of registry.standin_scores over a modelling table."""
    prob = "(CAST(frequency AS DOUBLE) / (CAST(frequency AS DOUBLE) + CAST(10 AS DOUBLE)))"
    return f"""SELECT price_mean * {prob} AS pred_total, {prob} AS pred_prob,
       spend_90_total, spend_90_flag, customer_id, recency, frequency, price_sum, price_mean
FROM ({source}) m"""


TEST_PRED = standin_sql(table_sql("te"))
ALL_PRED = standin_sql(f"{table_sql('tr')}\nUNION ALL\n{table_sql('te')}")
BASE = f"""SELECT p.*, spend_90_total - (pred_total + CAST(0.0001 AS DOUBLE)) AS spend_actual_vs_pred
FROM ({ALL_PRED}) p"""
SAMPLE = f"""SELECT b.* FROM ({BASE}) b WHERE customer_id IN (
  SELECT customer_id FROM (
    SELECT customer_id,
           row_number() OVER (ORDER BY md5('{SEED}:' || CAST(customer_id AS VARCHAR)),
                                       customer_id) AS rn,
           count(*) OVER () AS n
    FROM ({BASE}) b2) r
  WHERE rn <= round_even({reg.SAMPLE_FRACTION} * n, 0))"""
LONG = f"""SELECT customer_id, pred_prob, pred_total, spend_90_total, spend_actual_vs_pred,
       feature, value
FROM (UNPIVOT (SELECT customer_id, pred_prob, pred_total, spend_90_total, spend_actual_vs_pred,
                      CAST(recency AS DOUBLE) AS recency, CAST(frequency AS DOUBLE) AS frequency,
                      CAST(price_sum AS DOUBLE) AS price_sum
               FROM ({SAMPLE}) s)
      ON recency, frequency, price_sum INTO NAME feature VALUE value) u"""
SCALED = f"""SELECT l.*, round((value - m) / nullif(sd, 0), 6) AS value_scaled
FROM ({LONG}) l JOIN (SELECT feature, avg(value) AS m, stddev_samp(value) AS sd
                      FROM ({LONG}) l2 GROUP BY feature) st USING (feature)"""


def _stump_sql() -> str:
    """One regression tree of depth 2 with Newton leaves: cuts at exact rank quantiles, best split per node."""
    bins, rate, l2 = reg.STUMP["bins"], 0.3, 1.0
    names = ("recency", "frequency", "price_sum", "price_mean")
    order = " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(names))
    columns = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in names)
    parts = [f"""t AS (SELECT customer_id, CAST(0.5 AS DOUBLE) - spend_90_total AS g, {columns} FROM ({table_sql('tr')}) m),
long AS (SELECT customer_id, g, feature, CASE feature {order} END AS fno, value
         FROM (UNPIVOT t ON {', '.join(names)} INTO NAME feature VALUE value) u),
ordered AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS rn,
                   count(*) OVER (PARTITION BY feature) AS n FROM long),
cuts AS (SELECT DISTINCT o.feature, min(value) AS cut FROM ordered o, range(1, {bins}) k(k)
         WHERE rn >= greatest(1, ceil(CAST(k AS DOUBLE) / {bins} * n)) GROUP BY o.feature, k)"""]

    def node(i: int, rows: str) -> None:
        parts.append(f"""n{i} AS (SELECT * FROM long WHERE {rows}),
s{i} AS (SELECT sum(g) AS g, CAST(count(*) AS DOUBLE) AS h FROM n{i} WHERE fno = 0),
c{i} AS (SELECT n.feature, fno, cut, sum(CASE WHEN value < cut THEN n.g ELSE 0 END) AS gl,
                CAST(sum(CASE WHEN value < cut THEN 1 ELSE 0 END) AS DOUBLE) AS hl
         FROM n{i} n JOIN cuts c ON n.feature = c.feature GROUP BY ALL),
b{i} AS (SELECT c.feature, fno, cut, gl, hl, s.g AS g, s.h AS h,
                gl * gl / (hl + {l2}) + (s.g - gl) * (s.g - gl) / (s.h - hl + {l2}) - s.g * s.g / (s.h + {l2}) AS gain
         FROM c{i} c, s{i} s WHERE hl >= 1 AND s.h - hl >= 1),
w{i} AS (SELECT * FROM b{i} WHERE gain > 1e-6 ORDER BY gain DESC, fno, cut LIMIT 1)""")

    def under(i: int, op: str) -> str:
        return (f"customer_id IN (SELECT customer_id FROM n{i} WHERE feature = (SELECT feature FROM w{i})"
                f" AND value {op} (SELECT cut FROM w{i}))")

    node(0, "true")
    node(1, under(0, "<"))
    node(2, under(0, ">="))
    out = []
    for i in (0, 1, 2):
        out.append(f"SELECT {i} AS node, feature, cut AS threshold, gain, h AS cover, CAST(NULL AS DOUBLE) AS weight FROM w{i}")
        if i:
            out.append(f"SELECT {i}, NULL, NULL, NULL, h, -{rate} * g / (h + {l2}) FROM s{i} WHERE NOT EXISTS (FROM w{i})")
            for child, g, h in ((2 * i + 1, "gl", "hl"), (2 * i + 2, "(g - gl)", "(h - hl)")):
                out.append(f"SELECT {child}, NULL, NULL, NULL, {h}, -{rate} * {g} / ({h} + {l2}) FROM w{i}")
    return with_orders(",\n" + ",\n".join(parts) + ",\nnodes AS (" + "\nUNION ALL ".join(out) + ")\n")


_STUMP_NODES = _stump_sql()
NEWTON_STUMP = (f"{_STUMP_NODES}SELECT CAST(node AS INT) AS node, feature, threshold, round(gain / {reg.GAIN_UNIT}, 3) AS gain, cover,"
                " round(weight, 5) AS weight FROM nodes")
GAIN_IMPORTANCE = (f"{_STUMP_NODES}SELECT feature, round(sum(gain) / {reg.GAIN_UNIT}, 3) AS gain, sum(cover) AS cover,"
                   " count(*) AS splits FROM nodes WHERE feature IS NOT NULL GROUP BY feature")


def _scored_sql(source: str) -> str:
    """Scores by the stand-in trees: every customer walks down each tree's node rows."""
    parts, sums = [], []
    for name, model in (("total", reg.FIXED_TREES.total), ("prob", reg.FIXED_TREES.prob)):
        rows = ", ".join(
            f"({t}, {i}, {f'{n.feature!r}' if n.feature else 'NULL'}, {n.threshold if n.feature else 'NULL'},"
            f" {'true' if n.missing_left else 'false'}, {n.weight if n.feature is None else 'NULL'})"
            for t, tree in enumerate(model.trees) for i, n in tree.items())
        parts.append(f"""{name}_nodes(tree, node, feature, threshold, missing_left, weight) AS (VALUES {rows}),
{name}_walk AS (
  SELECT m.customer_id, tree, 0 AS node FROM m, (SELECT DISTINCT tree FROM {name}_nodes)
  UNION ALL
  SELECT w.customer_id, w.tree, CASE WHEN coalesce(v.value < n.threshold, n.missing_left) THEN 2 * w.node + 1 ELSE 2 * w.node + 2 END
  FROM {name}_walk w JOIN {name}_nodes n ON w.tree = n.tree AND w.node = n.node
       JOIN v ON v.customer_id = w.customer_id AND v.feature = n.feature),
{name}_sum AS (SELECT customer_id, sum(CAST(weight AS DOUBLE)) AS s
               FROM {name}_walk w JOIN {name}_nodes n ON w.tree = n.tree AND w.node = n.node WHERE n.feature IS NULL GROUP BY 1)""")
    return f"""WITH RECURSIVE {ORDERS_FLOW},
m AS ({source}),
v AS (SELECT customer_id, feature, value FROM (UNPIVOT (
        SELECT customer_id, CAST(recency AS DOUBLE) AS recency, CAST(frequency AS DOUBLE) AS frequency, price_sum, price_mean FROM m)
      ON recency, frequency, price_sum, price_mean INTO NAME feature VALUE value) u),
{", ".join(parts)}
SELECT round({reg.FIXED_TREES.total.base} + t.s, 6) AS pred_total,
       round(1 / (1 + exp(-({reg.FIXED_TREES.prob.base} + p.s))), 9) AS pred_prob,
       spend_90_total, spend_90_flag, m.customer_id, recency, frequency, price_sum, price_mean
FROM m JOIN total_sum t USING (customer_id) JOIN prob_sum p USING (customer_id)"""


PREDICTIONS_FIXED = _scored_sql(table_sql("te"))
MODEL_ROUND_TRIP = _scored_sql(f"{table_sql('tr')}\nUNION ALL\n{table_sql('te')}")

_F10 = " UNION ALL ".join(
    f"SELECT '{label}' AS label, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM m"
    for label in ("spend_90_total", "spend_90_flag") for f in ("recency", "frequency", "price_sum", "price_mean"))
FEATURE_LIST = with_orders(f""", m AS ({table_sql('tr')})
SELECT label, feature, count(value) AS rows, min(value) AS least, max(value) AS most FROM ({_F10}) x GROUP BY 1, 2""")


def rank_quantile(value: str, q: float, name: str) -> str:
    """Smallest value whose rank reaches ceil(q * n): the exact form of Spark's
    ``percentile_approx`` on groups smaller than its accuracy."""
    return (f"min(CASE WHEN rn >= greatest(1, ceil({q} * cnt)) THEN {value} END) AS {name}")


def clv_ctes(flow: str, split: str) -> str:
    """Same-day merged transactions of customers with estimation purchases."""
    return f"""{flow},
daily AS (SELECT customer_id, date, {money_sum('price')} AS price FROM coh GROUP BY 1, 2),
known AS (SELECT DISTINCT customer_id FROM daily WHERE date <= DATE '{split}'),
d AS (SELECT * FROM daily WHERE customer_id IN (SELECT customer_id FROM known)),
est AS (SELECT * FROM d WHERE date <= DATE '{split}')"""


def clv_statistics_sql(flow: str, split: str) -> str:
    return f"""WITH {clv_ctes(flow, split)}
SELECT customer_id, count(*) - 1 AS x,
       CAST(datediff('day', min(date), max(date)) AS DOUBLE) / CAST(1 AS DOUBLE) AS t_x,
       CAST(datediff('day', min(date), DATE '{split}') AS DOUBLE) / CAST(1 AS DOUBLE) AS T_cal,
       {money_sum('price')} / CAST(count(*) AS DOUBLE) AS spending
FROM est GROUP BY customer_id"""


_CLV = clv_ctes(ORDERS_FLOW, reg.ORDERS_CLV_SPLIT)
_SPLIT = reg.ORDERS_CLV_SPLIT
_IPT = ("CASE WHEN n > 1 THEN CAST(datediff('day', first, last) AS DOUBLE) / CAST(1 AS DOUBLE)"
        " / CAST(n - 1 AS DOUBLE) END")
CLV_SUMMARY = f"""WITH {_CLV},
r AS (SELECT CASE WHEN date <= DATE '{_SPLIT}' THEN 'Estimation' ELSE 'Holdout' END AS period,
             customer_id, date, price FROM d
      UNION ALL SELECT 'Total', customer_id, date, price FROM d),
pc AS (SELECT period, customer_id, count(*) AS n, min(date) AS first, max(date) AS last
       FROM r GROUP BY 1, 2),
bc AS (SELECT period, count(*) AS customers, min(first) AS first_transaction,
              max(last) AS last_transaction, CAST(sum(n) AS BIGINT) AS transactions,
              round(stddev_samp(n), 6) AS sd_transactions,
              CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS zero_repeaters,
              round(avg({_IPT}), 6) AS mean_interpurchase,
              round(stddev_samp({_IPT}), 6) AS sd_interpurchase
       FROM pc GROUP BY 1),
bt AS (SELECT period, {money_sum('price')} AS total_spending,
              round(stddev_samp(price), 6) AS sd_spending FROM r GROUP BY 1)
SELECT period, customers, first_transaction, last_transaction, transactions,
       CAST(transactions AS DOUBLE) / CAST(customers AS DOUBLE) AS mean_transactions,
       sd_transactions,
       total_spending / CAST(transactions AS DOUBLE) AS mean_spending,
       sd_spending, total_spending, zero_repeaters,
       CAST(100 AS DOUBLE) * CAST(zero_repeaters AS DOUBLE) / CAST(customers AS DOUBLE)
         AS pct_zero_repeaters,
       mean_interpurchase, sd_interpurchase
FROM bc JOIN bt USING (period)"""

TRACKING_ACTUAL = f"""WITH {_CLV},
cust_firsts AS (SELECT customer_id, min(date) AS first_date FROM d GROUP BY 1),
pf AS (SELECT first_date, count(*) AS n_first FROM cust_firsts GROUP BY 1),
pdays AS (SELECT date, count(*) AS n_all FROM d GROUP BY 1),
bounds AS (SELECT (SELECT min(first_date) FROM pf) AS lo, (SELECT max(date) FROM d) AS hi),
cal0 AS (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                       INTERVAL 1 DAY)) AS ts FROM bounds),
cal AS (SELECT CAST(ts AS DATE) AS period_until FROM cal0)
SELECT period_until, 'Actual' AS variable,
       CAST(coalesce(n_all, 0) - coalesce(n_first, 0) AS DOUBLE) AS value
FROM cal LEFT JOIN pdays ON cal.period_until = pdays.date
         LEFT JOIN pf ON cal.period_until = pf.first_date
WHERE period_until > (SELECT lo FROM bounds)"""


def _det3(a, b, c, d, e, f, g, h, i) -> str:
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


SMOOTH_TREND = with_orders(f""",
m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS date, {money_sum('price')} AS total_price
      FROM coh GROUP BY 1),
s AS (SELECT date, total_price, CAST(datediff('day', DATE '1970-01-01', date) AS DOUBLE) AS x,
             count(*) OVER () AS n FROM m),
p AS (SELECT a.date, a.total_price, a.x AS x0, a.n, b.x, b.total_price AS y,
             abs(b.x - a.x) AS dist,
             row_number() OVER (PARTITION BY a.date ORDER BY abs(b.x - a.x)) AS rk
      FROM s a CROSS JOIN s b),
hh AS (SELECT date, max(CASE WHEN rk = least(n, greatest(CAST(floor(0.75 * n) AS BIGINT), 3))
                             THEN dist END) AS h
       FROM p GROUP BY date),
w AS (SELECT p.date, p.total_price, (p.x - p.x0) / hh.h AS u, p.y,
             CASE WHEN abs((p.x - p.x0) / hh.h) < 1
                  THEN pow(1 - pow(abs((p.x - p.x0) / hh.h), 3), 3) ELSE 0 END AS w
      FROM p JOIN hh USING (date)),
mo AS (SELECT date, total_price, sum(w) AS s0, sum(w * u) AS s1, sum(w * pow(u, 2)) AS s2,
              sum(w * pow(u, 3)) AS s3, sum(w * pow(u, 4)) AS s4, sum(w * y) AS t0,
              sum(w * u * y) AS t1, sum(w * pow(u, 2) * y) AS t2
       FROM w GROUP BY 1, 2)
SELECT date, total_price,
       round({_det3('t0', 's1', 's2', 't1', 's2', 's3', 't2', 's3', 's4')}
             / {_det3('s0', 's1', 's2', 's1', 's2', 's3', 's2', 's3', 's4')}, 2) AS value_smooth
FROM mo""")


# local quadratic fits at the vertices of a k-d partition, cubics in between
SMOOTH_VERTICES = with_orders(f""",
m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS date, {money_sum('price')} AS total_price
      FROM coh GROUP BY 1),
s AS (SELECT date, total_price AS y, CAST(datediff('day', DATE '1970-01-01', date) AS DOUBLE) AS x,
             row_number() OVER (ORDER BY date) AS rn, count(*) OVER () AS n FROM m),
most AS (SELECT max(n) AS n, greatest(1, CAST(floor(0.75 * 0.2 * max(n)) AS BIGINT)) AS size FROM s),
cells AS (
  SELECT CAST(1 AS BIGINT) AS lo, n AS hi, 0 AS level FROM most
  UNION ALL
  SELECT * FROM (
    SELECT CASE side WHEN 0 THEN lo ELSE (lo + hi) // 2 + 1 END, CASE side WHEN 0 THEN (lo + hi) // 2 ELSE hi END, level + 1
    FROM cells, most, range(2) r(side) WHERE hi - lo + 1 > size AND hi > lo AND level < 40)),
vx AS (SELECT DISTINCT pos FROM (
  SELECT (a.x + b.x) / 2 AS pos FROM cells, most, s a, s b
  WHERE hi - lo + 1 > size AND hi > lo AND a.rn = (lo + hi) // 2 AND b.rn = (lo + hi) // 2 + 1
  UNION ALL SELECT min(x) - 0.005 * (max(x) - min(x)) FROM s
  UNION ALL SELECT max(x) + 0.005 * (max(x) - min(x)) FROM s) u),
far AS (SELECT pos, x - pos AS d, y, n, row_number() OVER (PARTITION BY pos ORDER BY abs(x - pos)) AS rk FROM vx, s),
h AS (SELECT pos, max(CASE WHEN rk = least(n, greatest(CAST(floor(0.75 * n) AS BIGINT), 3)) THEN abs(d) END) AS h FROM far GROUP BY pos),
w AS (SELECT pos, h, y, d / h AS u, CASE WHEN abs(d / h) < 1 THEN pow(1 - pow(abs(d / h), 3), 3) ELSE 0 END AS w FROM far JOIN h USING (pos)),
mo AS (SELECT pos, h, sum(w) AS s0, sum(w * u) AS s1, sum(w * pow(u, 2)) AS s2, sum(w * pow(u, 3)) AS s3, sum(w * pow(u, 4)) AS s4,
              sum(w * y) AS t0, sum(w * u * y) AS t1, sum(w * pow(u, 2) * y) AS t2 FROM w GROUP BY 1, 2),
fit AS (SELECT pos, {_det3('t0', 's1', 's2', 't1', 's2', 's3', 't2', 's3', 's4')} / {_det3('s0', 's1', 's2', 's1', 's2', 's3', 's2', 's3', 's4')} AS a,
               {_det3('s0', 't0', 's2', 's1', 't1', 's3', 's2', 't2', 's4')} / {_det3('s0', 's1', 's2', 's1', 's2', 's3', 's2', 's3', 's4')} / h AS da
        FROM mo),
piece AS (SELECT pos AS lo, lead(pos) OVER (ORDER BY pos) AS hi, a, da, lead(a) OVER (ORDER BY pos) AS b, lead(da) OVER (ORDER BY pos) AS db FROM fit),
p AS (SELECT date, y, (x - lo) / (hi - lo) AS t, hi - lo AS k, a, da, b, db FROM s JOIN piece ON x >= lo AND x < hi)
SELECT date, y AS total_price,
       round((1 + 2 * t) * (1 - t) * (1 - t) * a + t * (1 - t) * (1 - t) * da * k + t * t * (3 - 2 * t) * b + t * t * (t - 1) * db * k, 1) AS value_smooth
FROM p""").replace("WITH ", "WITH RECURSIVE ", 1)


def _spline_sql() -> str:
    """The spline at the fixed penalty: basis, normal equations, elimination step by step, back substitution."""
    segments, size = reg.SMOOTH_SEGMENTS, reg.SMOOTH_SEGMENTS + 3
    rough = [[sum(c[i] * c[j] for c in ([1 if k == r else -2 if k == r + 1 else 1 if k == r + 2 else 0 for k in range(size)]
                                        for r in range(size - 2))) for j in range(size)] for i in range(size)]

    def kernel(j: int) -> str:
        u = f"abs(t - {j - 1})"
        return (f"CASE WHEN {u} < 1 THEN CAST(2 AS DOUBLE) / 3 - {u} * {u} + {u} * {u} * {u} / 2"
                f" WHEN {u} < 2 THEN (2 - {u}) * (2 - {u}) * (2 - {u}) / 6 ELSE 0 END AS b{j}")

    cells = [(i, j) for i in range(size) for j in range(size)]
    steps = [f"""m AS ({ALL_PRED}),
ends AS (SELECT CAST(min(frequency) AS DOUBLE) AS low, CAST(max(frequency) AS DOUBLE) AS high FROM m),
tt AS (SELECT frequency, pred_prob AS y, (frequency - low) / ((high - low) / {segments}) AS t FROM m, ends),
b AS (SELECT frequency, y, {', '.join(kernel(j) for j in range(size))} FROM tt),
e0 AS (SELECT {', '.join(f"sum(b{i} * b{j}) + {reg.SMOOTH_PENALTY} * {rough[i][j]}{' + 1e-8' if i == j else ''} AS a{i}_{j}" for i, j in cells)},
              {', '.join(f'sum(b{i} * y) AS r{i}' for i in range(size))} FROM b)"""]
    for k in range(size - 1):
        kept = ", ".join(f"a{i}_{j}" if i <= k else f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" for i, j in cells if j > min(i - 1, k))
        right = ", ".join(f"r{i}" if i <= k else f"r{i} - a{i}_{k} * r{k} / a{k}_{k} AS r{i}" for i in range(size))
        steps.append(f"e{k + 1} AS (SELECT {kept}, {right} FROM e{k})")
    last = f"e{size - 1}"
    for k in reversed(range(size)):
        solved = " - ".join([f"r{k}", *(f"a{k}_{j} * w{j}" for j in range(k + 1, size))])
        steps.append(f"w_{k} AS (SELECT *, ({solved}) / a{k}_{k} AS w{k} FROM {last})")
        last = f"w_{k}"
    curve = " + ".join(f"b{j} * w{j}" for j in range(size))
    return with_orders(", " + ",\n".join(steps) + f"""
SELECT frequency, count(*) AS customers, round(min({curve}), 6) AS prob_smooth FROM b, {last} GROUP BY frequency""")


PROBABILITY_SMOOTH = _spline_sql()




def _currency(c: str) -> str:
    return (f"CASE WHEN {c} < 0 THEN '-$' || format('{{:,.2f}}', abs({c})) "
            f"ELSE '$' || format('{{:,.2f}}', {c}) END")


DASHBOARD_TEXT = with_orders(f"""
SELECT b.*, concat_ws(chr(10),
  'Customer ID: ' || CAST(customer_id AS VARCHAR),
  '90-Day Spend Prob: ' || format('{{:,.1f}}', pred_prob * CAST(100 AS DOUBLE)) || '%',
  '90-Day Spend Pred: ' || {_currency('pred_total')},
  'Actual 90-Day Spend: ' || {_currency('spend_90_total')},
  'Actual vs Pred: ' || {_currency('spend_actual_vs_pred')},
  '---',
  'Recency: ' || CASE WHEN recency = floor(recency) THEN CAST(CAST(recency AS BIGINT) AS VARCHAR)
                      ELSE CAST(recency AS VARCHAR) END,
  'Spend History (Total): ' || {_currency('price_sum')},
  'Avg Purchase: ' || {_currency('price_mean')}) AS text
FROM ({BASE}) b""")


def _f(v: float) -> str:
    """A DOUBLE literal carrying exactly the Python float."""
    return f"CAST({float(v)!r} AS DOUBLE)"


def _nodes_cte() -> str:
    import numpy as np
    z, w = np.polynomial.legendre.leggauss(64)
    rows = ", ".join(f"({_f(a)}, {_f(b)})" for a, b in zip(z, w))
    return f"nodes(z, w) AS (VALUES {rows})"


_R, _A, _S, _B = reg.FIXED_PNBD
_GP, _GQ, _GG = reg.FIXED_GG
_M = min(_A, _B)
_DELTA = 0.1 * 1.0 / 365.0

_CLV_STATS = f"""{_CLV},
stats AS (SELECT customer_id, count(*) - 1 AS x,
                 CAST(datediff('day', min(date), max(date)) AS DOUBLE) / CAST(1 AS DOUBLE) AS t_x,
                 CAST(datediff('day', min(date), DATE '{_SPLIT}') AS DOUBLE) / CAST(1 AS DOUBLE)
                   AS T_cal,
                 {money_sum('price')} / CAST(count(*) AS DOUBLE) AS spending
          FROM est GROUP BY customer_id),
{_nodes_cte()},
q0 AS (SELECT customer_id, x, t_x, T_cal, spending,
              ln(t_x + {_f(_M)}) AS lo, ln(T_cal + {_f(_M)}) AS hi FROM stats),
q1 AS (SELECT customer_id, x, T_cal, spending, (hi - lo) / 2 AS half, w,
              (hi - lo) / 2 * z + (hi + lo) / 2 AS v FROM q0 CROSS JOIN nodes),
q2 AS (SELECT customer_id, x, T_cal, spending, half,
              sum(w * exp(v - ({_f(_R)} + x) * ln(exp(v) + {_f(_A - _M)})
                          - ({_f(_S)} + 1) * ln(exp(v) + {_f(_B - _M)}))) AS sw
       FROM q1 GROUP BY 1, 2, 3, 4, 5)"""

_GG_MEAN = (f"{_f(_GP)} * ({_f(_GG)} + CAST(x + 1 AS DOUBLE) * spending)"
            f" / ({_f(_GP)} * CAST(x + 1 AS DOUBLE) + {_f(_GQ - 1.0)})")

PNBD_SCORES_FIXED = f"""WITH {_CLV_STATS},
hl AS (SELECT max(date) AS last_date,
              CAST(datediff('day', DATE '{_SPLIT}', max(date)) AS DOUBLE) / CAST(1 AS DOUBLE) AS h
       FROM d),
ho AS (SELECT customer_id, count(*) AS holdout_x, {money_sum('price')} AS holdout_spending
       FROM d WHERE date > DATE '{_SPLIT}' GROUP BY 1),
pa AS (SELECT customer_id, x, T_cal, spending,
              CASE WHEN half > 0 THEN 1 / (1 + exp(ln({_f(_S)}) + ln(half * sw)
                   + ({_f(_R)} + x) * ln({_f(_A)} + T_cal) + {_f(_S)} * ln({_f(_B)} + T_cal)))
                   ELSE CAST(1 AS DOUBLE) END AS p_alive
       FROM q2),
du AS (SELECT pa.customer_id, w,
              ln(1 + 40 / ({_f(_DELTA)} * ({_f(_B)} + T_cal))) AS upper_u, T_cal,
              ln(1 + 40 / ({_f(_DELTA)} * ({_f(_B)} + T_cal))) / 2 * (z + 1) AS u
       FROM pa CROSS JOIN nodes),
di AS (SELECT customer_id, max(upper_u) / 2 * sum(w * exp(-{_f(_DELTA)} * ({_f(_B)} + T_cal) * (exp(u) - 1)
                                       - {_f(_S)} * u + ln({_f(_B)} + T_cal) + u)) AS integral
       FROM du GROUP BY 1),
sc AS (SELECT pa.customer_id, pa.x, pa.spending, p_alive,
              p_alive * ({_f(_R)} + x) / ({_f(_A)} + T_cal) * ({_f(_B)} + T_cal) / {_f(_S - 1.0)}
                * (1 - pow(({_f(_B)} + T_cal) / ({_f(_B)} + T_cal + (SELECT h FROM hl)), {_f(_S - 1.0)}))
                AS cet,
              p_alive * ({_f(_R)} + x) / ({_f(_A)} + T_cal) * integral AS dert
       FROM pa JOIN di USING (customer_id))
SELECT sc.customer_id, DATE '{_SPLIT}' AS period_first, (SELECT last_date FROM hl) AS period_last,
       (SELECT h FROM hl) AS period_length,
       coalesce(ho.holdout_x, 0) AS actual_x,
       coalesce(ho.holdout_spending, CAST(0 AS DOUBLE)) AS actual_total_spending,
       round(p_alive, 9) AS p_alive, round(cet, 9) AS cet, round(dert, 7) AS dert,
       round({_GG_MEAN}, 6) AS predicted_mean_spending,
       round(dert * {_GG_MEAN}, 3) AS predicted_clv
FROM sc LEFT JOIN ho USING (customer_id)"""

PNBD_LOGLIK_FIXED = f"""WITH {_CLV_STATS}
SELECT round(sum(lgamma({_f(_R)} + x) - lgamma({_f(_R)}) + {_f(_R)} * ln({_f(_A)})
                 + {_f(_S)} * ln({_f(_B)})
                 + ln(exp(-({_f(_R)} + x) * ln({_f(_A)} + T_cal) - {_f(_S)} * ln({_f(_B)} + T_cal))
                      + {_f(_S)} * half * sw)), 4) AS loglik,
       count(*) AS customers
FROM q2"""

_GG_IN = f"""WITH {_CLV},
stats AS (SELECT customer_id, CAST(count(*) AS DOUBLE) AS n,
                 {money_sum('price')} / CAST(count(*) AS DOUBLE) AS z
          FROM est GROUP BY customer_id),
g AS (SELECT * FROM stats WHERE z > 0)"""

GG_LOGLIK_FIXED = f"""{_GG_IN}
SELECT round(sum(lgamma({_f(_GP)} * n + {_f(_GQ)}) - lgamma({_f(_GP)} * n) - lgamma({_f(_GQ)})
                 + {_f(_GQ)} * ln({_f(_GG)}) + ({_f(_GP)} * n - 1) * ln(z)
                 + {_f(_GP)} * n * ln(n) - ({_f(_GP)} * n + {_f(_GQ)}) * ln({_f(_GG)} + n * z)), 4)
         AS loglik,
       count(*) AS customers
FROM g"""


def _pnbd_derivatives() -> str:
    """Per customer the parts of the score: weights of being alive and of each quadrature node, u = d ln(part)."""
    r, a, s_, b, m = (_f(v) for v in (_R, _A, _S, _B, _M))
    u = ["-ln(A)", f"-({r} + x) / A", f"died / {s_} - ln(B)", f"-({s_} + died) / B"]
    du = {(0, 1): "-1 / A", (1, 1): f"({r} + x) / (A * A)", (2, 2): f"-died / ({s_} * {s_})", (2, 3): "-1 / B",
          (3, 3): f"({s_} + died) / (B * B)"}
    head = [f"list_sum(list_transform(range(x), lambda k: 1 / ({r} + k))) + ln({a})", f"{r} / {a}", f"ln({b})", f"{s_} / {b}"]
    head2 = {(0, 0): f"-list_sum(list_transform(range(x), lambda k: 1 / (({r} + k) * ({r} + k))))", (0, 1): f"1 / {a}",
             (1, 1): f"-{r} / ({a} * {a})", (2, 3): f"1 / {b}", (3, 3): f"-{s_} / ({b} * {b})"}
    pairs = [(i, j) for i in range(4) for j in range(i, 4)]
    means = ", ".join(f"sum(p * ({u[i]})) / sum(p) AS m{i}" for i in range(4))
    seconds = ", ".join(f"sum(p * (({u[i]}) * ({u[j]}) + {du.get((i, j), '0')})) / sum(p) AS c{i}{j}" for i, j in pairs)
    gradient = ", ".join(f"coalesce({head[i]}, ln({a})) + m{i} AS g{i}" if i == 0 else f"{head[i]} + m{i} AS g{i}" for i in range(4))
    hessian = ", ".join(f"c{i}{j} - m{i} * m{j} + coalesce({head2.get((i, j), '0')}, 0) AS h{i}{j}" for i, j in pairs)
    return f"""WITH {_CLV_STATS},
part AS (
  SELECT customer_id, x, exp(v) + {_f(_A - _M)} AS A, exp(v) + {_f(_B - _M)} AS B, CAST(1 AS DOUBLE) AS died,
         {s_} * half * w * exp(v - ({r} + x) * ln(exp(v) + {_f(_A - _M)}) - ({s_} + 1) * ln(exp(v) + {_f(_B - _M)})) AS p FROM q1
  UNION ALL
  SELECT customer_id, x, {a} + T_cal, {b} + T_cal, 0, exp(-({r} + x) * ln({a} + T_cal) - {s_} * ln({b} + T_cal)) FROM stats),
e AS (SELECT customer_id, x, {means}, {seconds} FROM part GROUP BY 1, 2),
g AS (SELECT {gradient}, {hessian} FROM e)
"""


_PNBD_D = _pnbd_derivatives()
PNBD_GRADIENT_FIXED = f"""{_PNBD_D}
SELECT (SELECT loglik FROM ({PNBD_LOGLIK_FIXED}) l) AS loglik, round(sum(g0), 4) AS d_r, round(sum(g1), 4) AS d_alpha,
       round(sum(g2), 4) AS d_s, round(sum(g3), 4) AS d_beta FROM g"""
PNBD_INFORMATION_FIXED = f"{_PNBD_D}\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS row_name, '{b}' AS column_name, round(-sum(h{i}{j}), 4) AS value FROM g"
    for i, a in enumerate(("r", "alpha", "s", "beta")) for j, b in enumerate(("r", "alpha", "s", "beta")) if j >= i)


def _digamma(x: str) -> str:
    """psi(x): shifted up by ten, then the asymptotic series."""
    y, z = f"({x} + 10)", f"(1 / (({x} + 10) * ({x} + 10)))"
    low = " + ".join(f"1 / ({x} + {k})" for k in range(10))
    return (f"(ln({y}) - 1 / (2 * {y}) - {z} * (CAST(1 AS DOUBLE) / 12 - {z} * (CAST(1 AS DOUBLE) / 120 - {z} *"
            f" (CAST(1 AS DOUBLE) / 252 - {z} / 240))) - ({low}))")


_N_ALL = f"({_f(_GG)} + n * z)"
_PNQ = f"({_f(_GP)} * n + {_f(_GQ)})"
GG_GRADIENT_FIXED = f"""{_GG_IN}
SELECT (SELECT loglik FROM ({GG_LOGLIK_FIXED}) l) AS loglik,
       round(sum(n * ({_digamma(_PNQ)} - {_digamma(f'({_f(_GP)} * n)')} + ln(z) + ln(n) - ln({_N_ALL}))), 4) AS d_p,
       round(sum({_digamma(_PNQ)} - {_digamma(_f(_GQ))} + ln({_f(_GG)}) - ln({_N_ALL})), 4) AS d_q,
       round(sum({_f(_GQ)} / {_f(_GG)} - {_PNQ} / {_N_ALL}), 4) AS d_gamma
FROM g"""

SPENDING_DENSITY_FIXED = f"""{_GG_IN},
w AS (SELECT count(*) AS total, max(z) / CAST(50 AS DOUBLE) AS width FROM g),
b AS (SELECT least(CAST(floor(z / width) AS INT), 49) AS bin, count(*) AS customers FROM g, w GROUP BY 1),
per_n AS (SELECT n, count(*) AS c FROM g GROUP BY 1),
grid AS (SELECT CAST(bin AS INT) AS bin, n, c, (bin + CAST(0.5 AS DOUBLE)) * width AS z, width, total FROM per_n, w, range(50) r(bin)),
m AS (SELECT bin, width, total, sum(c * exp(lgamma({_PNQ}) - lgamma({_f(_GP)} * n) - lgamma({_f(_GQ)}) + {_f(_GQ)} * ln({_f(_GG)})
        + ({_f(_GP)} * n - 1) * ln(z) + {_f(_GP)} * n * ln(n) - {_PNQ} * ln({_N_ALL}))) AS d FROM grid GROUP BY ALL)
SELECT m.bin, coalesce(customers, 0) AS customers, round(m.bin * width, 4) AS bin_start, round((m.bin + 1) * width, 4) AS bin_end,
       round(coalesce(customers, 0) / (total * width) * 1e6, 9) AS actual_density, round(d / total * 1e6, 9) AS model_density
FROM m LEFT JOIN b USING (bin)"""


SPENDING_FIXED = f"""WITH {_CLV},
stats AS (SELECT customer_id, count(*) - 1 AS x,
                 {money_sum('price')} / CAST(count(*) AS DOUBLE) AS spending
          FROM est GROUP BY customer_id)
SELECT customer_id, spending AS actual_mean_spending,
       round({_GG_MEAN}, 6) AS predicted_mean_spending
FROM stats WHERE spending > 0"""

SPENDING_FIXED_REPEAT = f"""WITH {_CLV},
f AS (SELECT customer_id, min(date) AS d0 FROM est GROUP BY customer_id),
r AS (SELECT e.customer_id, CAST(count(*) - 1 AS DOUBLE) AS n,
             CAST(sum(CASE WHEN e.date > f.d0 THEN CAST(e.price AS DECIMAL(18,2)) END) AS DOUBLE) AS total
      FROM est e JOIN f USING (customer_id) GROUP BY e.customer_id)
SELECT customer_id, round(CASE WHEN n > 0 THEN total / n END, 6) AS actual_mean_spending,
       round({_f(_GP)} * ({_f(_GG)} + CASE WHEN n > 0 THEN total ELSE 0 END)
             / ({_f(_GP)} * n + {_f(_GQ - 1.0)}), 6) AS predicted_mean_spending
FROM r"""

_EX_K = _R * _B / (_A * (_S - 1.0))


def _ex(t: str) -> str:
    return f"({_f(_EX_K)} * (1 - pow({_f(_B)} / ({_f(_B)} + {t}), {_f(_S - 1.0)})))"


TRACKING_EXPECTED_FIXED = f"""WITH {_CLV},
cust_firsts AS (SELECT customer_id, min(date) AS first_date FROM d GROUP BY 1),
pf AS (SELECT first_date, count(*) AS n_first FROM cust_firsts GROUP BY 1),
bounds AS (SELECT (SELECT min(first_date) FROM pf) AS lo, (SELECT max(date) FROM d) AS hi),
cal0 AS (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                       INTERVAL 1 DAY)) AS ts FROM bounds),
cal AS (SELECT CAST(ts AS DATE) AS period_until FROM cal0),
pairs AS (SELECT period_until, n_first,
                 CAST(datediff('day', first_date, period_until) AS DOUBLE) AS age
          FROM pf JOIN cal ON cal.period_until > pf.first_date)
SELECT period_until, 'pnbd' AS variable,
       round(sum(n_first * ({_ex('age / CAST(1 AS DOUBLE)')} - {_ex('(age - 1) / CAST(1 AS DOUBLE)')})),
             9) AS value
FROM pairs GROUP BY period_until"""


_LO = expand_partial_date(reg.ORDERS_COHORT[0], "start").isoformat()
_HI = expand_partial_date(reg.ORDERS_COHORT[1], "end").isoformat()

_POINTS = reg.DENSITY_POINTS
FEATURE_DENSITY = with_orders(f""", l AS ({SCALED}),
v AS (SELECT feature, value_scaled AS v, row_number() OVER (PARTITION BY feature ORDER BY value_scaled) AS rn,
             count(*) OVER (PARTITION BY feature) AS cnt FROM l WHERE value_scaled IS NOT NULL),
sh0 AS (SELECT feature, count(*) AS n, min(v) AS low, max(v) AS high, coalesce(stddev_samp(v), 0) AS sd,
               {rank_quantile('v', 0.25, 'q1')}, {rank_quantile('v', 0.75, 'q3')} FROM v GROUP BY feature),
sh AS (SELECT feature, n, low, (high - low) / {_POINTS - 1} AS step,
              0.9 * CASE WHEN q3 > q1 THEN least(sd, (q3 - q1) / 1.34) WHEN sd > 0 THEN sd ELSE 1 END
              * pow(CAST(n AS DOUBLE), -0.2) AS width FROM sh0),
tt AS (SELECT feature, CASE WHEN step > 0 THEN (v - low) / step ELSE 0 END AS t FROM v JOIN sh USING (feature)),
c AS (SELECT feature, t, least(CAST(floor(t) AS INT), {_POINTS - 2}) AS cell FROM tt),
mass AS (SELECT feature, cell + k AS i, sum(CASE k WHEN 0 THEN 1 - (t - cell) ELSE t - cell END) AS mass
         FROM c, range(2) r(k) GROUP BY 1, 2),
grid AS (SELECT sh.*, j FROM sh, range({_POINTS}) g(j) WHERE step > 0 OR j = 0)
SELECT feature, round(low + j * step, 6) AS at,
       round(sum(mass * exp(-((i - j) * step / width) * ((i - j) * step / width) / 2)) / (n * width * sqrt(2 * pi())), 6) AS density
FROM grid JOIN mass USING (feature) GROUP BY feature, j, low, step, n, width""")

FEATURES_TEXT = with_orders(f"""
SELECT b.*, concat_ws(chr(10),
  'Customer ID: ' || CAST(customer_id AS VARCHAR),
  '90-Day Spend Prob: ' || format('{{:,.1f}}', pred_prob * CAST(100 AS DOUBLE)) || '%',
  '90-Day Spend Pred: ' || {_currency('pred_total')},
  'Actual 90-Day Spend: ' || {_currency('spend_90_total')},
  'Actual vs Pred: ' || {_currency('spend_actual_vs_pred')},
  '---',
  feature || ': ' || CASE WHEN round_even(value, 2) = floor(round_even(value, 2)) THEN CAST(CAST(round_even(value, 2) AS BIGINT) AS VARCHAR)
                          ELSE CAST(round_even(value, 2) AS VARCHAR) END) AS text
FROM ({SCALED}) b""")

ORACLE: dict[str, str] = {
    "probability_smooth": PROBABILITY_SMOOTH,
    "feature_density": FEATURE_DENSITY,
    "smooth_trend_vertices": SMOOTH_VERTICES,
    "features_text": FEATURES_TEXT,
    "newton_stump_fixed": NEWTON_STUMP,
    "gain_importance": GAIN_IMPORTANCE,
    "predictions_fixed": PREDICTIONS_FIXED,
    "model_round_trip": MODEL_ROUND_TRIP,
    "feature_list": FEATURE_LIST,
    "transactions": """
SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS date,
       CAST(COALESCE(l.q, 0) AS DOUBLE) AS quantity, CAST(o.o_totalprice AS DOUBLE) AS price
FROM orders o
LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey
WHERE o.o_custkey IS NOT NULL AND o.o_orderdate IS NOT NULL
  AND o.o_totalprice IS NOT NULL AND NOT isnan(o.o_totalprice)""",

    "text_scan": """
SELECT printf('%05d', o_custkey) AS customer_id, CAST(o_orderdate AS DATE) AS date,
       CAST(1 AS DOUBLE) AS quantity, CAST(o_totalprice AS DOUBLE) AS price
FROM orders
WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
  AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)""",

    "parse_dates": """
WITH r AS (
  SELECT o_orderkey,
         CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)
              + CASE WHEN day(o_orderdate) > 25 THEN 5 ELSE 0 END AS BIGINT) AS raw_date
  FROM orders)
SELECT o_orderkey, raw_date,
       CAST(try_strptime(CAST(raw_date AS VARCHAR), '%Y%m%d') AS DATE) AS date
FROM r""",

    "drop_incomplete": """
SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS date,
       CAST(l.q AS DOUBLE) AS quantity, CAST(o.o_totalprice AS DOUBLE) AS price
FROM orders o
LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey
WHERE o.o_custkey IS NOT NULL AND o.o_orderdate IS NOT NULL
  AND o.o_totalprice IS NOT NULL AND NOT isnan(o.o_totalprice)
  AND l.q IS NOT NULL AND NOT isnan(l.q)""",

    "first_purchases": f"""
WITH {ORDERS_TX},
firsts AS (SELECT customer_id, min(date) AS first_date FROM tx GROUP BY customer_id)
SELECT tx.* FROM tx JOIN firsts f
  ON tx.customer_id = f.customer_id AND tx.date = f.first_date""",

    "date_range": f"""
WITH {ORDERS_TX},
firsts AS (SELECT customer_id, min(date) AS first_date FROM tx GROUP BY customer_id)
SELECT min(first_date) AS min_date, max(first_date) AS max_date FROM firsts""",

    "filter_by_time": f"""
WITH {ORDERS_TX}
SELECT * FROM tx WHERE date BETWEEN DATE '{_LO}' AND DATE '{_HI}'""",

    "cohort_ids": with_orders("SELECT customer_id FROM coh_ids"),
    "cohort_transactions": with_orders("SELECT * FROM coh"),
    "monthly_totals": with_orders(f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS date, {money_sum('price')} AS total_price
FROM coh GROUP BY 1"""),
    "smooth_trend": SMOOTH_TREND,
    "customer_histories": with_orders("""
SELECT * FROM coh WHERE customer_id IN
  (SELECT DISTINCT customer_id FROM coh ORDER BY customer_id LIMIT 10)"""),
    "split_train_ids": with_orders("SELECT customer_id FROM train_ids"),
    "split_test_transactions": with_orders("SELECT * FROM te"),
    "time_split_train": with_orders("SELECT * FROM tr_training"),
    "time_split_assess": with_orders("SELECT * FROM te_assess"),
    "cv_plan": with_orders("""
SELECT 'Slice1' AS slice_id,
       CASE WHEN date <= (SELECT cutoff FROM tr_cut) THEN 'training' ELSE 'testing' END
         AS split_key,
       * FROM tr"""),
    "targets": with_orders(targets_sql("tr_assess")),
    "rfm": with_orders(rfm_sql("tr_training")),
    "train_table": with_orders(table_sql("tr")),
    "test_table": with_orders(table_sql("te")),
    "all_customers": with_orders(f"{table_sql('tr')}\nUNION ALL\n{table_sql('te')}"),
    "event_rfm": f"WITH {EVENTS_FLOW}\n{table_sql('tr')}",
    "most_likely": with_orders(TEST_PRED),
    "recent_but_unlikely": with_orders(
        f"SELECT * FROM ({TEST_PRED}) p WHERE recency > -90 AND pred_prob < 0.2"),
    "missed_opportunities": with_orders(
        f"SELECT * FROM ({TEST_PRED}) p WHERE spend_90_total = 0"),
    "spend_more": with_orders(f"""
SELECT spend_actual_vs_pred AS "Actual Vs Prediction", spend_90_total AS "90-Day Spend (Actual)",
       pred_total AS "90-Day Spend (Predict)", customer_id AS "Cust Id", recency AS "Recency",
       frequency AS "Frequency", price_sum AS "Monetary (Total)", price_mean AS "Monetary (Avg)"
FROM ({BASE}) b WHERE spend_90_total < 10 AND pred_total > 10"""),
    "most_likely_top": with_orders(
        f"SELECT * FROM ({TEST_PRED}) p ORDER BY pred_prob DESC, customer_id LIMIT {reg.TOP}"),
    "recent_but_unlikely_top": with_orders(
        f"SELECT * FROM ({ALL_PRED}) p WHERE recency > -400 AND pred_prob < 0.6"
        f" ORDER BY pred_prob, customer_id LIMIT {reg.TOP}"),
    "missed_opportunities_top": with_orders(
        f"SELECT * FROM ({TEST_PRED}) p WHERE spend_90_total = 0"
        f" ORDER BY pred_total DESC, customer_id LIMIT {reg.TOP}"),
    "spend_more_top": with_orders(f"""
SELECT spend_actual_vs_pred AS "Actual Vs Prediction", spend_90_total AS "90-Day Spend (Actual)",
       pred_total AS "90-Day Spend (Predict)", customer_id AS "Cust Id", recency AS "Recency",
       frequency AS "Frequency", price_sum AS "Monetary (Total)", price_mean AS "Monetary (Avg)"
FROM ({BASE}) b WHERE spend_90_total < 10 AND pred_total > 10
ORDER BY pred_total DESC, customer_id LIMIT {reg.TOP}"""),
    "mae": with_orders(f"""
SELECT CAST(SUM(CAST(abs(spend_90_total - pred_total) AS DECIMAL(38,12))) AS DOUBLE)
       / CAST(COUNT(*) AS DOUBLE) AS mae
FROM ({TEST_PRED}) p"""),
    "roc_auc": with_orders(f""",
s AS (SELECT CAST(pred_prob AS DOUBLE) AS score,
             sum(CASE WHEN spend_90_flag = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN spend_90_flag = 1 THEN 0 ELSE 1 END) AS neg
      FROM ({TEST_PRED}) p GROUP BY 1),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                                 AND 1 PRECEDING), 0) AS nb FROM s)
SELECT CAST(sum(pos * (2 * nb + neg)) AS DOUBLE)
       / CAST(2 * (SELECT sum(pos) FROM s) * (SELECT sum(neg) FROM s) AS DOUBLE) AS roc_auc
FROM c"""),
    "roc_curve": with_orders(f""",
s AS (SELECT CAST(pred_prob AS DOUBLE) AS score,
             sum(CASE WHEN spend_90_flag = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN spend_90_flag = 1 THEN 0 ELSE 1 END) AS neg
      FROM ({TEST_PRED}) p GROUP BY 1),
c AS (SELECT score,
             coalesce(sum(pos) OVER w, 0) AS pb, coalesce(sum(neg) OVER w, 0) AS nb FROM s
      WINDOW w AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM s)
SELECT CAST('-inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS specificity,
       CAST(1 AS DOUBLE) AS sensitivity
UNION ALL SELECT CAST('inf' AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)
UNION ALL SELECT score, CAST(nb AS DOUBLE) / CAST(N AS DOUBLE),
                 CAST(P - pb AS DOUBLE) / CAST(P AS DOUBLE) FROM c, t"""),
    "dashboard_base": with_orders(BASE),
    "dashboard_text": DASHBOARD_TEXT,
    "sample_fraction": with_orders(SAMPLE),
    "features_long": with_orders(LONG),
    "scaled_features": with_orders(SCALED),
    "probability_by_frequency": with_orders(f"""
SELECT frequency, count(*) AS customers, avg(pred_prob) AS mean_prob,
       {rank_quantile('pred_prob', 0.25, 'q25_prob')},
       {rank_quantile('pred_prob', 0.5, 'q50_prob')},
       {rank_quantile('pred_prob', 0.75, 'q75_prob')}
FROM (SELECT frequency, pred_prob,
             row_number() OVER (PARTITION BY frequency ORDER BY pred_prob) AS rn,
             count(*) OVER (PARTITION BY frequency) AS cnt
      FROM ({SAMPLE}) s) r
GROUP BY frequency"""),
    "feature_distribution": with_orders(f"""
SELECT feature, CAST(floor(value_scaled / 0.5) * 0.5 AS DOUBLE) AS bin_start,
       count(*) AS customers
FROM ({SCALED}) x WHERE value_scaled IS NOT NULL GROUP BY 1, 2"""),
    "feature_quantiles": with_orders(f"""
SELECT feature, count(*) AS customers,
       {rank_quantile('value_scaled', 0.05, 'q05')}, {rank_quantile('value_scaled', 0.25, 'q25')},
       {rank_quantile('value_scaled', 0.5, 'q50')}, {rank_quantile('value_scaled', 0.75, 'q75')},
       {rank_quantile('value_scaled', 0.95, 'q95')}
FROM (SELECT feature, value_scaled,
             row_number() OVER (PARTITION BY feature ORDER BY value_scaled) AS rn,
             count(*) OVER (PARTITION BY feature) AS cnt
      FROM ({SCALED}) x WHERE value_scaled IS NOT NULL) r
GROUP BY feature"""),
    "clv_statistics": clv_statistics_sql(ORDERS_FLOW, reg.ORDERS_CLV_SPLIT),
    "clv_summary": CLV_SUMMARY,
    "tracking_actual": TRACKING_ACTUAL,
    "event_clv_statistics": clv_statistics_sql(EVENTS_FLOW, reg.EVENTS_CLV_SPLIT),
    "pnbd_scores_fixed": PNBD_SCORES_FIXED,
    "pnbd_loglik_fixed": PNBD_LOGLIK_FIXED,
    "gg_loglik_fixed": GG_LOGLIK_FIXED,
    "pnbd_gradient_fixed": PNBD_GRADIENT_FIXED,
    "pnbd_information_fixed": PNBD_INFORMATION_FIXED,
    "gg_gradient_fixed": GG_GRADIENT_FIXED,
    "spending_density_fixed": SPENDING_DENSITY_FIXED,
    "spending_fixed": SPENDING_FIXED,
    "spending_fixed_repeat": SPENDING_FIXED_REPEAT,
    "tracking_expected_fixed": TRACKING_EXPECTED_FIXED,
}

# round trips and layouts give the rows of the query they start from
ORACLE |= {
    "prediction_round_trip": with_orders(TEST_PRED),
    "action_csv_round_trip": ORACLE["spend_more"],
    "text_scan_positional": ORACLE["text_scan"],
    "tracking_actual_weekly": f"""
SELECT lo + CAST(7 * ceil(datediff('day', lo, period_until) / 7.0) AS INTEGER) AS period_until,
       variable, sum(value) AS value
FROM (SELECT period_until, variable, value, min(period_until) OVER () - 1 AS lo
      FROM ({ORACLE["tracking_actual"]}) days) w
GROUP BY 1, 2""",
}
