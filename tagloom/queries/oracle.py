"""SQL twins of the test queries, for DuckDB over the same tables."""

from __future__ import annotations

from tagloom.queries.catalog import FIXED_CENTRES
from tagloom.queries.standins import EVENTS_AS_OF, ORDERS_AS_OF, RULES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rules_cte() -> str:
    rows = ", ".join(f"({id_}, {pid}, {_text(rule)})" for id_, pid, rule in RULES)
    return f"rules(id, pid, rule) AS (VALUES {rows})"


USERS = """
users AS (
  SELECT c.c_custkey AS id,
         CASE WHEN c.c_acctbal < 5000 THEN 1 ELSE 2 END AS gender,
         c.c_mktsegment AS job,
         CAST(floor(c.c_acctbal / 4000) AS INTEGER) AS marriage,
         c.c_nationkey AS politicalface,
         CAST(CAST(f.first_order AS DATE) AS VARCHAR) AS birthday
  FROM customer c
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
    ON f.o_custkey = c.c_custkey)"""

ORDER_ROWS = """
order_rows AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS memberid, o.o_orderkey AS ordersn,
         o.o_totalprice AS orderamount, o.o_orderpriority AS paymentcode,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS finishtime, d.discount AS couponcodevalue
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice * l_discount) AS discount
             FROM lineitem GROUP BY l_orderkey) d ON d.l_orderkey = o.o_orderkey)"""

def _equal(pid: int, attribute: str, inner: bool = False) -> str:
    join = "JOIN" if inner else "LEFT JOIN"
    return (
        f"SELECT CAST(u.id AS VARCHAR) AS userId, CAST(r.id AS VARCHAR) AS tagsId FROM users u "
        f"{join} rules r ON r.pid = {pid} AND r.rule = CAST(u.{attribute} AS VARCHAR)"
    )


AGE = """
SELECT CAST(u.id AS VARCHAR) AS userId, CAST(r.id AS VARCHAR) AS tagsId
FROM users u JOIN rules r ON r.pid = 14 AND strpos(r.rule, '-') > 0
 AND replace(u.birthday, '-', '') BETWEEN split_part(r.rule, '-', 1) AND split_part(r.rule, '-', 2)"""

CYCLE = f"""
SELECT d.userId, CAST(r.id AS VARCHAR) AS tagsId
FROM (SELECT CAST(o_custkey AS VARCHAR) AS userId,
             date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '{ORDERS_AS_OF}') AS days
      FROM orders GROUP BY o_custkey) d
JOIN rules r ON r.pid = 23
 AND d.days BETWEEN TRY_CAST(split_part(r.rule, '-', 1) AS BIGINT)
                AND TRY_CAST(split_part(r.rule, '-', 2) AS BIGINT)"""

MODAL = """
modal AS (
  SELECT memberid, paymentcode FROM (
    SELECT memberid, paymentcode,
           row_number() OVER (PARTITION BY memberid
                              ORDER BY count(*) DESC, paymentcode ASC NULLS LAST) AS rn
    FROM (SELECT CAST(o_custkey AS VARCHAR) AS memberid, o_orderpriority AS paymentcode FROM orders)
    GROUP BY memberid, paymentcode) WHERE rn = 1)"""

PAYMENT = """
SELECT m.memberid AS userId, CAST(r.id AS VARCHAR) AS tagsId
FROM modal m LEFT JOIN rules r ON r.pid = 29 AND r.rule = m.paymentcode"""

RFM_FEATURES = f"""
rfm AS (
  SELECT CAST(o_custkey AS VARCHAR) AS userId,
         CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '{ORDERS_AS_OF}') AS INTEGER) AS recency,
         count(o_orderkey) AS frequency, round(sum(o_totalprice), 2) AS monetary
  FROM orders GROUP BY o_custkey)"""

RFE_FEATURES = f"""
rfe AS (
  SELECT CAST(user_id AS VARCHAR) AS userId,
         CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '{EVENTS_AS_OF}') AS INTEGER) AS recency,
         count(props) AS frequency, count(DISTINCT props) AS engagements
  FROM events GROUP BY user_id)"""

VISITOR_FEATURES = RFE_FEATURES.replace("CAST(user_id AS VARCHAR)", "concat(user_id, '-', event_id % 6)").replace(
    "GROUP BY user_id", "GROUP BY ALL"
)

RFM_SCORED = """
SELECT userId,
  CASE WHEN recency >= 16 THEN 1 WHEN recency >= 10 THEN 2 WHEN recency >= 7 THEN 3
       WHEN recency >= 4 THEN 4 WHEN recency >= 1 THEN 5 ELSE 0 END AS recency,
  CASE WHEN frequency BETWEEN 1 AND 49 THEN 1 WHEN frequency BETWEEN 50 AND 99 THEN 2
       WHEN frequency BETWEEN 100 AND 149 THEN 3 WHEN frequency BETWEEN 150 AND 199 THEN 4
       WHEN frequency >= 200 THEN 5 ELSE 0 END AS frequency,
  CASE WHEN monetary < 100000 THEN 1 WHEN monetary < 350000 THEN 2 WHEN monetary < 500000 THEN 3
       WHEN monetary < 850000 THEN 4 WHEN monetary >= 850000 THEN 5 ELSE 0 END AS monetary
FROM rfm"""

RFM_QUINTILE = """
SELECT userId,
  CASE WHEN recency >= 220 THEN 1 WHEN recency >= 122 THEN 2 WHEN recency >= 53 THEN 3
       WHEN recency >= 14 THEN 4 WHEN recency >= 1 THEN 5 ELSE 0 END AS recency,
  CASE WHEN frequency >= 14 THEN 5 WHEN frequency >= 11 THEN 4 WHEN frequency >= 9 THEN 3
       WHEN frequency >= 7 THEN 2 WHEN frequency >= 1 THEN 1 ELSE 0 END AS frequency,
  CASE WHEN monetary >= 3254294 THEN 5 WHEN monetary >= 2673204 THEN 4
       WHEN monetary >= 2230460 THEN 3 WHEN monetary >= 1709416 THEN 2
       WHEN monetary >= 0 THEN 1 ELSE 0 END AS monetary
FROM rfm"""

RFE_SCORED = """
SELECT userId,
  CASE WHEN recency BETWEEN 0 AND 15 THEN 5 WHEN recency BETWEEN 16 AND 30 THEN 4
       WHEN recency BETWEEN 31 AND 80 THEN 3 WHEN recency BETWEEN 81 AND 95 THEN 2
       WHEN recency > 95 THEN 1 ELSE 0 END AS recency,
  CASE WHEN frequency > 560 THEN 5 WHEN frequency BETWEEN 530 AND 560 THEN 4
       WHEN frequency BETWEEN 400 AND 529 THEN 3 WHEN frequency BETWEEN 250 AND 399 THEN 2
       WHEN frequency < 250 THEN 1 ELSE 0 END AS frequency,
  CASE WHEN engagements > 260 THEN 5 WHEN engagements BETWEEN 240 AND 260 THEN 4
       WHEN engagements BETWEEN 220 AND 239 THEN 3 WHEN engagements BETWEEN 50 AND 219 THEN 2
       WHEN engagements < 49 THEN 1 ELSE 0 END AS engagements
FROM rfe"""

RFE_QUANTILE = """
cuts AS (SELECT quantile_disc(recency, [0.2, 0.4, 0.6, 0.8]) AS r, quantile_disc(frequency, [0.2, 0.4, 0.6, 0.8]) AS f,
  quantile_disc(engagements, [0.2, 0.4, 0.6, 0.8]) AS e FROM rfe)
SELECT userId,
  CAST(CASE WHEN recency IS NULL THEN 0 ELSE 5 - len(list_filter(r, lambda c: recency > c)) END AS INTEGER) AS recency,
  CAST(CASE WHEN frequency IS NULL THEN 0 ELSE 1 + len(list_filter(f, lambda c: frequency > c)) END AS INTEGER) AS frequency,
  CAST(CASE WHEN engagements IS NULL THEN 0 ELSE 1 + len(list_filter(e, lambda c: engagements > c)) END AS INTEGER) AS engagements
FROM rfe, cuts"""

PSM_SCORE = """
SELECT userId, round(CAST(tdon AS DOUBLE) / nullif(ton, 0)
             + (tda / nullif(tdon, 0)) / nullif(tra / nullif(ton, 0), 0)
             + tda / nullif(tra, 0), 6) AS psm
FROM (SELECT memberid AS userId, sum(CASE WHEN coupon > 0 THEN 1 ELSE 0 END) AS tdon,
             count(ordersn) AS ton, sum(coupon) AS tda, sum(amount) AS tra
      FROM (SELECT memberid, ordersn,
                   CASE WHEN orderamount > 250000 THEN couponcodevalue ELSE 0.0 END AS coupon,
                   CASE WHEN paymentcode = '5-LOW' THEN 0.0 ELSE orderamount END AS amount
            FROM order_rows) GROUP BY memberid)
WHERE psm IS NOT NULL"""


def _nearest() -> str:
    rows = ", ".join(f"({i}, {r}, {f}, {m})" for i, (r, f, m) in enumerate(FIXED_CENTRES))
    return (
        f"centres(cluster, r, f, m) AS (VALUES {rows}), scored AS ({RFM_QUINTILE}), "
        "nearest AS (SELECT userId, cluster FROM (SELECT userId, cluster, row_number() OVER ("
        "PARTITION BY userId ORDER BY (recency - r) * (recency - r) + (frequency - f) * "
        "(frequency - f) + (monetary - m) * (monetary - m), cluster) AS rn "
        "FROM scored CROSS JOIN centres) WHERE rn = 1)"
    )


# With no more distinct score vectors than clusters, every vector is a centre of its own.
RFE_CLUSTERED = f"""
SELECT s.userId, CAST(t.id AS VARCHAR) AS tagsId
FROM (SELECT userId, recency + frequency + engagements AS total FROM ({RFE_SCORED})) s
JOIN (SELECT total, row_number() OVER (ORDER BY total DESC) AS place
      FROM (SELECT DISTINCT recency + frequency + engagements AS total FROM ({RFE_SCORED}))) v
  ON v.total = s.total
LEFT JOIN (SELECT id, row_number() OVER (ORDER BY id) AS place FROM rules WHERE pid = 45) t
  ON t.place = v.place"""



PART_RULES = """
SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS rule FROM part
WHERE CAST(substr(p_brand, 7) AS INTEGER) = 7"""


def _planted(last_tag: int, groups: int, scored: str) -> str:
    """The group with the highest number has the highest centre, and so the first tag."""
    return (
        f"SELECT userId, CAST({last_tag} - CAST(userId AS BIGINT) % {groups} AS VARCHAR) AS tagsId "
        f"FROM {scored}"
    )


STORED = """
stored AS (
  SELECT CAST(c_custkey AS VARCHAR) AS userId, concat(c_nationkey, ',100,20') AS tagsId
  FROM customer WHERE c_acctbal >= 0)"""

NEW = """
fresh AS (
  SELECT CAST(o_custkey AS VARCHAR) AS userId,
         string_agg(DISTINCT substr(o_orderpriority, 1, 1), ','
                    ORDER BY substr(o_orderpriority, 1, 1)) AS tagsId
  FROM orders GROUP BY o_custkey)"""


def _united(left: str, right: str) -> str:
    """Union of two non-null tag texts in numeric order."""
    return (
        f"array_to_string(list_sort(list_distinct(CAST(string_split(concat({left}, ',', {right}), ',')"
        " AS BIGINT[]))), ',')"
    )


def _merged(new: str, old: str) -> str:
    return (
        f"CASE WHEN {new} IS NULL THEN {old} WHEN {old} IS NULL THEN {new} "
        f"ELSE {_united(new, old)} END"
    )


def _all_rows(*jobs: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({job})" for job in jobs)


def _batch(*jobs: str) -> str:
    return (
        "batch AS (SELECT userId, array_to_string(list_sort(list(DISTINCT CAST(tagsId AS BIGINT)) "
        "FILTER (WHERE tagsId IS NOT NULL)), ',') AS tagsId "
        f"FROM ({_all_rows(*jobs)}) GROUP BY userId)"
    )


MATCH_STAT = (
    _equal(4, "gender"),
    _equal(7, "job"),
    AGE,
    _equal(61, "politicalface"),
    _equal(65, "marriage"),
    CYCLE,
    PAYMENT,
)


def _sql() -> dict[str, str]:
    rules = _rules_cte()
    people = f"WITH {rules}, {USERS} "
    merged_all = (
        "SELECT coalesce(b.userId, s.userId) AS userId, "
        f"{_merged('b.tagsId', 's.tagsId')} AS tagsId "
        "FROM batch b FULL JOIN stored s ON s.userId = b.userId"
    )
    return {
        "source_scan_by_rule": "SELECT c_custkey, c_mktsegment FROM customer",
        "rule_parse": """
WITH texts AS (
  SELECT p_partkey, concat('inType=parquet##esNodes=', p_brand, '##esIndex=', p_name,
         '##selectFields=', p_type, '=', p_size, '##esNodes=', p_type) AS rule FROM part),
pieces AS (
  SELECT p_partkey, unnest(string_split(rule, '##')) AS piece,
         unnest(range(len(string_split(rule, '##')))) AS place FROM texts)
SELECT p_partkey, split_part(piece, '=', 1) AS rule_key,
       arg_max(substr(piece, strpos(piece, '=') + 1), place) AS rule_value
FROM pieces GROUP BY p_partkey, split_part(piece, '=', 1)""",
        "rule_ranges": """
SELECT p_partkey, CAST(p_size AS VARCHAR) AS range_start,
       CASE WHEN p_size <= 40 THEN CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END AS range_end,
       CAST(p_size AS BIGINT) AS range_low,
       CASE WHEN p_size <= 40 THEN CAST(floor(p_retailprice) AS BIGINT) END AS range_high
FROM part""",
        "rule_values": PART_RULES,
        "rules_from_file": PART_RULES,
        "match_equal_segment": people + _equal(7, "job"),
        "match_inner": people + _equal(61, "politicalface", inner=True),
        "match_equal_many_rules": """
SELECT CAST(o.o_orderkey AS VARCHAR) AS userId, CAST(c.c_custkey AS VARCHAR) AS tagsId
FROM orders o LEFT JOIN customer c ON c.c_name = concat('Customer#', lpad(CAST(o.o_custkey + 10 AS VARCHAR), 9, '0'))""",
        "match_range_string": people + AGE,
        "match_range_many_rules": """
SELECT CAST(c.c_custkey AS VARCHAR) AS userId, CAST(s.s_suppkey AS VARCHAR) AS tagsId
FROM customer c JOIN supplier s
  ON floor(c.c_acctbal) BETWEEN floor(abs(s.s_acctbal)) AND floor(abs(s.s_acctbal)) + 50""",
        "match_range_many_text_rules": """
SELECT CAST(c.c_custkey AS VARCHAR) AS userId, CAST(s.s_suppkey AS VARCHAR) AS tagsId
FROM customer c JOIN supplier s
  ON c.c_name BETWEEN concat('Customer#', lpad(CAST(s.s_suppkey * 12 AS VARCHAR), 9, '0'))
                  AND concat('Customer#', lpad(CAST(s.s_suppkey * 12 + 14 AS VARCHAR), 9, '0'))""",
        "match_range_outlying_rule": """
SELECT CAST(c.c_custkey AS VARCHAR) AS userId, CAST(s.s_suppkey AS VARCHAR) AS tagsId
FROM customer c JOIN supplier s
  ON CASE WHEN s.s_suppkey = 1 THEN c.c_name BETWEEN 'A' AND 'Z'
     ELSE c.c_name BETWEEN concat('Customer#', lpad(CAST(s.s_suppkey * 12 AS VARCHAR), 9, '0'))
                       AND concat('Customer#', lpad(CAST(s.s_suppkey * 12 + 14 AS VARCHAR), 9, '0')) END""",
        "tags_merge": people
        + f"""SELECT userId, {_merged('new_tags', 'old_tags')} AS tagsId FROM (
SELECT n.userId, n.tagsId AS new_tags,
       CASE WHEN u.politicalface < 5 THEN NULL WHEN u.politicalface < 10 THEN '9,9'
            ELSE concat(u.politicalface, ',10,2') END AS old_tags
FROM ({_equal(7, 'job')}) n JOIN users u ON CAST(u.id AS VARCHAR) = n.userId)""",
        "merge_new_with_store": f"WITH {STORED}, {NEW} "
        f"SELECT f.userId, {_merged('f.tagsId', 's.tagsId')} AS tagsId "
        "FROM fresh f LEFT JOIN stored s ON s.userId = f.userId",
        "persona_upsert": f"WITH {STORED}, {NEW} "
        "SELECT * FROM fresh UNION ALL "
        "SELECT * FROM stored WHERE userId NOT IN (SELECT userId FROM fresh)",
        "persona_merge_upsert": f"WITH {STORED}, {NEW} "
        f"SELECT coalesce(f.userId, s.userId) AS userId, {_merged('f.tagsId', 's.tagsId')} AS tagsId "
        "FROM fresh f FULL JOIN stored s ON s.userId = f.userId",
        "persona_merge_read": f"WITH {STORED}, {NEW} "
        f"SELECT f.userId, {_merged('f.tagsId', 's.tagsId')} AS tagsId "
        "FROM fresh f LEFT JOIN stored s ON s.userId = f.userId",
        "persona_two_updates": f"WITH {STORED}, {NEW}, "
        "urgent AS (SELECT CAST(n_nationkey AS VARCHAR) AS userId, '300' AS tagsId FROM nation), "
        f"early AS (SELECT coalesce(f.userId, s.userId) AS userId, {_merged('f.tagsId', 's.tagsId')} AS tagsId "
        "FROM urgent f FULL JOIN stored s ON s.userId = f.userId) "
        f"SELECT coalesce(f.userId, s.userId) AS userId, {_merged('f.tagsId', 's.tagsId')} AS tagsId "
        "FROM fresh f FULL JOIN early s ON s.userId = f.userId",
        "consumption_cycle": f"WITH {rules} {CYCLE}",
        "payway_modal": f"WITH {MODAL} SELECT * FROM modal",
        "payway_modal_window": f"WITH {MODAL} SELECT * FROM modal",
        "payway_tags": f"WITH {rules}, {MODAL} {PAYMENT}",
        "order_profile": f"""WITH {ORDER_ROWS}, {MODAL}
SELECT o.memberid AS userId, min(m.paymentcode) AS payment, max(o.finishtime) AS last_finish,
       count(o.ordersn) AS orders, round(sum(o.orderamount), 2) AS amount,
       CAST(sum(CASE WHEN o.couponcodevalue > 0 THEN 1 ELSE 0 END) AS BIGINT) AS coupon_orders,
       round(sum(o.couponcodevalue), 4) AS coupon_amount
FROM order_rows o JOIN modal m ON m.memberid = o.memberid GROUP BY o.memberid""",
        "order_profile_incremental": f"""WITH {ORDER_ROWS}, {MODAL}
SELECT o.memberid AS userId, min(m.paymentcode) AS payment, max(o.finishtime) AS last_finish,
       count(o.ordersn) AS orders, round(sum(o.orderamount), 2) AS amount,
       CAST(sum(CASE WHEN o.couponcodevalue > 0 THEN 1 ELSE 0 END) AS BIGINT) AS coupon_orders,
       round(sum(o.couponcodevalue), 4) AS coupon_amount
FROM order_rows o JOIN modal m ON m.memberid = o.memberid GROUP BY o.memberid""",
        "rfm_features": f"WITH {RFM_FEATURES} SELECT * FROM rfm",
        "rfm_features_today": f"WITH {RFM_FEATURES.replace(f"DATE '{ORDERS_AS_OF}'", "current_date - 7")} "
        "SELECT * FROM rfm",
        "rfm_scores": f"WITH {RFM_FEATURES} {RFM_SCORED}",
        "rfm_scores_quintile": f"WITH {RFM_FEATURES} {RFM_QUINTILE}",
        "rfe_features": f"WITH {RFE_FEATURES} SELECT * FROM rfe",
        "rfe_features_approx": f"WITH {RFE_FEATURES} SELECT userId, recency, frequency, true AS near FROM rfe",
        "rfe_scores_quantile": f"WITH {VISITOR_FEATURES}, {RFE_QUANTILE}",
        "rfe_scores": f"WITH {RFE_FEATURES} {RFE_SCORED}",
        "psm_features": f"""WITH {ORDER_ROWS}
SELECT memberid AS userId,
       CAST(sum(CASE WHEN couponcodevalue > 0 THEN 1 ELSE 0 END) AS BIGINT) AS tdon,
       count(ordersn) AS ton, round(sum(couponcodevalue), 4) AS tda, round(sum(orderamount), 2) AS tra
FROM order_rows GROUP BY memberid""",
        "psm_score": f"WITH {ORDER_ROWS} {PSM_SCORE}",
        "nearest_centre_fixed": f"WITH {RFM_FEATURES}, {_nearest()} "
        "SELECT userId, CAST(cluster AS INTEGER) AS cluster FROM nearest",
        "cluster_tag_rank": f"""WITH {rules}, {RFM_FEATURES}, {_nearest()}
SELECT n.userId, CAST(t.id AS VARCHAR) AS tagsId FROM nearest n
JOIN (SELECT cluster, row_number() OVER (ORDER BY r + f + m DESC, cluster) AS place FROM centres) c
  ON c.cluster = n.cluster
LEFT JOIN (SELECT id, row_number() OVER (ORDER BY id) AS place FROM rules WHERE pid = 45) t
  ON t.place = c.place""",
        "rfe_cluster_tags": f"WITH {rules}, {RFE_FEATURES} {RFE_CLUSTERED}",
        "rfm_planted_groups": f"WITH {RFM_FEATURES} {_planted(44, 7, 'rfm')}",
        "rfe_planted_groups": f"WITH {RFE_FEATURES} {_planted(49, 4, 'rfe')}",
        "psm_planted_groups": f"WITH {ORDER_ROWS} {_planted(55, 5, f'({PSM_SCORE})')}",
        "gender_tags": people + _equal(4, "gender"),
        "profession_tags": people + _equal(7, "job"),
        "age_tags": people + AGE,
        "political_affiliation_tags": people + _equal(61, "politicalface"),
        "marital_status_tags": people + _equal(65, "marriage"),
        "persona_job_run": people
        + f", {_batch(_equal(4, 'gender'), AGE, _equal(7, 'job'))} SELECT * FROM batch",
        "persona_all_match_stat": people
        + f", {MODAL}, {STORED}, {_batch(*MATCH_STAT)} {merged_all}",
        "persona_tag_counts": people
        + f", {MODAL} SELECT tagsId, count(DISTINCT userId) AS users "
        f"FROM ({_all_rows(*MATCH_STAT)}) WHERE tagsId IS NOT NULL GROUP BY tagsId",
    }


OWN_JOBS = """
WITH fresh AS (
  SELECT c_custkey, list(200 + i ORDER BY i) AS tags FROM customer, range(2, 10) t(i) WHERE c_custkey % i = 0 GROUP BY 1),
stored AS (SELECT c_custkey, [c_nationkey, 100, 20] AS tags FROM customer WHERE c_acctbal >= 0)
SELECT c_custkey::VARCHAR AS userId, CASE WHEN n.tags IS NULL THEN array_to_string(s.tags, ',')
  WHEN s.tags IS NULL THEN array_to_string(n.tags, ',')
  ELSE array_to_string(list_sort(list_distinct(n.tags || s.tags)), ',') END AS tagsId
FROM fresh n FULL JOIN stored s USING (c_custkey)
"""

ORACLE_SQL: dict[str, str] = {**_sql(), "persona_own_jobs": OWN_JOBS}
