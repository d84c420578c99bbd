"""DuckDB oracle SQL for every hash-checked query in ``ratewise.plans.catalog``.

Each statement is independent ANSI SQL over the driver's pre-registered
tables (``lineitem orders part customer events ...``).  The logical views of
``ratewise.sources.testdata`` are restated here as CTEs, written from their
definitions, not from the Spark code.  Doubles are rounded to 6 digits and
``+ 0.0`` removes ``-0.0``; integer aggregates are cast to BIGINT.
"""

from __future__ import annotations

_REQ = ("((user_id * 31 + business_id * 17) % 10 = 0 OR user_id % 50 = 7 "
        "OR business_id % 40 = 9)")

VIEWS = {
    "ratings": """
  SELECT o_custkey AS user_id, l_partkey AS business_id,
         max(CAST(floor((l_quantity - 1) / 10) + 1 AS DOUBLE)) AS stars
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey""",
    "train": f"SELECT * FROM ratings WHERE NOT {_REQ}",
    "requests": f"SELECT * FROM ratings WHERE {_REQ}",
    "raw_lines": """
  SELECT o_custkey AS user_id, o_custkey // 150 * 10 + l_partkey % 97 AS business_id,
         CAST(floor((l_quantity - 1) / 10) + 1 AS DOUBLE) AS stars,
         (l_orderkey * 7 + l_linenumber) % 10 = 0 AS held
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "train_raw": "SELECT user_id, business_id, stars FROM raw_lines WHERE NOT held",
    "requests_raw": "SELECT DISTINCT user_id, business_id FROM raw_lines WHERE held",
    "planted": """
  SELECT user_id, business_id,
         CAST(1 + ((user_id % 5) + (business_id % 5)) / 2.0 AS DOUBLE) AS stars
  FROM ratings""",
    "items": """
  SELECT p_partkey AS business_id,
         CAST(1 + (p_partkey * 7 % 9) / 2.0 AS DOUBLE) AS stars,
         CAST(coalesce(lc.n_lines, 0) AS BIGINT) AS review_count,
         p_retailprice AS latitude,
         p_partkey % 7 <> 0 AS has_attributes,
         CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS a_type,
         CASE WHEN p_partkey % 7 <> 0 THEN split_part(p_name, ' ', 1) END AS a_colour,
         CASE WHEN p_partkey % 7 <> 0 THEN split_part(p_name, ' ', 2) END AS a_noun,
         CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS a_brand,
         CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS VARCHAR) END AS a_size,
         CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 10 = 1 THEN 'yes' END AS a_rare
  FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY l_partkey) lc
    ON lc.l_partkey = p_partkey""",
    "attr_long": """
  SELECT business_id, k AS attr_key, v AS attr_value FROM (
    SELECT business_id, 'type' AS k, a_type AS v FROM items UNION ALL
    SELECT business_id, 'colour', a_colour FROM items UNION ALL
    SELECT business_id, 'noun', a_noun FROM items UNION ALL
    SELECT business_id, 'brand', a_brand FROM items UNION ALL
    SELECT business_id, 'size', a_size FROM items UNION ALL
    SELECT business_id, 'rare', a_rare FROM items) t
  WHERE v IS NOT NULL""",
    "users": """
  SELECT c_custkey AS user_id,
         CAST(coalesce(oc.n_orders, 0) AS DOUBLE) AS review_count,
         CAST(c_nationkey AS DOUBLE) AS useful,
         CAST(c_custkey % 7 AS DOUBLE) AS funny,
         CAST(c_custkey % 11 AS DOUBLE) AS cool,
         CASE WHEN c_custkey % 5 = 0 THEN 'None' WHEN c_custkey % 5 = 1 THEN ''
              ELSE coalesce(oc.years, 'None') END AS elite,
         CASE WHEN c_custkey % 6 = 0 THEN 'None'
              ELSE substr('1,2,3,4,5', 1, CAST(2 * (c_custkey % 6) - 1 AS INTEGER)) END AS friends,
         CAST(c_custkey % 5 AS DOUBLE) AS fans,
         CAST(1 + (c_custkey * 13 % 9) / 2.0 AS DOUBLE) AS average_stars,
         CAST(c_custkey % 3 AS DOUBLE) AS compliment_list,
         CAST(c_custkey % 4 AS DOUBLE) AS compliment_note
  FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS n_orders,
           string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ','
                      ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS years
    FROM orders GROUP BY o_custkey) oc ON oc.o_custkey = c_custkey""",
    "reviews": """
  SELECT l_partkey AS business_id, CAST(l_quantity AS DOUBLE) AS useful,
         l_discount * 100 AS funny, l_tax * 100 AS cool FROM lineitem""",
    "ev": """
  SELECT ts, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS business_id
  FROM events""",
    "tips": "SELECT business_id FROM ev WHERE event_type = 'signup'",
    "photos": "SELECT business_id, event_type AS label FROM ev WHERE event_type = 'view'",
    "checkin_slots_long": """
  SELECT business_id, CAST(dayofweek(ts) + 1 AS VARCHAR) || '-' || CAST(hour(ts) AS VARCHAR) AS slot,
         count(*) AS n
  FROM ev WHERE event_type = 'click' GROUP BY 1, 2""",
    # item-CF building blocks
    "um": "SELECT user_id, avg(stars) AS user_mean, count(*) AS user_n FROM train GROUP BY user_id",
    "im": "SELECT business_id, avg(stars) AS item_mean, count(*) AS item_n FROM train GROUP BY business_id",
    "status": """
  SELECT r.user_id, r.business_id, um.user_mean, im.item_mean
  FROM requests r LEFT JOIN um ON um.user_id = r.user_id
                  LEFT JOIN im ON im.business_id = r.business_id""",
    "warm": """
  SELECT DISTINCT user_id, business_id FROM status
  WHERE user_mean IS NOT NULL AND item_mean IS NOT NULL""",
    "cand": """
  SELECT w.user_id, w.business_id, t.business_id AS neighbour, t.stars AS rating
  FROM warm w JOIN train t ON t.user_id = w.user_id""",
    "pairs": """
  SELECT DISTINCT least(business_id, neighbour) AS item_i,
                  greatest(business_id, neighbour) AS item_j FROM cand""",
    "corate": """
  SELECT p.item_i, p.item_j, a.user_id, a.stars AS x, b.stars AS y
  FROM pairs p JOIN train a ON a.business_id = p.item_i
               JOIN train b ON b.business_id = p.item_j AND b.user_id = a.user_id""",
    "pstats": """
  SELECT item_i, item_j, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS sxy,
         sum(x * x) AS sxx, sum(y * y) AS syy, sum(abs(x - y)) AS sad
  FROM corate GROUP BY item_i, item_j""",
    "sim": """
  SELECT p.item_i, p.item_j, CAST(coalesce(s.n, 0) AS BIGINT) AS n,
         CASE WHEN coalesce(s.n, 0) >= 3 THEN 'pearson' WHEN s.n = 2 THEN 'agreement'
              ELSE 'mean_gap' END AS rule,
         CASE WHEN coalesce(s.n, 0) >= 3 THEN
                CASE WHEN (s.n * s.sxx - s.sx * s.sx) * (s.n * s.syy - s.sy * s.sy) <= 0 THEN 0.0
                     ELSE (s.n * s.sxy - s.sx * s.sy)
                          / sqrt((s.n * s.sxx - s.sx * s.sx) * (s.n * s.syy - s.sy * s.sy)) END
              WHEN s.n = 2 THEN (10.0 - s.sad) / 10.0
              ELSE (5.0 - abs(mi.item_mean - mj.item_mean)) / 5.0 END AS weight
  FROM pairs p LEFT JOIN pstats s ON s.item_i = p.item_i AND s.item_j = p.item_j
       JOIN im mi ON mi.business_id = p.item_i JOIN im mj ON mj.business_id = p.item_j""",
    "wcand": """
  SELECT c.user_id, c.business_id, c.neighbour, c.rating, CAST(s.weight AS DOUBLE) AS weight
  FROM cand c JOIN sim s ON s.item_i = least(c.business_id, c.neighbour)
                        AND s.item_j = greatest(c.business_id, c.neighbour)""",
    "ranked": """
  SELECT *, row_number() OVER (PARTITION BY user_id, business_id
                               ORDER BY round(weight, 9) DESC, neighbour ASC) AS rank
  FROM wcand""",
    "cfs": """
  SELECT user_id, business_id,
         CASE WHEN sum(abs(weight)) = 0 THEN 3.75
              ELSE sum(weight * rating) / sum(abs(weight)) END AS cf_score
  FROM ranked WHERE rank <= 15 GROUP BY user_id, business_id""",
    "cfpred": """
  SELECT s.user_id, s.business_id,
         CAST(CASE WHEN s.user_mean IS NULL THEN 3.75 WHEN s.item_mean IS NULL THEN s.user_mean
                   ELSE coalesce(c.cf_score, 3.75) END AS DOUBLE) AS prediction,
         CASE WHEN s.user_mean IS NULL THEN 'cold_user' WHEN s.item_mean IS NULL THEN 'cold_item'
              ELSE 'cf' END AS source
  FROM status s LEFT JOIN cfs c ON c.user_id = s.user_id AND c.business_id = s.business_id""",
}

# dependency order of the CTEs above
_ORDER = list(VIEWS)


def _deps(body: str) -> set[str]:
    import re
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", body))
    return {v for v in VIEWS if v in words}


def with_views(select: str) -> str:
    """``WITH <needed views> <select>``: only the views the query reaches."""
    need: set[str] = set()
    todo = list(_deps(select))
    while todo:
        v = todo.pop()
        if v in need:
            continue
        need.add(v)
        todo.extend(_deps(VIEWS[v]) - need)
    ctes = [f"{v} AS ({VIEWS[v]}\n)" for v in _ORDER if v in need]
    return ("WITH " + ",\n".join(ctes) + "\n" + select) if ctes else select


def r6(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DOUBLE), 6) + 0.0 AS DOUBLE)"


def r9(expr: str) -> str:
    """Nine digits: exact ties at six are then equal for any formula."""
    return f"CAST(round(CAST({expr} AS DOUBLE), 9) + 0.0 AS DOUBLE)"


QUERIES: dict[str, str] = {}


def q(name: str, select: str) -> None:
    QUERIES[name] = with_views(select)


q("ratings_scan", "SELECT user_id, business_id, stars FROM ratings")
q("train_scan", "SELECT user_id, business_id, stars FROM train")
q("requests_scan", "SELECT user_id, business_id, stars FROM requests")
q("item_means", f"SELECT business_id, {r6('item_mean')} AS item_mean, CAST(item_n AS BIGINT) AS item_n FROM im")
q("user_means", f"SELECT user_id, {r6('user_mean')} AS user_mean, CAST(user_n AS BIGINT) AS user_n FROM um")
q("rater_sets", "SELECT DISTINCT business_id, user_id FROM train")
q("item_degrees", """SELECT business_id, CAST(count(DISTINCT user_id) AS BIGINT) AS n_raters
                     FROM train GROUP BY business_id""")
q("cold_requests", """SELECT user_id, business_id,
        CASE WHEN user_mean IS NULL THEN 'cold_user' ELSE 'cold_item' END AS reason
        FROM status WHERE user_mean IS NULL OR item_mean IS NULL""")
q("cf_candidates", "SELECT user_id, business_id, neighbour, rating FROM cand")
q("item_pairs_needed", "SELECT item_i, item_j FROM pairs")
q("co_raters", "SELECT item_i, item_j, user_id, x, y FROM corate")
q("pair_stats", """SELECT item_i, item_j, CAST(n AS BIGINT) AS n, sx, sy, sxy, sxx, syy, sad
                   FROM pstats""")
q("sim_mean_gap", f"SELECT item_i, item_j, {r6('weight')} AS weight FROM sim WHERE rule = 'mean_gap'")
q("sim_agreement", f"SELECT item_i, item_j, {r6('weight')} AS weight FROM sim WHERE rule = 'agreement'")
q("sim_pearson", f"SELECT item_i, item_j, {r6('weight')} AS weight FROM sim WHERE rule = 'pearson'")
q("item_similarity", f"SELECT item_i, item_j, n, rule, {r6('weight')} AS weight FROM sim")
q("top_neighbours", f"""SELECT user_id, business_id, neighbour, rating, {r6('weight')} AS weight,
                        CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 15""")
q("cf_weighted_mean", f"SELECT user_id, business_id, {r6('cf_score')} AS cf_score FROM cfs")
def _on_raw(select: str) -> str:
    """The same statement over the raw views: means of all rows, neighbour
    ratings of the highest row of a pair."""
    import re
    views = {v: VIEWS[v] for v in ("um", "im", "status", "warm", "cand", "pairs", "corate", "pstats", "sim",
                                   "wcand", "ranked", "cfs", "cfpred")}
    for v in ("um", "im"):
        views[v] = re.sub(r"\btrain\b", "train_raw", views[v])
    views = {v: re.sub(r"\brequests\b", "requests_raw", body) for v, body in views.items()}
    base = {v: VIEWS[v] for v in ("raw_lines", "train_raw", "requests_raw")}
    base["train"] = "SELECT user_id, business_id, max(stars) AS stars FROM train_raw GROUP BY 1, 2"
    return "WITH " + ",\n".join(f"{v} AS ({body}\n)" for v, body in (base | views).items()) + "\n" + select


QUERIES["item_cf_predict_raw"] = _on_raw(
    f"SELECT user_id, business_id, {r6('prediction')} AS prediction, source FROM cfpred")
q("item_means_raw", f"""SELECT business_id, {r6('avg(stars)')} AS item_mean, CAST(count(*) AS BIGINT) AS item_n
                        FROM train_raw GROUP BY business_id""")
q("item_cf_predict", f"SELECT user_id, business_id, {r6('prediction')} AS prediction, source FROM cfpred")


# ---------------------------------------------------------------- profiles
_STATS = ("avg", "std", "kurt", "skew", "max", "min")


def _sums_sql(col: str) -> str:
    """Count, power sums, max and min of ``col`` (exact for rating values)."""
    return (f"count({col}) AS cnt, sum({col}) AS s1, sum({col} * {col}) AS s2, "
            f"sum({col} * {col} * {col}) AS s3, sum({col} * {col} * {col} * {col}) AS s4, "
            f"max({col}) AS mx, min({col}) AS mn")


def _moments_sql(sums: str, keys: str, p: str) -> str:
    """Six statistics from a relation of power sums (pandas rules: NULL
    std below 2 values, NULL skew below 3, NULL kurt below 4, 0 skew/kurt at
    zero variance).  The closed forms are written operation for operation
    as the engine evaluates them, so that exact halves round the same."""
    k = f"{keys}, " if keys else ""
    return f"""
  SELECT {k}
         s1 / n AS {p}_avg,
         CASE WHEN n >= 2 THEN sqrt(greatest(m2, 0.0) / (n - 1)) END AS {p}_std,
         CASE WHEN n < 4 THEN NULL WHEN nm2 <= 0 THEN 0.0
              ELSE n * (n + 1) * (n - 1) * m4 / ((n - 2) * (n - 3) * m2 * m2)
                   - CAST(3.0 AS DOUBLE) * (n - 1) * (n - 1) / ((n - 2) * (n - 3)) END AS {p}_kurt,
         CASE WHEN n < 3 THEN NULL WHEN nm2 <= 0 THEN 0.0
              ELSE (n * sqrt(n - 1) / (n - 2)) * (m3 / (m2 * sqrt(m2))) END AS {p}_skew,
         CASE WHEN n > 0 THEN mx END AS {p}_max, CASE WHEN n > 0 THEN mn END AS {p}_min, cnt
  FROM (SELECT *, nm2 / n AS m2,
               s3 - CAST(3.0 AS DOUBLE) * s1 * s2 / n + CAST(2.0 AS DOUBLE) * s1 * s1 * s1 / (n * n) AS m3,
               s4 - CAST(4.0 AS DOUBLE) * s1 * s3 / n + CAST(6.0 AS DOUBLE) * s1 * s1 * s2 / (n * n)
                  - CAST(3.0 AS DOUBLE) * s1 * s1 * s1 * s1 / (n * n * n) AS m4
        FROM (SELECT *, n * s2 - s1 * s1 AS nm2
              FROM (SELECT *, CASE WHEN cnt > 0 THEN CAST(cnt AS DOUBLE) END AS n
                    FROM ({sums}) z0) z1) z2) z3"""


def _r6_stats(p: str, src: str = "") -> str:
    return ", ".join(f"{r6(src + p + '_' + s)} AS {p}_{s}" for s in _STATS)


def _fallback_stats(p: str, side: str) -> str:
    return ", ".join(f"{r6(f'CASE WHEN {side}.cnt = 0 THEN gp.{p}_{s} ELSE {side}.{p}_{s} END')} AS {p}_{s}"
                     for s in _STATS)


def _global_sql(col: str, table: str, p: str) -> str:
    m = _moments_sql(f"SELECT {_sums_sql(col)} FROM {table}", "", p)
    return (f"SELECT {p}_avg, {p}_std, {p}_kurt, {p}_skew, CAST(5.0 AS DOUBLE) AS {p}_max, "
            f"CAST(1.0 AS DOUBLE) AS {p}_min FROM ({m}) g")


def _copies_sql(key: str) -> str:
    w = ("(o.c - CASE WHEN o.user_id = t.user_id AND o.business_id = t.business_id AND o.stars = t.stars "
         "THEN 1 ELSE 0 END)")
    powers = ", ".join(f"sum({w} * {' * '.join(['o.stars'] * k)}) AS s{k}" for k in range(1, 5))
    return f"""SELECT t.user_id, t.business_id, t.stars, sum({w}) AS cnt, {powers},
      max(CASE WHEN {w} > 0 THEN o.stars END) AS mx, min(CASE WHEN {w} > 0 THEN o.stars END) AS mn
      FROM train_counts t JOIN train_counts o ON o.{key} = t.{key}
      GROUP BY t.user_id, t.business_id, t.stars"""


VIEWS.update({
    "gp": f"""
  SELECT u.*, b.* FROM ({_global_sql('average_stars', 'users', 'usr')}) u,
                       ({_global_sql('stars', 'items', 'bns')}) b""",
    # leave-one-out by definition: the statistics of the *other* rows
    "loo_u": _moments_sql(f"""
  SELECT t.user_id, t.business_id, {_sums_sql('o.stars')}
  FROM train t LEFT JOIN train o ON o.user_id = t.user_id AND o.business_id <> t.business_id
  GROUP BY t.user_id, t.business_id""", "user_id, business_id", "usr"),
    "loo_b": _moments_sql(f"""
  SELECT t.user_id, t.business_id, {_sums_sql('o.stars')}
  FROM train t LEFT JOIN train o ON o.business_id = t.business_id AND o.user_id <> t.user_id
  GROUP BY t.user_id, t.business_id""", "user_id, business_id", "bns"),
    "req_u": _moments_sql(f"""
  SELECT r.user_id, r.business_id, {_sums_sql('o.stars')}
  FROM (SELECT DISTINCT user_id, business_id FROM requests) r
  LEFT JOIN train o ON o.user_id = r.user_id AND o.business_id <> r.business_id
  GROUP BY r.user_id, r.business_id""", "user_id, business_id", "usr"),
    "req_b": _moments_sql(f"""
  SELECT r.user_id, r.business_id, {_sums_sql('o.stars')}
  FROM (SELECT DISTINCT user_id, business_id FROM requests) r
  LEFT JOIN train o ON o.business_id = r.business_id AND o.user_id <> r.user_id
  GROUP BY r.user_id, r.business_id""", "user_id, business_id", "bns"),
    # repeated rows as counts; a row leaves out one copy of itself
    "train_counts": "SELECT user_id, business_id, stars, count(*) AS c FROM train_raw GROUP BY ALL",
    "raw_u": _moments_sql(_copies_sql("user_id"), "user_id, business_id, stars", "usr"),
    "raw_b": _moments_sql(_copies_sql("business_id"), "user_id, business_id, stars", "bns"),
    "raw_req_u": _moments_sql(f"""
  SELECT r.user_id, r.business_id, {_sums_sql('o.stars')}
  FROM requests_raw r LEFT JOIN train_raw o ON o.user_id = r.user_id AND o.business_id <> r.business_id
  GROUP BY r.user_id, r.business_id""", "user_id, business_id", "usr"),
    "raw_req_b": _moments_sql(f"""
  SELECT r.user_id, r.business_id, {_sums_sql('o.stars')}
  FROM requests_raw r LEFT JOIN train_raw o ON o.business_id = r.business_id AND o.user_id <> r.user_id
  GROUP BY r.user_id, r.business_id""", "user_id, business_id", "bns"),
    "loo_train": f"""
  SELECT t.user_id, t.business_id, t.stars AS y,
         {_fallback_stats('usr', 'lu')}, {_fallback_stats('bns', 'lb')}
  FROM train t JOIN loo_u lu ON lu.user_id = t.user_id AND lu.business_id = t.business_id
               JOIN loo_b lb ON lb.user_id = t.user_id AND lb.business_id = t.business_id
               CROSS JOIN gp""",
    "loo_req": f"""
  SELECT r.user_id, r.business_id,
         {_fallback_stats('usr', 'lu')}, {_fallback_stats('bns', 'lb')}
  FROM requests r JOIN req_u lu ON lu.user_id = r.user_id AND lu.business_id = r.business_id
                  JOIN req_b lb ON lb.user_id = r.user_id AND lb.business_id = r.business_id
                  CROSS JOIN gp""",
})
_ORDER[:] = list(VIEWS)

def _builtin_sql(key: str, p: str) -> str:
    """The six statistics by DuckDB's own aggregates, which share nothing with
    the engine's closed forms; only the cases they leave undefined are stated."""
    return f"""SELECT {key}, {r9('avg(stars)')} AS {p}_avg, {r9('stddev_samp(stars)')} AS {p}_std,
      CASE WHEN count(*) < 4 THEN NULL WHEN min(stars) = max(stars) THEN CAST(0 AS DOUBLE)
           ELSE {r9('kurtosis(stars)')} END AS {p}_kurt,
      CASE WHEN count(*) < 3 THEN NULL WHEN min(stars) = max(stars) THEN CAST(0 AS DOUBLE)
           ELSE {r9('skewness(stars)')} END AS {p}_skew,
      {r9('max(stars)')} AS {p}_max, {r9('min(stars)')} AS {p}_min FROM train GROUP BY {key}"""


q("user_profile", _builtin_sql("user_id", "usr"))
q("item_profile", _builtin_sql("business_id", "bns"))
q("global_profile", f"SELECT {_r6_stats('usr')}, {_r6_stats('bns')} FROM gp")
q("loo_train_features", "SELECT * FROM loo_train")
q("loo_request_features", "SELECT * FROM loo_req")
q("loo_train_features_raw", f"""
  SELECT t.user_id, t.business_id, t.stars AS y, {_fallback_stats('usr', 'lu')}, {_fallback_stats('bns', 'lb')}
  FROM train_raw t JOIN raw_u lu USING (user_id, business_id, stars)
  JOIN raw_b lb USING (user_id, business_id, stars) CROSS JOIN gp""")
q("loo_request_features_raw", f"""
  SELECT lu.user_id, lu.business_id, {_fallback_stats('usr', 'lu')}, {_fallback_stats('bns', 'lb')}
  FROM raw_req_u lu JOIN raw_req_b lb ON lb.user_id = lu.user_id AND lb.business_id = lu.business_id
  CROSS JOIN gp""")


# ---------------------------------------------------------------- features
def _len_sql(c: str) -> str:
    return f"CAST(CASE WHEN {c} = 'None' THEN 0 ELSE len(string_split({c}, ',')) END AS DOUBLE)"


VIEWS.update({
    "rel_users": """
  SELECT * FROM users WHERE user_id IN (SELECT user_id FROM train UNION SELECT user_id FROM requests)""",
    "ufeat": f"""
  SELECT user_id, useful, funny, cool, {_len_sql('elite')} AS elite, {_len_sql('friends')} AS friends,
         fans, average_stars, compliment_list, compliment_note, review_count FROM rel_users""",
    "ifeat": """
  SELECT i.business_id, i.stars AS bus_stars, CAST(i.review_count AS DOUBLE) AS review_cnt, i.latitude,
         tc.likes, pc.labels, cs.customers
  FROM items i
  LEFT JOIN (SELECT business_id, CAST(count(*) AS BIGINT) AS likes FROM tips GROUP BY 1) tc
         ON tc.business_id = i.business_id
  LEFT JOIN (SELECT business_id, CAST(count(*) AS BIGINT) AS labels FROM photos GROUP BY 1) pc
         ON pc.business_id = i.business_id
  LEFT JOIN (SELECT business_id, CAST(count(*) AS BIGINT) AS customers FROM checkin_slots_long GROUP BY 1) cs
         ON cs.business_id = i.business_id""",
    "merged": """
  SELECT l.*, f.bus_stars, f.review_cnt, f.latitude, f.likes, f.labels, f.customers,
         u.useful, u.funny, u.cool, u.elite, u.friends, u.fans, u.average_stars,
         u.compliment_list, u.compliment_note, u.review_count
  FROM loo_train l LEFT JOIN ifeat f ON f.business_id = l.business_id
                   LEFT JOIN ufeat u ON u.user_id = l.user_id""",
    "attr_prof": """
  SELECT attr_key, CAST(count(DISTINCT attr_value) AS BIGINT) AS n_values,
         CAST(count(DISTINCT business_id) AS BIGINT) AS n_items,
         (SELECT CAST(count(*) AS BIGINT) FROM items) AS total_items
  FROM attr_long GROUP BY attr_key""",
    "attr_sel": "SELECT * FROM attr_prof WHERE n_values <= 10 AND n_items * 5 >= total_items * 1",
    "tv": """
  SELECT t.user_id, t.business_id, s.attr_key, coalesce(a.attr_value, 'unk') AS v
  FROM train t CROSS JOIN (SELECT attr_key FROM attr_sel) s
  LEFT JOIN attr_long a ON a.business_id = t.business_id AND a.attr_key = s.attr_key""",
    "rv": """
  SELECT r.user_id, r.business_id, s.attr_key, coalesce(a.attr_value, 'unk') AS v
  FROM requests r CROSS JOIN (SELECT attr_key FROM attr_sel) s
  LEFT JOIN attr_long a ON a.business_id = r.business_id AND a.attr_key = s.attr_key""",
    "attr_text": """
  SELECT business_id, string_agg(attr_key || '=' || attr_value, ';' ORDER BY attr_key) AS attributes
  FROM attr_long WHERE attr_key IN (SELECT attr_key FROM attr_sel) GROUP BY business_id""",
    "first_cat": "SELECT attr_key, min(v) AS v0 FROM tv GROUP BY attr_key",
})
_ORDER[:] = list(VIEWS)

_MERGED_DOUBLES = ["y"] + [f"{p}_{s}" for p in ("usr", "bns") for s in _STATS] + [
    "bus_stars", "review_cnt", "latitude", "useful", "funny", "cool", "elite", "friends", "fans",
    "average_stars", "compliment_list", "compliment_note", "review_count"]
_MERGED_LONGS = ["likes", "labels", "customers"]

q("review_means", f"""SELECT business_id, {r6('avg(useful)')} AS review_useful,
    {r6('avg(funny)')} AS review_funny, {r6('avg(cool)')} AS review_cool FROM reviews GROUP BY business_id""")
q("tip_counts", "SELECT business_id, CAST(count(*) AS BIGINT) AS likes FROM tips GROUP BY business_id")
q("photo_counts", "SELECT business_id, CAST(count(*) AS BIGINT) AS labels FROM photos GROUP BY business_id")
q("checkin_slots", """SELECT business_id, CAST(count(*) AS BIGINT) AS customers
                      FROM checkin_slots_long GROUP BY business_id""")
q("packed_list_len", f"""SELECT user_id, elite, friends, {_len_sql('elite')} AS elite_len,
                         {_len_sql('friends')} AS friends_len FROM users""")
q("json_props", """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
                   FROM events""")
q("relevant_users", "SELECT user_id FROM rel_users")
q("user_features", "SELECT * FROM ufeat")
q("feature_vector8", f"""
  SELECT t.user_id, t.business_id, t.stars AS y,
         {r6('rv.review_useful')} AS review_useful, {r6('rv.review_funny')} AS review_funny,
         {r6('rv.review_cool')} AS review_cool, u.average_stars AS user_avg_stars,
         u.review_count AS user_review_count, u.fans AS user_fans,
         i.stars AS item_stars, CAST(i.review_count AS DOUBLE) AS item_review_count
  FROM train t
  LEFT JOIN (SELECT business_id, avg(useful) AS review_useful, avg(funny) AS review_funny,
                    avg(cool) AS review_cool FROM reviews GROUP BY business_id) rv
         ON rv.business_id = t.business_id
  LEFT JOIN users u ON u.user_id = t.user_id
  LEFT JOIN items i ON i.business_id = t.business_id""")
q("attribute_profile", f"""SELECT attr_key, n_values, n_items, total_items,
    {r6('n_items / total_items')} AS coverage FROM attr_prof""")
q("selected_attributes", f"""SELECT attr_key, n_values, n_items, total_items,
    {r6('n_items / total_items')} AS coverage FROM attr_sel""")
q("item_attributes_wide", """SELECT business_id, attr_key, attr_value FROM attr_long
                             WHERE attr_key IN (SELECT attr_key FROM attr_sel)""")
_FILLED = ", ".join(
    [f"{r6(f'coalesce(m.{c}, gp.{c})' if c.startswith('bns_') else ('m.y' if c == 'y' else f'coalesce(m.{c}, 0.0)'))} AS {c}"
     for c in _MERGED_DOUBLES]
    + [f"{r6(f'coalesce(m.{c}, 0)')} AS {c}" for c in _MERGED_LONGS])
_ATTRIBUTES = "coalesce(a.attributes, '') AS attributes"
_ATTR_JOIN = "LEFT JOIN attr_text a ON a.business_id = m.business_id"

q("feature_merge", "SELECT m.user_id, m.business_id, " + ", ".join(
    [f"{r6('m.' + c)} AS {c}" for c in _MERGED_DOUBLES] + [f"m.{c}" for c in _MERGED_LONGS])
  + f", {_ATTRIBUTES} FROM merged m {_ATTR_JOIN}")
q("fill_missing", f"SELECT m.user_id, m.business_id, {_FILLED}, {_ATTRIBUTES} FROM merged m {_ATTR_JOIN} CROSS JOIN gp")

_F32 = "CAST(CAST({0} AS FLOAT) AS DOUBLE)"
_V8 = {"review_useful": "rv.review_useful", "review_funny": "rv.review_funny", "review_cool": "rv.review_cool",
       "user_avg_stars": "u.average_stars", "user_review_count": "u.review_count", "user_fans": "u.fans",
       "item_stars": "i.stars", "item_review_count": "CAST(i.review_count AS DOUBLE)"}
_V8_JOINS = """
  FROM train t
  LEFT JOIN (SELECT business_id, avg(useful) AS review_useful, avg(funny) AS review_funny,
                    avg(cool) AS review_cool FROM reviews GROUP BY business_id) rv
         ON rv.business_id = t.business_id
  LEFT JOIN users u ON u.user_id = t.user_id
  LEFT JOIN items i ON i.business_id = t.business_id"""
q("model_a_frame", f"SELECT t.user_id, t.business_id, {r6(_F32.format('t.stars'))} AS y, " + ", ".join(
    f"{r6(f'coalesce({_F32.format(e)}, -1.0e9)')} AS {c}, CAST(CASE WHEN {e} IS NULL THEN 1 ELSE 0 END AS DOUBLE) "
    f"AS {c}_is_missing" for c, e in _V8.items()) + _V8_JOINS)
q("model_a_frame_two_sided", "SELECT t.user_id, t.business_id, " + ", ".join(
    f"{r6(f'coalesce({_F32.format(e)}, {mark})')} AS {c}_{side}"
    for c, e in _V8.items() for side, mark in (("low", "-1.0e9"), ("high", "1.0e9"))) + _V8_JOINS)

VIEWS.update({
    "merged_req": """
  SELECT l.*, f.bus_stars, f.review_cnt, f.latitude, f.likes, f.labels, f.customers,
         u.useful, u.funny, u.cool, u.elite, u.friends, u.fans, u.average_stars,
         u.compliment_list, u.compliment_note, u.review_count
  FROM (SELECT DISTINCT * FROM loo_req) l LEFT JOIN ifeat f ON f.business_id = l.business_id
                   LEFT JOIN ufeat u ON u.user_id = l.user_id""",
    "hot_train": """
  SELECT user_id, business_id, string_agg(attr_key || v, ';' ORDER BY attr_key || v) AS onehot
  FROM tv JOIN first_cat USING (attr_key) WHERE v <> v0 GROUP BY user_id, business_id""",
    "hot_req": """
  SELECT user_id, business_id, string_agg(attr_key || v, ';' ORDER BY attr_key || v) AS onehot
  FROM (SELECT DISTINCT * FROM rv) rv JOIN first_cat USING (attr_key)
  WHERE v <> v0 AND EXISTS (SELECT 1 FROM tv WHERE tv.attr_key = rv.attr_key AND tv.v = rv.v)
  GROUP BY user_id, business_id""",
})
_ORDER[:] = list(VIEWS)
_HOT_JOIN = "ON h.user_id = m.user_id AND h.business_id = m.business_id CROSS JOIN gp"
q("model_b_frame", f"""SELECT m.user_id, m.business_id, {_FILLED}, coalesce(h.onehot, '') AS onehot
  FROM merged m LEFT JOIN hot_train h {_HOT_JOIN}""")
q("model_b_request_frame", f"""SELECT m.user_id, m.business_id, {_FILLED.split(' AS y, ', 1)[1]},
  coalesce(h.onehot, '') AS onehot FROM merged_req m LEFT JOIN hot_req h {_HOT_JOIN}""")
q("onehot_train", """SELECT user_id, business_id, attr_key || v AS feature
                     FROM tv JOIN first_cat USING (attr_key) WHERE v <> v0""")
q("onehot_requests", """SELECT user_id, business_id, attr_key || v AS feature
                        FROM rv JOIN first_cat USING (attr_key)
                        WHERE v <> v0 AND EXISTS (SELECT 1 FROM tv WHERE tv.attr_key = rv.attr_key AND tv.v = rv.v)""")


# ---------------------------------------------------------------- evaluation
VIEWS.update({
    "cf_truth": """
  SELECT p.prediction, r.stars AS truth FROM cfpred p
  JOIN requests r ON r.user_id = p.user_id AND r.business_id = p.business_id""",
})
_ORDER[:] = list(VIEWS)

q("rmse_eval", f"""SELECT CAST(count(*) AS BIGINT) AS n,
    {r6('sqrt(avg((prediction - truth) * (prediction - truth)))')} AS rmse FROM cf_truth""")
q("error_bands", """
  SELECT b.band, CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM (SELECT CAST(range AS INTEGER) AS band FROM range(5)) b
  LEFT JOIN (SELECT CAST(least(floor(abs(prediction - truth)), 4) AS INTEGER) AS band, count(*) AS n
             FROM cf_truth GROUP BY 1) c ON c.band = b.band""")
q("hybrid_blend", f"""
  SELECT p.user_id, p.business_id,
         {r6('0.1 * p.prediction + (1.0 - 0.1) * coalesce(s.item_mean, s.user_mean, 3.75)')} AS prediction
  FROM cfpred p JOIN status s ON s.user_id = p.user_id AND s.business_id = p.business_id""")


_DCG = "sum((power(2.0, truth) - 1) / log2(rank + 1))"
VIEWS.update({
    "judged": """
  SELECT p.user_id, p.business_id, p.prediction, r.stars AS truth FROM cfpred p
  JOIN requests r ON r.user_id = p.user_id AND r.business_id = p.business_id""",
    "by_score": """
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(prediction, 9) DESC, business_id) AS rank
  FROM judged""",
    "by_truth": "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY truth DESC, business_id) AS rank FROM judged",
    "ranking": f"""
  SELECT e.user_id, e.n, e.n_relevant, g.hits, g.hits / least(10, e.n) AS precision,
         CASE WHEN e.n_relevant > 0 THEN g.hits / e.n_relevant END AS recall, g.dcg / b.ideal AS ndcg
  FROM (SELECT user_id, count(*) AS n, count(*) FILTER (truth >= 4) AS n_relevant FROM judged GROUP BY user_id) e
  JOIN (SELECT user_id, count(*) FILTER (truth >= 4) AS hits, {_DCG} AS dcg FROM by_score WHERE rank <= 10
        GROUP BY user_id) g ON g.user_id = e.user_id
  JOIN (SELECT user_id, {_DCG} AS ideal FROM by_truth WHERE rank <= 10 GROUP BY user_id) b ON b.user_id = e.user_id""",
    "idf": """
  SELECT attr_key, attr_value, ln((SELECT CAST(count(*) AS DOUBLE) FROM items) / count(*)) AS idf
  FROM attr_long GROUP BY attr_key, attr_value""",
    "terms": """
  SELECT business_id, attr_key, attr_value, idf / sqrt(sum(idf * idf) OVER (PARTITION BY business_id)) AS weight
  FROM attr_long JOIN idf USING (attr_key, attr_value) WHERE idf > 0""",
    "ct_cand": """
  SELECT w.user_id, w.business_id, t.business_id AS neighbour, t.stars AS rating
  FROM (SELECT DISTINCT r.user_id, r.business_id FROM requests r JOIN um ON um.user_id = r.user_id) w
  JOIN train t ON t.user_id = w.user_id AND t.business_id <> w.business_id""",
    "ct_pairs": "SELECT DISTINCT business_id, neighbour FROM ct_cand",
    "ct_cos": """
  SELECT p.business_id, p.neighbour, sum(a.weight * b.weight) AS weight FROM ct_pairs p
  JOIN terms a ON a.business_id = p.business_id
  JOIN terms b ON b.business_id = p.neighbour AND b.attr_key = a.attr_key AND b.attr_value = a.attr_value
  GROUP BY p.business_id, p.neighbour""",
    "ct_ranked": """
  SELECT c.*, s.weight, row_number() OVER (PARTITION BY c.user_id, c.business_id
                                           ORDER BY round(s.weight, 9) DESC, c.neighbour) AS rank
  FROM ct_cand c JOIN ct_cos s ON s.business_id = c.business_id AND s.neighbour = c.neighbour""",
    "ct_score": """
  SELECT user_id, business_id, sum(weight * rating) / sum(abs(weight)) AS score
  FROM ct_ranked WHERE rank <= 15 GROUP BY user_id, business_id""",
    "ctpred": """
  SELECT r.user_id, r.business_id, CAST(coalesce(s.score, um.user_mean, 3.75) AS DOUBLE) AS prediction,
         CASE WHEN um.user_mean IS NULL THEN 'cold_user' WHEN s.score IS NULL THEN 'user_mean'
              ELSE 'content' END AS source, r.stars AS truth
  FROM requests r LEFT JOIN um ON um.user_id = r.user_id
  LEFT JOIN ct_score s ON s.user_id = r.user_id AND s.business_id = r.business_id""",
})
_ORDER[:] = list(VIEWS)
q("ranking_eval", f"""SELECT user_id, CAST(n AS BIGINT) AS n, CAST(n_relevant AS BIGINT) AS n_relevant,
    CAST(hits AS BIGINT) AS hits, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('ndcg')} AS ndcg
    FROM ranking""")
q("ranking_summary", f"""SELECT CAST(count(*) AS BIGINT) AS users, {r6('avg(precision)')} AS precision,
    {r6('avg(recall)')} AS recall, {r6('avg(ndcg)')} AS ndcg FROM ranking""")
q("item_terms", f"SELECT business_id, attr_key, attr_value, {r6('weight')} AS weight FROM terms")
q("content_predict", f"SELECT user_id, business_id, {r6('prediction')} AS prediction, source FROM ctpred")
q("content_rmse", f"""SELECT CAST(count(*) AS BIGINT) AS n,
    {r6('sqrt(avg((prediction - truth) * (prediction - truth)))')} AS rmse FROM ctpred""")
q("rater_chunks", """SELECT business_id, user_id >> 16 AS chunk, CAST(count(DISTINCT user_id) AS BIGINT) AS n,
    array_to_string(list_sort(list(DISTINCT user_id & 65535)), ',') AS raters FROM train GROUP BY 1, 2""")
q("rater_overlap", """SELECT p.item_i, p.item_j, CAST(count(c.user_id) AS BIGINT) AS n FROM pairs p
    LEFT JOIN corate c ON c.item_i = p.item_i AND c.item_j = p.item_j GROUP BY 1, 2""")
q("item_similarity_by_counts", f"SELECT item_i, item_j, n, rule, {r6('weight')} AS weight FROM sim")


# ---------------------------------------------------------------- sources and sinks
VIEWS.update({
    "items_text": """
  SELECT i.business_id, i.stars, i.review_count, i.latitude, a.attributes FROM items i
  LEFT JOIN (SELECT business_id, string_agg(attr_key || '=' || attr_value, ';'
                                            ORDER BY attr_key || '=' || attr_value) AS attributes
             FROM attr_long GROUP BY business_id) a ON a.business_id = i.business_id""",
})
_ORDER[:] = list(VIEWS)

q("items_scan", "SELECT * FROM items_text")
q("users_scan", "SELECT * FROM users")
q("ratings_csv_roundtrip", """SELECT CAST(user_id AS VARCHAR) AS user_id,
    CAST(business_id AS VARCHAR) AS business_id, stars FROM train""")
q("items_json_roundtrip", """SELECT CAST(business_id AS VARCHAR) AS business_id, stars, review_count,
    latitude, attributes FROM items_text""")
q("users_json_roundtrip", """SELECT CAST(user_id AS VARCHAR) AS user_id, review_count, useful, funny, cool,
    elite, friends, fans, average_stars, compliment_list, compliment_note FROM users""")
q("reviews_json_roundtrip", f"""SELECT CAST(business_id AS VARCHAR) AS business_id, useful,
    {r6('funny')} AS funny, {r6('cool')} AS cool FROM reviews""")
q("tips_json_roundtrip", "SELECT CAST(business_id AS VARCHAR) AS business_id FROM tips")
q("photos_json_roundtrip", "SELECT CAST(business_id AS VARCHAR) AS business_id, label FROM photos")
q("checkins_json_roundtrip", """SELECT CAST(business_id AS VARCHAR) AS business_id, slot,
    CAST(n AS INTEGER) AS n FROM checkin_slots_long""")
_KEY = "coalesce({0}, 0)"


def _spoilt(key: str, number: bool = True) -> str:
    k = _KEY.format(key)
    return f"({k} % 11 = 3 OR {k} % 13 = 5" + (f" OR {k} % 17 = 7)" if number else ")")


q("items_json_dirty", f"""SELECT CAST(business_id AS VARCHAR) AS business_id, stars, review_count,
    latitude, attributes FROM items_text WHERE NOT {_spoilt('business_id')}""")
q("users_json_dirty", f"""SELECT CAST(user_id AS VARCHAR) AS user_id, review_count, useful, funny, cool,
    elite, friends, fans, average_stars, compliment_list, compliment_note FROM users WHERE NOT {_spoilt('user_id')}""")
q("reviews_json_dirty", f"""SELECT CAST(business_id AS VARCHAR) AS business_id, useful,
    {r6('funny')} AS funny, {r6('cool')} AS cool FROM reviews WHERE NOT {_spoilt('business_id')}""")
q("tips_json_dirty", f"""SELECT CAST(business_id AS VARCHAR) AS business_id FROM tips
    WHERE NOT {_spoilt('business_id', False)}""")
q("photos_json_dirty", f"""SELECT CAST(business_id AS VARCHAR) AS business_id, label FROM photos
    WHERE NOT {_spoilt('business_id', False)}""")
q("checkins_json_dirty", f"""SELECT CAST(business_id AS VARCHAR) AS business_id, slot,
    CAST(n AS INTEGER) AS n FROM checkin_slots_long WHERE NOT {_spoilt('business_id', False)}""")


def _bad_rows(name: str, source: str, key: str, number: bool) -> str:
    k = _KEY.format(key)
    broken = f"({k} % 11 = 3 OR {k} % 13 = 5)"
    # a value of another type is found where the record itself is whole
    value = f"UNION ALL SELECT '{name}', 'value' FROM {source} WHERE NOT {broken} AND {k} % 17 = 7" if number else ""
    return f"SELECT '{name}' AS file, 'record' AS reason FROM {source} WHERE {broken} {value}"


q("json_bad_rows", "SELECT file, reason, CAST(count(*) AS BIGINT) AS n FROM (" + " UNION ALL ".join([
    _bad_rows("items", "items", "business_id", True), _bad_rows("users", "users", "user_id", True),
    _bad_rows("reviews", "reviews", "business_id", True), _bad_rows("tips", "tips", "business_id", False),
    _bad_rows("photos", "photos", "business_id", False),
    _bad_rows("checkins", "(SELECT DISTINCT business_id FROM checkin_slots_long) c", "business_id", False)])
  + ") z GROUP BY file, reason")
q("predictions_sink", f"SELECT user_id, business_id, {r6('prediction')} AS prediction FROM cfpred")
q("fallback_roundtrip", f"SELECT {_r6_stats('usr')}, {_r6_stats('bns')} FROM gp")
q("item_cf_stream", f"SELECT user_id, business_id, {r6('prediction')} AS prediction, source FROM cfpred")
