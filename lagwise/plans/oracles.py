"""The same results in SQL, written on their own: no text is shared with the Spark queries."""
from __future__ import annotations

_PROFILE = ("cms_segid", "cms_group_id", "final_gender_code", "age_level",
            "pvalue_level", "shopping_level", "occupation", "new_user_class_level")
_ENTITIES = ("cate_id", "campaign_id", "customer", "pid")
_CATEGORICAL = ("pid", "day_part", "hour", "dow", "final_gender_code", "age_level",
                "pvalue_level", "shopping_level", "occupation", "new_user_class_level",
                "cms_group_id", "gap_bucket")
_RATES = tuple(f"ctr_hist_{e}" for e in _ENTITIES)
_MEASURED = (*_RATES, *(f"log_imp_hist_{e}" for e in _ENTITIES), "ctr_user_prev",
             "log_imp_prev", "order_capped", "log_gap", "ctr_6h", "log_price", "price_rel")
_FLAGS = ("no_profile", "brand_known", "price_valid", "weekend")

_TRAIN = "d BETWEEN DATE '2024-01-02' AND DATE '2024-01-24'"
_VAL = "d BETWEEN DATE '2024-01-25' AND DATE '2024-01-27'"
_TEST = "d BETWEEN DATE '2024-01-28' AND DATE '2024-01-31'"
_D = "CAST({} AS DOUBLE)".format
_B = "CAST({} AS BIGINT)".format


def _r(x: str) -> str:
    return f"round({x}, 6)"


_TABLES: dict[str, str] = {}

_TABLES["imp"] = """
SELECT event_id, user_id AS userid,
       CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS time_stamp,
       CAST(ts + INTERVAL 8 HOURS AS DATE) AS d, k AS adgroup_id,
       concat('slot_', CAST(k % 2 AS VARCHAR)) AS pid,
       CAST(event_type = 'click' AS INTEGER) AS clk,
       1 - CAST(event_type = 'click' AS INTEGER) AS nonclk
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""

_TABLES["raw_ads"] = """
SELECT p_partkey AS adgroup_id, CAST(p_size AS BIGINT) AS cate_id,
       CAST(floor(p_partkey / 5) AS BIGINT) AS campaign_id,
       CAST(substr(p_brand, 7) AS BIGINT) AS customer,
       CASE WHEN p_partkey % 33 = 0 THEN 'NULL' ELSE substr(p_brand, 7) END AS brand_raw,
       CASE WHEN p_partkey % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE p_retailprice END AS price
FROM part"""

_TABLES["ads"] = """
SELECT adgroup_id, cate_id, campaign_id, customer, TRY_CAST(brand_raw AS DOUBLE) AS brand, price
FROM raw_ads"""

_TABLES["all_profiles"] = """
SELECT c_custkey AS userid, c_nationkey AS cms_segid,
       CAST(1 + c_nationkey % 13 AS INTEGER) AS cms_group_id,
       CAST(1 + c_custkey % 2 AS INTEGER) AS final_gender_code,
       CAST(c_nationkey % 7 AS INTEGER) AS age_level,
       CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CAST(1 + c_custkey % 3 AS DOUBLE) END
         AS pvalue_level,
       CAST(1 + c_custkey % 3 AS INTEGER) AS shopping_level,
       CAST(c_custkey % 2 AS INTEGER) AS occupation,
       CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN NULL
            ELSE CAST(1 + c_nationkey % 4 AS DOUBLE) END AS new_user_class_level
FROM customer"""

_TABLES["profile"] = "SELECT * FROM all_profiles WHERE userid % 17 <> 0"

_TABLES["timed"] = """
SELECT *, CAST(hour(ts_local) AS INTEGER) AS hour,
       CASE WHEN hour(ts_local) < 6 THEN 'madrugada' WHEN hour(ts_local) < 12 THEN 'manana'
            WHEN hour(ts_local) < 19 THEN 'tarde' ELSE 'noche' END AS day_part,
       CAST(dayofweek(ts_local) + 1 AS INTEGER) AS dow,
       CAST(dayofweek(ts_local) IN (0, 6) AS INTEGER) AS weekend
FROM (SELECT *, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(time_stamp) AS ts_utc_s,
             TIMESTAMP '1970-01-01 00:00:00' + to_seconds(time_stamp) + INTERVAL 8 HOURS
               AS ts_local
      FROM imp)"""

_TABLES["with_profile"] = """
SELECT imp.*, profile.* EXCLUDE (userid), CAST(cms_segid IS NULL AS INTEGER) AS no_profile
FROM imp LEFT JOIN profile ON imp.userid = profile.userid"""

_SENTINEL = ", ".join(f"coalesce(CAST({c} AS INTEGER), -1) AS {c}" for c in _PROFILE)

_TABLES["silver"] = f"""
SELECT timed.* EXCLUDE (nonclk, ts_utc_s), cate_id, campaign_id, customer, price,
       CAST(brand IS NOT NULL AS INTEGER) AS brand_known, CAST(price > 0 AS INTEGER) AS price_valid,
       CAST(cms_segid IS NULL AS INTEGER) AS no_profile, {_SENTINEL}
FROM timed JOIN ads ON timed.adgroup_id = ads.adgroup_id
LEFT JOIN profile ON timed.userid = profile.userid"""

_TABLES["prior"] = f"""
SELECT d, {_D('sum(clk) OVER w')} / {_D('sum(imp) OVER w')} AS p0
FROM (SELECT d, count(*) AS imp, sum(clk) AS clk FROM imp GROUP BY d)
WINDOW w AS (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""

for _e in _ENTITIES:
    _TABLES[f"hist_{_e}"] = f"""
SELECT x, d, {_B('coalesce(sum(imp) OVER w, 0)')} AS imp_prev,
       {_B('coalesce(sum(clk) OVER w, 0)')} AS clk_prev
FROM (SELECT {_e} AS x, d, count(*) AS imp, sum(clk) AS clk
      FROM imp JOIN ads ON imp.adgroup_id = ads.adgroup_id GROUP BY 1, 2)
WINDOW w AS (PARTITION BY x ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""

_RATE = "(clk_prev + CAST(200 AS DOUBLE) * p0) / (imp_prev + CAST(200 AS DOUBLE))"

_TABLES["user_rows"] = """
SELECT event_id, userid, clk, imp.d, p0,
       CAST(row_number() OVER w AS BIGINT) AS seen,
       time_stamp - lag(time_stamp) OVER w AS gap_sec,
       CAST(coalesce(sum(clk) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS BIGINT) AS clk_prev
FROM imp LEFT JOIN prior ON imp.d = prior.d
WINDOW w AS (PARTITION BY userid ORDER BY time_stamp, adgroup_id, pid, event_id)"""

_TABLES["fatigue"] = """
SELECT *, (clk_prev + CAST(20 AS DOUBLE) * p0) / (seen - 1 + CAST(20 AS DOUBLE)) AS ctr_user_prev,
       ln(CAST(seen AS DOUBLE)) AS log_imp_prev,
       CAST(least(seen, 20) AS DOUBLE) AS order_capped,
       ln(1 + CAST(coalesce(gap_sec, 0) AS DOUBLE)) AS log_gap,
       CASE WHEN gap_sec IS NULL THEN 'primera' WHEN gap_sec <= 300 THEN '0-5min'
            WHEN gap_sec <= 3600 THEN '5-60min' WHEN gap_sec <= 86400 THEN '1-24h'
            ELSE 'mas_1d' END AS gap_bucket
FROM user_rows"""

_TABLES["hours"] = """
SELECT *, CAST(floor((time_stamp - (SELECT min(time_stamp) FROM imp)) / 3600) AS BIGINT)
            AS hour_idx
FROM imp"""

_TABLES["slot"] = """
SELECT pid, hour_idx, avg(rate) OVER (PARTITION BY pid ORDER BY hour_idx
                                      RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING) AS rolling
FROM (SELECT pid, hour_idx, CAST(sum(clk) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate
      FROM hours GROUP BY 1, 2)"""

_TABLES["slot_rows"] = """
SELECT event_id, hours.hour_idx, coalesce(rolling, p0) AS ctr_6h
FROM hours LEFT JOIN slot ON hours.pid = slot.pid AND hours.hour_idx = slot.hour_idx
LEFT JOIN prior ON hours.d = prior.d"""

_TABLES["category_price"] = f"""
SELECT cate_id, avg(price) AS mean_price
FROM imp JOIN ads ON imp.adgroup_id = ads.adgroup_id WHERE {_TRAIN} GROUP BY 1"""

_TABLES["price_rows"] = """
SELECT event_id, ln(1 + greatest(price, 0)) AS log_price,
       coalesce(CASE WHEN mean_price > 0 THEN price / mean_price END, CAST(1 AS DOUBLE))
         AS price_rel
FROM imp JOIN ads ON imp.adgroup_id = ads.adgroup_id
LEFT JOIN category_price ON ads.cate_id = category_price.cate_id"""

_TABLES["gold"] = (
    "SELECT s.event_id, s.userid, s.adgroup_id, s.cate_id, s.campaign_id, s.customer, s.time_stamp, s.d, s.clk, s.pid, "
    "s.day_part, s.hour, s.dow, " + ", ".join(f"s.{c}" for c in _PROFILE[1:])
    + ", f.gap_bucket, "
    + ", ".join(f"{_RATE.replace('clk_prev', f'h_{e}.clk_prev').replace('imp_prev', f'h_{e}.imp_prev').replace('p0', 'prior.p0')} AS ctr_hist_{e}, "
                f"ln(1 + CAST(h_{e}.imp_prev AS DOUBLE)) AS log_imp_hist_{e}" for e in _ENTITIES)
    + ", f.ctr_user_prev, f.log_imp_prev, f.order_capped, f.log_gap, t.ctr_6h, p.log_price, "
      "p.price_rel, " + ", ".join(f"s.{c}" for c in _FLAGS)
    + " FROM silver s JOIN fatigue f ON s.event_id = f.event_id "
      "JOIN slot_rows t ON s.event_id = t.event_id JOIN price_rows p ON s.event_id = p.event_id "
      "LEFT JOIN prior ON s.d = prior.d "
    + " ".join(f"LEFT JOIN hist_{e} h_{e} ON s.{e} = h_{e}.x AND s.d = h_{e}.d"
               for e in _ENTITIES))

_TABLES["scored"] = f"SELECT event_id, clk, ctr_user_prev AS p FROM fatigue WHERE {_TEST}"

_TABLES["clicks_train"] = f"""
SELECT userid, cate_id, CAST(count(*) AS DOUBLE) AS clicks
FROM imp JOIN ads ON imp.adgroup_id = ads.adgroup_id WHERE clk = 1 AND {_TRAIN} GROUP BY 1, 2"""
_TABLES["clicks_test"] = _TABLES["clicks_train"].replace(_TRAIN, _TEST)

_TABLES["popular"] = """
SELECT CAST(row_number() OVER (ORDER BY sum(clicks) DESC, cate_id) AS INTEGER) AS rank,
       cate_id AS item, sum(clicks) AS clicks
FROM clicks_train GROUP BY cate_id QUALIFY rank <= 10"""

_TABLES["missing"] = " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) AS n, count(*) FILTER ({c} IS NULL) AS n_null,
       {_B(f'coalesce(sum(clk) FILTER ({c} IS NULL), 0)')} AS k_null,
       {_B(f'coalesce(sum(clk) FILTER ({c} IS NOT NULL), 0)')} AS k_known
FROM with_profile""" for c in _PROFILE)

_TABLES["missing_profile"] = f"""
SELECT column_name, {_r('100 * CAST(n_null AS DOUBLE) / n')} AS pct_null, n_null,
       {_r('100 * a')} AS ctr_null, {_r('100 * b')} AS ctr_not_null,
       {_r('CASE WHEN a > 0 THEN a / nullif(b, 0) END')} AS ratio,
       {_r('(a - b) / nullif(sqrt(c * (1 - c) * (1 / CAST(n_null AS DOUBLE) + 1 / CAST(n - n_null AS DOUBLE))), 0)')} AS z
FROM (SELECT *, k_null / nullif(CAST(n_null AS DOUBLE), 0) AS a,
             k_known / nullif(CAST(n - n_null AS DOUBLE), 0) AS b,
             (k_null + k_known) / CAST(n AS DOUBLE) AS c FROM missing)"""


def _hash_keep(fraction: float, purpose: str) -> str:
    if fraction == 1:
        return "TRUE"
    limit = format(int(fraction * 2 ** 32), "08x")
    return f"substr(md5(concat('42:{purpose}:', CAST(event_id AS VARCHAR))), 1, 8) < '{limit}'"


_KEPT = f"(clk = 1 OR (clk = 0 AND {_hash_keep(0.1, 'negatives')}))"


def _ranked(source: str) -> str:
    return f"""
SELECT p, n, pos, sum(n) OVER w AS n_cum, sum(pos) OVER w AS pos_cum
FROM (SELECT p, count(*) AS n, sum(clk) AS pos FROM {source} GROUP BY p)
WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def _auc(source: str) -> str:
    return f"""
SELECT {_D('sum((n - pos) * (pos_cum - pos + CAST(pos AS DOUBLE) / 2))')}
         / ({_D('sum(pos)')} * {_D('sum(n - pos)')}) AS auc_roc,
       sum(pos * (pr + CASE WHEN n_cum > n THEN CAST(pos_cum - pos AS DOUBLE)
                            / CAST(n_cum - n AS DOUBLE) ELSE pr END) / 2) / {_D('sum(pos)')} AS auc_pr
FROM (SELECT *, CAST(pos_cum AS DOUBLE) / CAST(n_cum AS DOUBLE) AS pr FROM ({_ranked(source)}))"""


def _metrics(source: str) -> str:
    q = "least(greatest(p, 1e-12), 1 - 1e-12)"
    return f"""
SELECT n, {_r('y')} AS observed, {_r('m')} AS predicted, {_r('ll')} AS logloss,
       {_r('br')} AS brier, {_r('auc_roc')} AS auc_roc, {_r('auc_pr')} AS auc_pr,
       {_r('auc_pr / y')} AS auc_pr_lift, {_r('m / y')} AS calibration_bias
FROM (SELECT count(*) AS n, avg(CAST(clk AS DOUBLE)) AS y, avg(p) AS m,
             avg(-(clk * ln({q}) + (1 - clk) * ln(1 - {q}))) AS ll, avg((p - clk) * (p - clk)) AS br
      FROM {source}), ({_auc(source)})"""


def _needed(sql: str) -> list[str]:
    """Names of the tables a text uses, with theirs, in dependency order."""
    import re
    found: list[str] = []

    def visit(text: str) -> None:
        for name in _TABLES:
            if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(_TABLES[name])
                found.append(name)
    visit(sql)
    return found


def _complete(sql: str) -> str:
    names = _needed(sql)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_TABLES[n]})" for n in names) + "\n" + sql


_SQL: dict[str, str] = {}

_SQL["csv_contract_scan"] = f"SELECT userid, {', '.join(_PROFILE)} FROM all_profiles"
_SQL["schema_cast"] = "SELECT * FROM ads"
_AUDIT = {
    "raw_sample": ("imp", [("user", "userid"), ("time_stamp",) * 2, ("adgroup_id",) * 2,
                           ("pid",) * 2, ("nonclk",) * 2, ("clk",) * 2]),
    "ad_feature": ("raw_ads", [("adgroup_id",) * 2, ("cate_id",) * 2, ("campaign_id",) * 2,
                               ("customer",) * 2, ("brand", "brand_raw"), ("price",) * 2]),
    "user_profile": ("all_profiles", [("userid",) * 2] + [(c, c) for c in _PROFILE]),
}
_SQL["cast_audit"] = (
    "SELECT *, nulls_after - nulls_before AS created_by_cast FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{name}' AS column_name, "
        f"count(*) FILTER ({c} IS NULL) AS nulls_before, "
        + (f"count(*) FILTER (TRY_CAST({c} AS DOUBLE) IS NULL)" if c == "brand_raw"
           else f"count(*) FILTER ({c} IS NULL)") + f" AS nulls_after FROM {source}"
        for t, (source, cols) in _AUDIT.items() for name, c in cols) + ")")
_SQL["undated_rows"] = """
SELECT 'impressions' AS table_name, count(*) AS rows, count(*) FILTER (time_stamp IS NULL) AS undated
FROM imp UNION ALL
SELECT 'with_lost_times', count(*), count(*) FILTER (time_stamp IS NULL OR userid % 13 = 0) FROM imp"""
_SQL["time_features"] = \
    "SELECT event_id, ts_utc_s, ts_local, d, hour, day_part, dow, weekend FROM timed"
_SQL["layer_roundtrip"] = ("SELECT event_id, userid, time_stamp, adgroup_id, pid, clk, ts_local, "
                           "d, hour, day_part FROM timed")
_SQL["layer_partitions"] = "SELECT d, count(*) AS rows FROM imp GROUP BY d"

_SQL["enrich_inner"] = """
SELECT event_id, ads.* FROM imp JOIN ads ON imp.adgroup_id = ads.adgroup_id"""
_SQL["enrich_left"] = """
SELECT with_profile.* EXCLUDE (nonclk), cate_id, campaign_id, customer, price,
       CAST(brand IS NOT NULL AS INTEGER) AS brand_known, CAST(price > 0 AS INTEGER) AS price_valid
FROM with_profile JOIN ads ON with_profile.adgroup_id = ads.adgroup_id"""
_SQL["silver_fact"] = "SELECT * FROM silver"
_SQL["sentinel_fill"] = f"SELECT event_id, {_SENTINEL} FROM with_profile"
_SQL["join_cardinality"] = """
SELECT name AS "check", rows, rows - expected AS delta,
       CASE WHEN rows = expected THEN 'OK' WHEN name LIKE '%unique' THEN 'CLAVE NO ÚNICA'
            WHEN rows > expected THEN 'DUPLICA' ELSE 'PIERDE FILAS' END AS verdict
FROM (
  SELECT 'inner_ads' AS name, (SELECT count(*) FROM imp) AS expected, count(*) AS rows
  FROM imp JOIN ads ON imp.adgroup_id = ads.adgroup_id
  UNION ALL
  SELECT 'inner_ads_left_profiles', (SELECT count(*) FROM imp), count(*)
  FROM imp JOIN ads ON imp.adgroup_id = ads.adgroup_id
  LEFT JOIN profile ON imp.userid = profile.userid
  UNION ALL SELECT 'ads_key_unique', count(DISTINCT adgroup_id), count(*) FROM ads
  UNION ALL SELECT 'profiles_key_unique', count(DISTINCT userid), count(*) FROM profile)"""
_SQL["missingness_profile"] = "SELECT * FROM missing_profile"
_SQL["imputation_decision"] = """
SELECT *, CASE WHEN n_null = 0 THEN 'sin_accion'
               WHEN abs(z) > 3 THEN 'categoria_desconocido'
               WHEN pct_null <= 1 THEN 'descartar_fila' WHEN pct_null <= 5 THEN 'imputar_moda'
               ELSE 'categoria_desconocido' END AS decision,
       CASE WHEN n_null = 0 THEN 'nothing missing in the join' ELSE
         CASE WHEN pct_null <= 1 THEN 'at most 1% missing'
              WHEN pct_null <= 5 THEN 'at most 5% missing' ELSE 'more than 5% missing' END
         || CASE WHEN abs(z) > 3 THEN '; absence is informative'
                 WHEN pct_null > 5 THEN '; too many to impute' ELSE '' END END AS reason
FROM missing_profile"""
_MODE = ("(SELECT CAST({c} AS INTEGER) FROM with_profile WHERE new_user_class_level IS NOT NULL "
         "AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")
_FILL = {c: f"coalesce(CAST({c} AS INTEGER), -1)" for c in _PROFILE} | {
    "cms_segid": "cms_segid", "new_user_class_level": "CAST(new_user_class_level AS INTEGER)"} | {
    c: f"coalesce(CAST({c} AS INTEGER), {_MODE.format(c=c)})" for c in ("age_level", "occupation")}
_SQL["imputation_apply"] = (
    "SELECT event_id, " + ", ".join(f"{x} AS {c}" for c, x in _FILL.items())
    + " FROM with_profile WHERE new_user_class_level IS NOT NULL")
_SQL["feature_nulls"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS nulls FROM gold WHERE {_TRAIN}"
    for c in (*_CATEGORICAL, *_MEASURED, *_FLAGS))

_SQL["daily_ctr"] = f"""
SELECT d, count(*) AS impressions, {_B('sum(clk)')} AS clicks,
       {_r('100 * CAST(sum(clk) AS DOUBLE) / count(*)')} AS ctr_pct FROM imp GROUP BY d"""
_SQL["deferred_prior"] = f"SELECT d, {_r('p0')} AS p0 FROM prior"
_SQL["deferred_entity_ctr"] = " UNION ALL ".join(f"""
SELECT event_id, '{e}' AS entity, imp_prev, clk_prev, {_r(_RATE)} AS ctr_hist,
       {_r('ln(1 + CAST(imp_prev AS DOUBLE))')} AS log_imp_hist
FROM imp JOIN ads ON imp.adgroup_id = ads.adgroup_id
LEFT JOIN hist_{e} ON hist_{e}.x = {'imp' if e == 'pid' else 'ads'}.{e} AND hist_{e}.d = imp.d
LEFT JOIN prior ON prior.d = imp.d""" for e in _ENTITIES)

_LINES = """(SELECT lineitem.*, o_custkey, CAST(l_returnflag = 'R' AS INTEGER) AS clk,
                    CAST(l_shipdate AS DATE) AS d
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_VOLUME = ("l_partkey", "l_suppkey", "o_custkey")


def _line_history(e: str) -> str:
    return f"""
SELECT {e} AS x, d, {_B('coalesce(sum(imp) OVER w, 0)')} AS imp_prev,
       {_B('coalesce(sum(clk) OVER w, 0)')} AS clk_prev
FROM (SELECT {e}, d, count(*) AS imp, sum(clk) AS clk FROM {_LINES} GROUP BY 1, 2)
WINDOW w AS (PARTITION BY {e} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


_SQL["entity_history_volume"] = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, x AS entity_id, d, imp_prev, clk_prev FROM ({_line_history(e)})"
    for e in _VOLUME)
_SQL["deferred_entity_ctr_volume"] = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_custkey, "
    + ", ".join(_r(f"(h{i}.clk_prev + CAST(200 AS DOUBLE) * p0) / (h{i}.imp_prev "
                   f"+ CAST(200 AS DOUBLE))") + f" AS ctr_hist_{e}"
                for i, e in enumerate(_VOLUME))
    + f" FROM {_LINES} l "
    + " ".join(f"LEFT JOIN ({_line_history(e)}) h{i} ON l.{e} = h{i}.x AND l.d = h{i}.d"
               for i, e in enumerate(_VOLUME))
    + f""" LEFT JOIN (
  SELECT d, {_D('sum(clk) OVER w')} / {_D('sum(imp) OVER w')} AS p0
  FROM (SELECT d, count(*) AS imp, sum(clk) AS clk FROM {_LINES} GROUP BY d)
  WINDOW w AS (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) q ON l.d = q.d""")

_SQL["user_fatigue"] = f"""
SELECT event_id, order_capped, gap_sec, gap_bucket, {_r('ctr_user_prev')} AS ctr_user_prev,
       {_r('log_imp_prev')} AS log_imp_prev, {_r('log_gap')} AS log_gap FROM fatigue"""
_SQL["user_fatigue_sliced"] = \
    "SELECT event_id, seen AS order_seen, gap_sec, clk_prev FROM user_rows"
_SQL["user_fatigue_lagged"] = f"""
SELECT event_id, {_r('(coalesce(k, 0) + CAST(20 AS DOUBLE) * p0) / (coalesce(n, 0) + CAST(20 AS DOUBLE))')}
         AS ctr_user_prev
FROM imp LEFT JOIN prior ON imp.d = prior.d
LEFT JOIN (SELECT userid, d, sum(n) OVER w AS n, sum(k) OVER w AS k
           FROM (SELECT userid, d, count(*) AS n, sum(clk) AS k FROM imp GROUP BY 1, 2)
           WINDOW w AS (PARTITION BY userid ORDER BY d
                        RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 2 DAYS PRECEDING)) t
  ON imp.userid = t.userid AND imp.d = t.d"""
_SQL["slot_rolling_ctr"] = \
    f"SELECT event_id, hour_idx, {_r('ctr_6h')} AS ctr_6h FROM slot_rows"
_SQL["price_relative"] = f"""
SELECT event_id, {_r('log_price')} AS log_price, {_r('price_rel')} AS price_rel FROM price_rows"""
_SQL["gold_features"] = ("SELECT * REPLACE (" + ", ".join(f"{_r(c)} AS {c}" for c in _MEASURED)
                         + ") FROM gold")
_SQL["gold_append_day"] = _SQL["gold_features"]

_SQL["temporal_split"] = f"""
SELECT event_id, d, CASE WHEN {_TRAIN} THEN 'train' WHEN {_VAL} THEN 'val' ELSE 'test' END AS split
FROM imp WHERE {_TRAIN} OR {_VAL} OR {_TEST}"""
_SQL["split_summary"] = f"""
SELECT d, count(*) AS rows, {_B('sum(clk)')} AS positives,
       {_r('100 * CAST(sum(clk) AS DOUBLE) / count(*)')} AS ctr_pct,
       CASE WHEN d = DATE '2024-01-01' THEN 'burn-in (no se entrena)' WHEN {_TRAIN} THEN 'train'
            WHEN {_VAL} THEN 'val' WHEN {_TEST} THEN 'test' ELSE 'fuera de rango' END AS split
FROM imp GROUP BY d"""
_SQL["leak_check_corr"] = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, {_r('r')} AS r,
       CASE WHEN r IS NULL THEN 'NO SPREAD' WHEN abs(r) > CAST(0.95 AS DOUBLE) THEN 'FUGA'
            ELSE 'OK' END AS verdict
FROM (SELECT covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) AS r
      FROM (SELECT {c} AS x, CAST(clk AS DOUBLE) AS y FROM gold
            WHERE d <> DATE '2024-01-01' AND {c} IS NOT NULL))""" for c in _MEASURED)
_SQL["leak_check_nulls"] = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS nulls,
       CASE WHEN count(*) FILTER ({c} IS NULL) = 0 THEN 'OK' ELSE 'BURN-IN INSUFICIENTE' END
         AS verdict FROM gold WHERE d = DATE '2024-01-02'""" for c in _RATES)
_SQL["leak_check_range"] = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, {_r(f'min({c})')} AS lowest, {_r(f'max({c})')} AS highest,
       CASE WHEN min({c}) <= 0 OR max({c}) > 1 THEN 'VALOR IMPOSIBLE' ELSE 'OK' END AS verdict
FROM gold""" for c in _RATES)
_SQL["leak_check_recompute"] = " UNION ALL ".join(f"""
SELECT '{e}' AS entity, count(*) AS rows_checked,
       count(*) FILTER ((expected IS NULL) <> (lo IS NULL) OR abs(lo - expected) > 1e-9
                        OR abs(hi - expected) > 1e-9) AS mismatches,
       CASE WHEN mismatches = 0 THEN 'OK' ELSE 'FUGA' END AS verdict
FROM (SELECT a.lo, a.hi, (coalesce(sum(b.clk), 0) + CAST(200 AS DOUBLE)
              * (SELECT CAST(sum(g.clk) AS DOUBLE) / count(*) FROM gold g WHERE g.d < a.d))
             / (coalesce(sum(b.imp), 0) + CAST(200 AS DOUBLE)) AS expected
      FROM (SELECT {e} AS x, d, min(ctr_hist_{e}) AS lo, max(ctr_hist_{e}) AS hi
            FROM gold GROUP BY 1, 2) a
      LEFT JOIN (SELECT {e} AS x, d, count(*) AS imp, sum(clk) AS clk FROM gold GROUP BY 1, 2) b
        ON a.x = b.x AND b.d < a.d
      GROUP BY a.x, a.d, a.lo, a.hi)""" for e in _ENTITIES)

_SQL["negative_undersample"] = f"SELECT event_id, clk, {_KEPT} AS kept FROM imp WHERE {_TRAIN}"
_SQL["nested_fractions"] = " UNION ALL ".join(
    f"SELECT '{f:g}' AS fraction, count(*) AS rows, {_B('coalesce(sum(clk), 0)')} AS positives "
    f"FROM imp WHERE {_hash_keep(f, 'fraction')}" for f in (0.1, 0.25, 0.5, 1.0))
_SQL["class_balance"] = f"""
SELECT p AS positives, n AS negatives, k AS negatives_kept, p + k AS rows_kept,
       {_r('CAST(k AS DOUBLE) / n')} AS effective_rate,
       {_r('CAST(p AS DOUBLE) / (p + k)')} AS prevalence_sample,
       {_r('CAST(p AS DOUBLE) / (p + n)')} AS prevalence_real
FROM (SELECT count(*) FILTER (clk = 1) AS p, count(*) FILTER (clk = 0) AS n,
             count(*) FILTER (clk = 0 AND {_KEPT}) AS k FROM imp WHERE {_TRAIN})"""
_SQL["class_weights"] = f"""
SELECT event_id, CASE WHEN clk = 1 THEN {_r('w')} ELSE CAST(1 AS DOUBLE) END AS weight
FROM imp, (SELECT CAST(count(*) FILTER (clk <> 1) AS DOUBLE) / count(*) FILTER (clk = 1) AS w
           FROM imp WHERE {_TRAIN}) WHERE {_TRAIN}"""
_SQL["prior_correction"] = f"""
SELECT event_id, {_r('q')} AS p_sampled,
       {_r('q * CAST(0.1 AS DOUBLE) / (q * CAST(0.1 AS DOUBLE) + 1 - q)')} AS p_corrected
FROM (SELECT event_id, p / (p + CAST(0.1 AS DOUBLE) * (1 - p)) AS q FROM scored)"""
_SAMPLED = f"(SELECT * FROM scored WHERE {_KEPT})"
_SQL["sampling_effect"] = " UNION ALL ".join(f"""
SELECT '{m}' AS metric, a.{m} AS "full", b.{m} AS sampled,
       {_r(f'(b.{m} - a.{m}) / nullif(a.{m}, 0)')} AS relative_difference
FROM ({_metrics('scored')}) a, ({_metrics(_SAMPLED)}) b"""
                                        for m in ("observed", "auc_roc", "auc_pr", "logloss"))

_CONSTANT = (f"(SELECT clk, (SELECT avg(CAST(clk AS DOUBLE)) FROM imp WHERE {_TRAIN}) AS p "
             f"FROM imp WHERE {_TEST})")
_SQL["baseline_prior"] = _metrics(_CONSTANT)
_SQL["binary_metrics"] = _metrics("scored")
_SQL["auc_exact"] = f"SELECT {_r('auc_roc')} AS auc_roc, {_r('auc_pr')} AS auc_pr FROM ({_auc('scored')})"
_CUTS = "[" + ", ".join(f"CAST(0.{i} AS DOUBLE)" for i in range(1, 10)) + "]"
_SQL["score_deciles"] = f"""
SELECT concat('D', row_number() OVER (ORDER BY b DESC)) AS decile, n AS impressions,
       k AS clicks, {_r('100 * CAST(k AS DOUBLE) / n')} AS ctr_pct, {_r('100 * m')} AS mean_score_pct,
       {_r('(CAST(k AS DOUBLE) / n) / (CAST(sum(k) OVER () AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE))')} AS lift
FROM (SELECT b, count(*) AS n, {_B('sum(clk)')} AS k, avg(p) AS m
      FROM (SELECT clk, p, len(list_filter(q, lambda c: p > c)) AS b
            FROM scored, (SELECT quantile_cont(p, {_CUTS}) AS q FROM scored)) GROUP BY b)"""
_PROBABILITIES = "[0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]"
_SQL["score_quantiles"] = f"""
SELECT CAST(unnest({_PROBABILITIES}) AS DOUBLE) AS probability, true AS within"""
_SQL["score_quantiles_small_error"] = f"""
SELECT CAST(p AS DOUBLE) AS probability,
       (SELECT min(v) FROM (SELECT CAST(o_totalprice AS DOUBLE) AS v, row_number() OVER (ORDER BY o_totalprice) AS k,
                                   count(*) OVER () AS n FROM orders) WHERE k >= CAST(p AS DOUBLE) * n) AS value
FROM (SELECT unnest({_PROBABILITIES}[2:]) AS p)"""
_SQL["product_topk"] = f"""
WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (CAST(1 AS DOUBLE) / (1 + vec_id % 97))) AS v
           FROM embeddings),
s AS (SELECT a.vec_id AS id, b.vec_id AS item, list_dot_product(a.v, b.v) AS score FROM w a CROSS JOIN w b),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, item) AS k FROM s)
SELECT id, CAST(k AS INTEGER) AS rank, item, {_r('score')} AS score FROM r WHERE k <= 10"""
_SQL["pr_curve"] = f"""
SELECT {_r('b / CAST(60 AS DOUBLE)')} AS threshold, {_B('sum(n) OVER w')} AS n_cum,
       {_r('CAST(sum(k) OVER w AS DOUBLE) / CAST(sum(n) OVER w AS DOUBLE)')} AS precision,
       {_r('CAST(sum(k) OVER w AS DOUBLE) / CAST(sum(k) OVER () AS DOUBLE)')} AS recall
FROM (SELECT least(floor(p * 60), 59) AS b, count(*) AS n, sum(clk) AS k FROM scored GROUP BY 1)
WINDOW w AS (ORDER BY b DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

_DECIDED = "(SELECT decision FROM decided WHERE column_name = '{c}')"
_KEPT = " AND ".join(f"NOT ({c} IS NULL AND {_DECIDED.format(c=c)} = 'descartar_fila')"
                     for c in _PROFILE)
_TABLES["decided"] = _SQL["imputation_decision"]
_SQL["imputation_measured"] = (
    "SELECT event_id, " + ", ".join(
        f"CASE {_DECIDED.format(c=c)} WHEN 'categoria_desconocido' "
        f"THEN coalesce(CAST({c} AS INTEGER), -1) WHEN 'imputar_moda' THEN coalesce(CAST({c} AS "
        f"INTEGER), (SELECT CAST({c} AS INTEGER) FROM with_profile WHERE {c} IS NOT NULL AND {_KEPT} "
        f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) ELSE CAST({c} AS INTEGER) END AS {c}"
        for c in _PROFILE) + f" FROM with_profile WHERE {_KEPT}")

_SQL["interaction_matrix"] = "SELECT * FROM clicks_train"
_BOTH = "(SELECT * FROM clicks_train UNION ALL SELECT * FROM clicks_test)"
_SQL["id_range_check"] = " UNION ALL ".join(
    f"SELECT '{c}' AS id, max({c}) AS largest, max({c}) <= 2147483647 AS fits FROM {_BOTH}"
    for c in ("userid", "cate_id"))
_SQL["popularity_topk"] = "SELECT * FROM popular"
_SQL["popularity_ranking"] = """
SELECT DISTINCT userid, (SELECT string_agg(CAST(item AS VARCHAR), ',' ORDER BY rank) FROM popular)
         AS recommended FROM clicks_test"""
_SQL["ranking_metrics"] = f"""
SELECT CAST(10 AS INTEGER) AS k, count(*) AS users_evaluated, count(*) AS users_with_truth,
       count(*) AS users_with_list, {_D('100')} AS coverage_pct,
       {_r('avg(found / CAST(10 AS DOUBLE))')} AS precision_at_k,
       {_r('avg(found / CAST(wanted AS DOUBLE))')} AS recall_at_k,
       {_r('avg(ap / least(wanted, 10))')} AS map_at_k, {_r('avg(dcg / ideal)')} AS ndcg_at_k
FROM (SELECT userid, max(wanted) AS wanted, sum(hit) AS found,
             sum(hit * cum / CAST(rank AS DOUBLE)) AS ap, sum(hit / log2(rank + 1)) AS dcg,
             sum(CASE WHEN rank <= wanted THEN 1 / log2(rank + 1) END) AS ideal
      FROM (SELECT u.userid, wanted, rank, CAST(t.userid IS NOT NULL AS INTEGER) AS hit,
                   sum(CAST(t.userid IS NOT NULL AS INTEGER))
                     OVER (PARTITION BY u.userid ORDER BY rank) AS cum
            FROM (SELECT userid, count(DISTINCT cate_id) AS wanted FROM clicks_test GROUP BY 1) u
            CROSS JOIN popular
            LEFT JOIN clicks_test t ON t.userid = u.userid AND t.cate_id = popular.item)
      GROUP BY userid)"""

_SQL["popularity_metrics"] = _SQL["ranking_metrics"]
_SQL["id_index"] = """
SELECT id, row_number() OVER (ORDER BY id) - 1 AS index
FROM (SELECT DISTINCT l_orderkey AS id FROM lineitem)"""

_SQL["token_encode"] = (
    "SELECT event_id, " + ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), 'DESCONOCIDO') AS {c}_cat" for c in _PROFILE)
    + " FROM with_profile")
_SQL["frequency_index"] = """
SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER) AS label_index
FROM (SELECT coalesce(CAST(new_user_class_level AS VARCHAR), 'DESCONOCIDO') AS label,
             count(*) AS n FROM with_profile GROUP BY 1)"""
_NO_FEATURES = {
    "event_id": "names the row", "userid": "history key", "adgroup_id": "identifier",
    "cate_id": "history key", "campaign_id": "history key", "customer": "history key",
    "time_stamp": "orders the rows", "d": "splits the rows", "clk": "outcome",
}
_SQL["feature_registry"] = " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, '{kind}' AS kind, 'accepted' AS status, '' AS reason, "
     f"count({c}) AS known_rows, count(*) - count({c}) AS null_rows FROM gold WHERE {_TRAIN}"
     for kind, names in (("categorical", _CATEGORICAL), ("numeric", (*_MEASURED, *_FLAGS)))
     for c in names]
    + [f"SELECT '{name}', '-', 'rejected', '{role}', count({name}), count(*) - count({name}) "
       f"FROM gold WHERE {_TRAIN}" for name, role in _NO_FEATURES.items()])


def oracle_sql() -> dict[str, str]:
    return {name: _complete(sql) for name, sql in _SQL.items()}
