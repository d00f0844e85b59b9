"""Building blocks of the reference SQL (DuckDB dialect) that checks the queries.

Written from the definitions of the operators, apart from the DataFrame code.
"""

from __future__ import annotations

from hexcohort import constants as K
from hexcohort.functions.hexgrid import side_km

LI = """SELECT o.o_custkey AS k, count(*) AS n_li, sum(l.l_quantity) AS qty,
  cast(sum(cast(round(l.l_discount*100e0) AS BIGINT)) AS DOUBLE)/(100e0*count(*)) AS disc,
  cast(sum(cast(round(l.l_tax*100e0) AS BIGINT)) AS DOUBLE)/(100e0*count(*)) AS tax,
  cast(sum(CASE WHEN l.l_returnflag='R' THEN 1 ELSE 0 END) AS DOUBLE)/cast(count(*) AS DOUBLE) AS ret
FROM orders o JOIN lineitem l ON l.l_orderkey=o.o_orderkey GROUP BY o.o_custkey"""

SUB = f"""WITH li AS ({LI}),
od AS (SELECT o_custkey AS k, count(*) AS n_o, count(DISTINCT o_orderpriority) AS n_prio FROM orders GROUP BY o_custkey),
b AS (SELECT c.c_custkey AS k, c.c_acctbal AS bal, c.c_nationkey AS nat, c.c_mktsegment AS seg,
  coalesce(li.n_li,0) AS n_li, coalesce(li.qty,0e0) AS qty, coalesce(li.disc,5e-2) AS disc,
  coalesce(li.tax,4e-2) AS tax, coalesce(li.ret,0e0) AS ret, coalesce(od.n_o,0) AS n_o,
  coalesce(od.n_prio,0) AS n_prio,
  cast((c.c_custkey*7919)%10007 AS DOUBLE)/10007e0 AS u1, cast((c.c_custkey*104729)%10009 AS DOUBLE)/10009e0 AS u2,
  cast((c.c_custkey*15485863)%10037 AS DOUBLE)/10037e0 AS u3
  FROM customer c LEFT JOIN li ON li.k=c.c_custkey LEFT JOIN od ON od.k=c.c_custkey)
SELECT concat('SUB_', lpad(cast(k AS VARCHAR(20)),8,'0')) AS subscriber_id,
  CASE seg WHEN 'AUTOMOBILE' THEN 'Urban Commuter' WHEN 'BUILDING' THEN 'Home Office Pro'
    WHEN 'FURNITURE' THEN 'Social Hub' WHEN 'MACHINERY' THEN 'Young Professional' ELSE 'Senior Steady' END AS true_persona_name,
  cast(CASE WHEN k%50=49 THEN -1 ELSE least(6, floor(7e0*u1)) END AS INT) AS segment_id,
  -6.5e0+6e-1*u1 AS home_lat, 106.6e0+5e-1*u2 AS home_lon,
  least(-5.9e0, greatest(-6.5e0, -6.5e0+6e-1*u1+1e-1*(u3-5e-1))) AS work_lat,
  least(107.1e0, greatest(106.6e0, 106.6e0+5e-1*u2+1e-1*(u1-5e-1))) AS work_lon,
  2e0+n_o*1.5e0 AS avg_daily_distance_km, 1e0+60e0*u3 AS travel_radius_km, 5e-1+30e0*u2 AS home_work_distance_km,
  cast(1+n_prio AS DOUBLE) AS n_frequent_locations, 2e-1+7e-1*u1 AS pct_time_at_home, 5e-2+3e-1*u2 AS pct_time_at_work,
  3e0*u3 AS mobility_entropy, qty/47e0 AS data_usage_gb, 50e0+800e0*u2 AS call_minutes_monthly,
  cast(n_li*3 AS DOUBLE) AS sms_monthly, 10e0*ret AS roaming_days_monthly, 1e-1+disc AS morning_data_ratio,
  1e-1+tax AS afternoon_data_ratio, 15e-2+35e-2*u1 AS evening_data_ratio, 5e-2+25e-2*u3 AS night_data_ratio,
  15e-2+45e-2*u2 AS weekend_data_ratio, 15e-2+45e-2*u3 AS peak_hour_data_ratio, u1 AS poi_office_score,
  u2 AS poi_transit_score, u3 AS poi_mall_score, 1e0-u1 AS poi_residential_score, 1e0-u2 AS poi_entertainment_score,
  -20e0+15e0*u3 AS home_zone_rsrq, -20e0+15e0*u1 AS work_zone_rsrq, 1e0+99e0*u2 AS avg_throughput_mbps,
  20e0+130e0*(bal+1000e0)/11000e0 AS monthly_charges, cast(1+k%100 AS DOUBLE) AS tenure_months,
  cast(CASE WHEN k%12=0 THEN 1 ELSE 0 END AS INT) AS senior_citizen,
  CASE WHEN nat%3=0 THEN 'DSL' WHEN nat%3=1 THEN 'fiber_optic' ELSE 'none' END AS internet_service
FROM b"""

POI = """SELECT p_partkey AS osm_id,
  CASE p_partkey%10 WHEN 0 THEN 'office' WHEN 1 THEN 'transit' WHEN 2 THEN 'train_station' WHEN 3 THEN 'mall'
    WHEN 4 THEN 'entertainment' WHEN 5 THEN 'restaurant' WHEN 6 THEN 'education' WHEN 7 THEN 'healthcare'
    WHEN 8 THEN 'residential' ELSE 'park' END AS poi_type, p_name AS name,
  -6.5e0+6e-1*cast((p_partkey*7907)%9973 AS DOUBLE)/9973e0 AS latitude,
  106.6e0+5e-1*cast((p_partkey*7883)%9967 AS DOUBLE)/9967e0 AS longitude FROM part"""

TOWER = """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'GSM' WHEN '2-HIGH' THEN 'UMTS' WHEN '3-MEDIUM' THEN 'LTE'
    WHEN '5-LOW' THEN 'NR' ELSE 'CDMA' END AS radio,
  cast(CASE WHEN o_orderkey%4=0 THEN 525 ELSE 510 END AS INT) AS mcc, cast(o_orderkey%100 AS INT) AS net,
  o_custkey AS area, o_orderkey AS cell, cast(0 AS INT) AS unit,
  106.5e0+7e-1*cast((o_orderkey*7877)%9949 AS DOUBLE)/9949e0 AS lon,
  CASE WHEN o_orderkey%97=0 THEN cast(NULL AS DOUBLE) ELSE -6.6e0+8e-1*cast((o_orderkey*7873)%9941 AS DOUBLE)/9941e0 END AS lat,
  cast(500+o_orderkey%5000 AS INT) AS "range", cast(1+o_orderkey%50 AS INT) AS samples, cast(1 AS INT) AS changeable,
  1262304000+o_orderkey*60 AS created, 1577836800+o_orderkey*60 AS updated,
  cast(-(50+o_orderkey%60) AS INT) AS averageSignal FROM orders"""


def rnd(x: str, n: int) -> str:
    return f"(round_even(({x})*1e{n}, 0)/1e{n})"


def out(x: str, n: int = 6) -> str:
    return f"({rnd(x, n)} + 0e0)"


def clip(x: str, lo=None, hi=None) -> str:
    y = x
    if lo is not None:
        y = f"greatest({y}, {float(lo)}::DOUBLE)"
    if hi is not None:
        y = f"least({y}, {float(hi)}::DOUBLE)"
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE {y} END)"


def flag(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def d(v: float) -> str:
    return f"{float(v)!r}::DOUBLE"


def txt(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strings(values) -> str:
    return "[" + ", ".join(txt(v) for v in values) + "]"


def tier(col: str, bins) -> str:
    lo, parts = 0, []
    for hi, label in bins:
        parts.append(f"WHEN {col} > {lo} AND {col} <= {hi} THEN '{label}'")
        lo = hi
    return "CASE " + " ".join(parts) + " ELSE 'nan' END"


def argmax(pairs) -> str:
    top = "greatest(" + ", ".join(c for _, c in pairs) + ")"
    return "CASE " + " ".join(f"WHEN {c} = {top} THEN {txt(n)}" for n, c in pairs) + " END"


def lookup(expr: str, mapping: dict, other: str) -> str:
    def lit(v):
        return txt(v) if isinstance(v, str) else strings(v) if isinstance(v, (list, tuple)) else d(v)

    return f"CASE {expr} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + f" ELSE {other} END"


def mobility(median: str) -> dict[str, str]:
    return {
        "home_work_ratio": rnd(clip("pct_time_at_home/(pct_time_at_work+1e-6)", 0, 20), 3),
        "other_time_ratio": rnd(clip("1e0-pct_time_at_home-pct_time_at_work", 0, 1), 3),
        "mobility_ratio": rnd(clip("travel_radius_km/(home_work_distance_km+1e0)", 0, 20), 3),
        "commute_intensity": rnd(clip(f"avg_daily_distance_km/{median}", 0, 10), 3),
        "location_concentration": rnd(clip("1e0-mobility_entropy/3.5e0", 0, 1), 3),
        "is_local_worker": flag("home_work_distance_km < 2e0"),
        "is_home_worker": flag("pct_time_at_home > 7e-1"),
        "is_heavy_commuter": flag("avg_daily_distance_km > 18e0"),
        "is_frequent_traveler": flag("travel_radius_km > 40e0"),
        "is_roamer": flag("roaming_days_monthly > 3"),
    }


def temporal() -> dict[str, str]:
    w = [(n, f"{n}_data_ratio") for n in ("morning", "afternoon", "evening", "night")]
    return {
        "primary_usage_window": argmax(w),
        "business_leisure_ratio": rnd(clip(
            "(morning_data_ratio+afternoon_data_ratio)/(evening_data_ratio+night_data_ratio+1e-6)", 0, 10), 3),
        "is_evening_heavy": flag("evening_data_ratio > 38e-2"),
        "is_weekend_heavy": flag("weekend_data_ratio > 45e-2"),
        "is_peak_hour_user": flag("peak_hour_data_ratio > 42e-2"),
        "data_tier": tier("data_usage_gb", K.DATA_TIERS),
        "gb_per_dollar": rnd(clip("data_usage_gb/(monthly_charges+1e0)", 0, 5), 3),
    }


def poi() -> dict[str, str]:
    work = rnd(clip("55e-2*poi_office_score+45e-2*poi_transit_score", 0, 1), 3)
    total = "(" + "+".join(K.POI_SCORES) + "+1e-10)"
    ent = "+".join(f"(CASE WHEN {c} > 0 THEN {c}/{total}*ln({c}/{total}) ELSE 0e0 END)" for c in K.POI_SCORES)
    kinds = ("office", "transit", "mall", "residential", "entertainment")
    return {
        "poi_work_affinity": work,
        "poi_leisure_affinity": rnd(clip("5e-1*poi_mall_score+5e-1*poi_entertainment_score", 0, 1), 3),
        "poi_stay_affinity": rnd(clip("7e-1*poi_residential_score+3e-1*(1e0-poi_transit_score)", 0, 1), 3),
        "poi_transit_affinity": rnd(clip("poi_transit_score", 0, 1), 3),
        "dominant_poi_type": argmax([(k, f"poi_{k}_score") for k in kinds]),
        "poi_diversity_score": out(f"-({ent})", 3),
        "is_office_worker_poi": flag(f"{work} > 55e-2"),
        "is_mall_visitor": flag("poi_mall_score > 6e-1"),
        "is_transit_user": flag("poi_transit_score > 55e-2"),
        "is_residential_anchor": flag("poi_residential_score > 7e-1"),
    }


def usage(md: str, mc: str, mp: str) -> dict[str, str]:
    dn, vn = clip(f"data_usage_gb/({md}+1e-6)", 0, 5), clip(f"call_minutes_monthly/({mc}+1e-6)", 0, 5)
    ratio = rnd(clip(f"{vn}/({dn}+1e-6)", 0, 10), 3)
    roam = rnd(clip("roaming_days_monthly/30e0", 0, 1), 3)
    eng = (f"4e-1*{clip(dn, 0, 1)}+3e-1*{clip(vn, 0, 1)}+2e-1*{clip(clip('sms_monthly/100e0', 0, 3), 0, 1)}"
           f"+1e-1*{roam}")
    return {
        "voice_data_ratio": ratio, "is_voice_dominant": flag(f"{ratio} > 1.5e0"), "is_data_dominant": flag(f"{ratio} < 5e-1"),
        "gb_per_dollar": rnd(clip("data_usage_gb/(monthly_charges+1e0)", 0, 5), 3),
        "calls_per_dollar": rnd(clip("call_minutes_monthly/(monthly_charges+1e0)", 0, 30), 3),
        "arpu_normalised": rnd(clip(f"monthly_charges/({mp}+1e-6)", 0, 5), 3),
        "data_per_tenure_month": rnd("data_usage_gb/greatest(tenure_months, 1e0)", 3),
        "calls_per_tenure_month": rnd("call_minutes_monthly/greatest(tenure_months, 1e0)", 3),
        "roaming_intensity": roam, "is_roaming_user": flag("roaming_days_monthly > 2"),
        "engagement_score": rnd(clip(eng, 0, 1), 3),
        "data_tier": tier("data_usage_gb", K.DATA_TIERS), "arpu_tier": tier("monthly_charges", K.ARPU_TIERS),
        "sms_intensity": rnd(clip("sms_monthly/(greatest(call_minutes_monthly, 1e0)/10e0)", 0, 10), 3),
    }


def cols(named: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in named.items())


MEDIAN_DISTANCE = "(SELECT median(avg_daily_distance_km) FROM sub)"


def with_(**ctes: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in ctes.items()) + " "


def sub(**more: str) -> str:
    return with_(sub=SUB, **more)


def hexed(src: str, lat: str, lon: str, res: int, name: str = "home_h3") -> str:
    """``src`` with the id of the hexagonal cell of a position."""
    s = f"{side_km(res)!r}::DOUBLE"
    return (f"SELECT * EXCLUDE (x_, y_, q_, r_, rq_, rr_, rs_), CASE WHEN {lat} IS NULL OR {lon} IS NULL THEN NULL ELSE "
            f"concat('hx{res}_', cast(CASE WHEN abs(rq_-q_)>abs(rr_-r_) AND abs(rq_-q_)>abs(rs_+q_+r_) THEN -rr_-rs_ ELSE rq_ END AS BIGINT), '_', "
            f"cast(CASE WHEN abs(rq_-q_)>abs(rr_-r_) AND abs(rq_-q_)>abs(rs_+q_+r_) THEN rr_ WHEN abs(rr_-r_)>abs(rs_+q_+r_) THEN -rq_-rs_ ELSE rr_ END AS BIGINT)) END AS {name} "
            f"FROM (SELECT *, floor(q_+5e-1) AS rq_, floor(r_+5e-1) AS rr_, floor(5e-1-q_-r_) AS rs_ FROM "
            f"(SELECT *, (sqrt(3e0)/3e0*x_ - y_/3e0)/{s} AS q_, (2e0/3e0*y_)/{s} AS r_ FROM "
            f"(SELECT *, 6371.0088e0*radians({lon})*cos(radians(-6.2e0)) AS x_, 6371.0088e0*radians({lat}) AS y_ FROM {src})))")


FEATURES35 = K.CLUSTERING_FEATURES + K.EXTRA_FEATURES


def feature_ctes() -> dict[str, str]:
    """feat (all derived columns) and scaled (35 standard-scaled features, s_<name>)."""
    feat = f"SELECT *, {cols(mobility(MEDIAN_DISTANCE))}, {cols(temporal())}, {cols(poi())} FROM sub"
    stats = "SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS p_{c}" for c in FEATURES35) + " FROM feat"
    scaled = ("SELECT subscriber_id, segment_id, home_lat, home_lon, "
              + ", ".join(f"({c}-m_{c})/CASE WHEN p_{c} <= 1e-12 THEN 1e0 ELSE p_{c} END AS s_{c}" for c in FEATURES35)
              + " FROM feat, stats")
    return {"feat": feat, "stats": stats, "scaled": scaled}


def zscore_cte(features, src: str = "sub") -> dict[str, str]:
    """pop and prof: the profile table of the segments."""
    pop = "SELECT count(*) AS all_n, " + ", ".join(f"avg({c}) AS pm_{c}, stddev_samp({c}) AS ps_{c}" for c in features) + f" FROM {src}"
    sel = ", ".join(f"{out(f'avg({c})', 3)} AS mean_{c}, "
                    f"{out(f'(avg({c})-any_value(pm_{c}))/CASE WHEN any_value(ps_{c}) <= abs(any_value(pm_{c}))*1e-12 THEN 1e0 ELSE any_value(ps_{c}) END', 3)} AS zscore_{c}"
                    for c in features)
    prof = (f"SELECT segment_id, count(*) AS n_subscribers, {rnd('cast(count(*) AS DOUBLE)/cast(any_value(all_n) AS DOUBLE)*100e0', 1)} AS pct_of_total, "
            f"{sel} FROM {src}, pop WHERE segment_id >= 0 GROUP BY segment_id")
    return {"pop": pop, "prof": prof}


def matched_ctes(features) -> dict[str, str]:
    """matched (archetype, archetype_score) and named (segment_name, description, plans)."""
    scores = []
    for i, sig in enumerate(K.ARCHETYPES.values()):
        terms = [f"({'1e0' if v > 0 else '-1e0'}*zscore_{f})" for f, v in sig.items() if f in features]
        scores.append("0e0+" + "+".join(terms) + f" AS a{i}")
    best = argmax([(n, f"a{i}") for i, n in enumerate(K.ARCHETYPES)])
    top = "greatest(" + ", ".join(f"a{i}" for i in range(len(K.ARCHETYPES))) + ")"
    skip = ", ".join(f"a{i}" for i in range(len(K.ARCHETYPES)))
    return {
        "scored": f"SELECT *, {', '.join(scores)} FROM prof",
        "matched": f"SELECT * EXCLUDE ({skip}), {best} AS archetype, {top} AS archetype_score FROM scored",
        "named": ("SELECT *, archetype || CASE WHEN nth > 1 THEN ' ' || nth ELSE '' END AS segment_name, "
                  f"{lookup('archetype', K.ARCHETYPE_DESCRIPTIONS, txt(K.FALLBACK_DESCRIPTION))} AS segment_description, "
                  f"{lookup('archetype', K.ARCHETYPE_PLANS, strings(K.FALLBACK_PLANS))} AS plans "
                  "FROM (SELECT *, row_number() OVER (PARTITION BY archetype ORDER BY segment_id) AS nth FROM matched)"),
    }


ARCHETYPE_FEATURES = list(dict.fromkeys(f for sig in K.ARCHETYPES.values() for f in sig))


def dim_ctes() -> dict[str, str]:
    return {**zscore_cte(ARCHETYPE_FEATURES), **matched_ctes(ARCHETYPE_FEATURES)}


def plans_by_name(name: str, other: str) -> str:
    return ("CASE " + " ".join(f"WHEN contains({name}, {txt(a)}) THEN {strings(p)}" for a, p in K.ARCHETYPE_PLANS.items())
            + f" ELSE {other} END")


def plan_name(p: str) -> str:
    return lookup(p, K.PLAN_NAMES, p)


def plan_price(p: str, other: str = "0e0") -> str:
    return lookup(p, K.PLAN_PRICES, other)


def density_ctes(src: str, cell: str = "home_h3", min_subs: int = 5, segments=range(7)) -> dict[str, str]:
    """dens: the density table of ``src``."""
    shares = ", ".join(f"{rnd(f'cast(count(*) FILTER (segment_id={k}) AS DOUBLE)/cast(count(*) AS DOUBLE)', 3)} AS pct_seg_{k}"
                       for k in segments)
    cnt = f"SELECT {cell}, segment_id, count(*) AS n FROM {src} WHERE segment_id >= 0 GROUP BY {cell}, segment_id"
    mode = f"SELECT {cell}, segment_id AS dominant_segment FROM (SELECT *, row_number() OVER (PARTITION BY {cell} ORDER BY n DESC, segment_id) AS rn FROM cnt) WHERE rn = 1"
    ent = f"SELECT {cell}, -sum(p*ln(p+1e-10)) + 0e0 AS segment_entropy FROM (SELECT *, cast(n AS DOUBLE)/sum(n) OVER (PARTITION BY {cell}) AS p FROM cnt) GROUP BY {cell}"
    agg = (f"SELECT {cell}, count(*) AS n_subscribers, {rnd('avg(monthly_charges)', 2)} AS avg_monthly_charges, "
           f"{rnd('avg(data_usage_gb)', 2)} AS avg_data_usage_gb, {rnd('avg(home_zone_rsrq)', 2)} AS avg_rsrq, {shares} "
           f"FROM {src} WHERE segment_id >= 0 GROUP BY {cell} HAVING count(*) >= {min_subs}")
    dens = f"SELECT * FROM agg JOIN mode USING ({cell}) JOIN ent USING ({cell})"
    return {"cnt": cnt, "mode": mode, "ent": ent, "agg": agg, "dens": dens}


def persona_quantiles(feature: str, lo: float, hi: float, group: str = "true_persona_name") -> str:
    return (f"SELECT {group}, quantile_cont({feature}, {lo!r}::DOUBLE) AS low, quantile_cont({feature}, {hi!r}::DOUBLE) AS high "
            f"FROM sub GROUP BY {group}")


def hash_order(key: str = "subscriber_id", seed: int = 42) -> str:
    return f"md5({key} || '|{seed}'), {key}"


def hash28(*parts: str) -> str:
    return "cast('0x' || substr(md5(" + " || '|' || ".join(parts) + "), 1, 7) AS BIGINT)"


PREVIOUS = ("SELECT subscriber_id, cast(CASE WHEN segment_id>=0 AND cast(substr(subscriber_id,5) AS BIGINT)%9=0 "
            "THEN (segment_id+1)%7 ELSE segment_id END AS INT) AS segment_id FROM sub")
