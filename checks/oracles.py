"""The same answers in plain SQL, written from the business rules rather than from the Spark code.

``CTES`` is a library of named subqueries; ``compose`` prefixes a final select with those it needs.
"""

from __future__ import annotations

import re

# Values are spelled out here and not taken from the code under test, so that a wrong constant there shows.
STARTER, PARTNER, TOP = "스타터 패키지", "파트너 패키지", "프리미엄 패키지"
ADDS = {STARTER: "a place in the advertised list", PARTNER: "coupons of its own", TOP: "a place on the first page"}
TEAM = "사업운영팀"
SHIFT_DAYS = 9517
WORD_FIXES = [
    ("쿠pon", "쿠폰"), ("쿠Pon", "쿠폰"), ("쿠PON", "쿠폰"), ("이vent", "이벤트"), ("이Vent", "이벤트"), ("이ven트", "이벤트"),
    ("쿠pon이", "쿠폰이"), ("쿠pon을", "쿠폰을"), ("쿠pon은", "쿠폰은"), ("coupon", "쿠폰"), ("Coupon", "쿠폰"), ("COUPON", "쿠폰"),
    ("push", "푸시"), ("PUSH", "푸시"), ("marketing", "마케팅"), ("Marketing", "마케팅"), ("package", "패키지"), ("Package", "패키지"),
]
BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fixed(expr: str) -> str:
    for wrong, right in WORD_FIXES:
        expr = f"replace({expr}, {quoted(wrong)}, {quoted(right)})"
    return expr


def case_map(expr: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {quoted(default)} END"


def thousands(expr: str) -> str:
    return f"format('{{:,}}', CAST({expr} AS BIGINT))"


def one_decimal(expr: str) -> str:
    return f"printf('%.1f', round({expr}, 1))"


def percent(expr: str) -> str:
    return f"CAST(trunc(CAST({expr} AS DOUBLE) * 100) AS INT)"


def mean_text(total: str, n: str) -> str:
    """total / n to one decimal, half up, in integers."""
    return f"printf('%.1f', CASE WHEN {n} = 0 THEN 0.0 ELSE ((20 * {total} + {n}) // (2 * {n})) / 10.0 END)"


def phone(expr: str) -> str:
    p = f"trim({expr}, {BLANK})"
    return (
        f"CASE WHEN {expr} IS NULL OR {expr} = '' THEN '번호없음' "
        f"WHEN length({p}) = 10 THEN left({p}, 3) || '-' || substr({p}, 4, 3) || '-' || substr({p}, 7) "
        f"WHEN length({p}) = 11 THEN left({p}, 3) || '-' || substr({p}, 4, 4) || '-' || substr({p}, 8) ELSE {p} END"
    )


def price(suggested: str, alias: str = "re") -> str:
    """``suggested`` is the test on the suggestion: '<> 0' or '> 0'."""
    return (
        f"CAST(CASE WHEN {alias}.suggestion_price {suggested} THEN round({alias}.suggestion_price, 0) "
        f"WHEN {alias}.total_price_set = 0 THEN round({alias}.total_price, 0) "
        f"ELSE round({alias}.total_price_set, 0) END AS BIGINT)"
    )


def users(table: str, key: str, name: str) -> str:
    return f"""
    SELECT {key} AS id, {name} AS name,
      CASE WHEN {key} % 17 = 0 THEN NULL
           WHEN {key} % 19 = 0 THEN 'Test.' || lower({name}) || '@example.com'
           WHEN {key} % 23 = 0 THEN lower({name}) || '@house.example'
           ELSE lower({name}) || '@example.com' END AS email,
      CASE WHEN {key} % 13 <> 5 THEN list_min({phones_of(key)}) END AS phone
    FROM {table}"""


def phones_of(key: str) -> str:
    """The phone records of a user: two for every fourth, blanks around every seventh, none for some."""
    first = f"CASE {key} % 3 WHEN 0 THEN '010' WHEN 1 THEN '02' ELSE '2' END || lpad({key}::VARCHAR, 8, '0')"
    blank = f"CASE WHEN {key} % 7 = 0 THEN chr(9) || {first} || chr(10) ELSE {first} END"
    return f"CASE WHEN {key} % 4 = 0 THEN [{blank}, '019' || lpad({key}::VARCHAR, 8, '0')] ELSE [{blank}] END"


def reservations(room: str, created: str, success: str) -> str:
    return f"""
    SELECT row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS id, {room} AS room_id,
      CASE l_returnflag || l_linestatus WHEN 'AF' THEN 1 WHEN 'AO' THEN 3 WHEN 'NF' THEN 6
           WHEN 'NO' THEN 7 WHEN 'RF' THEN 8 ELSE 12 END AS status,
      {created} AS created_at, {success} AS success_at,
      CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_extendedprice AS DECIMAL(14,2)) ELSE 0 END AS suggestion_price,
      CAST(l_extendedprice AS DECIMAL(14,2)) AS total_price,
      CASE WHEN l_linenumber % 2 = 0 THEN CAST(0 AS DECIMAL(14,2)) ELSE
        CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(14,2)) END AS total_price_set
    FROM lineitem"""


def eligible(acm: str, user: str, test_marker: bool) -> str:
    """Accommodations with their host; an address that is missing fails both LIKE tests."""
    test = "AND lower(u.email) NOT LIKE '%test%'" if test_marker else ""
    return f"""
    SELECT a.id AS acm_id, a.name AS acm_name, a.sales_id, u.name AS host_name, u.email AS host_email,
      u.phone AS host_phone, string_split(string_split(a.name, '/')[1], '[')[-1] AS region
    FROM {acm} a LEFT JOIN {user} u ON u.id = a.owner
    WHERE NOT a.deleted AND NOT a.is_test AND lower(u.email) NOT LIKE '%house.example%' {test}
      AND NOT (a.name LIKE '%NATION\\_1%' ESCAPE '\\' AND a.name LIKE '%BUILDING%')
      AND (a.type_name IS NULL OR a.type_name NOT LIKE '%TURE')"""


def no_ad(days: int) -> str:
    return f"""
    SELECT h.acm_id, h.acm_name, h.sales_id, h.host_name, h.host_email, h.host_phone,
      CAST(count(re.id) AS BIGINT) AS res_90d,
      CAST(coalesce(sum(CASE WHEN re.status IN (7, 8, 12) THEN {price('<> 0')} ELSE 0 END), 0) AS BIGINT) AS gmv_90d, h.region
    FROM u_host h
    LEFT JOIN orders r ON r.o_custkey = h.acm_id
    LEFT JOIN u_res re ON re.room_id = r.o_orderkey AND re.status IN (1, 3, 6, 7, 8, 12)
      AND re.created_at >= u_now - INTERVAL {days} DAY AND re.created_at <= u_now
    WHERE NOT EXISTS (SELECT 1 FROM u_active aa WHERE aa.acm_id = h.acm_id)
    GROUP BY ALL HAVING count(re.id) > 0""".replace("u_now", NOW)


NOW = "TIMESTAMP '1998-01-15'"
CONTACTS_NOW = "TIMESTAMP '2024-02-05'"
SHIFT = f"INTERVAL {SHIFT_DAYS} DAY"
GRADE = "CASE WHEN res_90d >= 10 THEN 'A' WHEN res_90d >= 3 THEN 'B' WHEN res_90d >= 2 THEN 'C' ELSE 'D' END"
SCORED_ORDER = "grade, res_90d DESC, acm_id, advert_name NULLS FIRST"


def scored_no_ad(source: str) -> str:
    return f"""
    SELECT *, {GRADE} AS grade, 'no_ad' AS target_type, {quoted(STARTER)} AS rec_package, 0.15::DOUBLE AS rec_rate,
      CAST(trunc(gmv_90d * (0.15::DOUBLE - 0.0::DOUBLE)) AS BIGINT) AS extra_rev_90d
    FROM {source}"""


def monthly_pair(table: str) -> str:
    """Both months joined to the room, as two left joins; identical pairs only inflate the sums."""
    return f"""
    SELECT h.acm_id, h.acm_name, aa.advert_name, aa.rate AS advert_commission, h.host_name, h.host_email, h.host_phone, h.region,
      CAST(count(DISTINCT re1.id) AS BIGINT) AS res_this_month,
      CAST(coalesce(sum({price('> 0', 're1')}), 0) AS BIGINT) AS gmv_this_month,
      CAST(count(DISTINCT re2.id) AS BIGINT) AS res_last_month,
      CAST(coalesce(sum({price('> 0', 're2')}), 0) AS BIGINT) AS gmv_last_month
    FROM m_host h JOIN (SELECT DISTINCT acm_id, advert_name, rate FROM m_latest) aa ON aa.acm_id = h.acm_id
    LEFT JOIN m_room r ON r.acm_id = h.acm_id
    LEFT JOIN {table} re1 ON re1.room_id = r.id AND re1.status IN (7, 8) AND CAST(re1.success_at AS DATE) BETWEEN DATE '1997-12-01' AND DATE '1997-12-31'
    LEFT JOIN {table} re2 ON re2.room_id = r.id AND re2.status IN (7, 8) AND CAST(re2.success_at AS DATE) BETWEEN DATE '1997-11-01' AND DATE '1997-11-30'
    GROUP BY ALL"""


def responses(table: str, key: str, copy: str, odd: str, extra: str = "") -> str:
    return f"""
    SELECT {key} AS acm_id {extra}, CASE WHEN {key} % 3 = 0 THEN copy WHEN {key} % 3 = 1 THEN '```json' || chr(10) || copy || chr(10) || '```'
      WHEN {odd} THEN '[' || copy || ']' ELSE left(copy, length(copy) - 1) END AS response
    FROM (SELECT *, CAST({copy} AS VARCHAR) AS copy FROM {table})"""


def parsed(source: str) -> str:
    text = r"regexp_replace(response, '^\s+|\s+$', '', 'g')"
    inner = f"split_part({text}, '```', 2)"
    return f"""
    SELECT *, CASE WHEN json_valid(j) THEN CASE WHEN json_type(j) = 'OBJECT' THEN true ELSE false END ELSE false END AS usable
    FROM (SELECT *, CASE WHEN contains({text}, '```') THEN CASE WHEN starts_with({inner}, 'json') THEN substr({inner}, 5) ELSE {inner} END
      ELSE {text} END AS j FROM {source})"""


def copies(source: str) -> str:
    return f"""
    SELECT acm_id, {fixed("coalesce(json_extract_string(j, '$.subject'), '')")} AS subject,
      {fixed("coalesce(json_extract_string(j, '$.body'), '')")} AS body FROM {source} WHERE usable
    QUALIFY row_number() OVER (PARTITION BY acm_id ORDER BY made DESC) = 1"""


CTES = {
    "u_acm": """
    SELECT c_custkey AS id, '[' || n_name || '/' || c_mktsegment || '] ' || c_name AS name, CAST(c_nationkey AS BIGINT) AS sales_id,
      c_custkey - CASE WHEN c_custkey % 5 = 4 THEN 1 ELSE 0 END AS owner,
      c_mktsegment AS type_name, c_custkey % 29 = 0 AS deleted, c_custkey % 31 = 0 AS is_test
    FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "u_user": users("customer", "c_custkey", "c_name"),
    "u_res": reservations("l_orderkey", "l_shipdate", "l_shipdate + to_days(3 * l_linenumber)"),
    "u_advert": """
    SELECT o_custkey AS acm_id, o_orderpriority AS advert_name,
      CASE o_orderpriority WHEN '1-URGENT' THEN 0.30 WHEN '2-HIGH' THEN 0.20 WHEN '3-MEDIUM' THEN 0.15 ELSE 0.10 END::DECIMAL(4,2) AS rate,
      CASE WHEN o_orderkey % 4 = 0 AND o_orderstatus <> 'P' THEN o_orderdate END AS success_at,
      CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate + INTERVAL 365 DAY END AS expiration_at
    FROM orders""",
    "u_active": f"""
    SELECT * FROM u_advert WHERE success_at IS NOT NULL AND success_at <= {NOW} AND (expiration_at IS NULL OR expiration_at > {NOW})""",
    "u_host": eligible("u_acm", "u_user", True),
    "u_host_any": eligible("u_acm", "u_user", False),
    "u_no_ad": no_ad(90),
    "u_no_ad_365": no_ad(365),
    "u_no_ad_200": "SELECT * FROM u_no_ad ORDER BY res_90d DESC, acm_id LIMIT 200",
    "u_top": """
    SELECT DISTINCT a.acm_id, a.advert_name, a.rate FROM u_active a
    JOIN (SELECT acm_id, max(rate) AS best FROM u_active WHERE rate <= 0.15 GROUP BY acm_id) t ON t.acm_id = a.acm_id AND t.best = a.rate""",
    "u_upgrade": f"""
    SELECT h.acm_id, h.acm_name, h.sales_id, aa.advert_name, aa.rate AS advert_commission, h.host_name, h.host_email, h.host_phone,
      CAST(count(re.id) AS BIGINT) AS res_90d, CAST(coalesce(sum({price('<> 0')}), 0) AS BIGINT) AS gmv_90d, h.region
    FROM u_host_any h JOIN u_top aa ON aa.acm_id = h.acm_id
    LEFT JOIN orders r ON r.o_custkey = h.acm_id
    LEFT JOIN u_res re ON re.room_id = r.o_orderkey AND re.status IN (7, 8)
      AND re.success_at >= {NOW} - INTERVAL 180 DAY AND re.success_at <= {NOW}
    GROUP BY ALL""",
    "u_upgrade_20": "SELECT * FROM u_upgrade ORDER BY res_90d DESC, acm_id, advert_name LIMIT 20",
    "u_no_ad_scored": scored_no_ad("u_no_ad"),
    "u_upgrade_scored": f"""
    SELECT * EXCLUDE (to_package, to_rate), to_package AS rec_package, to_rate AS rec_rate,
      CAST(trunc(gmv_90d * (to_rate - advert_commission::DOUBLE)) AS BIGINT) AS extra_rev_90d
    FROM (SELECT *, {GRADE} AS grade, 'upgrade' AS target_type,
      CASE advert_commission WHEN 0.10 THEN {quoted(STARTER)} WHEN 0.15 THEN {quoted(PARTNER)} WHEN 0.20 THEN {quoted(TOP)} END AS to_package,
      CASE advert_commission WHEN 0.10 THEN 0.15::DOUBLE WHEN 0.15 THEN 0.20::DOUBLE WHEN 0.20 THEN 0.30::DOUBLE END AS to_rate
      FROM u_upgrade) WHERE to_package IS NOT NULL""",
    "u_all": """
    SELECT s.*, coalesce(b.total, 0) AS total, coalesce(b.n, 0) AS n FROM (
      SELECT 1 AS list_no, acm_id, acm_name, sales_id, NULL::VARCHAR AS advert_name, NULL::DECIMAL(4,2) AS advert_commission, host_name, host_email,
        host_phone, res_90d, gmv_90d, region, grade, target_type, rec_package, rec_rate, extra_rev_90d FROM u_no_ad_scored
      UNION ALL
      SELECT 2, acm_id, acm_name, sales_id, advert_name, advert_commission, host_name, host_email,
        host_phone, res_90d, gmv_90d, region, grade, target_type, rec_package, rec_rate, extra_rev_90d FROM u_upgrade_scored) s
    LEFT JOIN u_base b ON b.region = s.region""",
    "u_limited": """
    SELECT * FROM u_all WHERE (list_no = 1 AND acm_id IN (SELECT acm_id FROM u_no_ad_200))
      OR (list_no = 2 AND (acm_id, advert_name) IN (SELECT (acm_id, advert_name) FROM u_upgrade_20))""",
    "u_listed": f"SELECT *, CAST(row_number() OVER (PARTITION BY list_no ORDER BY {SCORED_ORDER}) AS INT) AS pos FROM u_limited",
    "w_listed": f"""
    SELECT * EXCLUDE (subject, copy_body), CASE WHEN has_copy THEN subject END AS subject, CASE WHEN has_copy THEN copy_body END AS body FROM (
      SELECT t.*, c.subject, c.body AS copy_body, c.acm_id IS NOT NULL AND overall <= 30 AS has_copy FROM (
        SELECT *, CAST(row_number() OVER (ORDER BY list_no, pos) AS INT) AS overall FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY list_no ORDER BY {SCORED_ORDER}) AS INT) AS pos FROM u_limited
          WHERE acm_id NOT IN (SELECT acm_id FROM e_shown WHERE last_shown - {SHIFT} > {NOW} - INTERVAL 7 DAY))) t
      LEFT JOIN u_copy c ON c.acm_id = t.acm_id)""",
    "w_mail": f"""
    SELECT t.*, c.subject, c.body, s.last_sent,
      CASE WHEN s.last_sent IS NOT NULL OR coalesce(t.host_email, '') = '' THEN 'skip' ELSE 'success' END AS outcome
    FROM (SELECT *, row_number() OVER (PARTITION BY acm_id ORDER BY list_no, pos) AS nth FROM u_listed) t JOIN u_copy c ON c.acm_id = t.acm_id
    LEFT JOIN (SELECT email, last_sent - {SHIFT} AS last_sent FROM e_sent) s ON s.email = t.host_email AND s.last_sent >= {NOW} - INTERVAL 14 DAY
    WHERE nth = 1 AND t.acm_id IN (SELECT acm_id FROM k_approved WHERE workflow = 'weekly_upsell' AND NOT test_mode)""",
    "w_mail_all": f"""
    SELECT t.*, c.subject, c.body, s.last_sent,
      CASE WHEN s.last_sent IS NOT NULL OR coalesce(t.host_email, '') = '' THEN 'skip' ELSE 'success' END AS outcome
    FROM (SELECT *, row_number() OVER (PARTITION BY acm_id ORDER BY list_no, pos) AS nth FROM u_ranked) t JOIN u_copy c ON c.acm_id = t.acm_id
    LEFT JOIN (SELECT email, last_sent - {SHIFT} AS last_sent FROM e_sent) s ON s.email = t.host_email AND s.last_sent >= {NOW} - INTERVAL 14 DAY
    WHERE nth = 1 AND t.acm_id IN (SELECT acm_id FROM k_approved WHERE workflow = 'weekly_upsell' AND NOT test_mode)""",
    "u_ranked": f"SELECT *, CAST(row_number() OVER (PARTITION BY list_no ORDER BY {SCORED_ORDER}) AS INT) AS pos FROM u_all",
    "m_mail_all": f"""
    SELECT t.*, c.subject, c.body, s.last_sent,
      CASE WHEN s.last_sent IS NOT NULL OR coalesce(t.host_email, '') = '' THEN 'skip' ELSE 'success' END AS outcome
    FROM (SELECT *, row_number() OVER (PARTITION BY acm_id ORDER BY res_this_month DESC, advert_name) AS nth FROM m_scored_all) t JOIN m_copy c ON c.acm_id = t.acm_id
    LEFT JOIN (SELECT email, last_sent - {SHIFT} AS last_sent FROM e_sent_m) s ON s.email = t.host_email AND s.last_sent >= {NOW} - INTERVAL 25 DAY
    WHERE nth = 1 AND t.acm_id IN (SELECT acm_id FROM k_approved WHERE workflow = 'monthly_report')""",
    "m_mail": f"""
    SELECT t.*, c.subject, c.body, s.last_sent,
      CASE WHEN s.last_sent IS NOT NULL OR coalesce(t.host_email, '') = '' THEN 'skip' ELSE 'success' END AS outcome
    FROM (SELECT *, row_number() OVER (PARTITION BY acm_id ORDER BY pos) AS nth FROM m_scored) t JOIN m_copy c ON c.acm_id = t.acm_id
    LEFT JOIN (SELECT email, last_sent - {SHIFT} AS last_sent FROM e_sent_m) s ON s.email = t.host_email AND s.last_sent >= {NOW} - INTERVAL 25 DAY
    WHERE nth = 1 AND t.acm_id IN (SELECT acm_id FROM k_approved WHERE workflow = 'monthly_report')""",
    "u_region": "SELECT DISTINCT string_split(string_split(name, '/')[1], '[')[-1] AS region FROM u_acm",
    "u_ad_res": f"""
    SELECT a.id, a.name, count(DISTINCT re.id) AS res FROM u_acm a
    JOIN (SELECT DISTINCT acm_id FROM u_active) aa ON aa.acm_id = a.id
    LEFT JOIN orders r ON r.o_custkey = a.id
    LEFT JOIN u_res re ON re.room_id = r.o_orderkey AND re.status IN (7, 8)
      AND re.success_at >= {NOW} - INTERVAL 90 DAY AND re.success_at <= {NOW}
    WHERE NOT a.deleted AND NOT a.is_test GROUP BY ALL""",
    "u_base": """
    SELECT g.region, CAST(coalesce(sum(s.res), 0) AS BIGINT) AS total, CAST(count(s.id) AS BIGINT) AS n
    FROM u_region g LEFT JOIN u_ad_res s ON s.name LIKE '%' || g.region || '%' GROUP BY g.region""",
    "m_acm": """
    SELECT s_suppkey AS id, '[' || n_name || '/SUPPLIER] ' || s_name AS name, CAST(s_nationkey AS BIGINT) AS sales_id,
      s_suppkey - CASE WHEN s_suppkey % 5 = 4 THEN 1 ELSE 0 END AS owner, NULL::VARCHAR AS type_name, s_suppkey % 29 = 0 AS deleted, s_suppkey % 31 = 0 AS is_test
    FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "m_user": users("supplier", "s_suppkey", "s_name"),
    "m_res": reservations("l_suppkey * 10 + l_linenumber", "l_shipdate - to_days(3 * l_linenumber)", "l_shipdate"),
    "m_room": "SELECT DISTINCT l_suppkey * 10 + l_linenumber AS id, l_suppkey AS acm_id FROM lineitem",
    "m_host": eligible("m_acm", "m_user", True),
    "m_active": f"""
    SELECT * FROM (SELECT l_suppkey AS acm_id,
      CASE l_returnflag WHEN 'A' THEN {quoted(STARTER)} WHEN 'N' THEN {quoted(PARTNER)} ELSE {quoted(TOP)} END AS advert_name,
      CASE l_returnflag WHEN 'A' THEN 0.15 WHEN 'N' THEN 0.20 ELSE 0.30 END::DECIMAL(4,2) AS rate,
      l_shipdate AS success_at, l_shipdate + INTERVAL 730 DAY AS expiration_at
      FROM lineitem WHERE l_quantity >= 48 AND l_linenumber = 1)
    WHERE success_at <= {NOW} AND expiration_at > {NOW} AND rate >= 0.15""",
    "m_latest": """
    SELECT a.* FROM m_active a JOIN (SELECT acm_id, max(success_at) AS newest FROM m_active GROUP BY acm_id) t
      ON t.acm_id = a.acm_id AND t.newest = a.success_at""",
    "m_fanout": monthly_pair("m_res"),
    "m_month": f"""
    SELECT r.acm_id, CAST(count(*) FILTER (date_trunc('month', re.success_at) = DATE '1997-12-01') AS BIGINT) AS res_this,
      CAST(coalesce(sum({price('> 0')}) FILTER (date_trunc('month', re.success_at) = DATE '1997-12-01'), 0) AS BIGINT) AS gmv_this,
      CAST(count(*) FILTER (date_trunc('month', re.success_at) = DATE '1997-11-01') AS BIGINT) AS res_last,
      CAST(coalesce(sum({price('> 0')}) FILTER (date_trunc('month', re.success_at) = DATE '1997-11-01'), 0) AS BIGINT) AS gmv_last
    FROM m_res re JOIN m_room r ON r.id = re.room_id WHERE re.status IN (7, 8) GROUP BY r.acm_id""",
    "m_hosts": """
    SELECT h.acm_id, h.acm_name, aa.advert_name, aa.rate AS advert_commission, h.host_name, h.host_email, h.host_phone, h.region,
      coalesce(m.res_this, 0) AS res_this_month, coalesce(m.gmv_this, 0) AS gmv_this_month,
      coalesce(m.res_last, 0) AS res_last_month, coalesce(m.gmv_last, 0) AS gmv_last_month
    FROM m_host h JOIN (SELECT DISTINCT acm_id, advert_name, rate FROM m_latest) aa ON aa.acm_id = h.acm_id
    LEFT JOIN m_month m ON m.acm_id = h.acm_id""",
    "m_region": "SELECT DISTINCT string_split(string_split(name, '/')[1], '[')[-1] AS region FROM m_acm",
    "m_ad_res": """
    SELECT a.id, a.name, coalesce(m.res_this, 0) AS res, coalesce(m.gmv_this, 0) AS gmv FROM m_acm a
    JOIN (SELECT DISTINCT acm_id FROM m_latest) aa ON aa.acm_id = a.id LEFT JOIN m_month m ON m.acm_id = a.id
    WHERE NOT a.deleted AND NOT a.is_test""",
    "m_base": """
    SELECT g.region, CAST(coalesce(sum(s.res), 0) AS BIGINT) AS total, CAST(count(s.id) AS BIGINT) AS n,
      coalesce(avg(CASE WHEN s.res > 0 THEN s.gmv / s.res END), 0) AS avg_price
    FROM m_region g LEFT JOIN m_ad_res s ON s.name LIKE '%' || g.region || '%' GROUP BY g.region""",
    "m_listed": "SELECT * FROM m_hosts ORDER BY res_this_month DESC, acm_id, advert_name LIMIT 200",
    "m_scored": """
    SELECT *, CAST(row_number() OVER (ORDER BY res_this_month DESC, acm_id, advert_name) AS INT) AS pos FROM m_scored_all
    WHERE (acm_id, advert_name) IN (SELECT (acm_id, advert_name) FROM m_listed)""",
    "m_scored_all": """
    SELECT s.*, 1 AS list_no FROM (
      SELECT h.*, CASE WHEN res_this_month = 0 THEN 'zero' WHEN res_last_month = 0 THEN 'new'
          WHEN (res_this_month - res_last_month) / res_last_month >= 0.2::DOUBLE THEN 'growth'
          WHEN (res_this_month - res_last_month) / res_last_month <= -0.2::DOUBLE THEN 'poor' ELSE 'stable' END AS perf,
        CASE WHEN res_last_month = 0 THEN 0.0::DOUBLE ELSE round((res_this_month - res_last_month) / res_last_month * 100, 1) END AS change_pct,
        CASE WHEN res_this_month > 0 THEN gmv_this_month // res_this_month ELSE 0 END AS host_price_per_res,
        CAST(trunc(coalesce(b.avg_price, 0)) AS BIGINT) AS region_avg_price,
        res_this_month > 0 AND gmv_this_month > 0 AND coalesce(b.avg_price, 0) > 0
          AND gmv_this_month / greatest(res_this_month, 1) > b.avg_price * 1.3::DOUBLE AS price_high,
        coalesce(b.total, 0) AS total, coalesce(b.n, 0) AS n,
        res_this_month = 0 AND res_last_month = 0 AS consecutive_zero
      FROM m_hosts h LEFT JOIN m_base b ON b.region = h.region) s""",
    "e_shown": "SELECT user_id AS acm_id, max(ts) AS last_shown FROM events WHERE event_type = 'click' GROUP BY user_id",
    "e_sent": "SELECT u.email, s.last_shown AS last_sent FROM e_shown s JOIN u_user u ON u.id = s.acm_id WHERE u.email IS NOT NULL",
    "e_sent_m": "SELECT u.email, s.last_shown AS last_sent FROM e_shown s JOIN m_user u ON u.id = s.acm_id WHERE u.email IS NOT NULL",
    "c_raw": responses(
        "conversations", "conv_id", "json_object('subject', 'coupon ' || role || ' Package', 'body', text)", "turn % 2 = 1", ", turn"
    ),
    "c_parsed": parsed("c_raw"),
    "u_raw": responses("customer, range(3) v(made)", "c_custkey", "json_object('subject', '쿠pon ' || (9 - made) || ' ' || c_name, 'body', ' marketing push' || chr(10) || c_name || chr(10))", "made = 1", ", made"),
    "u_parsed": parsed("u_raw"),
    "u_copy": copies("u_parsed"),
    "m_raw": responses("supplier, range(3) v(made)", "s_suppkey", "json_object('subject', '쿠pon ' || (9 - made) || ' ' || s_name, 'body', ' marketing push' || chr(10) || s_name || chr(10))", "made = 1", ", made"),
    "m_parsed": parsed("m_raw"),
    "m_copy": copies("m_parsed"),
    "k_click": """
    SELECT event_id AS click_id, user_id, event_type, CAST(json_extract(props, '$.k') AS INT) AS k, date_trunc('second', ts) AS requested,
      date_trunc('second', ts) + to_seconds(5 * CAST(json_extract(props, '$.k') AS INT)) AS arrived_at FROM events""",
    "k_fresh": "SELECT * FROM k_click WHERE abs(date_diff('second', requested, arrived_at)) <= 300",
    "k_routed": """
    SELECT click_id, arrived_at, CASE event_type WHEN 'signup' THEN 'test_upsell_email' WHEN 'view' THEN 'test_monthly_report'
        WHEN 'click' THEN 'send_upsell_email' ELSE CASE user_id % 2 WHEN 0 THEN 'send_all_monthly_report' ELSE 'send_all_upsell' END END AS action_id,
      user_id || ',' || k AS acm_ids,
      CASE WHEN event_type = 'view' OR event_type = 'purchase' AND user_id % 2 = 0 THEN 'monthly_report' ELSE 'weekly_upsell' END AS workflow,
      event_type IN ('signup', 'view') AS test_mode, user_id, k
    FROM k_fresh WHERE event_type <> 'error'""",
    "k_approved": """
    SELECT DISTINCT click_id, arrived_at, workflow, test_mode, 2 AS bulk_size, unnest([user_id, CAST(k AS BIGINT)]) AS acm_id FROM k_routed""",
}


def compose(final: str) -> str:
    """Prefix ``final`` with the subqueries it uses, directly or through others, in library order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(CTES[name])

    visit(final)
    if not needed:
        return final
    order = [name for name in _sorted_names() if name in needed]
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({CTES[name]})" for name in order) + "\n" + final


def _sorted_names() -> list[str]:
    """Definition before use."""
    done: list[str] = []

    def place(name: str) -> None:
        if name in done:
            return
        for other in CTES:
            if other != name and re.search(rf"\b{other}\b", CTES[name]):
                place(other)
        done.append(name)

    for name in CTES:
        place(name)
    return done


# --- texts -----------------------------------------------------------------------------------------

NL = "chr(10)"


def _lines(*parts: str) -> str:
    return f"concat_ws({NL}, {', '.join(parts)})"


def _paragraphs(*parts: str) -> str:
    return f"concat_ws({NL} || {NL}, {', '.join(parts)})"


def _literal(text: str) -> str:
    return quoted(text) if "\n" not in text else " || chr(10) || ".join(quoted(line) for line in text.split("\n"))


def _facts(*rows: tuple) -> str:
    """``label: value`` lines of (label, value) or (label, value, condition); NULL has no line."""
    lines = []
    for label, value, *condition in rows:
        line = f"{quoted(label + ': ')} || ({value})"
        lines.append(f"CASE WHEN {condition[0]} THEN {line} END" if condition else line)
    return _lines(*lines)


def _won(amount: str) -> str:
    return f"{thousands(amount)} || ' won'"


def _booked(bookings: str, value: str) -> str:
    return f"{bookings} || ' for ' || {_won(value)}"


def _at(name: str, rate: str) -> str:
    return f"{name} || ' at ' || coalesce({percent(rate)}, 0) || '%'"


def _comma(name: str, rate: str) -> str:
    return f"coalesce({name}, '') || ', ' || coalesce({percent(rate)}, 0) || '%'"


REACH = f"concat_ws(' / ', host_email, {phone('host_phone')})"
SYMBOL = "CASE grade WHEN 'A' THEN '🔴' WHEN 'B' THEN '🟠' WHEN 'C' THEN '🟡' WHEN 'D' THEN '⚪' ELSE '' END"
PERF_SYMBOL = "CASE perf WHEN 'growth' THEN '🟢' WHEN 'stable' THEN '🟡' WHEN 'new' THEN '🔵' ELSE '🔴' END"
MONTH = "'1997년 12월'"
UPSELL_BODY = f"trim(body, {BLANK})"
CHANGE = one_decimal("change_pct")

UPSELL_CARD = _lines(
    f"concat_ws(' ', {SYMBOL}, grade, acm_name)",
    _facts(
        ("tier", _comma("advert_name", "advert_commission"), "list_no = 2"), ("booked", "res_90d"), ("neighbours", mean_text("total", "n"), "list_no = 1"),
        ("value", thousands("gmv_90d")), ("offer", _comma("rec_package", "rec_rate")), ("may add", thousands("extra_rev_90d")), ("reach", REACH),
        ("subject", "subject", "has_copy"),
    ),
    f"CASE WHEN has_copy AND {UPSELL_BODY} <> '' THEN {UPSELL_BODY} END",
)
REPORT_CARD = _lines(
    f"concat_ws(' ', {PERF_SYMBOL}, acm_name)",
    _facts(
        ("tier", _comma("advert_name", "advert_commission")), ("booked", "res_this_month"),
        ("change", f"CASE WHEN change_pct > 0 THEN '+' ELSE '' END || {CHANGE} || '%'"), ("value", thousands("gmv_this_month")),
        ("price", f"{thousands('host_price_per_res')} || ' over ' || {thousands('region_avg_price')}", "price_high"), ("reach", REACH),
        ("subject", "subject", "has_copy"),
    ),
)


def review(label: str) -> str:
    return _paragraphs(_facts((label, "acm_name"), ("to", "host_email"), ("subject", "subject")), "body")


DIRECT_CALL = f"concat_ws(' / ', acm_name, {REACH}, {_comma('advert_name', 'advert_commission')})"
NOTICE = "concat_ws(' / ', acm_name, host_email, 'from ' || coalesce(strftime(last_sent + INTERVAL 14 DAY, '%Y-%m-%d'), '알 수 없음'))"

_ANSWER = 'Answer with one JSON object whose keys are "subject" and "body", plain text only.'
BENEFITS = {STARTER: ADDS[STARTER], PARTNER: f"{ADDS[STARTER]}; {ADDS[PARTNER]}", TOP: f"{ADDS[STARTER]}; {ADDS[PARTNER]}; {ADDS[TOP]}"}
UPSELL_PROMPT = _paragraphs(
    quoted(f"Offer the host below a better place, in the name of {TEAM}."),
    _facts(
        ("stay", "acm_name"), ("host", "host_name"), ("tier now", _at("coalesce(advert_name, 'none')", "advert_commission")),
        ("booked in 90 days", _booked("res_90d", "gmv_90d")), ("neighbours that advertise", "n"), ("tier to offer", _at("rec_package", "rec_rate")),
        ("what it brings", case_map("rec_package", BENEFITS, "")), ("more to expect in 90 days", _won("extra_rev_90d")),
    ),
    quoted(f"{_ANSWER} Stay under 500 characters. Quote the bookings. Mention the neighbours that advertise, not how they do."),
)

OFFERED = "perf = 'growth' AND advert_commission IN (0.15, 0.20)"
OFFER_NAME = f"CASE advert_commission WHEN 0.15 THEN {quoted(PARTNER)} WHEN 0.20 THEN {quoted(TOP)} END"
OFFER_EXTRA = f"CASE advert_commission WHEN 0.15 THEN {quoted(ADDS[PARTNER])} WHEN 0.20 THEN {quoted(ADDS[TOP])} END"
PRICE_ADVICE = _facts(("own price per booking", _won("host_price_per_res")), ("price of neighbours that advertise", _won("region_avg_price")))
WANTS_ADVICE = "price_high AND perf IN ('poor', 'zero') AND region_avg_price > 0"
TONES = {
    "growth": "Congratulate, and say in passing that a higher tier can carry the growth on.",
    "stable": "Encourage, with one idea for the coming season.",
    "poor": "Show understanding, look for outside reasons first, then suggest better prices, pictures or texts.",
    "zero": "Be warm and plain; suggest prices, the first picture, the text and quicker answers. No word on adverts, tiers or rates.",
    "new": "Welcome to the first month; figures are still coming in; one idea for a good first impression.",
}
REPORT_PROMPT = _paragraphs(
    f"{quoted(f'Tell the host below, in the name of {TEAM}, how the month went: ')} || {MONTH}",
    _facts(
        ("stay", "acm_name"), ("host", "host_name"), ("class", "perf"), ("tier", _at("advert_name", "advert_commission"), "perf <> 'zero'"),
        ("booked in the month", _booked("res_this_month", "gmv_this_month")),
        ("against the month before", f"CASE WHEN change_pct >= 0 THEN '+' ELSE '' END || {CHANGE} || '%'"),
        ("neighbours' mean", mean_text("total", "n"), "perf <> 'zero'"), ("next tier", OFFER_NAME, OFFERED), ("which adds", OFFER_EXTRA, OFFERED),
    ),
    f"CASE WHEN {WANTS_ADVICE} THEN {PRICE_ADVICE} END",
    case_map("perf", TONES, ""),
    quoted(f"{_ANSWER} Stay under 600 characters. Quote the bookings. Suggest, do not demand."),
)

_LISTED_LINE = (
    f"concat_ws('; ', grade || ' ' || acm_name, 'booked ' || {_booked('res_90d', 'gmv_90d')} || ', neighbours ' || {mean_text('total', 'n')}, "
    f"'offer ' || {_at('rec_package', 'rec_rate')}, concat_ws(', ', host_name, host_email, {phone('host_phone')}))"
)
UPSELL_SUMMARY = _paragraphs(
    quoted("Write to the sales team about these hosts."), f"string_agg({_LISTED_LINE}, {NL} ORDER BY list_no, pos)",
    quoted("Open with the totals, mark grade A as this week's calls, give each line a reason to call, stay under 700 characters."),
)
_GROWING, _STEADY, _WEAK = (f"count(*) FILTER (perf IN ({classes}))" for classes in ("'growth'", "'stable', 'new'", "'poor', 'zero'"))
REPORT_SUMMARY = _paragraphs(
    quoted("Write to the team how the advertised stays did."),
    _facts(("month", MONTH), ("growing", _GROWING), ("steady", _STEADY), ("weak or without bookings", _WEAK), ("all", "count(*)")),
    quoted("Two or three sentences. Where bookings are few or missing, look at prices and quality."),
)
REPORT_HEADER = _facts(("growing", _GROWING), ("steady", _STEADY), ("weak or none", _WEAK), ("all", "count(*)"))
UPSELL_HEADER = _facts(("no advert", "count(*) FILTER (list_no = 1)"), ("higher tier", "count(*) FILTER (list_no = 2)"), ("all", "count(*)"))
HEADING = (
    "CASE list_no WHEN 1 THEN 'Without an advert' ELSE 'Ready for a higher tier' END || ': ' || count(*) || ', ' || "
    "least(count(*), CASE list_no WHEN 1 THEN 15 ELSE 10 END) || ' on cards'"
)

# Short templates for the rendered queries: every placeholder once, and the optional block.
UPSELL_TEMPLATE = (
    "{{host_name}}|{{acm_name}}|{{acm_id}}|{{res_90d}}|{{gmv_90d_fmt}}|{{current_pkg}}|{{#if_compare}}<b>{{avg_res}}/\n{{ad_acm_cnt}}</b>{{/if_compare}}"
    "|{{extra_rev_fmt}}|{{rec_package}}|{{rec_rate_pct}}|{{email_body}}"
)
REPORT_TEMPLATE = (
    "{{month_label}}|{{host_name}}|{{acm_name}}|{{acm_id}}|{{res_this_month}}|{{gmv_this_fmt}}|{{res_last_month}}|{{change_arrow}}|{{change_color}}"
    "|{{region_avg_res}}|{{perf_label}}|{{email_body}}|{{#if_show_pkg}}<p>\n{{pkg_name}} {{show_pkg}}</p>{{/if_show_pkg}}"
)
UPSELL_HTML = (
    f"concat_ws('|', host_name, acm_name, acm_id::VARCHAR, res_90d::VARCHAR, {thousands('gmv_90d')}, coalesce(advert_name, '미가입'), "
    f"CASE WHEN n > 0 THEN '<b>' || {mean_text('total', 'n')} || '/' || {NL} || n || '</b>' ELSE '' END, {thousands('extra_rev_90d')}, rec_package, "
    f"{percent('rec_rate')}::VARCHAR, body)"
)
PERF_LABEL = case_map("perf", {"growth": "성장 🟢", "stable": "유지 🟡", "poor": "저조 🔴", "zero": "예약 없음 🔴", "new": "첫 달 🔵"}, "—")
REPORT_HTML = (
    f"concat_ws('|', {MONTH}, host_name, acm_name, acm_id::VARCHAR, res_this_month::VARCHAR, {thousands('gmv_this_month')}, res_last_month::VARCHAR, "
    f"CASE WHEN change_pct > 0 THEN '▲ ' || {CHANGE} || '%' WHEN change_pct < 0 THEN '▼ ' || {one_decimal('abs(change_pct)')} || '%' ELSE '—' END, "
    f"CASE WHEN change_pct > 0 THEN '#1b6f4a' WHEN change_pct < 0 THEN '#a8231c' ELSE '#5f5f5f' END, {mean_text('total', 'n')}, {PERF_LABEL}, body, "
    f"CASE WHEN perf <> 'zero' THEN '<p>' || {NL} || advert_name || ' True</p>' ELSE '' END)"
)


# The mails of approved runs: each workflow's real clicks and its test clicks apart.
CTES["w_mail_test"] = CTES["w_mail_all"].replace("AND NOT test_mode", "AND test_mode")
CTES["m_mail_real"] = CTES["m_mail_all"].replace("workflow = 'monthly_report'", "workflow = 'monthly_report' AND NOT test_mode")
CTES["m_mail_test"] = CTES["m_mail_all"].replace("workflow = 'monthly_report'", "workflow = 'monthly_report' AND test_mode")
CTES["k_odd"] = """
    SELECT *, event_id % 13 AS kind, CASE
      WHEN event_id % 13 = 7 THEN 'no arrival' WHEN event_id % 13 = 6 OR k * 5 > 300 THEN 'stale' WHEN event_id % 13 = 0 THEN 'no payload'
      WHEN event_id % 13 IN (1, 8) THEN 'unreadable' WHEN event_id % 13 IN (2, 3) THEN 'no action' WHEN event_id % 13 = 4 THEN 'no ids'
      WHEN event_type = 'error' AND event_id % 13 <> 5 THEN 'unknown button' END AS reason
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)"""
