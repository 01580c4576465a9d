"""DuckDB SQL for every registered query: the same semantics written independently as SQL.

Views ``customer nation region orders lineitem events`` are expected to exist.
The CTE builders below mirror the adapters (FIXTURES.md section 2) and the job
rules; each query's SQL is ``WITH <ctes> SELECT ...``.
"""

from __future__ import annotations

AS_OF = (2018, 7, 15)
DAY1, DAY2, DAY3 = "20240101", "20240102", "20240103"
ALL_DAYS = [f"202401{d:02d}" for d in range(1, 31)]  # the calendar the fixture spans; empty days carry over

EV = """ev AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         strftime(ts, '%Y%m%d') AS dt
  FROM events)"""

BEHAVIOR = """behavior AS (
  SELECT user_id AS id,
         CASE WHEN event_id % 50 = 0 THEN '' WHEN event_id % 47 = 0 THEN NULL
              ELSE 't' || CAST(k % 20 AS VARCHAR) END AS type_id,
         CASE WHEN event_id % 61 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS prod_id,
         CASE WHEN event_id % 59 = 0 THEN NULL ELSE CAST(event_id % 9 AS VARCHAR) END AS behavior_id,
         dt
  FROM ev)"""

BW = """bw AS (
  SELECT id AS user_id, dt, type_id, prod_id, behavior_id,
         CASE WHEN behavior_id IN ('0','1','2','3','4','5','6','7') THEN 8 - CAST(behavior_id AS INTEGER)
              ELSE 0 END AS w
  FROM behavior)"""

TAGROWS = """tagrows AS (
  SELECT user_id, dt, 'be_tags' AS family,
         CASE WHEN type_id IS NULL OR type_id = '' THEN 'type_id' ELSE type_id END AS tag,
         CASE WHEN type_id IS NULL OR type_id = '' THEN 0 ELSE w END AS w
  FROM bw
  UNION ALL
  SELECT user_id, dt, 'prod_tags', 'prod_' || prod_id, w FROM bw WHERE prod_id IS NOT NULL AND prod_id <> '')"""

DAILY = """daily AS (
  SELECT user_id, dt, family, tag, CAST(SUM(w) AS DECIMAL(18,2)) AS new_w
  FROM tagrows GROUP BY user_id, dt, family, tag)"""

INTEREST_BASE = [EV, BEHAVIOR, BW, TAGROWS, DAILY]

S0 = """s0 AS (
  SELECT CAST(NULL AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS family, CAST(NULL AS VARCHAR) AS tag,
         CAST(NULL AS DECIMAL(18,2)) AS weight
  WHERE FALSE)"""


def merge_step(n: int, day: str, expire: str = "drop", decay_inactive: bool = False, decay: str = "0.75") -> list[str]:
    """CTEs d<n>, f<n>, m<n>, s<n>: state s<n> from s<n-1> and the day's aggregate."""
    p = f"s{n - 1}"
    stale = "m.old_w" if expire == "keep_stale" else "NULL"
    inactive = "FALSE" if decay_inactive else "f.active = 0"
    return [
        f"""d{n} AS (SELECT user_id, family, tag, new_w FROM daily WHERE dt = '{day}')""",
        f"""f{n} AS (
  SELECT user_id, MAX(is_day) AS active,
         MAX(CASE WHEN is_day = 0 AND family = 'be_tags' THEN 1 ELSE 0 END)
       * MAX(CASE WHEN is_day = 0 AND family = 'prod_tags' THEN 1 ELSE 0 END) AS known
  FROM (SELECT user_id, family, 0 AS is_day FROM {p} UNION ALL SELECT user_id, family, 1 FROM d{n})
  GROUP BY user_id)""",
        f"""m{n} AS (
  SELECT COALESCE(p.user_id, d.user_id) AS user_id, COALESCE(p.family, d.family) AS family,
         COALESCE(p.tag, d.tag) AS tag, p.weight AS old_w, d.new_w AS new_w,
         (COALESCE(p.weight, 0) + COALESCE(d.new_w, 0)) * {decay} AS raw
  FROM {p} p FULL OUTER JOIN d{n} d
    ON p.user_id = d.user_id AND p.family = d.family AND p.tag = d.tag)""",
        f"""s{n} AS (
  SELECT user_id, family, tag, weight FROM (
    SELECT m.user_id, m.family, m.tag,
           CAST(CASE WHEN {inactive} THEN m.old_w
                     WHEN f.known = 1 THEN CASE WHEN m.raw > 0.5 THEN ROUND(m.raw, 2) ELSE {stale} END
                     WHEN m.new_w IS NOT NULL THEN ROUND(m.new_w * {decay}, 2)
                     ELSE m.old_w END AS DECIMAL(18,2)) AS weight
    FROM m{n} m JOIN f{n} f ON m.user_id = f.user_id) x
  WHERE weight IS NOT NULL)""",
    ]


def interest_ctes(days: list[str], expire: str = "drop", decay_inactive: bool = False, decay: str = "0.75") -> list[str]:
    ctes = INTEREST_BASE + [S0]
    for i, d in enumerate(days, 1):
        ctes += merge_step(i, d, expire, decay_inactive, decay)
    return ctes


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- member and attribute rules -------------------------------------------------

MEMBER = """member AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id,
         CAST(CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN NULL ELSE 7 END AS INTEGER) AS gender,
         CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN '2001-5'
              WHEN c_custkey % 83 = 0 THEN '19'
              ELSE lpad(CAST(1940 + c_custkey % 80 AS VARCHAR), 4, '0') || '-'
                || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '-'
                || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') END AS birth,
         CAST(c_custkey % 6 AS INTEGER) AS deformity_level,
         CAST(c_custkey % 11 AS INTEGER) AS education_level,
         CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 10 = 1 THEN NULL ELSE c_mktsegment END AS position,
         CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 7 = 1 THEN NULL ELSE c_mktsegment END AS hobby,
         CAST(c_custkey % 5 AS INTEGER) AS terminal_type,
         r_name AS province, n_name AS city,
         CASE c_nationkey % 5 WHEN 0 THEN '一线城市' WHEN 1 THEN '二线城市' WHEN 2 THEN '三线城市'
              WHEN 3 THEN '四线城市' ELSE NULL END AS city_level,
         '20240101' AS dt
  FROM customer LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey) g
    ON c_nationkey = g.n_nationkey)"""


def age_expr(rule: str = "calendar") -> str:
    y, m, d = AS_OF
    before = (f"({m} < b_m OR ({m} = b_m AND {d} < b_d))" if rule == "calendar"
              else f"({m} < b_m OR ({m} = b_m AND {d} <> b_d))")
    return (f"CASE WHEN birth IS NULL OR length(birth) < 4 THEN 0 "
            f"WHEN b_y IS NULL OR b_m IS NULL OR b_d IS NULL THEN NULL "
            f"ELSE {y} - b_y - CASE WHEN {before} THEN 1 ELSE 0 END END")


AGED = """aged AS (
  SELECT *, TRY_CAST(substr(birth, 1, 4) AS INTEGER) AS b_y, TRY_CAST(substr(birth, 6, 2) AS INTEGER) AS b_m,
         TRY_CAST(substr(birth, 9, 2) AS INTEGER) AS b_d
  FROM member)"""


def band(age: str) -> str:
    return (f"CASE WHEN {age} <= 14 THEN '002001' WHEN {age} >= 15 AND {age} <= 27 THEN '002002' "
            f"WHEN {age} >= 28 AND {age} <= 34 THEN '002003' WHEN {age} >= 35 AND {age} <= 44 THEN '002004' "
            f"WHEN {age} >= 45 AND {age} <= 60 THEN '002005' WHEN {age} >= 61 THEN '002006' ELSE 'unknown' END")


def text_or_unknown(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'unknown' ELSE {c} END"


GENDER = "CASE gender WHEN 0 THEN '001001' WHEN 1 THEN '001002' ELSE 'unknown' END"
GENDER_NULL_AS_ZERO = "CASE COALESCE(gender, 0) WHEN 0 THEN '001001' WHEN 1 THEN '001002' ELSE 'unknown' END"
TERMINAL_NULL_AS_ZERO = ("CASE COALESCE(terminal_type, 0) WHEN 0 THEN '005001' WHEN 1 THEN '005002' "
                         "WHEN 2 THEN '005003' WHEN 3 THEN '005004' ELSE 'unknown' END")
DEFORMITY = ("CASE deformity_level WHEN 1 THEN '009001' WHEN 2 THEN '009002' WHEN 3 THEN '009003' "
             "WHEN 4 THEN '009004' ELSE 'unknown' END")
EDUCATION = "CASE WHEN education_level BETWEEN 1 AND 9 THEN '00300' || CAST(education_level AS VARCHAR) ELSE 'unknown' END"
TERMINAL = ("CASE terminal_type WHEN 0 THEN '005001' WHEN 1 THEN '005002' WHEN 2 THEN '005003' "
            "WHEN 3 THEN '005004' ELSE 'unknown' END")


def city_level(fallback: str = "unknown") -> str:
    return (f"CASE city_level WHEN '一线城市' THEN '007001' WHEN '二线城市' THEN '007002' "
            f"WHEN '三线城市' THEN '007003' ELSE '{fallback}' END")


BASIC = f"""basic AS (
  SELECT id AS user_id, {GENDER} AS gender, {band(age_expr())} AS age, {DEFORMITY} AS deformity_level,
         {EDUCATION} AS education_level, {text_or_unknown('position')} AS position,
         {text_or_unknown('hobby')} AS hobby, {TERMINAL} AS terminal_type,
         {text_or_unknown('province')} AS province, {text_or_unknown('city')} AS city,
         {city_level()} AS city_level
  FROM aged)"""

BASIC_ATTRS = ["gender", "age", "deformity_level", "education_level", "position", "hobby",
               "terminal_type", "province", "city", "city_level"]

BASIC_LONG = "basic_long AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT user_id, 'user_tags' AS family, '{a}' AS tag, {a} AS value FROM basic" for a in BASIC_ATTRS) + ")"

# --- slots ----------------------------------------------------------------------

BROWSE = """browse AS (
  SELECT user_id AS id,
         CASE WHEN event_id % 53 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS browse_time,
         dt
  FROM ev)"""

SROWS = """srows AS (
  SELECT user_id, dt, slot, CASE WHEN slot = 'time_tags' THEN 0 ELSE 1 END AS n FROM (
    SELECT id AS user_id, dt,
           CASE WHEN h >= 5 AND h < 8 THEN '015001' WHEN h >= 8 AND h < 11 THEN '015002'
                WHEN h >= 11 AND h < 13 THEN '015003' WHEN h >= 13 AND h < 18 THEN '015004'
                WHEN h >= 18 AND h < 24 THEN '015005' WHEN h >= 0 AND h < 5 THEN '015005'
                ELSE 'time_tags' END AS slot
    FROM (SELECT id, dt, TRY_CAST(substr(browse_time, 12, 2) AS INTEGER) AS h FROM browse) a) b)"""

SDAILY = """sdaily AS (SELECT user_id, dt, slot, CAST(SUM(n) AS BIGINT) AS n FROM srows GROUP BY user_id, dt, slot)"""

SLOT_BASE = [EV, BROWSE, SROWS, SDAILY]


def dbl_text(n: str) -> str:
    s = f"CAST({n} AS VARCHAR)"
    return (f"CASE WHEN {n} < 10000000 THEN {s} || '.0' ELSE substr({s}, 1, 1) || '.' || "
            f"COALESCE(NULLIF(rtrim(substr({s}, 2), '0'), ''), '0') || 'E' || CAST(length({s}) - 1 AS VARCHAR) END")


def summary_agg(slot: str = "slot", n: str = "n") -> str:
    return (f"'List(' || string_agg('(' || {slot} || ',' || {dbl_text(n)} || ')', ', ' "
            f"ORDER BY {n} DESC, {slot} ASC) || ')'")


SLOT_SUMMARY = """ssum AS (
  SELECT t.user_id, """ + summary_agg("t.slot", "t.n") + """ AS summary
  FROM (SELECT user_id, slot, CAST(SUM(n) AS BIGINT) AS n FROM sdaily GROUP BY user_id, slot) t
  JOIN (SELECT DISTINCT d.user_id, d.slot FROM sdaily d
        JOIN (SELECT user_id, MAX(dt) AS dt FROM sdaily GROUP BY user_id) l
          ON d.user_id = l.user_id AND d.dt = l.dt) today
    ON t.user_id = today.user_id AND t.slot = today.slot
  GROUP BY t.user_id)"""

SLOT_SUMMARY_ALL = """ssum_all AS (
  SELECT user_id, """ + summary_agg("slot", "n") + """ AS summary
  FROM (SELECT user_id, slot, CAST(SUM(n) AS BIGINT) AS n FROM sdaily GROUP BY user_id, slot) t
  GROUP BY user_id)"""

SLOT_STATE_ALL = """sstate AS (SELECT user_id, slot, CAST(SUM(n) AS BIGINT) AS n FROM sdaily GROUP BY user_id, slot)"""

# --- similarity -----------------------------------------------------------------


def similarity_ctes(ui_source: str) -> list[str]:
    """ui_source: a SELECT yielding (user_id, item)."""
    return [
        f"ui AS (SELECT DISTINCT user_id, item FROM ({ui_source}) u)",
        "freq AS (SELECT item, COUNT(*) AS n FROM ui GROUP BY item)",
        """pc AS (SELECT a.item AS i, b.item AS j, COUNT(*) AS c FROM ui a JOIN ui b
           ON a.user_id = b.user_id AND a.item < b.item GROUP BY a.item, b.item)""",
        """sc AS (SELECT pc.i, pc.j, pc.c, CAST(pc.c AS DOUBLE) / sqrt(CAST(fi.n AS DOUBLE) * CAST(fj.n AS DOUBLE)) AS score
           FROM pc JOIN freq fi ON fi.item = pc.i JOIN freq fj ON fj.item = pc.j)""",
        "sim AS (SELECT i AS item, j AS neighbour, c, score FROM sc UNION ALL SELECT j, i, c, score FROM sc)",
        """top AS (SELECT item, neighbour, c, score, rank FROM (
             SELECT item, neighbour, c, score,
                    CAST(ROW_NUMBER() OVER (PARTITION BY item ORDER BY score DESC, neighbour ASC) AS INTEGER) AS rank
             FROM sim) r WHERE rank <= 6)""",
    ]


UI_SMALL = ("SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS item FROM "
            "(SELECT user_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e "
            "WHERE k IS NOT NULL")
UI_LARGE = ("SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item "
            "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def ui_state(state: str = "s2") -> str:
    return f"SELECT user_id, substr(tag, 6) AS item FROM {state} WHERE family = 'prod_tags'"



def seed_cte(order: str = "DESC", state: str = "s2") -> str:
    return f"""seed AS (
  SELECT user_id, item, weight FROM (
    SELECT user_id, substr(tag, 6) AS item, weight,
           ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY weight {order}, substr(tag, 6) ASC) AS rn
    FROM {state} WHERE family = 'prod_tags') x
  WHERE rn = 1)"""


def push_lists_sql(order: str = "DESC", days: list[str] | None = None) -> str:
    days = days or [DAY1, DAY2]
    state = f"s{len(days)}"
    return with_(interest_ctes(days) + similarity_ctes(ui_state(state)) + [seed_cte(order, state)],
                 'SELECT s.user_id AS "MEMBER_ID", COALESCE(string_agg(t.neighbour, \',\' ORDER BY t.rank), \'\') '
                 'AS "PROD_IDS" FROM seed s LEFT JOIN top t ON t.item = s.item GROUP BY s.user_id')


def push_ctes(order: str = "DESC", run_dt: str = DAY2, days: list[str] | None = None) -> list[str]:
    days = days or [DAY1, DAY2]
    state = f"s{len(days)}"
    return interest_ctes(days) + similarity_ctes(ui_state(state)) + [seed_cte(order, state), f"""cand AS (
  SELECT s.user_id, s.item AS seed, t.neighbour, t.rank FROM seed s JOIN top t ON t.item = s.item)""",
        f"""push AS (
  SELECT md5(user_id || '|' || neighbour || '|' || '{run_dt}') AS "ID", user_id AS "MEMBER_ID",
         neighbour AS "PROD_ID", CAST(1 AS INTEGER) AS "STATUS"
  FROM cand)"""]


# --- IP ranges and JSON ---------------------------------------------------------

IP = """probe AS (
  SELECT event_id AS id, CAST((CAST(event_id AS HUGEINT) * 2654435761) % 4294967296 AS BIGINT) AS ip FROM events),
ranges AS (
  SELECT CAST(n_nationkey AS BIGINT) * 171798691 AS lo, (CAST(n_nationkey AS BIGINT) + 1) * 171798691 - 1 AS hi,
         r_name AS region, n_name AS city, 'isp' || CAST(n_regionkey AS VARCHAR) AS isp
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

NESTED = """nested AS (
  SELECT 0 AS lo, 4294967295 AS hi, 'world' AS region, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS isp
  UNION ALL SELECT MIN(lo), MAX(hi), region, NULL, NULL FROM ranges GROUP BY region
  UNION ALL SELECT lo, hi, region, city, isp FROM ranges
  UNION ALL SELECT lo + 1000001, lo + 90000077, region, city || ' centre', isp FROM ranges
  UNION ALL SELECT hi - 3000003, hi + 3000010, region, city || ' border', isp FROM ranges)"""
