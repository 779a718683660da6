"""DuckDB SQL for the customer-model views (the oracle side of sources/views.py).

Each entry is a CTE body; ``with_views(names, body)`` prepends the CTEs a query
needs (dependencies first).
"""

from __future__ import annotations

from persona_engine.functions import fixed


def _q(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def sql_list(vals) -> str:
    return ", ".join(_q(v) for v in vals)


LV = fixed.ACTIVENESS_LEVELS
BASE_FEATURES = list(fixed.FEATURE_COLS) + ["usr_gndr_enc", "is_active"]

VIEW_SQL: dict[str, tuple[list[str], str]] = {
    "bounds": ([], """SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi,
        CAST(date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) AS DOUBLE) AS span
        FROM orders"""),
    "last_order": ([], """SELECT o_custkey AS cust_id, max(CAST(o_orderdate AS DATE)) AS last_order_date
        FROM orders GROUP BY o_custkey"""),
    "demo": (["bounds", "last_order"], f"""SELECT c.c_custkey AS cust_id, n.n_name AS usr_cnty_name,
        r.r_name AS usr_cnty_ap2,
        CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS usr_gndr,
        CAST(18 + c.c_custkey % 58 AS BIGINT) AS usr_age,
        CASE WHEN date_diff('day', lo.last_order_date, b.hi) <= 30 THEN {_q(LV[0])}
             WHEN date_diff('day', lo.last_order_date, b.hi) <= 90 THEN {_q(LV[1])}
             WHEN date_diff('day', lo.last_order_date, b.hi) <= 180 THEN {_q(LV[2])}
             WHEN date_diff('day', lo.last_order_date, b.hi) <= 365 THEN {_q(LV[3])}
             ELSE {_q(LV[4])} END AS sa_activeness
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey
        LEFT JOIN last_order lo ON c.c_custkey = lo.cust_id CROSS JOIN bounds b"""),
    "lines": ([], f"""SELECT o.o_custkey AS cust_id, o.o_orderkey AS order_id,
        CAST(o.o_orderdate AS DATE) AS order_date, CAST(l.l_linenumber AS BIGINT) AS line_no,
        l.l_partkey AS part_id, p.p_type AS category, p.p_brand AS brand, p.p_name AS product_name,
        CAST(p.p_type IN ({sql_list(fixed.PREMIUM_PTYPES)}) AS BIGINT) AS premium_flg,
        l.l_quantity AS quantity, l.l_extendedprice AS price_base,
        l.l_extendedprice * l.l_discount AS price_discount,
        CAST(round(l.l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l.l_discount * 100) AS BIGINT)) AS net_units,
        CAST(round(l.l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l.l_discount * 100) AS BIGINT)) / 10000.0 AS net_amount,
        l.l_extendedprice * l.l_tax AS tax_amount, l.l_tax AS tax_rate, l.l_discount AS l_discount_rate,
        l.l_returnflag AS return_flag, l.l_linestatus AS line_status,
        o.o_orderstatus AS order_status, o.o_orderpriority AS order_priority
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
        JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "ord": (["lines"], """SELECT order_id, cust_id, order_date, order_status, order_priority,
        CAST(sum(net_units) AS BIGINT) AS order_units, max(premium_flg) AS has_premium, count(*) AS n_lines,
        max(CAST(return_flag = 'R' AS BIGINT)) AS any_return
        FROM lines GROUP BY order_id, cust_id, order_date, order_status, order_priority"""),
    "clv": (["ord", "bounds"], """SELECT cust_id, count(*) AS pchs_cnt,
        CAST(sum(has_premium) AS BIGINT) AS premium_cnt, CAST(sum(n_lines) AS BIGINT) AS prod_cnt,
        CAST(sum(order_units) AS BIGINT) / 10000.0 AS ltv_r, avg(order_units) / 10000.0 AS val_p,
        min(order_date) AS first_reg_dt, max(order_date) AS last_reg_dt,
        CAST(count(*) > 1 AS BIGINT) AS cum_repchs_flg,
        max(CAST(order_priority = '1-URGENT' AS BIGINT)) AS samsunghealth_flag,
        max(CAST(order_status = 'F' AS BIGINT)) AS samsungwallet_flag,
        max(any_return) AS smartthings_flag,
        round_even(least(greatest(CAST(1.0 AS DOUBLE) - CAST(date_diff('day', max(order_date), (SELECT hi FROM bounds)) AS DOUBLE)
            / (SELECT span FROM bounds), 0.0), 1.0), 3) AS retention_score
        FROM ord GROUP BY cust_id"""),
    "daily": ([], f"""SELECT user_id AS cust_id, CAST(ts AS DATE) AS usage_date,
        CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total,
        CAST(sum(CASE WHEN event_type = {_q(fixed.GAME_EVENT)} THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS game,
        CAST(sum(CASE WHEN event_type = {_q(fixed.SOCIAL_EVENT)} THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS social,
        CAST(sum(CASE WHEN event_type = {_q(fixed.BRAND_EVENT)} THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS brand
        FROM events GROUP BY user_id, CAST(ts AS DATE)"""),
    "app": (["daily"], """SELECT cust_id,
        CAST(sum(game) AS DOUBLE) / nullif(CAST(sum(total) AS DOUBLE), 0) AS app_game_ratio,
        CAST(sum(social) AS DOUBLE) / nullif(CAST(sum(total) AS DOUBLE), 0) AS app_social_ratio,
        CAST(sum(brand) AS DOUBLE) / nullif(CAST(sum(total) AS DOUBLE), 0) AS app_samsung_ratio,
        round_even(CAST(sum(total) AS DOUBLE) / count(*) / 100.0, 6) AS avg_daily_usage_min,
        count(*) AS active_days
        FROM daily GROUP BY cust_id"""),
    "customers": (["demo", "clv", "app"], """SELECT d.*, c.pchs_cnt, c.premium_cnt, c.ltv_r, c.val_p,
        c.cum_repchs_flg, c.samsunghealth_flag, c.samsungwallet_flag, c.smartthings_flag, c.retention_score,
        a.app_game_ratio, a.app_social_ratio, a.app_samsung_ratio, a.avg_daily_usage_min
        FROM demo d LEFT JOIN clv c ON d.cust_id = c.cust_id LEFT JOIN app a ON d.cust_id = a.cust_id"""),
    "enc": (["customers"], """SELECT *, coalesce(CAST(usr_gndr = 'M' AS BIGINT), 0) AS usr_gndr_enc,
        coalesce(CAST(starts_with(sa_activeness, 'Active') AS BIGINT), 0) AS is_active FROM customers"""),
    "regions": (["enc"], """SELECT DISTINCT usr_cnty_ap2 AS v FROM enc WHERE usr_cnty_ap2 IS NOT NULL"""),
    "raw_long": (["enc", "regions"], f"""SELECT cust_id, unnest([{sql_list(BASE_FEATURES)}]) AS feature,
        unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in BASE_FEATURES)}]) AS value FROM enc
        UNION ALL
        SELECT e.cust_id, 'region_' || r.v AS feature,
               CASE WHEN e.usr_cnty_ap2 = r.v THEN 1.0 ELSE 0.0 END::DOUBLE AS value
        FROM enc e CROSS JOIN regions r"""),
    "med": (["raw_long"], "SELECT feature, median(value) AS med FROM raw_long GROUP BY feature"),
    "imp": (["raw_long", "med"], """SELECT r.cust_id, r.feature, coalesce(r.value, m.med) AS value
        FROM raw_long r JOIN med m ON r.feature = m.feature"""),
    "mom": (["imp"], "SELECT feature, avg(value) AS mu, stddev_pop(value) AS sd FROM imp GROUP BY feature"),
    "z": (["imp", "mom"], """SELECT i.cust_id, i.feature,
        CASE WHEN i.value IS NULL THEN NULL WHEN mo.sd IS NULL OR mo.sd = 0 THEN 0.0
             ELSE (i.value - mo.mu) / mo.sd END AS value
        FROM imp i JOIN mom mo ON i.feature = mo.feature"""),
    "interests": (["lines"], """SELECT cb.cust_id, cb.interest, cb.spend / t.total AS interest_score
        FROM (SELECT cust_id, brand AS interest, CAST(sum(net_units) AS DOUBLE) AS spend FROM lines GROUP BY cust_id, brand) cb
        JOIN (SELECT cust_id, CAST(sum(net_units) AS DOUBLE) AS total FROM lines GROUP BY cust_id) t ON cb.cust_id = t.cust_id"""),
    "rewards": ([], """SELECT o_custkey AS cust_id, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS point_acc_amt,
        CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END) AS BIGINT) AS rdm,
        CAST(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END) // 20 AS BIGINT) AS point_exp_amt
        FROM orders GROUP BY o_custkey"""),
}


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in VIEW_SQL[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prepend the view CTEs (and extra (name, sql) CTEs, in order) to a query body."""
    ctes = [f"{n} AS ({VIEW_SQL[n][1]})" for n in _order(names)]
    ctes += [f"{n} AS ({s})" for n, s in (extra or [])]
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body if ctes else body


def kmeans_ctes(k: int = 7, seed: int = 42, n_init: int = 10, max_iter: int = 300, points: str | None = None,
                id_col: str = "cust_id", p: str = "") -> list[tuple[str, str]]:
    """Seeded Lloyd restarts to convergence as a recursive CTE (oracle of segment.lloyd_kmeans).

    ``points``: a query of (id, v list), by default the standardised features; ``p`` prefixes the names.
    """
    pt = points or "SELECT cust_id, list(value ORDER BY feature) AS v FROM z GROUP BY cust_id"
    return [
        (f"{p}pt", pt),
        (f"{p}kk", f"""SELECT CASE WHEN least({k}, n) = n THEN greatest(2, n - 1) ELSE least({k}, n) END AS k
            FROM (SELECT count(*) AS n FROM {p}pt)"""),
        (f"{p}seeds", f"""SELECT r, cid, v FROM (SELECT r, v, row_number() OVER (PARTITION BY r
                ORDER BY md5('{seed}:init:' || CAST(r AS VARCHAR) || ':' || CAST({id_col} AS VARCHAR))) - 1 AS cid
            FROM {p}pt, range({max(n_init, 1)}) t(r)) WHERE cid < (SELECT k FROM {p}kk)"""),
        (f"{p}lloyd(it, r, cid, v, moved)", f"""SELECT 0, r, cid, v, true FROM {p}seeds
            UNION ALL (
            WITH a AS (SELECT l.it, l.r, p.{id_col} AS id, arg_min(l.cid, (list_distance(p.v, l.v), l.cid)) AS cid
                       FROM {p}lloyd l, {p}pt p WHERE l.moved AND l.it < {max_iter} GROUP BY l.it, l.r, p.{id_col}),
                 m AS (SELECT it, r, cid, d, avg(x) AS x FROM (
                         SELECT a.it, a.r, a.cid, unnest(p.v) AS x, unnest(range(len(p.v))) AS d FROM a JOIN {p}pt p ON a.id = p.{id_col})
                       GROUP BY ALL),
                 n AS (SELECT it, r, cid, list(x ORDER BY d) AS v FROM m GROUP BY it, r, cid),
                 f AS (SELECT n.r, max(CASE WHEN o.v IS NULL OR list_distance(n.v, o.v) > 1e-9 THEN 1 ELSE 0 END) = 1 AS moved
                       FROM n LEFT JOIN {p}lloyd o ON o.r = n.r AND o.cid = n.cid GROUP BY n.r)
            SELECT n.it + 1, n.r, n.cid, n.v, f.moved FROM n JOIN f ON n.r = f.r)"""),
        (f"{p}cents", f"SELECT r, cid, v FROM {p}lloyd QUALIFY it = max(it) OVER (PARTITION BY r)" if n_init else
         f"SELECT r, cid, v FROM {p}seeds"),
        (f"{p}near", f"""SELECT r, {id_col}, cid, d FROM (SELECT c.r, p.{id_col}, c.cid, list_distance(p.v, c.v) ** 2 AS d
            FROM {p}cents c, {p}pt p) QUALIFY row_number() OVER (PARTITION BY r, {id_col} ORDER BY d, cid) = 1"""),
        (f"{p}cost", f"SELECT r, sum(d) AS cost FROM {p}near GROUP BY r ORDER BY round(sum(d), 6), r LIMIT 1"),
        (f"{p}assigned", f"""SELECT n.{id_col}, n.cid AS persona_cluster, n.d AS sq_dist FROM {p}near n
            WHERE n.r = (SELECT r FROM {p}cost)"""),
    ]


def projection_ctes(points: str = "SELECT cust_id, list(coalesce(value, 0.0) ORDER BY feature) AS v FROM z GROUP BY cust_id",
                    id_col: str = "cust_id", squarings: int = 40) -> list[tuple[str, str]]:
    """proj (id, x, y): coordinates along the first two principal axes (oracle of segment.pca_projection).

    An axis is the covariance matrix squared and rescaled again and again: what is left is
    the outer product of the first eigenvector with itself. The second comes from the
    matrix without the first's share.
    """
    def power(name: str, start: str) -> tuple[str, str]:
        square = "list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c)))"
        trace = "list_sum(list_transform(range(1, len(q) + 1), lambda i: q[i][i]))"
        return (f"{name}(it, m)", f"""SELECT 0, m FROM {start} UNION ALL
            SELECT it + 1, list_transform(q, lambda r: list_transform(r, lambda x: x / t))
            FROM (SELECT it, q, {trace} AS t FROM (SELECT it, {square} AS q FROM {name} WHERE it < {squarings}))""")

    def axis(name: str, powers: str) -> tuple[str, str]:
        lead = "list_position(list_transform(u, lambda x: abs(x)), list_max(list_transform(u, lambda x: abs(x))))"
        return (name, f"""SELECT list_transform(u, lambda x: x * sign(u[{lead}]) / sqrt(list_dot_product(u, u))) AS v FROM (
            SELECT m[list_position(d, list_max(d))] AS u FROM (
              SELECT m, list_transform(range(1, len(m) + 1), lambda i: m[i][i]) AS d FROM {powers} WHERE it = {squarings}))""")

    return [
        ("ppt", points),
        ("pmean", "SELECT i, avg(x) AS mu FROM (SELECT unnest(v) AS x, unnest(range(len(v))) AS i FROM ppt) GROUP BY i"),
        ("pcen", f"""SELECT {id_col}, p.i, p.x - m.mu AS x FROM (SELECT {id_col}, unnest(v) AS x, unnest(range(len(v))) AS i FROM ppt) p
            JOIN pmean m ON p.i = m.i"""),
        ("pcov", f"""SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM (
            SELECT a.i, b.i AS j, sum(a.x * b.x) / (SELECT count(*) - 1 FROM ppt) AS c FROM pcen a JOIN pcen b ON a.{id_col} = b.{id_col}
            GROUP BY a.i, b.i) GROUP BY i)"""),
        power("ppow1", "pcov"), axis("pax1", "ppow1"),
        ("pcov2", """SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - l * v[i] * v[j])) AS m FROM (
            SELECT m, v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS l FROM pcov, pax1)"""),
        power("ppow2", "pcov2"), axis("pax2", "ppow2"),
        ("proj", f"SELECT {id_col}, list_dot_product(p.v, a.v) AS x, list_dot_product(p.v, b.v) AS y FROM ppt p, pax1 a, pax2 b"),
    ]


LAB_CTE = ("lab", "SELECT e.*, a.persona_cluster, a.sq_dist FROM enc e JOIN assigned a ON e.cust_id = a.cust_id")


def py_float_sql(x: str) -> str:
    """SQL twin of expr.py_float_text."""
    fixed6 = f"regexp_replace(printf('%.6f', {x}), '0+$', '')"
    return (f"(CASE WHEN abs({x}) >= 1e7 THEN (CASE WHEN {fixed6} LIKE '%.' THEN {fixed6} || '0' ELSE {fixed6} END)"
            f" ELSE CAST({x} AS VARCHAR) END)")


def half_even_sql(x: str, d: int) -> str:
    """SQL twin of expr.half_even_div."""
    r = f"((({x}) % {d} + {d}) % {d})"
    q = f"((({x}) - {r}) // {d})"
    return (f"({q} + CASE WHEN {r} * 2 > {d} THEN 1 WHEN {r} * 2 = {d} AND ({q} % 2 + 2) % 2 = 1 THEN 1 ELSE 0 END)")


def render_sql(template: str, **fields) -> str:
    """SQL twin of expr.render: literal pieces (newlines as chr(10)) || field expressions."""
    from persona_engine.functions.expr import template_parts
    out = []
    for p in template_parts(template):
        if isinstance(p, tuple):
            out.append(f"CAST(({fields[p[0]]}) AS VARCHAR)")
        else:
            pieces = p.split("\n")
            segs = []
            for i, piece in enumerate(pieces):
                if piece:
                    segs.append(_q(piece))
                if i < len(pieces) - 1:
                    segs.append("chr(10)")
            out.extend(segs)
    return "(" + " || ".join(out or ["''"]) + ")"
