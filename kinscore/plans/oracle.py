"""DuckDB statements for the registered queries, written from the definitions in SURVEY §2.12.

One relation per fact (the driver mapping of FIXTURES.md §2 applied once) and conditional
aggregates over it: every feature of a family is a ``FILTER`` of one grouped scan. The
assembled dataset is checked in long form, one row per (user, feature), because its
columns follow the data. All statements are self-contained SELECTs that can be stored as views.
"""

from __future__ import annotations

import datetime as dt

from ..config import JobConfig, OrRule, driver_config
from ..functions.text import CYRILLIC, KEEP_CLASS, LATIN, underscore_spaces
from ..sources.adapters import DRIVER_CATEGORIES
from ..sources.catalog import DRIVER_EVENT_TYPES
from .scoring_checks import (
    FIXTURE_N_REC,
    FIXTURE_SCALE,
    FIXTURE_THRESHOLDS,
    HISTORY_DAYS,
    HISTORY_TODAY,
    LIST_HISTORY_DAYS,
    LIST_N_REC,
    LIST_STEP,
    LIST_THRESHOLDS,
    ROUND_DIGITS,
)


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _among(values) -> str:
    return "(" + ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values) + ")"


def _since(column: str, last: dt.date, days: int) -> str:
    """``column`` lies in the closed window of ``days`` days up to ``last``."""
    return f"{column} BETWEEN DATE '{last - dt.timedelta(days=days)}' AND DATE '{last}'"


def slug_sql(x: str) -> str:
    letters = f"regexp_replace(lower({x}), {_text(KEEP_CLASS)}, '', 'g')"
    return f"regexp_replace(translate({letters}, {_text(CYRILLIC)}, {_text(LATIN)}), ' +', '_', 'g')"


def _rule(rule: OrRule) -> str:
    return (
        f"(coalesce(cat_id = {rule.main_cat_id}, false)"
        f" OR coalesce(cat_id = {rule.second_cat_id} AND tx = {_text(rule.second_tx_type)}, false)"
        f" OR coalesce(kind ILIKE {_text(rule.subtype_pattern)}, false))"
    )


def _relations(cfg: JobConfig) -> dict[str, str]:
    """The shared relations, each built on those before it."""
    categories = ", ".join(f"({a}, {_text(v)}, {_text(s)}, {c})" for a, v, s, c in DRIVER_CATEGORIES)
    catalog = ", ".join(f"({_text(n)}, {ord(n[0]) * 100 + len(n)})" for n in DRIVER_EVENT_TYPES)
    return {
        "category": f"SELECT * FROM (VALUES {categories}) AS c(category, vertical, slug, cat_id)",
        "person": """SELECT c_custkey AS person, c_custkey + 1000000 AS ext, bool_or(c_acctbal < -500) AS test
            FROM customer GROUP BY ALL""",
        # a line of an order with its item's and its category's columns
        "line": """SELECT o_custkey AS person, o_orderkey AS item, l_shipdate AS moment, CAST(l_shipdate AS DATE) AS day,
            l_linestatus = 'O' AS paid, p_type AS kind, concat(l_orderkey, '-', l_linenumber) AS operation,
            CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4)) AS amount, l_returnflag AS tx,
            o_orderstatus = 'F' AS dead, o_orderpriority AS attr1, nullif(o_orderpriority, '4-NOT SPECIFIED') AS attr2,
            vertical, slug, cat_id
            FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
            LEFT JOIN category ON category = CAST(left(o_orderpriority, 1) AS BIGINT)""",
        "jobs_line": f"""SELECT * FROM line
            WHERE NOT dead AND vertical = {_text(cfg.jobs_vertical)} AND slug = {_text(cfg.jobs_slug)}""",
        "active": f"""SELECT person, ext FROM person
            WHERE person NOT IN (SELECT person FROM person WHERE test)
            AND person IN (SELECT person FROM jobs_line WHERE paid AND {_since("moment", cfg.as_of, cfg.population_days)})""",
        "sighting": """SELECT o_custkey AS person, last_day(CAST(o_orderdate AS DATE)) AS day, r_name AS team
            FROM orders, customer, nation, region
            WHERE c_custkey = o_custkey AND n_nationkey = c_nationkey AND r_regionkey = n_regionkey""",
        "flag": f"""SELECT person,
            bool_or(team ILIKE {_text(cfg.team_pattern)} AND day = DATE '{cfg.as_of}') AS is_asd,
            bool_or(team ILIKE {_text(cfg.team_pattern)}) AS was_asd,
            bool_or(NOT team ILIKE {_text(cfg.team_pattern)} AND day >= DATE '{cfg.as_of}') AS asd_others
            FROM sighting WHERE person IS NOT NULL GROUP BY person""",
        "jobs_count": "SELECT person, " + ", ".join([
            "count(DISTINCT item) AS count_items_180",
            "count(DISTINCT operation) FILTER (WHERE paid) AS count_payments_180",
            *(f"count(DISTINCT operation) FILTER (WHERE paid AND kind = {_text(s)}) AS service_{i}"
              for i, s in enumerate(cfg.services)),
        ]) + f" FROM jobs_line SEMI JOIN active USING (person) WHERE {_since('moment', cfg.as_of, cfg.long_days)} GROUP BY person",
        "money": "SELECT person, " + ", ".join([
            f"sum(amount) FILTER (WHERE paid AND NOT dead AND {_since('moment', cfg.as_of, 90)}) AS all_revenue_90",
            f"sum(amount) FILTER (WHERE paid AND NOT dead AND {_since('moment', cfg.as_of, 30)}) AS all_revenue_30",
            f"sum(amount) FILTER (WHERE paid AND NOT dead AND {_since('moment', cfg.as_of, cfg.long_days)}"
            f" AND {_rule(cfg.revenue_rule)}) AS revenue_180",
            *(f"count(DISTINCT operation) FILTER (WHERE paid AND dead IS NOT TRUE AND {_since('moment', cfg.as_of, cfg.long_days)}"
              f" AND {_rule(cfg.tariff_rule)} AND kind = {_text(s)}) AS tariff_{i}" for i, s in enumerate(cfg.tariffs)),
        ]) + " FROM line SEMI JOIN active USING (person) GROUP BY person",
        "activity": f"""SELECT person,
            count(item) FILTER (WHERE started AND {_since("day", cfg.as_of, 30)}) AS activations_30,
            count(item) FILTER (WHERE started AND {_since("day", cfg.as_of - dt.timedelta(days=31), 29)}) AS activations_30_60,
            count(item) FILTER (WHERE started AND {_since("day", cfg.as_of - dt.timedelta(days=61), 29)}) AS activations_60_90,
            count(DISTINCT item) FILTER (WHERE day = DATE '{cfg.as_of}'
                AND (cat_id IS NULL OR cat_id NOT IN {_among(cfg.excluded_snapshot_cat_ids)})) AS other_vertical_items_end_date
            FROM (SELECT *, kind IN {_among(cfg.paid_activation_types)} AND cat_id = {cfg.activation_cat_id} AS started FROM line)
            SEMI JOIN active USING (person) GROUP BY person""",
        "click": f"""SELECT user_id AS person, {slug_sql("name")} || {_text(cfg.click_suffix)} AS feature, count(*) AS n
            FROM events JOIN (VALUES {catalog}) AS k(name, eid)
              ON eid = ascii(event_type) * 100 + length(event_type)
            SEMI JOIN active ON person = user_id
            WHERE {_since("CAST(ts AS DATE)", cfg.click_as_of, cfg.click_days)} GROUP BY ALL""",
    }


def _select(cfg: JobConfig, body: str, **more: str) -> str:
    parts = {**_relations(cfg), **more}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n" + body


def _numbers(relation: str, columns: dict[str, str]) -> str:
    """(person, feature, value) out of wide columns; what a user has no rows for is left out."""
    return "\nUNION ALL ".join(
        f"SELECT person, {_text(name)} AS feature, CAST({col} AS DOUBLE) AS value FROM {relation} WHERE {col} <> 0"
        for col, name in columns.items()
    )


def _services(cfg):
    return {f"service_{i}": underscore_spaces(s) for i, s in enumerate(cfg.services)}


def _tariffs(cfg):
    return {f"tariff_{i}": underscore_spaces(s) for i, s in enumerate(cfg.tariffs)}


ACTIVITY = ("activations_30", "activations_30_60", "activations_60_90")


def _attribute(cfg: JobConfig, attr: str) -> str:
    prefix = getattr(cfg, f"{attr}_prefix")
    return f"""SELECT person, {_text(prefix)} || {slug_sql(attr)} AS feature, CAST(count(*) AS DOUBLE) AS value
        FROM jobs_line SEMI JOIN active USING (person)
        WHERE paid AND {attr} <> '' AND {_since("moment", cfg.as_of, cfg.long_days)} GROUP BY ALL"""


def _one(cfg, relation, column, name=None):
    return _select(
        cfg,
        f"SELECT person AS user_id, CAST({column} AS DOUBLE) AS {name or column} FROM {relation} "
        f"WHERE {column} IS NOT NULL AND {column} <> 0",
    )


def _flag(cfg, name, restricted=False):
    semi = " SEMI JOIN active USING (person)" if restricted else ""
    return _select(cfg, f"SELECT person AS user_id, CAST(1 AS DOUBLE) AS {name} FROM flag{semi} WHERE {name}")


def _long(cfg, sql, value="cnt"):
    return _select(cfg, f"SELECT person AS user_id, feature, value AS {value} FROM ({sql})")


def dataset_relations(cfg: JobConfig) -> dict[str, str]:
    """``dataset(user_id, external_id, feature, value, click)``: every active user with every
    feature name, zero where nothing was counted. Attribute and click names come from the data."""
    flags = {n: n for n in ("is_asd", "was_asd", "asd_others")}
    wide = {
        "money": {n: n for n in ("all_revenue_90", "all_revenue_30", "revenue_180")} | _tariffs(cfg),
        "activity": {n: n for n in (*ACTIVITY, "other_vertical_items_end_date")},
        "jobs_count": {n: n for n in ("count_items_180", "count_payments_180")} | _services(cfg),
    }
    parts = [_numbers(relation, columns) for relation, columns in wide.items()]
    parts += [f"SELECT person, {_text(n)}, 1.0 FROM flag WHERE {n}" for n in flags]
    attrs = [f"SELECT * FROM ({_attribute(cfg, a)})" for a in ("attr1", "attr2")]
    clicks = "SELECT person, feature, CAST(n AS DOUBLE) FROM click"
    fixed = [n for columns in (flags, *wide.values()) for n in columns.values()]
    return {
        "counted": "\nUNION ALL ".join([*parts, *attrs, clicks]),
        "named": f"""SELECT feature, false AS click FROM (VALUES {", ".join(f"({_text(n)})" for n in fixed)}) AS t(feature)
            UNION SELECT feature, false FROM ({attrs[0]} UNION ALL {attrs[1]})
            UNION SELECT feature, true FROM click""",
        # a feature's index: its rank by family, then by its place in the dataset (fixed ones) or its name
        "ranked": f"""SELECT feature, CAST(row_number() OVER (ORDER BY family, place, feature) - 1 AS INTEGER) AS index FROM (
            SELECT 0 AS family, place, feature FROM (VALUES {", ".join(f"({i}, {_text(n)})" for i, n in enumerate(_fixed_order(cfg)))}) AS t(place, feature)
            UNION SELECT 1, 0, feature FROM ({attrs[0]}) UNION SELECT 2, 0, feature FROM ({attrs[1]})
            UNION SELECT 3, 0, feature FROM click)""",
        "dataset": """SELECT person AS user_id, ext AS external_id, feature, coalesce(value, 0) AS value, click
            FROM active CROSS JOIN named LEFT JOIN counted USING (person, feature)""",
    }


def _fixed_order(cfg: JobConfig) -> list[str]:
    head = ["all_revenue_90", "all_revenue_30", *ACTIVITY, "other_vertical_items_end_date", "revenue_180"]
    return [*head, "count_items_180", "count_payments_180", *_services(cfg).values(), *_tariffs(cfg).values()]


def _dataset(cfg, body):
    return _select(cfg, body, **dataset_relations(cfg))


LABELS = "('is_asd', 'was_asd', 'asd_others')"


def feature_oracles(cfg: JobConfig) -> dict[str, str]:
    # the label of every active user; the other flags and features do not matter here
    balance = "(SELECT coalesce(is_asd, false) AS served FROM active LEFT JOIN flag USING (person))"
    counts = f"SELECT count(*) AS n, count_if(served) AS yes, count_if(NOT served) AS no FROM {balance}"
    pivot = ", ".join(
        f"CAST(sum(n) FILTER (WHERE feature = {_text(e + cfg.click_suffix)}) AS DOUBLE) AS {e}{cfg.click_suffix}"
        for e in DRIVER_EVENT_TYPES
    )
    deviation = "coalesce(nullif(stddev_pop(value) OVER (PARTITION BY feature), 0), 1)"
    return {
        "active_population": _select(cfg, "SELECT person AS user_id, ext AS external_id FROM active"),
        "flag_managed_on_date": _flag(cfg, "is_asd"),
        "flag_managed_ever": _flag(cfg, "was_asd"),
        "flag_managed_by_others": _flag(cfg, "asd_others", restricted=True),
        "revenue_90": _one(cfg, "money", "all_revenue_90"),
        "revenue_30": _one(cfg, "money", "all_revenue_30"),
        "revenue_180_rule": _one(cfg, "money", "revenue_180"),
        "activation_buckets": _long(cfg, _numbers("activity", {n: n for n in ACTIVITY})),
        "snapshot_items_other": _one(cfg, "activity", "other_vertical_items_end_date"),
        "distinct_items_180": _one(cfg, "jobs_count", "count_items_180"),
        "distinct_payments_180": _one(cfg, "jobs_count", "count_payments_180"),
        "service_counts": _long(cfg, _numbers("jobs_count", _services(cfg))),
        "tariff_counts": _long(cfg, _numbers("money", _tariffs(cfg))),
        "attr1_counts": _long(cfg, _attribute(cfg, "attr1")),
        "attr2_counts": _long(cfg, _attribute(cfg, "attr2")),
        "slug": f"SELECT p_partkey, {slug_sql('p_name')} AS name_slug FROM part",
        "click_counts": _long(cfg, "SELECT person, feature, CAST(n AS DOUBLE) AS value FROM click"),
        "click_pivot": _select(cfg, f"SELECT person AS user_id, {pivot} FROM click GROUP BY person"),
        "feature_assembly": _dataset(cfg, "SELECT user_id, external_id, feature, value FROM dataset"),
        "sparse_features": _dataset(
            cfg, "SELECT user_id, index, feature, value FROM dataset JOIN ranked USING (feature) WHERE value <> 0"
        ),
        "sparse_log_features": _dataset(
            cfg,
            f"""SELECT user_id, index, feature, round(log10(1 + value), {ROUND_DIGITS}) AS value
            FROM dataset JOIN ranked USING (feature) WHERE value <> 0 AND value > -1""",
        ),
        "sparse_moments": _dataset(
            cfg,
            f"""SELECT index, feature, round(avg(value), {ROUND_DIGITS}) AS mean, round(stddev_pop(value), {ROUND_DIGITS}) AS std
            FROM dataset JOIN ranked USING (feature) GROUP BY index, feature""",
        ),
        "label_balance": _select(
            cfg, f"SELECT n AS dataset_length, CAST(yes AS BIGINT) AS asd, CAST(no AS BIGINT) AS non_asd FROM ({counts})"
        ),
        "run_log_comment": _select(
            cfg,
            f"""SELECT 'lookalike' AS task, 'collect_dataset' AS operation,
            concat('{{"dataset_length":', n, ',"asd":', yes, ',"non_asd":', no, '}}') AS comment FROM ({counts})""",
        ),
        "class_weights": _select(
            cfg,
            f"""SELECT CAST(served AS INTEGER) AS label, count(*) AS n,
            (sum(count(*)) OVER ()) / (2.0 * count(*))::DOUBLE AS balanced_weight,
            CASE WHEN served THEN 10.0 ELSE 1.0 END::DOUBLE AS ten_to_one_weight FROM {balance} GROUP BY served""",
        ),
        "log_features": _dataset(
            cfg,
            f"""SELECT user_id, feature, CASE WHEN feature IN {LABELS} THEN value WHEN value > -1
            THEN round(log10(1 + value), {ROUND_DIGITS}) ELSE 0 END AS value FROM dataset""",
        ),
        "standardize": _dataset(
            cfg,
            f"""SELECT user_id, feature,
            round((value - avg(value) OVER (PARTITION BY feature)) / {deviation}, {ROUND_DIGITS}) + 0.0 AS value
            FROM dataset WHERE feature NOT IN {LABELS} AND NOT click""",
        ),
        "exclude_recent": _select(
            cfg,
            f"""SELECT person AS user_id, ext AS external_id FROM active
            WHERE person NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL
                AND CAST(ts AS DATE) > DATE '{HISTORY_TODAY - dt.timedelta(days=HISTORY_DAYS)}')""",
        ),
    }


# ---------------------------------------------------------------------------------------
# scoring and selection operators (scores that both sides derive from `embeddings`)

# summed in the order of the dimensions, as in numpy
_L1 = "list_reduce([abs(x[1] - x[2]) FOR x IN list_zip(c.v, p.v)], lambda a, b: a + b)"


def _nearest(scale: float) -> dict[str, str]:
    return {
        "vec": f"SELECT vec_id, [x * CAST({scale!r} AS DOUBLE) FOR x IN CAST(embedding AS DOUBLE[])] AS v, label FROM embeddings",
        "near": f"""SELECT c.vec_id, min({_L1}) AS knn_dist FROM vec c JOIN vec p ON p.label = 0
            WHERE c.label <> 0 GROUP BY c.vec_id""",
    }


def _ranked() -> dict[str, str]:
    """``listed``: each model's best users by score; ``voted``; ``filled``: the even fill."""
    models = {"knn": "knn", "logreg": "logreg", "xgb": "xgb"}
    passing = " UNION ALL ".join(
        f"SELECT user_id, '{m}' AS model, {m}_score AS score FROM score WHERE {m}_score > {float(FIXTURE_THRESHOLDS[m])!r}"
        for m in models
    )
    place = "row_number() OVER (PARTITION BY model ORDER BY score DESC, user_id)"
    return {
        **_nearest(FIXTURE_SCALE),
        "score": """SELECT vec_id AS user_id, coalesce(1 - knn_dist, -10.0)::DOUBLE AS knn_score,
            v[1] * CAST(5 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS logreg_score,
            v[2] * CAST(5 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS xgb_score FROM vec LEFT JOIN near USING (vec_id)""",
        "passing": passing,
        "listed": f"SELECT user_id, model FROM passing QUALIFY {place} <= {FIXTURE_N_REC}",
        "voted": "SELECT user_id FROM listed GROUP BY user_id HAVING count(*) > 1",
        "filled": f"""SELECT user_id FROM passing ANTI JOIN voted USING (user_id)
            QUALIFY {place} <= (SELECT greatest(0, {FIXTURE_N_REC} - count(*)) // 3 FROM voted)""",
    }


def scoring_oracles() -> dict[str, str]:
    def select(body: str, parts: dict[str, str]) -> str:
        return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in parts.items()) + "\n" + body

    return {
        "nearest_l1": select("SELECT vec_id, knn_dist, 1 - knn_dist AS knn_score FROM near", _nearest(1.0)),
        "top_k_per_score": select("SELECT user_id, model FROM listed", _ranked()),
        "vote_two_of_three": select("SELECT user_id FROM voted", _ranked()),
        "quota_fill": select("SELECT user_id FROM voted UNION SELECT user_id FROM filled", _ranked()),
        "f1_scores": select(
            """SELECT model, CASE WHEN tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END::DOUBLE AS f1
            FROM (SELECT model, count_if(p AND y) AS tp, count_if(p AND NOT y) AS fp, count_if(NOT p AND y) AS fn
                FROM (SELECT 'logreg' AS model, logreg_score > 0.5 AS p, label = 0 AS y FROM score JOIN vec ON vec_id = user_id
                    UNION ALL SELECT 'xgb', xgb_score > 0.5, label = 0 FROM score JOIN vec ON vec_id = user_id)
                GROUP BY model)""",
            _ranked(),
        ),
    }


def list_oracle(cfg: JobConfig) -> str:
    """The 14 columns of the chosen users, from the score tables, the dataset and the history."""
    from ..operators.selection import OUTPUT_COLUMNS, OUTPUT_TYPES

    names = [c for c in OUTPUT_COLUMNS if c not in ("user_id", "external_id", "knn_score", "logreg_score", "xgb_score")]
    columns = ", ".join(f"max(value) FILTER (WHERE feature = {_text(c)}) AS {c}" for c in names)
    limits = {m: float(LIST_THRESHOLDS[m]) for m in ("knn", "logreg", "xgb")}
    above = " UNION ALL ".join(
        f"SELECT user_id, '{m}' AS model, {m}_score AS score FROM eligible WHERE {m}_score > {v!r}" for m, v in limits.items()
    )
    place = "row_number() OVER (PARTITION BY model ORDER BY score DESC, user_id)"
    kinds = {"long": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}
    out = ", ".join(f"CAST({c} AS {kinds[OUTPUT_TYPES.get(c, 'double')]}) AS {c}" for c in OUTPUT_COLUMNS)
    score = _ranked()
    parts = {
        "vec": score["vec"], "near": score["near"],
        "given": f"SELECT user_id * {LIST_STEP} + 1 AS user_id, knn_score, logreg_score, xgb_score FROM ({score['score']})",
        "merged": f"""SELECT d.*, coalesce(k.knn_score, {cfg.knn_fill!r}) AS knn_score, l.logreg_score, x.xgb_score
            FROM (SELECT user_id, external_id, {columns} FROM dataset GROUP BY user_id, external_id) d
            LEFT JOIN (FROM given WHERE user_id % 5 <> 0) k USING (user_id)
            LEFT JOIN (FROM given WHERE user_id % 7 <> 0) l USING (user_id)
            LEFT JOIN (FROM given WHERE user_id % 11 <> 0) x USING (user_id)""",
        "eligible": f"""SELECT * FROM merged WHERE asd_others = 0 AND is_asd = 0 AND user_id NOT IN (
            SELECT user_id FROM events WHERE user_id IS NOT NULL
            AND CAST(ts AS DATE) > DATE '{HISTORY_TODAY - dt.timedelta(days=LIST_HISTORY_DAYS)}')""",
        "above": above,
        "voters": f"SELECT user_id FROM (FROM above QUALIFY {place} <= {LIST_N_REC}) GROUP BY user_id HAVING count(*) > 1",
        "fill": f"""SELECT user_id FROM above ANTI JOIN voters USING (user_id)
            QUALIFY {place} <= (SELECT greatest(0, {LIST_N_REC} - count(*)) // 3 FROM voters)""",
    }
    body = f"SELECT {out} FROM eligible WHERE user_id IN (SELECT user_id FROM voters UNION SELECT user_id FROM fill)"
    return _select(cfg, body, **dataset_relations(cfg), **parts)


def tree_oracles(cfg: JobConfig) -> dict[str, str]:
    """The first second-order tree on dense bins, one level after the other."""
    from ..operators.boosting import CHECKED, LEAST_GAIN, LEVELS_PER_UNIT, TreeParams

    p = TreeParams(**{**cfg.tree_params, **CHECKED})
    score = lambda g, h: f"(greatest(abs({g}) - {p.l1!r}::DOUBLE, 0.0) * greatest(abs({g}) - {p.l1!r}::DOUBLE, 0.0) / ({h} + {p.l2!r}::DOUBLE))"
    parts = {
        "logged": """SELECT user_id, index, log10(1 + value) AS v FROM dataset JOIN ranked USING (feature)
            WHERE value <> 0 AND value > -1""",
        "lev": f"SELECT user_id, index, v > 0 AS up, CAST(floor(v * {LEVELS_PER_UNIT}) AS BIGINT) AS level FROM logged WHERE v <> 0",
        "sizes": "SELECT index, up, level, count(*) AS n FROM lev GROUP BY ALL",
        "bins": f"""SELECT index, up, level, n, CAST({p.bins} * (sum(n) OVER (PARTITION BY index ORDER BY level) - n)
            // sum(n) OVER (PARTITION BY index) AS INTEGER) + CASE WHEN up THEN 2 ELSE 0 END AS bin FROM sizes""",
        "zeros": f"""SELECT index, CAST({p.bins} * coalesce(sum(n) FILTER (WHERE NOT up), 0) // sum(n) AS INTEGER) + 1 AS zero
            FROM sizes GROUP BY index""",
        "cell": """SELECT u.user_id, z.index, coalesce(b.bin, z.zero) AS bin
            FROM (SELECT DISTINCT user_id FROM dataset) u CROSS JOIN zeros z
            LEFT JOIN (SELECT user_id, index, bin FROM lev JOIN bins USING (index, up, level)) b
            ON b.user_id = u.user_id AND b.index = z.index""",
        "s0": "SELECT user_id, 1 AS node, 0.5::DOUBLE - value AS g, 0.25::DOUBLE AS h FROM dataset WHERE feature = 'is_asd'",
    }
    root = "SELECT index, bin, count(*) AS n, sum(g) AS g, sum(h) AS h FROM cell JOIN s0 USING (user_id) GROUP BY index, bin"
    out = {"tree_root_histogram": _select(cfg, root, **dataset_relations(cfg), **parts)}
    for d in range(p.depth):
        parts[f"h{d}"] = f"""SELECT node, index, bin, sum(g) AS g, sum(h) AS h FROM cell JOIN s{d} USING (user_id)
            WHERE node >= {2**d} GROUP BY ALL"""
        parts[f"c{d}"] = f"""SELECT node, index, bin AS cut, sum(g) OVER w AS gl, sum(h) OVER w AS hl,
            sum(g) OVER a AS ga, sum(h) OVER a AS ha FROM h{d}
            WINDOW a AS (PARTITION BY node, index), w AS (PARTITION BY node, index ORDER BY bin)"""
        parts[f"b{d}"] = f"""SELECT node, index, cut, gl, hl, ga - gl AS gr, ha - hl AS hr,
            {score("gl", "hl")} + {score("(ga - gl)", "(ha - hl)")} - {score("ga", "ha")} AS gain FROM c{d}
            WHERE hl >= {p.min_hessian!r} AND ha - hl >= {p.min_hessian!r} AND gain > {LEAST_GAIN!r}
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, index, cut) = 1"""
        parts[f"s{d + 1}"] = f"""SELECT s.user_id, CASE WHEN b.node IS NULL THEN s.node
            ELSE 2 * s.node + CAST(c.bin > b.cut AS INTEGER) END AS node, s.g, s.h FROM s{d} s LEFT JOIN b{d} b USING (node)
            LEFT JOIN cell c ON c.user_id = s.user_id AND c.index = b.index"""
    body = " UNION ALL ".join(f"SELECT node, index, cut, round(gain, 6) AS gain, gl, hl, gr, hr FROM b{d}" for d in range(p.depth))
    out["tree_first_splits"] = _select(cfg, body, **dataset_relations(cfg), **parts)
    return out


def all_oracle_sql(cfg: JobConfig | None = None) -> dict[str, str]:
    cfg = cfg or driver_config()
    return {**feature_oracles(cfg), **scoring_oracles(), "list_from_scores": list_oracle(cfg), **tree_oracles(cfg)}
