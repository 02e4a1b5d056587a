"""The catalogue's queries as plain SQL over the same tables, for an independent check."""

from __future__ import annotations

from riskloom.plans.catalog import CARD_A, CARD_B, CUSTOMER_DEFINITIONS, YEARS
from riskloom.sources.cohorts import CUSTOMERS, CUTOFF, DOCUMENTS, LINES


# Fixed value: the base rate in percent that deltas are taken from.
_BASE = 30.0


def half(x: str, n: int = 0) -> str:
    """Half-even rounding on the scaled value."""
    return f"round_even(({x})::DOUBLE, 0)::DOUBLE" if n == 0 else f"(round_even(({x})::DOUBLE*1e{n}, 0)::DOUBLE/1e{n})"


def rnd(x: str, n: int) -> str:
    return f"(round(({x})::DOUBLE, {n}) + 0e0)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def union(parts) -> str:
    return " UNION ALL ".join(parts)


# --- cohorts ---------------------------------------------------------------------------------

def _gap(c: str, x: str) -> str:
    return f"CASE WHEN md5(c_custkey || ':{c}:gap') >= '08' THEN {x} END AS {c}"


_HIST = f"""hist AS (
  SELECT o_custkey, count(*) FILTER (o_orderdate < TIMESTAMP '{CUTOFF}') AS ob,
    sum(o_totalprice) FILTER (o_orderdate < TIMESTAMP '{CUTOFF}') AS pb,
    max(o_orderdate) FILTER (o_orderdate < TIMESTAMP '{CUTOFF}') AS last_order,
    count(*) FILTER (o_orderdate >= TIMESTAMP '{CUTOFF}') AS oa
  FROM orders GROUP BY 1)"""
_VALUES = {
    "region": "r_name", "c_acctbal": "c_acctbal", "n_orders": "coalesce(ob, 0)::DOUBLE",
    "avg_price": "CASE WHEN ob > 0 THEN " + half("pb/ob", 2) + " END",
    "recency_days": f"date_diff('day', last_order::DATE, DATE '{CUTOFF}')::DOUBLE",
}


def _raw(shown) -> str:
    return f"""{_HIST},
  raw AS (SELECT c_custkey, c_name, c_mktsegment, {', '.join(shown(c, x) for c, x in _VALUES.items())},
    (coalesce(oa, 0) = 0)::INT AS churned
  FROM customer LEFT JOIN hist ON c_custkey = o_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""


# The customers as they are, and with the gaps that the cleaning queries make.
WHOLE = _raw(lambda c, x: f"{x} AS {c}")
CUST = _raw(_gap)

LINE = """line AS (
  SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus,
    year(l_shipdate)::VARCHAR AS ship_year, (l_returnflag = 'R')::INT AS returned FROM lineitem)"""

_SIZES = """doc_id, lang, source, n_chars::DOUBLE AS n_chars,
    (length(text) - length(replace(text, ' ', '')) + 1)::DOUBLE AS n_words,
    (length(text) - length(replace(text, chr(10), '')) + 1)::DOUBLE AS n_lines"""
SIZES = f"docs AS (SELECT {_SIZES} FROM documents)"
DOCS = f"docs AS (SELECT {_SIZES}, (1 - quality)::INT AS poor FROM documents JOIN labels USING (doc_id))"


def _mode(c: str, t: str) -> str:
    return f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


def _modes_of(t: str, *columns: str) -> str:
    """Most frequent value of each column as text, with its rows."""
    return union(f"""SELECT * FROM (SELECT '{c}' AS "column", count(*) AS n, {c}::VARCHAR AS value FROM {t}
  WHERE {c} IS NOT NULL GROUP BY 3 ORDER BY n DESC, value LIMIT 1)""" for c in columns)


_fill = {c: f"coalesce({c}, (SELECT median({c}) FROM raw))" for c in CUSTOMERS.numeric}
_fill |= {c: f"coalesce({c}, {_mode(c, 'raw')})" for c in CUSTOMERS.categorical}
_cust_cols = ["c_custkey", "c_name", "c_mktsegment", "region", "c_acctbal", "n_orders", "avg_price",
              "recency_days", "churned"]
IMPUTED = "imp AS (SELECT DISTINCT " + ", ".join(
    f"{_fill[c]} AS {c}" if c in _fill else c for c in _cust_cols) + " FROM raw)"


def _limits(t: str, cols, by: str = "") -> str:
    """One row per (by, column)."""
    b, g = (f"{by}, ", f"WHERE {by} IS NOT NULL GROUP BY {by}") if by else ("", "")
    parts = [
        f"SELECT {b}'{c}' AS \"column\", count({c}) AS n, quantile_cont({c}, 0.25) AS q1, "
        f"quantile_cont({c}, 0.75) AS q3 FROM {t} {g}" for c in cols
    ]
    return (f"SELECT *, q3 - q1 AS iqr, q1 - 1.5e0 * (q3 - q1) AS lower, q3 + 1.5e0 * (q3 - q1) AS upper "
            f"FROM ({union(parts)})")


LIMITS = f"lim AS ({_limits('imp', CUSTOMERS.outlier)})"


def _lim(c: str, side: str) -> str:
    return f"(SELECT {side} FROM lim WHERE \"column\" = '{c}')"


def _wins(c: str) -> str:
    return (f"CASE WHEN {c} < {_lim(c, 'lower')} THEN {_lim(c, 'lower')} "
            f"WHEN {c} > {_lim(c, 'upper')} THEN {_lim(c, 'upper')} ELSE {c} END")


WINS = "wins AS (SELECT " + ", ".join(
    f"{_wins(c)} AS {c}" if c in CUSTOMERS.outlier else c for c in _cust_cols) + " FROM imp)"
CLEAN = "clean AS (SELECT " + ", ".join(
    f"{half(c)}::INT AS {c}" if c in CUSTOMERS.integer
    else f"{half(c, CUSTOMERS.decimals[c])} AS {c}" if c in CUSTOMERS.decimals else c for c in _cust_cols
) + " FROM wins)"
TO_CLEAN = (CUST, IMPUTED, LIMITS, WINS, CLEAN)


def _split(t: str, key: str, target: str) -> tuple[str, str, str]:
    """Counts per class, rows per class by largest remainder, and the marked rows."""
    return (
        f"cls AS (SELECT {target} AS s, count(*)::HUGEINT AS n FROM {t} GROUP BY 1)",
        f"""alloc AS (
  SELECT s, n, CASE WHEN row_number() OVER (ORDER BY rem DESC, s) <= train - sum(base) OVER () THEN n - base - 1
    ELSE n - base END AS k
  FROM (SELECT s, n, train, (n * train) // total AS base, (n * train) % total AS rem
    FROM (SELECT s, n, sum(n) OVER () AS total,
      (sum(n) OVER ())::HUGEINT - ceil((sum(n) OVER ())::DOUBLE * 2e-1)::HUGEINT AS train FROM cls)))""",
        f"""marked AS (
  SELECT *, row_number() OVER (PARTITION BY {target} ORDER BY md5({key} || ':42'), {key})
    <= (SELECT k FROM alloc WHERE s = {target}) AS is_test FROM {t})""",
    )


def _nulls(c: str, t: str = "raw") -> str:
    return f"(SELECT count(*) - count({c}) FROM {t})"


def _softsign(z: str) -> str:
    return f"(5e-1 + 5e-1 * ({z}) / (1e0 + abs({z})))"


def _cards(t: str, label: str, cards: dict[str, str]) -> str:
    parts = [f"SELECT '{n}' AS model, {label} AS label, {_softsign(z)} AS score FROM {t}" for n, z in cards.items()]
    return f"scored AS (SELECT *, (score >= 5e-1)::INT AS prediction FROM ({union(parts)}))"


_cust_z = "(9e0 - coalesce(n_orders, 0e0)) / 3e0"
CUST_SCORED = (WHOLE, _cards("raw", "churned", {
    CARD_A: _cust_z, CARD_B: "(coalesce(recency_days, 300e0) - 250e0) / 200e0"}))
LINE_SCORED = (LINE, _cards("line", "returned", {
    CARD_A: "(l_quantity - 25e0) / 10e0 + (l_discount - 5e-2) * 20e0",
    CARD_B: "(l_extendedprice - 52000e0) / 25000e0 - (l_tax - 4e-2) * 10e0"}))

CONF = """conf AS (SELECT model,
  count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp
  FROM scored GROUP BY 1)"""
AUC = """auc AS (
  SELECT model, (sum(r) FILTER (label = 1) - p * (p + 1) / 2e0) / (p::DOUBLE * n) AS auc FROM (
    SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
        + (count(*) OVER (PARTITION BY model, score) - 1) / 2e0 AS r,
      sum(label) OVER (PARTITION BY model) AS p, sum(1 - label) OVER (PARTITION BY model) AS n FROM scored)
  GROUP BY model, p, n)"""


def _div(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif(({b})::DOUBLE, 0e0), 0e0)"


MEASURED = "measured AS (" + union(
    f"SELECT model, '{m}' AS metric, {half(x, 4)} AS value FROM conf JOIN auc USING (model)" for m, x in (
        ("Acurácia", _div("tn + tp", "tn + fp + fn + tp")), ("Precisão", _div("tp", "tp + fp")),
        ("Recall", _div("tp", "tp + fn")), ("F1-Score", _div("2 * tp", "2 * tp + fp + fn")), ("ROC-AUC", "auc"),
    )) + ")"
CURVE = """pts AS (SELECT model, score, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM scored GROUP BY 1, 2),
cum AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, lead(pos) OVER w AS np, lead(neg) OVER w AS nn,
    row_number() OVER w AS place, sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
  FROM pts WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""


def _roc(where: str) -> str:
    return (f"SELECT model, {rnd('score', 9)} AS threshold, {rnd('cn::DOUBLE / n', 9)} AS fpr, "
            f"{rnd('cp::DOUBLE / p', 9)} AS tpr FROM cum {where} UNION ALL "
            "SELECT DISTINCT model, 'inf'::DOUBLE, 0e0, 0e0 FROM scored")


def _kpi(t: str, target: str, means: dict, by: str = "") -> str:
    rate = half(_div(f"sum({target}) * 100", "count(*)"), 1)
    cols = [f"count(*) AS total", f"coalesce(sum({target}), 0)::BIGINT AS positives", f"{rate} AS rate"]
    cols += [f"{half(f'avg({c})', d)} AS mean_{c}" for c, d in means.items()]
    return ", ".join(cols)


def _rate(t: str, by: str, target: str) -> str:
    return (f"SELECT {by}, count(*) AS n, sum({target})::BIGINT AS positives, "
            f"{half(f'sum({target}) * 100e0 / count(*)', 1)} AS rate FROM {t} WHERE {by} IS NOT NULL GROUP BY 1")


def _share(t: str, by: str) -> str:
    return (f"SELECT {by}, count(*) AS n, {half('count(*) * 100e0 / sum(count(*)) OVER ()', 1)} AS pct "
            f"FROM {t} WHERE {by} IS NOT NULL GROUP BY 1")


def _corr(a: str, b: str, t: str) -> str:
    return f"(SELECT corr({a}, {b}) FROM {t})"


def _box(t: str, cols, by: str) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT {by}, '{c}' AS "column", n, {rnd('q1', 4)} AS q1, {rnd('q2', 4)} AS median,
  {rnd('q3', 4)} AS q3, {rnd('min(x) FILTER (ok)', 4)} AS low_whisker, {rnd('max(x) FILTER (ok)', 4)} AS high_whisker,
  count(*) FILTER (NOT ok) AS outliers
FROM (SELECT {by}, n, q1, q2, q3, x, x BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1) AS ok FROM
  (SELECT {by}, {c} AS x FROM {t} WHERE {c} IS NOT NULL) JOIN
  (SELECT {by}, count({c}) AS n, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2,
    quantile_cont({c}, 0.75) AS q3 FROM {t} GROUP BY 1) USING ({by})) GROUP BY {by}, n, q1, q2, q3""")
    return union(parts)


def _bin(x: str, lo: str, hi: str, bins: int) -> str:
    return f"least(greatest(floor(({x} - {lo}) / ({hi} - {lo}) * {bins})::INT + 1, 1), {bins})"


def _hist(t: str, c: str, bins: int, digits: int) -> str:
    return f"""SELECT b.bin::INT AS bin, {rnd(f'lo + (b.bin - 1) * ((hi - lo) / {bins})', digits)} AS low,
  {rnd(f'lo + b.bin * ((hi - lo) / {bins})', digits)} AS high, coalesce(n, 0) AS n
FROM (SELECT unnest(range(1, {bins + 1})) AS bin) b
  CROSS JOIN (SELECT min({c}) AS lo, max({c}) AS hi FROM {t})
  LEFT JOIN (SELECT {_bin(c, 'lo', 'hi', bins)} AS bin, count(*) AS n
    FROM {t}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {t}) WHERE {c} IS NOT NULL GROUP BY 1) k ON b.bin = k.bin"""


def _band(p: str) -> str:
    return f"CASE WHEN {p} IS NULL THEN NULL WHEN {p} >= 60 THEN 'alto' WHEN {p} >= 35 THEN 'medio' ELSE 'baixo' END"


def _z(c: str) -> str:
    return f"({c} - avg({c}) FILTER (NOT is_test) OVER ()) / stddev_pop({c}) FILTER (NOT is_test) OVER ()"


# The factor rules of the customers, as (condition, code, level) per rule.
_rules = [
    ("CASE WHEN c_acctbal < 0 THEN 'balance_negative' WHEN c_acctbal < 1000 THEN 'balance_low' END"),
    ("CASE WHEN recency_days > 365 THEN 'long_silent' WHEN recency_days > 180 THEN 'silent' END"),
    ("CASE WHEN n_orders >= 15 THEN 'very_busy' WHEN n_orders >= 12 THEN 'busy' END"),
    ("CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'household' WHEN c_mktsegment = 'BUILDING' THEN 'building' END"),
]
_red = "('balance_negative', 'long_silent', 'very_busy', 'household')"
RISK = f"""risk AS (SELECT *, {_softsign(_cust_z)} * 100e0 AS prob,
  list_filter([{', '.join(_rules)}], lambda f: f IS NOT NULL) AS codes FROM raw)"""

ORDER_SCORE = f"""SELECT o_orderkey, {rnd('prob', 6)} AS prob, {_band('prob')} AS band,
  {rnd(f'prob - {_BASE}', 6)} AS delta, concat_ws('|',
    CASE WHEN o_totalprice > 400000 THEN 'very_large' WHEN o_totalprice > 250000 THEN 'large' END,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END) AS codes
FROM (SELECT *, {_softsign('(o_totalprice - 300000e0) / 100000e0')} * 100e0 AS prob FROM orders)"""


def _chosen(c: str) -> str:
    return (f"CASE WHEN row_number() OVER (ORDER BY md5(o_orderkey || ':{c}:42'), o_orderkey) "
            f"> floor(count(*) OVER () * 0.03::DOUBLE) THEN {c} END AS {c}")


# --- dictionary and report -------------------------------------------------------------------

_types = {"c_custkey": "int64", "churned": "int64"} | {c: "float64" for c in CUSTOMERS.numeric}
_defs = {c: (d, v) for c, d, v in CUSTOMER_DEFINITIONS}


def _domain(c: str) -> str:
    kind = _defs.get(c, (None, "—"))[1]
    if kind == "rows":
        return "(SELECT '1 a ' || count(*) FROM raw)"
    if kind == "int_range":
        return f"(SELECT printf('min=%d | max=%d', min({c})::BIGINT, max({c})::BIGINT) FROM clean)"
    if kind == "decimal_range":
        return f"(SELECT printf('min=%.1f | max=%.1f', min({c}), max({c})) FROM clean)"
    return f"'{kind}'"


DICTIONARY = union(
    f"SELECT {i} AS position, '{c}' AS coluna, '{_types.get(c, 'object')}' AS tipo_python, "
    f"'{_defs.get(c, ('—', ''))[0]}' AS descricao, {_domain(c)} AS valores_possiveis, "
    f"{half(f'{_nulls(c)} * 100e0 / (SELECT count(*) FROM raw)', 2)} AS pct_ausentes_antes, "
    f"{half(_nulls(c, 'clean') + ' * 100e0 / (SELECT count(*) FROM clean)', 2)} AS pct_ausentes_depois"
    for i, c in enumerate(_cust_cols, 1))

_out = {c: f"(SELECT count(*) FROM imp WHERE {c} < {_lim(c, 'lower')} OR {c} > {_lim(c, 'upper')})"
        for c in CUSTOMERS.outlier}
_report = [("load", None, "rows", "(SELECT count(*) FROM raw)")]
_report += [("missing", c, "nulls", _nulls(c)) for c in _cust_cols]
_report += [("missing", None, "nulls", " + ".join(_nulls(c) for c in _cust_cols))]
_report += [("missing", c, "fill", f"(SELECT median({c}) FROM raw)") for c in CUSTOMERS.numeric]
_report += [("duplicates", None, "removed", "(SELECT count(*) FROM raw) - (SELECT count(*) FROM imp)")]
for _c in CUSTOMERS.outlier:
    _report += [("outliers", _c, "treated", _out[_c]), ("outliers", _c, "lower", _lim(_c, "lower")),
                ("outliers", _c, "upper", _lim(_c, "upper"))]
_report += [("outliers", None, "treated", " + ".join(_out.values())),
            ("result", None, "rows", "(SELECT count(*) FROM imp)")]


def _text(c) -> str:
    return "NULL::VARCHAR" if c is None else f"'{c}'"


REPORT = union(
    f"SELECT '{s}' AS step, {_text(c)} AS \"column\", '{m}' AS metric, {rnd(v, 6)} AS value" for s, c, m, v in _report)


def _profile(t: str, cols, types: dict) -> str:
    parts = []
    for i, c in enumerate(cols, 1):
        num = types.get(c, "object") != "object"
        stats = ", ".join(
            f"{rnd(f'{f}({c})', 4) if num else 'NULL::DOUBLE'} AS {n}"
            for f, n in (("min", "min"), ("max", "max"), ("sum", "sum"), ("avg", "mean")))
        parts.append(f"SELECT {i} AS position, '{c}' AS \"column\", '{types.get(c, 'object')}' AS dtype, "
                     f"count(*) AS rows, count(*) - count({c}) AS nulls, "
                     f"{rnd(f'(count(*) - count({c})) * 100e0 / count(*)', 4)} AS pct_null, {stats} FROM {t}")
    return union(parts)


def _top_corr() -> str:
    return union(f"SELECT '{c}' AS \"column\", {_corr(c, 'churned', 'raw')} AS r" for c in CUSTOMERS.numeric)


def _class_report() -> str:
    p0, r0, f0 = _div("tn", "tn + fn"), _div("tn", "tn + fp"), _div("2 * tn", "2 * tn + fn + fp")
    p1, r1, f1 = _div("tp", "tp + fp"), _div("tp", "tp + fn"), _div("2 * tp", "2 * tp + fp + fn")
    n0, n1, n = "(tn + fp)", "(fn + tp)", "(tn + fp + fn + tp)"

    def avg(a, b):
        return f"({a} + {b}) / 2e0"

    def weighted(a, b):
        return _div(f"{a} * {n0} + {b} * {n1}", n)

    rows = [("stayed", p0, r0, f0, n0), ("churned", p1, r1, f1, n1),
            ("accuracy", "NULL", "NULL", _div("tn + tp", n), n),
            ("macro avg", avg(p0, p1), avg(r0, r1), avg(f0, f1), n),
            ("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), n)]
    return union(f"SELECT model, '{name}' AS row, {rnd(p, 6)} AS precision, {rnd(r, 6)} AS recall, {rnd(f, 6)} AS f1, "
                 f"{s} AS support FROM conf" for name, p, r, f, s in rows)


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_hot = [("c_mktsegment", v) for v in _SEGMENTS] + [("region", v) for v in _REGIONS]
_names = [*CUSTOMERS.numeric] + [f"{c}_{v}" for c, v in _hot]
_line_key = "l_quantity, l_discount, l_tax, l_linestatus, returned"
_corr_cols = [*CUSTOMERS.numeric, "churned"]
_line_corr = [*LINES.numeric, "returned"]

_SLOTS = f"""SELECT (row_number() OVER (ORDER BY field, name) - 1)::INT AS slot, name AS feature FROM (
  {union(f"SELECT {i} AS field, '{c}' AS name" for i, c in enumerate(CUSTOMERS.numeric))} UNION ALL
  {union(f"SELECT DISTINCT {10 + i}, '{c}_' || {c} FROM marked WHERE NOT is_test"
         for i, c in enumerate(CUSTOMERS.categorical))})"""


def _true(*checks: str) -> str:
    return ", ".join(f"TRUE AS {c}" for c in checks)


_CLEAN_SPLIT = with_(*TO_CLEAN, *_split("clean", "c_custkey", "churned"))

ORACLES: dict[str, str] = {
    "null_profile": with_(CUST) + union(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, "
        f"{rnd(f'(count(*) - count({c})) * 100e0 / count(*)', 6)} AS pct_null FROM raw" for c in _cust_cols),
    "table_profile": with_(CUST) + _profile("raw", _cust_cols, _types),
    "data_dictionary": with_(*TO_CLEAN) + DICTIONARY,
    "fill_medians": with_(LINE) + union(
        f"SELECT '{c}' AS \"column\", {rnd(f'median({c})', 6)} AS value FROM line" for c in LINES.numeric),
    "fill_modes": with_(SIZES) + union(
        f"SELECT '{c}' AS \"column\", {_mode(c, 'docs')} AS value" for c in DOCUMENTS.categorical),
    "fill_modes_many": _modes_of("lineitem", "l_orderkey", "l_partkey", "l_suppkey"),
    "fill_modes_documents": _modes_of("documents", "source", "lang", "text"),
    "fill_modes_merged": _modes_of("orders", "o_custkey", "o_orderdate"),
    "impute_median_mode": with_(CUST) + "SELECT " + ", ".join(
        f"{rnd(_fill[c], 4)} AS {c}" if c in ("c_acctbal", "avg_price") else f"{_fill[c]} AS {c}" if c in _fill else c
        for c in _cust_cols) + " FROM raw",
    "drop_nulls": with_(CUST) + "SELECT c_custkey, c_acctbal FROM raw WHERE c_acctbal IS NOT NULL",
    "dedupe_count": with_(LINE) + f"""SELECT (SELECT count(*) FROM line) AS rows, count(*) AS kept,
  (SELECT count(*) FROM line) - count(*) AS duplicates FROM (SELECT DISTINCT {_line_key} FROM line)""",
    "dedupe_rows": with_(LINE) + f"SELECT DISTINCT {_line_key} FROM line",
    "iqr_limits": with_(LINE) + "SELECT \"column\", n, " + ", ".join(
        f"{rnd(c, 6)} AS {c}" for c in ("q1", "q3", "iqr", "lower", "upper"))
        + f" FROM ({_limits('line', LINES.numeric)})",
    "iqr_limits_by_group": with_(SIZES) + "SELECT lang, \"column\", n, " + ", ".join(
        f"{rnd(c, 6)} AS {c}" for c in ("q1", "q3", "iqr", "lower", "upper"))
        + f" FROM ({_limits('docs', DOCUMENTS.numeric, 'lang')})",
    "outlier_count_raw": with_(CUST, f"lim AS ({_limits('raw', CUSTOMERS.outlier)})") + union(
        f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM raw WHERE {c} < {_lim(c, 'lower')} "
        f"OR {c} > {_lim(c, 'upper')}) AS outliers, {rnd(_lim(c, 'lower'), 6)} AS lower, "
        f"{rnd(_lim(c, 'upper'), 6)} AS upper" for c in CUSTOMERS.outlier),
    "outlier_count_clean": with_(CUST, IMPUTED, LIMITS) + union(
        f"SELECT '{c}' AS \"column\", {_out[c]} AS outliers, {rnd(_lim(c, 'lower'), 6)} AS lower, "
        f"{rnd(_lim(c, 'upper'), 6)} AS upper" for c in CUSTOMERS.outlier),
    "winsorize": with_(CUST, IMPUTED, LIMITS, WINS) + "SELECT " + ", ".join(
        f"{rnd(c, 6)} AS {c}" if c in CUSTOMERS.numeric else c for c in _cust_cols) + " FROM wins",
    "clean_full": with_(*TO_CLEAN) + "SELECT * FROM clean",
    "cleaning_report": with_(CUST, IMPUTED, LIMITS) + REPORT,
    "quality_summary": with_(*TO_CLEAN, f"rlim AS ({_limits('raw', CUSTOMERS.outlier)})") + union([
        "SELECT 'raw rows' AS item, NULL::VARCHAR AS \"column\", count(*)::DOUBLE AS value FROM raw",
        f"SELECT 'raw columns', NULL, {len(_cust_cols)}e0",
        "SELECT 'clean rows', NULL, count(*)::DOUBLE FROM clean",
        f"SELECT 'clean columns', NULL, {len(_cust_cols)}e0",
        f"SELECT 'missing', NULL, ({' + '.join(_nulls(c) for c in _cust_cols)})::DOUBLE",
        "SELECT 'outliers', NULL, (" + " + ".join(
            f"(SELECT count(*) FROM raw, rlim WHERE \"column\" = '{c}' AND ({c} < lower OR {c} > upper))"
            for c in CUSTOMERS.outlier) + ")::DOUBLE",
        f"SELECT 'positive rate', NULL, {rnd('avg(churned) * 100', 4)} FROM clean",
        f"""SELECT 'correlation ' || place, c, {rnd('r', 4)} FROM (
  SELECT c, r, row_number() OVER (ORDER BY abs(r) DESC, c) AS place FROM ({union(
      f"SELECT '{c}' AS c, {_corr(c, 'churned', 'clean')} AS r" for c in CUSTOMERS.numeric)})) WHERE place <= 3""",
    ]),
    "csv_roundtrip": with_(*TO_CLEAN) + "SELECT * FROM clean",
    "csv_inferred": with_(CUST) + "SELECT * FROM raw",
    "dedupe_subset": """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_quantity, l_discount, l_tax ORDER BY l_orderkey, l_linenumber) AS place FROM lineitem)
WHERE place = 1""",
    "sketched_quantiles": with_(LINE) + union(
        f"""SELECT '{c}' AS "column", {p!r}::DOUBLE AS prob, count({c}) AS n, TRUE AS within FROM line"""
        for c in LINES.numeric for p in (0.01, 0.25, 0.5, 0.75, 0.99)),
    "cached_summary": with_(SIZES) + union(
        f"""SELECT {c} AS value, count(*) AS n, {half('count(*) * 100e0 / (SELECT count(*) FROM docs)', 1)} AS pct FROM docs GROUP BY 1"""
        for c in ("lang", "source")),
    "scatter_sample": with_(DOCS) + """SELECT n_chars, n_words, CASE poor WHEN 0 THEN 'good' WHEN 1 THEN 'poor' END AS label, doc_id, lang FROM (
  SELECT *, row_number() OVER (PARTITION BY poor ORDER BY md5(doc_id || ':42'), doc_id) AS place FROM docs) WHERE place <= 20""",
    "split_many_strata": with_("o AS (SELECT o_orderkey, o_custkey FROM orders)", *_split("o", "o_orderkey", "o_custkey")[:2],
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY md5(o_orderkey || ':42'), o_orderkey) AS place FROM o)""")
        + "SELECT o_orderkey, o_custkey, place <= k AS is_test FROM ranked JOIN alloc ON s = o_custkey",
    "label_encode_many": """SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderkey::VARCHAR) - 1 AS order_enc,
  dense_rank() OVER (ORDER BY o_custkey::VARCHAR) - 1 AS customer_enc FROM orders""",
    "onehot_many": """SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) - 1 AS slot FROM customer UNION ALL
SELECT c_custkey, (SELECT count(DISTINCT c_name) FROM customer) + dense_rank() OVER (ORDER BY c_mktsegment) - 1 FROM customer""",
    "roc_points_bounded": with_(*LINE_SCORED, CURVE) + _roc(
        "WHERE place = 1 OR np IS NULL OR floor(((cn + nn)::DOUBLE / n + (cp + np)::DOUBLE / p) * 97 / 2e0) > "
        "floor((cn::DOUBLE / n + cp::DOUBLE / p) * 97 / 2e0)"),
    "kpi_all": with_(LINE) + f"SELECT {_kpi('line', 'returned', {'l_quantity': 2, 'l_extendedprice': 1})} FROM line",
    "kpi_filtered": with_(DOCS) + f"SELECT {_kpi('docs', 'poor', {'n_chars': 2, 'n_words': 1})} FROM docs WHERE lang = 'en'",
    "kpi_rollup": with_(LINE) + f"""SELECT CASE WHEN grouping(ship_year) = 1 THEN 'Todos' ELSE ship_year END AS choice,
  {_kpi('line', 'returned', {'l_quantity': 2, 'l_extendedprice': 1})} FROM line GROUP BY ROLLUP (ship_year)""",
    "kpi_delta": with_(WHOLE) + f"""SELECT choice, total, positives, rate, mean_n_orders,
  CASE WHEN lvl = 0 THEN {rnd('rate - overall', 6)} END AS delta FROM (
  SELECT CASE WHEN grouping(region) = 1 THEN 'Todos' ELSE region END AS choice, grouping(region) AS lvl,
    (SELECT avg(churned) * 100e0 FROM raw) AS overall, {_kpi('raw', 'churned', {'n_orders': 2})}
  FROM raw GROUP BY ROLLUP (region)) WHERE choice IS NOT NULL""",
    "rate_by_lang": with_(DOCS) + _rate("docs", "lang", "poor"),
    "rate_by_category": with_(LINE) + _rate("line", "ship_year", "returned"),
    "category_share": with_(LINE) + _share("line", "ship_year"),
    "ordered_share": with_(LINE) + f"""SELECT position::INT AS position, ship_year, n, pct FROM
  (SELECT unnest(range(1, {len(YEARS) + 1})) AS position, unnest({YEARS!r}) AS ship_year)
  LEFT JOIN ({_share('line', 'ship_year')}) USING (ship_year)""",
    "target_summary": with_(LINE) + f"""SELECT CASE returned WHEN 0 THEN 'Kept (0)' WHEN 1 THEN 'Returned (1)' END AS class,
  n, pct FROM ({_share('line', 'returned')})""",
    "describe_numeric": with_(LINE) + union(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, " + ", ".join(
            f"{rnd(x, 4)} AS {n}" for n, x in (
                ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("min", f"min({c})"),
                ("p25", f"quantile_cont({c}, 0.25)"), ("p50", f"quantile_cont({c}, 0.5)"),
                ("p75", f"quantile_cont({c}, 0.75)"), ("max", f"max({c})"))) + " FROM line" for c in LINES.numeric),
    "corr_matrix": with_(CUST) + union(
        f"SELECT '{a}' AS a, '{b}' AS b, {rnd(_corr(a, b, 'raw'), 6)} AS r" for a in _corr_cols for b in _corr_cols),
    "corr_wide": with_(LINE) + union(
        f"SELECT '{a}' AS a, " + ", ".join(f"{rnd(_corr(a, b, 'line'), 6)} AS {b}" for b in _line_corr)
        for a in _line_corr),
    "corr_target_topk": with_(WHOLE) + f"""SELECT place, "column", {rnd('r', 6)} AS r, printf('%+.2f', r) AS text FROM (
  SELECT *, row_number() OVER (ORDER BY abs(r) DESC, "column")::INT AS place FROM ({_top_corr()})) WHERE place <= 3""",
    "corr_bar": with_(WHOLE) + f"""SELECT "column", {rnd('r', 6)} AS r, printf('%+.4f', r) AS text,
  CASE WHEN r > 0 THEN '+' ELSE '-' END || repeat('█', trunc(abs(r * 30))::INT) AS bar,
  CASE WHEN r > 0 THEN 'raises' ELSE 'lowers' END AS effect FROM ({_top_corr()})""",
    "box_stats": with_(LINE) + _box("line", ["l_quantity", "l_extendedprice"], "returned"),
    "box_stats_documents": with_(SIZES) + _box("docs", ["n_chars", "n_words"], "lang"),
    "box_outliers": with_(SIZES, f"lim AS ({_limits('docs', ['n_chars'], 'lang')})") + """
SELECT lang, doc_id, n_chars AS value FROM docs JOIN lim USING (lang) WHERE n_chars < lower OR n_chars > upper""",
    "histogram30": with_(LINE) + _hist("line", "l_extendedprice", 30, 4),
    "histogram30_scaled": with_(WHOLE, """z AS (SELECT (avg_price - m) / s AS avg_price FROM raw,
  (SELECT avg(avg_price) AS m, stddev_pop(avg_price) AS s FROM raw))""") + _hist("z", "avg_price", 30, 6),
    "density2d": with_(LINE) + f"""SELECT returned, {_bin('l_quantity', 'ql', 'qh', 20)} AS x_bin,
  {_bin('l_extendedprice', 'el', 'eh', 20)} AS y_bin, count(*) AS n FROM line,
  (SELECT min(l_quantity) AS ql, max(l_quantity) AS qh, min(l_extendedprice) AS el, max(l_extendedprice) AS eh FROM line)
GROUP BY 1, 2, 3""",
    "scatter_points": with_(DOCS) + """SELECT n_chars, n_words, CASE poor WHEN 0 THEN 'good' WHEN 1 THEN 'poor' END AS label,
  lang, source FROM docs""",
    "at_risk_list": with_(WHOLE) + """SELECT c_name AS "Name", c_mktsegment AS "Segment", region AS "Region",
  c_acctbal AS "Balance", n_orders AS "Orders", avg_price AS "Mean price", recency_days AS "Recency"
FROM raw WHERE churned = 1""",
    "label_map": "SELECT *, CASE quality WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS quality_name FROM labels",
    "distinct_values": with_(WHOLE) + "SELECT DISTINCT region FROM raw WHERE region IS NOT NULL ORDER BY 1",
    "head_rows": with_(WHOLE) + "SELECT * FROM raw ORDER BY c_custkey LIMIT 10",
    "stratified_split": with_("o AS (SELECT o_orderkey, o_orderstatus FROM orders)",
                              *_split("o", "o_orderkey", "o_orderstatus"))
        + "SELECT o_orderkey, o_orderstatus, is_test FROM marked",
    "split_counts": with_(*TO_CLEAN, *_split("clean", "c_custkey", "churned"))
        + "SELECT churned, is_test, count(*) AS n FROM marked GROUP BY 1, 2",
    "standardize": with_(*TO_CLEAN, *_split("clean", "c_custkey", "churned")) + "SELECT c_custkey, is_test, " + ", ".join(
        f"{rnd(_z(c), 6)} AS {c}" for c in CUSTOMERS.numeric) + " FROM marked",
    "onehot": with_(WHOLE) + "SELECT c_custkey, " + ", ".join(
        f"coalesce(({c} = '{v}')::INT, 0) AS \"{c}_{v}\"" for c, v in _hot) + " FROM raw",
    "label_encode": with_(SIZES) + """SELECT doc_id, (dense_rank() OVER (ORDER BY lang) - 1)::INT AS lang_enc,
  (dense_rank() OVER (ORDER BY source) - 1)::INT AS source_enc FROM docs""",
    "feature_names": _CLEAN_SPLIT + _SLOTS,
    "lr_optimality": _CLEAN_SPLIT + f"""SELECT slot, feature, TRUE AS solved FROM ({_SLOTS}) UNION ALL
  SELECT count(*)::INT, 'intercept', TRUE FROM ({_SLOTS})""",
    "lr_coefficients": _CLEAN_SPLIT + f"SELECT *, {_true('text_fits', 'sign_fits', 'effect_fits')} FROM ({_SLOTS})",
    "lr_scores": _CLEAN_SPLIT + f"""SELECT c_custkey, 'Regressão Logística' AS model, churned AS label,
  {_true('score_fits', 'prediction_fits')} FROM marked WHERE is_test""",
    "rf_importances": _CLEAN_SPLIT + f"""SELECT *, {_true('is_share', 'sums_to_one', 'mean_fits', 'gain_fits', 'flag_fits')}
FROM ({_SLOTS})""",
    "rf_top_importances": f"""SELECT place::INT AS place, {_true('not_too_late', 'not_too_early', 'text_fits', 'bar_fits')}
FROM (SELECT unnest(range(1, 6)) AS place)""",
    "trained_comparison": f"""SELECT model, metric, {_true('in_range', 'value_fits', 'best_fits')}
FROM (SELECT unnest(['Regressão Logística', 'Random Forest']) AS model),
  (SELECT unnest(['Acurácia', 'Precisão', 'Recall', 'F1-Score', 'ROC-AUC']) AS metric)""",
    "saved_model_scores": with_(*TO_CLEAN) + f"""SELECT c_custkey, 'Regressão Logística' AS model,
  array_to_string(list_filter([{', '.join(_rules)}], lambda f: f IS NOT NULL), '|') AS codes,
  {_true('prob_fits', 'pred_fits', 'band_fits', 'delta_fits')} FROM clean""",
    "load_or_fit_once": with_(CUST, IMPUTED) + """SELECT turn::INT AS turn, (SELECT count(*) FROM imp) AS scored, 1 AS fits
FROM (SELECT unnest(range(3)) AS turn)""",
    "gap_scores": f"""SELECT c_custkey, 'Regressão Logística' AS model,
  {_true('prob_fits', 'pred_fits', 'band_fits', 'delta_fits')} FROM customer""",
    "gap_scores_stream": "SELECT count(*) AS rows, count(*) AS same FROM customer",
    "legacy_rf_scores": with_(CUST, *_split("raw", "c_custkey", "churned"))
        + f"""SELECT c_custkey, is_test,
  {_true('prob_fits', 'one_decimal', 'class_fits', 'score_fits', 'learned', 'report_fits')} FROM marked""",
    "saved_model_check": _CLEAN_SPLIT + "SELECT count(*) AS rows, count(*) AS same FROM marked WHERE is_test",
    "validate": with_(WHOLE) + f"SELECT count(*) AS rows, {len(_cust_cols)} AS columns FROM raw",
    "separate_features": with_(DOCS) + "SELECT " + ", ".join(DOCUMENTS.features) + ", poor::DOUBLE AS label FROM docs",
    "hash_split": f"""SELECT o_orderkey, o_orderstatus,
  ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT < {int(0.2 * 2**32)} AS is_test FROM orders""",
    "feature_vector": with_(*TO_CLEAN, *_split("clean", "c_custkey", "churned"),
                            "zs AS (SELECT c_custkey, is_test, c_mktsegment, region, " + ", ".join(
                                f"{_z(c)} AS {c}" for c in CUSTOMERS.numeric) + " FROM marked)")
        + union([f"SELECT c_custkey, is_test, {i} AS slot, {rnd(c, 6)} AS value FROM zs"
                 for i, c in enumerate(CUSTOMERS.numeric)]
                + [f"SELECT c_custkey, is_test, {len(CUSTOMERS.numeric) + i}, ({c} = '{v}')::INT::DOUBLE FROM zs"
                   for i, (c, v) in enumerate(_hot)]),
    "confusion": with_(*LINE_SCORED, CONF) + "SELECT * FROM conf",
    "confusion_cells": with_(*CUST_SCORED, CONF) + union(
        f"SELECT model, '{a}' AS actual, '{p}' AS predicted, {c} AS n FROM conf" for c, a, p in (
            ("tn", "stayed", "stayed"), ("fp", "stayed", "churned"), ("fn", "churned", "stayed"),
            ("tp", "churned", "churned"))),
    "metrics": with_(*CUST_SCORED, CONF, AUC, MEASURED) + "SELECT * FROM measured",
    "metrics_lines": with_(*LINE_SCORED, CONF, AUC, MEASURED) + "SELECT * FROM measured",
    "class_report": with_(*CUST_SCORED, CONF) + _class_report(),
    "roc_points": with_(*CUST_SCORED, CURVE) + _roc("WHERE place = 1 OR np IS NULL OR np <> pos OR nn <> neg"),
    "roc_points_all": with_(*LINE_SCORED, CURVE) + _roc("")
        + " UNION ALL SELECT 'Aleatório', NULL, 0e0, 0e0 UNION ALL SELECT 'Aleatório', NULL, 1e0, 1e0",
    "roc_auc": with_(*LINE_SCORED, AUC) + f"SELECT model, {rnd('auc', 9)} AS auc FROM auc",
    "compare_models": with_(*CUST_SCORED, CONF, AUC, MEASURED)
        + "SELECT *, value = max(value) OVER (PARTITION BY metric) AS best FROM measured",
    "compare_wide": with_(*CUST_SCORED, CONF, AUC, MEASURED) + "SELECT model, " + ", ".join(
        f"max(value) FILTER (metric = '{m}') AS \"{m}\"" for m in ("Acurácia", "Precisão", "Recall", "F1-Score", "ROC-AUC")
    ) + " FROM measured GROUP BY 1",
    "best_model": with_(*CUST_SCORED, CONF, AUC, MEASURED)
        + f"SELECT model, value FROM measured WHERE metric = 'ROC-AUC' ORDER BY value DESC, model = '{CARD_A}' LIMIT 1",
    "risk_band": with_(LINE) + f"""SELECT {_band('p')} AS band, count(*) AS n, sum(returned)::BIGINT AS returned
FROM (SELECT {_softsign('(l_quantity - 25e0) / 10e0')} * 100e0 AS p, returned FROM line) GROUP BY 1""",
    "risk_factors": with_(WHOLE, RISK) + f"""SELECT c_custkey, {_band('prob')} AS band, len(codes)::INT AS n_factors,
  array_to_string(codes, '|') AS codes, array_to_string(list_transform(codes,
    lambda f: CASE WHEN f IN {_red} THEN 'vermelho' ELSE 'amarelo' END), '|') AS levels FROM risk""",
    "risk_delta": with_(WHOLE, RISK) + f"""SELECT c_custkey, {rnd('prob', 6)} AS prob,
  {rnd(f'prob - {_BASE}', 6)} AS delta FROM risk""",
    "scenario_check": with_(WHOLE, RISK) + f"""SELECT expected, band,
  CASE WHEN band = expected THEN 'consistente' ELSE 'inesperado' END AS verdict, count(*) AS n FROM (
  SELECT CASE WHEN churned = 1 THEN 'alto' ELSE 'baixo' END AS expected, {_band('prob')} AS band FROM risk) GROUP BY 1, 2, 3""",
    "score_bars": with_(LINE) + f"""SELECT ship_year, repeat('#', trunc(abs(rate / 100e0 * 50))::INT) AS bar,
  printf('%+.2f', rate / 100e0) AS signed, CASE ship_year WHEN '1995' THEN 'first' END AS mark
FROM ({_rate('line', 'ship_year', 'returned')})""",
    "inject_nulls": f"SELECT o_orderkey, {_chosen('o_totalprice')}, {_chosen('o_orderpriority')} FROM orders",
    "inject_nulls_hashed": f"""SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(o_orderkey || ':o_totalprice:42'), 1, 8))::BIGINT
  >= {int(0.03 * 2**32)} THEN o_totalprice END AS o_totalprice FROM orders""",
    "stream_score": ORDER_SCORE,
    "batch_score": ORDER_SCORE,
}


def _long(chart: str, rows: str, keys: list[str], numbers: list[str]) -> str:
    key = ", ".join([f"'{chart}'", *[f'"{k}"::VARCHAR' for k in keys]])
    values = ", ".join(rnd(f'"{c}"', 4) for c in numbers)
    return f"SELECT concat_ws('|', {key}) AS key, unnest({numbers!r}) AS measure, unnest([{values}]) AS value FROM ({rows})"


def _dashboard() -> str:
    x, y = "avg_price", "recency_days"
    indicators = _kpi("raw", "churned", {"n_orders": 2, "avg_price": 1})
    said = ["total", "positives", "rate", "mean_n_orders", "mean_avg_price"]
    charts = [
        ("choices", "SELECT DISTINCT region, 1 AS rows FROM raw WHERE region IS NOT NULL", ["region"], ["rows"]),
        ("kpis", f"SELECT {indicators} FROM chosen", [], said),
        ("kpis_by_choice", f"""SELECT *, CASE WHEN lvl = 0 THEN rate - overall END AS delta FROM (
          SELECT CASE WHEN grouping(region) = 1 THEN 'Todos' ELSE region END AS choice, grouping(region) AS lvl,
            (SELECT avg(churned) * 100e0 FROM raw) AS overall, {indicators}
          FROM raw GROUP BY ROLLUP (region)) WHERE choice IS NOT NULL""", ["choice"], [*said, "delta"]),
        ("scatter", "SELECT *, CASE churned WHEN 0 THEN 'kept' WHEN 1 THEN 'churned' END AS label FROM chosen",
         ["c_custkey", "label"], [x, y]),
        ("density", f"""SELECT churned, {_bin(x, 'xl', 'xh', 20)} AS x_bin, {_bin(y, 'yl', 'yh', 20)} AS y_bin, count(*) AS n
          FROM chosen, (SELECT min({x}) AS xl, max({x}) AS xh, min({y}) AS yl, max({y}) AS yh FROM chosen)
          WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1, 2, 3""", ["churned", "x_bin", "y_bin"], ["n"]),
        ("box", _box("chosen", [x], "churned"), ["churned", "column"],
         ["n", "q1", "median", "q3", "low_whisker", "high_whisker", "outliers"]),
        ("box_outliers", f"SELECT *, {x} AS value FROM chosen JOIN lim USING (churned) WHERE {x} < lower OR {x} > upper",
         ["churned", "c_custkey"], ["value"]),
        ("correlations", f"""SELECT "column", r, printf('%+.4f', r) AS text,
          CASE WHEN r > 0 THEN '+' ELSE '-' END || repeat('█', trunc(abs(r * 30))::INT) AS bar,
          CASE WHEN r > 0 THEN 'raises' ELSE 'lowers' END AS effect FROM ({_top_corr()})""",
         ["column", "text", "bar", "effect"], ["r"]),
        ("at_risk", 'SELECT c_name AS "Name", region AS "Region", 1 AS rows FROM chosen WHERE churned = 1',
         ["Name", "Region"], ["rows"]),
        *[(f"rate_by_{c}", _rate("raw", c, "churned"), [c], ["n", "positives", "rate"]) for c in ("region", "c_mktsegment")],
    ]
    return with_(WHOLE, "chosen AS (SELECT * FROM raw WHERE region = 'ASIA')",
                 f"lim AS ({_limits('chosen', [x], 'churned')})") + union(_long(*chart) for chart in charts)


ORACLES["dashboard"] = _dashboard()
ORACLES["quality_flow"] = ORACLES["quality_summary"]
