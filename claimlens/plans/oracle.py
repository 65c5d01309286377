"""The registered queries as plain SQL over the raw tables, for checking in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from claimlens import schema
from claimlens.operators.features import SCALED
from claimlens.plans.registry import (
    CURVE_POINTS,
    FIXED_POWERS,
    GLM_GROUPS,
    GLM_POWERS,
    SMALL_INPUTS,
    SMALL_POWERS,
    SKETCHED,
    SUMMARY_COLUMNS,
)

CLAIMS = """
claims AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
    l.l_extendedprice AS Claim,
    CAST(p.p_size * 2 AS INTEGER) AS Age,
    l.l_linestatus AS Gender,
    o.o_orderstatus AS MaritalStatus,
    CASE WHEN l.l_tax >= 0.04 THEN 'F' ELSE 'P' END AS PartTimeFullTime,
    CAST(l.l_linenumber - 1 AS INTEGER) AS DependentChildren,
    CAST(l.l_suppkey % 3 AS INTEGER) AS DependentsOther,
    abs(c.c_acctbal) / 5 AS WeeklyPay,
    l.l_quantity * 2 - 10 AS HoursWorkedPerWeek,
    CAST(1 + l.l_partkey % 7 AS INTEGER) AS DaysWorkedPerWeek,
    CAST(year(o.o_orderdate) AS INTEGER) AS AccYear,
    CAST(month(o.o_orderdate) AS INTEGER) AS AccMonth,
    CAST(isodow(o.o_orderdate) AS INTEGER) AS AccWeekday,
    CAST(l.l_suppkey % 24 AS INTEGER) AS AccTime,
    CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) AS INTEGER) AS AccDay,
    CAST(date_diff('day', DATE '1995-01-01', CAST(l.l_shipdate AS DATE)) AS INTEGER) AS RepDay,
    CAST(year(l.l_shipdate) AS INTEGER) AS RepYear,
    CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS RepDelay
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_shipdate >= o.o_orderdate
)"""

SILVER = (
    CLAIMS
    + """,
silver AS (
  SELECT *, row_number() OVER (
      ORDER BY Claim DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS Id
  FROM claims WHERE AccYear > 1995 AND HoursWorkedPerWeek > 0
)"""
)


def _hash(seed: int, value: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({value} AS VARCHAR)), 1, 8) AS BIGINT)"


def _uniform(seed: int, value: str) -> str:
    return f"(({_hash(seed, value)} + 0.5) / 4294967296.0)"


S = schema.SEED

# clamped claims with codes, random numbers, split and shuffle key
BASE = (
    SILVER
    + f""",
gender_levels AS (
  SELECT Gender, row_number() OVER (ORDER BY Gender) AS code
  FROM (SELECT DISTINCT Gender FROM silver)
),
marital_levels AS (
  SELECT MaritalStatus, row_number() OVER (ORDER BY MaritalStatus) AS code
  FROM (SELECT DISTINCT MaritalStatus FROM silver)
),
time_levels AS (
  SELECT PartTimeFullTime, row_number() OVER (ORDER BY PartTimeFullTime) AS code
  FROM (SELECT DISTINCT PartTimeFullTime FROM silver)
),
base AS (
  SELECT s.* REPLACE (
      greatest(16, least(70, s.Age)) AS Age,
      least(1, s.DependentChildren) AS DependentChildren,
      least(1, s.DependentsOther) AS DependentsOther,
      least(1200.0::DOUBLE, s.WeeklyPay) AS WeeklyPay,
      least(60.0::DOUBLE, s.HoursWorkedPerWeek) AS HoursWorkedPerWeek),
    least(100, s.RepDelay) AS RepDelayCap,
    CAST(g.code AS INTEGER) AS GenderCode,
    CAST(m.code AS INTEGER) AS MaritalStatusCode,
    CAST(t.code AS INTEGER) AS PartTimeFullTimeCode,
    sqrt(-2 * ln({_uniform(S + 20, 's.Id')})) * cos(2 * pi() * {_uniform(S + 21, 's.Id')}) AS RandNormal,
    -sqrt(3) + {_uniform(S + 30, 's.Id')} * 2 * sqrt(3) AS RandUniform,
    CASE WHEN (s.Id - 1) % 5 = {_hash(S, '(s.Id - 1) // 5')} % 5 THEN 'test' ELSE 'learn' END AS split,
    {_hash(S + 10, 's.Id')} AS shuffle_key,
    CASE WHEN m.code = 1 THEN 1 ELSE 0 END AS Marital1,
    CASE WHEN m.code = 2 THEN 1 ELSE 0 END AS Marital2,
    CASE WHEN m.code = 3 THEN 1 ELSE 0 END AS Marital3
  FROM silver s
  JOIN gender_levels g ON s.Gender = g.Gender
  JOIN marital_levels m ON s.MaritalStatus = m.MaritalStatus
  JOIN time_levels t ON s.PartTimeFullTime = t.PartTimeFullTime
)"""
)

FEATURES = (
    BASE
    + ",\nstats AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in SCALED.values())
    + " FROM base),\nfeatures AS (SELECT base.*, "
    + ", ".join(f"({c} - m_{c}) / s_{c} AS {n}" for n, c in SCALED.items())
    + " FROM base CROSS JOIN stats)"
)


def _with(ctes: str, select: str, *more: str) -> str:
    return f"WITH {ctes}{''.join(',' + m for m in more)}\n{select}"


RAW_COLUMNS = [f.name for f in schema.CLAIMS_SCHEMA.fields]
KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
RAW = ", ".join(RAW_COLUMNS)

VALIDATION = """
ranked AS (
  SELECT *, row_number() OVER (ORDER BY shuffle_key, Id) AS place, count(*) OVER () AS n
  FROM base WHERE split = 'learn'
),
validated AS (SELECT *, place > (n * 4) // 5 AS is_validation FROM ranked)"""

WEEKS = """
weeks AS (
  SELECT *, rep_week - acc_week AS RepDelay_week FROM (
    SELECT *,
      CAST(floor((AccDay - (SELECT min(AccDay) FROM silver)) / 7.0) AS BIGINT) AS acc_week,
      CAST(floor((RepDay - (SELECT min(AccDay) FROM silver)) / 7.0) AS BIGINT) AS rep_week
    FROM silver)
)"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _schema_report() -> str:
    types = {"double": "double", "integer": "int", "string": "string"}
    fields = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_partkey", "bigint")]
    fields += [("l_suppkey", "bigint")]
    fields += [(f.name, types[f.dataType.typeName()]) for f in schema.CLAIMS_SCHEMA.fields]
    fields += [("Id", "bigint")]
    return _with(
        SILVER,
        _union(
            [
                f"SELECT CAST({i + 1} AS INTEGER) AS position, '{n}' AS name, '{t}' AS type, "
                f"count({n}) AS non_null, "
                f"CAST(max(CASE WHEN Id = 1 THEN {n} END) AS VARCHAR) AS first_value FROM silver"
                for i, (n, t) in enumerate(fields)
            ]
        ),
    )


def _summary(source: str, columns: list[str]) -> str:
    return _union(
        [
            f"SELECT '{c}' AS feature, count({c}) AS n, count(*) - count({c}) AS nulls, "
            f"round(CAST(min({c}) AS DOUBLE), 4) AS min, "
            f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q1, "
            f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median, "
            f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q3, "
            f"round(avg({c}), 4) AS mean, round(CAST(max({c}) AS DOUBLE), 4) AS max FROM {source}"
            for c in columns
        ]
    )


def _ranges() -> str:
    return _union(
        [
            f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi, "
            f"round(avg({c}), 4) AS mean, count(*) - count({c}) AS nulls FROM base"
            for c in ("AccYear", "RepYear", "RepDelay", "RepDelayCap", "Claim")
        ]
    )


def _delay_ranges() -> str:
    return _union(
        [
            f"SELECT '{c}' AS \"column\", min({c}) AS min_days, max({c}) AS max_days, "
            f"round(min({c}) / 365.0, 4) AS min_years, round(max({c}) / 365.0, 4) AS max_years, "
            f"round(min({c}) / 7.0, 4) AS min_weeks, round(max({c}) / 7.0, 4) AS max_weeks, "
            f"round(avg({c}) / 7, 4) AS mean_weeks FROM base"
            for c in ("RepDelay", "RepDelayCap")
        ]
    )


def _levels(columns: list[str], source: str, select: str) -> str:
    return _union(
        [
            f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, {select} FROM {source} GROUP BY {c}"
            for c in columns
        ]
    )


BINNED = """
binned AS (
  SELECT * REPLACE (
    CAST(least(1200, ceil(WeeklyPay / 100) * 100) AS BIGINT) AS WeeklyPay,
    least(60.0::DOUBLE, HoursWorkedPerWeek) AS HoursWorkedPerWeek,
    CAST(least(100, floor(RepDelayCap / 10.0) * 10) AS BIGINT) AS RepDelay)
  FROM base
)"""


def _pearson(source: str) -> str:
    cols = schema.CORRELATION_COLUMNS
    name = {c: ("RepDelayCap" if c == "RepDelay" and source == "base" else c) for c in cols}
    return _union(
        [
            f"SELECT '{a}' AS a, '{b}' AS b, round("
            + ("1.0::DOUBLE" if a == b else f"corr({name[a]}, {name[b]})")
            + f", 2) AS r FROM {source}"
            + (" HAVING count(*) > 0" if a == b else "")
            for a in cols
            for b in cols
        ]
    )


def _ranks() -> str:
    parts = []
    for c in schema.CORRELATION_COLUMNS:
        x = "RepDelayCap" if c == "RepDelay" else c
        parts.append(
            f"rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS {c}"
        )
    return "ranks AS (SELECT " + ", ".join(parts) + " FROM base)"


def _kde(value: str, where: str = "") -> str:
    return _with(
        SILVER,
        """SELECT i, round(lo + i * step, 6) AS x, round(density, 10) AS density FROM (
  SELECT i, any_value(lo) AS lo, any_value(step) AS step,
    sum(w * exp(-0.5 * ((i - node) * step / bw) * ((i - node) * step / bw)))
      / any_value(n * bw * sqrt(2 * pi())) AS density
  FROM weights CROSS JOIN ends CROSS JOIN (SELECT CAST(range AS INTEGER) AS i FROM range(512))
  GROUP BY i)""",
        f"\nvals AS (SELECT {value} AS v FROM silver {where})",
        """
ends AS (
  SELECT *, (hi - lo) / 511 AS step, 0.9 * least(sd, iqr / 1.34) * pow(n, -0.2) AS bw FROM (
    SELECT count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) AS sd,
      quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM vals))""",
        """
placed AS (
  SELECT CAST(least(floor(p), 510) AS INTEGER) AS node, p - least(floor(p), 510) AS part
  FROM (SELECT (v - lo) / (hi - lo) * 511 AS p FROM vals CROSS JOIN ends))""",
        """
weights AS (
  SELECT node, sum(w) AS w FROM (
    SELECT node, sum(1 - part) AS w FROM placed GROUP BY node
    UNION ALL SELECT node + 1, sum(part) FROM placed GROUP BY node)
  GROUP BY node)""",
    )


ECDF = """
points AS (
  SELECT x, cnt, ecdf, ln(x) AS log_x, ln(1.00001 - ecdf) AS log_survival FROM (
    SELECT x, cnt, sum(cnt) OVER (ORDER BY x) / sum(cnt) OVER () AS ecdf FROM (
      SELECT Claim AS x, count(*) AS cnt FROM silver GROUP BY Claim))
)"""

EVERY_POINT = "\ncells AS (SELECT log_x AS x, log_survival AS y, cnt AS w FROM points)"

LOCAL = [
    "\nends AS (SELECT min(log_x) AS lo, max(log_x) AS hi, sum(cnt) AS n FROM points)",
    """
cells AS (
  SELECT sum(cnt * log_x) / sum(cnt) AS x, sum(cnt * log_survival) / sum(cnt) AS y, sum(cnt) AS w
  FROM points CROSS JOIN ends
  GROUP BY least(floor((log_x - lo) / (hi - lo) * 4096), 4095))""",
    """
near AS (
  SELECT i, x0, x, y, w, d, sum(w) OVER (PARTITION BY i ORDER BY d) AS reached, floor(n * 0.1 + 1e-9) AS needed
  FROM (
    SELECT *, abs(x - x0) AS d FROM (
      SELECT CAST(range AS INTEGER) AS i, lo + range * ((hi - lo) / 100) AS x0, n, x, y, w
      FROM cells CROSS JOIN ends CROSS JOIN range(101))))""",
    """
wide AS (SELECT *, min(CASE WHEN reached >= needed THEN d END) OVER (PARTITION BY i) AS h FROM near)""",
    """
weighed AS (
  SELECT i, x0, y, (x - x0) / h AS u, w * pow(1 - pow(abs((x - x0) / h), 3), 3) AS k
  FROM wide WHERE d < h)""",
    """
moments AS (
  SELECT i, x0, sum(k) AS s0, sum(k*u) AS s1, sum(k*u*u) AS s2, sum(k*u*u*u) AS s3, sum(k*u*u*u*u) AS s4,
    sum(k*y) AS t0, sum(k*u*y) AS t1, sum(k*u*u*y) AS t2
  FROM weighed GROUP BY i, x0)""",
]


def _deviance(y: str, mu: str, p: float) -> str:
    if p == 2.0:
        return f"2 * (({y} - {mu}) / {mu} + ln({mu} / {y}))"
    if p == 3.0:
        return f"({y} - {mu}) * ({y} - {mu}) / ({mu} * {mu} * {y})"
    a, b = 1 - p, 2 - p
    return (
        f"2 * (pow({y}, {b}) / ({a * b}) - {y} * pow({mu}, {a}) / ({a}) + pow({mu}, {b}) / ({b}))"
    )


def _metrics(models: list[str], source: str) -> str:
    parts = []
    for m in models:
        for split in ("learn", "test"):
            for kind, p, unit in (("p2", 2.0, 1), ("pp", schema.POWER, 10), ("p3", 3.0, 1000)):
                parts.append(
                    f"SELECT '{m}' AS model, '{split}_{kind}' AS key, "
                    f"round(avg({_deviance('Claim', m, p)}) * {unit}, 4) AS value "
                    f"FROM {source} WHERE split = '{split}'"
                )
        parts.append(
            f"SELECT '{m}' AS model, 'avg_size' AS key, round(avg({m}), 0) AS value "
            f"FROM {source} WHERE split = 'test'"
        )
    return _union(parts)


NULL_MEAN = "(SELECT round(avg(Claim)) FROM features WHERE split = 'learn')"


def _entry(i: int, j: int) -> float:
    return ((7 * i + 3 * j) % 11 - 5) / 50


def _bias(j: int) -> float:
    return (j % 5 - 2) / 50


def _affine(inputs: list[str], n_out: int) -> list[str]:
    return [
        f"({_bias(j)})" + "".join(f" + {x} * ({_entry(i, j)})" for i, x in enumerate(inputs))
        for j in range(n_out)
    ]


def _network() -> list[str]:
    """Hidden layers of the formula-weight networks, one CTE per layer."""
    ctes, inputs, source = [], schema.MODEL_FEATURES, "features"
    for layer, width in enumerate(schema.HIDDEN_LAYERS):
        nodes = _affine(inputs, width)
        outputs = [f"h{layer}_{j}" for j in range(width)]
        ctes.append(
            f"\nnet{layer} AS (SELECT {source}.*, "
            + ", ".join(f"tanh({n}) AS {o}" for n, o in zip(nodes, outputs))
            + f" FROM {source})"
        )
        inputs, source = outputs, f"net{layer}"
    betas = _affine(inputs, len(schema.MODEL_FEATURES))
    ctes.append(
        f"\nnet_attention AS (SELECT {source}.*, "
        + ", ".join(f"{b} AS b{j}" for j, b in enumerate(betas))
        + f" FROM {source})"
    )
    ffn = "".join(f" + {x} * ({_entry(i, 0)})" for i, x in enumerate(inputs))
    local = " + ".join(f"{f} * b{j}" for j, f in enumerate(schema.MODEL_FEATURES))
    ctes.append(
        f"""
scored AS (
  SELECT *, {NULL_MEAN} AS null_model,
    exp(ln({NULL_MEAN}){ffn}) AS ffn_fixed,
    exp(ln({NULL_MEAN}) + 0.5 * ({local})) AS localglm_fixed
  FROM net_attention)"""
    )
    return ctes


def _fixed_gradients() -> tuple[list[str], list[tuple[str, str, float, list[tuple[str, int, int, str, str]]]]]:
    """CTEs with the derivatives by the chain rule, one per layer and model, and per model:
    name, CTE, power, and (layer, i, j, start value, derivative of a row)."""
    hidden = list(schema.HIDDEN_LAYERS)
    inputs = [schema.MODEL_FEATURES] + [[f"h{k}_{j}" for j in range(n)] for k, n in enumerate(hidden)]
    last = len(hidden) - 1
    log_mean = f"ln({NULL_MEAN})"
    ctes, models = [], []
    features = schema.MODEL_FEATURES
    ffn = "".join(f" + {x} * ({_entry(i, 0)})" for i, x in enumerate(inputs[-1]))
    local = " + ".join(f"{f} * b{j}" for j, f in enumerate(features))
    for kind in ("ffn", "localglm"):
        for label, p in FIXED_POWERS.items():
            name = f"{kind}_{label}"
            eta = f"{log_mean}{ffn}" if kind == "ffn" else f"{log_mean} + 0.5 * ({local})"
            ctes.append(
                f"\n{name}_mu AS (SELECT *, {local} AS score, exp({eta}) AS mu, {NULL_MEAN} AS m FROM net_attention WHERE split = 'learn')"
            )
            ctes.append(f"\n{name}_s AS (SELECT *, 2 * (pow(mu, {2 - p}) - Claim * pow(mu, {1 - p})) AS s FROM {name}_mu)")
            source = f"{name}_s"
            slots = []
            if kind == "ffn":
                slots += [("output", i, 0, repr(_entry(i, 0)), f"{x} * s") for i, x in enumerate(inputs[-1])]
                back = [f"s * ({_entry(i, 0)})" for i in range(hidden[-1])]
            else:
                slots.append(("output", 0, 0, "0.5", "score * s"))
                beta = [f"s * 0.5 * {f}" for f in features]
                slots += [
                    ("attention", i, j, repr(_entry(i, j)), f"{x} * {beta[j]}")
                    for i, x in enumerate(inputs[-1])
                    for j in range(len(features))
                ]
                slots += [("attention", -1, j, repr(_bias(j)), beta[j]) for j in range(len(features))]
                back = [
                    " + ".join(f"{beta[j]} * ({_entry(i, j)})" for j in range(len(features)))
                    for i in range(hidden[-1])
                ]
            slots.append(("output", -1, 0, "ln(max(m))", "s"))
            for layer in range(last, -1, -1):
                pre = [f"d{layer}_{j}" for j in range(hidden[layer])]
                ctes.append(
                    f"\n{name}_{layer} AS (SELECT *, "
                    + ", ".join(f"({b}) * (1 - h{layer}_{j} * h{layer}_{j}) AS {pre[j]}" for j, b in enumerate(back))
                    + f" FROM {source})"
                )
                source = f"{name}_{layer}"
                slots += [
                    (f"layer{layer + 1}", i, j, repr(_entry(i, j)), f"{x} * {d}")
                    for i, x in enumerate(inputs[layer])
                    for j, d in enumerate(pre)
                ]
                slots += [(f"layer{layer + 1}", -1, j, repr(_bias(j)), d) for j, d in enumerate(pre)]
                if layer:
                    back = [
                        " + ".join(f"{d} * ({_entry(i, j)})" for j, d in enumerate(pre))
                        for i in range(hidden[layer - 1])
                    ]
            models.append((name, source, p, slots))
    return ctes, models


def _parameters(value: Callable[[str, str, float], str]) -> str:
    """One row per parameter of the six networks: ``value(start, mean derivative, power)``."""
    ctes, models = _fixed_gradients()
    parts = []
    for name, source, p, slots in models:
        listed = ", ".join(
            f"{{'layer': '{layer}', 'i': {i}, 'j': {j}, 'value': {value(start, f'avg({d})', p)}}}"
            for layer, i, j, start, d in slots
        )
        parts.append(
            f"SELECT '{name}' AS model, r.layer AS layer, CAST(r.i AS INTEGER) AS i, CAST(r.j AS INTEGER) AS j, "
            f"round(r.value, 6) + 0.0 AS value FROM (SELECT unnest([{listed}]) AS r FROM {source})"
        )
    return _with(FEATURES, _union(parts), *_network()[:-1], *ctes)


def _nadam(start: str, gradient: str) -> str:
    """The first step of the optimizer from zero moments."""
    now, following = (0.9 * (1 - 0.5 * 0.96 ** (0.004 * t)) for t in (1, 2))
    share = 0.1 * following / (1 - now * following) + 1
    return f"{start} - 0.001 * {share!r} * {gradient} / (abs({gradient}) + 1e-7)"


SMALL_SLOTS = [
    *(("layer1", i, j, f"w{i}{j}", repr(_entry(i, j))) for i in range(3) for j in range(2)),
    *(("layer1", -1, j, f"b{j}", repr(_bias(j))) for j in range(2)),
    *(("output", i, 0, f"v{i}", repr(_entry(i, 0))) for i in range(2)),
    ("output", -1, 0, "c", f"ln({NULL_MEAN})"),
]


def _small_steps(batch: str) -> list[str]:
    """CTEs of two training steps: per model ``<model>_0`` to ``_2`` hold the parameters and moments, ``_at0`` to
    ``_at2`` the rows with the deviances at them.  ``batch`` numbers the steps a row takes part in."""
    x = ", ".join(f"{f} AS x{i}" for i, f in enumerate(SMALL_INPUTS))
    ctes = [
        f"\nplaced AS (SELECT Claim AS y, {x}, {NULL_MEAN} AS mean, count(*) OVER () AS n, "
        "row_number() OVER (ORDER BY shuffle_key, Id) AS place FROM features WHERE split = 'learn')",
        f"\nlearn_rows AS (SELECT *, place > (n * 4) // 5 AS held, {batch} AS batch FROM placed)",
    ]
    product = 1.0
    momentum = [0.9 * (1 - 0.5 * 0.96 ** (0.004 * t)) for t in range(4)]
    names = [slot[3] for slot in SMALL_SLOTS]
    for model, p in SMALL_POWERS.items():
        start = ", ".join(f"{value} AS {name}, 0.0 AS m_{name}, 0.0 AS q_{name}" for *_, name, value in SMALL_SLOTS)
        ctes.append(f"\n{model}_0 AS (SELECT {start})")
        product = 1.0
        deviance = "2 * ((y - mu) / mu + ln(mu / y))" if p == 2 else "(y - mu) * (y - mu) / (mu * mu * y)"
        for t in range(3):
            h = ", ".join(f"tanh(b{j} + " + " + ".join(f"x{i} * w{i}{j}" for i in range(3)) + f") AS h{j}" for j in range(2))
            ctes.append(f"\n{model}_h{t} AS (SELECT *, {h} FROM learn_rows CROSS JOIN {model}_{t})")
            ctes.append(f"\n{model}_mu{t} AS (SELECT *, exp(c + h0 * v0 + h1 * v1) AS mu FROM {model}_h{t})")
            ctes.append(
                f"\n{model}_at{t} AS (SELECT *, 2 * (pow(mu, {2 - p}) - y * pow(mu, {1 - p})) AS s, {deviance} AS dev FROM {model}_mu{t})"
            )
            if t == 2:
                break
            back = [f"s * v{j} * (1 - h{j} * h{j})" for j in range(2)]
            slopes = {"c": "s", "v0": "h0 * s", "v1": "h1 * s", "b0": back[0], "b1": back[1]}
            slopes |= {f"w{i}{j}": f"x{i} * {back[j]}" for i in range(3) for j in range(2)}
            means = ", ".join(f"avg({d}) AS g_{name}" for name, d in slopes.items())
            ctes.append(f"\n{model}_g{t} AS (SELECT {means} FROM {model}_at{t} WHERE NOT held AND batch IN (0, {t + 1}))")
            now, following = momentum[t + 1], 0.9 * (1 - 0.5 * 0.96 ** (0.004 * (t + 2)))
            product *= now
            moments = ", ".join(
                f"{n}, g_{n}, 0.9 * m_{n} + 0.1 * g_{n} AS m_{n}, 0.999 * q_{n} + 0.001 * g_{n} * g_{n} AS q_{n}" for n in names
            )
            ctes.append(f"\n{model}_m{t} AS (SELECT {moments} FROM {model}_{t} CROSS JOIN {model}_g{t})")
            stepped = ", ".join(
                f"{n} - 0.001 * (m_{n} * {following / (1 - product * following)!r} + g_{n} * {(1 - now) / (1 - product)!r}) "
                f"/ (sqrt(q_{n} / {1 - 0.999 ** (t + 1)!r}) + 1e-7) AS {n}, m_{n}, q_{n}"
                for n in names
            )
            ctes.append(f"\n{model}_{t + 1} AS (SELECT {stepped} FROM {model}_m{t})")
    return ctes


def _fit_two_steps() -> str:
    halves = "CASE WHEN place <= ((n * 4) // 5 + 1) // 2 THEN 1 ELSE 2 END"
    parts = [
        f"SELECT '{model}' AS model, '{layer}' AS layer, CAST({i} AS INTEGER) AS i, CAST({j} AS INTEGER) AS j, "
        f"round({name}, 6) + 0.0 AS value FROM {model}_2"
        for model in SMALL_POWERS
        for layer, i, j, name, _ in SMALL_SLOTS
    ]
    return _with(FEATURES, _union(parts), *_small_steps(halves))


def _fit_resumed() -> str:
    parts = []
    for model, p in SMALL_POWERS.items():
        for epoch in (1, 2):
            scale = f"pow(max(mean), {p - 2})"
            train = f"(SELECT round(avg(dev) * {scale}, 6) FROM {model}_at{epoch - 1} WHERE NOT held)"
            val = [f"(SELECT avg(dev) * {scale} FROM {model}_at{e} WHERE held)" for e in (1, 2)]
            parts.append(
                f"SELECT '{model}' AS model, CAST({epoch} AS INTEGER) AS epoch, {train} AS train_loss, "
                f"round({val[epoch - 1]}, 6) AS val_loss, ({val[1]} < {val[0]}) = {epoch == 2} AS kept"
            )
    return _with(FEATURES, _union(parts), *_small_steps("0"))


def _ingest_rejects() -> str:
    return _with(
        CLAIMS,
        "SELECT reason, count(*) AS n, round(sum(CASE WHEN reason = 'accepted' THEN Claim END), 2) AS total FROM "
        "(SELECT Claim, CASE l_orderkey % 10 WHEN 3 THEN 'malformed' WHEN 7 THEN 'malformed' WHEN 5 THEN 'missing Claim' "
        "ELSE 'accepted' END AS reason FROM claims) GROUP BY reason",
    )


def _publish_twice() -> str:
    return _with(
        SILVER,
        "SELECT reader, AccYear, count(*) AS n, round(sum(Claim), 2) AS total FROM silver "
        "JOIN (VALUES ('before', 1996), ('after', 9999)) r(reader, year) ON AccYear <= year GROUP BY reader, AccYear",
    )


def _large_codes() -> str:
    return _with(
        SILVER,
        "SELECT Id, dense_rank() OVER (ORDER BY concat(l_partkey, '-', l_orderkey)) AS PolicyCode, "
        "dense_rank() OVER (ORDER BY MaritalStatus) AS MaritalStatusCode FROM silver",
    )


def _glm_scores() -> str:
    names = ["intercept", *(f for f in schema.MODEL_FEATURES if f != "Marital1")]
    models = ", ".join(f"('{m}')" for m in GLM_POWERS)
    features = ", ".join(f"('{f}')" for f in names)
    return (
        f"SELECT model, feature, CAST(0 AS DOUBLE) AS score FROM (VALUES {models}) m(model), "
        f"(VALUES {features}) f(feature)"
    )


def _repeated() -> str:
    wide = ", ".join(f"max(CASE WHEN key = '{k}' THEN value END) AS {k}" for k in schema.METRICS)
    return _with(
        FEATURES,
        "SELECT experiment, * EXCLUDE (experiment, attempt), rank() OVER (PARTITION BY experiment ORDER BY test_p2) AS place "
        f"FROM (SELECT model AS run_name, {wide} FROM metrics GROUP BY model), "
        "(VALUES ('first'), ('second')) e(experiment), (VALUES (1), (2)) a(attempt)",
        *_network(),
        f"\nmetrics AS ({_metrics(['null_model', 'ffn_fixed'], 'scored')})",
    )


def _design() -> str:
    return _union(
        [
            f"SELECT Id, CAST({i} AS INTEGER) AS position, round(CAST({f} AS DOUBLE), 6) AS value FROM features"
            for i, f in enumerate(schema.MODEL_FEATURES)
        ]
    )


def _attention() -> str:
    return _union(
        [
            f"SELECT Id, CAST({j} AS INTEGER) AS position, round(b{j}, 6) AS beta FROM net_attention"
            for j in range(len(schema.MODEL_FEATURES))
        ]
    )


def _group_means() -> str:
    return _union(
        [
            f"SELECT '{c}' AS feature, {c} AS level, round(avg(Claim), 2) AS fitted "
            f"FROM base WHERE split = 'learn' GROUP BY {c}"
            for c in GLM_GROUPS
        ]
    )


def _comparison() -> str:
    groups = [
        f"\nmean_{c} AS (SELECT {c} AS level, avg(Claim) AS fitted FROM base WHERE split = 'learn' GROUP BY {c})"
        for c in ("Gender", "MaritalStatus")
    ]
    joined = """
all_scored AS (
  SELECT s.*, g.fitted AS glm_Gender, m.fitted AS glm_MaritalStatus
  FROM scored s JOIN mean_Gender g ON s.Gender = g.level
    JOIN mean_MaritalStatus m ON s.MaritalStatus = m.level)"""
    models = ["null_model", "ffn_fixed", "localglm_fixed", "glm_Gender", "glm_MaritalStatus"]
    wide = ", ".join(f"max(CASE WHEN key = '{k}' THEN value END) AS {k}" for k in schema.METRICS)
    return _with(
        FEATURES,
        "SELECT *, rank() OVER (ORDER BY test_p2) AS place FROM ("
        "SELECT 'severity' AS experiment, model AS run_id, "
        "CASE model WHEN 'null_model' THEN 'Constant' ELSE model END AS run_name, "
        f"{wide} FROM metrics GROUP BY model)",
        *_network(),
        *groups,
        joined,
        f"\nmetrics AS ({_metrics(models, 'all_scored')})",
    )


CURVE = f"""
curve AS (
  SELECT epoch, 2 * (ty / mu - 1 + ln(mu) - tl) AS train_loss, 2 * (vy / mu - 1 + ln(mu) - vl) AS val_loss
  FROM (
    SELECT *, ty * (0.5 + epoch / {CURVE_POINTS}.0) AS mu FROM (
      SELECT avg(Claim) FILTER (NOT is_validation) AS ty, avg(ln(Claim)) FILTER (NOT is_validation) AS tl,
        avg(Claim) FILTER (is_validation) AS vy, avg(ln(Claim)) FILTER (is_validation) AS vl
      FROM validated)
    CROSS JOIN (SELECT CAST(range AS INTEGER) AS epoch FROM range(1, {CURVE_POINTS + 1}))))"""


def all_oracles() -> dict[str, str]:
    nn = [f for f in schema.MODEL_FEATURES if f.endswith("NN")]
    network = _network()
    null_scored = f"\nscored AS (SELECT *, {NULL_MEAN} AS null_model FROM features)"
    three = _metrics(["null_model", "ffn_fixed", "localglm_fixed"], "scored")
    return {
        "severity_by_year": _with(
            CLAIMS,
            "SELECT AccYear, count(*) AS claims, round(avg(Claim), 4) AS mean_claim FROM claims "
            "WHERE AccYear > 1995 AND HoursWorkedPerWeek > 0 GROUP BY AccYear",
        ),
        "bronze_scan": _with(CLAIMS, f"SELECT {KEY}, {RAW} FROM claims"),
        "ingest_scan": _with(CLAIMS, f"SELECT {RAW} FROM claims"),
        "silver_from_bronze": _with(SILVER, f"SELECT {KEY}, {RAW}, Id FROM silver"),
        "database_cycle": _with(CLAIMS, "SELECT Gender, count(*) AS n FROM claims GROUP BY Gender"),
        "silver_by_path": _with(SILVER, f"SELECT {KEY}, {RAW}, Id FROM silver"),
        "schema_report": _schema_report(),
        "preview_week_counts": _with(
            SILVER,
            "SELECT acc_week, rep_week, count(*) AS nr FROM weeks GROUP BY ALL "
            "ORDER BY acc_week, rep_week LIMIT 6",
            WEEKS,
        ),
        "preview_week_means": _with(
            SILVER,
            "SELECT acc_week, round(avg(RepDelay_week), 4) AS mm FROM weeks GROUP BY acc_week "
            "ORDER BY acc_week LIMIT 6",
            WEEKS,
        ),
        "silver_claims": _with(SILVER, f"SELECT {KEY}, {RAW}, Id FROM silver"),
        "dense_ids": _with(SILVER, f"SELECT Id, Claim, {KEY} FROM silver"),
        "small_claim_filter": _with(SILVER, "SELECT Id, Claim FROM silver WHERE Claim <= 10000"),
        "split_assignment": _with(BASE, "SELECT Id, split, shuffle_key FROM base"),
        "split_by_sets": _with(BASE, "SELECT Id, split FROM base"),
        "split_sizes": _with(BASE, "SELECT split, count(*) AS n FROM base GROUP BY split"),
        "split_means": _with(
            BASE, "SELECT split, round(sum(Claim) / count(Claim), 0) AS mean_claim FROM base GROUP BY split"
        ),
        "split_quantiles": _with(
            BASE,
            _union(
                [
                    f"SELECT split, CAST({p} AS DOUBLE) AS prob, round(quantile_cont(Claim, {p}), 4) AS quantile "
                    "FROM base GROUP BY split"
                    for p in schema.SPLIT_PROBS
                ]
            ),
        ),
        "split_quantiles_large": _with(
            BASE,
            _union(
                [
                    f"SELECT split, CAST({p} AS DOUBLE) AS prob, round(quantile_cont(Claim, {p}), 4) AS quantile "
                    "FROM base GROUP BY split"
                    for p in schema.SPLIT_PROBS
                ]
            ),
        ),
        "shuffle_validation": _with(
            BASE, "SELECT Id, shuffle_key, is_validation FROM validated", VALIDATION
        ),
        "clamped_features": _with(
            BASE,
            "SELECT Id, Age, DependentChildren, DependentsOther, WeeklyPay, HoursWorkedPerWeek, "
            "RepDelay, RepDelayCap FROM base",
        ),
        "profile_bins": _with(
            BASE, "SELECT Id, WeeklyPay, HoursWorkedPerWeek, RepDelay FROM binned", BINNED
        ),
        "category_codes": _with(
            BASE, "SELECT Id, GenderCode, MaritalStatusCode, PartTimeFullTimeCode FROM base"
        ),
        "standardized": _with(
            FEATURES, "SELECT Id, " + ", ".join(f"round({n}, 6) AS {n}" for n in nn) + " FROM features"
        ),
        "standardized_lazily": _with(
            SILVER,
            "SELECT Id, round((WeeklyPay - mp) / sp, 4) AS WeeklyPayNN, "
            "round((RepDelay - md) / sd, 4) AS RepDelayNN, round(WeeklyPay / rms, 4) AS WeeklyPayRms, "
            "round(RepDelay - md, 4) AS RepDelayCentered FROM silver CROSS JOIN st",
            "\nst AS (SELECT avg(WeeklyPay) AS mp, stddev_samp(WeeklyPay) AS sp, avg(RepDelay) AS md, "
            "stddev_samp(RepDelay) AS sd, sqrt(sum(WeeklyPay * WeeklyPay) / (count(*) - 1)) AS rms FROM silver)",
        ),
        "minmax_scaled": _with(
            SILVER,
            "SELECT Id, "
            + ", ".join(
                f"round(2 * ({c} - (SELECT min({c}) FROM silver)) / "
                f"CAST((SELECT max({c}) - min({c}) FROM silver) AS DOUBLE) - 1, 6) AS {c}MM"
                for c in ("Age", "WeeklyPay", "RepDelay")
            )
            + " FROM silver",
        ),
        "onehot_marital": _with(
            BASE, "SELECT Id, MaritalStatus, Marital1, Marital2, Marital3 FROM base"
        ),
        "random_features": _with(
            FEATURES, "SELECT Id, round(RandNN, 6) AS RandNN, round(RandUN, 6) AS RandUN FROM features"
        ),
        "design_matrix": _with(FEATURES, _design()),
        "claim_mean": _with(
            SILVER, "SELECT round(avg(Claim), 4) AS mean_claim, count(*) AS n FROM silver"
        ),
        "claim_ranges": _with(BASE, _ranges()),
        "delay_ranges": _with(BASE, _delay_ranges()),
        "table_summary": _with(FEATURES, _summary("features", SUMMARY_COLUMNS)),
        "table_summary_large": _with(FEATURES, _summary("features", SUMMARY_COLUMNS)),
        "net_gradient_fixed": _parameters(lambda _, g, p: f"{g} * pow(max(m), {p - 2})"),
        "nadam_step_fixed": _parameters(lambda start, g, _: _nadam(start, g)),
        "glm_score": _glm_scores(),
        "fit_two_steps": _fit_two_steps(),
        "fit_resumed": _fit_resumed(),
        "publish_twice": _publish_twice(),
        "ingest_rejects": _ingest_rejects(),
        "large_category_codes": _large_codes(),
        "repeated_runs": _repeated(),
        "claim_summary": _with(SILVER, _summary("silver", ["Claim"])),
        "level_counts": _with(BASE, _levels(schema.CATEGORICAL, "base", "count(*) AS n")),
        "sketch_quantiles": _with(
            SILVER,
            _union(
                [
                    f"SELECT '{c}' AS feature, {p}::DOUBLE AS prob, count({c}) AS n, TRUE AS \"within\" FROM silver"
                    for c in SKETCHED
                    for p in schema.SPLIT_PROBS
                ]
            ),
        ),
        "sketch_distinct": _with(
            SILVER,
            _union(
                [
                    f"SELECT AccYear, '{c}' AS feature, count({c}) AS n, count(DISTINCT {c}) AS exact, "
                    'TRUE AS "within" FROM silver GROUP BY AccYear'
                    for c in SKETCHED
                ]
            ),
        ),
        "distinct_counts": _with(
            BASE,
            _union(
                [
                    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM base"
                    for c in schema.PROFILE_FEATURES
                ]
            ),
        ),
        "claim_grid": _with(
            SILVER,
            "SELECT CAST(range AS INTEGER) AS i, round(lo + range / 100.0 * (hi - lo), 6) AS x FROM "
            "(SELECT min(ln(Claim)) AS lo, max(ln(Claim)) AS hi FROM silver) CROSS JOIN range(101)",
        ),
        "transforms": _with(
            SILVER,
            "SELECT Id, round(ln(Claim), 6) AS log_claim, "
            "round(pow(Claim, 1.0::DOUBLE / 3), 6) AS cube_root_claim FROM silver",
        ),
        "delay_weeks": _with(SILVER, "SELECT Id, acc_week, rep_week, RepDelay_week FROM weeks", WEEKS),
        "week_counts": _with(
            SILVER, "SELECT acc_week, rep_week, count(*) AS nr FROM weeks GROUP BY acc_week, rep_week", WEEKS
        ),
        "week_mean_delay": _with(
            SILVER, "SELECT acc_week, round(avg(RepDelay_week), 4) AS mm FROM weeks GROUP BY acc_week", WEEKS
        ),
        "delay_quantiles": _with(
            SILVER,
            _union(
                [
                    f"SELECT CAST({p} AS DOUBLE) AS prob, "
                    f"round(quantile_cont(CAST(RepDelay_week AS DOUBLE), {p}), 4) AS quantile FROM weeks"
                    for p in sorted({*schema.DELAY_PROBS, *schema.DELAY_LINE_PROBS})
                ]
            ),
            WEEKS,
        ),
        "reporting_scatter": _with(
            SILVER,
            "SELECT c.acc_week, c.rep_week, c.rep_week - c.acc_week AS x, "
            "(SELECT max(acc_week) FROM weeks) - c.acc_week AS y, nr, mm FROM "
            "(SELECT acc_week, rep_week, count(*) AS nr FROM weeks GROUP BY ALL) c JOIN "
            "(SELECT acc_week, round(avg(RepDelay_week), 4) AS mm FROM weeks GROUP BY acc_week) m "
            "ON c.acc_week = m.acc_week",
            WEEKS,
        ),
        "marginal_profile": _with(
            BASE,
            _levels(
                schema.PROFILE_FEATURES, "binned", "count(*) AS vol, round(avg(Claim), 4) AS avg"
            ),
            BINNED,
        ),
        "uniform_reference": _with(
            BASE,
            _union(
                [
                    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS levels, "
                    f"round(count(*) / count(DISTINCT {c}), 4) AS global_n FROM binned"
                    for c in schema.PROFILE_FEATURES
                ]
            ),
            BINNED,
        ),
        "pearson_matrix": _with(BASE, _pearson("base")),
        "spearman_matrix": _with(BASE, _pearson("ranks"), "\n" + _ranks()),
        "kde_claim": _kde("Claim", "WHERE Claim <= 10000"),
        "kde_log": _kde("ln(Claim)"),
        "kde_cuberoot": _kde("pow(Claim, 1.0::DOUBLE / 3)"),
        "ecdf_survival": _with(
            SILVER,
            "SELECT x, cnt, round(ecdf, 6) AS ecdf, round(log_x, 6) AS log_x, "
            "round(log_survival, 6) AS log_survival FROM points",
            ECDF,
        ),
        "local_regression": _with(
            SILVER,
            "SELECT i, round(x0, 6) AS x, round("
            "(t0*(s2*s4 - s3*s3) - s1*(t1*s4 - s3*t2) + s2*(t1*s3 - s2*t2)) / "
            "(s0*(s2*s4 - s3*s3) - s1*(s1*s4 - s2*s3) + s2*(s1*s3 - s2*s2)), 6) AS fit FROM moments",
            ECDF,
            *LOCAL,
        ),
        "local_regression_exact": _with(
            SILVER,
            "SELECT i, round(x0, 6) AS x, round("
            "(t0*(s2*s4 - s3*s3) - s1*(t1*s4 - s3*t2) + s2*(t1*s3 - s2*t2)) / "
            "(s0*(s2*s4 - s3*s3) - s1*(s1*s4 - s2*s3) + s2*(s1*s3 - s2*s2)), 6) AS fit FROM moments",
            ECDF,
            LOCAL[0],
            EVERY_POINT,
            *LOCAL[2:],
        ),
        "null_model_losses": _with(FEATURES, _metrics(["null_model"], "scored"), null_scored),
        "square_loss_null": _with(
            FEATURES,
            "SELECT split, round(avg((Claim - null_model) * (Claim - null_model)), 2) AS square_loss "
            "FROM scored GROUP BY split",
            null_scored,
        ),
        "ffn_forward_fixed": _with(
            FEATURES, "SELECT Id, round(ffn_fixed, 4) AS mu FROM scored", *network
        ),
        "localglm_forward_fixed": _with(
            FEATURES, "SELECT Id, round(localglm_fixed, 4) AS mu FROM scored", *network
        ),
        "localglm_attention_fixed": _with(FEATURES, _attention(), *network[:-1]),
        "loss_report_fixed": _with(FEATURES, three, *network),
        "calibration": _with(
            FEATURES,
            _levels(
                schema.CALIBRATION_FEATURES,
                "tested",
                "count(*) AS n, round(avg(Claim), 4) AS obs, round(avg(ffn_fixed), 4) AS pred_ffn_fixed, "
                "round(avg(localglm_fixed), 4) AS pred_localglm_fixed",
            ),
            *network,
            "\ntested AS (SELECT * FROM scored WHERE split = 'test')",
        ),
        "batch_scoring": _with(
            FEATURES,
            "SELECT split, count(*) AS n, round(avg(localglm_fixed), 4) AS mean_prediction "
            "FROM scored GROUP BY split",
            *network,
        ),
        "glm_saturated_groups": _with(BASE, _group_means()),
        "model_comparison": _comparison(),
        "run_log": _with(
            FEATURES,
            "SELECT 'severity' AS experiment, 'null_model' AS run_id, 'Constant' AS run_name, "
            "'metric' AS kind, key, value FROM metrics UNION ALL "
            "SELECT 'severity', 'null_model', 'Constant', 'param', key, value FROM (VALUES "
            f"('epochs', {schema.EPOCHS}.0::DOUBLE), ('batch_size', {schema.BATCH_SIZE}.0::DOUBLE), "
            f"('validation_split', {schema.VALIDATION_SPLIT}::DOUBLE)) AS p(key, value)",
            null_scored,
            f"\nmetrics AS ({_metrics(["null_model"], "scored")})",
        ),
        "loss_curve_long": _with(
            BASE,
            "SELECT epoch, 'train_loss' AS variable, round(train_loss, 6) AS loss FROM curve UNION ALL "
            "SELECT epoch, 'val_loss', round(val_loss, 6) FROM curve",
            VALIDATION,
            CURVE,
        ),
        "best_epoch": _with(
            BASE,
            "SELECT epoch, round(val_loss, 6) AS val_loss FROM curve ORDER BY curve.val_loss, epoch LIMIT 1",
            VALIDATION,
            CURVE,
        ),
        "hash_values": _with(SILVER, f"SELECT Id, {_hash(S, 'Id')} AS hash FROM silver"),
    }
