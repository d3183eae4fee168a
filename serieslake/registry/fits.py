"""SQL of the fair-value fits: windows, regressions, sign check with one refit, unit-root tests.

Written for the oracles alone, from the rows of every window: centred moments by aggregates, the
regression as a recursion of pivots over a flat matrix, the unit-root test from the residuals' own lags.
"""

from __future__ import annotations

from serieslake.plans.regression import CRITICAL, LARGE_P, SMALL_P, TAU_MAX, TAU_MIN, TAU_SPLIT
from serieslake.plans.universes import CHINA_DRIVERS, FX_CHN, UNIVERSES

K = len(CHINA_DRIVERS)
SIDE = K + 1
PARAMETERS = "par AS (SELECT * FROM (VALUES {}) AS p(universe, k, months, need, ratio, threshold, significance, signs))".format(
    ", ".join(
        f"('{u.name}', {len(u.drivers)}, {u.window_months}, {u.min_observations}, {float(u.stop_reward_ratio)}::DOUBLE,"
        f" {u.z_threshold}::DOUBLE, {u.cointegration_significance}::DOUBLE,"
        f" [{', '.join(str(u.expected_signs.get(d, 0)) for d in FX_CHN.drivers)}])"
        for u in UNIVERSES.values()
    )
)
LAST_DAYS = """fitdays AS (SELECT series_code, universe, max(d) AS as_of FROM features GROUP BY 1, 2)"""
EVERY_DAY = """fitdays AS (SELECT series_code, universe, d AS as_of FROM features)"""


def last_dates(count: int, as_of: str) -> str:
    """The universe's last days up to ``as_of``, for all of its pairs."""
    return f"""fitdays AS (
  SELECT series_code, universe, as_of FROM (SELECT DISTINCT series_code, universe FROM features)
  JOIN (SELECT universe, d AS as_of, row_number() OVER (PARTITION BY universe ORDER BY d DESC) AS place
        FROM (SELECT DISTINCT universe, d FROM features WHERE d <= DATE '{as_of}'))
  USING (universe) WHERE place <= {count})"""


_ROWS = f"""cells AS (
  SELECT series_code, universe, d, rate, is_logged, [{", ".join(CHINA_DRIVERS)}] AS xs FROM features),
win AS (
  SELECT f.series_code, f.universe, f.as_of, c.d, c.rate, c.xs[1:p.k] AS xs, p.k, p.need, p.signs,
         arg_max(c.is_logged, c.d) OVER (PARTITION BY f.series_code, f.universe, f.as_of) AS logged
  FROM fitdays f JOIN par p ON f.universe = p.universe
  JOIN cells c ON c.series_code = f.series_code AND c.universe = f.universe AND c.d <= f.as_of
    AND c.d > f.as_of - to_months(p.months)),
resp AS (SELECT *, CASE WHEN logged THEN CASE WHEN rate > 0 THEN ln(rate) END ELSE rate END AS y FROM win),
tops AS (SELECT series_code, universe, as_of, any_value(logged) AS logged, any_value(k) AS k, any_value(need) AS need,
                any_value(signs) AS signs, last(rate ORDER BY d) AS current_rate, max(d) AS last_day
         FROM resp GROUP BY 1, 2, 3)"""


def _cell(place: int) -> str:
    return "y" if place == K else f"xs[{place + 1}]"


def _fit(name: str, rows: str) -> str:
    """CTEs of one fit over complete rows: moments, pivots, solution ``{name}``.

    ``rows`` selects resp's rows with ``used`` (places of the drivers that take part). A missing place
    counts as zero and is never a pivot.
    """
    value = [f"coalesce({_cell(i)}, 0)" if i < K else "y" for i in range(SIDE)]
    covariances = ", ".join(
        f"covar_pop({value[min(i, j)]}, {value[max(i, j)]})" for i in range(SIDE) for j in range(SIDE)
    )
    pivot = f"m[({SIDE} + 1) * (step - 1) + 1]"
    cell = f"""CASE WHEN e // {SIDE} = step - 1 AND e % {SIDE} = step - 1 THEN 1 / {pivot}
      WHEN e // {SIDE} = step - 1 THEN m[e + 1] / {pivot}
      WHEN e % {SIDE} = step - 1 THEN -m[e + 1] / {pivot}
      ELSE m[e + 1] - m[(e // {SIDE}) * {SIDE} + step] * m[(step - 1) * {SIDE} + e % {SIDE} + 1] / {pivot} END"""
    return f"""{name}_rows AS ({rows}),
{name}_mom AS (
  SELECT series_code, universe, as_of, any_value(used) AS used, count(*) AS n,
         [{", ".join(f"avg({v})" for v in value)}] AS means, [{covariances}] AS m0,
         arg_max(xs, d) AS last_xs, arg_max(y, d) AS last_y
  FROM {name}_rows GROUP BY 1, 2, 3 HAVING count(*) >= any_value(need)),
{name}_sw AS (
  SELECT series_code, universe, as_of, used, 1 AS step, m0 AS m FROM {name}_mom
  UNION ALL
  SELECT series_code, universe, as_of, used, step + 1, CASE WHEN list_contains(used, step)
    THEN list_transform(range({SIDE * SIDE}), lambda e: {cell}) ELSE m END
  FROM {name}_sw WHERE step <= {K}),
{name} AS (
  SELECT a.*, s.m, list_transform(range(1, {K + 1}), lambda j: CASE WHEN list_contains(a.used, j)
           THEN s.m[j * {SIDE}] END) AS slopes
  FROM {name}_mom a JOIN {name}_sw s USING (series_code, universe, as_of) WHERE step = {K + 1})"""


_FIRST = _fit(
    "one", "SELECT *, range(1, k + 1) AS used FROM resp WHERE y IS NOT NULL AND len(list_filter(xs, lambda x: x IS NOT NULL)) = k"
)
_KEPT = """kept AS (
  SELECT o.series_code, o.universe, o.as_of, list_filter(o.used, lambda j: NOT (o.slopes[j] * t.signs[j] < 0)) AS used
  FROM one o JOIN tops t USING (series_code, universe, as_of))"""
_SECOND = _fit(
    "two",
    """SELECT r.*, h.used FROM resp r JOIN kept h USING (series_code, universe, as_of)
    WHERE y IS NOT NULL AND len(h.used) > 0
      AND len(list_filter(h.used, lambda j: r.xs[j] IS NOT NULL)) = len(h.used)""",
)
_PLACES = f"list_filter(range(0, {K}), lambda j: slopes[j + 1] IS NOT NULL)"
_QUADRATIC = f"""list_sum(list_transform({_PLACES}, lambda i: list_sum(list_transform({_PLACES}, lambda j:
    means[i + 1] * m[i * {SIDE} + j + 1] * means[j + 1]))))"""


def _tail(ratio: str) -> str:
    """Two-sided tail of Student's t by its finite series, factorials through gamma functions."""
    square = f"(free / (free + ({ratio}) * ({ratio})))"
    angle = f"atan(abs({ratio}) / sqrt(free))"
    odd = f"""2 / pi() * ({angle} + sin({angle}) * cos({angle}) * coalesce(list_sum(list_transform(
        range(0, (free - 1) // 2), lambda q: exp(q * ln(4) + 2 * lgamma(q + 1) - lgamma(2 * q + 2) + q * ln({square})))), 0))"""
    even = f"""sin({angle}) * coalesce(list_sum(list_transform(range(0, free // 2),
        lambda q: exp(lgamma(2 * q + 1) - 2 * lgamma(q + 1) - q * ln(4) + q * ln({square})))), 0)"""
    return f"CASE WHEN free > 0 AND ({ratio}) IS NOT NULL THEN greatest(1 - CASE WHEN free % 2 = 1 THEN {odd} ELSE {even} END, 0) END"


_NAMES = ("const", *CHINA_DRIVERS)
_SOLVED = f"""sol AS (
  SELECT *, last_day = as_of AS on_grid, n - len(used) - 1 AS free,
    means[{SIDE}] - list_sum(list_transform({_PLACES}, lambda j: slopes[j + 1] * means[j + 1])) AS b_const,
    greatest(m[{SIDE * SIDE}], 0) AS left_over, m0[{SIDE * SIDE}] AS variance,
    {", ".join(f"slopes[{j + 1}] AS b_{d}" for j, d in enumerate(CHINA_DRIVERS))}
  FROM two JOIN tops USING (series_code, universe, as_of)),
est AS (
  SELECT *, b_const + list_sum(list_transform({_PLACES}, lambda j: slopes[j + 1] * last_xs[j + 1])) AS fitted_value,
    last_y AS actual_value, sqrt(left_over) AS residual_std, 1 - left_over / variance AS r_squared,
    sqrt(left_over / free * (1 + {_QUADRATIC})) AS se_const,
    {", ".join(f"CASE WHEN b_{d} IS NOT NULL THEN sqrt(left_over / free * m[{j * (SIDE + 1) + 1}]) END AS se_{d}" for j, d in enumerate(CHINA_DRIVERS))},
    array_to_string(list_transform(list_filter(range(1, k + 1), lambda j: NOT list_contains(used, j)),
      lambda j: [{", ".join(f"'{d}'" for d in CHINA_DRIVERS)}][j]), ',') AS dropped_variables
  FROM sol),
fits AS (
  SELECT *, (actual_value - fitted_value) / residual_std AS z_score,
    {", ".join(f"{_tail(f'b_{d} / se_{d}')} AS p_{d}" for d in _NAMES)}
  FROM est)"""


def _lagged(name: str, rows: str) -> str:
    """CTEs that sweep the regression of ``rows``: (keys, t, q, list v of the q variables)."""
    pivot = "m[(q + 1) * step + 1]"
    cell = f"""CASE WHEN e // q = step AND e % q = step THEN 1 / {pivot}
      WHEN e // q = step THEN m[e + 1] / {pivot} WHEN e % q = step THEN -m[e + 1] / {pivot}
      ELSE m[e + 1] - m[(e // q) * q + step + 1] * m[step * q + e % q + 1] / {pivot} END"""
    return f"""{name}_rows AS ({rows}),
{name}_long AS (SELECT series_code, universe, as_of, t, q, unnest(v) AS v, unnest(range(0, q)) AS a FROM {name}_rows),
{name}_mom AS (
  SELECT series_code, universe, as_of, q, n, list(total ORDER BY a, b) AS m0 FROM (
    SELECT x.series_code, x.universe, x.as_of, x.q, x.a, z.a AS b, sum(x.v * z.v) AS total, count(*) AS n
    FROM {name}_long x JOIN {name}_long z USING (series_code, universe, as_of, t) GROUP BY ALL) GROUP BY 1, 2, 3, 4, 5),
{name}_sw AS (
  SELECT series_code, universe, as_of, q, n, 0 AS step, m0 AS m FROM {name}_mom
  UNION ALL
  SELECT series_code, universe, as_of, q, n, step + 1, list_transform(range(q * q), lambda e: {cell})
  FROM {name}_sw WHERE step < q - 1)"""


_VARIABLES = """[1::DOUBLE, es[t]] || list_transform(range(1, lags + 1), lambda j: es[t - j + 1] - es[t - j])
      || [es[t + 1] - es[t]]"""
_NORMAL = """CASE WHEN x < -8 THEN 0 WHEN x > 8 THEN 1 ELSE 0.5 + sign(x) * exp(-x * x / 2) / sqrt(2 * pi())
    * list_sum(list_transform(range(0, 150), lambda i: exp((2 * i + 1) * ln(greatest(abs(x), 1e-300))
        + i * ln(2) + lgamma(i + 1) - lgamma(2 * i + 2)))) END"""


def _polynomial(terms: tuple[float, ...]) -> str:
    return " + ".join(f"({c}::DOUBLE) * statistic ** {i}" for i, c in enumerate(terms))


def critical_sql(level: str) -> str:
    return " + ".join(f"({c}::DOUBLE) / root_n ** {i}" for i, c in enumerate(CRITICAL[level]))


RESIDUALS = f"""resid AS (
  SELECT r.series_code, r.universe, r.as_of, list(r.y - (o.means[{SIDE}] + list_sum(list_transform(range(1, r.k + 1),
      lambda j: o.slopes[j] * (r.xs[j] - o.means[j])))) ORDER BY r.d) AS es
  FROM one_rows r JOIN one o USING (series_code, universe, as_of) JOIN tested USING (series_code, universe, as_of)
  GROUP BY 1, 2, 3)"""
TESTS = (
    """lens AS (SELECT *, len(es) AS size,
  least(ceil(12 * (len(es) / 100) ** 0.25)::INTEGER, len(es) // 2 - 2) AS lags FROM resid)""",
    _lagged(
        "long_lags",
        f"""SELECT series_code, universe, as_of, t, lags + 3 AS q, {_VARIABLES} AS v
  FROM (SELECT *, unnest(range(lags + 1, size)) AS t FROM lens)""",
    ),
    """best AS (
  SELECT series_code, universe, as_of, arg_min(step - 2, (n * ln(greatest(m[q * q], 0) / n) + ln(n) * step, step)) AS lags
  FROM long_lags_sw WHERE step >= 2 GROUP BY 1, 2, 3)""",
    _lagged(
        "final_lags",
        f"""SELECT series_code, universe, as_of, t, lags + 3 AS q, {_VARIABLES} AS v
  FROM (SELECT l.series_code, l.universe, l.as_of, l.es, b.lags, unnest(range(b.lags + 1, size)) AS t
        FROM lens l JOIN best b USING (series_code, universe, as_of))""",
    ),
    f"""roots AS (
  SELECT series_code, universe, as_of, n AS root_n,
         m[2 * q] / sqrt(m[q * q] / (n - q + 1) * m[q + 2]) AS statistic
  FROM final_lags_sw WHERE step = q - 1),
tails AS (SELECT *, CASE WHEN statistic <= {TAU_SPLIT} THEN {_polynomial(SMALL_P)} ELSE {_polynomial(LARGE_P)} END AS x FROM roots),
tests AS (
  SELECT series_code, universe, as_of, root_n, statistic,
         CASE WHEN statistic > {TAU_MAX} THEN 1 WHEN statistic < {TAU_MIN} THEN 0 ELSE {_NORMAL} END AS p FROM tails)""",
)
FITS = (PARAMETERS, _ROWS, _FIRST, _KEPT, _SECOND, _SOLVED)


def with_views(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def figure(expression: str, digits: int = 5) -> str:
    """A number to so many digits after the first, as the queries show it."""
    return f"(printf('%.{digits}e', {expression})::DOUBLE + 0)"


NUMBERS = ("fitted_value", "actual_value", "residual_std", "r_squared")


def number_columns(digits: int = 5) -> str:
    """Coefficients, standard errors and p-values of ``fits``, as the queries show them."""
    return ", ".join(
        [
            *[f"{figure(f'b_{n}', digits)} AS coefficient_{n}" for n in _NAMES],
            *[f"{figure(f'se_{n}', digits)} AS standard_error_{n}" for n in _NAMES],
            *[f"round(p_{n}, {digits}) + 0 AS p_value_{n}" for n in _NAMES],
        ]
    )


def estimate_sql(digits: int = 5, tested: bool = True) -> str:
    """Every fit with a window, as :func:`serieslake.plans.estimation.estimate` gives it."""
    shown = ", ".join(f"{figure(f'f.{n}', digits)} AS {n}" for n in NUMBERS)
    text = f"""SELECT t.series_code, t.universe, t.as_of::DATE AS as_of,
      CASE WHEN f.n IS NULL THEN 'insufficient_data' ELSE 'ok' END AS status, t.logged AS is_logged,
      {figure("t.current_rate", digits)} AS current_rate, {shown}, round(f.z_score, {digits}) + 0 AS z_score,
      f.n AS n_obs, f.dropped_variables, {number_columns(digits)}"""
    if tested:
        text += f""",
      coalesce(x.p <= par.significance, false) AS cointegration_passed, round(x.p, {digits}) + 0 AS cointegration_p_value,
      {figure("x.statistic", digits)} AS cointegration_statistic, {critical_columns(digits)},
      o.n AS cointegration_n_obs"""
    text += """
    FROM tops t LEFT JOIN fits f USING (series_code, universe, as_of)"""
    if tested:
        text += """
      JOIN par ON par.universe = t.universe LEFT JOIN one o USING (series_code, universe, as_of)
      LEFT JOIN tests x USING (series_code, universe, as_of)"""
    return text


def critical_columns(digits: int = 5) -> str:
    return ", ".join(
        f"{figure(critical_sql(level), digits)} AS critical_{level.rstrip('%')}pct" for level in CRITICAL
    )


EACH_TESTED = "tested AS (SELECT series_code, universe, as_of FROM one)"
#: Only the newest date, for pairs that have a row there.
NEWEST_TESTED = """tested AS (
  SELECT series_code, universe, as_of FROM one JOIN tops USING (series_code, universe, as_of)
  JOIN (SELECT universe, max(as_of) AS as_of FROM fitdays GROUP BY 1) USING (universe, as_of) WHERE last_day = as_of)"""
EACH_VERDICT = """verdict AS (
  SELECT series_code, universe, as_of, coalesce(p <= significance, false) AS passed, p
  FROM fits JOIN par USING (universe) LEFT JOIN tests USING (series_code, universe, as_of))"""
#: The newest date's verdict for all dates of a pair; a pair that was not tested has failed.
NEWEST_VERDICT = """verdict AS (
  SELECT f.series_code, f.universe, f.as_of, coalesce(x.p <= significance, false) AS passed, x.p
  FROM fits f JOIN par ON f.universe = par.universe
  LEFT JOIN tests x ON x.series_code = f.series_code AND x.universe = f.universe)"""
FIRED = """fired AS (
  SELECT *, CASE WHEN signal <> 'NONE' THEN level_value END AS target FROM (
    SELECT f.*, v.passed, v.p, p.threshold, p.ratio,
      CASE WHEN f.logged THEN exp(f.fitted_value) ELSE f.fitted_value END AS level_value,
      CASE WHEN NOT v.passed OR abs(f.z_score) < p.threshold THEN 'NONE' WHEN f.z_score > 0 THEN 'SELL' ELSE 'BUY' END AS signal
    FROM fits f JOIN verdict v USING (series_code, universe, as_of) JOIN par p ON p.universe = f.universe)),
stops AS (
  SELECT *, CASE signal WHEN 'SELL' THEN current_rate + abs(current_rate - target) / ratio
    WHEN 'BUY' THEN current_rate - abs(current_rate - target) / ratio END AS stop_loss,
    CASE WHEN NOT passed THEN 'cointegration failed (p=' || coalesce(printf('%.4f', p), 'nan') || ')'
         WHEN abs(z_score) < threshold THEN '|z|=' || printf('%.2f', abs(z_score)) || ' below threshold ' || threshold
         ELSE '|z|=' || printf('%.2f', abs(z_score)) || ' >= threshold ' || threshold || ', cointegrated' END AS reason
  FROM fired)"""
CROSS_SECTION = f"""SELECT series_code, universe, as_of::DATE AS as_of, logged AS is_logged,
  round(z_score, 5) + 0 AS z_score, {figure("level_value")} AS fair_value, dropped_variables,
  passed AS cointegration_passed, {figure("target")} AS upper, {figure("stop_loss")} AS lower,
  CAST(NULL AS VARCHAR) AS markov_state, {number_columns()}
FROM stops"""
SIGNAL_ROWS = f"""SELECT as_of::DATE AS "date", universe, series_code, signal, round(z_score, 5) + 0 AS entry_z_score,
  {figure("target")} AS target, {figure("stop_loss")} AS stop_loss, reason FROM stops"""
_RAW_DRIVERS = [f"xs[{j + 1}]" for j in range(K)]
WINDOW_ROWS = f"""SELECT series_code, universe, as_of::DATE AS as_of, d::TIMESTAMP AS "date", {figure("spot")} AS spot,
  {", ".join(f"{figure(x)} AS {d}" for x, d in zip(_RAW_DRIVERS, CHINA_DRIVERS))},
  {figure("y")} AS response, {figure("fitted")} AS fitted,
  {figure("CASE WHEN logged THEN exp(fitted) ELSE fitted END")} AS fair_value,
  round(y - fitted, 5) + 0 AS residual, {figure("fitted + threshold * residual_std")} AS upper_bound,
  {figure("fitted - threshold * residual_std")} AS lower_bound
FROM (SELECT r.series_code, r.universe, r.as_of, r.d, r.rate AS spot, r.xs, r.y, f.logged, f.residual_std, p.threshold,
        f.b_const + list_sum(list_transform(f.used, lambda j: f.slopes[j] * r.xs[j])) AS fitted
      FROM two_rows r JOIN fits f USING (series_code, universe, as_of) JOIN par p ON p.universe = r.universe)"""
DESIGN_ROWS = f"""SELECT series_code, universe, as_of::DATE AS as_of, d::TIMESTAMP AS "date", 1.0::DOUBLE AS const,
  {", ".join(f"CASE WHEN list_contains(used, {j + 1}) THEN {figure(x)} END AS {d}" for j, (x, d) in enumerate(zip(_RAW_DRIVERS, CHINA_DRIVERS)))}
FROM two_rows JOIN (SELECT series_code, universe, as_of FROM fits) USING (series_code, universe, as_of)"""
PAIR_RESIDUALS = """linked AS (
  SELECT series_code, universe, d, rate AS y, local_equity AS x FROM features
  WHERE d <= DATE '2001-06-29' AND rate IS NOT NULL AND local_equity IS NOT NULL),
lines AS (SELECT series_code, universe, regr_slope(y, x) AS slope, regr_intercept(y, x) AS const, count(*) AS n
  FROM linked GROUP BY 1, 2),
resid AS (SELECT series_code, universe, DATE '2001-06-29' AS as_of, list(y - const - slope * x ORDER BY d) AS es
  FROM linked JOIN lines USING (series_code, universe) WHERE n >= 20 GROUP BY 1, 2)"""
PAIR_TESTS = f"""SELECT series_code, universe, CASE WHEN n < 20 THEN 'insufficient_data' ELSE 'ok' END AS status,
  coalesce(p <= 0.05, false) AS passed, round(p, 5) + 0 AS p_value, {figure("statistic")} AS statistic, n AS n_obs
FROM lines LEFT JOIN tests USING (series_code, universe)"""
