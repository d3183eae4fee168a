"""The fair-value model end to end: one object per universe, and the daily batch run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serieslake.api import DataAPI
from serieslake.operators.quality import drop_failing, failing_keys, gate
from serieslake.operators.periods import last_days
from serieslake.plans import discovery, drivers, estimation, results, signals
from serieslake.plans.universes import CHN, UNIVERSES, Universe
from serieslake.plans.windows import listed_dates
from serieslake.schema import SERIES_CODE, InsufficientDataError
from serieslake.session import cut_lineage

LATEST, EACH = "latest", "each"
#: What names the rows of one run in the written tables.
RUN = ["universe", "date"]


@dataclass(frozen=True)
class FitResults:
    """What one fit produced. ``signals`` has a row per (pair, as_of)."""

    universe: Universe
    features: DataFrame
    signals: DataFrame
    report: DataFrame
    fit_dates: list[date]

    @property
    def blocked(self) -> DataFrame:
        """(series_code, reason) of the pairs that were never fetched."""
        return self.report.filter("blocked").select(
            SERIES_CODE, F.concat(F.lit("blocked: "), F.col("block_reasons")).alias("reason")
        )

    @property
    def summary(self) -> DataFrame:
        return results.cross_section(self.signals)

    @property
    def as_of_dates(self) -> list[date]:
        return sorted(self.fit_dates)

    def resolve(self, as_of: int | str | date | None = None) -> date:
        """A fitted date by position, by value, or the newest one."""
        dates = self.as_of_dates
        if not dates:
            raise LookupError(f"nothing was fitted for {self.universe.name}")
        if as_of is None:
            return dates[-1]
        if isinstance(as_of, int):
            return dates[as_of]
        day = date.fromisoformat(str(as_of)[:10])
        if day not in dates:
            raise KeyError(f"{day} is not a fitted date; fitted: {dates}")
        return day

    def get_cross_section(self, as_of: int | str | date | None = None) -> DataFrame:
        return self.summary.filter(F.col("as_of") == F.lit(self.resolve(as_of)))

    def get(self, series_code: str, as_of: int | str | date | None = None) -> DataFrame:
        """Windowed rows of one pair."""
        day = self.resolve(as_of)
        return self.rows().filter(
            (F.col(SERIES_CODE) == series_code) & (F.col("as_of") == F.lit(day))
        )

    def signal_table(self, as_of: int | str | date | None = None) -> DataFrame:
        day = self.resolve(as_of)
        return results.signal_rows(self.signals).filter(F.col("date") == F.lit(day))

    def rows(self) -> DataFrame:
        """Windowed long rows of every fit."""
        return estimation.fitted_rows(
            self.features, self.signals, self.universe, fit_dates=self.fit_dates
        )

    def panel(self, field: str) -> DataFrame:
        """One column per fitted pair: as many as the universe has pairs."""
        codes = [r[0] for r in self.summary.select(SERIES_CODE).distinct().collect()]
        return results.panel(self.summary, field, sorted(codes))

    def z_scores(self, as_of: int | str | date | None = None) -> DataFrame:
        return results.z_scores(self.get_cross_section(as_of), self.universe.z_threshold)

    def save(self, api: DataAPI) -> None:
        results.save_results(api, self.summary, self.rows())


def resolve_cutover(
    universes: Universe | Mapping[str, Universe], catalog: DataFrame, values: DataFrame
) -> date | None:
    """Regime change of the flows driver; only China needs one, and only if it has flows."""
    names = [universes.name] if isinstance(universes, Universe) else list(universes)
    if CHN not in names or not drivers.flows_complete(values):
        return None
    return drivers.flows_cutover(catalog)


def pair_features(
    catalog: DataFrame,
    values: DataFrame,
    universe: Universe | Mapping[str, Universe],
    *,
    pairs: list[str] | None = None,
    require_real: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(availability report, features) of the pairs of one or several universes."""
    universes = {universe.name: universe} if isinstance(universe, Universe) else universe
    found = discovery.discover_pairs(
        catalog, next(iter(universes)) if len(universes) == 1 else None, require_real=require_real
    )
    report = discovery.availability_report(found.filter(F.col("universe").isin(*universes)), catalog)
    if pairs is not None:
        report = report.filter(F.col(SERIES_CODE).isin(pairs))
    report = cut_lineage(report, "report")
    mapping = drivers.series_mapping(report.filter(~F.col("blocked")))
    cutover = resolve_cutover(universes, catalog, values)
    raw = drivers.raw_driver_frame(values, mapping, cutover=cutover)
    conformed = drivers.conform_drivers(raw)
    return report, drivers.build_features(conformed, universes)


def fit(
    catalog: DataFrame,
    values: DataFrame,
    universe: Universe,
    **options,
) -> FitResults:
    """Fit every unblocked pair of one universe; see :func:`fit_universes`."""
    return fit_universes(catalog, values, {universe.name: universe}, **options)[universe.name]


def fit_universes(
    catalog: DataFrame,
    values: DataFrame,
    universes: Mapping[str, Universe] = UNIVERSES,
    *,
    as_of: date | str | None = None,
    lookback_days: int = 1,
    cointegration: str = LATEST,
    pairs: list[str] | None = None,
) -> dict[str, FitResults]:
    """Fit every unblocked pair at the last ``lookback_days`` business days of its universe up to
    ``as_of``, all universes in one run.

    Each date uses only rows up to that date. ``cointegration='latest'`` tests each pair once,
    at the newest date, and applies the verdict to all dates; ``'each'`` tests every date.
    """
    if cointegration not in (LATEST, EACH):
        raise ValueError(f"cointegration must be {LATEST!r} or {EACH!r}, got {cointegration!r}")
    report, features = pair_features(catalog, values, universes, pairs=pairs)
    features = cut_lineage(features, "features")
    fit_dates = {
        name: sorted(
            row["day"]
            for row in last_days(
                features.filter(F.col("universe") == name), lookback_days, as_of=as_of, day="day"
            ).collect()
        )
        for name in universes
    }
    for name, dates in fit_dates.items():
        if not dates and as_of is not None and not features.filter(F.col("universe") == name).isEmpty():
            raise InsufficientDataError(f"no data on or before {as_of} for {name}")
    newest = {name: dates[-1:] for name, dates in fit_dates.items()}
    estimates = cut_lineage(
        estimation.estimate(
            features, universes, fit_dates=fit_dates, test_dates=newest if cointegration == LATEST else None
        ),
        "estimates",
    )
    if cointegration == LATEST:
        estimates = _spread_verdict(estimates, newest)
    fired = signals.with_signals(
        estimates,
        z_threshold=drivers.by_universe("z_threshold", universes),
        stop_reward_ratio=drivers.by_universe("stop_reward_ratio", universes),
    )
    unused = {
        name: [c for c in fired.columns if c.endswith(tuple(f"_{d}" for d in estimation.all_drivers(universes) if d not in universe.drivers))]
        for name, universe in universes.items()
    }
    of = lambda frame, name: frame.filter(F.col("universe") == name)
    return {
        name: FitResults(
            universe, of(features, name), of(fired, name).drop(*unused[name]), of(report, name), fit_dates[name]
        )
        for name, universe in universes.items()
    }


def _spread_verdict(estimates: DataFrame, newest: Mapping[str, list[date]]) -> DataFrame:
    """Each pair's verdict of its universe's newest date on all its rows; untested pairs have failed."""
    carried = [c for c in estimates.columns if c.startswith(("cointegration_", "critical_"))]
    verdict = estimates.filter(F.array_contains(listed_dates(newest), F.col("as_of"))).select(
        SERIES_CODE, "universe", *carried
    )
    order = estimates.columns
    joined = estimates.drop(*carried).join(verdict, [SERIES_CODE, "universe"], "left")
    return joined.withColumn(
        "cointegration_passed", F.coalesce("cointegration_passed", F.lit(False))
    ).select(*order)


class FairValueModel:
    """A universe bound to a catalog and values."""

    def __init__(self, catalog: DataFrame, values: DataFrame, universe: Universe) -> None:
        self.catalog = catalog
        self.values = values
        self.universe = universe

    @classmethod
    def from_api(cls, api: DataAPI, universe: Universe | str) -> FairValueModel:
        chosen = UNIVERSES[universe] if isinstance(universe, str) else universe
        return cls(api.catalog(), api.values_frame(), chosen)

    def fit(self, **kwargs) -> FitResults:
        return fit(self.catalog, self.values, self.universe, **kwargs)


def run_daily(
    api: DataAPI, universe: Universe, *, as_of: date | str | None = None
) -> dict[str, object]:
    """Availability, silver rows, features, estimates and signals of one universe, written out.

    A pair that is blocked, stale or fails its feature checks is left out; it never fails the
    run. Estimates or signals that break any rule are not written. Every pair is fitted at its
    own newest day, or at ``as_of``.
    """
    catalog, values = api.catalog(), api.values_frame()
    found = discovery.discover_pairs(catalog, universe.name)
    report = discovery.availability_report(found, catalog)
    cutover, cutover_error = None, None
    try:
        cutover = resolve_cutover(universe, catalog, values)
    except ValueError as error:  # reported; the run goes on without a regime change
        cutover_error = str(error)
    raw = cut_lineage(drivers.open_raw(values, report, cutover=cutover), "raw")
    silver = drivers.silver_frame(values, report, as_of=as_of, raw=raw)
    stale = drivers.stale_pairs(
        raw, drivers.moment_of(as_of).cast("timestamp_ntz"), tolerance_days=drivers.TOLERANCE_DAYS
    )
    built = drivers.build_features(silver, {universe.name: universe})
    built = cut_lineage(built, "features")
    rules = drivers.feature_rules()
    features = drop_failing(built, [SERIES_CODE], rules)
    outcome: dict[str, object] = {
        "pairs": report.count(),
        "blocked": report.filter("blocked").count(),
        "failed_checks": failing_keys(built, [SERIES_CODE], rules).count(),
        "blocked_pairs": {
            row[SERIES_CODE]: row["block_reasons"] for row in report.filter("blocked").collect()
        },
        "stale_pairs": {
            row[SERIES_CODE]: "no rate" if row["latest"] is None else f"newest rate {str(row['latest'])[:10]}, {row['age_days']} days old"
            for row in stale.collect()
        },
        "cutover_error": cutover_error,
        "written": 0,
    }
    fit_dates = None if as_of is None else [date.fromisoformat(str(as_of)[:10])]
    estimates = cut_lineage(
        estimation.estimate(features, universe, fit_dates=fit_dates), "estimates"
    )
    fired = signals.with_signals(
        estimates,
        z_threshold=universe.z_threshold,
        stop_reward_ratio=universe.stop_reward_ratio,
    )
    rows = results.estimate_rows(fired, universe.drivers)
    lines = results.signal_rows(fired)
    outcome["broken_rules"] = gate(rows, signals.estimate_rules(universe.drivers))
    if not outcome["broken_rules"]:
        api.write_table(results.GOLD, results.ESTIMATES_TABLE, rows, replace=RUN)
        outcome["written"] = rows.count()
        outcome["broken_rules"] = gate(lines, signals.signal_rules())
        if not outcome["broken_rules"]:
            api.write_table(results.GOLD, results.SIGNALS_TABLE, lines, replace=RUN)
            outcome["signals"] = {
                row["signal"]: row["n"] for row in signals.signal_counts(lines).collect()
            }
    return outcome
