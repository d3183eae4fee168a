"""Trading signals from estimates, and the checks that gate what is written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.functions.numeric import to_level
from serieslake.operators.quality import Rule, out_of_range
from serieslake.plans.drivers import RATE_RANGE
from serieslake.plans.universes import UNIVERSE_NAMES

BUY, SELL, NO_SIGNAL = "BUY", "SELL", "NONE"
# Largest believable coefficient and z-score.
COEFFICIENT_BOUND = 1e6
Z_BOUND = 100.0


def with_signals(
    estimates: DataFrame, *, z_threshold: Column | float, stop_reward_ratio: Column | float
) -> DataFrame:
    """Adds signal, target, stop_loss and reason.

    Needs z_score, fitted_value, is_logged, current_rate, cointegration_passed and
    cointegration_p_value. A signal fires only when the pair is cointegrated and the score
    reaches the threshold; the stop sits on the far side of the rate from the target.
    """
    z = F.col("z_score")
    limit = z_threshold if isinstance(z_threshold, Column) else F.lit(float(z_threshold))
    ratio = (
        stop_reward_ratio
        if isinstance(stop_reward_ratio, Column)
        else F.lit(float(stop_reward_ratio))
    )
    passed = F.coalesce(F.col("cointegration_passed"), F.lit(False))
    quiet = F.abs(z) < limit
    signal = (
        F.when(~passed | quiet, F.lit(NO_SIGNAL)).when(z > 0, F.lit(SELL)).otherwise(F.lit(BUY))
    )
    target = F.when(
        F.col("signal") != NO_SIGNAL, to_level(F.col("fitted_value"), F.col("is_logged"))
    )
    risk = F.abs(F.col("current_rate") - F.col("target")) / ratio
    stop = F.when(F.col("signal") == SELL, F.col("current_rate") + risk).when(
        F.col("signal") == BUY, F.col("current_rate") - risk
    )
    p_value = F.coalesce(F.col("cointegration_p_value"), F.lit(float("nan")))
    p_text = F.when(F.isnan(p_value), F.lit("nan")).otherwise(F.format_string("%.4f", p_value))
    size = F.format_string("%.2f", F.abs(z))
    shown_limit = limit.cast("string")
    reason = (
        F.when(~passed, F.concat(F.lit("cointegration failed (p="), p_text, F.lit(")")))
        .when(quiet, F.concat(F.lit("|z|="), size, F.lit(" below threshold "), shown_limit))
        .otherwise(
            F.concat(
                F.lit("|z|="), size, F.lit(" >= threshold "), shown_limit, F.lit(", cointegrated")
            )
        )
    )
    return (
        estimates.withColumn("signal", signal)
        .withColumn("target", target)
        .withColumn("stop_loss", stop)
        .withColumn("reason", reason)
    )


def signal_counts(signals: DataFrame) -> DataFrame:
    return signals.groupBy("signal").agg(F.count("*").alias("n"))


def estimate_rules(drivers: Sequence[str]) -> list[Rule]:
    """Checks on estimate rows; any failure means nothing is written."""
    rules = [
        Rule(f"{name} must be set", "null", F.col(name).isNull())
        for name in ("date", "universe", "series_code", "is_logged", "cointegration_passed")
    ]
    rules.append(Rule("unknown universe", "range", ~F.col("universe").isin(*UNIVERSE_NAMES)))
    rules += [
        Rule(
            f"{name}_coef out of range",
            "range",
            out_of_range(f"{name}_coef", -COEFFICIENT_BOUND, COEFFICIENT_BOUND),
        )
        for name in ("const", *drivers)
    ]
    rules += [
        Rule(f"{name} must be set", "null", F.col(name).isNull())
        for name in ("fitted_value", "actual_value")
    ]
    rules += [
        Rule(
            "z_score out of range",
            "range",
            out_of_range("z_score", -Z_BOUND, Z_BOUND, nullable=False),
        ),
        Rule(
            "r_squared out of range",
            "range",
            out_of_range("r_squared", 0.0, 1.0001, nullable=False),
        ),
        Rule("n_obs must be positive", "range", F.coalesce(F.col("n_obs") <= 0, F.lit(True))),
    ]
    return rules


def signal_rules() -> list[Rule]:
    """Checks on signal rows; any failure means nothing is written."""
    return [
        *[
            Rule(f"{name} must be set", "null", F.col(name).isNull())
            for name in ("date", "universe", "series_code", "reason")
        ],
        Rule("unknown universe", "range", ~F.col("universe").isin(*UNIVERSE_NAMES)),
        Rule(
            "unknown signal",
            "range",
            ~F.coalesce(F.col("signal").isin(BUY, SELL, NO_SIGNAL), F.lit(False)),
        ),
        Rule(
            "entry_z_score out of range",
            "range",
            out_of_range("entry_z_score", -Z_BOUND, Z_BOUND, nullable=False),
        ),
        Rule("target out of range", "range", out_of_range("target", *RATE_RANGE)),
        Rule("stop_loss out of range", "range", out_of_range("stop_loss", *RATE_RANGE)),
    ]
