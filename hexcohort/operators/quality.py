"""Data-quality rules compiled to one aggregation, and per-row request checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K


@dataclass(frozen=True)
class _Rule:
    name: str
    severity: str
    bad: Column            # number of offending rows
    passed: Column
    message: Column


def _n(c: Column) -> Column:
    return F.format_number(c, 0)


class Validator:
    """Fluent rule builder.  All rules share one pass over the table.

    Rules on an absent column are skipped, except the row count and the list of
    required columns.  Uniqueness is counted by a second, key-only aggregation
    per column, which folds equal keys before the shuffle.
    """

    def __init__(self, df: DataFrame):
        self.df = df
        self._rules: list[_Rule] = []
        self._unique: list[tuple[int, str]] = []

    def _counted(self, name: str, bad: Column, wrong: Column, fine: str, severity: str = "ERROR") -> Validator:
        n = F.coalesce(F.count_if(bad), F.lit(0)).cast("bigint")
        self._rules.append(_Rule(name, severity, n, n == 0, F.when(n > 0, wrong).otherwise(F.lit(fine))))
        return self

    def row_count_above(self, minimum: int) -> Validator:
        n = F.count(F.lit(1))
        bad = F.greatest(F.lit(minimum) - n, F.lit(0)).cast("bigint")
        self._rules.append(_Rule("row_count", "ERROR", bad, n >= minimum,
                                 F.concat(_n(n), F.lit(f" rows (need >= {minimum:,})"))))
        return self

    def columns(self, names: list[str]) -> Validator:
        missing = [c for c in names if c not in self.df.columns]
        text = f"missing: {missing}" if missing else f"all {len(names)} required columns present"
        self._rules.append(_Rule("required_columns", "ERROR", F.lit(len(missing)).cast("bigint"),
                                 F.lit(not missing), F.lit(text)))
        return self

    def no_nulls(self, names: list[str]) -> Validator:
        for c in names:
            if c in self.df.columns:
                bad = F.col(c).isNull()
                self._counted(f"no_nulls:{c}", bad, F.concat(_n(F.count_if(bad)), F.lit(" nulls")), "no nulls")
        return self

    def unique(self, c: str) -> Validator:
        if c in self.df.columns:
            self._unique.append((len(self._rules), c))
            self._rules.append(_Rule(f"unique:{c}", "ERROR", F.lit(0), F.lit(True), F.lit("")))
        return self

    def in_range(self, c: str, lo: float, hi: float, severity: str = "ERROR") -> Validator:
        """Inclusive; NULL does not violate."""
        if c in self.df.columns:
            bad = (F.col(c) < lo) | (F.col(c) > hi)
            wrong = F.concat(_n(F.count_if(bad)), F.lit(f" values outside [{lo}, {hi}]"))
            self._counted(f"range:{c}", bad, wrong, f"all in [{lo}, {hi}]", severity)
        return self

    def values_in(self, c: str, valid: list) -> Validator:
        """NULL counts as unexpected; the message shows five offending values."""
        if c in self.df.columns:
            bad = ~F.coalesce(F.col(c).isin(list(valid)), F.lit(False))
            shown = (unexpected_values(self.df, c, valid).agg(F.concat_ws(", ", F.array_sort(F.collect_list(
                F.coalesce(F.col("value").cast("string"), F.lit("null")))))).scalar())
            wrong = F.concat(_n(F.count_if(bad)), F.lit(" unexpected: "), shown)
            self._counted(f"values_in:{c}", bad, wrong, f"all in {sorted(map(str, valid))}")
        return self

    def positive(self, c: str) -> Validator:
        """Not negative (zero passes)."""
        if c in self.df.columns:
            bad = F.col(c) < 0
            self._counted(f"positive:{c}", bad, F.concat(_n(F.count_if(bad)), F.lit(" negative values")),
                          "all positive")
        return self

    def results(self) -> DataFrame:
        """``(rule, passed, n_bad, message, severity)``, one row per rule, in declared order."""
        structs = [F.struct(F.lit(i).alias("pos"), F.lit(r.name).alias("rule"), r.passed.alias("passed"),
                            r.bad.cast("bigint").alias("n_bad"), r.message.alias("message"),
                            F.lit(r.severity).alias("severity")).alias(f"r{i}")
                   for i, r in enumerate(self._rules) if i not in {p for p, _ in self._unique}]
        parts = []
        if structs:
            row = self.df.agg(F.count(F.lit(1)).alias("_n"), *structs)
            parts.append(row.select(F.explode(F.array(*[F.col(f"r{i}") for i in range(len(self._rules))
                                                        if f"r{i}" in row.columns])).alias("r")).select("r.*"))
        for pos, c in self._unique:
            parts.append(self._unique_result(pos, c))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.orderBy("pos").drop("pos")

    def _unique_result(self, pos: int, c: str) -> DataFrame:
        dup = (self.df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
               .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("bad")))
        return dup.select(F.lit(pos).alias("pos"), F.lit(f"unique:{c}").alias("rule"),
                          (F.col("bad") == 0).alias("passed"), F.col("bad").alias("n_bad"),
                          F.when(F.col("bad") > 0, F.concat(_n(F.col("bad")), F.lit(" duplicates")))
                          .otherwise(F.lit("all unique")).alias("message"), F.lit("ERROR").alias("severity"))

    def report(self) -> DataFrame:
        """One row: verdict (no failed ERROR) and the number of passed, warning and error rules."""
        failed = ~F.col("passed")
        return self.results().agg(
            (F.count_if(failed & (F.col("severity") == "ERROR")) == 0).alias("ok"),
            F.count_if(F.col("passed")).alias("n_passed"),
            F.count_if(failed & (F.col("severity") == "WARNING")).alias("n_warnings"),
            F.count_if(failed & (F.col("severity") == "ERROR")).alias("n_errors"))

    def is_valid(self) -> bool:
        return bool(self.report().first()["ok"])


def unexpected_values(df: DataFrame, c: str, valid: list, n: int = 5) -> DataFrame:
    """The first ``n`` distinct offending values (sorted), for the message of a failed rule."""
    bad = ~F.coalesce(F.col(c).isin(list(valid)), F.lit(False))
    return df.filter(bad).select(F.col(c).alias("value")).distinct().orderBy("value").limit(n)


def subscriber_rules(df: DataFrame) -> Validator:
    """The rule set of the batch job."""
    v = (Validator(df).row_count_above(1000).unique("subscriber_id")
         .no_nulls(["subscriber_id", "home_lat", "home_lon", "data_usage_gb", "monthly_charges"])
         .in_range("home_lat", -11.0, 6.0).in_range("home_lon", 95.0, 141.0)
         .in_range("data_usage_gb", 0, 500).in_range("home_zone_rsrq", -30, -3)
         .positive("avg_daily_distance_km").positive("monthly_charges"))
    for c in ["pct_time_at_home", "pct_time_at_work"] + K.TEMPORAL + K.POI_SCORES[:3]:
        v.in_range(c, 0.0, 1.0, "WARNING")
    return v


REQUIRED = ["subscriber_id", "home_lat", "home_lon", "work_lat", "work_lon", "avg_daily_distance_km",
            "travel_radius_km", "data_usage_gb", "call_minutes_monthly", "morning_data_ratio",
            "evening_data_ratio", "weekend_data_ratio", "poi_office_score", "poi_transit_score",
            "poi_mall_score", "home_zone_rsrq", "monthly_charges"]


def strict_subscriber_rules(df: DataFrame) -> Validator:
    """The alternative rule set with required columns and all ratio columns."""
    v = (Validator(df).row_count_above(1000).columns(REQUIRED).unique("subscriber_id")
         .no_nulls(["subscriber_id", "home_lat", "home_lon"])
         .in_range("home_lat", -11.0, 6.0).in_range("home_lon", 95.0, 141.0)
         .in_range("data_usage_gb", 0, 500).in_range("home_zone_rsrq", -30, -3)
         .positive("avg_daily_distance_km").positive("monthly_charges"))
    for c in ["pct_time_at_home", "pct_time_at_work"] + K.TEMPORAL + K.POI_SCORES:
        v.in_range(c, 0, 1, "WARNING")
    return v


def request_errors(df: DataFrame) -> DataFrame:
    """Adds ``errors`` (offending fields) and ``is_valid`` to scoring requests."""
    checks = [F.when(F.col("subscriber_id").isNull(), F.lit("subscriber_id"))]
    for field, (lo, hi) in K.REQUEST_LIMITS.items():
        if field not in df.columns:
            continue
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (F.col(field) < lo)
        if hi is not None:
            bad = bad | (F.col(field) > hi)
        checks.append(F.when(bad, F.lit(field)))
    errors = F.array_compact(F.array(*checks))
    return df.withColumn("errors", errors).withColumn("is_valid", F.size("errors") == 0)
