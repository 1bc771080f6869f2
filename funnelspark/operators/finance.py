"""Monthly actuals, unified scenarios and weekly targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions.dates import fiscal_period, fiscal_year, month_end

# Account types kept as actuals.
REVENUE, WAGES, OTHER, EBITDA = "Revenue", "Salaries and Wages", "Other Expenses", "EBITDA"
ACTUAL_TYPES = (REVENUE, WAGES, OTHER)
SHORT_WAGES = "S&W"


def entity_code(rules: Sequence[tuple[Column, str]]) -> Column:
    """Facility code from entity and account tests; no hit is NULL."""
    from funnelspark.functions.rules import first_match

    return first_match(rules)


def text_flag(c: Column, needle: str, hit: str, miss: str) -> Column:
    """Case-blind substring flag."""
    return F.when(F.lower(F.coalesce(c, F.lit(""))).contains(needle.lower()), F.lit(hit)).otherwise(F.lit(miss))


def fin_monthly(bank: DataFrame, historical: DataFrame) -> DataFrame:
    """Bank rows per month, entity and type with expenses made positive, and historical rows as they are."""
    clean = bank.where(F.col("type").isin(*ACTUAL_TYPES) & F.col("entity").isNotNull())
    sums = clean.groupBy(month_end(F.col("date")).alias("month_ending"), "entity", "type").agg(F.sum("amount").alias("raw"))
    actual = sums.select(
        "month_ending", "entity", "type",
        F.when(F.col("type") == REVENUE, F.col("raw")).otherwise(-F.col("raw")).alias("amount"),
        F.lit("Bank Actuals").alias("source"),
    )
    old = historical.select("month_ending", "entity", "type", "amount", F.lit("Historical").alias("source"))
    return actual.unionByName(old)


def metric_columns(monthly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rev, wages, other and ebitda side by side; a missing part counts 0 in the difference."""
    def part(t: str) -> Column:
        return F.sum(F.when(F.col("type") == t, F.col("amount")))

    agg = monthly.groupBy(*keys).agg(part(REVENUE).alias("rev"), part(WAGES).alias("wages"), part(OTHER).alias("other"))
    zero = F.lit(0.0)
    return agg.withColumn(
        "ebitda", F.coalesce("rev", zero) - F.coalesce("wages", zero) - F.coalesce("other", zero)
    )


def fin_unified(monthly: DataFrame, budget: DataFrame) -> DataFrame:
    """Long chart table: actual revenue, wages and derived EBITDA, and the budget rows."""
    m = metric_columns(monthly, ["month_ending", "entity"])
    zero = F.lit(0.0)
    rows = F.array(
        F.struct(F.lit(REVENUE).alias("type"), F.coalesce("rev", zero).alias("amount")),
        F.struct(F.lit(SHORT_WAGES).alias("type"), F.coalesce("wages", zero).alias("amount")),
        F.struct(F.lit(EBITDA).alias("type"), F.col("ebitda").alias("amount")),
    )
    actual = m.select("month_ending", "entity", F.explode(rows).alias("r")).select(
        "month_ending", "entity", F.lit("Actual").alias("scenario"), "r.type", "r.amount"
    )
    planned = budget.select(
        "month_ending", "entity", F.lit("Budget").alias("scenario"),
        F.when(F.col("type") == WAGES, F.lit(SHORT_WAGES)).otherwise(F.col("type")).alias("type"), "amount",
    )
    return actual.unionByName(planned)


def weekly_targets(budget: DataFrame, first_week: object, last_week: object) -> DataFrame:
    """Monthly budget split evenly over the week endings of its month inside the range.

    Each budget row generates its own weeks, so there is no join with a calendar.
    """
    first, last = F.lit(first_week).cast("date"), F.lit(last_week).cast("date")
    all_weeks = F.sequence(first, last, F.expr("interval 7 days"))
    mine = F.filter(all_weeks, lambda d: F.last_day(d) == F.col("month_ending"))
    rows = budget.where(F.col("type").isin(REVENUE, WAGES, EBITDA)).withColumn("_weeks", mine)
    return rows.select(
        F.explode("_weeks").alias("week_ending"), "month_ending", "entity", "type",
        (F.col("amount") / F.size("_weeks")).alias("weekly_target"),
    )


def with_fiscal(df: DataFrame, entities: Mapping[str, int], day: str = "month_ending", entity: str = "entity") -> DataFrame:
    """Adds fiscal_year and fiscal_period by each entity's start month."""
    start = F.create_map(*[F.lit(x) for kv in entities.items() for x in kv])[F.col(entity)]
    return df.withColumn("fiscal_year", fiscal_year(F.col(day), start)).withColumn(
        "fiscal_period", fiscal_period(F.col(day), start)
    )


def prior_year(monthly: DataFrame, keys: Sequence[str], value: str, month: str = "month_ending") -> DataFrame:
    """Adds the value of the same month a year earlier (NULL when absent)."""
    prev = monthly.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.last_day(F.add_months(F.col(month), 12)).alias("_m"), F.col(value).alias(f"{value}_py")
    )
    cond = F.col(month) == F.col("_m")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return monthly.join(prev, cond, "left").drop("_m", *[f"_{k}" for k in keys])


def growth(cur: Column, prev: Column) -> Column:
    """Change over the absolute prior value; NULL when there is none or it is 0."""
    return F.try_divide(cur - prev, F.abs(prev))


def fiscal_ytd(df: DataFrame, entities: Mapping[str, int], as_of: object, keys: Sequence[str], value: str) -> DataFrame:
    """Sum over each entity's current fiscal year up to the period of ``as_of``."""
    start = F.create_map(*[F.lit(x) for kv in entities.items() for x in kv])[F.col("entity")]
    today = F.lit(as_of).cast("date")
    d = with_fiscal(df, entities)
    now = (F.col("fiscal_year") == fiscal_year(today, start)) & (F.col("fiscal_period") <= fiscal_period(today, start))
    return d.where(now).groupBy(*keys).agg(F.sum(value).alias(f"{value}_ytd"))
