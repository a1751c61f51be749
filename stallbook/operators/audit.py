"""The audit of the removal rules, and the report on excluded codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallbook.functions.numbers import price_status, times_copies
from stallbook.operators.lines import COPIES, ELIGIBLE, is_excluded
from stallbook.operators.metrics import total
from stallbook.schema import AUDIT_COLUMNS, EXCLUDED_CODES, MONEY, REMOVAL_STEPS

DUPLICATES = REMOVAL_STEPS[0]
POSITIVE, NONPOSITIVE, UNCOMPUTABLE = AUDIT_COLUMNS
STATUS_COUNTS = {
    "positive": "positive_price_row_count",
    "zero": "zero_price_row_count",
    "negative": "negative_price_row_count",
    "invalid_numeric": "invalid_numeric_row_count",
}
EXCLUSION_COLUMNS = [
    "StockCode", "category", "reason", "basis", "row_count", *STATUS_COUNTS.values(),
    *AUDIT_COLUMNS,
]
PARTITIONS = ("input", "removed", "remaining")
STAGE_COLUMNS = [
    "record_type", "step", "input_rows", "removed_rows", "remaining_rows",
    *[f"{part}_{name}" for part in PARTITIONS for name in AUDIT_COLUMNS],
]
SUMMARY_COLUMNS = [*STAGE_COLUMNS, "observed_count"]


def _count(condition: Column, rows: Column | None) -> Column:
    rows = F.lit(1) if rows is None else rows
    return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0)).cast("bigint")


def audit_sums(rows: Column | None = None) -> list[Column]:
    """Row count and audit values of judged lines, each standing for one row or for rows."""
    price, computable = F.col("price_number"), F.col("computable")
    value = F.col("signed_value")
    if rows is not None:
        value = times_copies(value, rows.cast("bigint"))
    rows = F.lit(1) if rows is None else rows
    return [
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("row_count"),
        total(F.when(computable & (price > 0), value)).alias(POSITIVE),
        total(F.when(computable & (price <= 0), value)).alias(NONPOSITIVE),
        _count(~computable, rows).alias(UNCOMPUTABLE),
    ]


def audit_values(judged: DataFrame, rows: Column | None = None) -> DataFrame:
    """One row of row count, audit values and uncomputable count."""
    return judged.agg(*audit_sums(rows))


def audit_groups(judged: DataFrame, *more: Column) -> DataFrame:
    """Audit values of first copies and of further copies, by disposition: at most 7 rows.

    One pass over the lines gives all the audit needs; more aggregates may join in.
    """
    further = [
        column.alias(f"further_{name}")
        for name, column in zip(
            ["row_count", *AUDIT_COLUMNS], audit_sums(F.col(COPIES) - 1)
        )
    ]
    return judged.groupBy("disposition").agg(*audit_sums(), *further, *more)


def charges(groups: DataFrame, remove_duplicates: bool = True) -> DataFrame:
    """Rows and audit values charged to each rule, and to the eligible lines.

    First copies are charged to their own disposition. Further copies go to the
    duplicate rule, or where the first one goes if duplicates are kept.
    """
    measures = ["row_count", *AUDIT_COLUMNS]
    further_to = F.lit(DUPLICATES) if remove_duplicates else F.col("disposition")
    entries = F.array(
        F.struct(F.col("disposition").alias("charged_to"), *measures),
        F.struct(
            further_to.alias("charged_to"),
            *[F.col(f"further_{name}").alias(name) for name in measures],
        ),
    )
    return (
        groups.select(F.explode(entries).alias("entry"))
        .groupBy(F.col("entry.charged_to").alias("disposition"))
        .agg(
            F.sum("entry.row_count").alias("row_count"),
            *[total(F.col(f"entry.{name}")).alias(name) for name in (POSITIVE, NONPOSITIVE)],
            F.sum(f"entry.{UNCOMPUTABLE}").alias(UNCOMPUTABLE),
        )
    )


def audit_by_disposition(judged: DataFrame, remove_duplicates: bool = True) -> DataFrame:
    return charges(audit_groups(judged), remove_duplicates)


def stage_audit(charged: DataFrame) -> DataFrame:
    """Seven removal steps with input, removed and remaining, in order.

    Removed rows come from audit_by_disposition; the input of a step is everything
    charged to it or to what follows. At most eight rows are ordered here.
    """
    spark = charged.sparkSession
    steps = spark.createDataFrame(
        list(enumerate([*REMOVAL_STEPS, ELIGIBLE], 1)), "step_no int, step string"
    )
    measures = ["row_count", *AUDIT_COLUMNS]
    removed = steps.join(
        charged.withColumnRenamed("disposition", "step"), "step", "left"
    ).na.fill(0, measures)
    following = Window.orderBy("step_no").rowsBetween(0, Window.unboundedFollowing)
    after = Window.orderBy("step_no").rowsBetween(1, Window.unboundedFollowing)

    def columns(part: str, measure) -> list[Column]:
        return [
            measure("row_count").cast("bigint").alias(f"{part}_rows"),
            measure(POSITIVE).cast(MONEY).alias(f"{part}_{POSITIVE}"),
            measure(NONPOSITIVE).cast(MONEY).alias(f"{part}_{NONPOSITIVE}"),
            measure(UNCOMPUTABLE).cast("bigint").alias(f"{part}_{UNCOMPUTABLE}"),
        ]

    return (
        removed.select(
            "step_no",
            "step",
            *columns("input", lambda name: F.sum(name).over(following)),
            *columns("removed", F.col),
            *columns("remaining", lambda name: F.coalesce(F.sum(name).over(after), F.lit(0))),
        )
        .where(F.col("step") != ELIGIBLE)
        .select("step_no", F.lit("removal_step").alias("record_type"), *STAGE_COLUMNS[1:])
    )


def eligible_total(charged: DataFrame) -> DataFrame:
    """One record of the rows and values that remain, zero when nothing does."""
    survivors = charged.where(F.col("disposition") == ELIGIBLE)
    return survivors.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("remaining_rows"),
        total(F.col(POSITIVE)).alias(f"remaining_{POSITIVE}"),
        total(F.col(NONPOSITIVE)).alias(f"remaining_{NONPOSITIVE}"),
        F.coalesce(F.sum(UNCOMPUTABLE), F.lit(0)).cast("bigint").alias(
            f"remaining_{UNCOMPUTABLE}"
        ),
    ).select(
        F.lit("eligible_total").alias("record_type"),
        F.lit("eligible_merchandise").alias("step"),
        "*",
    )


def information_records(profile: DataFrame) -> DataFrame:
    """Integer entries of a one-row profile as (seq, record_type, step, observed_count)."""
    counts = [name for name, kind in profile.dtypes if kind == "bigint"]
    pairs = [
        F.struct(F.lit(name).alias("step"), F.col(name).alias("observed_count"))
        for name in counts
    ]
    missing = F.transform(
        F.map_entries("missing_by_column"),
        lambda entry: F.struct(
            F.concat(F.lit("missing_"), entry["key"]).alias("step"),
            entry["value"].alias("observed_count"),
        ),
    )
    return profile.select(
        F.posexplode(F.concat(F.array(*pairs), missing)).alias("seq", "entry")
    ).select(
        "seq",
        F.lit("informational_raw").alias("record_type"),
        F.col("entry.step").alias("step"),
        F.col("entry.observed_count").alias("observed_count"),
    )


def cleaning_summary(charged: DataFrame, profile: DataFrame) -> DataFrame:
    """Removal steps, the eligible total and the raw counts, in that order.

    charged and profile come from a few written rows, as they are read several times.
    """
    steps = stage_audit(charged).withColumnRenamed("step_no", "seq")
    survivors = eligible_total(charged).withColumn("seq", F.lit(100))
    counts = information_records(profile).withColumn("seq", F.col("seq") + 200)
    return (
        steps.unionByName(survivors, allowMissingColumns=True)
        .unionByName(counts, allowMissingColumns=True)
        .orderBy("seq")
        .select("seq", *SUMMARY_COLUMNS)
    )


def exclusion_dimension(spark: SparkSession) -> DataFrame:
    """The excluded codes; their number is fixed, so joins may broadcast them."""
    return spark.createDataFrame(
        EXCLUDED_CODES, "StockCode string, category string, reason string"
    )


def excluded_entries(judged: DataFrame, remove_duplicates: bool = True) -> DataFrame:
    """Counts and diagnostic values of each excluded code that occurs."""
    rows = None if remove_duplicates else F.col(COPIES)
    basis = "post_deduplication" if remove_duplicates else "raw"
    status = price_status(F.col("computable"), F.col("price_number"))
    groups = (
        # Right after deduplication, the rule is the code and nothing else. Both are asked: the
        # disposition picks the folder of stored lines, the code spares others their judgement.
        judged.where(is_excluded(F.col("code")) & (F.col("disposition") == "excluded_codes"))
        .withColumn("status", status)
        .groupBy(F.col("code").alias("StockCode"))
        .agg(
            *audit_sums(rows),
            *[_count(F.col("status") == name, rows).alias(count) for name, count in STATUS_COUNTS.items()],
        )
    )
    return (
        groups.join(F.broadcast(exclusion_dimension(judged.sparkSession)), "StockCode")
        .withColumn("basis", F.lit(basis))
        .select(*EXCLUSION_COLUMNS)
        .orderBy("StockCode")
    )


def excluded_lines(judged: DataFrame) -> DataFrame:
    """Judged lines whose code is in the exclusion dimension."""
    codes = exclusion_dimension(judged.sparkSession).select(F.col("StockCode").alias("code"))
    return judged.join(F.broadcast(codes), "code", "left_semi")


def merchandise_lines(judged: DataFrame) -> DataFrame:
    """Judged lines whose code is not in the exclusion dimension."""
    codes = exclusion_dimension(judged.sparkSession).select(F.col("StockCode").alias("code"))
    return judged.join(F.broadcast(codes), "code", "left_anti")
