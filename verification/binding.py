"""HR-shaped source tables derived from the star-schema test tables.

Customers stand for employees, their orders for salary events, order lines for reviews and recruitment events.
Integer arithmetic only, so that a SQL engine can derive the same rows independently.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peoplelake.functions.scalar import day, quarter_key
from peoplelake.operators.staging import clamp_events_to_exit

AS_OF = dt.date(2001, 8, 1)
LOADED_AT = dt.datetime(2001, 8, 1)
HEADCOUNT_START = dt.date(1995, 1, 1)
CUTOFF = dt.date(1998, 6, 30)
EARLIER_CUTOFF = dt.date(1997, 6, 30)

# Names of the six job levels in rank order.
LEVEL_NAMES = ("Junior", "Mid", "Senior", "Lead", "Manager", "Director")
REASONS = {"1-URGENT": "Promotion", "2-HIGH": "Merit", "3-MEDIUM": "Market_Adj", "5-LOW": "Correction"}
CHANNELS = {"1-URGENT": "LinkedIn", "2-HIGH": "Referral", "3-MEDIUM": "Job_Board", "5-LOW": "Direct"}
STAGE_OF_LINE = {2: "Screening", 3: "Interview", 4: "Offer", 5: "Hired", 6: "Rejected"}


def star(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def employee_id(key: Column) -> Column:
    """``EMP-%06d``. Only unusual keys go through the formatter, which takes more than twice as long."""
    digits = key.cast("string")
    padded = F.when(key.between(0, 999_999), F.concat(F.lit("EMP-"), F.lpad(digits, 6, "0")))
    return padded.when(key > 999_999, F.concat(F.lit("EMP-"), digits)).otherwise(F.format_string("EMP-%06d", key))


def _numbered(prefix: str, key: Column) -> Column:
    """``prefix%d``, by the formatter's text for NULL."""
    return F.concat(F.lit(prefix), F.coalesce(key.cast("string"), F.lit("null")))


def _mapped(column: str, values: dict) -> Column:
    out = F.lit(None).cast("string")
    for k, v in values.items():
        out = F.coalesce(out, F.when(F.col(column) == k, v))
    return out


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).cast("long").alias("department_id"),
        F.concat(F.lit(" "), "r_name").alias("department_name"),
        F.lit(None).cast("long").alias("parent_id"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )


def job_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = (F.col("c_custkey") % 6 + 1).alias("level_id")
    names = _mapped("level_id", {i + 1: f"{name} " for i, name in enumerate(LEVEL_NAMES)})
    return (
        star(spark, sf_dir, "customer")
        .select(level)
        .distinct()
        .select("level_id", names.alias("level_name"), F.col("level_id").alias("level_rank"))
    )


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an order: their first one is the hire date, which no employee lacks."""
    first_order = (
        star(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("hire_date"))
    )
    nation = star(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    k = F.col("c_custkey")
    planned = F.date_add("hire_date", (k * 97 % 1400 + 90).cast("int"))
    leaves = (F.col("c_acctbal") < 5000) & (planned <= day(AS_OF))
    return (
        star(spark, sf_dir, "customer")
        .join(nation, "c_nationkey")
        .join(first_order, "c_custkey")
        .select(
            k.alias("k"),
            "c_name",
            "c_mktsegment",
            "hire_date",
            (F.col("n_regionkey") + 1).cast("long").alias("department_id"),
            (k % 6 + 1).alias("level_id"),
            F.when(leaves, planned).alias("exit_date"),
        )
    )


def _manager(k: Column) -> Column:
    return F.when(k >= 10, employee_id(F.floor(k / 10)))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    kind = F.when(k % 10 == 8, "PART_TIME").when(k % 10 == 9, "CONTRACT").otherwise("FULL_TIME")
    status = F.when(F.col("exit_date").isNotNull(), "TERMINATED").when(k % 50 == 0, "ON_LEAVE").otherwise("ACTIVE")
    return _people(spark, sf_dir).select(
        employee_id(k).alias("employee_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.upper("c_name"), F.lit("@X.COM ")).alias("email"),
        F.when(k % 3 == 0, "Male").when(k % 3 == 1, "Female").alias("gender"),
        F.date_add(F.lit("1955-01-01").cast("date"), (k * 37 % 7300).cast("int")).alias("birth_date"),
        "hire_date",
        "department_id",
        F.concat(F.lit(" "), "c_mktsegment").alias("job_title"),
        "level_id",
        _manager(k).alias("manager_id"),
        kind.alias("employment_type"),
        status.alias("status"),
    )


def _exits(spark: SparkSession, sf_dir: str, key: Column) -> DataFrame:
    return _people(spark, sf_dir).filter(F.col("exit_date").isNotNull()).select(key, "exit_date")


def exits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exits(spark, sf_dir, employee_id(F.col("k")).alias("employee_id"))


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "orders").withColumn("effective_date", F.col("o_orderdate").cast("date"))


def salary_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salary events before the clamp."""
    return _salary_rows(_dated_orders(spark, sf_dir))


def _salary_rows(orders: DataFrame) -> DataFrame:
    return orders.select(
        (F.col("o_orderkey") + 1).alias("salary_id"),
        employee_id(F.col("o_custkey")).alias("employee_id"),
        "effective_date",
        F.col("o_totalprice").cast("decimal(12,2)").alias("salary_amount"),
        F.when(F.col("o_orderkey") % 7 != 0, "usd").alias("currency"),
        _mapped("o_orderpriority", REASONS).alias("change_reason"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, line number); raw lines repeat that pair.

    Lines are dealt by order once, for this grouping and for the join with their orders; those without an order meet none.
    """
    return (
        star(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date"), "l_quantity", "l_suppkey")
        .filter(F.col("l_orderkey").isNotNull())
        .repartition("l_orderkey")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("ship_date").alias("ship_date"),
            F.min("l_quantity").cast("int").alias("quantity"),
            F.min("l_suppkey").alias("suppkey"),
        )
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews before the clamp."""
    return _review_rows(_lines(spark, sf_dir).join(_orders(spark, sf_dir), "l_orderkey"))


def _review_rows(lines: DataFrame) -> DataFrame:
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"),
        employee_id(F.col("o_custkey")).alias("employee_id"),
        F.col("ship_date").alias("review_date"),
        quarter_key("ship_date").alias("review_period"),
        ((F.col("quantity") * 8 + 100).cast("decimal(5,0)") / 100).cast("decimal(3,2)").alias("score"),
        employee_id(F.col("suppkey")).alias("manager_id"),
        F.lit(None).cast("string").alias("notes"),
        F.col("ship_date").cast("timestamp_ntz").alias("created_at"),
    )


def job_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terminations and promotions before the clamp."""
    people, k = _people(spark, sf_dir), F.col("k")
    exit_type = F.when(k % 20 < 13, "Voluntary").when(k % 20 < 18, "Involuntary").otherwise("Retirement")

    def change(rows, change_id, date, kind, to_level, exit_type):
        return rows.select(
            change_id.alias("change_id"),
            employee_id(k).alias("employee_id"),
            date.alias("change_date"),
            F.lit(kind).alias("change_type"),
            F.col("department_id").alias("from_dept_id"),
            F.lit(None).cast("long").alias("to_dept_id"),
            F.col("level_id").alias("from_level_id"),
            to_level.alias("to_level_id"),
            _manager(k).alias("from_manager_id"),
            F.lit(None).cast("string").alias("to_manager_id"),
            F.lit(None).cast("decimal(12,2)").alias("from_salary"),
            F.lit(None).cast("decimal(12,2)").alias("to_salary"),
            exit_type.alias("exit_type"),
            date.cast("timestamp_ntz").alias("created_at"),
        )

    none = F.lit(None)
    left = change(
        people.filter(F.col("exit_date").isNotNull()), k * 2 + 1, F.col("exit_date"), "Termination",
        none.cast("long"), exit_type,
    )
    raised = F.date_add("hire_date", (k * 53 % 1000 + 365).cast("int"))
    promoted = change(
        people.filter((k % 7 == 0) & (raised <= day(AS_OF))), k * 2 + 2, raised, "Promotion",
        F.least(F.col("level_id") + 1, F.lit(6)), none.cast("string"),
    )
    return left.unionByName(promoted)


def recruitment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _people(spark, sf_dir).select(F.col("k").alias("o_custkey"), "department_id", "c_mktsegment")
    stage = F.coalesce(_mapped("l_linenumber", STAGE_OF_LINE), F.lit("Applied"))
    # Orders meet the people before the lines, of which there are more.
    return (
        _lines(spark, sf_dir)
        .join(_orders(spark, sf_dir).join(people, "o_custkey"), "l_orderkey")
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"),
            _numbered("REQ-", F.col("l_orderkey")).alias("requisition_id"),
            _numbered("CAND-", F.col("suppkey")).alias("candidate_id"),
            F.when(stage == "Hired", employee_id(F.col("o_custkey"))).alias("employee_id"),
            F.col("c_mktsegment").alias("job_title"),
            "department_id",
            stage.alias("stage"),
            F.col("ship_date").alias("stage_date"),
            _mapped("o_orderpriority", CHANNELS).alias("source"),
            F.col("ship_date").cast("timestamp_ntz").alias("created_at"),
        )
    )


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the seven HR source tables; events after an employee's exit are clamped, while their rows are narrow."""
    if name in ("salary_history", "performance_reviews"):
        gone = _exits(spark, sf_dir, F.col("k").alias("o_custkey"))
    if name == "salary_history":
        return _salary_rows(clamp_events_to_exit(_dated_orders(spark, sf_dir), gone, "o_custkey", "effective_date"))
    if name == "performance_reviews":
        lines, orders = _lines(spark, sf_dir), _orders(spark, sf_dir)
        return _review_rows(clamp_events_to_exit(lines, gone, "o_custkey", "ship_date", parents=orders, on="l_orderkey"))
    if name == "job_changes":
        keep = F.col("change_type") == "Termination"
        return clamp_events_to_exit(
            job_changes(spark, sf_dir), exits(spark, sf_dir), "employee_id", "change_date", keep
        )
    build = {
        "departments": departments,
        "job_levels": job_levels,
        "employees": employees,
        "recruitment_events": recruitment_events,
    }
    return build[name](spark, sf_dir)


def calendar_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole years from the first order to the last shipment."""
    dates = (
        star(spark, sf_dir, "orders")
        .agg(F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"))
        .unionByName(
            star(spark, sf_dir, "lineitem").agg(F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high"))
        )
    )
    last_year = F.trunc(F.max(F.col("high").cast("date")), "year")
    return dates.agg(
        F.trunc(F.min(F.col("low").cast("date")), "year").alias("start"),
        F.date_sub(F.add_months(last_year, 12), 1).alias("end"),
    )
