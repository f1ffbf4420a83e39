"""Functions callable from SQL text, registered for the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.operators.aggregates import balance_summary


def register_date_key(spark: SparkSession, name: str = "date_key") -> str:
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(d DATE) RETURNS INT"
        " RETURN year(d) * 10000 + month(d) * 100 + day(d)"
    )
    return name


def register_balance(instalments: DataFrame, name: str = "student_balance") -> str:
    """Table function of one student's balance; ``LEFT JOIN LATERAL`` makes it a join with the balances.

    A student without instalments gets one row: no instalments, the rest NULL.
    """
    balances = balance_summary(instalments)
    balances.createOrReplaceTempView(f"{name}_rows")
    first, *rest = [f for f in balances.schema if f.name != "AlunoID"]
    values = [f"coalesce(max(b.{first.name}), 0)", *[f"max(b.{f.name})" for f in rest]]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (first, *rest))
    instalments.sparkSession.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(student BIGINT) RETURNS TABLE ({columns})"
        f" RETURN SELECT {', '.join(values)} FROM {name}_rows b WHERE b.AlunoID = {name}.student"
    )
    return name
