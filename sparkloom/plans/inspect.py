"""What a physical plan will do: exchanges, joins, pushed filters, columns read."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    """The physical plan in full, before any of it has run."""
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def operators(df: DataFrame) -> Counter:
    """How often each physical operator appears in the initial plan."""
    tree = plan_text(df).split("\n\n")[0]
    return Counter(re.findall(r"[+:\-\s]*(?:\* )?([A-Z][A-Za-z]+(?: [A-Z][A-Za-z]+)?) \(\d+\)", tree))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df))


def columns_read(df: DataFrame) -> list[set[str]]:
    """For each scan the columns that it reads."""
    return [set(re.findall(r"(\w+):", x)) for x in re.findall(r"ReadSchema: struct<(.*?)>\n", plan_text(df))]
