"""What a plan will do, read from ``explain``."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    """Physical plan of a batch frame as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def plan_facts(df: DataFrame) -> dict:
    """Counts of exchanges and joins, and the filters and columns that reach the scans."""
    text = plan_text(df)
    return {
        "exchanges": len(re.findall(r"(?<![A-Za-z])Exchange ", text)),
        "broadcasts": text.count("BroadcastExchange "),
        "sort_merge_joins": text.count("SortMergeJoin "),
        "broadcast_joins": text.count("BroadcastHashJoin "),
        "partition_filters": [f for f in re.findall(r"PartitionFilters: \[(.*?)\], ", text) if f],
        "pushed_filters": [f for f in re.findall(r"PushedFilters: \[(.*?)\], ", text) if f],
        "read_schemas": re.findall(r"ReadSchema: (struct<.*?>)(?:,|$)", text, re.MULTILINE),
    }
