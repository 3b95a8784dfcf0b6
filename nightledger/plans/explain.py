"""Plan text and shuffle summary from ``DataFrame.explain``."""

from __future__ import annotations

import contextlib
import io
import re
from collections import Counter

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def shuffle_keys(df: DataFrame) -> list[str]:
    """Hash-partitioning keys of the plan's own shuffles (reused ones are
    not counted), attribute ids removed."""
    text = plan_text(df, "formatted")
    details = text.split("\n\n", 1)[-1]
    keys = []
    for block in details.split("\n\n"):
        if re.match(r"\(\d+\) Exchange\b", block.strip()):
            m = re.search(r"Arguments: hashpartitioning\((.*), \d+\)", block)
            if m:
                keys.append(re.sub(r"#\d+L?", "", m.group(1)).strip())
    return keys


def summary(df: DataFrame) -> dict:
    text = plan_text(df, "formatted")
    return {
        "shuffles": dict(Counter(shuffle_keys(df))),
        "reused_exchanges": len(re.findall(r"\(\d+\) ReusedExchange", text)),
        "broadcast_exchanges": len(re.findall(r"\(\d+\) BroadcastExchange", text)),
        "read_schemas": sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", text))),
    }
