"""The values before each value of a series, as a stateful operator."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

RECENT = "metric STRING, ts TIMESTAMP_NTZ, value DOUBLE, before ARRAY<DOUBLE>"


class Recent(StatefulProcessor):
    """Adds to every (metric, ts, value) the ``n`` values before it, oldest first; fewer at the start.

    Rows of a batch are taken in order of time. A watermark closes buckets in that order, so no later batch
    brings an earlier one. The state is one array of at most ``n`` values for each metric.
    """

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState("ring", "held ARRAY<DOUBLE>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("ts", kind="stable")  # a row a bucket
        held = list(self.ring.get()[0]) if self.ring.exists() else []
        before = []
        for value in new["value"]:
            before.append(list(held))
            held = [*held, None if np.isnan(value) else float(value)][-self.n:]
        self.ring.update((held,))
        yield pd.DataFrame({"metric": key[0], "ts": new["ts"].to_numpy(), "value": new["value"].to_numpy(),
                            "before": before})

    def close(self) -> None:
        pass
