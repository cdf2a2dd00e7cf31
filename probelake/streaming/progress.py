"""Offset ledger written from query progress."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.offsets import LEDGER


def ledger_rows(sources: list[dict], grp: str, batch: int, cost_ms: int) -> Iterator[tuple]:
    """One row per topic and partition from the start and end offsets of a batch."""
    for source in sources:
        end = _offsets(source.get("endOffset"))
        start = _offsets(source.get("startOffset"))
        for topic, parts in end.items():
            for part, until in parts.items():
                yield topic, grp, int(part), batch, int(start.get(topic, {}).get(part, 0)), int(until), cost_ms


def _offsets(value: str | dict | None) -> dict[str, dict[str, int]]:
    """``{"topic": {"partition": offset}}``; other sources report one log position."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return {}
    if not isinstance(value, dict):
        return {}
    if set(value) == {"logOffset"}:
        # File sources count from -1; the position after an entry is its number plus 1.
        return {"files": {"0": int(value["logOffset"]) + 1}}
    return {t: p for t, p in value.items() if isinstance(p, dict)}


class OffsetLedger(StreamingQueryListener):
    """Appends the offsets and cost of every batch that read something."""

    def __init__(self, spark: SparkSession, root: str, grp: str) -> None:
        self._spark, self._root, self._grp = spark, root, grp

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = json.loads(event.progress.json)
        if not progress.get("numInputRows"):
            return
        cost = int(progress.get("durationMs", {}).get("triggerExecution", 0))
        rows = list(ledger_rows(progress.get("sources", []), self._grp, int(progress["batchId"]), cost))
        if rows:
            self._spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(self._root)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
