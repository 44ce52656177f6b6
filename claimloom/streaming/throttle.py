"""Requests to hosts as a stream: what became of each, with what a host has refused kept as state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from claimloom.operators.retrieval import LONGEST_WAIT, REFUSALS_TO_QUARANTINE

#: The state store that keyed state with timers needs: spark.sql.streaming.stateStore.providerClass.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = "host string, seq bigint, status int, outcome string, resume_at timestamp"


class Hosts(StatefulProcessor):
    """Refusals of a host, until when it asks to wait, and when it was last asked.

    Every request gets the outcome that ``retrieval.outcomes`` gives it in a batch: quarantined after the host's third
    403, deferred where it asks for a long wait, retried, failed or ok. A deferred one tells when the host may be asked
    again, and a timer gives a row ``resumed`` (without seq) then, unless the host is in quarantine. With ``quiet_ms`` a host that was not asked for so
    long is forgotten, its quarantine with it.
    """

    def __init__(self, quiet_ms: int | None = None):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("host", "refusals int, resume_ms bigint, last_ms bigint")

    def _now(self) -> tuple[int, int, int]:
        return tuple(self.state.get()) if self.state.exists() else (0, 0, 0)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        refusals, resume, last = self._now()
        out = []
        given = pd.concat(rows).sort_values("seq")
        arrived = given["arrived"].dt.tz_localize(None).astype("datetime64[ms]").astype("int64")
        for seq, status, wait, at in zip(given["seq"], given["status"], given["retry_after"].fillna(0), arrived, strict=True):
            last, until = max(last, int(at)), None
            again = status == 429 or status >= 500
            if refusals >= REFUSALS_TO_QUARANTINE:
                outcome = "quarantined"
            elif again and wait > LONGEST_WAIT:
                outcome, until = "deferred", int(at) + int(wait) * 1000
                resume = max(resume, until)
            else:
                outcome = "retried" if again else "failed" if status >= 400 else "ok"
            refusals += status == 403
            out.append((key[0], seq, status, outcome, None if until is None else pd.Timestamp(until, unit="ms")))
        self.state.update((min(int(refusals), REFUSALS_TO_QUARANTINE), resume, last))
        now = timerValues.getCurrentWatermarkInMs()
        for at in (resume, last + self.quiet_ms if self.quiet_ms else 0):
            if at > now:
                self.handle.registerTimer(at)
        yield _frame(out)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at, (refusals, resume, last) = expiredTimerInfo.getExpiryTimeInMs(), self._now()
        # A later wait or request has a timer of its own.
        if self.quiet_ms and last and at >= last + self.quiet_ms:
            self.state.clear()
        if at == resume and refusals < REFUSALS_TO_QUARANTINE:
            yield _frame([(key[0], None, None, "resumed", pd.Timestamp(at, unit="ms"))])

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    found = pd.DataFrame(rows, columns=["host", "seq", "status", "outcome", "resume_at"])
    return found.astype({"seq": "Int64", "status": "Int32", "resume_at": "datetime64[ms]"})


def outcomes(requests: DataFrame, delay: str = "10 minutes", quiet_ms: int | None = None) -> DataFrame:
    """host, seq, status, outcome and resume_at of a stream of requests (host, seq, status, retry_after, arrived); see ``Hosts``.

    Arrivals of a host come in the order of seq, in batches of any size, which bound what a task holds; the watermark lags ``delay``. Sessions need ``STATE_STORE``.
    """
    keyed = requests.select("host", "seq", "status", "retry_after", "arrived").withWatermark("arrived", delay).groupBy("host")
    return keyed.transformWithStateInPandas(statefulProcessor=Hosts(quiet_ms), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")
