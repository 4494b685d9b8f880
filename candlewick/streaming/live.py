"""The live quote job (R01-R05 together): landed snapshot files -> de-duplicated
quotes -> history (exactly once per batch), and landed snapshot files -> changed
codes -> latest quote per code and provisional daily bars against the stored
bars. Two streams over the same files, each with its own checkpoint."""

from __future__ import annotations

import hashlib
import time

from candlewick.plans.market import Market
from candlewick.schema import QUOTE
from candlewick.session import shared_dir
from candlewick.streaming import latest
from candlewick.streaming import quotes as Q


class Streams:
    """Several streaming queries, awaited and stopped together."""

    def __init__(self, *queries):
        self.queries = queries

    def awaitTermination(self, timeout: float | None = None) -> bool:
        """Whether all have ended in time; the error of one that fails ends the waiting."""
        end = None if timeout is None else time.monotonic() + timeout
        while not all([q.awaitTermination(1) for q in self.queries]):
            if end is not None and time.monotonic() > end:
                return False
        return True

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def start(spark, m: Market, quotes_dir: str, out_root: str, as_of, available_now: bool = True,
          watermark: str = "1 hour", checkpoint: str | None = None) -> Streams:
    """Start the streams; landed files follow ``schema.QUOTE`` (date + time
    text, as the feed delivers them).

    The checkpoints (offsets, de-duplication state, latest quotes) lie in the
    shared folder under a name derived from (quotes folder, output root,
    day): a restart of the same job resumes, another job never inherits its
    state.
    """
    if checkpoint is None:
        key = hashlib.sha1(f"{quotes_dir}|{out_root}|{as_of}".encode()).hexdigest()[:16]
        checkpoint = f"{shared_dir(spark)}/candlewick-streams/live-{key}"
    landed = lambda: Q.read_stream(spark, quotes_dir, QUOTE).withColumn("event_ts", Q.event_time())
    history = (Q.dedupe(landed(), watermark).writeStream.foreachBatch(Q.history_sink(f"{out_root}/live"))
               .option("checkpointLocation", f"{checkpoint}/history"))
    if available_now:
        history = history.trigger(availableNow=True)
    return Streams(history.start(), latest.start_latest(landed().drop("date", "time"), f"{out_root}/live", f"{checkpoint}/latest", m.stocks, as_of, available_now))
