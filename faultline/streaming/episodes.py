"""One alert per episode of breaching windows, on a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from faultline.operators.analytics import with_error_rate
from faultline.streaming.windows import windowed_counts

ALERT_SCHEMA = "service string, episode_start bigint, total_events bigint, error_events bigint"


def first_of_episode(step: int) -> StatefulProcessor:
    """Passes a breaching window on unless the one before it, `step` seconds earlier, breached too.

    The state of a service is the start of its last breaching window. The class is local so that it
    travels to the executors with the query and they need no copy of this package.
    """

    class FirstOfEpisode(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last_breach", "start bigint")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            # Only the breaching windows of one batch arrive here, a few per service.
            windows = pd.concat(list(rows)).sort_values("second")
            seconds = windows["second"].tolist()
            before = [self.last.get()[0] if self.last.exists() else None, *seconds]
            starts = [last is None or second != last + step for last, second in zip(before, seconds)]
            self.last.update((seconds[-1],))
            first = windows[starts]
            yield pd.DataFrame(
                {
                    "service": key[0],
                    "episode_start": first["second"],
                    "total_events": first["total_events"],
                    "error_events": first["error_events"],
                }
            )

        def close(self) -> None:
            pass

    return FirstOfEpisode()


def stream_alert_episodes(
    events: DataFrame, delay: str, minutes: int = 60, min_events: int = 2, max_error_pct: float = 20.0
) -> DataFrame:
    """The first window of each episode; watermarks release windows in time order, so state never goes back."""
    counted = windowed_counts(events, f"{minutes} minutes", delay)
    breaching = with_error_rate(counted).filter(
        (F.col("total_events") >= min_events) & (F.col("error_rate_pct") > max_error_pct)
    )
    starts = (
        breaching.select("service", F.unix_seconds("window.start").alias("second"), "total_events", "error_events")
        .groupBy("service")
        .transformWithStateInPandas(
            first_of_episode(minutes * 60), outputStructType=ALERT_SCHEMA, outputMode="append", timeMode="None"
        )
    )
    return starts.withColumn("episode_start", F.timestamp_seconds("episode_start").cast("timestamp_ntz"))
