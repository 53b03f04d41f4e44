"""Acquisition: what is to be fetched, and the order, pace and report of fetching. Fetching itself is an interface."""

from __future__ import annotations

import time
from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from . import availability, joins


class Blocked(RuntimeError):
    """The other side refuses further requests."""


class Fetcher(ABC):
    @abstractmethod
    def fetch(self, video_id: str) -> None:
        """Fetch one video; raise with the reason where that fails."""


def wanted_openasl(rows: DataFrame) -> DataFrame:
    return rows.select(tx.present(F.col("yid")).alias("VIDEO_ID")).where("VIDEO_ID is not null").distinct()


def wanted_msasl(rows: DataFrame) -> DataFrame:
    return rows.select(tx.youtube_id(F.col("url")).alias("VIDEO_ID")).where("VIDEO_ID <> ''").distinct()


def wanted_wlasl(rows: DataFrame) -> DataFrame:
    """(VIDEO_ID, url): both are needed; the last url of an id wins."""
    both = rows.where(tx.present(F.col("url")).isNotNull() & tx.present(F.col("video_id")).isNotNull())
    return joins.last_wins(both.select(F.col("video_id").alias("VIDEO_ID"), "url", F.struct("i", "j").alias("at")), "VIDEO_ID", "at")


def fetch_all(wanted: DataFrame, there: DataFrame, fetcher: Fetcher, policy: str = "drop_unavailable", pause: float = 0.2, step: float = 0.1, most: float = 2.0, stop_on_block: bool = True, sleep: Callable[[float], None] = time.sleep, log: Callable[[str, str], object] | None = None) -> tuple[dict, list[tuple[str, str]]]:
    """({wanted, downloaded, errors, blocked}, [(VIDEO_ID, REASON)]). One after another, by id; every error lengthens the
    pause, if there is one. The ids stream to the driver, which fetches: the far side's pace is the bound, not the cluster's. With ``log``
    each failure goes there and only the first is kept."""

    def note(video_id: str, why: str) -> None:
        if log is not None:
            log(video_id, why)
        if log is None or not missing:
            missing.append((video_id, why))

    stats, missing = {"wanted": 0, "downloaded": 0, "errors": 0, "blocked": False}, []
    for row in availability.missing(wanted.select(wanted.columns[0]), there).toLocalIterator():
        stats["wanted"] += 1
        try:
            fetcher.fetch(row[0])
            stats["downloaded"] += 1
        except Blocked as e:
            note(row[0], str(e))
            stats["errors"] += 1
            if stop_on_block:
                stats["blocked"] = True
                break
        except Exception as e:  # a video's failure is its reason
            note(row[0], str(e))
            stats["errors"] += 1
            pause = min(most, pause + step) if pause else 0.0
        if pause:  # even a sleep of nothing costs a call of the system
            sleep(pause)
    if policy == "fail_fast" and missing:
        raise RuntimeError(f"{len(missing)} videos couldn't be fetched, such as {missing[0]}")
    return stats, missing


def reasons(spark: SparkSession, missing: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(missing, "VIDEO_ID string, REASON string")
