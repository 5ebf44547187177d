"""What a run says while it works: a log, and how far its tasks have come."""

from __future__ import annotations

import logging
import threading
import time

from pyspark.sql import SparkSession

_LOG = logging.getLogger("screenforge")


class RunLog:
    """Lines for the console, by way of logging, and for the run's folder."""

    def __init__(self) -> None:
        self.lines: list[str] = []

    def _add(self, level: int, text: str) -> None:
        self.lines.append(f"{time.strftime('%Y-%m-%d %H:%M:%S')} | {logging.getLevelName(level):<7} | {text}")
        _LOG.log(level, text)

    def info(self, text: str) -> None:
        self._add(logging.INFO, text)

    def warn(self, text: str) -> None:
        self._add(logging.WARNING, text)

    def text(self) -> str:
        return "".join(f"{x}\n" for x in self.lines)


class Progress:
    """Logs, every few seconds, the finished tasks of the stages at work and the time that the rest may take."""

    def __init__(self, spark: SparkSession, log: RunLog, every: float = 10.0) -> None:
        self.tracker, self.log, self.every = spark.sparkContext.statusTracker(), log, every
        self.over = threading.Event()
        self.thread = threading.Thread(target=self._watch, daemon=True)

    def _watch(self) -> None:
        began: dict[int, float] = {}
        while not self.over.wait(self.every):
            for stage in self.tracker.getActiveStageIds():
                at = self.tracker.getStageInfo(stage)
                if at is None or not at.numTasks:
                    continue
                since = time.time() - began.setdefault(stage, time.time())
                left = f", about {since / at.numCompletedTasks * (at.numTasks - at.numCompletedTasks):.0f} s left" if since and at.numCompletedTasks else ""
                self.log.info(f"stage {stage}: {at.numCompletedTasks} of {at.numTasks} tasks{left}")

    def __enter__(self) -> Progress:
        self.thread.start()
        return self

    def __exit__(self, *_) -> None:
        self.over.set()
        self.thread.join()
