"""What jobs say, kept beside the usual output: a store of log records that can be saved as a table."""

from __future__ import annotations

import logging
import warnings
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime, timezone

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession


class LogStore(logging.Handler):
    """Keeps the records of a logger (time, job, level, text); `with` adds it to the logger, also for Python warnings, and takes it off again.

    `ignore`: texts whose records are left out. It holds at most `most` records, the latest.
    """

    def __init__(self, job: str = "", ignore: Iterable[str] = (), name: str = "minespark", most: int = 100_000):
        super().__init__()
        self.job, self.ignore, self.logger, self.most = job, tuple(ignore), logging.getLogger(name), most
        self.kept: list[tuple] = []

    def emit(self, record: logging.LogRecord) -> None:
        text = record.getMessage()
        if not any(x in text for x in self.ignore):
            self.kept.append((datetime.fromtimestamp(record.created, timezone.utc).replace(tzinfo=None), self.job, record.levelname, text))
            del self.kept[: -self.most]

    def __enter__(self) -> LogStore:
        self.logger.addHandler(self)
        self._level, self._show = self.logger.level, warnings.showwarning
        self.logger.setLevel(min(self.logger.level or logging.INFO, logging.INFO))
        warnings.showwarning = lambda message, *_: self.logger.warning("%s", message)
        return self

    def __exit__(self, *_) -> None:
        self.logger.removeHandler(self)
        self.logger.setLevel(self._level)
        warnings.showwarning = self._show

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.kept, "at timestamp_ntz, job string, level string, text string")


def run_jobs(spark: SparkSession, jobs: Mapping[str, Callable[[], object]], at_once: int = 1) -> dict[str, str]:
    """Runs named jobs, some at once, each as a Spark job group of its name: "succeed", or the error of each. One that fails stops no other, but
    a lack of memory is raised."""
    said: dict[str, str] = {}

    def run(name: str) -> None:
        spark.sparkContext.setJobGroup(name, name)
        try:
            jobs[name]()
            said[name] = "succeed"
        except Exception as e:
            said[name] = f"{type(e).__name__}: {e}"
            logging.getLogger("minespark").error("%s: %s", name, e)

    names = list(jobs)
    for i in range(0, len(names), at_once):
        threads = [InheritableThread(target=run, args=(n,), session=spark) for n in names[i : i + at_once]]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    lost = [n for n, x in said.items() if "OutOfMemoryError" in x or x.startswith("MemoryError")]
    if lost:
        raise MemoryError(f"out of memory: {lost}")
    return {n: said[n] for n in names}
