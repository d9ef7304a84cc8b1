"""Bounded batches of texts for Python workers."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows and bytes of texts that a Python worker is handed at a time.
BOUNDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def bounded(docs: DataFrame) -> DataFrame:
    """``docs``; its session hands at most the bounds' rows and bytes at a time to Python from here on.

    The settings are read when a plan is made, which is after the operator has returned its frame; so they stay set. A session
    that asks for less keeps what it asks for.
    """
    conf = docs.sparkSession.conf
    for setting, most in BOUNDS.items():
        now = conf.get(setting, None)
        if now is None or not 0 < size_of(now) <= most:
            conf.set(setting, str(most))
    return docs


def size_of(setting: str) -> int:
    """A number of rows, or of bytes with an optional unit."""
    units = {"k": 10, "m": 20, "g": 30}
    text = setting.strip().lower().removesuffix("b")
    return int(text[:-1]) << units[text[-1]] if text[-1:] in units else int(text)
