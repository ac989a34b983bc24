"""Sending batches to a remote index through a user callback."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from itemsync.schemas import RESPONSES

def _plain(value):
    """Lists arrive as arrays; callbacks get lists."""
    return value.tolist() if isinstance(value, np.ndarray) else value


Send = Callable[[list[dict]], list[dict]]


def with_retry(call: Callable, retries: int, sleep: Callable[[float], None] = time.sleep):
    """Call with growing pauses of 2, 4, 8 ... seconds; the last failure is raised."""

    def run(argument):
        for attempt in range(1, retries + 1):
            try:
                return call(argument)
            except Exception:
                if attempt == retries:
                    raise
                sleep(2**attempt)

    return run


def send_batches(
    documents: DataFrame,
    batch: list[str],
    send: Send,
    retries: int = 3,
    order: str | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Send each batch once and return its responses (``id``, ``errors``).

    ``documents`` carry the batch columns of ``consumer_batches``. The rows of a
    batch are brought together and sorted; a task holds one batch at a time. A
    lost task sends its batches again, which an upsert by id allows. Write the
    result down before it is used twice.
    """
    together = documents.repartition(*batch).sortWithinPartitions(*batch, *([order] if order else []))
    fields = [name for name in documents.columns if name not in batch and name != order]
    call = with_retry(send, retries, sleep)

    def answers(rows: list[dict]) -> pd.DataFrame:
        replies = call(rows)
        return pd.DataFrame({"id": [r["id"] for r in replies], "errors": [list(r["errors"]) for r in replies]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key, held = None, []
        for frame in frames:
            for key, rows in frame.groupby(batch, sort=False, dropna=False):
                if held and key != open_key:
                    yield answers(held)
                    held = []
                open_key = key
                held += [{k: _plain(v) for k, v in row.items()} for row in rows[fields].to_dict("records")]
        if held:
            yield answers(held)

    return together.mapInPandas(run, RESPONSES)
