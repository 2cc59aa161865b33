"""Metrics that a query reports as its rows pass by."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from queue import Empty, SimpleQueue
from threading import Thread

from pyspark.sql import Observation, Row

PATIENCE = 60.0


def observed_metrics(
    observation: Observation, recompute: Callable[[], Row], patience: float = PATIENCE
) -> dict[str, int]:
    """The metrics of a query that has ended, or the same values computed again, with a warning.

    Spark delivers them by an event, and drops events when a job with very many tasks floods
    its queue. Waiting for a dropped one would never end, so after ``patience`` seconds the
    metrics are computed from the rows once more, which costs another pass over them.
    """
    answers: SimpleQueue[dict] = SimpleQueue()
    Thread(target=lambda: answers.put(observation.get), daemon=True).start()
    try:
        return answers.get(timeout=patience)
    except Empty:
        warnings.warn(
            f"the metrics of a query did not arrive in {patience:g} s; computing them again",
            RuntimeWarning,
            stacklevel=2,
        )
        return recompute().asDict()
