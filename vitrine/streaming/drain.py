"""Waiting until a stream has taken in everything there is."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


def drain(query: StreamingQuery, timeout: float | None = None) -> None:
    """Waits for an available-now query, however long it takes unless ``timeout`` seconds are given.

    Raises TimeoutError after that time, the query stopped; what was committed
    stays, and the next run goes on from the checkpoint.  What was read is in
    the sink (``ingest.load_totals``): a query keeps the progress of its last
    batches only.
    """
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.id} still busy after {timeout} s")
