"""The SCD2 pipeline as a ``foreachBatch`` sink.

The stream's checkpoint knows which rows have been read, so no limit on the
change time is applied to a batch: a late source is not skipped. Rows may come in any
order and in any batches. The store remembers the last delete of every deleted
key, also of keys it has never held, and holds each row against it: a key is
current if its newest row is live and no delete is as new, whichever of
them came first. Of rows of one key with the same change time in different
batches, the first one's stays.
"""

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans import scd2
from ..sources.history import HistoryStore


def scd2_stream(
    rows: DataFrame,
    store: HistoryStore,
    spec: scd2.Spec,
    checkpoint: str,
    options: scd2.Options = scd2.DEFAULTS,
) -> StreamingQuery:
    """Apply each micro-batch of keyed change rows to the store, then stop.

    A batch carries the checkpoint and its number as a token, so one that is
    replayed after a failure is applied once.
    """
    options = replace(options, use_watermark=False)

    def apply(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()  # its rows and its deletes are two reads
        try:
            store.load(kept, spec, options, token=f"{checkpoint}#{batch_id}")
        finally:
            kept.unpersist()

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
