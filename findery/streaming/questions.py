"""Questions that arrive as a stream, answered micro-batch by micro-batch with the batch plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from findery.operators import postings, retrieval
from findery.plans import hybrid
from findery.scratch import materialize


def answer_stream(questions: DataFrame, chunks: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, client: Callable | None = None, path: str | None = None, **trigger) -> StreamingQuery:
    """Each micro-batch is one set of questions over the corpus; ``sink(answers, batch_id)`` writes it, and may be called again with the same id after a failure.

    A question that can't be asked is refused in its row, and the stream goes on. ``path``: an index of
    ``postings``, of which every batch reads the version that is newest as it begins; without one, the
    corpus is tokenised once, when the stream starts. What a client says is kept beside the
    checkpoint, so a batch that is replayed asks nothing twice.
    """
    index = None if path else materialize(retrieval.sparse_index(chunks), "postings")

    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            now = postings.load(batch.sparkSession, path) if path else index
            sink(hybrid.ask(chunks, batch, client, index=now, ledger=f"{checkpoint.rstrip('/')}/generations" if client else None), batch_id)

    return questions.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
