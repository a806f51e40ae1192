"""What symbols texts are made of."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 4_000_000  # characters that are counted at once, or more where one text has more


def symbol_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(symbol, n, n_docs): how often each character occurs, and in how many texts. Null and empty texts have none.

    Counted on code points under Arrow, so that a batch of texts sends a row for each of its few symbols into one aggregation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size = [], 0
            for i in range(b.num_rows):
                held.append(np.frombuffer((b.column(0)[i].as_py() or "").encode("utf-32-le", "surrogatepass"), np.uint32))
                size += len(held[-1])
                if size < PIECE and i < b.num_rows - 1:
                    continue
                owner = np.repeat(np.arange(len(held), dtype=np.uint64), [len(h) for h in held])
                pairs, n = np.unique(owner << np.uint64(32) | np.concatenate(held), return_counts=True)
                code, which = np.unique((pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32), return_inverse=True)
                n, docs_of = np.bincount(which, n, len(code)).astype(np.int64), np.bincount(which, minlength=len(code)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(list(map(chr, code.tolist())), pa.string()), pa.array(n), pa.array(docs_of)], ["symbol", "n", "n_docs"])
                held, size = [], 0

    counted = docs.select(F.col(text).cast("string")).mapInArrow(run, "symbol string, n long, n_docs long")
    return counted.groupBy("symbol").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
