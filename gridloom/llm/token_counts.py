"""Token counts of whole texts by rank-synchronous array merging.

Input: any table with an id and a text column; other columns are ignored. Null
text counts as empty (0 bytes, 0 tokens). A row gives a row: repeated rows,
repeated ids and null ids stay as they are. An empty table gives an empty table.
The special strings of the vocabulary count as one token where they stand in a
text, as the library does by default; nothing is added, cut off or padded.

Words known already are told by a 64-bit hash of their bytes. Very long texts are
taken whole, one at a time. Columns of other names, and clashing ones, are left out.

No shuffle: one narrow pass. Memory in a worker: one Arrow batch, the words of one
slab (or one longer text) and the words kept by the merger (bounded, see ``_wordbpe``).
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gridloom.llm._spark import map_texts


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = 2048) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row of ``docs``."""
    path = vocabulary or default_vocabulary()

    def kernel(batch: pa.RecordBatch) -> list:
        from gridloom.llm import _wordbpe

        text = batch.column(batch.num_columns - 1).fill_null("")
        tokens = pa.array(_wordbpe.load(path).count(text), pa.int64())
        return [pc.binary_length(text).cast(pa.int64()), tokens, pc.greater(tokens, limit)]

    return map_texts(docs, [id_col, text_col], "n_bytes long, n_tokens long, over_limit boolean", kernel)
