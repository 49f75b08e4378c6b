"""Token counts of a byte-level BPE without keeping ids.

The vocabulary strings that encode alone as one token are proved once per vocabulary (``bpe.whole_tokens``). A pre-token that
is such a string counts one; only the others are merged, each different one once per slice of text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from oslogs.llm import bpe
from oslogs.llm.common import map_batches

_LOADED: dict[str, bpe.Encoder] = {}


def counter(path: str) -> bpe.Encoder:
    """The counting encoder of a vocabulary file, once per worker."""
    if path not in _LOADED:
        vocabulary = bpe.Vocabulary(path)
        _LOADED[path] = bpe.Encoder(vocabulary, bpe.Rounds(vocabulary))
    return _LOADED[path]


def token_counts(df: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row's whole text.

    A null text counts as an empty one: no bytes, no tokens. Rows are treated alone, so repeated rows and ids stay; an empty
    table gives an empty one. Other columns are not read, whatever their names.
    """

    def rows(batches):
        encoder = counter(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = list(encoder.counts(texts))
            yield {"id": batch.column(0), "n_bytes": [len(t.encode()) if t else 0 for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

    few = df.select(df[id_col].cast("bigint").alias("id"), df[text_col].alias("text"))
    return map_batches(few, rows, "id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("id", id_col)
