"""Words of texts, in batches of columns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that count as symbols rather than text.
SYMBOLS = "#*$%&|<>"


@F.pandas_udf(T.StructType().add("size", T.LongType()).add("symbols", T.LongType()))
def sizes(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Words (runs of other than space and U+0009 to U+000D) and symbols; 0 for null."""
    for batch in texts:
        # Splitting bytes without an argument splits at exactly these six characters.
        rows = [
            (0, 0)
            if text is None
            else (len(text.encode().split()), sum(map(text.count, SYMBOLS)))
            for text in batch
        ]
        yield pd.DataFrame(rows, columns=["size", "symbols"])
