"""Suffix de-duplication, with hashed seeds in place of a suffix array.

Keeps seeds at content-selected minimiser positions only (about one word
position in fourteen) and groups their hashes shard by shard; the windows
around repeated seeds are compared exactly.  Any repeat of ``window`` words or
more contains a kept seed at the same offset in both places, so none is lost.  See `repeats` for
the plan, the rule and the treatment of nulls, ties and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.llm.repeats import SparseSuffixes, repeated_words

#: shortest repeat that is removed, in words
WINDOW = 50


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with all but the first copy of repeats of at least ``window``
    words removed from ``text``; adds n_words, n_removed and spans.  Null, empty
    and very long texts, repeated rows and empty tables as in `repeated_words`."""
    seed = max(1, window // 2)
    return repeated_words(docs, window, lambda _: SparseSuffixes(window, seed), doc_id, text)
