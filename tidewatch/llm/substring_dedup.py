"""Substring de-duplication behind a count-min prefilter.

Each chunk sketches its distinct windows; merged sketches overestimate how
often a window occurs; a second pass groups exactly only the windows estimated
to repeat.  An overestimate never falls below the true count, so no repeat is
lost.  See `repeats` for the plan, the rule and the treatment of nulls, ties
and repeated rows.  An empty table gives an empty result; texts shorter than a
window keep all words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.llm.repeats import CountMin, repeated_words

#: words of a window
WINDOW = 20


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the words of repeated windows removed from ``text``; adds
    n_words, n_removed and the removed spans."""
    return repeated_words(docs, window, CountMin, doc_id, text)
