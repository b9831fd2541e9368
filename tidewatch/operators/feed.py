"""News-feed operators.

The reference polls a feed, takes its first five items, and publishes an item
only the first time its link hash is seen.  Here the same rules are set
operations over a table of polled items:

* ``first_items_per_poll``: top-5 per poll by feed position (bounded groups);
* ``first_sighting``: one row per link hash, the earliest in feed order,
  computed with ``min_by`` so partial aggregation collapses a hot link inside
  each task before the shuffle;
* ``exclude_seen``: anti-join against an archive of already-published keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import link_hash
from tidewatch.operators.ranking import top_k

# ---- fixed values: producer rule of the reference ---------------------------
ITEMS_PER_POLL = 5
# -----------------------------------------------------------------------------


def with_link_hash(items: DataFrame, link_col: str = "link", out: str = "link_md5") -> DataFrame:
    """the message key of a report."""
    return items.withColumn(out, link_hash(F.col(link_col)))


def first_items_per_poll(items: DataFrame, k: int = ITEMS_PER_POLL, poll: str = "poll_id",
                         position: str = "position") -> DataFrame:
    """The first ``k`` items of every poll, in feed order."""
    return top_k(items, [poll], [F.col(position).asc()], k, name="rank")


def first_sighting(items: DataFrame, key: str = "link_md5",
                   order=("poll_id", "position")) -> DataFrame:
    """Distinct by key, keeping the earliest row in feed order."""
    others = [c for c in items.columns if c != key]
    packed = F.struct(*[F.col(c) for c in others])
    first = items.groupBy(key).agg(F.min_by(packed, F.struct(*[F.col(c) for c in order])).alias("_f"))
    return first.select(key, *[F.col(f"_f.{c}").alias(c) for c in others])


def exclude_seen(items: DataFrame, seen: DataFrame, key: str = "link_md5") -> DataFrame:
    """Drop items whose key is already in the archive (left anti join on
    the key only, so a hot key is a hash probe, never a pair expansion)."""
    return items.join(seen.select(key).distinct(), key, "left_anti")


def new_reports(items: DataFrame, archive: DataFrame | None = None, k: int = ITEMS_PER_POLL) -> DataFrame:
    """The producer's rule over a whole feed history: first ``k`` items of
    each poll, each link published once at its first sighting, minus links
    already in ``archive``."""
    cands = with_link_hash(first_items_per_poll(items, k)).drop("rank")
    fresh = first_sighting(cands)
    return exclude_seen(fresh, archive) if archive is not None else fresh
