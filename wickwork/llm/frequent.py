"""Tables of keys with a number each, cut into a frequent part of bounded size,
which workers hold, and the rest, which is joined.

A third of all tokens may be one word. Sending a row for each of them to one
task is avoided by adding up frequent keys where the document is read; only
keys that are rare in the whole corpus are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most so many keys can each have a LIMIT-th of all occurrences.
LIMIT = 1 << 20
# Longer keys are never held by workers, so that LIMIT bounds the bytes too.
LONGEST = 64


def frequent(counts: DataFrame, key: str, value: str, often: str, limit: int = LIMIT) -> dict:
    """key -> value of the keys with more than a ``limit``-th of all occurrences.

    ``often`` is the column with a key's occurrences. Since those add up to the
    total, there are fewer than ``limit`` such keys, of at most LONGEST bytes.
    """
    total = counts.agg(F.sum(often)).first()[0] or 0
    rows = counts.where((F.col(often) > total / limit) & (F.octet_length(key) <= LONGEST))
    return {r[0]: r[1] for r in rows.select(key, value).toLocalIterator(prefetchPartitions=True)}
