"""Order-independent digests that aggregate map-side instead of collecting a group.

``set_digest`` adds the eight 32-bit words of every member's SHA-256 and hashes the sums with the
member count.  It needs O(1) state per group, so a group of any size never meets in one task.
Members must be distinct for set semantics; repeated members give multiset semantics.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS = 8


def row_text(columns: list[Column]) -> Column:
    """Canonical row text: values joined by U+001F, NULL as empty text."""
    return F.concat_ws("\u001f", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def set_digest(member: Column) -> Column:
    h = F.sha2(member, 256)
    sums = [F.sum(F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint")).cast("string") for i in range(WORDS)]
    return F.sha2(F.concat_ws("|", F.count(member).cast("string"), *sums), 256)


def short_hash(c: Column, n: int = 12) -> Column:
    return F.left(c, F.lit(n))
