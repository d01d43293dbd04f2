"""A source's next release merged into the elements that are there: states, history, and what must be embedded again.

Elements are kept by key (authority and code, say). A full outer join of the two snapshots gives each key its
state; of elements that claim the same thing the one with the older accession stays active. Nothing is decided
by order of rows or by windows: winners are an aggregate over claims, so a claim that a third of all elements
make is summed up before it is shuffled.

States: new, same, changed (another content hash), returned (was inactive, is back), retired (was active, is
not in the release), gone (was inactive and still isn't there), replaced (another element has its claim).

Defined results: null parts of a key are equal; of rows of a release with one key the smallest by hash, then
version, then claim counts; a null hash is a content of its own; elements without a claim replace none; an empty
release retires all, an empty table makes all new; a release that is merged twice changes nothing the second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a merge reads of a release, besides the key, and what elements have more.
RELEASE = ("content_hash", "source_version", "claim")
KEPT = (*RELEASE, "accession", "is_active")


def _key(keys: list[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def _once(df: DataFrame, keys: list[str], columns: tuple[str, ...]) -> DataFrame:
    """One row for each key."""
    first = df.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("first"))
    return first.select(*keys, *[F.col(f"first.{c}").alias(c) for c in columns])


def merge(elements: DataFrame, release: DataFrame, keys: list[str], number: int) -> DataFrame:
    """Elements after a release: keys, content_hash, source_version, claim, accession, is_active, replaced_by, state, old_hash, old_version.

    elements: keys and KEPT; of a merge's own result further columns are left out. release: keys and RELEASE.
    number: the release's own, which rises; it is the accession of what is new. replaced_by: the winner's key.
    """
    old = _once(elements, keys, KEPT).select(F.lit(True).alias("was"), _key(keys).alias("old_key"), *[F.col(c).alias(f"old_{c}") for c in KEPT])
    come = _once(release, keys, RELEASE).select(F.lit(True).alias("is"), _key(keys).alias("key"), *RELEASE)
    both = old.join(come, F.col("old_key").eqNullSafe(F.col("key")), "full_outer")
    was, here, active = F.col("was").isNotNull(), F.col("is").isNotNull(), F.coalesce("old_is_active", F.lit(False))
    same = F.col("old_content_hash").eqNullSafe(F.col("content_hash"))
    # An element that another replaced is inactive, yet neither returns nor changes by being in the next release.
    state = (
        F.when(~was, "new").when(here & ~same, "changed").when(here & ~active, "returned").when(here, "same").when(active, "retired").otherwise("gone")
    )
    now = lambda c: F.when(here, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c)
    merged = both.select(
        F.coalesce("key", "old_key").alias("key"), *[now(c) for c in RELEASE], F.coalesce("old_accession", F.lit(number)).cast("long").alias("accession"), here.alias("here"), state.alias("state"),
        F.col("old_content_hash").alias("old_hash"), F.col("old_source_version").alias("old_version"), active.alias("was_active"),
    )
    claims = merged.filter("here AND claim IS NOT NULL").groupBy("claim").agg(F.min(F.struct("accession", "key")).alias("winner"))
    won = merged.join(claims.select(F.col("claim").alias("of"), F.col("winner.key").alias("winner")), F.col("claim") == F.col("of"), "left")
    lost = F.coalesce(F.col("here") & F.col("winner").isNotNull() & ~F.col("winner").eqNullSafe(F.col("key")), F.lit(False))
    # What was replaced before, and is so still, is as it was.
    return won.select(
        *[F.col("key")[k].alias(k) for k in keys], *RELEASE, "accession", (F.col("here") & ~lost).alias("is_active"), F.when(lost, F.col("winner")).alias("replaced_by"),
        F.when(lost, "replaced").otherwise(F.col("state")).alias("state"), "old_hash", "old_version",
    )


def history(merged: DataFrame, keys: list[str], number: int) -> DataFrame:
    """What a release changed, a row an element: keys, release, state, old and new hash and version; to be appended to what there is."""
    told = merged.filter(~F.col("state").isin("same", "gone") & ~((F.col("state") == "replaced") & F.col("old_hash").eqNullSafe(F.col("content_hash")) & F.col("old_version").eqNullSafe(F.col("source_version"))))
    return told.select(*keys, F.lit(number).cast("long").alias("release"), "state", "old_hash", F.col("content_hash").alias("new_hash"), "old_version", F.col("source_version").alias("new_version"))


def to_embed(merged: DataFrame, stored: DataFrame) -> DataFrame:
    """(content_hash): contents of active elements that have no embedding yet, each once: an unchanged content is never embedded again."""
    wanted = merged.filter("is_active AND content_hash IS NOT NULL").select("content_hash").distinct()
    return wanted.join(stored.select("content_hash").distinct(), "content_hash", "left_anti")
