"""Link-unique store merge (M1, M2, J1, J2, S13, S15, S16; ``store.py`` writes the result, S12).

A link lives in at most one collection.  A batch of candidates (in input order ``seq``) is
merged in one pass:

* ``duplicate``  the link's current collection equals the candidate's
  (the stored row stays unchanged);
* ``moved``      the link lives in another collection (delete + insert);
* ``inserted``   the link is new.

After any step the link's current collection is that of the last candidate
seen, so a candidate's "current collection" is the previous candidate's
collection for the same link, or the stored one for the first candidate.
That closed form replaces the row-at-a-time loop.

Skew: a link repeated a third of all rows would put a third of the batch in
one window partition.  The previous-candidate lookup is therefore split in
``seq`` chunks: the window runs per (link, chunk), and only the last
collection of each (link, chunk) — one row per chunk, from a partial
aggregate — is carried across chunk borders by a second, tiny window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .metrics import collection_rank

DEFAULT_CHUNK = 1 << 20


def current_collection(store: DataFrame) -> DataFrame:
    """(link, existing_collection) — first collection in the fixed order.

    A hash aggregate (partial + final), so a link present many times costs
    one partial row per task.
    """
    return store.groupBy("link").agg(
        F.min_by("collection_name", collection_rank()).alias("existing_collection"))


def store_for(store: DataFrame, batch: DataFrame) -> DataFrame:
    """The stored rows whose link occurs in the batch (left semi join).

    The batch's distinct links are usually far smaller than the store: AQE
    then broadcasts them (within the 32 MB cap) and the store is filtered
    where it is read instead of being shuffled whole; a large batch falls
    back to a shuffled semi join.
    """
    return store.join(batch.select("link").distinct(), "link", "left_semi")


def link_exists(df: DataFrame, store: DataFrame) -> DataFrame:
    """Rows of ``df`` whose (collection_name, link) is in the store."""
    return df.join(store.select("collection_name", "link"), ["collection_name", "link"], "left_semi")


def merge_actions(candidates: DataFrame, store: DataFrame, chunk: int = DEFAULT_CHUNK,
                  outcome: str | None = None) -> DataFrame:
    """M1: one ``action`` per candidate (seq, link, collection_name, ...).

    Returns the input columns plus ``previous_collection`` and ``action``;
    pass keys only (the documents join later by ``seq``, see :func:`new_state`).
    With ``outcome`` (P12's column), rows whose outcome is not
    ``candidate`` keep that outcome as their action and are invisible to
    the merge, so a whole run's results go through one pass.  Shuffles:
    the rows once by (link, chunk), the store once by link; the per-chunk
    tails are a small table.
    """
    cand = (F.col(outcome) == "candidate") if outcome else F.lit(True)
    c = candidates.withColumns({
        "_chunk": F.floor(F.col("seq") / F.lit(chunk)),
        "_coll": F.when(cand, F.col("collection_name")),
        "_cseq": F.when(cand, F.col("seq")),
    })
    part = Window.partitionBy("link", "_chunk").orderBy("seq")
    c = c.withColumns({
        "_prev": F.last("_coll", ignorenulls=True).over(part.rowsBetween(Window.unboundedPreceding, -1)),
        # the chunk's last candidate collection, from the same window pass
        "_tail": F.last("_coll", ignorenulls=True).over(
            part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    # one row per (link, chunk); the rows are already clustered that way
    chunks = c.groupBy("link", "_chunk").agg(F.first("_tail").alias("_tail"))
    # the last candidate collection of any earlier chunk of the same link
    across = (Window.partitionBy("link").orderBy("_chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    chunks = (chunks.withColumn("_prev_tail", F.last("_tail", ignorenulls=True).over(across))
              .join(current_collection(store_for(store, candidates)), "link", "left")
              .select("link", "_chunk", F.coalesce("_prev_tail", "existing_collection").alias("_before")))

    out = c.join(chunks, ["link", "_chunk"], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_before"))
    action = (F.when(~cand, F.col(outcome) if outcome else F.lit(None))
              .when(prev.isNull(), F.lit("inserted"))
              .when(prev == F.col("collection_name"), F.lit("duplicate"))
              .otherwise(F.lit("moved")))
    return (out.withColumns({"previous_collection": F.when(cand, prev), "action": action})
            .drop("_chunk", "_prev", "_before", "_coll", "_cseq", "_tail"))


def document_id(link="link") -> Column:
    """A document's id, the same for a link in every run (a name-based UUID)."""
    h = F.md5(F.col(link) if isinstance(link, str) else link)
    return F.concat_ws("-", *[F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def new_state(store: DataFrame, actions: DataFrame, documents: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    """M2: store after the merge.

    Untouched stored rows, plus for every changed link its last
    non-duplicate candidate.  Only keys are aggregated (a maximum of ``seq``
    per link, with a partial phase, safe for hot links); the winners' rows are then taken
    from ``documents`` (the candidates with all their columns; default: ``actions``) by ``seq``.
    With ``now`` the new rows get P1's ``id``, ``created_at`` and ``updated_at``; a link that was
    stored before keeps its ``created_at``.
    """
    changed = actions.filter(F.col("action") != "duplicate").select("link", "seq")
    last = changed.groupBy("link").agg(F.max("seq").alias("seq"))
    source = documents if documents is not None else actions
    new = source.join(last.select("seq"), "seq", "left_semi")
    if now is not None:
        born = store.select("link", F.col("created_at").alias("_born"))
        new = new.join(born, "link", "left").withColumns({
            "id": document_id(), "created_at": F.coalesce("_born", now), "updated_at": now}).drop("_born")
    else:
        new = new.drop("action", "previous_collection")
    kept = store.join(last.select("link"), "link", "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def delete_links(store: DataFrame, keys: DataFrame) -> DataFrame:
    """Drop the stored rows whose (collection_name, link) is in ``keys``."""
    return store.join(keys.select("collection_name", "link"), ["collection_name", "link"], "left_anti")


def resolve_users(requested: DataFrame, users: DataFrame) -> DataFrame:
    """Existing users win; unknown names get split names and a new id.

    ``requested`` has ``full_name``; ``users`` has at least ``full_name``.
    Returns the new user rows (id, full_name, first_name, last_name,
    created_at); ``users.unionByName(new, allowMissingColumns=True)`` is the
    dimension after the run.
    """
    names = requested.select("full_name").distinct()
    new = names.join(users.select("full_name"), "full_name", "left_anti")
    parts = T.split_full_name("full_name")
    return new.select(
        F.expr("uuid()").alias("id"), "full_name",
        parts["first_name"].alias("first_name"), parts["last_name"].alias("last_name"),
        F.current_timestamp().alias("created_at"))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (unique-key audit)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))

