"""Change-aware keyed upsert.

A new key is inserted. A known key whose compared columns differ (NULL equals NULL) is
rewritten, `fetched_at` included. Any other row is skipped, and the stored row keeps its
`fetched_at`. A key may occur many times in a batch; rows then act in arrival order.

After each row the stored content equals that row's, written or not. So the outcome of a
row depends on the preceding row of its key alone, with the stored row as the first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolecall.operators.chain import PREVIOUS, previous_values
from rolecall.schemas import COMPARED

INSERTED, UPDATED, SKIPPED, FAILED = "inserted", "updated", "skipped", "failed"

DIGEST, ROW, PART = "_digest", "_staged", "_part"

Levels = Sequence[Sequence[str]]

DEALT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

# Rows of a key that are sorted in one task; a key with more is sorted in steps.
LONGEST = 10_000


def content_digest(compared: Sequence[str] = COMPARED) -> Column:
    """256 bits that tell contents apart: NULL from empty, and one column from the next."""
    return F.unhex(F.sha2(F.to_json(F.struct(*compared)), 256))


def with_digest(rows: DataFrame, compared: Sequence[str] = COMPARED) -> DataFrame:
    return rows if DIGEST in rows.columns else rows.withColumn(DIGEST, content_digest(compared))


def classify(
    incoming: DataFrame,
    state: DataFrame,
    arrival: Levels,
    key: str = "external_id",
    compared: Sequence[str] = COMPARED,
) -> DataFrame:
    """Incoming rows without the compared columns, and with their `outcome`.

    `arrival` holds order columns from coarse to fine, for example
    `[["landed_at", "keyword"], ["page", "position"]]`. One key may hold any share of the
    rows: a task sorts a key's rows at once if there are at most `LONGEST`, and else those of
    one step only (see `previous_values`). With several steps, the keys with more are found
    first, and written to the shared folder. The state is joined to distinct keys. Contents are compared by digest
    (`_digest`, computed where a side does not have it), so that the compared columns are not moved.
    """
    keys = incoming.groupBy(key).agg(F.count("*").alias("_rows"))
    known = with_digest(state, compared).join(keys, key, "left_semi").select(key, DIGEST)
    rows = with_digest(incoming, compared)
    # A struct is never NULL, and NULLs in it are equal and sort first.
    steps = {f"_step{i}": F.struct(*level) for i, level in enumerate(arrival)}
    kept = [c for c in incoming.columns if c not in compared and c != DIGEST]
    packed = rows.select(*kept, DIGEST, *[step.alias(name) for name, step in steps.items()])
    outcome = (
        F.when(F.col(PREVIOUS).isNull(), INSERTED)
        .when(F.col(PREVIOUS) == F.col(DIGEST), SKIPPED)
        .otherwise(UPDATED)
    )
    if len(steps) == 1:
        return previous_values(packed, key, list(steps), DIGEST, known).select(*kept, outcome.alias("outcome"))
    # A NULL key is like no other: its rows have none before them but in their own step.
    hot = _kept(keys.filter((F.col("_rows") > LONGEST) | F.col(key).isNull()).select(F.col(key).alias("_hot")))
    if hot.isEmpty():
        packed = packed.select(*kept, DIGEST, F.struct(*steps).alias("_order"))
        chained = previous_values(packed, key, ["_order"], DIGEST, known)
    else:
        chained = _previous_digests(packed, known, hot, key, list(steps))
    return chained.select(*kept, outcome.alias("outcome"))


def _previous_digests(packed: DataFrame, known: DataFrame, hot: DataFrame, key: str, steps: list[str]) -> DataFrame:
    """`previous_values` in which a key has all its rows in one step, unless it is in `hot`."""
    *outer, _ = steps
    same = F.col(key).eqNullSafe(F.col("_hot"))
    stepped = F.col("_hot_rows").isNotNull()

    marked = packed.join(hot.withColumn("_hot_rows", F.lit(True)), same, "left")
    # NULLs in a struct are equal.
    rows = marked.select(
        *[c for c in packed.columns if c not in steps],
        "_hot_rows",
        *[F.struct(F.when(stepped, F.col(s)).alias("step")).alias(s) for s in outer],
        F.struct(*steps).alias(steps[-1]),
    )
    lasts = rows.filter(stepped).groupBy(key, *outer).agg(F.max_by(DIGEST, steps[-1]).alias(DIGEST))
    before = previous_values(lasts, key, outer, DIGEST, known.join(hot, same, "left_semi")).drop(DIGEST)
    types = {f.name: f.dataType for f in rows.schema}
    whole = known.join(hot, same, "left_anti").select(
        key, *[F.struct(F.lit(None).cast(types[s]["step"].dataType).alias("step")).alias(s) for s in outer],
        F.col(DIGEST).alias(PREVIOUS),
    )
    inside = F.lag(DIGEST).over(Window.partitionBy(key, *outer).orderBy(steps[-1]))
    chained = rows.withColumn("_inside", inside).join(before.unionByName(whole), [key, *outer], "left")
    return chained.withColumn(PREVIOUS, F.coalesce("_inside", PREVIOUS)).drop("_inside", "_hot_rows")


def _kept(rows: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read from there."""
    from rolecall.sources.files import shared_dir, shuffles_released

    path = shared_dir(rows.sparkSession)
    with shuffles_released(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def dealt(rows: DataFrame, place: Sequence[str], by: str, parts: int) -> DataFrame:
    """Rows shuffled by `place` and `_part`, one of `parts` by the hash of `by`.

    With the settings `DEALT`, a join by these and more columns leaves them where they are. So
    its rows come out by `place`, as they are to be written, and need no second shuffle.
    """
    part = F.pmod(F.xxhash64(by), F.lit(parts)).cast("int")
    return rows.withColumn(PART, part).repartition(*place, PART)


def latest_writes(
    classified: DataFrame,
    staged: DataFrame,
    columns: Sequence[str],
    arrival: Levels,
    key: str = "external_id",
    stamp: str = "fetched_at",
    place: Sequence[str] = (),
    parts: int = 1,
) -> DataFrame:
    """One row per key that was written: last content, `stamp` of the last write.

    `classified` are the outcomes of `staged`; `_staged` tells the rows of both apart. Contents
    are fetched once, for the written keys. `place` names columns that follow from the key; if
    given, they stay, and the rows come by them, in `parts` (see `dealt`).
    """
    order = F.struct(*[c for level in arrival for c in level])
    written = F.col("outcome") != SKIPPED
    last = classified.groupBy(key, *place).agg(
        F.max_by(ROW, order).alias(ROW),
        # A struct keeps a NULL stamp apart from "never written".
        F.max_by(F.struct(stamp), F.when(written, order)).alias("_stamp"),
    )
    last = last.filter(F.col("_stamp").isNotNull()).select(ROW, *place, "_stamp")
    rows, match = staged.drop(stamp), [ROW]
    if place:
        rows, last = (dealt(side, place, ROW, parts) for side in (rows, last))
        match = [*place, PART, ROW]
    return rows.join(last, match).withColumn(stamp, F.col("_stamp." + stamp)).select(*columns, *place)


def merge(state: DataFrame, writes: DataFrame, key: str = "external_id") -> DataFrame:
    """State with the written rows put in place. `writes` has one row per key."""
    return state.join(writes.select(key), key, "left_anti").unionByName(
        writes.select(*state.columns)
    )


def upsert(
    state: DataFrame,
    incoming: DataFrame,
    arrival: Levels,
    key: str = "external_id",
    compared: Sequence[str] = COMPARED,
    stamp: str = "fetched_at",
) -> tuple[DataFrame, DataFrame]:
    """`(new_state, classified)`; `classified` is `incoming` with `outcome`.

    The incoming rows are written to the shared folder first, as they are read several
    times over.
    """
    staged = _kept(with_digest(incoming, compared).withColumn(ROW, F.monotonically_increasing_id()))
    outcomes = classify(staged, state, arrival, key, compared)
    writes = latest_writes(outcomes, staged, state.columns, arrival, key, stamp)
    classified = staged.drop(DIGEST).join(outcomes.select(ROW, "outcome"), ROW).drop(ROW)
    return merge(state, writes, key), classified
