"""Warehouse loading as pure DataFrame functions (W1-W12).

Every function takes the current table state and an incoming batch and
returns the complete new state (plus what changed). Nothing is updated in
place: the caller writes the new state to a fresh location (see
``sources.sinks``), so a failed job leaves the previous state readable and
a rerun of the same batch converges to the same state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DIM_ACCOUNT, DIM_MERCHANT, FACT_TRANSACTIONS


def _ts(batch_ts: str) -> Column:
    return F.lit(batch_ts).cast("timestamp_ntz")


def wide_key(*cols: Column) -> Column:
    """128-bit surrogate of the given values, as 32 hex digits. Each value is
    marked as present or NULL and preceded by its length, so no two different
    rows of values spell the same text."""
    parts = []
    for c in cols:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat_ws(",", *parts).cast("binary"))


#: Rows of a dimension that a join may send through the driver to all executors; larger ones are shuffled.
BROADCAST_ROWS = 10_000


def shuffled_if_large(dim: DataFrame) -> DataFrame:
    """A written table for joins in which it is looked up. Left to itself, the
    planner broadcasts by the size of compressed files: a load has a dozen
    such joins, and each would send the driver as much as it just allows."""
    return dim.hint("shuffle_hash") if dim.count() > BROADCAST_ROWS else dim


def _refuse_duplicates(incoming: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """One row per key; a key twice in the batch fails the job.

    The aggregate is on the same key the following join shuffles on, so it
    shares that exchange instead of adding one.
    """
    agg = incoming.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(a).alias(a) for a in attrs])
    # evaluated for every key; raises inside the task that sees a duplicate
    fail = F.raise_error(F.concat(F.lit(f"duplicate {key} in batch: "), F.col(key).cast("string")))
    first, rest = attrs[0], attrs[1:]
    checked = F.when(F.col("_n") > 1, fail.cast(agg.schema[first].dataType)).otherwise(F.col(first))
    return agg.select(key, checked.alias(first), *rest)


# ---------------------------------------------------------------------------
# W1 insert-if-new
# ---------------------------------------------------------------------------
@dataclass
class InsertResult:
    state: DataFrame
    inserted: DataFrame


def insert_if_new(current: DataFrame | None, incoming: DataFrame, key: str) -> InsertResult:
    """Rows whose key is not present yet are appended; existing keys are kept as is."""
    if current is None:
        new = incoming.dropDuplicates([key])
        return InsertResult(new, new)
    new = incoming.dropDuplicates([key]).join(current.select(key), key, "left_anti")
    return InsertResult(current.unionByName(new), new)


# ---------------------------------------------------------------------------
# W2 type-1 upsert (dim_merchant)
# ---------------------------------------------------------------------------
@dataclass
class UpsertResult:
    state: DataFrame
    affected: DataFrame  # the incoming keys (inserted or overwritten)


def merchant_key_of(merchant_id: Column) -> Column:
    return wide_key(merchant_id)


def type1_upsert(current: DataFrame | None, incoming: DataFrame) -> UpsertResult:
    """Incoming attributes overwrite (also with NULL); the surrogate key stays."""
    attrs = ["merchant_category", "region"]
    inc = _refuse_duplicates(incoming.select("merchant_id", *attrs), "merchant_id", attrs)
    if current is None:
        state = inc.select(merchant_key_of(F.col("merchant_id")).alias("merchant_key"),
                           "merchant_id", *attrs)
        return UpsertResult(state, inc)
    cur = current.select("merchant_key", "merchant_id", *[F.col(a).alias("_old_" + a) for a in attrs])
    j = cur.join(inc.withColumn("_inc", F.lit(True)), "merchant_id", "full_outer")
    from_inc = F.col("_inc").isNotNull()
    state = j.select(
        F.coalesce(F.col("merchant_key"), merchant_key_of(F.col("merchant_id"))).alias("merchant_key"),
        "merchant_id",
        *[F.when(from_inc, F.col(a)).otherwise(F.col("_old_" + a)).alias(a) for a in attrs])
    return UpsertResult(state.select([f.name for f in DIM_MERCHANT.fields]), inc)


# ---------------------------------------------------------------------------
# W3/W4/W5/W6 type-2 history (dim_account)
# ---------------------------------------------------------------------------
@dataclass
class Scd2Result:
    state: DataFrame
    changes: DataFrame  # account_id, action in {closed_and_reopened, inserted_new}


def account_key_of(account_id: Column, effective_start: Column) -> Column:
    """Deterministic surrogate: the same version always gets the same key."""
    return wide_key(account_id, effective_start)


def scd2_merge(current: DataFrame | None, incoming: DataFrame, batch_ts: str) -> Scd2Result:
    """Close changed current versions at ``batch_ts`` and open new ones.

    * unchanged (null-safe equal region and status): kept
    * changed: old version gets effective_end = batch_ts, is_current = false;
      a new current version starts at batch_ts (no gap, no overlap)
    * new: a current version starts at batch_ts
    * absent from the batch: kept current (no delete detection)
    Closed history rows are passed through untouched.
    """
    attrs = ["region", "account_status"]
    inc = _refuse_duplicates(incoming.select("account_id", *attrs), "account_id", attrs)
    ts = _ts(batch_ts)
    cols = [f.name for f in DIM_ACCOUNT.fields]

    def opened(df: DataFrame) -> DataFrame:
        return df.select(account_key_of(F.col("account_id"), ts).alias("account_key"),
                         "account_id", "region", "account_status",
                         ts.alias("effective_start"),
                         F.lit(None).cast("timestamp_ntz").alias("effective_end"),
                         F.lit(True).alias("is_current"))

    if current is None:
        state = opened(inc)
        changes = inc.select("account_id", F.lit("inserted_new").alias("action"))
        return Scd2Result(state, changes)

    # One join. Each account then becomes the versions it is left with: its
    # current one kept or closed, a new one opened, or both. Closed versions
    # do not take part.
    decided = _decided(current, inc, ts, "full_outer")
    versions = decided.select(F.explode(F.filter(F.array(F.coalesce("_kept", "_closed"), "_opened"), lambda v: v.isNotNull())).alias("v")).select("v.*")
    state = current.filter(~F.col("is_current")).select(cols).unionByName(versions)
    changes = decided.filter(F.col("_action") != "kept").select(
        "account_id", F.col("_action").alias("action"))
    return Scd2Result(state, changes)


def _decided(current: DataFrame, inc: DataFrame, ts: Column, how: str) -> DataFrame:
    """account_id, _action and the versions _kept, _closed, _opened (or NULL)."""
    cols = [f.name for f in DIM_ACCOUNT.fields]
    attrs = ["region", "account_status"]
    cur = current.filter(F.col("is_current")).select("account_id", F.struct(*cols).alias("_c"))
    new = inc.select("account_id", F.struct(*attrs).alias("_i"))
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(f"_c.{a}").eqNullSafe(F.col(f"_i.{a}"))
    action = (F.when(F.col("_c").isNull(), F.lit("inserted_new"))
               .when(F.col("_i").isNotNull() & ~same, F.lit("closed_and_reopened"))
               .otherwise(F.lit("kept")))
    late = F.raise_error(F.concat(F.lit("batch is not later than the current version of "), F.col("account_id")))
    closed_at = F.when(F.col("_c.effective_start") >= ts, late.cast("timestamp_ntz")).otherwise(ts)

    def version(**changed: Column) -> Column:
        return F.struct(*(changed.get(c, F.col(f"_c.{c}")).cast(DIM_ACCOUNT[c].dataType).alias(c) for c in cols))

    return cur.join(new, "account_id", how).withColumn("_action", action).select(
        "account_id", "_action",
        F.when(F.col("_action") == "kept", version()).alias("_kept"),
        F.when(F.col("_action") == "closed_and_reopened", version(effective_end=closed_at, is_current=F.lit(False))).alias("_closed"),
        F.when(F.col("_action") != "kept", version(
            account_key=account_key_of(F.col("account_id"), ts), account_id=F.col("account_id"),
            region=F.col("_i.region"), account_status=F.col("_i.account_status"), effective_start=ts,
            effective_end=F.lit(None), is_current=F.lit(True))).alias("_opened"))


def scd2_delta(current: DataFrame, incoming: DataFrame, batch_ts: str) -> DataFrame:
    """What a batch does to the current versions: account_id, action, the
    version it closes (or NULL) and the version it opens, for changed and new
    accounts only. ``current`` may leave out accounts that the batch does not
    hold; closed history is neither read nor returned."""
    inc = _refuse_duplicates(incoming.select("account_id", "region", "account_status"), "account_id", ["region", "account_status"])
    return (_decided(current, inc, _ts(batch_ts), "right").filter(F.col("_action") != "kept")
            .select("account_id", F.col("_action").alias("action"), F.col("_closed").alias("closed"), F.col("_opened").alias("opened")))


def type1_delta(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """The merchants that a batch adds or changes, as they are to be stored."""
    attrs = ["merchant_category", "region"]
    inc = _refuse_duplicates(incoming.select("merchant_id", *attrs), "merchant_id", attrs)
    old = current.select("merchant_key", "merchant_id", *[F.col(a).alias(f"_old_{a}") for a in attrs])
    same = F.col("merchant_key").isNotNull()
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.col(f"_old_{a}"))
    return inc.join(old, "merchant_id", "left").filter(~same).select(
        F.coalesce("merchant_key", merchant_key_of(F.col("merchant_id"))).alias("merchant_key"), "merchant_id", *attrs)


def change_report(changes: DataFrame) -> DataFrame:
    """W5: closed_and_reopened and inserted_new counts in one aggregate."""
    return changes.agg(
        F.count_if(F.col("action") == "closed_and_reopened").cast("long").alias("closed_and_reopened"),
        F.count_if(F.col("action") == "inserted_new").cast("long").alias("inserted_new"))


def current_versions(dim_account: DataFrame) -> DataFrame:
    """W12: the current version of each account."""
    return dim_account.filter(F.col("is_current"))


# ---------------------------------------------------------------------------
# W8/W9/W10 fact key resolution and audit
# ---------------------------------------------------------------------------
STAGING_ROW_COLUMNS = [
    "orig_account_id", "dest_account_id", "dest_merchant_id", "date_key", "type_code",
    "amount", "balance_before_orig", "balance_after_orig", "balance_before_dest",
    "balance_after_dest", "is_fraud", "is_flagged_by_system", "source_step",
]


def transaction_key() -> Column:
    """The digest of a staged row."""
    return wide_key(*[F.col(c) for c in STAGING_ROW_COLUMNS])


def _money(c: str) -> Column:
    col = F.col(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col).cast("decimal(18,2)")


LEAST_NULL_SPREAD = 4096


def _spread_null_key(staging: DataFrame, col: str) -> Column:
    """Join key for an optional id: the id itself, or for NULL a value that
    matches no dimension row (ids are hex; this starts with NUL), spread over
    several times as many values as the shuffle has partitions by a hash of
    the row. Every payment has a NULL destination account and every transfer
    a NULL merchant, so a plain key would send that whole share of the fact
    to one shuffle partition."""
    n = max(LEAST_NULL_SPREAD, 4 * int(staging.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = F.pmod(F.xxhash64("orig_account_id", "date_key", "amount"), F.lit(n))
    return F.coalesce(F.col(col), F.concat(F.lit("\u0000"), spread.cast("string")))


#: Ids per lookup that are resolved without a shuffle, at most, and items that the sketch tracks to find them.
HOT_IDS, HOT_TRACKED = 1024, 16_384
LOOKUP_IDS = ("orig_account_id", "dest_account_id", "dest_merchant_id")
HOT_SCHEMA = "role string, id string, n long"


def hot_ids(staging: DataFrame, share: float | None = None) -> DataFrame:
    """role, id, n: the ids of each lookup that hold at least ``share`` of the
    rows (default: what one shuffle partition holds on average).

    One pass with a frequent-items sketch per lookup, of fixed size; at most
    HOT_IDS rows per lookup. Counts are estimates: they only route rows.
    """
    if share is None:
        share = 1 / max(1, int(staging.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = staging.agg(F.count(F.lit(1)).alias("_rows"), *[F.expr(f"approx_top_k({c}, {HOT_IDS}, {HOT_TRACKED})").alias(c) for c in LOOKUP_IDS])
    items = F.concat(*[F.expr(f"transform({c}, x -> struct('{c}' AS role, x.item AS id, x.count AS n))") for c in LOOKUP_IDS])
    return (found.select("_rows", F.explode(items).alias("i")).select("i.*", "_rows")
            .where(F.col("id").isNotNull() & (F.col("n") >= F.lit(share) * F.col("_rows"))).select("role", "id", "n"))


def few_ids(staging: DataFrame) -> set[str]:
    """The lookups whose ids are at most BROADCAST_ROWS, by an estimate that
    decides nothing but how they are joined."""
    found = staging.agg(*[F.approx_count_distinct(c).alias(c) for c in LOOKUP_IDS]).first()
    return {c for c in LOOKUP_IDS if found[c] <= BROADCAST_ROWS}


def lookup(facts: DataFrame, dim: DataFrame, id_col: str, key_col: str, hot: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """``facts`` with the key of ``id_col`` from ``dim`` (id, key), NULL if there is none.

    With ``among``, rows that hold all ids of the facts and few different
    ones, the dimension rows of these ids are broadcast and no fact moves.
    Else hot ids (at most HOT_IDS, and so many dimension rows) are broadcast. In
    the shuffle join their rows, like those without an id, stand under values
    that match nothing and are spread by a hash of the row.
    """
    if among is not None:
        ids = F.broadcast(among.select(F.col(id_col).alias("id")).distinct())
        keys = dim.join(ids, "id", "left_semi").select(F.col("id").alias("_held_id"), F.col("key").alias(key_col))
        return facts.join(F.broadcast(keys), F.col(id_col) == F.col("_held_id"), "left").drop("_held_id")
    mine = F.broadcast(hot.where(F.col("role") == id_col).select(F.col("id").alias("_hot_id")).distinct())
    held = dim.join(mine, dim["id"] == mine["_hot_id"], "left_semi").select(F.col("id").alias("_held_id"), F.col("key").alias("_hot_key"))
    common = mine.join(held, F.col("_hot_id") == F.col("_held_id"), "left").drop("_held_id")
    routed = facts.join(F.broadcast(common), F.col(id_col) == F.col("_hot_id"), "left")
    routed = routed.withColumn("_far", F.when(F.col("_hot_id").isNull(), F.col(id_col)))
    routed = routed.withColumn("_far", _spread_null_key(routed, "_far"))
    far = dim.select(F.col("id").alias("_far"), F.col("key").alias("_far_key"))
    return routed.join(far, "_far", "left").withColumn(key_col, F.coalesce("_hot_key", "_far_key")).drop("_far", "_far_key", "_hot_id", "_hot_key")


def resolve_flags(staging: DataFrame, dim_account: DataFrame, dim_merchant: DataFrame,
                  dim_type: DataFrame, hot: DataFrame | None = None, few: set[str] = frozenset()) -> DataFrame:
    """Staged facts with surrogate keys looked up; unresolved rows are kept
    with NULL keys so they can be counted by cause. With the ids in ``hot``
    (see ``hot_ids``) no id is more than a shuffle partition's share; lookups
    in ``few`` (see ``few_ids``) do without a shuffle.

    Type (5 rows) is broadcast. Account and merchant dimensions grow with
    the data, so they are left to the planner (sort-merge, or broadcast when
    AQE measures them small; skewed account keys are split by AQE). A caller
    who has them written passes them through ``shuffled_if_large``.
    """
    cur = current_versions(dim_account).select("account_id", "account_key")
    types = F.broadcast(dim_type.select("type_code", "transaction_type_key"))
    if hot is not None:
        accounts = cur.select(F.col("account_id").alias("id"), F.col("account_key").alias("key"))
        merchants = dim_merchant.select(F.col("merchant_id").alias("id"), F.col("merchant_key").alias("key"))
        out = staging.join(types, "type_code", "left")
        for id_col, dim, key_col in (("orig_account_id", accounts, "orig_account_key"), ("dest_account_id", accounts, "dest_account_key"),
                                     ("dest_merchant_id", merchants, "merchant_key")):
            out = lookup(out, dim, id_col, key_col, hot, staging if id_col in few else None)
        return out
    orig = cur.select(F.col("account_id").alias("orig_account_id"),
                      F.col("account_key").alias("orig_account_key"))
    dest = cur.select(F.col("account_id").alias("_dest_account_join"),
                      F.col("account_key").alias("dest_account_key"))
    merch = dim_merchant.select(F.col("merchant_id").alias("_dest_merchant_join"), "merchant_key")
    return (staging
            .withColumn("_dest_account_join", _spread_null_key(staging, "dest_account_id"))
            .withColumn("_dest_merchant_join", _spread_null_key(staging, "dest_merchant_id"))
            .join(types, "type_code", "left")
            .join(orig, "orig_account_id", "left")
            .join(dest, "_dest_account_join", "left")
            .join(merch, "_dest_merchant_join", "left")
            .drop("_dest_account_join", "_dest_merchant_join"))


def unresolved_counts(staging: DataFrame, dim_account: DataFrame, dim_type: DataFrame) -> DataFrame:
    """One row: staged, unresolved_type, unresolved_account.

    Counted from the staging itself, by key: its rows are summed up by type
    and originator before anything is joined, so a duplicated dimension row
    cannot change these numbers.
    """
    known = F.broadcast(dim_type.select("type_code", F.lit(True).alias("_type")).distinct())  # five types
    ids = current_versions(dim_account).select(F.col("account_id").alias("orig_account_id"), F.lit(True).alias("_acct")).distinct()
    per_key = staging.groupBy("type_code", "orig_account_id").agg(F.count(F.lit(1)).alias("_n"))
    flagged = per_key.join(known, "type_code", "left").join(ids, "orig_account_id", "left")
    zero = F.lit(0).cast("long")
    return flagged.agg(
        F.coalesce(F.sum("_n"), zero).alias("staged"),
        F.coalesce(F.sum(F.when(F.col("_type").isNull(), F.col("_n"))), zero).alias("unresolved_type"),
        F.coalesce(F.sum(F.when(F.col("_type").isNotNull() & F.col("_acct").isNull(), F.col("_n"))), zero).alias("unresolved_account"))


def resolve_fact(staging: DataFrame, dim_account: DataFrame, dim_merchant: DataFrame,
                 dim_type: DataFrame, batch_ts: str, hot: DataFrame | None = None, few: set[str] = frozenset()) -> DataFrame:
    """Inner semantics on type and originator, outer on the destinations."""
    flagged = resolve_flags(staging, dim_account, dim_merchant, dim_type, hot, few)
    ok = F.col("transaction_type_key").isNotNull() & F.col("orig_account_key").isNotNull()
    return flagged.filter(ok).select(
        transaction_key().alias("transaction_key"),
        "date_key", "transaction_type_key", "orig_account_key", "dest_account_key",
        F.col("merchant_key").alias("dest_merchant_key"),
        _money("amount").alias("amount"),
        _money("balance_before_orig").alias("balance_before_orig"),
        _money("balance_after_orig").alias("balance_after_orig"),
        _money("balance_before_dest").alias("balance_before_dest"),
        _money("balance_after_dest").alias("balance_after_dest"),
        "is_fraud", "is_flagged_by_system", "source_step",
        _ts(batch_ts).alias("loaded_at"),
        "partition_date",
    ).select([f.name for f in FACT_TRANSACTIONS.fields])


def load_audit(staging: DataFrame, dim_account: DataFrame, dim_merchant: DataFrame,
               dim_type: DataFrame, existing_fact: DataFrame | None = None) -> DataFrame:
    """One row: staged, inserted, unresolved rows by cause, fan_out, deleted.

    ``unresolved_type`` counts rows whose type is unknown; ``unresolved_account``
    rows with a known type whose originator has no current version. Without
    fan-out, staged = inserted + unresolved_type + unresolved_account; what is
    inserted beyond that, because a dimension holds a key twice, is ``fan_out``.
    ``deleted`` counts the stored rows on all staged days.
    """
    flagged = resolve_flags(staging, dim_account, dim_merchant, dim_type)
    ok = F.col("transaction_type_key").isNotNull() & F.col("orig_account_key").isNotNull()
    inserted = flagged.agg(F.count_if(ok).cast("long").alias("inserted"))
    audit = unresolved_counts(staging, dim_account, dim_type).crossJoin(F.broadcast(inserted))  # one row each
    audit = audit.withColumn("fan_out", F.expr("inserted + unresolved_type + unresolved_account - staged"))
    deleted = F.lit(0).cast("long") if existing_fact is None else rows_on_batch_days(existing_fact, staging).scalar()
    return audit.withColumn("deleted", deleted)


def rows_on_batch_days(existing_fact: DataFrame, staging: DataFrame) -> DataFrame:
    """One-row count of stored facts on the days of the batch (to be replaced).

    The batch's distinct days (bounded by the step range, 31 days) are
    broadcast; on a day-partitioned table this prunes the scan to those days.
    """
    days = F.broadcast(staging.select("partition_date").distinct())
    return existing_fact.join(days, "partition_date", "left_semi").agg(F.count(F.lit(1)))


# ---------------------------------------------------------------------------
# W7 replace-by-partition
# ---------------------------------------------------------------------------
def replace_partitions(existing: DataFrame | None, incoming: DataFrame, staging: DataFrame | None = None,
                       part_col: str = "partition_date") -> DataFrame:
    """Every staged day replaces the stored day, also when none of its rows
    could be resolved; other days stay. Without ``staging`` the staged days
    are those of ``incoming``."""
    if existing is None:
        return incoming
    # the staged days (bounded by the calendar, at most 31 here) are broadcast,
    # so the stored fact is filtered in place instead of shuffled by day
    days = F.broadcast((incoming if staging is None else staging).select(part_col).distinct())
    kept = existing.join(days, part_col, "left_anti")
    return kept.unionByName(incoming)
