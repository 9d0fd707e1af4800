"""Flags and effective values of all departments in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.operators import amendments, duplicates, effective
from contractlens.operators.amendments import amendment_groups, find_amendments, taking_part, ungrouped
from contractlens.operators.duplicates import find_duplicates
from contractlens.operators.effective import effective_values, regular_values
from contractlens.operators.flags import reset_generated
from contractlens.operators.grouping import all_equal
from contractlens.schema import GENERATED
from contractlens.session import cut_lineage, shuffled, small_side
from contractlens.sources import snapshots, writers

# What the rules read; descriptions and other wide text stay out of the shuffles.
KEYS = [
    "id",
    "owner_acronym",
    "source_fiscal",
    "source_year",
    "contract_value",
    "original_value",
    "gen_vendor_normalized",
    "raw_contract_date",
    "reference_number",
    "gen_start_year",
    "gen_end_year",
    "gen_is_error",
]
# A few short columns: carrying them through the rules costs less than a join back by id.
CARRIED = ["vendor_name", "source_quarter", "source_origin", "gen_error_via"]
ACTIONS = ("reset", "duplicates", "amendments", "amendmentvalues", "regularvalues", "all")


def _derive(rows: DataFrame) -> DataFrame:
    """Duplicates, then amendment groups, then effective values.

    Each step reads its input more than once, so the narrow rows are written to the
    shared folder in between instead of being derived again. Duplicates and errors take no
    part in the later steps: they are not written again, and get their columns by one
    projection.
    """
    marked = cut_lineage(find_duplicates(rows))
    work, others = taking_part(marked)
    linked = cut_lineage(amendment_groups(work))
    return effective_values(linked).unionByName(regular_values(ungrouped(others)))


def metadata_flags(rows: DataFrame) -> DataFrame:
    """(id, derived columns) for all rows, computed on the key columns only."""
    return _derive(rows.select(*KEYS)).select("id", *GENERATED.names)


def update_all_metadata(rows: DataFrame) -> DataFrame:
    """Rows with fresh derived columns: narrow rules, then one join back by id."""
    kept = [c for c in rows.columns if c not in GENERATED.names]
    base = rows.select(*kept)
    if set(kept) <= {*KEYS, *CARRIED}:
        return _derive(base).select(*kept, *GENERATED.names)
    flags = metadata_flags(base)
    return base.join(shuffled(flags), "id").select(*kept, *GENERATED.names)


DUPLICATE = ["gen_is_duplicate", "gen_duplicate_via", "gen_duplicate_source_id"]
AMENDMENT = ["gen_is_amendment", "gen_amendment_via", "gen_amendment_group_id"]


def _in_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys, missing ones too, are among the groups."""
    side = small_side(cut_lineage(groups.select(*keys).distinct()))
    return rows.alias("r").join(side.alias("g"), all_equal("r", "g", keys), "left_semi")


def changed_metadata(stored: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Fresh derived columns (id and the generated ones) of the rows that a change may touch.

    stored: the flagged rows so far; added: rows without derived columns; removed: ids. The
    change is followed through the rules: changed rows touch the (department, value)
    groups in which duplicates are found; rows whose duplicate flags change there, and
    changed rows, touch the (department, vendor) groups in which amendments are found;
    effective values depend on these groups alone. All other rows keep what they have.
    """
    keys = [*KEYS, *DUPLICATE]
    gone = removed.select(F.col("id").alias("gone")).distinct()
    before = stored.select(*keys)
    lost = before.join(gone, F.col("id") == F.col("gone"), "left_semi")
    kept = before.join(gone, F.col("id") == F.col("gone"), "left_anti")
    fresh = added.select(*KEYS)
    for name in DUPLICATE:
        fresh = fresh.withColumn(name, F.lit(None).cast(before.schema[name].dataType))
    rows = cut_lineage(kept.unionByName(fresh))
    changed = cut_lineage(lost.select(*KEYS).unionByName(fresh.select(*KEYS)))

    groups = _in_groups(rows, changed, duplicates.GROUP)
    held = groups.select(F.col("id").alias("of"), *[F.col(name).alias(f"was_{name}") for name in DUPLICATE])
    marked = cut_lineage(find_duplicates(groups.drop(*DUPLICATE)))
    same = F.lit(True)
    for name in DUPLICATE:
        same = same & F.col(name).eqNullSafe(F.col(f"was_{name}"))
    flipped = marked.join(shuffled(held), F.col("id") == F.col("of")).filter(~same).select(*amendments.GROUP)

    touched = flipped.unionByName(changed.select(*amendments.GROUP))
    others = rows.join(shuffled(marked.select(F.col("id").alias("of"))), F.col("id") == F.col("of"), "left_anti")
    current = marked.select(*keys).unionByName(others.select(*keys))
    linked = cut_lineage(find_amendments(_in_groups(current, touched, amendments.GROUP)))
    return effective_values(linked).select("id", *GENERATED.names)


def apply_changes(stored: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """The stored rows after rows were added and removed, with derived columns as a full run
    would give; only the touched groups are derived again."""
    fresh = cut_lineage(changed_metadata(stored, added, removed))
    return merged(stored, added, removed, fresh)


def merged(stored: DataFrame, added: DataFrame, removed: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored and added rows without the removed ones, with the fresh derived columns where
    there are any."""
    plain = [name for name in stored.columns if name not in GENERATED.names]
    gone = removed.select(F.col("id").alias("gone")).distinct()
    rows = stored.join(gone, F.col("id") == F.col("gone"), "left_anti")
    late = added.select(*plain)
    for field in GENERATED:
        late = late.withColumn(field.name, F.lit(None).cast(field.dataType))
    every = rows.unionByName(late.select(*rows.columns))
    new = fresh.select(F.col("id").alias("of"), F.struct(*GENERATED.names).alias("new"))
    has = F.col("of").isNotNull()
    return every.join(shuffled(new), F.col("id") == F.col("of"), "left").select(
        *[
            F.when(has, F.col(f"new.{name}")).otherwise(F.col(name)).alias(name) if name in GENERATED.names else F.col(name)
            for name in stored.columns
        ]
    )


def change_stored(spark: SparkSession, path: str, schema, added: DataFrame, removed: DataFrame) -> int:
    """Apply a change to a stored, flagged contracts table; returns the partitions rewritten.

    A partition is rewritten if it gains or loses rows or if a derived column of one of its
    rows changes. Rows are read whole in these partitions only.
    """
    narrow = [*KEYS, "source_origin", *GENERATED.names]
    stored = snapshots.read(spark, path, schema).select(*dict.fromkeys(narrow))
    fresh = cut_lineage(changed_metadata(stored, added, removed))
    place = ["source_origin", "owner_acronym"]
    gone = removed.select(F.col("id").alias("gone")).distinct()
    lost = stored.join(gone, F.col("id") == F.col("gone"), "left_semi").select(*place)
    new = fresh.select(F.col("id").alias("of"), *[F.col(name).alias(f"new_{name}") for name in GENERATED.names])
    same = F.lit(True)
    for name in GENERATED.names:
        same = same & F.col(name).eqNullSafe(F.col(f"new_{name}"))
    turned = stored.join(shuffled(new), F.col("id") == F.col("of")).filter(~same).select(*place)
    touched = cut_lineage(lost.unionByName(turned).unionByName(added.select(*place)).distinct())

    def change(rows: DataFrame) -> DataFrame:
        return merged(rows, added, removed, fresh)

    return writers.rewrite_partitions(spark, path, schema, touched, change)


def update_metadata(rows: DataFrame, action: str, owner: str | None = None) -> DataFrame:
    """One named step, for all departments or one; other rows pass unchanged.

    Steps after the first read the flags that the rows already carry.
    """
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}; one of {', '.join(ACTIONS)}")
    if owner is not None:
        chosen = F.col("owner_acronym").eqNullSafe(F.lit(owner))
        return update_metadata(rows.filter(chosen), action).unionByName(rows.filter(~chosen))
    columns = rows.columns
    if action == "reset":
        return reset_generated(rows).select(*columns)
    if action == "all":
        return update_all_metadata(rows).select(*columns)
    if action == "duplicates":
        bare = rows.drop("gen_is_duplicate", "gen_duplicate_via", "gen_duplicate_source_id")
        return find_duplicates(bare).select(*columns)
    if action == "amendments":
        bare = rows.drop("gen_is_amendment", "gen_amendment_via", "gen_amendment_group_id")
        return find_amendments(bare).select(*columns)
    fresh = effective_values(rows.drop(*effective.ADDED)).select("id", *effective.ADDED)
    grouped = F.col("gen_amendment_group_id").isNotNull()
    touched = grouped if action == "amendmentvalues" else ~grouped
    return (
        rows.filter(touched)
        .drop(*effective.ADDED)
        .join(fresh, "id")
        .select(*columns)
        .unionByName(rows.filter(~touched).select(*columns))
    )
