"""Effective years and values of contracts and their amendments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.functions.dates import repaired_end
from contractlens.session import shuffled

ADDED = [
    "gen_effective_start_year",
    "gen_effective_end_year",
    "gen_effective_total_value",
    "gen_effective_yearly_value",
    "gen_original_value",
    "gen_is_most_recent_value",
]


def _valid() -> Column:
    return ~F.col("gen_is_duplicate") & ~F.col("gen_is_error") & F.col("source_fiscal").isNotNull()


def _repaired() -> Column:
    return repaired_end(F.col("gen_start_year"), F.col("gen_end_year"), F.col("source_year"))


def _original(original: Column, value: Column) -> Column:
    """The original value, or the contract value where it is missing or zero."""
    return F.when(F.coalesce(original, F.lit(0.0)) == 0, value).otherwise(original)


def regular_values(rows: DataFrame) -> DataFrame:
    """Entries without a group: the whole value over start..end. One projection."""
    has_years = F.col("gen_start_year").isNotNull() & F.col("gen_end_year").isNotNull()
    runs = _valid() & F.col("gen_amendment_group_id").isNull() & has_years
    end = _repaired()
    value = F.col("contract_value")
    columns = [
        F.col("gen_start_year"),
        end,
        value,
        value / (end - F.col("gen_start_year") + 1),
        _original(F.col("original_value"), value),
    ]
    return rows.select(
        "*",
        *[F.when(runs, c).alias(name) for c, name in zip(columns, ADDED[:-1], strict=True)],
        F.coalesce(runs, F.lit(False)).alias(ADDED[-1]),
    )


def group_bounds(rows: DataFrame) -> DataFrame:
    """Per group: span of years, first and last entry, original value, whether it runs."""
    order = F.struct("source_fiscal", "contract_value", "id")
    has_years = F.col("gen_start_year").isNotNull() & F.col("gen_end_year").isNotNull()
    entry = F.struct(
        "id", "contract_value", F.coalesce("gen_start_year", F.lit(0)).alias("start"), "end", "source_year"
    )
    bounds = (
        rows.withColumn("end", _repaired())
        .groupBy(F.col("gen_amendment_group_id").alias("grp"))
        .agg(
            F.min("gen_start_year").alias("span_start"),
            F.max(F.struct(order.alias("o"), F.col("end").alias("e")))["e"].alias("span_end"),
            F.max(order)["id"].alias("last_id"),
            F.min(F.struct(order.alias("o"), entry.alias("entry"))).alias("first"),
            F.min("original_value").alias("min_original"),
            F.min("contract_value").alias("min_value"),
            F.bool_or(has_years).alias("runs"),
        )
    )
    return bounds.select(
        "grp",
        F.coalesce("span_start", F.lit(0)).alias("span_start"),
        "span_end",
        "last_id",
        F.col("first.entry").alias("first_entry"),
        F.col("first.o").alias("first_order"),
        _original(F.col("min_original"), F.col("min_value")).alias("group_original"),
        "runs",
    )


def year_owners(rows: DataFrame) -> DataFrame:
    """(grp, entry, eff_start, eff_end, ...) for entries that own at least one year.

    Each year of a group belongs to the last entry that covers it. The first entry
    covers start..end, the others source_year..end. Entries of a group with the same
    two years are reduced to the last one before any year is spelled out, so a group
    contributes a number of rows bounded by its years, not by its entries.
    """
    order = F.struct("source_fiscal", "contract_value", "id")
    entry = F.struct(
        "id", "contract_value", F.coalesce("gen_start_year", F.lit(0)).alias("start"), "end", "source_year"
    )
    spans = (
        rows.withColumn("end", _repaired())
        .groupBy(F.col("gen_amendment_group_id").alias("g"), F.col("source_year").alias("y"), F.col("end").alias("e"))
        .agg(F.max(F.struct(order.alias("o"), entry.alias("entry"))).alias("m"))
    )
    bounds = group_bounds(rows)
    common = ["grp", "span_start", "span_end", "last_id", "group_original", "runs"]
    later = (
        spans.join(shuffled(bounds), F.col("g") == F.col("grp"))
        .filter(F.col("m.entry.id") != F.col("first_entry.id"))
        .select(
            *common,
            F.col("m.o").alias("o"),
            F.col("m.entry").alias("entry"),
            F.coalesce("y", F.lit(0)).alias("from_year"),
        )
    )
    first = bounds.select(
        *common,
        F.col("first_order").alias("o"),
        F.col("first_entry").alias("entry"),
        F.col("first_entry.start").alias("from_year"),
    )
    # year 0 stands for "unknown" and is never an effective year
    low = F.greatest("from_year", "span_start", F.lit(1))
    high = F.least(F.col("entry.end"), F.col("span_end"))
    years = (
        first.unionByName(later)
        .filter(F.col("runs") & (low <= high))
        .select(*common, "o", "entry", F.explode(F.sequence(low, high)).alias("year"))
    )
    owned = years.groupBy("grp", "year").agg(
        F.max(F.struct("o", "entry", "last_id", "group_original")).alias("m")
    )
    return owned.groupBy("grp", F.col("m.entry.id").alias("entry_id")).agg(
        F.max("m.o").alias("o"),
        F.max("m.entry").alias("entry"),
        F.min("year").alias("eff_start"),
        F.max("year").alias("eff_end"),
        F.max("m.last_id").alias("last_id"),
        F.max("m.group_original").alias("group_original"),
    )


def amendment_values(rows: DataFrame) -> DataFrame:
    """(id, effective years and values) of group entries that own a year.

    In order, an entry spreads what earlier entries have left of its value over its
    planned years, and keeps the part that falls in its own years. The remainder
    depends on all earlier entries, so it is folded over the owning entries of a
    group; there are at most as many of these as the group has years.
    """
    owners = year_owners(rows)
    group = owners.groupBy("grp").agg(
        F.array_sort(
            F.collect_list(
                F.struct("o", "entry", "eff_start", "eff_end", "last_id", "group_original")
            )
        ).alias("owners")
    )

    def add(state: Column, x: Column) -> Column:
        entry = x["entry"]
        is_first = F.size(state["totals"]) == 0
        planned_from = F.when(is_first, entry["start"]).otherwise(entry["source_year"])
        rate = (entry["contract_value"] - state["spent"]) / (entry["end"] - planned_from + 1)
        total = rate * (x["eff_end"] - x["eff_start"] + 1)
        return F.struct(
            (state["spent"] + total).alias("spent"),
            F.concat(state["totals"], F.array(total)).alias("totals"),
        )

    zero = F.struct(
        F.lit(0.0).cast("double").alias("spent"), F.array().cast("array<double>").alias("totals")
    )
    folded = group.withColumn(
        "totals", F.aggregate("owners", zero, add, lambda s: s["totals"])
    ).select(F.inline(F.arrays_zip("owners", "totals")))
    x, total = F.col("owners"), F.col("totals")
    return folded.select(
        x["entry"]["id"].alias("id"),
        x["eff_start"].alias(ADDED[0]),
        x["eff_end"].alias(ADDED[1]),
        total.alias(ADDED[2]),
        (total / (x["eff_end"] - x["eff_start"] + 1)).alias(ADDED[3]),
        x["group_original"].alias(ADDED[4]),
        (x["entry"]["id"] == x["last_id"]).alias(ADDED[5]),
    )


def in_running_group(rows: DataFrame) -> DataFrame:
    """Entries with a group and a fiscal label: the input of the group rules."""
    return rows.filter(_valid() & F.col("gen_amendment_group_id").isNotNull())


def effective_values(rows: DataFrame) -> DataFrame:
    """Add the six effective columns to grouped and ungrouped entries.

    Only entries in groups take part in the joins; the others are one projection.
    """
    grouped = in_running_group(rows)
    alone = rows.filter(
        ~F.coalesce(_valid() & F.col("gen_amendment_group_id").isNotNull(), F.lit(False))
    )
    values = amendment_values(grouped).withColumnRenamed("id", "_id")
    # groups without a single entry that has both years; nearly always none
    idle = group_bounds(grouped).filter(~F.col("runs")).select("grp")
    joined = grouped.join(shuffled(values), F.col("id") == F.col("_id"), "left").join(
        shuffled(idle), F.col("gen_amendment_group_id") == F.col("grp"), "left"
    )
    # an entry overridden in all its years counts as zero and has no years
    overridden = F.col("grp").isNull() & F.col("_id").isNull()
    with_values = joined.select(
        *[F.col(c) for c in rows.columns],
        F.col(ADDED[0]),
        F.col(ADDED[1]),
        F.when(overridden, 0.0).otherwise(F.col(ADDED[2])).alias(ADDED[2]),
        F.when(overridden, 0.0).otherwise(F.col(ADDED[3])).alias(ADDED[3]),
        F.col(ADDED[4]),
        F.coalesce(F.col(ADDED[5]), F.lit(False)).alias(ADDED[5]),
    )
    return regular_values(alone).unionByName(with_values)


def group_min_last(rows: DataFrame) -> DataFrame:
    """Per group: first start year, last entry's end, and original value."""
    return group_bounds(in_running_group(rows)).select(
        F.col("grp").alias("gen_amendment_group_id"),
        F.col("span_start").alias("earliest_year"),
        F.col("span_end").alias("latest_year"),
        F.col("group_original").alias("original_value"),
    )
