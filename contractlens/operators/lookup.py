"""Lookups of vendors, departments and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens import fixed_values as fixed
from contractlens.functions.vendor import clean_vendor_name
from contractlens.session import small_side


def pairs(text: str) -> dict[str, str]:
    """'key: value' lines of a fixed table."""
    lines = [line.split(":", 1) for line in text.strip().splitlines()]
    return {key.strip(): value.strip() for key, value in lines}


def _literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def map_lookup(key: Column, values: dict[str, str]) -> Column:
    """Look a key up in a fixed table; a key that is not listed stays as it is.

    The table is a constant of the plan (at most about 100 entries), so this is a
    projection without any join.
    """
    return F.coalesce(F.try_element_at(_literal_map(values), key), key)


def owner_code(code: Column) -> Column:
    """'agr-aafc' -> 'agr', then old and merged departments to the one in use."""
    return map_lookup(F.split(code, "-")[0], pairs(fixed.OWNER_ALIASES))


def renamed_owner(code: Column) -> Column:
    return map_lookup(code, pairs(fixed.OWNER_ALIASES))


def normalize_owner(rows: DataFrame, column: str = "owner_acronym") -> DataFrame:
    return rows.withColumn(column, owner_code(F.col(column)))


def label_text(code: Column) -> Column:
    return map_lookup(code, pairs(fixed.DISPLAY_LABELS))


def label_lookup(rows: DataFrame, code: str, name: str = "label") -> DataFrame:
    return rows.withColumn(name, label_text(F.col(code)))


def alias_table(aliases: DataFrame) -> DataFrame:
    """(vendor_clean, parent): one parent per cleaned company name.

    Input: (parent_company, company_name, position). Companies are read parent by
    parent, parents in order of first appearance; the last one read wins.
    """
    named = aliases.filter(~F.coalesce("company_name", F.lit("")).isin("", "0"))
    first = named.groupBy(F.col("parent_company").alias("_p")).agg(
        F.min("position").alias("_first")
    )
    ordered = named.join(first, F.col("parent_company").eqNullSafe(F.col("_p")))
    return (
        ordered.select(
            clean_vendor_name(F.col("company_name")).alias("vendor_clean"),
            clean_vendor_name(F.col("parent_company")).alias("parent"),
            F.struct("_first", "position").alias("_read"),
        )
        .groupBy("vendor_clean")
        .agg(F.max_by("parent", "_read").alias("parent"))
    )


def normalize_vendor(
    rows: DataFrame,
    table: DataFrame,
    clean: str = "gen_vendor_clean",
    normalized: str = "gen_vendor_normalized",
) -> DataFrame:
    """Cleaned name -> parent company, else the cleaned name itself.

    The alias list is broadcast while it is small; beyond that the join shuffles.
    """
    side = small_side(table.select(F.col("vendor_clean").alias("_k"), F.col("parent").alias("_p")))
    kept = [c for c in rows.columns if c != normalized]
    return rows.join(side, F.col(clean) == F.col("_k"), "left").select(
        *kept, F.coalesce("_p", clean).alias(normalized)
    )


def renormalize_vendors(
    rows: DataFrame, table: DataFrame, clean: str, normalized: str
) -> DataFrame:
    """Apply the aliases to a stored table; names without an alias keep their value."""
    side = small_side(table.select(F.col("vendor_clean").alias("_k"), F.col("parent").alias("_p")))
    return rows.join(side, F.col(clean) == F.col("_k"), "left").select(
        *[
            F.coalesce("_p", normalized).alias(normalized) if c == normalized else F.col(c)
            for c in rows.columns
        ]
    )


def vendor_name_variants(rows: DataFrame, table: DataFrame) -> DataFrame:
    """(parent, vendor_clean): every alias as cleaned today, and the raw names seen for it.

    Distinct raw names are found before anything is joined to them.
    """
    raw = rows.select("gen_vendor_clean", "vendor_name").distinct()
    seen = raw.join(
        small_side(table), F.col("gen_vendor_clean") == F.col("vendor_clean")
    ).select(F.col("parent"), clean_vendor_name(F.col("vendor_name")).alias("vendor_clean"))
    listed = table.select(
        clean_vendor_name(F.col("parent")).alias("parent"),
        clean_vendor_name(F.col("vendor_clean")).alias("vendor_clean"),
    )
    return listed.union(seen).distinct()


def sorted_aliases(aliases: DataFrame) -> DataFrame:
    """The alias list cleaned and without repeats, ready to be written in order."""
    cleaned = aliases.filter(~F.coalesce("company_name", F.lit("")).isin("", "0")).select(
        clean_vendor_name(F.col("parent_company")).alias("parent_company"),
        clean_vendor_name(F.col("company_name")).alias("company_name"),
    )
    return cleaned.distinct().orderBy("parent_company", "company_name")


def alias_entries(lists: DataFrame) -> DataFrame:
    """(names, parent) with names one per line or comma -> alias entries.

    Names equal to the parent are not needed and are dropped.
    """
    parent = clean_vendor_name(F.col("parent")).alias("parent_company")
    names = F.explode(F.split(F.translate("names", "\n", ","), ","))
    entries = lists.select(parent, names.alias("name")).select(
        "parent_company", clean_vendor_name(F.col("name")).alias("company_name")
    )
    return drop_identity_aliases(entries.filter(F.col("company_name") != "")).distinct()


def drop_identity_aliases(aliases: DataFrame) -> DataFrame:
    return aliases.filter(F.col("company_name") != F.col("parent_company"))
