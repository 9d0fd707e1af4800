"""Flags, duplicates, amendments, effective values and exports."""

from pyspark.sql import functions as F

from contractlens.catalog.inputs import flagged, store
from contractlens.catalog.sql_text import after
from contractlens.operators import amendments, duplicates, effective, flags
from contractlens.operators.exports import exports_v1, exports_v2
from contractlens.plans.metadata import change_stored, update_all_metadata
from contractlens.plans.metadata import update_metadata as run_action
from contractlens.session import cut_lineage, scratch_path
from contractlens.sources import snapshots, writers
from contractlens.sources.tables import contracts_view

PURCHASE = ["owner_acronym", "contract_value", "gen_vendor_normalized", "raw_contract_date"]


def _rounded(df):
    return df.select(
        *[
            F.round(F.col(c), 4).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def flag_data_errors(spark, sf):
    return flags.flag_data_errors(contracts_view(spark, sf)).select(
        "id", "gen_is_error", "gen_error_via"
    )


def find_duplicates(spark, sf):
    out = duplicates.find_duplicates(flagged(spark, sf))
    return out.select("id", "gen_is_duplicate", "gen_duplicate_via", "gen_duplicate_source_id")


def first_in_key(spark, sf):
    out = duplicates.first_in_key(flagged(spark, sf).filter("not gen_is_error"), PURCHASE)
    return out.select("id", "is_later", "first_id")


def duplicate_pairs(spark, sf):
    return duplicates.duplicate_pairs(flagged(spark, sf).filter("not gen_is_error"), PURCHASE)


def _marked(spark, sf):
    """Stored contracts with their duplicate flags, before amendments are found."""
    rows = store(spark, sf)["contracts"]
    return rows.drop(*amendments.ADDED, *effective.ADDED)


def find_amendments(spark, sf):
    out = amendments.find_amendments(_marked(spark, sf))
    return out.select("id", "gen_is_amendment", "gen_amendment_via", "gen_amendment_group_id")


def find_amendments_by_reference(spark, sf):
    rows = _marked(spark, sf).withColumn("original_value", F.lit(None).cast("double"))
    out = amendments.find_amendments(rows)
    return out.select("id", "gen_is_amendment", "gen_amendment_group_id")


def amendment_links(spark, sf):
    return amendments.linked_pairs(flagged(spark, sf).filter("not gen_is_error"))


def _linked(spark, sf):
    """Stored contracts with their amendment groups, before effective values."""
    return store(spark, sf)["contracts"].drop(*effective.ADDED)


def effective_amendment_values(spark, sf):
    return _rounded(effective.amendment_values(effective.in_running_group(_linked(spark, sf))))


def effective_regular_values(spark, sf):
    rows = _linked(spark, sf).filter("gen_amendment_group_id is null")
    return _rounded(effective.regular_values(rows).select("id", *effective.ADDED))


def most_recent_flag(spark, sf):
    rows = store(spark, sf)["contracts"]
    return rows.filter("gen_amendment_group_id is not null").select(
        "id", "gen_amendment_group_id", "gen_is_most_recent_value"
    )


def group_min_last(spark, sf):
    return effective.group_min_last(_linked(spark, sf))


def update_metadata(spark, sf):
    return _rounded(update_all_metadata(flagged(spark, sf)))


def change_stored_metadata(spark, sf):
    """A stored, flagged table loses some entries and gains others; only what they touch is
    derived again, only their departments are written."""
    rows, path = flagged(spark, sf), scratch_path(spark, "changing")
    strange = rows.filter("id % 97 = 5").withColumn("id", F.col("id") + 10**12)
    first = update_all_metadata(rows.filter("id % 89 <> 3").unionByName(strange))
    snapshots.replace(first, path, writers.PARTITIONS, lambda old, new: True)
    change_stored(spark, path, first.schema, rows.filter("id % 89 = 3"), strange.select("id"))
    return _rounded(snapshots.read(spark, path, first.schema))


def update_metadata_actions(spark, sf):
    """The named steps one after another, each reading the flags the rows carry."""
    rows = flags.reset_generated(flagged(spark, sf))
    for action in ("reset", "duplicates", "amendments", "amendmentvalues", "regularvalues"):
        rows = cut_lineage(run_action(rows, action))
    return _rounded(rows)


def update_metadata_of_owner(spark, sf):
    """All steps for one department; the rows of the others keep what they carry."""
    rows = flags.reset_generated(flagged(spark, sf))
    return _rounded(run_action(rows, "all", "nation_3")).select(
        "id", "owner_acronym", "gen_is_duplicate", "gen_amendment_group_id", "gen_effective_total_value"
    )


def export_v1(spark, sf):
    return _rounded(exports_v1(store(spark, sf)["contracts"]))


def export_v2(spark, sf):
    return _rounded(exports_v2(store(spark, sf)["exports_v1"]))


def materialize_v1(spark, sf):
    """The stored first export, read back."""
    v1 = store(spark, sf)["exports_v1"]
    return v1.groupBy("owner_acronym").agg(
        F.count(F.lit(1)).alias("entries"),
        F.round(F.sum("effective_total_value"), 2).alias("total_value"),
    )


def materialize_v2(spark, sf):
    v2 = store(spark, sf)["exports_v2"]
    return v2.groupBy("owner_acronym").agg(
        F.count(F.lit(1)).alias("entries"), F.round(F.sum("yearly_value"), 2).alias("total_value")
    )


def valid_entries(spark, sf):
    return flags.valid_entries(store(spark, sf)["contracts"]).select("id")


def year_range(spark, sf):
    return flags.year_range(contracts_view(spark, sf), "source_year", (1994, 1996)).select(
        "id", "source_year"
    )


def owner_filter(spark, sf):
    rows = store(spark, sf)["contracts"]
    return flags.equals_if_given(rows, "owner_acronym", "nation_3").select("id", "owner_acronym")


def vendor_filter(spark, sf):
    rows = contracts_view(spark, sf)
    return flags.equals_if_given(rows, "gen_vendor_normalized", "BUILDING 3").select("id")


def reset_generated(spark, sf):
    return flags.reset_generated(store(spark, sf)["contracts"]).drop("row_created_at")


QUERIES = {
    "flag_data_errors": flag_data_errors,
    "find_duplicates": find_duplicates,
    "first_in_key": first_in_key,
    "duplicate_self_match": duplicate_pairs,
    "find_amendments": find_amendments,
    "find_amendments_by_reference": find_amendments_by_reference,
    "amendment_self_match": amendment_links,
    "effective_amendment_values": effective_amendment_values,
    "effective_regular_values": effective_regular_values,
    "most_recent_flag": most_recent_flag,
    "group_min_last": group_min_last,
    "update_all_metadata": update_metadata,
    "update_metadata_actions": update_metadata_actions,
    "change_stored_metadata": change_stored_metadata,
    "update_metadata_of_owner": update_metadata_of_owner,
    "exports_v1": export_v1,
    "exports_v2": export_v2,
    "materialize_v1": materialize_v1,
    "materialize_v2": materialize_v2,
    "valid_entries": valid_entries,
    "year_range": year_range,
    "owner_filter": owner_filter,
    "vendor_filter": vendor_filter,
    "reset_generated": reset_generated,
}

_EFFECTIVE = """gen_effective_start_year, gen_effective_end_year,
 round(gen_effective_total_value, 4) AS gen_effective_total_value,
 round(gen_effective_yearly_value, 4) AS gen_effective_yearly_value,
 round(gen_original_value, 4) AS gen_original_value, gen_is_most_recent_value"""

_V1 = """SELECT vendor_normalized, owner_acronym, round(effective_total_value, 4) AS effective_total_value,
 round(effective_yearly_value, 4) AS effective_yearly_value, round(original_value, 4) AS original_value,
 effective_start_year, effective_end_year, source_fiscal, source_year, source_quarter, source_origin,
 is_most_recent_value, is_amendment, amendment_group_id, reference_number FROM v1"""

_FIRST = """SELECT id, coalesce(id <> f, false) AS is_later, CASE WHEN id <> f THEN f END AS first_id FROM (
 SELECT id, first_value(id) OVER (PARTITION BY owner_acronym, contract_value, gen_vendor_normalized, raw_contract_date
  ORDER BY source_fiscal, id) AS f FROM flagged WHERE NOT gen_is_error)"""

ORACLES = {
    "flag_data_errors": after("flagged", "SELECT id, gen_is_error, gen_error_via FROM flagged"),
    "find_duplicates": after(
        "marked",
        "SELECT id, gen_is_duplicate, gen_duplicate_via, gen_duplicate_source_id FROM marked",
    ),
    "first_in_key": after("flagged", _FIRST),
    "duplicate_self_match": after(
        "flagged", f"SELECT first_id, id AS later_id FROM ({_FIRST}) WHERE is_later"
    ),
    "find_amendments": after(
        "linked",
        "SELECT id, gen_is_amendment, gen_amendment_via, gen_amendment_group_id FROM linked",
    ),
    "find_amendments_by_reference": after(
        "marked",
        """
SELECT id, coalesce(grp <> id, false) AS gen_is_amendment, grp AS gen_amendment_group_id FROM (
 SELECT m.id, CASE WHEN c > 1 THEN f END AS grp FROM marked m LEFT JOIN (
  SELECT id, first_value(id) OVER (PARTITION BY owner_acronym, gen_vendor_normalized, reference_number
     ORDER BY source_fiscal, id) AS f,
   count(*) OVER (PARTITION BY owner_acronym, gen_vendor_normalized, reference_number) AS c
  FROM marked WHERE NOT gen_is_error AND NOT gen_is_duplicate AND source_fiscal IS NOT NULL) g ON m.id = g.id)""",
    ),
    "amendment_self_match": after(
        "flagged",
        """
SELECT DISTINCT a.from_id, b.id AS to_id FROM flagged b JOIN (
 SELECT owner_acronym, gen_vendor_normalized, reference_number, min(id) AS from_id FROM flagged WHERE NOT gen_is_error
 GROUP BY ALL) a USING (owner_acronym, gen_vendor_normalized, reference_number) WHERE NOT b.gen_is_error AND b.id <> a.from_id
UNION
SELECT a.from_id, b.id FROM flagged b JOIN (
 SELECT owner_acronym, gen_vendor_normalized, contract_value, gen_start_year, min(id) AS from_id FROM flagged WHERE NOT gen_is_error
 GROUP BY ALL) a ON a.owner_acronym = b.owner_acronym AND a.gen_vendor_normalized = b.gen_vendor_normalized
  AND a.contract_value = b.original_value AND a.gen_start_year = b.gen_start_year
WHERE NOT b.gen_is_error AND b.id <> a.from_id""",
    ),
    "effective_amendment_values": after(
        "enriched",
        f"SELECT id, {_EFFECTIVE} FROM enriched WHERE gen_amendment_group_id IS NOT NULL "
        "AND gen_effective_start_year IS NOT NULL",
    ),
    "effective_regular_values": after(
        "enriched", f"SELECT id, {_EFFECTIVE} FROM enriched WHERE gen_amendment_group_id IS NULL"
    ),
    "most_recent_flag": after(
        "enriched",
        "SELECT id, gen_amendment_group_id, gen_is_most_recent_value FROM enriched "
        "WHERE gen_amendment_group_id IS NOT NULL",
    ),
    "group_min_last": after(
        "enriched",
        "SELECT grp AS gen_amendment_group_id, cast(lo AS int) AS earliest_year, "
        "cast(hi AS int) AS latest_year, original AS original_value FROM e_span",
    ),
    "update_all_metadata": after(
        "enriched",
        f"""SELECT id, owner_acronym, vendor_name, gen_vendor_normalized, round(contract_value, 4) AS contract_value,
 round(original_value, 4) AS original_value, reference_number, raw_contract_date, source_year, source_quarter,
 source_fiscal, source_origin, gen_start_year, gen_end_year, gen_is_error, gen_error_via, gen_is_duplicate,
 gen_duplicate_via, gen_duplicate_source_id, gen_is_amendment, gen_amendment_via, gen_amendment_group_id,
 {_EFFECTIVE} FROM enriched""",
    ),
    "update_metadata_of_owner": after(
        "enriched",
        """SELECT id, owner_acronym, gen_is_duplicate AND owner_acronym = 'nation_3' AS gen_is_duplicate,
 CASE WHEN owner_acronym = 'nation_3' THEN gen_amendment_group_id END AS gen_amendment_group_id,
 CASE WHEN owner_acronym = 'nation_3' THEN round(gen_effective_total_value, 4) END AS gen_effective_total_value FROM enriched""",
    ),
    "exports_v1": after("exports", _V1),
    "exports_v2": after(
        "exports", "SELECT * REPLACE (round(yearly_value, 4) AS yearly_value) FROM v2"
    ),
    "materialize_v1": after(
        "exports",
        "SELECT owner_acronym, count(*) AS entries, round(sum(effective_total_value), 2) AS total_value FROM v1 GROUP BY 1",
    ),
    "materialize_v2": after(
        "exports",
        "SELECT owner_acronym, count(*) AS entries, round(sum(yearly_value), 2) AS total_value FROM v2 GROUP BY 1",
    ),
    "valid_entries": after(
        "marked",
        "SELECT id FROM marked WHERE NOT gen_is_duplicate AND NOT gen_is_error AND source_fiscal IS NOT NULL",
    ),
    "year_range": after(
        "contracts", "SELECT id, source_year FROM contracts WHERE source_year BETWEEN 1994 AND 1996"
    ),
    "owner_filter": after(
        "contracts", "SELECT id, owner_acronym FROM contracts WHERE owner_acronym = 'nation_3'"
    ),
    "vendor_filter": after(
        "contracts", "SELECT id FROM contracts WHERE gen_vendor_normalized = 'BUILDING 3'"
    ),
    "reset_generated": after(
        "flagged",
        """SELECT *, false AS gen_is_duplicate, cast(NULL AS int) AS gen_duplicate_via, cast(NULL AS bigint) AS gen_duplicate_source_id,
 false AS gen_is_amendment, cast(NULL AS int) AS gen_amendment_via, cast(NULL AS bigint) AS gen_amendment_group_id,
 cast(NULL AS int) AS gen_effective_start_year, cast(NULL AS int) AS gen_effective_end_year,
 cast(NULL AS double) AS gen_effective_total_value, cast(NULL AS double) AS gen_effective_yearly_value,
 cast(NULL AS double) AS gen_original_value, false AS gen_is_most_recent_value FROM flagged""",
    ),
}

ORACLES["update_metadata_actions"] = ORACLES["change_stored_metadata"] = ORACLES["update_all_metadata"]
