"""Rounds, ranges, versions and buckets: what keeps large inputs in bounds."""

import csv
import io
import math
import random
from collections import Counter
from functools import partial

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from contractlens.catalog import ingest, inputs
from contractlens.operators import amendments, claims, contraction, duplicates, series
from contractlens.operators import reports as r
from contractlens.plans import metadata, report_suite
from contractlens.sources import files, snapshots, split_csv, writers
from contractlens.streaming import incremental, key_index
from test_core_rules import COLUMNS, NAMES, as_dicts


def staircases(count, size):
    """One group of rows; in a staircase each shares its date with the next one and its
    reference with the one after, turn about. Staircases share nothing."""
    rows = []
    for k in range(count):
        for i in range(size):
            rows.append(
                (len(rows), "hot", "2010-Q1", 10.0, None, "V", f"d{k}-{(i + 1) // 2}", f"r{k}-{i // 2}", 2011, 2010, 2011, False)
            )
    return rows


def counted(monkeypatch):
    calls, plain = [], claims._round
    monkeypatch.setattr(claims, "_round", lambda rows: calls.append(1) or plain(rows))
    return calls


def test_staircases_take_a_bounded_number_of_rounds(spark, monkeypatch):
    rows, rounds = staircases(60, 30), counted(monkeypatch)
    df = spark.createDataFrame(rows, COLUMNS).repartition(8)
    out = duplicates.find_duplicates(df, 20, 0).filter("gen_is_duplicate")
    got = {r.id: (r.gen_duplicate_via, r.gen_duplicate_source_id) for r in out.collect()}
    assert got == brute.duplicates(as_dicts(rows))
    assert len(rounds) == claims.ROUNDS


def test_components_beyond_the_bound_go_on_with_rounds(spark, monkeypatch):
    rows, rounds = [*staircases(2, 24), *staircases(9, 6)], counted(monkeypatch)
    rows = [(i, *row[1:6], f"{row[6]}{i >= 48}", f"{row[7]}{i >= 48}", *row[8:]) for i, row in enumerate(rows)]
    monkeypatch.setattr(duplicates, "accepted_rows", partial(claims.accepted_rows, component_rows=15, rounds=2))
    df = spark.createDataFrame(rows, COLUMNS).repartition(8)
    out = duplicates.find_duplicates(df, 20, 0).filter("gen_is_duplicate")
    got = {r.id: (r.gen_duplicate_via, r.gen_duplicate_source_id) for r in out.collect()}
    assert got == brute.duplicates(as_dicts(rows))
    assert 2 < len(rounds) <= 12


def plain_values(parents, known):
    """OR over the children's negated values."""
    children = {}
    for child, parent in parents.items():
        children.setdefault(parent, []).append(child)
    values = dict(known)
    for node in sorted(children):  # children are smaller than their parent
        values[node] = any(not values[child] for child in children[node])
    return {node: values[node] for node in children}


def contracted(spark, parents, known):
    links = spark.createDataFrame([(p, c, True) for c, p in parents.items()], "parent long, child long, flip boolean")
    values, rounds = contraction.forest_values(links, spark.createDataFrame(list(known.items()), "node long, value boolean"))
    return {r.node: r.value for r in values.collect()}, rounds


@pytest.mark.parametrize("reach", [2, 40])
def test_forests_are_contracted(spark, reach):
    rng = random.Random(reach)
    parents = {i: rng.randint(i + 1, min(i + reach, 300)) for i in range(300) if rng.random() < 0.95}
    inner = set(parents.values())
    known = {i: rng.random() < 0.5 for i in parents if i not in inner}
    got, rounds = contracted(spark, parents, known)
    assert got == plain_values(parents, known)
    assert rounds <= 2 * math.ceil(math.log2(300)) + 2


def test_a_chain_takes_a_logarithm_of_rounds(spark):
    for size in (30, 500):
        parents = {i: i + 1 for i in range(size)}
        got, rounds = contracted(spark, parents, {0: True})
        assert got == plain_values(parents, {0: True})
        assert rounds <= math.ceil(math.log2(size)) + 2


def test_chains_of_amendments(spark):
    """Every entry's original value is the next one's contract value."""
    rows = [
        (i, "hot", "2010-Q1", float(i), float(i + 1), "V", None, f"r{i}", 2011, 2010, 2011, False, False) for i in range(40)
    ]
    df = spark.createDataFrame(rows, COLUMNS + ", gen_is_duplicate boolean").repartition(4)
    out = amendments.find_amendments(df, 10, 0).filter("gen_amendment_group_id is not null")
    got = {r.id: (r.gen_is_amendment, r.gen_amendment_group_id) for r in out.collect()}
    assert got == brute.amendments(as_dicts(rows, [*NAMES, "gen_is_duplicate"]))


# ranges of a CSV file

FIELDS = st.text(st.sampled_from('ab", \n\r'), max_size=12)


@settings(deadline=None)
@given(st.lists(st.lists(FIELDS, min_size=2, max_size=4), max_size=6))
def test_states_of_lines(rows):
    held = io.StringIO(newline="")
    csv.writer(held, lineterminator="\n").writerows(rows)
    text, inside, records = held.getvalue(), False, 0
    for line in text.split("\n")[:-1]:
        inside = split_csv.ends_inside(line, inside)
        records += not inside
    assert not inside and records == len(rows)


@pytest.fixture
def tiny_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def written(folder, name, rows, end="\n"):
    with open(folder / name, "w", newline="", encoding="utf-8") as file:
        csv.writer(file, lineterminator=end).writerows(rows)


def test_one_file_is_read_by_many_tasks(spark, tiny_ranges, tmp_path):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice('ab",\né ') for _ in range(rng.randrange(9)))
    wanted = {"a.csv": [], "b.csv": [], "c.csv": []}
    for name in ("a.csv", "b.csv"):
        for i in range(100):
            text = word() if i % 40 else "x\n" * 700  # some records cross many ranges
            wanted[name].append([f"{name}{i}", *[word() for _ in range(40)], text, "end"])
        head = [f"h{i}" for i in range(43)]
        written(tmp_path, name, [head, *wanted[name]], "\r\n" if name == "b.csv" else "\n")
    (tmp_path / "c.csv").write_text("\n\n")
    found = files.scan_contract_csv(spark, str(tmp_path))
    known = files.csv_columns()
    got = {}
    for row in files.with_row_numbers(found).collect():
        got[row.row_number] = (row.file_path.split("/")[-1], [row[field] for field in known.values()])
    order = [(name, row) for name in sorted(wanted) for row in wanted[name]]
    want = [(name, [row[int(column[1:])].replace("\r\n", "\n") for column in known]) for name, row in order]
    assert sorted(got) == list(range(2, len(want) + 2))
    assert [got[i] for i in sorted(got)] == want
    ranges = found.groupBy("file_path", "block_start").count().filter("file_path like '%a.csv'").count()
    assert ranges > 30


def test_a_file_without_an_end(spark, tiny_ranges, tmp_path):
    (tmp_path / "a.csv").write_text('h1,h2\n1,"open\n' + "more\n" * 300)
    rows = split_csv.csv_records(spark, str(tmp_path)).orderBy("block_start", "place").collect()
    assert [r.record for r in rows] == ["h1,h2", '1,"open\n' + "more\n" * 299 + "more"]


# versions

ROWS = "id long, owner_acronym string, source_origin int, contract_value double"


def contents(spark, path):
    rows = writers.read_contracts(spark, path, spark.createDataFrame([], ROWS).schema).collect()
    return Counter((r.id, r.owner_acronym, r.source_origin) for r in rows)


def test_departments_without_new_rows_end_up_empty(spark, tmp_path):
    path, frame = str(tmp_path / "table"), lambda rows: spark.createDataFrame(rows, ROWS)
    assert not contents(spark, path)
    writers.replace_owner_rows(frame([(1, "a", 1, 1.0), (2, "b", 1, 1.0), (3, "x/y=z", 1, 1.0), (4, None, 1, 0.0)]), path, [])
    writers.replace_csv_rows(frame([(5, "a", 2, 1.0), (6, "b", 2, 1.0), (7, "c", 2, 1.0)]), path)
    writers.replace_owner_rows(frame([(8, "a", 1, 1.0)]), path, ["a", "b", "x/y=z"])
    assert contents(spark, path) == Counter([(8, "a", 1), (4, None, 1), (7, "c", 2)])
    writers.replace_owner_rows(frame([]), path, [None, "c"])
    assert contents(spark, path) == Counter([(8, "a", 1)])
    writers.replace_csv_rows(frame([(9, "q", 2, 1.0)]), path)
    assert len(snapshots.drop_unused(spark, path)) == 3  # loads of which nothing is left, an empty one too
    assert contents(spark, path) == Counter([(8, "a", 1), (9, "q", 2)])


def test_a_failed_load_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    writers.replace_owner_rows(spark.createDataFrame([(1, "a", 1, 1.0), (2, "b", 1, 1.0)], ROWS), path, [])
    before = contents(spark, path)
    bad = spark.range(50).repartition(5).selectExpr(
        "id", "'a' AS owner_acronym", "1 AS source_origin", "CASE WHEN id = 49 THEN raise_error('broken') ELSE 1.0D END AS contract_value"
    )
    with pytest.raises(Exception, match="broken"):
        writers.replace_owner_rows(bad, path, ["a", "b"])
    assert contents(spark, path) == before
    # a manifest that was not written to its end is no version either
    with open(f"{path}/_manifests/{2:012d}.json", "w") as file:
        file.write('{"folders": [')
    assert contents(spark, path) == before
    writers.replace_owner_rows(spark.createDataFrame([(3, "b", 1, 1.0)], ROWS), path, ["b"])
    assert contents(spark, path) == Counter([(1, "a", 1), (3, "b", 1)])


def test_loads_that_cross_are_both_kept(spark, tmp_path, monkeypatch):
    path, frame = str(tmp_path / "table"), lambda rows: spark.createDataFrame(rows, ROWS)
    writers.replace_owner_rows(frame([(1, "a", 1, 1.0)]), path, [])
    plain, crossed = snapshots.current, []

    def late(files):
        found = plain(files)
        if not crossed:
            crossed.append(1)
            writers.replace_owner_rows(frame([(2, "b", 1, 1.0)]), path, [])
        return found

    monkeypatch.setattr(snapshots, "current", late)
    writers.replace_owner_rows(frame([(3, "c", 1, 1.0)]), path, [])
    monkeypatch.undo()
    assert contents(spark, path) == Counter([(1, "a", 1), (2, "b", 1), (3, "c", 1)])


# buckets of stored keys


def test_filters_rule_out_nothing_that_they_hold():
    rng = random.Random(1)
    keys = [f"{rng.getrandbits(128):032x}" for _ in range(5000)]
    held = key_index.bloom_filter(keys[:2500])
    found = key_index.may_hold(held, key_index._halves(keys))
    assert found[:2500].all() and found[2500:].mean() < 0.03


def test_a_batch_reads_only_buckets_that_it_may_hit(spark, tmp_path, monkeypatch):
    path, read = str(tmp_path / "stored"), []
    plain = key_index._stored

    def watched(spark, path, kind, schema, buckets, but):
        found = plain(spark, path, kind, schema, buckets, but)
        if found is not None:
            read.extend((kind, f.split("bucket=")[1][:2]) for f in found.inputFiles())
        return found

    monkeypatch.setattr(key_index, "_stored", watched)
    pages = lambda ids: spark.createDataFrame([(i, f"http://x/{i}") for i in ids], "page_id long, url string")
    incremental.store_new_pages(pages(range(3000)), 0, path)
    assert not read
    batch = pages([5, 7, 5000, 5001, 5002])
    incremental.store_new_pages(batch, 1, path)
    buckets = lambda kind: {b for k, b in read if k == kind}
    assert len(read) <= 2 * 5 and 1 <= len(buckets(key_index.KEYS)) <= 3 and len(buckets(key_index.FILTERS)) <= 5
    incremental.store_new_pages(batch, 1, path)  # again, after a failure
    incremental.store_new_pages(pages([7, 5001, 6000]), 2, path)
    stored = spark.read.parquet(path)
    assert Counter(r.page_id for r in stored.collect()) == Counter([*range(3000), 5000, 5001, 5002, 6000])
    assert stored.columns == ["page_key", "page_id", "url", "batch"]


def test_pages_without_a_url_have_no_key(spark, tmp_path):
    path = str(tmp_path / "stored")
    for number in range(2):
        incremental.store_new_pages(spark.createDataFrame([(number, None)], "page_id long, url string"), number, path)
    assert spark.read.parquet(path).count() == 2
    assert spark.read.parquet(path).select(F.count("page_key")).first()[0] == 0


# copy on write and change propagation


def test_changed_aliases_rewrite_few_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    kind = "id long, owner_acronym string, source_origin int, gen_vendor_clean string, gen_vendor_normalized string"
    rows = [(i, f"o{i % 10}", 1, f"V{i}", f"V{i}") for i in range(100)]
    frame = spark.createDataFrame(rows, kind)
    writers.replace_owner_rows(frame, path, [])
    before = snapshots.current(snapshots.Files(spark, path))[1]
    aliases = spark.createDataFrame([("V13", "P"), ("V23", "P"), ("V44", "Q"), ("other", "P")], "vendor_clean string, parent string")
    assert writers.renormalize_contracts(spark, path, frame.schema, aliases) == 2
    after = snapshots.current(snapshots.Files(spark, path))[1]
    assert len(set(before) & set(after)) == 8 and len(after) == 10
    got = {r.id: r.gen_vendor_normalized for r in writers.read_contracts(spark, path, frame.schema).collect()}
    assert got == {i: {13: "P", 23: "P", 44: "Q"}.get(i, f"V{i}") for i in range(100)}
    assert writers.renormalize_contracts(spark, path, frame.schema, aliases) == 0
    assert snapshots.current(snapshots.Files(spark, path))[1] == after


def contract_rows(spark, seed, ids):
    """Contract entries of few departments, vendors and values, so that rules meet."""
    rng = random.Random(seed)
    rows = []
    for i in ids:
        year = rng.choice([2010, 2011, 2012])
        rows.append(
            (
                i, f"o{rng.randrange(8)}", rng.choice([f"{year}-Q{rng.randrange(1, 5)}", None] if i % 9 == 0 else [f"{year}-Q1"]),
                year, float(rng.randrange(1, 9)), rng.choice([None, 2.0, 3.0]), rng.choice(["A", "B", "C", None]),
                f"d{rng.randrange(5)}", rng.choice([None, f"r{rng.randrange(9)}"]), year, year + rng.randrange(3),
                rng.random() < 0.1, rng.choice([1, 2]), f"text {i}",
            )
        )
    return spark.createDataFrame(
        rows,
        "id long, owner_acronym string, source_fiscal string, source_year int, contract_value double, "
        "original_value double, gen_vendor_normalized string, raw_contract_date string, reference_number string, "
        "gen_start_year int, gen_end_year int, gen_is_error boolean, source_origin int, description string",
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_give_what_a_full_run_gives(spark, seed):
    rng = random.Random(seed)
    base, added = contract_rows(spark, seed, range(400)), contract_rows(spark, seed + 10, range(400, 400 + 12 * (seed % 2)))
    removed = spark.createDataFrame([(rng.randrange(400),) for _ in range(10)], "id long")
    full = metadata.update_all_metadata(base)
    stored = spark.createDataFrame(full.collect(), full.schema)
    got = metadata.apply_changes(stored, added, removed)
    assert got.columns == stored.columns
    left = base.unionByName(added).join(removed, "id", "left_anti").select(*base.columns)
    want = metadata.update_all_metadata(left)
    by_id = lambda rows: {r.id: r.asDict() for r in rows.collect()}
    got, want = by_id(got), by_id(want)
    assert got.keys() == want.keys()
    for i, row in want.items():
        assert got[i] == row


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "table")
    base = contract_rows(spark, 5, range(300))
    flagged = metadata.update_all_metadata(base)
    snapshots.replace(flagged, path, writers.PARTITIONS, lambda old, new: True)
    before = set(snapshots.current(snapshots.Files(spark, path))[1])
    added = contract_rows(spark, 6, range(300, 303)).withColumn("owner_acronym", F.lit("o3"))
    removed = spark.createDataFrame([(7,)], "id long")
    home = base.filter("id = 7").first().owner_acronym
    count = metadata.change_stored(spark, path, flagged.schema, added, removed)
    after = set(snapshots.current(snapshots.Files(spark, path))[1])
    rewritten = {f.split("/", 1)[1] for f in after - before}
    assert len(rewritten) == count and {f.split("=")[-1] for f in rewritten} <= {"o3", home}
    assert len(before & after) >= 12
    got = {r.id: r.asDict() for r in snapshots.read(spark, path, flagged.schema).collect()}
    left = base.unionByName(added).filter("id <> 7").select(*base.columns)
    want = {r.id: r.asDict() for r in metadata.update_all_metadata(left).collect()}
    assert got == want


# shared scans and positions


def test_reports_of_a_base_equal_reports_of_the_rows(spark):
    tables = inputs.store(spark, "/root/testdata/sf0.001")
    contracts, v2, years = tables["contracts"], tables["exports_v2"], (1996, 2002)
    base, values = r.report_base(contracts), r.value_base(v2)
    assert base.count() <= contracts.count()
    for make in (report_suite.general_reports, report_suite.department_reports, report_suite.vendor_reports):
        plain, shared = make(contracts, v2, years), make(base, values, years)
        assert plain.keys() == shared.keys()
        for name in plain:
            rows = [Counter(map(tuple, made[name][0].collect())) for made in (plain, shared)]
            assert rows[0] == rows[1], name


def test_stored_tables_are_read_once_for_all_reports(spark, tmp_path, monkeypatch):
    tables = inputs.store(spark, "/root/testdata/sf0.001")
    reads, plain = [], report_suite.write_report
    stored = {name: set(tables[name].inputFiles()) for name in ("contracts", "exports_v2")}

    def watched(report, *rest):
        reads.append(set(report.inputFiles()) & (stored["contracts"] | stored["exports_v2"]))
        return plain(report, *rest)

    monkeypatch.setattr(report_suite, "write_report", watched)
    folders = report_suite.write_all_reports(tables["contracts"], tables["exports_v2"], str(tmp_path), (1996, 2002))
    assert len(folders) == len(reads) == 23 and not any(reads)


def test_limits_are_parameters(spark):
    contracts = inputs.store(spark, "/root/testdata/sf0.001")["contracts"]
    every = r.entries_by_fiscal(contracts, limit=None).count()
    assert every > 3 and r.entries_by_fiscal(contracts, limit=3).count() == 3


def test_positions_need_no_single_task(spark):
    rng = random.Random(4)
    rows = [(f"l{rng.randrange(300)}", rng.randrange(1000)) for _ in range(2000)] + [(None, 5)]
    df = spark.createDataFrame(rows, "label string, at long")
    out = series.label_positions(df, "label", ["at"])
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    first = {}
    for label, at in rows:
        first[label] = min(at, first.get(label, at))
    place = {at: i for i, at in enumerate(sorted(set(first.values())))}
    assert {x.label: x.position for x in out.collect()} == {label: place[at] for label, at in first.items()}
    assert series.label_positions(df.limit(0), "label").count() == 0


def test_sides_that_grow_are_not_gathered_at_the_driver(spark, tmp_path):
    """Small files make Spark broadcast a side; the grouped values and amendment links grow
    with the entries, so they must meet the rows by shuffle."""
    from contractlens.operators import amendments, effective

    columns = (
        "id long, owner_acronym string, gen_vendor_normalized string, source_fiscal string, source_year int, "
        "contract_value double, original_value double, reference_number string, gen_start_year int, "
        "gen_end_year int, gen_is_error boolean, gen_is_duplicate boolean"
    )
    rows = [
        (i, "o", "v", f"20{i % 20:02d}", 2000 + i % 20, float(i), None, f"R{i % 7}", 2000 + i % 20, 2020, False, False)
        for i in range(60)
    ]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, columns).write.parquet(path)
    linked = amendments.find_amendments(spark.read.parquet(path), fold_limit=8, tail_rows=1)
    linked.write.parquet(path + "-linked")
    valued = effective.effective_values(spark.read.parquet(path + "-linked"))
    for step in (linked, valued):
        joins = step._jdf.queryExecution().optimizedPlan().toString()
        physical = step._jdf.queryExecution().sparkPlan().toString()
        assert "Join" in joins and "SortMergeJoin" in physical
    assert "BroadcastHashJoin" not in valued._jdf.queryExecution().sparkPlan().toString()


def test_rows_are_numbered_without_reading_the_files_again(spark, tiny_ranges, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("\n\nh1,h2\n" + "".join(f'{i},"x\n\n""{i}"\n\r\n' for i in range(60)))
    (tmp_path / "b.csv").write_text("h1,h2\n" + "".join(f"{i},y\n" for i in range(60, 200)))
    found = files.scan_contract_csv(spark, str(tmp_path))
    cuts, plain = [], split_csv._cut
    monkeypatch.setattr(split_csv, "_cut", lambda *given: cuts.append(1) or plain(*given))
    monkeypatch.setattr(files, "small_side", None)
    rows = files.with_row_numbers(found).select("row_number", "csvReferenceNumber").collect()
    assert not cuts
    assert sorted((n, int(k)) for n, k in rows) == [(i + 2, i) for i in range(200)]


def test_tasks_that_write_record_files_sort_a_bounded_share(spark, tmp_path):
    """More records give more writing tasks, not longer sorts."""
    folder = "/root/testdata/sf0.01"
    for name in ("orders", "customer", "nation"):
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(4).write.parquet(f"{tmp_path}/{name}.parquet")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "100k")
    try:
        path = ingest._write_record_files(spark, str(tmp_path))
    finally:
        spark.conf.unset(size)
    task = F.regexp_extract(F.input_file_name(), r"/part-(\d+)-", 1)
    written = spark.read.text(path, recursiveFileLookup=True).groupBy(task).count().collect()
    assert sum(r["count"] for r in written) == 15_000
    assert max(r["count"] for r in written) < 3_000


def test_rows_out_of_the_amendment_rules_are_written_once(spark, monkeypatch):
    """Owner filter and yearly totals wait for the stored tables: duplicates and errors, which
    may be most rows, are not written again, and short columns need no join back by id."""
    rows = inputs.flagged(spark, "/root/testdata/sf0.001").drop("row_created_at")
    written, plain = [], metadata.cut_lineage

    def cut(df):
        out = plain(df)
        written.append(out.count())
        return out

    joined = []
    monkeypatch.setattr(metadata, "cut_lineage", cut)
    monkeypatch.setattr(metadata, "metadata_flags", joined.append)
    out = metadata.update_all_metadata(rows)
    part = out.filter("NOT gen_is_duplicate AND NOT gen_is_error AND source_fiscal IS NOT NULL").count()
    assert written == [rows.count(), part] and part < rows.count()
    assert not joined


def test_wide_columns_stay_out_of_the_rules(spark):
    rows = inputs.flagged(spark, "/root/testdata/sf0.001")
    wide = metadata.update_all_metadata(rows.withColumn("description", F.lit("x")))
    plain = metadata.update_all_metadata(rows)
    assert sorted(map(str, wide.drop("description").collect())) == sorted(map(str, plain.collect()))


def test_equal_keys_are_reduced_without_sorting_all_rows(spark, monkeypatch):
    plans, plain = [], claims.cut_lineage
    monkeypatch.setattr(claims, "cut_lineage", lambda df: plans.append(df) or plain(df))
    rows = staircases(3, 8)
    copies = [(i + 100, *row[1:]) for i, row in enumerate(rows)] + [(i + 200, *row[1:2], "2010-Q2", *row[3:]) for i, row in enumerate(rows)]
    df = spark.createDataFrame(rows + copies, COLUMNS).repartition(4)
    out = duplicates.find_duplicates(df, 20, 1000).filter("gen_is_duplicate")
    got = {r.id: (r.gen_duplicate_via, r.gen_duplicate_source_id) for r in out.collect()}
    assert got == brute.duplicates(as_dicts(rows + copies))
    # from the bottom up, the first aggregates take numbers and need no sort
    steps = [line for line in plans[0]._jdf.queryExecution().sparkPlan().toString().split("\n") if "Aggregate" in line]
    assert "HashAggregate" in steps[-1] and "HashAggregate" in steps[-2]
