"""The operators on small tables, against plain versions, with awkward rows."""

import base64
import hashlib
import zlib
from array import array
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from check_oracles import compare
from contractlens.llm import (
    bpe,
    catalog,
    chat,
    common,
    components,
    exact_dedup,
    near_dedup,
    packing,
    phrases,
    sharding,
    token_files,
    toxicity,
    warc,
)
from test_text_units import JSON, RANKS, plain_shingles

FOLDER = "/root/testdata/sf0.001"
# names that the operators use inside or return
CLASHING = "ids range last class digest shard kept key n_tokens score root part slot copies text_sha256 predicted".split()
WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS)


def near(text, *changes):
    words = text.split()
    for at in changes:
        words[at] = "changed"
    return " ".join(words)


AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, "One"), (6, "one"), (7, "two words"),
    (8, LONG), (9, LONG.upper()), (10, near(LONG, 100)), (11, near(LONG, 100, 300)), (12, near(LONG, 20, 100, 300, 350)),
    (13, near(LONG, *range(0, 400, 9))), (14, "é" * 50), (15, "É" * 50), (16, "x" * 60_000), (17, "word " * 30_000),
    (21, near(LONG, 390)), (21, "another text of one id"), (21, near(LONG, 7)), (22, "another text of one id too"),
    (18, "😀 中文 \x85 \x1c<|endoftext|>"), (20, "same"), (20, "same"), (20, "same"), (-5, "negative id"),
    (None, "no id"), (None, "no id"), (None, LONG), (2**62, "large id"), (30, "ab  cd \n\n ef  "),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = spark.createDataFrame(AWKWARD, "doc_id long, text string").repartition(3)
    for name in CLASHING:
        rows = rows.withColumn(name, F.lit("other"))
    return rows.cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, ids string")


def ids_by_library(text, end=None):
    library = Tokenizer.from_file(JSON)
    return np.array(library.encode(text or "", add_special_tokens=False).ids + ([end] if end else []), "<u4")


def order(row):
    return (row[0] is not None, row[0] or 0, str(row[1:]))


def test_byte_bpe(awkward, nothing):
    with open(RANKS, "rb") as file:
        ranks = bpe.ranks_of(file.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.decode_ids(bpe.encode_texts(awkward, RANKS, public_tokenizers.PATTERN), RANKS)
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in rows.collect())
    want = Counter()
    for doc, text in AWKWARD:
        ids = library.encode_ordinary(text or "")
        want[(doc, len(ids), array("I", ids).tobytes(), (text or "").encode())] += 1
    assert got == want
    assert bpe.decode_ids(bpe.encode_texts(nothing, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_token_files(spark, awkward, nothing, tmp_path):
    got = token_files.token_files(awkward, JSON, 2).collect()
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in AWKWARD), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    want = Counter((d, ids_by_library(t, 2).tobytes()) for d, t in AWKWARD)
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    assert token_files.token_files(nothing, JSON, 2).count() == 0
    # small blocks, files kept
    path = str(tmp_path / "files")
    token_files.write_token_files(awkward, path, JSON, 2, block_ids=7)
    again = token_files.read_token_files(spark, path).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_packing(awkward, nothing):
    got = packing.pack_documents(awkward, JSON, 1, pool=8).collect()
    want = Counter((d, ids_by_library(t, 1).tobytes()) for d, t in AWKWARD)
    sequences, whole = defaultdict(list), Counter()
    pieces = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
        pieces[(r.doc_id, r.doc_tokens)].append((r.start, bytes(r.ids)))
        assert len(r.ids) == 4 * r.length
    for held in sequences.values():
        held.sort(key=lambda r: r.offset)
        assert [r.offset for r in held] == np.cumsum([0, *(r.length for r in held[:-1])]).tolist()
        size = sum(r.length for r in held)
        assert size <= 2048 and size & (size - 1) == 0 and {r.context for r in held} == {size}
    for (doc, n), parts in pieces.items():
        copies = Counter(start for start, _ in parts)
        count = copies[0]
        covered = sum(len(ids) // 4 for _, ids in parts)
        assert covered == count * n
        if count == 1:
            whole[(doc, b"".join(ids for _, ids in sorted(parts)))] += 1
    # pieces of rows with one id and length can't be told apart
    alike = Counter((doc, len(ids) // 4) for doc, ids in want.elements())
    single = {k: n for k, n in want.items() if alike[(k[0], len(k[1]) // 4)] == 1}
    assert len(single) > 15
    assert {k: whole[k] for k in single} == single
    assert packing.pack_documents(nothing, JSON, 1).count() == 0


def test_added_tokens_in_token_files_and_packing(spark):
    texts = {1: "a<|endoftext|>b", 2: "plain text", 3: "<|endoftext|>", 4: "中 <|endoftext|> é"}
    library = Tokenizer.from_file(JSON)
    want = {d: [*library.encode(t, add_special_tokens=False).ids, 2] for d, t in texts.items()}
    assert want[1] == [64, 50256, 65, 2]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = sorted(token_files.token_files(docs, JSON, 2).collect(), key=lambda r: r.start)
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == want
    assert [r.start for r in got] == np.cumsum([0, *(len(want[d]) for d in (1, 2, 3))]).tolist()
    assert {r.doc_id: r.doc_tokens for r in packing.pack_documents(docs, JSON, 2).collect()} == {
        d: len(ids) for d, ids in want.items()
    }


def jump(key, shards):
    key, bucket, target = key % 2**64, -1, 0
    while target < shards:
        bucket = target
        key = (key * 2862933555777941757 + 1) % 2**64
        target = int((bucket + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return bucket


def test_shards(spark, awkward, nothing):
    got = sharding.assign_shards(awkward, 8, chunk_rows=1).collect()
    assert len(got) == len(AWKWARD)
    want = Counter()
    for doc, text in AWKWARD:
        data = (text or "").encode()
        want[(doc, len(data) + 1, zlib.crc32(data), "key", jump(doc or 0, 8), jump(doc or 0, 9))] += 1
    assert want == Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got)
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(nothing).count() == 0
    keys = spark.range(-300, 9000, 31)
    for shards in (1, 2, 70, 5000):
        found = keys.select("id", sharding.jump_hash(sharding.unsigned(F.col("id")), shards).alias("s"))
        assert all(r.s == jump(r.id, shards) for r in found.collect())


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("least", [1, 2, 64])
def test_exact_duplicates(awkward, nothing, least):
    groups = defaultdict(list)
    for doc, text in AWKWARD:
        groups[lower(text)].append(doc)
    want = Counter()
    for text, docs in groups.items():
        keep = max((d for d in docs if d is not None), default=None)
        for doc in docs:
            digest = hashlib.sha256(text.encode()).hexdigest()
            want[(doc, keep, len(docs), keep is None or doc == keep, digest)] += 1
    got = exact_dedup.exact_duplicates(awkward, least_copies=least)
    assert want == Counter(tuple(r) for r in got.collect())
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    kept = exact_dedup.drop_exact_duplicates(awkward)
    assert kept.columns == awkward.columns
    want_kept = sorted((str(d) for (d, _, _, k, _), n in want.items() for _ in range(n) if k or d is None))
    assert sorted(str(r.doc_id) for r in kept.collect()) == want_kept


def brute_components(rows, words):
    sets = [plain_shingles(text or "", words) for _, text in rows]
    sets = [frozenset(tuple(w.lower() for w in s) for s in x) for x in sets]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(rows[i][0], len(sets[i]), least.get(find(i))) for i in range(len(rows))]


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_of_awkward_rows(awkward, nothing, words):
    want = Counter((d, n, c, c is None or d == c) for d, n, c in brute_components(AWKWARD, words))
    got = near_dedup.near_duplicates(awkward, words)
    assert want == Counter(tuple(r) for r in got.collect())
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_near_duplicates_in_chains(spark, monkeypatch):
    """Chains in which only neighbours are similar, and a bucket of several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    base = [f"v{i}" for i in range(120)]
    rows, words = [], list(base)
    for i in range(40):
        words = list(words)
        for k in range(2):
            words[(i * 2 + k) * 3 % 120] = f"n{i}.{k}"
        rows.append((i * 7 % 41, " ".join(words)))
    rows += [(100 + i, " ".join(base[:60]) + f" {i} " + " ".join(f"o{i}.{k}" for k in range(60))) for i in range(30)]
    want = Counter((d, n, c, d == c) for d, n, c in brute_components(rows, 4))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert want == Counter(tuple(r) for r in near_dedup.near_duplicates(docs, 4).collect())


def test_components(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(100)] + [("z", "y"), ("y", "z"), ("q", "q"), (None, "a"), ("x", "y")]
    edges += [("m", f"leaf{i}") for i in range(300)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "a string, b string")).collect())
    want = {f"{i:03}": "000" for i in range(101)} | {"x": "x", "y": "x", "z": "x"}
    want |= {f"leaf{i}": "leaf0" for i in range(300)} | {"m": "leaf0"}
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_fingerprints(spark, awkward, nothing):
    got = sorted(phrases.compare_with_edits(awkward).collect(), key=order)
    rows = sorted(((d, t or "") for d, t in AWKWARD), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        n = len(text) // 4
        edit = text[: len(text) - n] + following[:n]
        own, other, after = phrases.fingerprints([text, edit, following])
        want.append((
            doc, len(text), hashlib.sha256(edit.encode()).hexdigest(), own, other,
            phrases.likeness(own, other), phrases.likeness(own, after),
        ))
    assert [tuple(r) for r in got] == sorted(want, key=order)
    assert phrases.compare_with_edits(nothing).count() == 0
    alone = phrases.compare_with_edits(spark.createDataFrame([(1, "abcd efgh")], "doc_id long, text string")).collect()
    assert alone[0].near_next == 1
    plain = {(r.doc_id, r.fingerprint) for r in phrases.fingerprint_texts(awkward).collect()}
    assert plain == {(r.doc_id, r.fingerprint) for r in got}


def test_ranges_of_ids(spark):
    bounds = [3, 10, 11, 40, 41, 90]
    ids = spark.createDataFrame([(i,) for i in [None, *range(-2, 100)]], "id long")
    for r in ids.select("id", phrases._range_of(F.col("id"), bounds).alias("r")).collect():
        assert r.r == (0 if r.id is None else sum(b <= r.id for b in bounds))


PAGES = [
    (1, "http://a", "x"), (2, "http://b", "x"), (3, "http://c", None), (4, None, ""), (5, "http://d", "\r\n\r\nWARC/1.1\r\n"),
    (6, "http://d", "\r\n\r\nWARC/1.1\r\n"), (7, "http://e", "é" * 3000), (8, "h\r\nX: y", "x"), (9, "u", "\r\n"), (9, "u", "\r\n"),
    (10, "u", "y" * 300_000),
]


@pytest.mark.parametrize("least", [0, 2])
def test_archives(spark, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("z"))
    first = {}
    for page, _, html in PAGES:
        first.setdefault(html or "", page)
    want = set()
    for page, _, html in PAGES:
        data = (html or "").encode()
        of = first[html or ""] if len(data) >= least and first[html or ""] != page else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.add((page, len(data), digest, "revisit" if of is not None else "response", of))
    got = [tuple(r) for r in warc.archive_pages(pages, least).collect()]
    assert set(got) == want and len(got) == len(want)
    none = pages.filter("page_id < 0")
    assert warc.archive_pages(none).count() == 0


def test_transactions_are_nested(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "a"), records_per_file=4)
    rows = warc.assemble_transactions(warc.read_records(spark, str(tmp_path / "a"))).collect()
    assert len(rows) == 10
    by_page = {r.metadata[0].page_id: r for r in rows}
    assert warc.http_payload(bytes(by_page[5].block)) == b"\r\n\r\nWARC/1.1\r\n"
    assert by_page[6].refers_to == by_page[5].record_id
    assert all(len(r.requests) == len(r.metadata) == 1 for r in rows)
    assert bytes(by_page[8].requests[0].block) == b"GET h X: y HTTP/1.1\r\n\r\n"


def test_every_page_row_is_a_capture(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "COPIES", 2)
    rows = [(1, "a", "x"), (1, "b", "x"), (2, "c", "x"), (2, "c", "x"), (2, "d", "x"), (3, "e", "y"), (4, None, "x")]
    rows += [(5, "f", "z")] * 5 + [(6, "g", "z")]
    unknown = [(None, "u", "x"), (None, "v", "x"), (None, None, ""), (None, None, None), (None, "u", "only"), (None, "u", "x")]
    frame = lambda some: spark.createDataFrame(some, "page_id long, url string, html string")
    folder = str(tmp_path)
    frame(rows).write.parquet(f"{folder}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet/*.parquet')")
    state, count, _, note = compare(spark, con, folder, "op6_warc", catalog.op6_warc, catalog.ORACLES["op6_warc"])
    assert (state, count) == ("ok", len(rows)), note
    # every row without an id is a response of its own, with or without the repeated ones
    for every, known in ((True, len(rows)), (False, len(set(rows)))):
        got = [tuple(r) for r in warc.archive_pages(frame(rows + unknown), every_row=every).collect()]
        assert len(got) == known + len(unknown)
        assert sorted((r[1], r[3], r[4]) for r in got if r[0] is None) == sorted(
            (len(html or ""), "response", None) for _, _, html in unknown
        )


TALKS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "bye"),
    (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "bye"),
    (4, 0, "user", "hi"), (4, 1, "user", "hello"),
    (5, 0, "user", None), (5, 0, "user", None), (5, None, None, "first"),
    (6, None, "", "first"), (7, 0, "assistant", "hello"), (None, 0, "user", "hi"),
]


def test_conversations(spark):
    rows = spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1))
    got = {r.conv_id: r for r in chat.format_conversations(rows).collect()}
    assert {k: (r.n_turns, r.n_copies) for k, r in got.items()} == {2: (3, 2), 4: (2, 1), 5: (3, 1), 7: (1, 1)}
    assert got[4].rendered == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>user\nhello<|im_end|>\n"
    assert got[5].rendered.startswith("<|im_start|>\nfirst<|im_end|>\n<|im_start|>user\n<|im_end|>")
    assert chat.format_conversations(rows.filter("turn > 9")).count() == 0


def test_toxicity(spark, awkward, nothing):
    docs, labels = common.read(spark, FOLDER, "documents"), common.read(spark, FOLDER, "labels")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    # marks of held-out rows make no difference
    changed = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.score_toxicity(docs, changed).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    marks = spark.createDataFrame([(8, 1), (8, 0), (None, 1), (999, 1), (10, None)], "doc_id long, toxic int")
    odd = toxicity.score_toxicity(awkward, marks)
    assert odd.count() == len(AWKWARD) and odd.filter("score IS NULL OR held_out IS NULL").count() == 0
    assert toxicity.score_toxicity(nothing, marks).count() == 0
    assert toxicity.drop_toxic(awkward, marks.limit(0)).count() == len(AWKWARD)


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.1"), reason="needs the larger tables")
def test_toxicity_on_held_out_marks(spark):
    docs, labels = (common.read(spark, "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    wrong = sum(r.predicted for r in rows if not r.toxic) / sum(not r.toxic for r in rows)
    found = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    assert right > 0.96 and found > 0.85 and wrong < 0.02


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("documents", "conversations", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows_as_sql(spark, tables, name):
    state, _, _, note = compare(spark, tables, FOLDER, name, catalog.QUERIES[name], catalog.ORACLES[name])
    assert state == "ok", note


def test_stages_keep_one_row_of_each_group(spark):
    long, other = LONG, " ".join(f"z{i}" for i in range(300))
    rows = [
        (5, "x"), (9, "x"), (5, "y"),  # (5, "y") stays though (5, "x") goes
        (7, "twice"), (7, "twice"), (8, "One"), (8, "one"), (None, "none"), (None, "none"), (None, "x"),
        (None, "a text"), (3, ""), (3, None), (4, "\t"),
    ]
    frame = lambda some: spark.createDataFrame(some, "doc_id long, text string").withColumn("kept", F.lit("own"))
    got = corpus_pipeline.exact_dedup(spark, frame(rows).repartition(3), FOLDER)
    assert got.columns == ["doc_id", "text", "kept"]
    assert Counter((r.doc_id, lower(r.text)) for r in got.collect()) == Counter(
        [(9, "x"), (5, "y"), (7, "twice"), (8, "one"), (None, "none"), (None, "a text"), (3, ""), (4, "\t")]
    )
    # without one_each an id with a text that goes keeps its other text too
    plain = exact_dedup.drop_exact_duplicates(frame(rows)).collect()
    assert (5, "y") in {(r.doc_id, r.text) for r in plain} and (5, "x") not in {(r.doc_id, r.text) for r in plain}

    rows = [
        (1, long), (2, near(long, 100)), (2, other), (2, "short one"),  # only the near copy of 2 goes
        (6, near(other, 50)), (7, "again and again"), (7, "again and again"), (None, near(long, 7)),
        (None, "no id at all"), (None, "no id at all"), (None, "no id as well"), (3, ""), (3, ""), (3, " "), (None, None), (None, ""),
        (11, " ".join(WORDS[::-1])), (11, near(" ".join(WORDS[::-1]), 9)),  # alike under one id: one stays
    ]
    got = corpus_pipeline.near_dedup(spark, frame(rows).repartition(3), FOLDER).collect()
    eleven = [r for r in got if r.doc_id == 11]
    assert len(eleven) == 1
    assert Counter((r.doc_id, r.text or "") for r in got if r.doc_id != 11) == Counter(
        [(1, long), (2, other), (2, "short one"), (7, "again and again"), (None, "no id at all"),
         (None, "no id as well"), (3, ""), (3, " "), (None, "")]
    )


def test_pipeline(spark):
    """Each stage does to its input what a plain version does."""
    docs = common.read(spark, FOLDER, "documents").cache()
    columns, rows = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    scores = toxicity.score_toxicity(docs, common.read(spark, FOLDER, "labels")).collect()
    clean = {r.doc_id: rows[r.doc_id] for r in scores if not r.predicted}
    last = {lower(t): d for d, t in sorted(clean.items())}
    distinct = {d: clean[d] for d in last.values()}
    least = brute_components(list(distinct.items()), 5)
    want = [{d for d in clean}, set(distinct), {d for d, _, c in least if d == c}]
    for (_, stage), kept in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns
        assert sorted(r.doc_id for r in docs.collect()) == sorted(kept)
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    lengths = defaultdict(int)
    for r in pieces:
        lengths[r.doc_id] += r.length
    assert dict(lengths) == {d: len(ids_by_library(rows[d], 1)) for d in want[-1]}
