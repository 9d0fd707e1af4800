"""Parsing, risk and hot keys against plain second versions; awkward rows end to end."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracles import compare
from contractlens.llm import catalog, chat, common, exact_dedup, phrases, sharding, token_files, toxicity
from test_text_operators import AWKWARD, FOLDER, TALKS, ids_by_library
from test_text_units import JSON

WORD = 2**64 - 1
#: Names that steps use inside or that need quotes.
ODD = ["my.col", "a`b", "row", "digest", "of", "kept", "score", "class", "ids", "group"]


def with_odd_columns(rows):
    for name in ODD:
        rows = rows.withColumn(name, F.lit("other"))
    return rows


# parsing, one name at a time


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & WORD
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & WORD
    return x ^ (x >> 31)


def toss(now, before):
    place = next(b for b in range(64) if (now ^ before) >> b & 1)
    return 2 * place + (now >> place & 1)


def plain_next_level(names):
    runs = []
    for name in names:
        if runs and runs[-1][0] == name:
            runs[-1][1] += 1
        else:
            runs.append([name, 1])
    names = [name if n == 1 else mix((name * 3 + n) & WORD) for name, n in runs]
    label = names
    for _ in range(4):  # each time labels of fewer kinds
        label = [toss(now, label[i - 1] if i else now ^ 1) for i, now in enumerate(label)]
    assert max(label) <= 5 and all(a != b for a, b in zip(label, label[1:], strict=False))
    out, held = [], []
    for i, name in enumerate(names):
        left = label[i - 1] if i else -1
        right = label[i + 1] if i + 1 < len(label) else -1
        if held and label[i] > left and label[i] > right:
            out.append(held)
            held = []
        held.append(name)
    out.append(held)
    return [
        mix(sum(name * (mix(min(i, 63) + 1) | 1) for i, name in enumerate(phrase)) & WORD) for phrase in out
    ]


def plain_sketch(names):
    out = [0xFFFF] * 64
    for name in names:
        hashed = mix((name + 0x9E3779B97F4A7C15) & WORD)
        out[hashed >> 58] = min(out[hashed >> 58], (hashed >> 40) % 0xFFFF)
    return base64.b64encode(b"".join(v.to_bytes(2, "little") for v in out)).decode()


def plain_fingerprint(text):
    if not text:
        return ""
    levels = [[mix(ord(c) + 1) for c in text]]
    for _ in range(4):
        levels.append(plain_next_level(levels[-1]))
    top = max((n for n in range(1, 5) if len(levels[n]) >= 24), default=1)
    return ".".join([str(top), plain_sketch(levels[top]), plain_sketch(levels[top - 1])])


def test_parsing_by_a_second_version():
    rng = random.Random(11)
    texts = ["", "a", "aa", "ab", "aaaaab" * 30, "x" * 2000, "é中😀" * 40, "abc" * 100]
    texts += ["".join(rng.choice("abcd é中\n") for _ in range(rng.randrange(1, 900))) for _ in range(60)]
    texts += ["".join(rng.choice("ab") for _ in range(300)) for _ in range(10)]
    assert phrases.fingerprints(texts) == [plain_fingerprint(t) for t in texts]


def plain_comparisons(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    texts, out = [text or "" for _, text in rows], Counter()
    for i, (doc, _) in enumerate(rows):
        own, after = texts[i], texts[(i + 1) % len(rows)]
        n = len(own) // 4
        edit = own[: len(own) - n] + after[:n]
        prints = phrases.fingerprints([own, edit, after])
        near = [round(phrases.likeness(prints[0], p), 9) for p in prints[1:]]
        out[(doc, len(own), hashlib.sha256(edit.encode()).hexdigest(), prints[0], prints[1], *near)] += 1
    return out


def test_many_rows_of_one_id_are_cut_by_text(spark):
    """Two thirds have no id or share one; many of these rows are equal."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcé中") for _ in range(rng.randrange(60, 90)))
    some = ["", None, "x" * 100, *["same beginning " * 5 + word() for _ in range(20)], *[word() for _ in range(40)]]
    rows = [(None, rng.choice(some)) for _ in range(150)] + [(77, rng.choice(some)) for _ in range(150)]
    rows += [(i, word()) for i in range(60, 120)] + [(77, None)]
    frame = with_odd_columns(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    hot = phrases.hot_ids(frame, ties=10)
    assert (hot.ids, hot.nulls) == ([77], True) and hot.ties < 40
    found = phrases.with_next(frame, hot).withColumn("task", F.spark_partition_id()).collect()
    sizes = Counter(r.range for r in found)
    assert len(sizes) > 10 and max(sizes.values()) < 60 and len({(r.range, r.task) for r in found}) == len(sizes)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for ties in (10, 10**6):
        got = phrases.compare_with_edits(frame, ties=ties)
        assert got.columns == names
        assert Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got.collect()) == plain_comparisons(rows)


# risk and scores, one text at a time


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def plain_training(positives, unlabelled, prior, steps, rate, decay):
    """Weights by feature; both kinds of texts as lists of sets of features."""
    n, m = len(positives), len(unlabelled)
    used = {0}
    for f in set().union(*positives, *unlabelled):
        p, u = (sum(f in text for text in some) for some in (positives, unlabelled))
        share = (p + u + 1) / (n + m + 2)
        if abs(p / n - u / m) / math.sqrt(share * (1 - share) * (1 / n + 1 / m)) >= toxicity.LEAST_Z:
            used.add(f)
    weights, mean, square = ({f: 0.0 for f in used} for _ in range(3))
    weights[0] = -2.0
    turned = 0
    for step in range(1, steps + 1):
        margin = lambda text: sum(weights[f] for f in text if f in used)
        mp, mu = [margin(t) for t in positives], [margin(t) for t in unlabelled]
        clean = sum(math.log1p(math.exp(x)) for x in mu) / m - prior * sum(math.log1p(math.exp(x)) for x in mp) / n
        turned += clean < 0
        gradient = {f: decay * weights[f] / len(used) for f in used}
        for text, x in zip(positives, mp, strict=True):
            # of prior * loss(toxic) and of the part taken off the clean risk
            slope = -prior * sigmoid(-x) / n - prior * sigmoid(x) / n if clean >= 0 else prior * sigmoid(x) / n
            for f in text & used:
                gradient[f] += slope
        for text, x in zip(unlabelled, mu, strict=True):
            for f in text & used:
                gradient[f] += (1 if clean >= 0 else -1) * sigmoid(x) / m
        for f in used:
            mean[f] = 0.9 * mean[f] + 0.1 * gradient[f]
            square[f] = 0.99 * square[f] + 0.01 * gradient[f] ** 2
            weights[f] -= rate * (mean[f] / (1 - 0.9**step)) / (math.sqrt(square[f] / (1 - 0.99**step)) + 1e-8)
    return weights, turned


@pytest.mark.parametrize("prior", [0.05, 0.5])
def test_training_by_a_second_version(prior):
    rng = random.Random(2)
    some = lambda share: {0, *(f for f in range(1, 30) if rng.random() < (share if f < 6 else 0.2))}
    positives, unlabelled = [some(0.9) for _ in range(60)], [some(0.1) for _ in range(90)]
    sample = lambda texts: toxicity.Sample.of([np.array(sorted(t), np.uint32) for t in texts])
    got = toxicity.train(sample(positives), sample(unlabelled), prior, steps=120)
    want, turned = plain_training(positives, unlabelled, prior, 120, 0.05, 0.1)
    assert len(want) > 3 and 0 < turned < 120  # both branches of the risk are taken
    assert np.allclose([got[f] for f in want], list(want.values()), atol=1e-9)
    assert np.count_nonzero(got) <= len(want)


def plain_features(text):
    """The word features as the module states them, from the text's letters."""
    words = "".join(c if ord(c) >= 128 or "a" <= c <= "z" else " " for c in text.lower()).split(" ")
    found = {0}
    for word in filter(None, words):
        for part in {word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) >= n)}:
            found.add(1 + zlib.crc32(part.encode()) % (2**18 - 1))
    return found


def test_scores_by_a_second_version(spark):
    docs, labels = common.read(spark, FOLDER, "documents"), common.read(spark, FOLDER, "labels")
    weights = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    for row in docs.select("doc_id", "text").collect():
        margin = sum(float(weights[f]) for f in plain_features(row.text))
        assert got[row.doc_id] == pytest.approx(sigmoid(margin), abs=1e-9)


# keys that hold a third of the rows


def test_copies_of_a_row_are_spelled_out_by_many_tasks(spark):
    rows = spark.range(900).selectExpr("id % 3 = 0 AS hot", "id").selectExpr(
        "CASE WHEN NOT hot THEN id END AS doc_id", "CASE WHEN hot THEN '' ELSE 'text' END AS text"
    )
    rows = rows.unionByName(spark.range(300).selectExpr("CAST(NULL AS bigint) AS doc_id", "'' AS text"))
    out = sharding.assign_shards(rows, 8, chunk_rows=50, copies=40)
    slots = defaultdict(list)
    for r in out.collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == 1200
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = spark.createDataFrame([(7, 100, 1000)], "shard int, slot long, copies long")
    blocks = sharding._in_blocks(hot, 64).collect()
    assert max(r.copies for r in blocks) == 64 and len(blocks) == 16
    assert sorted(s for r in blocks for s in range(r.slot, r.slot + r.copies)) == list(range(100, 1100))


def test_tail_groups_meet_no_window(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "CAST(CASE WHEN id % 3 = 0 THEN 1 ELSE id % 400 END AS string) AS text")
    out = exact_dedup.exact_duplicates(rows, least_copies=10**9)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    groups = defaultdict(list)
    for i in range(3000):
        groups[str(1 if i % 3 == 0 else i % 400)].append(i)
    want = {i: (max(g), len(g)) for g in groups.values() for i in g}
    assert {r.doc_id: (r.keep_id, r.group_size) for r in out.collect()} == want


def test_rows_without_a_conversation_are_single_turns(spark, tmp_path):
    rows = [*TALKS, (None, 1, "user", "hi"), (None, 1, "user", "only"), (None, None, "user", "only"), (None, 2, None, None)]
    rows += [(9, 3, "user", "only"), (10, 0, "user", "alone")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = Counter((r.conv_id, r.n_turns, r.n_copies, r.rendered) for r in chat.format_conversations(frame).collect())
    unnamed = {k: n for k, n in got.items() if k[0] is None}
    # "hi" starts other conversations; of "only" the named conversation stays
    assert unnamed == {(None, 1, 1, "<|im_start|>\n<|im_end|>\n"): 1}
    assert got[(9, 1, 3, "<|im_start|>user\nonly<|im_end|>\n")] == 1
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    query, sql = catalog.op9_chat_format, catalog.ORACLES["op9_chat_format"]
    state, _, _, note = compare(spark, con, str(tmp_path), "op9_chat_format", query, sql)
    assert state == "ok", note


def test_token_files_are_read_by_path_alone(spark, tmp_path):
    path = str(tmp_path / "files")
    rows = spark.createDataFrame(AWKWARD, "doc_id long, text string").repartition(6)
    token_files.write_token_files(rows, path, JSON, 2)
    got = Counter((r.doc_id, bytes(r.ids)) for r in token_files.read_token_files(spark, path).collect())
    assert got == Counter((d, ids_by_library(t, 2).tobytes()) for d, t in AWKWARD)
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.select("part").distinct().count() > 1
    turned = blocks.withColumn("part", -F.col("part"))
    turned.write.parquet(f"{path}-turned/blocks")
    with pytest.raises(RuntimeError):
        token_files._check_parts(spark, f"{path}-turned")


# the pipeline


def test_pipeline_on_awkward_rows(spark):
    docs = with_odd_columns(spark.createDataFrame(AWKWARD, "doc_id long, text string").repartition(3)).cache()
    columns = docs.columns
    before = Counter((r.doc_id, r.text) for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns, name
        kept = Counter((r.doc_id, r.text) for r in docs.collect())
        assert kept and not kept - before
        assert all(r[2] == "other" for r in docs.select("doc_id", "text", F.col("`my.col`")).collect())
        before = kept
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    lengths = Counter()
    for r in pieces:
        lengths[r.doc_id] += r.length
    want = Counter()
    for (doc, text), n in before.items():
        want[doc] += n * len(ids_by_library(text, 1))
    assert lengths == want


def test_pipeline_on_an_empty_table(spark):
    docs = with_odd_columns(spark.createDataFrame([], "doc_id long, text string"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", *ODD] and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 0
