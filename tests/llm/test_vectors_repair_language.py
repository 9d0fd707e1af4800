"""Vector codes, conversation repair and languages, against plain versions."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contractlens.llm import common, langid, repair, vector_codes

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
CLASHING = "code error label_error whole part entry n my.col of seg place audit cost letter lang_pred mark".split()


def clashing(rows):
    for name in CLASHING:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit("other"))
    return rows


# vector codes


@settings(deadline=None, max_examples=200)
@given(st.integers(1, 12), st.integers(1, 200), st.sampled_from([7, 2**20, 2**26, 2**28]), st.randoms(use_true_random=False))
def test_products_are_exact(count, size, most, rng):
    a = [[rng.randint(-most, most) for _ in range(size)] for _ in range(count)]
    b = [[rng.choice([-most, most, rng.randint(-most, most)]) for _ in range(size)] for _ in range(3)]
    got = vector_codes.exact_products(np.array(a, np.int64), np.array(b, np.int64))
    for i, j in itertools.product(range(count), range(3)):
        true = sum(x * y for x, y in zip(a[i], b[j], strict=True))
        assert int(got[i, j]) == (true + 2**63) % 2**64 - 2**63


def test_limbs_keep_products_below_the_bound():
    for size in (1, 8, 64, 1000, 10**6):
        width = vector_codes.limb_width(size)
        assert size * (2**width) ** 2 <= 2**53
    values = np.array([-(2**40), -1, 0, 1, 2**40 - 1])
    parts = vector_codes.limbs(values, 9, 2**40)
    assert all(p.min() >= 0 and p.max() < 512 for p in parts[:-1]) and abs(parts[-1]).max() <= 512
    assert sum(p.astype(np.int64) << (9 * i) for i, p in enumerate(parts)).tolist() == values.tolist()


def plain_codes(rows, parts, entries, rounds):
    """rows: (id, integers), in the order in which codebooks start."""
    cut = lambda v: [tuple(v[i * len(v) // parts : (i + 1) * len(v) // parts]) for i in range(parts)]
    books = [list(column) for column in zip(*(cut(v) for _, v in rows[:entries]), strict=True)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda piece, book: min(range(len(book)), key=lambda e: (far(piece, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, v in rows:
                held[best(cut(v)[p], books[p])].append(cut(v)[p])
            for e, pieces in held.items():
                books[p][e] = tuple(sum(c) // len(pieces) for c in zip(*pieces, strict=True))
    out = []
    for name, v in rows:
        codes = [best(piece, books[p]) for p, piece in enumerate(cut(v))]
        out.append((name, bytes(codes).hex(), sum(far(cut(v)[p], books[p][c]) for p, c in enumerate(codes))))
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return out, hashlib.sha256(flat.encode()).hexdigest()


def test_vector_codes(spark):
    rng = random.Random(5)
    good = [[rng.choice([-0.5, 0.25, rng.uniform(-1, 1)]) for _ in range(6)] for _ in range(60)]
    rows = [(i * 7 % 61, v, rng.choice([1, 2, None])) for i, v in enumerate(good)]
    rows += [rows[3], rows[3], (None, good[5], 2), (None, good[8], None), (5000, [1e3, -1e3, 0.0, 1.0, 2.0, 3.0], 9)]
    bad = [
        (900, None, 1), (-9, [None, *good[0][1:]], 1), (-8, [float("nan"), *good[0][1:]], 1),
        (-7, [float("inf"), *good[0][1:]], 2), (-6, [0.0, float("-inf"), 0.0, 0.0, 0.0, 0.0], 2),
    ]
    other = [(-5, [0.5] * 4, 2), (-4, [], 3)]
    kind = "vec_id long, embedding array<float>, label int"
    frame = clashing(spark.createDataFrame([*rows, *bad, *other], kind).repartition(4))
    got = vector_codes.encode_vectors(frame, parts=3, entries=5, rounds=3).collect()
    whole = lambda v: [math.floor(4096 * float(np.float32(x))) for x in v]
    ordered = sorted(((i, whole(v)) for i, v, _ in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want, digest = plain_codes(ordered, 3, 5, 3)
    assert Counter((r.vec_id, r.code, r.error) for r in got) == Counter([*want, (-5, None, None), (-4, None, None)])
    assert {r.codebooks_sha256 for r in got} == {digest}
    totals = defaultdict(int)
    for r in got:
        totals[r.label] += r.error or 0
    assert all(r.label_error == (totals[r.label] if r.label != 3 else None) for r in got)
    nothing = vector_codes.encode_vectors(spark.createDataFrame(bad, kind))
    assert nothing.columns == got[0].__fields__ and nothing.count() == 0
    few = vector_codes.encode_vectors(spark.createDataFrame(rows[:2], kind), parts=3, entries=16)
    assert {(r.code, r.error) for r in few.collect()} == {("000000", 0), ("010101", 0)}
    with pytest.raises(ValueError):
        vector_codes.encode_vectors(frame, parts=4)
    with pytest.raises(ValueError):
        vector_codes.encode_vectors(spark.createDataFrame([(1, [1e30] * 8, 1)], kind))


# conversations

AFTER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def plain_repair(rows):
    """rows: (role, text) in order. Every state keeps its least (cost, audit, lines)."""
    seen, faults = set(), []
    for role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))

    def inserted(found):
        for _ in range(2):
            for q, follows in AFTER.items():
                after = "a" if q == "u" else "u"
                cost, audit, lines = found[after]
                line = "user:" if after == "u" else "assistant:"
                found[q] = min(found[q], (cost + 3, "I" + audit, [line, *lines]))
                del follows
        return found

    none = (math.inf, "", [])
    best = inserted({"": (0, "", []), "s": none, "u": none, "a": (0, "", [])})
    for (role, text), fault in reversed(list(zip(rows, faults, strict=True))):
        new, more = {}, 3 if fault == "truncated" else 0
        for q, follows in AFTER.items():
            cost, audit, lines = best[q]
            options = [(cost + 4, "D" + audit, lines)]
            if fault not in ("blank", "duplicate"):
                if role[:1] in follows:
                    cost, audit, lines = best[follows[role[:1]]]
                    options.append((cost + more, "K" + audit, [f"{role}:{text}", *lines]))
                after = "a" if q == "u" else "u"
                cost, audit, lines = best[after]
                word = "user" if after == "u" else "assistant"
                options.append((cost + 3 + more, "R" + audit, [f"{word}:{text}", *lines]))
            new[q] = min(options)
        best = inserted(new)
    cost, audit, lines = best[""]
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (*counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def plain_reports(rows):
    """conv_id -> report, lines of rows (conv_id, turn, role, text)."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, some in held.items():
        some.sort()
        turns = {t for known, t, _, _ in some if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        report, lines = plain_repair([r[2:] for r in some])
        out[conv] = ((gaps, *report), lines)
    return out


def random_turns(seed, count):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        conv = rng.choice([None, None, *range(60)])  # one conversation holds far more than others
        turn = rng.choice([None, *range(12)])
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "a", "s"])
        text = rng.choice(["Yes.", "No", "", " \n", None, "Is it?", "é", "Go! \t", "x" * rng.randrange(9)])
        rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("longest", [4096, 7, 1])
def test_repair(spark, longest):
    rows = random_turns(longest, 700)
    frame = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    ids = spark.createDataFrame([(i,) for i in (1, 1, 2, 777)], "conv_id long").union(frame.select("conv_id"))
    report = repair.repair_conversations(frame, ids, longest)
    got = {r.conv_id: tuple(r)[1:] for r in report.collect()}
    want = {conv: found for conv, (found, _) in plain_reports(rows).items()}
    assert got.pop(777) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want
    left = defaultdict(list)
    for r in sorted(repair.repaired_turns(frame, report).collect(), key=lambda r: r.place):
        left[r.conv_id].append((r.place, f"{r.role}:{r.text}"))
    lines = {conv: list(enumerate(lines)) for conv, (_, lines) in plain_reports(rows).items() if lines}
    assert dict(left) == lines


def test_long_conversations_are_cut(spark):
    """A third of all rows without a conv_id and a turn: no task holds more than a segment."""
    rows = [(None, None, "user", f"t{i}.") for i in range(300)] + [(None, 3, "user", "same")] * 100
    rows += [(i, t, "user" if t % 2 == 0 else "assistant", "Fine.") for i in range(200) for t in range(4)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    large = repair.described(frame.filter("conv_id is null"))
    segments = repair._segments(large, 50).collect()
    assert max(len(r.kinds) for r in segments) <= 50 and sum(len(r.kinds) for r in segments) == 400
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_conversations(frame, longest=50).collect()}
    assert got == {conv: found for conv, (found, _) in plain_reports(rows).items()}


def test_repair_of_nothing(spark):
    nothing = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_conversations(repair.damaged(nothing), nothing).count() == 0
    assert repair.repaired_turns(nothing, repair.repair_conversations(nothing)).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", "A. B! C?") for c in [None, *range(40)] for t in [None, 0, 1]]
    rows += [(1, 2, None, None), (2, 2, "s", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = Counter()
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if harm == 1 else "".join(c for c in text if harm != 2 or c not in ".!?")
        want[(conv, turn, "user" if harm == 4 else role, text)] += {0: 0, 3: 2}.get(harm, 1)
    assert Counter(map(tuple, repair.damaged(frame).collect())) == +want


@settings(deadline=None, max_examples=150)
@given(st.integers(1, 14), st.randoms(use_true_random=False))
def test_ranks_order_nodes_by_their_least_audits(count, rng):
    """On any graph without circles, also where one letter leads to several nodes."""
    arcs = [
        (a, rng.randint(1, 4), b) for a in range(count) for b in range(a + 1, count) for _ in range(2) if rng.random() < 0.3
    ]
    least = [""] * count
    for a in reversed(range(count)):
        ways = ["DIKR"[letter - 1] + least[b] for source, letter, b in arcs if source == a]
        least[a] = min(ways, default="")
    source, letter, target = (np.array([arc[i] for arc in arcs], np.int64) for i in range(3))
    nodes = repair.Nodes(np.zeros(1), np.zeros(count), source, letter, target)
    ranks = repair.audit_ranks(nodes)
    for a, b in itertools.combinations(range(count), 2):
        assert (least[a] < least[b]) == (ranks[a] < ranks[b])
    audits, ends = repair.least_audits(nodes, np.arange(count))
    assert audits == least and not set(ends.tolist()) & set(source.tolist())


# languages


def segmentations(word):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, held = [], word[0]
        for cut, letter in zip(cuts, word[1:], strict=True):
            if cut:
                parts.append(held)
                held = ""
            held += letter
        yield [*parts, held]


@pytest.fixture(scope="module")
def toy():
    pieces = langid.Pieces([langid.MARK + "a", "a", "ab", "b", "ba", langid.MARK + "ab", "c", "12", "x▁y"])
    rng = np.random.default_rng(3)
    return pieces, langid.probabilities(rng.random((len(pieces), 2)) * 9)


def test_all_segmentations_are_summed(toy):
    pieces, logs = toy
    number = lambda part: pieces.numbers.get(part, 0 if len(part) == 1 else -1)
    for word in ("a", "abab", "bac", "zab", "aabbab"):
        ways = [[number(p) for p in parts] for parts in segmentations(langid.MARK + word)]
        ways = [w for w in ways if -1 not in w]
        weights = np.array([np.exp(logs[w].sum(axis=0)) for w in ways])
        grid = langid._grid(pieces, [word, word])
        assert np.allclose(langid.forward(grid, logs)[-1], np.log(weights.sum(axis=0)))
        assert np.allclose(langid.backward(grid, logs)[0], np.log(weights.sum(axis=0)))
        assert np.allclose(langid.long_word(pieces, word, logs), np.log(weights.sum(axis=0)))
        uses = np.zeros(len(logs))
        for way, weight in zip(ways, weights[:, 0] / weights[:, 0].sum(), strict=True):
            for piece in way:
                uses[piece] += 3 * weight
        got = langid.expected_uses(pieces, [word], np.array([3]), logs[:, [0]])
        assert np.allclose(got, uses)


def test_words_of_any_length(toy, monkeypatch):
    pieces, logs = toy
    word = "ab" * 40 + "zc"
    whole = langid.forward(langid._grid(pieces, [word]), logs)[-1][0]
    for stretch in (1, 3, 10, 11, 1000):
        monkeypatch.setattr(langid, "STRETCH", stretch)
        assert np.allclose(langid.long_word(pieces, word, logs), whole)
    monkeypatch.setattr(langid, "PART", 5)
    text = "ab, Cab! 12 ½ x²y_é\n" * 3
    assert "".join(langid.parts_of(text)) == text
    assert [w for part in langid.parts_of(text) for w in langid.words_of(part)] == ["ab", "cab", "x", "y", "é"] * 3


def test_kept_words_give_the_same_scores(toy, monkeypatch):
    pieces, logs = toy
    model = langid.Model(list(pieces.numbers), ["one", "two"], logs, np.zeros(2))
    texts = ["ab ba", "", "c c c ab", "12 ..", "a" * 60 + " b"]
    first = langid.Scorer(model)
    monkeypatch.setattr(langid, "KEPT_WORDS", 1)
    monkeypatch.setattr(langid, "PART", 4)
    again = langid.Scorer(model)
    for _ in range(2):
        for one, two in zip(first.text_scores(texts), again.text_scores(texts), strict=True):
            assert np.allclose(one, two)
    assert first.text_scores(texts)[0] == [True, False, True, False, True]


def test_languages(spark):
    docs = common.read(spark, "/root/testdata/sf0.01", "documents")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.identify_languages(docs, VOCABULARY).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_documents_are_not_read(spark):
    docs = common.read(spark, FOLDER, "documents")
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    other = other.withColumn("source", F.lit("x"))
    one, two = (sorted(map(tuple, langid.identify_languages(d, VOCABULARY).collect())) for d in (docs, other))
    assert [r[:3] for r in one] == [r[:3] for r in two]
    assert np.allclose([r[3] for r in one], [r[3] for r in two])


def test_languages_of_awkward_rows(spark):
    learned = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 3 != 1)
    rows = [
        (0, "the house and the garden", "en"), (learned, "la maison et le jardin", "fr"),
        (learned, "la maison et le jardin", "fr"),
        (None, "the house", "en"), (None, "the house", "en"), (6, None, "fr"), (7, "", "en"), (8, "½ 12 _ ²", "fr"),
        (9, "le jardin " * 3000, None), (10, "The " + "x" * 50_000, "en"), (11, "中文", None), (13, "der", "only null text"),
        (14, None, "nn"),
    ]
    frame = clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    got = langid.identify_languages(frame, VOCABULARY).collect()
    assert len(got) == len(rows)
    found = defaultdict(set)
    for r in got:
        found[r.doc_id].add((r.lang_pred, r.held_out))
        assert r.lang_pred != "und" or r.score == 0
        assert (r.lang_pred == "und") == (r.doc_id in (6, 7, 8, 14))
    assert found[9] == {("fr", zlib.crc32(b"9") % 3 == 1)} and found[None] == {("en", False)}
    assert {p for p, _ in found[11]} <= {"en", "fr", "only null text"}
    assert langid.identify_languages(frame.limit(0), VOCABULARY).count() == 0
    untold = langid.identify_languages(frame.withColumn("lang", F.lit(None).cast("string")), VOCABULARY)
    assert {(r.lang_pred, r.score) for r in untold.collect()} == {("und", 0.0)}


def test_a_language_held_by_copies_is_cut_down(spark):
    rows = [(None, "one text", "en")] * 500 + [(i, f"text {i}", "fr") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = Counter(r.lang for r in langid.training_documents(frame, 50).collect())
    assert got == {"en": 1, "fr": 50}
