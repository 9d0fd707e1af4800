"""Small pieces of the text operators, against libraries and plain versions."""

import random
from array import array

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contractlens.llm import bpe, library_ids, near_dedup, packing, phrases, token_files, toxicity, warc

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = st.text(st.sampled_from("ab c\n\t\r'st.,é中😀1\x1c\x85 "), max_size=60) | st.text(max_size=60)


@pytest.fixture(scope="module")
def byte_encoder():
    with open(RANKS, "rb") as file:
        ranks = bpe.ranks_of(file.read())
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return bpe.text_ids(ranks, public_tokenizers.PATTERN), library


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_byte_bpe_equals_the_library(byte_encoder, text):
    own, library = byte_encoder
    ids = array("I", own.encode(text)).tolist()
    assert ids == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 4000, "ab" * 2000, " " * 999, "中文" * 1500, "x\n" * 500, " a  b   c \n "])
def test_byte_bpe_long_pieces(byte_encoder, text):
    own, library = byte_encoder
    assert array("I", own.encode(text)).tolist() == library.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_library_ids_by_piece(text):
    with open(JSON, encoding="utf-8") as file:
        encode = library_ids.text_encoder("test", file.read())
    library = Tokenizer.from_file(JSON)
    assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize(
    "text",
    ["a<|endoftext|>b", "<|endoftext|>", "it 's <|endoftext|> <|endoftext|>\n x", "中<|endoftext|>é", "<|endoftext |>", "<|startoftext|>a"],
)
def test_added_tokens_have_their_ids(name, text):
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        encode = library_ids.text_encoder(name, file.read())
    library = Tokenizer.from_file(public_tokenizers.path(name))
    assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_go_through_the_library():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encode = library_ids.text_encoder("words", file.read())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = "Two Words, and \n more  of them"
    assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_memo_keeps_two_generations():
    made = []
    memo = bpe.Memo(lambda key: made.append(key) or key.upper(), limit=2, longest=3)
    assert [memo[k] for k in ("a", "b", "c", "a", "long", "long")] == ["A", "B", "C", "A", "LONG", "LONG"]
    assert made == ["a", "b", "c", "long", "long"]


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_packed_integers_come_back(values):
    control, data = token_files.pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert token_files.unpack(control, data, len(values)).tolist() == values


@given(st.lists(st.integers(0, 70_000), max_size=20))
def test_stored_ids_come_back(ids):
    assert token_files.widen(token_files.narrow(np.array(ids, "<u4"))).tolist() == ids


@settings(deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=80))
def test_windows_are_full(lengths):
    pool = packing.Pool()
    for doc, length in enumerate(lengths):
        pool.add((doc, 0, length))
    windows, left = packing.pack_pool(pool, packing.TIERS)
    windows += packing.closing_windows(left, 2048)
    seen = {doc: [] for doc in range(len(lengths))}
    for size, pieces in windows:
        assert size & (size - 1) == 0 and sum(p[2] for p in pieces) == size
        for doc, start, length in pieces:
            seen[doc] += range(start, start + length)
    assert all(sorted(seen[d]) == list(range(n)) for d, n in enumerate(lengths))


def test_step_groups_are_even():
    windows = [(256, [(0, 0, n), (1, 0, 256 - n)]) for n in range(1, 129)]
    groups = packing.step_groups(windows, 256 * 32)
    costs = [sum(p[2] ** 2 for w, g in zip(windows, groups, strict=True) if g == k for p in w[1]) for k in range(4)]
    assert sorted(set(groups)) == [0, 1, 2, 3] and [groups.count(k) for k in range(4)] == [32] * 4
    assert max(costs) < 1.05 * min(costs)


def stream(records, cut=warc.END + warc.VERSION):
    return b"".join(r + warc.END for r in records).split(cut)


@pytest.mark.parametrize(
    "payload", [b"", b"\r\n\r\n", b"x\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\n\r\n", b"\xff\x00", b"\r\n\r\nWARC/1.1\r\n" * 3]
)
def test_records_stream_back(payload):
    records = warc.capture_records(1, "http://a/\r\nb", payload, None, "2020-01-01T00:00:00Z")
    files = stream(records) + stream(records)  # one file after the other
    found = list(warc.stream_records(iter(files)))
    assert len(found) == 6
    assert [f["warc-type"] for f, _ in found[:3]] == ["request", "response", "metadata"]
    assert warc.http_payload(found[1][1]) == payload
    assert found[0][0]["warc-concurrent-to"] == found[1][0]["warc-record-id"] == found[5][0]["warc-concurrent-to"]


def test_cut_off_archive_is_an_error():
    records = warc.capture_records(1, "u", b"payload", None, "2020-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        list(warc.stream_records(iter([b"".join(records)[:-20]])))


def plain_shingles(text, words):
    found = text.encode().lower().split()
    if not found:
        return set()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


@given(st.text(st.sampled_from("aAbBéÉ \t\n\x0b\x0c\x85"), max_size=60), st.integers(1, 5))
def test_shingle_counts(text, words):
    assert len(near_dedup.shingles(text, words)) == len(plain_shingles(text, words))


def test_sketch_estimates_similarity():
    random = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.9, 0.97):
        found = []
        for _ in range(60):
            both = random.integers(0, 2**63, 1000).astype(np.uint64)
            n = int(1000 * share)
            rest = (1000 - n) // 2
            one, two = (near_dedup.minhashes(x) for x in (both[: n + rest], np.concatenate([both[:n], both[n + rest :]])))
            bits = np.bitwise_count((near_dedup.odd_sketch(one) ^ near_dedup.odd_sketch(two)).view(np.uint64)).sum()
            found.append(near_dedup.estimated_similarity(int(bits)))
            if share >= 0.8:
                assert bits <= near_dedup.distance_limit(0.8)
                assert (near_dedup.band_keys(one) == near_dedup.band_keys(two)).any()
        assert abs(np.mean(found) - n / (n + 2 * rest)) < 0.03


def text_of(words, n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(words) for _ in range(n))


WORDS = [text_of("abcdefghij", 4, i).replace(" ", "") for i in range(300)]


def test_fingerprints_don_t_depend_on_the_batch():
    texts = [text_of(WORDS, n, n) for n in (1, 2, 5, 40, 400, 3000)] + ["", "a", "aaaa", "é中😀" * 9, "ab" * 500]
    together = phrases.fingerprints(texts)
    assert together == [phrases.fingerprints([t])[0] for t in texts]
    assert together[6] == "" and phrases.likeness("", "") == 1 and phrases.likeness("", together[0]) == 0


def test_equal_substrings_share_phrases():
    text = text_of(WORDS, 800, 5)
    moved = text_of(WORDS, 13, 6) + text + text_of(WORDS, 7, 7)
    other = text_of(WORDS, 800, 8)
    own, shifted, far = phrases.fingerprints([text, moved, other])
    assert phrases.likeness(own, shifted) > 0.85
    assert phrases.likeness(own, far) < 0.1
    half = phrases.fingerprints([text[: len(text) // 2] + other[len(text) // 2 :]])[0]
    assert 0.15 < phrases.likeness(own, half) < 0.55


def test_neighbouring_labels_differ():
    names = phrases.mix(np.arange(5000, dtype=np.uint64) % np.uint64(97))
    starts = np.array([0, 1, 2, 777])
    label = phrases.labels(names, starts)
    inside = np.setdiff1d(np.arange(1, 5000), starts)
    assert label.max() < 6 and (label[inside] != label[inside - 1]).all()


def test_learning_needs_positives_and_corrects_the_prior():
    rng = np.random.default_rng(3)
    noise = lambda: rng.integers(1000, 200_000, 30).astype(np.uint32)
    toxic = lambda: np.append(noise(), [0, 7, 8]).astype(np.uint32)
    clean = lambda: np.append(noise(), [0]).astype(np.uint32)
    positives = toxicity.Sample.of([toxic() for _ in range(200)])
    unlabelled = toxicity.Sample.of([toxic() if i % 5 == 0 else clean() for i in range(1000)])
    weights = toxicity.train(positives, unlabelled, 0.2)
    fresh = toxicity.Sample.of([toxic() for _ in range(50)] + [clean() for _ in range(50)])
    assert ((toxicity.margins(weights, fresh) >= 0) == ([True] * 50 + [False] * 50)).all()
    empty = toxicity.Sample.of([])
    assert (toxicity.margins(toxicity.train(empty, unlabelled, 0.2), fresh) < 0).all()
