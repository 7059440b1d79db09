"""Parts of the operators that need no Spark: hashes, encoders, merges, automata."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import (
    anchors,
    arrays,
    bpe,
    embedding_dedup,
    jaccard_join,
    language,
    suffix_runs,
    warc,
)
from millrace.llm.frames import place_of, share_of
from millrace.llm.language import Lattice, _tails
from millrace.llm.quality import FACTORS, Features, Machine
from millrace.llm.substring_dedup import SuffixAutomaton

RANKS = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
ENCODER = bpe.Encoder(RANKS)
TIKTOKEN = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=80), st.text(alphabet="ab e", max_size=200).map(str.encode)))
def test_tree_reduction_equals_tiktoken(piece):
    ids = ENCODER.encode(piece)
    assert list(ids) == (TIKTOKEN._core_bpe.encode_single_piece(piece) if piece else [])
    assert ENCODER.decode(ids) == piece


def test_tokens_cut_anywhere_join_alike():
    rng = random.Random(2)
    tokens = list(RANKS)
    for _ in range(300):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randint(2, 8)))
        cut = rng.randint(0, len(piece))
        joined = ENCODER.join(ENCODER.encode(piece[:cut]), ENCODER.encode(piece[cut:]))
        assert list(joined) == TIKTOKEN._core_bpe.encode_single_piece(piece)


@pytest.mark.parametrize("piece", [b"a" * 20_000, b" " * 3000, b"=-" * 2000, b"\xff" * 999])
def test_long_pieces(piece):
    assert list(ENCODER.encode(piece)) == TIKTOKEN._core_bpe.encode_single_piece(piece)


def test_equal_runs_hash_alike_wherever_they_are():
    data = np.frombuffer(b"xyzabcabcxyz--abc", dtype=np.uint8)
    hashes = arrays.Hashes.of_bytes(data).runs(np.array([3, 6, 14, 0]), np.array([6, 9, 17, 3]))
    assert hashes[0] == hashes[1] == hashes[2] != hashes[3]


def test_words_end_with_their_text():
    chunk = next(arrays.chunks(pa.array(["a b", None, "", " cé ", "d"])))
    found = arrays.words(chunk, arrays.SPACED)
    texts = [found.of(chunk, i) for i in range(5)]
    assert texts == [[b"a", b"b"], [], [], ["cé".encode()], [b"d"]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), min_size=1, max_size=4))
def test_equal_windows_have_their_anchors_at_equal_places(texts):
    chunk = next(arrays.chunks(pa.array(texts)))
    hashes = arrays.Hashes.of_bytes(chunk.data)
    found = anchors.find(hashes, chunk.starts, chunk.ends, 8, 3)
    places: dict[bytes, set] = {}
    for i in range(len(texts)):
        at = {int(a - chunk.starts[i]) for a, t in zip(found.at, found.text) if t == i}
        text = chunk.text(i)
        for start in range(len(text) - 7):
            window = text[start : start + 8]
            least = min(hashes.grams(3)[chunk.starts[i] + start : chunk.starts[i] + start + 6])
            here = {
                p for p in range(6) if hashes.grams(3)[chunk.starts[i] + start + p] == least
            }
            assert here <= {a - start for a in at}
            assert places.setdefault(window, here) == here


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=12).map(lambda b: b[:3] * 3 + b), max_size=12), max_size=7))
def test_merge_equals_sort(runs):
    coded = []
    for number, run in enumerate(runs):
        run = sorted(run)
        coded.append(
            suffix_runs.decode_run((s, r, number) for s, r in suffix_runs.front_code(run))
        )
    merged = list(suffix_runs.merge(coded))
    assert [entry[0] for entry in merged] == sorted(x for run in runs for x in run)
    for before, after in zip(merged, merged[1:]):
        assert after[1] == suffix_runs.common(before[0], after[0], 0)


def test_merge_never_compares_known_prefixes(monkeypatch):
    """Each byte of a string is looked at about once over the whole merge."""
    looked = []
    plain = suffix_runs.common

    def counted(a, b, start):
        found = plain(a, b, start)
        looked.append(found - start + 1)
        return found

    runs = [sorted(b"p" * 500 + bytes([i, j]) for j in range(40)) for i in range(8)]
    coded = [
        suffix_runs.decode_run([(s, r, None) for s, r in suffix_runs.front_code(run)])
        for run in runs
    ]
    monkeypatch.setattr(suffix_runs, "common", counted)
    assert len(list(suffix_runs.merge(coded))) == 320
    # Comparing whole strings each time would look at 320 * 3 * 500 bytes.
    assert sum(looked) < 10_000


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.text(alphabet="ab", max_size=20), max_size=4), st.text(alphabet="abc", max_size=20)
)
def test_matching_statistics_equal_brute_force(reference, text):
    automaton = SuffixAutomaton()
    for sequence in reference:
        automaton.add(sequence)
    for end, length in enumerate(automaton.matching(text), 1):
        longest = max(n for n in range(end + 1) if any(text[end - n : end] in r for r in [*reference, ""]) )
        assert length == longest


def test_forward_sums_all_segmentations():
    pieces = ["a", "ab", "b", "▁", "▁a"]
    index = {piece: i for i, piece in enumerate(pieces)}
    probability = np.array([0.1, 0.2, 0.3, 0.15, 0.2, 0.05])

    def total(text):
        if not text:
            return 1.0
        parts = [(p, probability[i]) for p, i in index.items() if text.startswith(p)]
        if text[0] not in index:
            parts.append((text[0], probability[-1]))
        return sum(p * total(text[len(piece) :]) for piece, p in parts)

    words = ["ab", "abab", "b", "axb"]
    lattice = Lattice(words, _tails(pieces), len(pieces), 2)
    found = lattice.total(lattice.forward(probability))
    assert np.allclose(found, [total("▁" + word) for word in words])
    # Expected counts add up to the expected number of pieces, found by derivatives.
    counts = lattice.expected(probability, np.ones(len(words)))
    for i in range(len(probability)):
        more = probability.copy()
        more[i] *= 1 + 1e-6
        slope = (np.log(lattice.total(lattice.forward(more))) - np.log(found)).sum() / 1e-6
        assert abs(counts[i] - slope) < 1e-3


def test_machine_sums_pairs_in_linear_time():
    machine = Machine()
    rng = np.random.default_rng(1)
    machine.factors = rng.normal(size=machine.factors.shape)
    machine.linear = rng.normal(size=machine.linear.shape)
    features = Features(next(arrays.chunks(pa.array(["one two two three", "", "Four!"]))))
    text, feature, value = machine.rows(features)
    logits, _ = machine.sums(text, feature, value, 3)
    for i in range(3):
        f, x = feature[text == i], value[text == i]
        pairs = sum(
            machine.factors[f[a]] @ machine.factors[f[b]] * x[a] * x[b]
            for a in range(len(f))
            for b in range(a)
        )
        assert np.isclose(logits[i], machine.bias + machine.linear[f] @ x + pairs)
    assert machine.factors.shape[1] == FACTORS


@pytest.mark.parametrize("refers_to", [None, 7])
@pytest.mark.parametrize("payload", [b"", b"a\r\n\r\nb", b"x" * 5000])
def test_record_round_trip(payload, refers_to):
    found = warc.parse_record(warc.record(3, "http://a/\r\nX: y", payload, refers_to))
    assert (found["id"], found["payload_bytes"], found["refers_to"]) == (3, len(payload), refers_to)
    assert found["payload"] == (payload if refers_to is None else None)
    assert "\n" not in found["uri"]


def test_damaged_records_are_refused():
    content = warc.record(3, "u", b"payload", None)
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(content.replace(b"payload", b"Payload"))


@pytest.mark.parametrize("size", [1000, 65_535, 65_536, 2_500_000])
def test_room_is_never_less_than_what_sets_share(size):
    rng = np.random.default_rng(5)
    grams = np.unique(rng.integers(0, 2**64, size + size // 50, dtype=np.uint64))
    sets = grams[:size], grams[-size:]
    a, b = (
        np.frombuffer(jaccard_join._parts(x), dtype=np.uint16).reshape(1, -1) for x in sets
    )
    both = len(np.intersect1d(*sets, assume_unique=True))
    assert 180 * both >= 80 * 2 * size
    for x, y in ((a, b), (b, a), (a, a)):
        assert jaccard_join._room(x, y)[0] >= both


def test_copies_send_their_prefix_once(monkeypatch):
    monkeypatch.setattr(jaccard_join, "PREFIX_ROWS", 50)
    copy = " ".join(f"w{i}" for i in range(104))
    texts = [copy, "", copy.upper(), None, "one two", *[copy] * 300, "three four"]
    batches = [pa.RecordBatch.from_pydict({"text": texts[at : at + 40]}) for at in range(0, 306, 40)]
    frequency = np.zeros(jaccard_join.DF_SLOTS, dtype=np.int64)
    sent = [
        np.frombuffer(x.as_py(), dtype=jaccard_join._PREFIX)
        for batch in jaccard_join._prefixes(iter(batches), frequency, 3, 5, 80)
        for x in batch.column("entries")
    ]
    entries = np.concatenate(sent)
    assert len(entries) == jaccard_join.prefix_length(100, 80) + 2
    assert len(np.unique(entries[["gram", "k"]])) == len(entries)
    assert sorted(np.unique(entries["n"])) == [1, 100]


def test_shares_of_very_many_rows():
    """However many rows there are, some are taken, about as many as asked for."""
    for n in (10, 399, 10**6, 5 * 10**8, 10**13):
        taken = n * share_of(400, n) / 10**18
        assert abs(taken - min(n, 400)) <= 0.01 * min(n, 400)
    assert share_of(400, 0) == 10**18


def test_places_are_even(spark):
    places = spark.range(20_000).select((place_of(F.col("id"), 23) / 10**18).alias("p"))
    found = [row["p"] for row in places.collect()]
    assert min(found) >= 0 and max(found) < 1 and len(set(found)) == 20_000
    assert abs(sum(x < 0.25 for x in found) - 5000) < 300


def test_a_language_among_very_many_rows_is_learnt(spark, monkeypatch):
    """The sizes that ``fit`` sees are a hundred million times those of the table."""
    rows = [(i, "de", f"der hund und die katze {i}") for i in range(300)]
    rows += [(i, "en", f"the dog and the cat {i}") for i in range(300, 600)]
    docs = spark.createDataFrame(rows, "id bigint, lang string, text string")
    true = language.share_of
    monkeypatch.setattr(language, "share_of", lambda sample, n: true(sample * 10**8, n * 10**8))
    model = language.fit(docs, "id", "text", "lang", sample=100)
    assert model.languages == ["de", "en"]
    found = language.identify(docs, "text", model).filter("lang = lang_pred").count()
    assert found == 600


def test_language_scores_equal_enumeration(spark):
    """Every segmentation of every word written out, for a fitted model."""
    rows = [(i, "de", "der hund und katze") for i in range(6)]
    rows += [(i, "es", "el perro y gato") for i in range(6, 12)]
    docs = spark.createDataFrame(rows, "id bigint, lang string, text string")
    model = language.fit(docs, "id", "text", "lang")
    known = {piece: model.table[i] for i, piece in enumerate(model.vocabulary)}
    unknown = model.table[len(model.vocabulary)]

    def cuts(text):
        if not text:
            yield np.ones(len(model.languages))
        for end in range(1, len(text) + 1):
            piece = known.get(text[:end], unknown if end == 1 else None)
            if piece is not None:
                for rest in cuts(text[end:]):
                    yield piece * rest

    texts = ["der perro", "gato", "Hund", "xyz ñ", "y", None, "12 .", "und el"]
    asked = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    found = {r["id"]: r for r in language.identify(asked, "text", model).collect()}
    for i, text in enumerate(texts):
        row = found[i]
        if not text or not any(map(str.isalpha, text)):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        logs = sum(np.log(sum(cuts("▁" + word))) for word in text.lower().split())
        share = np.exp(logs - logs.max())
        assert row["lang_pred"] == model.languages[int(logs.argmax())]
        assert abs(row["score"] - share.max() / share.sum()) < 1e-9


def test_bpe_remembers_little(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 60)
    monkeypatch.setattr(bpe, "MAX_PARTS", 20)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 20)
    bpe._pieces.cache_clear()
    pieces = bpe._pieces(public_tokenizers.path(bpe.RANKS))
    words = [f" wörd{i} and{i * 7}" for i in range(500)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(500)), "text": words})
    whole = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pieces.encoder.ranks, special_tokens={}
    )
    for done in bpe._encode_batches(iter([batch]), public_tokenizers.path(bpe.RANKS), True):
        assert len(pieces) <= 30 and len(pieces.older) <= 30
        assert len(pieces.encoder.parts) <= 21 and len(pieces.encoder.stable) <= 21
        for doc, ids in zip(done.column("doc").to_pylist(), done.column("ids").to_pylist()):
            assert ids == whole.encode_ordinary(words[doc])


@pytest.mark.parametrize("n", [2_000, 20_000, 100_000, 400_000])
def test_probes_find_similar_vectors_however_many_lists(n):
    """Vectors without any clusters, the hardest: those of cosine 0.93 to 0.96 lie in lists
    that one of the two looks into."""
    rng = np.random.default_rng(n)
    unit = embedding_dedup._unit
    lists = int(2 * n**0.5) + 1
    known = embedding_dedup.Quantiser(unit(rng.normal(size=(min(n, 20_000), 64))), lists)
    v = unit(rng.normal(size=(4000, 64)))
    other = rng.normal(size=v.shape)
    other = unit(other - (other * v).sum(axis=1, keepdims=True) * v)
    cosine = rng.uniform(0.93, 0.96, size=(len(v), 1))
    u = cosine * v + np.sqrt(1 - cosine**2) * other

    def looked_into(vectors):
        probes, counts = known.probes(vectors, embedding_dedup._reach(0.93))
        return np.split(probes, np.cumsum(counts)[:-1])

    of_v, of_u = looked_into(v), looked_into(u)
    homes = embedding_dedup._nearest(v, known.centroids, 1)[:, 0]
    assert [p[0] for p in of_v] == homes.tolist()
    assert all(len(set(p)) == len(p) >= 8 for p in of_v)
    found = [a[0] in b or b[0] in a for a, b in zip(of_v, of_u)]
    assert np.mean(found) >= 0.999
    # Of 1,265 lists at most.
    assert np.mean([len(p) for p in of_v]) <= 40
