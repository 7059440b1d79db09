"""Token files, collocations and vector codes: against the tokenizer itself, brute force,
SQL and odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import TESTDATA
from millrace.llm.arrays import chunks
from millrace.llm import collocations, rans, token_files, vector_codes
from millrace.llm.queries import QUERIES

# --- range coding -------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=200), max_size=5), st.integers(1, 5))
def test_blocks_round_trip(blocks, power):
    blocks = [np.array(block, np.uint32) ** np.uint32(power % 3 + 1) for block in blocks]
    counts = Counter(int(x) for block in blocks for x in block)
    table = rans.Table.from_bytes(rans.Table.of_counts(counts).to_bytes())
    coded = table.encode(blocks) if counts else []
    blocks = blocks if counts else []
    decoded = table.decode(coded, [len(block) for block in blocks])
    assert [x.tolist() for x in decoded] == [x.tolist() for x in blocks]
    for i, one in enumerate(coded):
        assert table.decode([one], [len(blocks[i])])[0].tolist() == blocks[i].tolist()


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(5)
    data = (rng.zipf(1.4, 200_000) % 40_000).astype(np.uint32)
    counts = Counter(data.tolist())
    table = rans.Table.of_counts(counts)
    bits = 32 * sum(len(words) for _, words in table.encode([data]))
    entropy = -sum(n * math.log2(n / len(data)) for n in counts.values())
    assert bits < 1.02 * entropy


def test_damage_is_noticed():
    data = np.arange(5000, dtype=np.uint32) % 77
    table = rans.Table.of_counts(Counter(data.tolist()))
    [(states, words)] = table.encode([data])
    words = words.copy()
    words[len(words) // 2] ^= 1 << 13
    try:
        [decoded] = table.decode([(states, words)], [len(data)])
    except rans.Damaged:
        return
    assert decoded.tolist() != data.tolist()


# --- token files --------------------------------------------------------------

PATH = public_tokenizers.path(token_files.TOKENIZER)
TEXTS = [
    (5, "The quick brown fox's jumps, 123 times! \t\n\n over"),
    (5, "another of the same id"),
    (5, "another of the same id"),
    (None, "no id"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (-4, "Ärgeŕ   \x1c\x1d \x85 ΣΑΣ ́x é 日本語 🙂🙂 İstanbul ǅ"),
    (2**62, "far away " * 3000),
    (9, "x" * 5000),
    (10, '" " \'s don\'t "a" ""'),
    (11, "<|endoftext|> is text here? �"),
]


ENCODER = token_files.WordEncoder(PATH)
WHOLE = Tokenizer.from_file(PATH)
WHOLE.encode_special_tokens = True


def expected_tokens(rows):
    return [
        (doc, [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1])
        for doc, text in rows
    ]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("sizes", [{}, {"shard_ids": 700, "block_ids": 64}, {"block_ids": 1}])
def test_token_files_of_odd_rows(spark, monkeypatch, sizes):
    monkeypatch.setattr(token_files, "LEAST_SHARD_IDS", 500)
    rows = [(doc, text, "e", 1, "i") for doc, text in TEXTS]
    docs = spark.createDataFrame(rows, "ID bigint, text string, end string, Start int, ids string")
    folder = token_files.token_folder(spark)
    manifest = token_files.write_tokens(docs, "ID", "text", folder, **sizes)
    found = token_files.read_tokens(manifest, folder, with_ids=True).orderBy("start").collect()
    expected = expected_tokens(TEXTS)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r["id"], list(r["ids"])) for r in found), key=key) == sorted(expected, key=key)
    before = 0
    for row in found:
        assert (row["start"], row["n_tokens"]) == (before, len(row["ids"]))
        assert row["ids_crc32"] == crc(row["ids"])
        before += row["n_tokens"]
    ids = [(row["id"] is not None, row["id"] or 0) for row in found]
    assert ids == sorted(ids)


def test_token_files_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    folder = token_files.token_folder(spark)
    manifest = token_files.write_tokens(docs, "doc_id", "text", folder)
    assert manifest.count() == 0
    assert token_files.read_tokens(manifest, folder).count() == 0


def test_token_files_of_bytes_that_are_no_text(spark):
    docs = spark.sql("select 1L as doc_id, cast(unhex('61FF62') as string) as text")
    folder = token_files.token_folder(spark)
    manifest = token_files.write_tokens(docs, "doc_id", "text", folder)
    [row] = token_files.read_tokens(manifest, folder, with_ids=True).collect()
    assert (1, list(row["ids"])) == expected_tokens([(1, "a�b")])[0]


def test_token_files_with_one_hot_id(spark, monkeypatch):
    """Equal rows are spread over files, and damaged files are refused."""
    monkeypatch.setattr(token_files, "LEAST_SHARD_IDS", 2000)
    docs = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.lit("some words of all").alias("text"),
    )
    folder = token_files.token_folder(spark)
    manifest = token_files.write_tokens(docs, "doc_id", "text", folder)
    sizes = [row["n_docs"] for row in manifest.collect()]
    assert sum(sizes) == 4000 and max(sizes) < 4000 / 6
    rows = token_files.read_tokens(manifest, folder).orderBy("start").collect()
    assert [row["start"] for row in rows] == [5 * i for i in range(4000)]
    fs, path = pafs.LocalFileSystem(), folder.removeprefix("file://")
    name = f"{path}/{manifest.first()['file']}"
    with fs.open_input_stream(name) as source:
        content = bytearray(source.read())
    content[len(content) // 3] ^= 255
    with fs.open_output_stream(name) as out:
        out.write(bytes(content))
    with pytest.raises(Exception, match="damaged"):
        token_files.read_tokens(manifest, folder).collect()


def encode(encoder, texts):
    [chunk] = chunks(pa.array([text.encode() for text in texts]))
    return [ids.tolist() for ids in encoder.encode(chunk)]


def test_words_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "WORDS_KEPT", 100)
    encoder = token_files.WordEncoder(PATH)
    tokenizer = Tokenizer.from_file(PATH)
    for i in range(500):
        text = f"word{i} common {'long' * i}"
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert encode(encoder, [text]) == [expected]
        assert len(encoder) <= 50 and len(encoder.older) <= 60
        assert max(map(len, [b"", *encoder, *encoder.older])) <= token_files.LONGEST_KEPT


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab sStT'RrvVmMlLdD.,(12\n\té\u0301ÀßÿİΣǅ日×÷…\x1c\x85\xa0ªº"), st.characters(codec="utf-8")), max_size=40))
def test_pieces_are_encoded_as_the_whole(text):
    texts = [text, "a" + text, text + "é", text]
    assert encode(ENCODER, texts) == [ids[:-1] for _, ids in expected_tokens(enumerate(texts))]


def test_op11_equals_the_tokenizer(spark):
    sf_dir = f"{TESTDATA}/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected, before = [], 0
    for doc, ids in expected_tokens(sorted(map(tuple, docs))):
        expected.append((doc, before, len(ids), crc(ids)))
        before += len(ids)
    found = QUERIES["op11_token_files"](spark, sf_dir)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect())) == expected


# --- collocations -------------------------------------------------------------


def brute_collocations(rows, longest=3, least=10, inside=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", (text or "").encode().translate(lower)):
            words = re.findall(rb"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        found = []
        for words, a in candidates.items():
            if any(
                len(other) > len(words)
                and 100 * b >= inside * a
                and any(other[i : i + len(words)] == words for i in range(len(other)))
                for other, b in candidates.items()
            ):
                continue
            cuts = [(f[words[:k]], f[words[k:]], k) for k in range(1, len(words))]
            score, _, left, right = min(
                (10**6 * a * a // (x * y), k, x, y) for x, y, k in cuts
            )
            found.append((-score, -a, b" ".join(words), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


COLUMNS = ["grp", "rank", "phrase", "a", "l", "r", "n", "score"]


def phrases_of(spark, rows, **options):
    docs = spark.createDataFrame(
        [(lang, text, "x", 1) for lang, text in rows],
        "Lang string, text string, phrase string, GRP int",
    )
    found = collocations.collocations(docs, "text", "Lang", **options)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()))


def some_rows():
    rng = np.random.default_rng(3)
    known = ["a", "b", "the", "of", "New", "york", "wörd", "日本", "x y", "-"]
    texts = []
    for i in range(120):
        words = rng.choice(known, rng.integers(0, 60)).tolist()
        words[3:3] = ["new", "York", "City"] if i % 2 else ["in", "spite", "of", "all"]
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", ",", "\n"], p=[0.6, 0.1, 0.1, 0.1, 0.05, 0.05]) for w in words)
        texts.append((["en", None, "und", "fr"][i % 4], text))
    return [*texts, ("en", None), (None, ""), ("en", " \t . "), ("fr", "ab " * 400), ("fr", "ab " * 400), ("en", "z" * 9000)]


@pytest.mark.parametrize("trigger", [1, 3, 1000])
def test_phrases_equal_brute_force(spark, trigger):
    rows = some_rows()
    assert phrases_of(spark, rows, trigger=trigger) == brute_collocations(rows)


@pytest.mark.parametrize("longest", [2, 4])
def test_phrases_of_other_lengths(spark, longest):
    rows = some_rows()
    options = dict(longest=longest, least=6, inside=80, top=15)
    assert phrases_of(spark, rows, **options) == brute_collocations(rows, **options)


def test_phrases_in_small_steps(spark, monkeypatch):
    """Flushes of few phrases, and a table of bits that is far too small."""
    monkeypatch.setattr(collocations, "_PHRASES", 50)
    monkeypatch.setattr(collocations, "_BLOCK", 40)
    monkeypatch.setattr(collocations, "_MAX_BITS", 64)
    rows = some_rows()
    assert phrases_of(spark, rows) == brute_collocations(rows)


def test_no_phrases(spark):
    assert phrases_of(spark, []) == []
    assert phrases_of(spark, [("en", None), (None, ""), ("en", " .")]) == []


def test_bytes_that_are_no_text_are_counted(spark):
    docs = spark.sql(
        "select cast(unhex('61FF62206364') as string) as text, 'en' as lang from range(12)"
    )
    [row] = collocations.collocations(docs, "text", "lang").select(F.hex("phrase"), "a").collect()
    assert tuple(row) == ("61FF62206364", 12)


def test_equal_passages_are_cut_alike(spark):
    passage = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame([(f"p{i} q{i} {passage} r{i} s{i}", "en") for i in range(50)], "text string, lang string")
    dictionary = collocations.parse(docs, "text", "lang")
    counts = Counter(row["n"] for row in dictionary.collect())
    # All of the passage but its edges is in the dictionary once.
    assert counts[50] > 30 and sum(n for k, n in counts.items() if k < 50) <= 50 * 4


def test_scores_are_exact_for_large_counts(spark):
    numbers = [(10**15 - 7, 10**15 - 3, 10**15 - 1), (3 * 10**14 + 1, 10**15, 7 * 10**14), (10, 11, 13)]
    rows = [(a, left, right) for a, left, right in numbers]
    df = spark.createDataFrame(rows, "a bigint, l bigint, r bigint")
    found = df.select(collocations.score().alias("s")).collect()
    assert [r["s"] for r in found] == [10**6 * a * a // (x * y) for a, x, y in rows]


# --- vector codes -------------------------------------------------------------


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """``rows``: id, label, vector. Plain Python integers throughout."""
    kept = [
        (i, label, [math.floor(1024 * x) for x in v])
        for i, label, v in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    width = len(kept[0][2]) // parts
    cut = [np.array([v[p * width : (p + 1) * width] for _, _, v in kept], dtype=object) for p in range(parts)]
    place = lambda row: (row[0] is None, row[0] or 0, np.array(row[2], "<i4").tobytes())
    order = sorted(range(len(kept)), key=lambda i: place(kept[i]))[:entries]
    books = [[list(cut[p][i]) for i in order] for p in range(parts)]

    def nearest(p):
        codes, errors = [], []
        for point in cut[p]:
            found = [sum((x - y) ** 2 for x, y in zip(point, entry)) for entry in books[p]]
            codes.append(found.index(min(found)))
            errors.append(min(found))
        return codes, errors

    for _ in range(rounds):
        for p in range(parts):
            codes, _ = nearest(p)
            for e in range(len(books[p])):
                mine = [cut[p][i] for i, code in enumerate(codes) if code == e]
                if mine:
                    books[p][e] = [int(sum(x)) // len(mine) for x in zip(*mine)]
    done = [nearest(p) for p in range(parts)]
    errors = [sum(int(done[p][1][i]) for p in range(parts)) for i in range(len(kept))]
    by_label = Counter()
    for (_, label, _), error in zip(kept, errors):
        by_label[label] += error
    out = [
        (i, "".join(f"{done[p][0][n]:02x}" for p in range(parts)), errors[n], by_label[label])
        for n, (i, label, _) in enumerate(kept)
    ]
    numbers = ",".join(str(int(x)) for book in books for entry in book for x in entry)
    return sorted(out, key=str), hashlib.sha256(numbers.encode()).hexdigest()


SCHEMA = "Vec_ID bigint, vec array<float>, tag int, code string, ERROR int"


def codes_of(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, "c", 0) for i, label, v in rows], SCHEMA)
    coded, books = vector_codes.compress(df.repartition(3), "Vec_ID", "vec", "tag", **options)
    found = vector_codes.hex_codes(coded, books)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    rows = found.collect()
    assert all(row["codebooks_sha256"] == books.digest() for row in rows)
    return sorted((tuple(row[:4]) for row in rows), key=str), books.digest()


def as_floats(rows):
    return [(i, label, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]


def some_vectors(n, width=8, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] * 0.3 + rng.normal(size=width) * 0.05
        rows.append((int(i * 7 % n), [None, 1, 2][i % 3], v.tolist()))
    return rows


ODD_VECTORS = [
    (-5, 1, None), (-4, 1, []), (-3, None, [0.0, None] * 4), (-2, 2, [float("nan")] * 8),
    (-1, 2, [float("inf")] + [0.0] * 7), (None, None, [0.25] * 8), (3, 2, [0.25] * 8),
    (3, 2, [0.25] * 8), (4, 9, [-0.0001] * 8), (5, 9, [15000.0, -15000.0] * 4), (6, None, [0.0] * 8),
]


@pytest.mark.parametrize("entries,first", [(5, 16), (40, 3), (40, 39), (64, 1), (256, 16)])
def test_codes_equal_brute_force(spark, entries, first):
    rows = as_floats(some_vectors(300) + ODD_VECTORS)
    found = codes_of(spark, rows, entries=entries, first_bounds=first)
    assert found == brute_codes(rows, entries=entries)


def test_codes_of_ties(spark):
    """Points on a small grid: many equal distances, entries that stay unused."""
    rng = np.random.default_rng(1)
    rows = [(i, 0, (rng.integers(0, 3, 8) / 1024).tolist()) for i in range(200)]
    found = codes_of(spark, as_floats(rows), entries=30, first_bounds=4, rounds=3)
    assert found == brute_codes(as_floats(rows), entries=30, rounds=3)


def test_no_vectors(spark):
    assert codes_of(spark, []) == brute_codes([])
    assert codes_of(spark, as_floats(ODD_VECTORS[:5])) == brute_codes([])
    assert codes_of(spark, as_floats([(1, 1, [0.5] * 4)])) == brute_codes([(1, 1, [0.5] * 4)])


def test_vectors_that_are_refused(spark):
    for rows, why in (
        ([(1, 1, [0.5] * 4), (2, 1, [0.5] * 8)], "one length"),
        ([(1, 1, [0.5] * 6)], "one length"),
        ([(1, 1, [1e30] * 4)], "below"),
    ):
        with pytest.raises(Exception, match=why):
            codes_of(spark, rows)


def test_bounds_never_skip_a_nearer_entry():
    """All rounds on one part, with every kept bound checked against true distances."""
    rng = np.random.default_rng(2)
    points = rng.integers(-900, 900, (2000, 16))
    entries = points[:100].copy()
    bounds, skipped = vector_codes.full_assignment(points, entries, 8), 0
    for _ in range(6):
        codes = bounds.entry
        new = np.stack([points[codes == e].mean(axis=0) if (codes == e).any() else entries[e] for e in range(100)])
        new = np.floor(new).astype(np.int64)
        vector_codes.moved(bounds, np.sqrt(((new - entries) ** 2).sum(axis=1)) * (1 + 1e-12))
        entries = new
        need = vector_codes.reassign(points, entries, bounds)
        true = ((points[:, None] - entries) ** 2).sum(axis=2)
        assert (bounds.entry == true.argmin(axis=1)).all()
        roots = np.sqrt(true)
        rows = np.arange(len(points))
        assert (bounds.upper >= roots[rows, bounds.entry]).all()
        assert (bounds.lower <= np.take_along_axis(roots, bounds.near.astype(int), axis=1)).all()
        other = roots.copy()
        other[rows, bounds.entry] = np.inf
        np.put_along_axis(other, bounds.near.astype(int), np.inf, axis=1)
        assert (bounds.outer <= other.min(axis=1)).all()
        skipped += (need == 0).sum()
    assert skipped > 2000  # the bounds do spare work


def test_op13_equals_brute_force(spark):
    sf_dir = f"{TESTDATA}/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    expected = brute_codes([tuple(row) for row in rows])
    found = QUERIES["op13_vector_codes"](spark, sf_dir).collect()
    assert sorted((tuple(row[:4]) for row in found), key=str) == expected[0]
    assert {row["codebooks_sha256"] for row in found} == {expected[1]}
