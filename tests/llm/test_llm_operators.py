"""The training-data operators on Spark: against SQL, brute force and odd rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from compare import assert_same, duckdb_over
from conftest import TESTDATA
from millrace.llm import (
    anchors,
    arrays,
    bpe,
    chat,
    components,
    decontaminate,
    embedding_dedup,
    jaccard_join,
    language,
    quality,
    repeats,
    substring_dedup,
    suffix_dedup,
    warc,
)
from millrace.llm.queries import ORACLE_SQL, QUERIES

SMALL = f"{TESTDATA}/sf0.001"
DOCS = "doc_id bigint, text string, row string, k string, marks int, score string"


def odd_docs(spark, texts):
    """Rows with columns whose names the operators use themselves."""
    rows = [(i, text, "r", "k", 1, "s") for i, text in texts]
    return spark.createDataFrame(rows, DOCS)


PASSAGE = " ".join(f"wörd{i}" for i in range(90))
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, PASSAGE),
    (5, "before " + PASSAGE + " after it"),
    (5, "before " + PASSAGE + " after it"),
    (None, PASSAGE + " end"),
    (None, "only here"),
    (7, "x" * 900),
    (8, "one two"),
    (9, "ONE two"),
    (10, "a " * 3000),
]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, scale):
    sf_dir = f"{TESTDATA}/{scale}"
    assert assert_same(QUERIES[name](spark, sf_dir), duckdb_over(sf_dir), ORACLE_SQL[name]) > 0


# --- repeats ----------------------------------------------------------------


def brute_bytes(rows, window):
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(t[p : p + window] for t in texts for p in range(len(t) - window + 1))
    out = Counter()
    for (doc, _), t in zip(rows, texts):
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - window + 1):
            if seen[t[p : p + window]] > 1:
                gone[p : p + window] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        digest = hashlib.sha256(kept).hexdigest()
        out[doc, len(t), int(gone.sum()), spans, digest] += 1
    return out


@pytest.mark.parametrize("most", [20_000, 2])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", most)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(row) for row in docs.collect()]
    done = suffix_dedup.remove_repeats(docs, "doc_id", "text", with_kept=False)
    got = done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, got.collect())) == brute_bytes(rows, 400)


@pytest.mark.parametrize("most", [20_000, 2])
def test_suffix_dedup_of_odd_rows(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", most)
    done = suffix_dedup.remove_repeats(odd_docs(spark, ODD), "doc_id", "text", window=40)
    got = done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == brute_bytes(ODD, 40)
    kept = [(row.kept, row.kept_text) for row in done.collect() if row.doc_id == 1]
    assert kept == [(None, None)]
    assert {"row", "k", "marks", "score"} < set(done.columns)
    for row in done.collect():
        if row.kept is not None:
            assert row.kept_text == bytes(row.kept).decode(errors="ignore")


def test_suffix_dedup_cuts_characters_cleanly(spark):
    docs = odd_docs(spark, [(1, "é" * 5 + "ab" * 30 + "ü"), (2, "è" * 5 + "ab" * 30 + "ö")])
    done = suffix_dedup.remove_repeats(docs, "doc_id", "text", window=20).collect()
    for row in done:
        assert len(bytes(row.kept)) + row.n_removed == row.n_bytes
        assert set(row.kept_text) <= set("éèüö")


def repeating_rows():
    """Texts that repeat lines within themselves, shared with others and not."""
    line = "one line that very many texts repeat again and again, without an end\n"
    own = "a line that only this text repeats, as often as it likes to do that\n"
    return [
        (1, line * 9 + "what the first text says"),
        (2, "what the second text says " + line * 30 + "and then " + line * 4),
        (2, "what the second text says " + line * 30 + "and then " + line * 4),
        (3, own * 25),
        (4, "nothing is repeated here, and this text is longer than a window is"),
        (None, line * 7 + own * 3),
        (5, line[:50]),
    ]


def test_texts_that_repeat_lines_equal_brute_force(spark):
    rows = repeating_rows()
    docs = odd_docs(spark, rows)
    done = suffix_dedup.remove_repeats(docs, "doc_id", "text", window=40, with_kept=False)
    got = done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == brute_bytes(rows, 40)
    done = substring_dedup.remove_earlier(docs, "doc_id", "text", window=10, with_kept=False)
    got = done.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == brute_words(rows, 10)


def test_a_text_sends_each_context_once():
    """However often a text repeats a line, its anchors make a row for each core and
    context, and all their places are in it."""
    unit = repeats.Unit(by_words=False, window=40, core=20, later_only=False)
    texts = [text for _, text in repeating_rows()]
    batch = pa.RecordBatch.from_pydict(
        {"doc": list(range(len(texts))), "h": [0] * len(texts), "text": texts}
    )
    got, all_places = Counter(), set()
    for made in repeats._find_anchors(iter([batch]), unit):
        for row in made.to_pylist():
            got[row["doc"], row["g"], row["c"]] += 1
            for at in (row["at"], *(row.get("more") or ())):
                all_places.add((row["doc"], at, row["g"], row["c"]))
    assert set(got.values()) == {1}
    expected = set()
    for doc, text in enumerate(texts):
        chunk = next(arrays.chunks(pa.array([text])))
        hashes, starts, ends, _ = unit.split(chunk)
        found = anchors.find(hashes, starts, ends, unit.window, unit.core)
        expected |= {
            (doc, int(at), int(g), int(c))
            for at, g, c in zip(found.at, found.core.view(np.int64), found.context.view(np.int64))
        }
    assert all_places == expected
    assert len(expected) > 2 * len(got)


def brute_words(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    order = [2**63 - 1 if doc is None else doc for doc, _ in rows]
    first = {}
    for doc, words in zip(order, texts):
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            first[key] = min(first.get(key, doc), doc)
    out = Counter()
    for (doc, _), place, words in zip(rows, order, texts):
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] < place:
                gone[p : p + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[doc, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("most", [20_000, 1])
def test_substring_dedup_of_odd_rows(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", most)
    done = substring_dedup.remove_earlier(odd_docs(spark, ODD), "doc_id", "text", window=10)
    got = done.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == brute_words(ODD, 10)
    assert [row.kept for row in done.collect() if row.doc_id == 1] == [None]


# --- near-duplicates --------------------------------------------------------


def brute_groups(rows):
    sets = []
    for _, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        sets.append(grams or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = Counter()
    for members in groups.values():
        known = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[rows[i][0], len(sets[i]), min(known, default=None)] += 1
    return out, len(groups)


# With few bits most sets share a key with others, with some more only some do.
@pytest.mark.parametrize(
    "block, unit, prefix, bits",
    [(2048, 32, 1_000_000, 64), (3, 2, 3000, 64), (2048, 32, 1_000_000, 3), (3, 2, 3000, 10)],
)
def test_jaccard_join_equals_brute_force(spark, monkeypatch, block, unit, prefix, bits):
    monkeypatch.setattr(jaccard_join, "KEY_BITS", bits)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "UNIT", unit)
    monkeypatch.setattr(jaccard_join, "PREFIX_ROWS", prefix)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    base = [f"w{i}" for i in range(100)]
    near = [
        (10_000 + i, " ".join([*base[: 3 * i % 90], f"x{i}", *base[3 * i % 90 + 1 :]]))
        for i in range(30)
    ]
    rows = [tuple(row) for row in docs.collect()] + near + ODD
    found = jaccard_join.near_duplicates(odd_docs(spark, rows), "doc_id", "text")
    expected, groups = brute_groups(rows)
    got = found.select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == expected
    kept = jaccard_join.keep_one(odd_docs(spark, rows), "doc_id", "text")
    # A row that repeats another in full goes as well; each has a group of its own here.
    assert kept.count() == groups
    assert kept.columns == odd_docs(spark, rows).columns


def test_keep_one_keeps_all_texts_without_words(spark):
    blank = [(None, None), (None, None), (None, ""), (None, " \n"), (None, " \n"), (6, "")]
    blank += [(6, ""), (6, None), (7, "\t\v\f\r ")]
    rows = [*blank, (8, "\u00a0"), (8, "\u00a0"), (None, "\u3000"), (None, "a b"), (None, "a b")]
    kept = jaccard_join.keep_one(odd_docs(spark, rows), "doc_id", "text")
    got = Counter((row.doc_id, row.text) for row in kept.collect())
    assert got == Counter(blank) + Counter({(8, "\u00a0"), (None, "\u3000"), (None, "a b")})


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)]
    edges += [(7, 7), (300, 200), (200, 300), (None, 5), (500, 500)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = dict(map(tuple, components.components(df, "a", "b").collect()))
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)} | {200: 200, 300: 200}
    assert got == expected


@pytest.mark.parametrize("bits", [64, 10, 3])
def test_vectors_equal_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(embedding_dedup, "KEY_BITS", bits)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        v = rng.normal(size=24)
        rows.append((i, v.tolist(), i % 3))
    for i in range(300):
        base = np.array(rows[i % 40][1])
        noise = rng.normal(size=24)
        noise *= np.linalg.norm(base) / np.linalg.norm(noise)
        rows.append((900 + i, (base + rng.uniform(0, 0.45) * noise).tolist(), rows[i % 40][2]))
    rows.append((2000, rows[0][1], rows[0][2]))
    odd = [
        (3000, None, 0), (3001, [0.0] * 24, 0), (3002, [float("nan")] * 24, 0),
        (3003, [None, *rows[0][1][1:]], 0), (3004, rows[0][1], None), (3005, [], 0),
        (3006, [float("inf"), *rows[0][1][1:]], 0), (3007, [1e300, 1e300], 0),
        (3008, [1e-300, 1.1e-300], 0),
    ]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, label int")
    found = embedding_dedup.near_duplicates(
        df.withColumn("k", F.lit("clash")), "vec_id", "embedding", "label"
    )
    got = {row.vec_id: (row.n_links, row.component_id) for row in found.collect()}
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([x for _, _, x in rows])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    ids = [i for i, _, _ in rows]
    found_links = sum(got[i][0] for i in ids)
    assert found_links >= 0.99 * near.sum() > 100
    assert all(got[i][0] <= n for i, n in zip(ids, near.sum(axis=1)))
    for i, _, _ in odd[:7]:
        assert got[i] == (0, i)
    assert got[3007] == (1, 3007) and got[3008] == (1, 3007)


# --- the others -------------------------------------------------------------


def test_bpe_of_odd_rows_and_round_trip(spark):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
    plain = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = ODD + [(11, "a b  c\n\n d'll <|endoftext|> ½ 12345"), (12, "z" * 30_000)]
    rows = bpe.encode_texts(odd_docs(spark, texts), "doc_id", "text").collect()
    expected = Counter()
    for doc, text in texts:
        ids = plain.encode_ordinary(text or "")
        spelt = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected[doc, tuple(ids), spelt, hashlib.sha256((text or "").encode()).hexdigest()] += 1
    got = Counter(
        (row.doc_id, tuple(row.ids), row.ids_sha256, row.decoded_sha256) for row in rows
    )
    assert got == expected


def test_bpe_of_a_whole_table_equals_tiktoken(spark):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
    plain = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = dict(
        map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    )
    for row in QUERIES["op9_bpe"](spark, SMALL).collect():
        ids = plain.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("most, size", [(200_000, 1 << 20), (7, 1 << 20), (200_000, 90)])
def test_decontamination_in_blocks(spark, most, size):
    items = spark.createDataFrame(
        [
            (1, " ".join(f"w{i}" for i in range(12))),
            (2, "Short item"),
            (3, None),
            (4, "?!"),
            (None, "no id"),
            (10, "short ITEM"),
        ],
        "item_id bigint, text string",
    )
    ten = " ".join(f"W{i}," for i in range(1, 11))
    texts = [
        (1, f"<{ten}> and Short... item"),
        (2, "nothing"),
        (3, None),
        (4, ""),
        (None, "no id"),
        (6, "short item"),
        (6, "short item"),
    ]
    docs = odd_docs(spark, texts).withColumn("items", F.lit("clash"))
    found = decontaminate.find_contamination(
        docs, "text", items, "item_id", "text", max_windows=most, max_bytes=size
    ).collect()
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.clean_text) for r in found)
    assert got == Counter(
        [
            (1, 13, 12, ("1", "10", "2"), "<,> and "),
            (2, 1, 0, (), "nothing"),
            (3, 0, 0, (), None),
            (4, 0, 0, (), ""),
            (None, 2, 2, (), ""),
            (6, 2, 2, ("10", "2"), ""),
            (6, 2, 2, ("10", "2"), ""),
        ]
    )
    assert found[0].row == "r"


def test_archive_is_the_same_however_it_is_written(spark, tmp_path):
    rows = [(i % 40 if i else None, f"u{i}", "p" * (900 + i % 7 * 50)) for i in range(60)]
    rows += [(70, "u", None), (71, None, ""), (71, None, "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    seen = []
    for parts in (1, 7):
        folder = f"{tmp_path}/{parts}"
        manifest = warc.write_archive(
            pages.repartition(parts), "page_id", "url", "html", folder, shard_bytes=9000,
            file_bytes=600,
        )
        seen.append(sorted(map(tuple, manifest.collect())))
        records = warc.read_archive(manifest, folder).collect()
        assert len(records) == len(rows)
        assert not list((tmp_path / str(parts)).glob("_temporary*"))
    assert seen[0] == seen[1] and len(seen[0]) > 3
    by_digest = defaultdict(list)
    for record in records:
        by_digest[record.payload_digest].append(record)
    for same in by_digest.values():
        latest = max((r.id for r in same if r.id is not None), default=None)
        for r in same:
            revisit = r.payload_bytes >= 1000 and len(same) > 1 and r.id != latest
            assert (r.record_type, r.refers_to) == (
                ("revisit", latest) if revisit else ("response", None)
            )
            assert (r.payload is None) == revisit


def test_archive_refuses_a_changed_file(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string")
    manifest = warc.write_archive(pages, "page_id", "url", "html", str(tmp_path / "a"))
    file = next((tmp_path / "a").glob("*.warc.gz"))
    file.write_bytes(file.read_bytes() + b"x")
    with pytest.raises(Exception, match="not the file|incorrect header"):
        warc.read_archive(manifest, str(tmp_path / "a")).collect()


def test_chat_parts_make_up_the_whole(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi\nall"), (1, 2, "bob", None),
        (1, 3, None, "who?"), (1, 3, "ann", "tie"), (1, None, "bob", "no turn"),
        (2, 5, "system", "alone"), (None, 0, "ann", "no conversation"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = chat.render_views(
        turns.withColumn("said", F.lit(1)), "conv_id", "turn", "role", "text", part_turns=2
    ).collect()
    views = defaultdict(list)
    for row in found:
        views[row.conv, row.view].append(row)
    assert set(views) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    for (conv, view), parts in views.items():
        parts.sort(key=lambda row: row.start)
        text, learnt = "", []
        for row in parts:
            assert row.start == len(text)
            learnt += [row.text[m.start : m.end] for m in row.masks]
            text += row.text
        said = sorted(
            ((r[1] is not None, r[1], r[2] or "unknown", r[3] or "") for r in rows if r[0] == conv),
            key=str,
        )
        mine = [t for _, _, role, t in said if role == view]
        assert learnt == [f"{t}<|end|>" for t in mine]
        assert text.count("<|assistant|>\n") == len(mine)
        assert f"<|user {view}|>" not in text


def test_languages_of_held_out_texts(spark):
    sf_dir = f"{TESTDATA}/sf0.01"
    lang = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op6_language_id"](spark, sf_dir).join(lang, "doc_id").collect()
    held_out = [row for row in rows if row.held_out]
    right = sum(row.lang == row.lang_pred for row in held_out)
    assert len(rows) == 1000 and right >= 0.97 * len(held_out) > 100
    assert all(0 <= row.score <= 1 for row in rows)


def test_languages_of_odd_rows(spark):
    rows = [(i, t, x) for i, (t, x) in enumerate([("the cat", "en"), ("die Katze", "de")] * 5)]
    rows += [(90, None, "en"), (91, "12 !", "de"), (92, "the", None), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs, "doc_id", "text", "lang")
    found = language.identify(docs.withColumn("score", F.lit("x")), "text", model).collect()
    by_id = {row.doc_id: (row.lang_pred, row.score) for row in found}
    assert by_id[90] == by_id[91] == by_id[None] == ("und", 0.0)
    assert by_id[92][0] == by_id[0][0] == "en" and by_id[1][0] == "de"
    assert language.fit(docs.filter("lang is null"), "doc_id", "text", "lang") is None
    nothing = language.identify(docs, "text", None).collect()
    assert {row.lang_pred for row in nothing} == {"und"}


def test_quality_of_held_out_texts(spark):
    sf_dir = f"{TESTDATA}/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = QUERIES["op10_quality_classifier"](spark, sf_dir).join(labels, "doc_id", "left")
    rows = rows.collect()
    held_out = [row for row in rows if row.held_out and row.quality is not None]
    right = sum(row.predicted == row.quality for row in held_out)
    assert len(rows) == 10_000 and right >= 0.97 * len(held_out) > 500
    good = [row for row in held_out if row.quality == 1]
    assert sum(row.predicted for row in good) >= 0.99 * len(good)


def test_quality_without_labels_and_of_odd_rows(spark):
    docs = odd_docs(spark, ODD)
    labels = spark.createDataFrame([(4, None), (None, 1), (77, 1)], "doc_id bigint, quality int")
    assert quality.fit(docs, "doc_id", "text", labels, "doc_id", "quality") is None
    scored = quality.score(docs, "text", None)
    assert {row.score for row in scored.collect()} == {0.5}
    some = spark.createDataFrame([(4, 1), (10, 0), (7, 0)], "doc_id bigint, quality int")
    machine = quality.fit(docs, "doc_id", "text", some, "doc_id", "quality")
    rows = quality.score(docs, "text", machine).collect()
    assert len(rows) == len(ODD) and all(0 <= row.score <= 1 for row in rows)


def test_empty_tables(spark):
    docs = odd_docs(spark, []).select("doc_id", "text")
    items = spark.createDataFrame([], "item_id bigint, text string")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    folder = warc.archive_folder(spark)
    manifest = warc.write_archive(pages, "page_id", "url", "html", folder)
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    for df in (
        suffix_dedup.remove_repeats(docs, "doc_id", "text"),
        substring_dedup.remove_earlier(docs, "doc_id", "text"),
        jaccard_join.near_duplicates(docs, "doc_id", "text"),
        decontaminate.find_contamination(docs, "text", items, "item_id", "text"),
        warc.read_archive(manifest, folder),
        chat.render_views(turns, "conv_id", "turn", "role", "text"),
        embedding_dedup.near_duplicates(vectors, "vec_id", "embedding", "label"),
        bpe.encode_texts(docs, "doc_id", "text"),
        language.identify(docs, "text", None),
        quality.score(docs, "text", None),
    ):
        assert df.count() == 0


# --- the pipeline -----------------------------------------------------------


def kept_bytes(rows, window):
    """What is left of each text without bytes of strings that start twice, as text."""
    texts = {doc: text.encode() for doc, text in rows}
    seen = Counter(t[p : p + window] for t in texts.values() for p in range(len(t) - window + 1))
    out = {}
    for doc, t in texts.items():
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - window + 1):
            if seen[t[p : p + window]] > 1:
                gone[p : p + window] = True
        out[doc] = bytes(np.frombuffer(t, np.uint8)[~gone]).decode(errors="ignore")
    return out


def test_pipeline_of_odd_rows_and_names(spark, tmp_path):
    """The whole of ``run`` over nulls, blanks, copies, bytes that are no text, and
    documents' own columns that have the names of what operators add."""
    own = "Score double, n_words int, ITEMS string, spans string, n_hit int, kept_text string"
    rows = [
        (i, f"these are words number {i} of a text {i * 7} that nothing repeats {i}", "en", "s", 5)
        for i in range(30)
    ]
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0), (102, " ", "en", "s", 1)]
    rows += [(None, PASSAGE, "en", "s", 3), (None, PASSAGE, "en", "s", 3), (103, PASSAGE + " x", "en", "s", 4)]
    docs = spark.createDataFrame(
        [(*row, 0.5, 1, "i", "s", 2, "k") for row in rows],
        f"doc_id bigint, text string, lang string, source string, n_chars bigint, {own}",
    )
    odd = docs.limit(1).withColumn("text", F.expr("cast(unhex('61FF62') as string)"))
    odd = odd.withColumn("doc_id", F.lit(200).cast("bigint"))
    docs.unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    items = [("a", "number 3 of a text 21 that nothing repeats 3")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    old, corpus_pipeline.GOOD = corpus_pipeline.GOOD, 0.5  # without labels all score 0.5
    try:
        found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        corpus_pipeline.GOOD = old
    ids = Counter(row["doc_id"] for row in found)
    assert ids == Counter({**{i: 1 for i in range(30)}, 100: 1, 101: 1, 102: 1, 103: 1, 200: 1})
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, read, str(tmp_path)) if name != "quality classifier" else read
        assert kept.columns == read.columns, name
        assert {(r["Score"], r["n_words"], r["ITEMS"], r["spans"], r["n_hit"], r["kept_text"]) for r in kept.collect()} == {(0.5, 1, "i", "s", 2, "k")}, name


def test_pipeline_stages(spark):
    """Each stage against brute force over what the stage before has kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    good = stages["quality classifier"](spark, docs, SMALL).cache()
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    one = stages["n-gram Jaccard join"](spark, good, SMALL).cache()
    rows = [(row.doc_id, row.text) for row in good.collect()]
    expected, groups = brute_groups(rows)
    assert {row.doc_id for row in one.collect()} == {component for _, _, component in expected}
    assert one.count() == groups and one.columns == docs.columns
    cut = stages["suffix-array dedup"](spark, one, SMALL).cache()
    kept = kept_bytes([(r.doc_id, r.text) for r in one.collect()], 400)
    left = {row.doc_id: row.text for row in cut.collect()}
    assert left == {doc: text for doc, text in kept.items() if text.strip(" ")}
    assert all(row.n_chars == len(row.text) for row in cut.collect())
    clean = stages["benchmark decontamination"](spark, cut, SMALL).cache()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    again = decontaminate.find_contamination(clean, "text", items, "item_id", "text")
    assert clean.columns == docs.columns
    assert again.filter("n_hit > 0").count() == 0
    last = stages["byte-level BPE"](spark, clean, SMALL)
    assert last.count() == clean.count() <= cut.count() <= one.count()


# --- range-sorted archives ----------------------------------------------------


def archived(spark, rows, **options):
    schema = "id bigint, uri string, payload string, kind string, shard int"
    pages = spark.createDataFrame([(*row, "k", 7) for row in rows], schema)
    folder = warc.archive_folder(spark)
    manifest = warc.write_archive(pages, "id", "uri", "payload", folder, **options)
    found = warc.read_archive(manifest, folder).collect()
    shards = defaultdict(list)
    for name in sorted(row["file"] for row in manifest.collect()):
        one = manifest.filter(F.col("file") == name)
        shards[name.split("-")[1]] += [r["id"] for r in warc.read_archive(one, folder).collect()]
    return found, [shards[name] for name in sorted(shards)]


@pytest.mark.parametrize(
    "ids",
    [
        [*range(400), 2**62],
        [-(2**63), *range(-200, 200), 2**63 - 1],
        [*range(300), *[150] * 300],
        [*range(200), *[None] * 300, *[2**40] * 300],
    ],
)
def test_shards_are_ranges_of_ids(spark, ids):
    """Ids far apart, and ids with very many rows."""
    rng = np.random.default_rng(4)
    rows = [(id_, f"http://a/ b  {i}", f"page {i} " * 30) for i, id_ in enumerate(ids)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    found, shards = archived(spark, rows, shard_bytes=20_000)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])
    read = [(r["id"], r["uri"], bytes(r["payload"]).decode()) for r in found]
    assert sorted(read, key=key) == sorted(rows, key=key)
    assert len(shards) > 5 and max(map(len, shards)) < len(ids) / 6 + 20
    joined = [(id_ is not None, id_ or 0) for shard in shards for id_ in sorted(shard, key=lambda x: (x is not None, x or 0))]
    assert joined == sorted(joined)


def test_record_ids_are_unique_and_uris_kept(spark):
    rows = [(1, "http://a/ x  y", "p" * 2000)] * 5 + [(2, " lead\ting\r\nline ", "p" * 2000)] * 3
    rows += [(3, None, None)] * 4
    found, _ = archived(spark, rows, shard_bytes=3000)
    uris = Counter((r["id"], r["uri"]) for r in found)
    assert uris == {(1, "http://a/ x  y"): 5, (2, " lead%09ing%0D%0Aline "): 3, (3, ""): 4}
    types = Counter((r["id"], r["record_type"], r["refers_to"]) for r in found)
    assert types == {(1, "revisit", 2): 5, (2, "response", None): 3, (3, "response", None): 4}
    made = {warc.record(1, "u", b"p", None, again).split(b"WARC-Record-ID: ")[1][:60] for again in ("", "/0/1", "/1/1")}
    assert len(made) == 3


# --- names that differ in capitals, bytes that are no text ---------------------

CLASHES = "doc_id bigint, text string, Score string, N_HIT string, N_REMOVED string, Kept string"


def clashing_docs(spark):
    text = F.expr("case doc_id when 0 then cast(unhex('61FF62') as string) when 1 then null "
                  "else concat('some words here ', doc_id, ' and more words of text ', doc_id) end")
    return spark.range(20).select(F.col("id").alias("doc_id")).select(
        "doc_id", text.alias("text"), *(F.lit(x).alias(x) for x in ("Score", "N_HIT", "N_REMOVED", "Kept"))
    )


def test_odd_names_and_bytes_everywhere(spark):
    docs = clashing_docs(spark)
    items = spark.createDataFrame([("a", "words here 3 and more")], "item string, text string")
    model = language.fit(docs.withColumn("lang", F.lit("en")), "doc_id", "text", "lang")
    results = {
        "op1": suffix_dedup.remove_repeats(docs, "doc_id", "text", with_kept=False),
        "op3": substring_dedup.remove_earlier(docs, "doc_id", "text"),
        "op4": decontaminate.find_contamination(docs, "text", items, "item", "text"),
        "op6": language.identify(docs, "text", model),
        "op8": jaccard_join.near_duplicates(docs, "doc_id", "text"),
        "op8 one": jaccard_join.keep_one(docs, "doc_id", "text"),
        "op9": bpe.encode_texts(docs, "doc_id", "text"),
        "op10": quality.score(docs, "text", None),
    }
    for name, found in results.items():
        lowered = [column.lower() for column in found.columns]
        assert len(lowered) == len(set(lowered)), name
        assert len(found.collect()) == 20, name
    digest = hashlib.sha256("a�b".encode()).hexdigest()
    [row] = results["op9"].filter("doc_id = 0").collect()
    assert row["decoded_sha256"] == digest
    [row] = results["op1"].filter("doc_id = 0").collect()
    assert (row["n_bytes"], row["kept_sha256"]) == (3, hashlib.sha256(b"a\xffb").hexdigest())
