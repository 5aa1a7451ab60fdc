"""Vector codes, language identification and the prefix trie."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from genflow.llm import langid, prefix_trie, queries, vector_codes
from genflow.llm.common import utf8

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

# -- vector codes ----------------------------------------------------------


def plain_codes(rows, entries=16, rounds=6):
    """Lloyd over (vec_id, vector, label) rows with Python's integers."""
    kept = [(i, [int(np.floor(x * 4096)) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 8)
    parts = [[(v + [0] * (8 * width))[p * width:(p + 1) * width] for p in range(8)] for _, v, _ in kept]
    books = [[list(parts[k][p]) for k in range(min(entries, len(parts)))] for p in range(8)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), k) for k, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            members = defaultdict(list)
            for row in parts:
                members[near(row[p], books[p])[1]].append(row[p])
            for k, held in members.items():
                books[p][k] = [sum(x) // len(held) for x in zip(*held)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out, sums = [], defaultdict(int)
    for (i, _, label), row in zip(kept, parts):
        found = [near(part, books[p]) for p, part in enumerate(row)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), min(sum(d for d, _ in found), 2**63 - 1)))
        sums[label] += out[-1][3]
    return sorted(((i, c, e, min(sums[label], 2**63 - 1), digest) for i, label, c, e in out), key=str)


def coded(spark, rows, **options):
    wide = spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                                 "vec_id bigint, embedding array<double>, label int, code string, nid int, entry int").repartition(3)
    got = vector_codes.compressed(wide, **options).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    return sorted(map(tuple, got), key=str)


def test_codes_with_edge_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 3, 0.4) for _ in range(16)], i % 4 or None) for i in range(60)]
    rows += [(60, None, 1), (61, [1.0] * 15 + [float("nan")], 1), (62, [1.0] * 15 + [None], 1), (63, [float("inf")] * 16, 1),
             (64, [0.0] * 16, None), (65, [0.0] * 16, 2), (65, [0.0] * 16, 2), (None, [5.0] * 16, 2), (3, [-0.00001] * 16, 2)]
    assert coded(spark, rows) == plain_codes(rows)


def test_codes_of_few_uneven_and_no_vectors(spark):
    rows = [(5, [1.0, 2.0, 3.0], 1), (2, [0.5] * 17, 1), (9, [], None)]
    assert coded(spark, rows) == plain_codes(rows)
    assert coded(spark, rows[:0]) == []
    assert coded(spark, [(1, [], 1), (2, [], 1)]) == plain_codes([(1, [], 1), (2, [], 1)])


def test_codes_beyond_64_bit_squares(spark):
    rows = [(i, [float(i) * 1e9 + j for j in range(8)], 1) for i in range(40)]
    assert coded(spark, rows, rounds=3) == plain_codes(rows, rounds=3)


def test_codes_with_most_parts_on_one_entry(spark):
    rng = random.Random(4)
    rows = [(i, [0.25] * 8 if i % 3 else [rng.random() for _ in range(8)], i % 2) for i in range(300)]
    assert coded(spark, rows) == plain_codes(rows)


def test_only_parts_that_change_their_entry_are_shuffled(spark, tmp_path):
    books = vector_codes.Codebooks(tuple(((0,), (100,)) for _ in range(8)), 1)
    rows = [(i, p, int(i >= 50), i % 4, False, [99 if i < 10 else 0 if i < 50 else 100]) for i in range(90) for p in range(8)]
    parts = spark.createDataFrame(rows, vector_codes._PART)
    moved = parts.mapInArrow(vector_codes._moved(books), vector_codes._PART)
    assert moved.where("moved").count() == 80  # ten vectors in eight positions
    settled = vector_codes._settled(moved)
    assert settled.count() == 720
    plan = settled._jdf.queryExecution().toString()
    assert "Exchange" not in plan  # read where they lie


# -- language --------------------------------------------------------------

def labelled(spark, rows):
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id bigint, text string, lang string, lang_pred string, score double").repartition(3)


def plain_chances(network, text):
    """The network's answer for one text, window by window and place by place."""
    raw = text.encode()
    step = langid.WINDOW - max(langid.WIDTHS) + 1
    total, weight = np.zeros(len(network.languages)), 0
    at = 0
    while True:
        piece = langid._CLASS[np.frombuffer(raw[at:at + langid.WINDOW], np.uint8)]
        window = np.zeros(langid.WINDOW, np.uint8)
        window[:len(piece)] = piece
        hidden = []
        for width, filters, bias in zip(langid.WIDTHS, network.filters, network.biases):
            best = np.full(langid.FILTERS, -np.inf)
            for i in range(langid.WINDOW - width + 1):
                best = np.maximum(best, network.embed[window[i:i + width]].reshape(-1) @ filters)
            hidden.append(np.maximum(best + bias, 0))
        score = np.concatenate(hidden) @ network.out + network.out_bias
        chance = np.exp(score - score.max())
        letters = int((piece > 1).sum())
        total += letters * chance / chance.sum()
        weight += letters
        at += step
        if at + (langid.WINDOW - step) >= len(raw):
            return total / weight


@pytest.fixture(scope="module")
def network(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    return langid.train(docs.where(~langid.held_out()), epochs=4)


def test_chances_against_plain_windows(network):
    texts = ["short one", "über " * 100, "a" * langid.WINDOW, "b" * (langid.WINDOW + 1), "x y " * 1000]
    import pyarrow as pa
    got = langid.text_chances(network, *utf8(pa.array(texts)))
    for text, line in zip(texts[:4], got):
        np.testing.assert_allclose(line, plain_chances(network, text), atol=1e-4)
    np.testing.assert_allclose(got.sum(axis=1), 1, atol=1e-5)


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    net = langid.Network.fresh(["a", "b", "c"])
    for name in ("embed", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters = [f.astype(np.float64) for f in net.filters]
    windows, wanted = rng.integers(1, 20, (5, 30)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    loss, slopes = net.gradients(windows, wanted)
    for weight, slope in zip(net.weights(), slopes):
        at = tuple(rng.integers(0, s) for s in weight.shape) if weight is not net.embed else (int(windows[0, 0]), 3)
        held = weight[at]
        weight[at] = held + 1e-4
        more, _ = net.gradients(windows, wanted)
        weight[at] = held - 1e-4
        less, _ = net.gradients(windows, wanted)
        weight[at] = held
        assert abs((more - less) / 2e-4 - slope[at]) < 2e-3


def test_language_query_on_held_out_documents(spark):
    got = {r["doc_id"]: r for r in queries.op12_byte_convolution(spark, LARGER).collect()}
    rows = duckdb.sql(f"select doc_id, text, lang from '{LARGER}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    right = total = 0
    for doc, text, lang in rows:
        assert got[doc]["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2)
        assert 0 <= got[doc]["score"] <= 1
        if not text or not any(c.isalpha() for c in text):
            assert got[doc]["lang_pred"] == "und"
        elif got[doc]["held_out"]:
            total += 1
            right += got[doc]["lang_pred"] == lang
    assert total > 200 and right / total > 0.97


def test_language_edge_rows(spark, network):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 34 !?", "en"), (3, "12 34 !?", "en"), (None, "the and of", None), (4, "the " * 200_000, "en"),
            (5, "\U0001F600", "en"), (6, "Ж", "en")]
    got = langid.predict(labelled(spark, rows), network)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    found = sorted((r["doc_id"] or 0, r["lang_pred"] != "und") for r in got.collect())
    assert found == [(0, True), (1, False), (2, False), (3, False), (3, False), (4, True), (5, False), (6, True)]
    assert langid.predict(labelled(spark, rows[:0]), network).count() == 0


def test_languages_that_cannot_be_learned(spark):
    rows = [(1, None, "en"), (2, "123", "en"), (3, "some text", None)]
    assert langid.train(labelled(spark, rows)) is None
    assert {r["lang_pred"] for r in langid.predict(labelled(spark, rows), None).collect()} == {"und"}
    one = langid.train(labelled(spark, [(1, "some text that is long enough", "xx")] * 5))
    assert [tuple(r) for r in langid.predict(labelled(spark, [(9, "words", None)]), one).select("lang_pred", "score").collect()] == [("xx", 1.0)]


def test_sample_is_bounded_and_counts_copies_once(spark):
    rows = [(i, "the same text over and over", "en") for i in range(500)] + [(i, f"ein anderer text zahl {i} wort", "de") for i in range(300)]
    net = langid.train(labelled(spark, rows), sample=20, a_text=1, epochs=1)
    assert net.languages == ["de", "en"]


# -- prefix trie -----------------------------------------------------------

def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        turns = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(members[k]) - 1) * words
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items()), key=str)


def rolled(spark, rows, **options):
    wide = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows],
                                 "conv_id bigint, turn bigint, role string, text string, comp string, nid int, depth int, weight int").repartition(3)
    got = prefix_trie.prefix_rollup(wide, **options)
    return sorted((tuple(r) for r in got.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                               "ends_sha256").collect()), key=str)


@pytest.mark.parametrize("local_weight", [2048, 6])
def test_trie_with_edge_rows(spark, local_weight):
    rows = [(0, 0, "user", "hello  there"), (0, 1, "assistant", None), (0, None, "system", "be kind"), (1, 0, "user", "hello  there"),
            (None, 0, "user", "of nobody"), (7, 3, None, ""), (7, 3, None, ""), (23, 1, "user", "x"), (41, 0, "user", "word " * 50_000),
            (-3, 0, "user", "below zero"), (-3, 1, "user", "still"), (45, 5, "user", "tie b"), (45, 5, "user", "tie a"), (45, 5, "assistant", "tie c")]
    rows += [(c, t, "user", f"turn {t}") for c in range(60, 80) for t in range(c % 5)]
    assert rolled(spark, rows, local_weight=local_weight) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert rolled(spark, []) == []
    assert rolled(spark, [(None, 0, "user", "x")]) == []


@pytest.mark.parametrize("local_weight", [2048, 40])
def test_trie_with_a_long_conversation_and_many_copies(spark, local_weight):
    rng = random.Random(5)
    rows = [(3, t, "user", f"long {t}") for t in range(300)]
    rows += [(c, t, "user", f"copied {t}") for c in range(100, 220) for t in range(4)]
    rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice("abc")) for c in range(300, 400) for t in range(rng.randrange(7))]
    rows += [(c, t, "user", f"long {t}") for c in (22, 43) for t in range(rng.randrange(100, 290))]
    assert rolled(spark, rows, local_weight=local_weight) == plain_trie(rows)


def test_blocks_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    rows = [(c, t, "user", f"turn {t}" if t < 50 else f"{c} {t}") for c in (5, 6) for t in range(70)]
    assert rolled(spark, rows) == plain_trie(rows)


def test_split_against_plain_sums():
    rng = np.random.default_rng(7)
    for kind in ("chain", "star", "random"):
        n = 200
        up = np.array([0] + [{"chain": i - 1, "star": 0, "random": int(rng.integers(0, i))}[kind] for i in range(1, n)])
        depth = np.zeros(n, np.int64)
        for i in range(1, n):
            depth[i] = depth[up[i]] + 1
        values = rng.integers(0, 9, (n, 2))
        want, weight = values.copy(), np.ones(n, np.int64)
        for i in range(n - 1, 0, -1):
            want[up[i]] += want[i]
            weight[up[i]] += weight[i]
        got = prefix_trie.split(np.arange(n), up, np.zeros(n, np.int64), depth, weight, values)
        assert (got == want).all()


def test_ids_of_one_node_are_joined_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    ends = spark.createDataFrame([(1, i) for i in range(100)] + [(2, -4)], "nid bigint, conv_id bigint").repartition(4)
    got = {r["nid"]: r["ends"] for r in prefix_trie.end_hashes(ends).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, range(100))).encode()).hexdigest(), 2: hashlib.sha256(b"-4").hexdigest()}
