"""Resampling, decontamination and the manifest against brute-force versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from llm_common import AWKWARD, corpus, documents
from recordflow.llm import byte_words, common, merkle, ordering, resampling, winnowing

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [(910, "Ünï-çödé ÉÈ 漢字 kanji\x00null 42x"), (911, "Tie tie TIE"), (-5, "negative id"), (912, "x" * 70 + " " + "y" * 33 + " " + "x" * 70)]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "item_id long, text string, doc_id string, fp string")


# Words and hashes


def test_spans_and_hashes():
    rnd = random.Random(3)
    texts = ["Héllo, WORLD the  x", "", "...", "a", "".join(rnd.choice("aB0 é漢-") for _ in range(3000)), "w" * 100, "\n\n"]
    spans = byte_words.word_spans([t.encode() for t in texts])
    mine = [spans.text(i, 1) for i in range(len(spans.starts))]
    assert mine == [w for t in texts for w in words(t)]
    assert np.diff(spans.first).tolist() == [len(words(t)) for t in texts]
    hashes = byte_words.span_hashes(spans.buffer, spans.starts, spans.ends - spans.starts)
    assert hashes.tolist() == [xxhash.xxh64_intdigest(w.encode()) for w in mine]


@pytest.mark.parametrize("size", range(0, 70))
def test_hash_of_every_length(size):
    raw = bytes(i * 7 % 251 for i in range(size))
    buffer = np.concatenate([np.frombuffer(b"ab" + raw, np.uint8), np.zeros(8, np.uint8)])
    assert byte_words.span_hashes(buffer, np.array([2]), np.array([size])).tolist() == [xxhash.xxh64_intdigest(raw)]


def test_table_tells_equal_hashes_apart(monkeypatch):
    """Bytes decide: with one hash for all n-grams, each distinct one still has its slot and count."""
    monkeypatch.setattr(resampling, "span_hashes", lambda buffer, starts, lengths: np.zeros(len(starts), np.uint64))
    spans = byte_words.word_spans([b"one two one three two one longerthaneight longerthaneighu"])
    table = resampling.NgramTable(spans.buffer, spans.starts, spans.ends - spans.starts, 10_000)
    taken = table.count > 0
    assert sorted(zip(table.count[taken], table.bucket[taken])) == sorted(
        (n, zlib.crc32(w) % 10_000) for w, n in ((b"one", 3), (b"two", 2), (b"three", 1), (b"longerthaneight", 1), (b"longerthaneighu", 1))
    )
    assert table.slot[0] == table.slot[2] == table.slot[5] != table.slot[1]


# Positions


def test_positions_of_a_hot_group_and_equal_rows(spark):
    rows = [("a", 1)] * 300 + [(None, i) for i in range(40)] + [(f"g{i}", i) for i in range(30)] + [("a", 0)]
    random.Random(1).shuffle(rows)
    stages = common.Stages(spark, "test")
    got = ordering.positions(spark.createDataFrame(rows, "g string, v long").repartition(7), ["g"], ["v"], stages).collect()
    by_group = collections.defaultdict(list)
    for r in got:
        by_group[r["g"]].append((r["pos"], r["v"], r["n"]))
    wanted = collections.defaultdict(list)
    for g, v in rows:
        wanted[g].append(v)
    assert {g: sorted(x) for g, x in by_group.items()} == {g: [(i, v, len(x)) for i, v in enumerate(sorted(x))] for g, x in wanted.items()}


# Resampling


def features(text):
    found = words(text)
    return found + [f"{a} {b}" for a, b in zip(found, found[1:])]


def resampled(rows, target, percent=25, least=20, buckets=10_000, seed=7):
    def counted(texts):
        out = collections.Counter()
        for t in texts:
            out.update(zlib.crc32(f.encode()) % buckets for f in features(t))
        return out

    s, t = counted(x for _, x in rows), counted(target)
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    out = []
    for doc_id, text in rows:
        gains = [math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t))) for b in (zlib.crc32(f.encode()) % buckets for f in features(text))]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words(text)), len(gains), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    ranks = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted((tuple(r) + (ranks.get(id(r)),) for r in out), key=repr)


@pytest.mark.parametrize("percent, least, chunk", [(25, 20, 1 << 18), (50, 0, 7), (0, 20, 64), (100, 3, 1 << 18)])
def test_resampling(spark, monkeypatch, percent, least, chunk):
    monkeypatch.setattr(resampling, "TABLE_WORDS", chunk)
    if chunk < 100:  # workers import the module anew, so the chunking is tested here
        spans = byte_words.word_spans([t.encode() for _, t in corpus(2)])
        whole, cut = collections.Counter(), collections.Counter()
        for out, size in ((cut, chunk), (whole, 1 << 18)):
            monkeypatch.setattr(resampling, "TABLE_WORDS", size)
            for table, owner in resampling._tables(spans, 2, 997):
                out.update(zip(owner.tolist(), table.bucket[table.slot].tolist()))
        assert whole == cut
    rows = corpus(5) + AWKWARD + ODD
    target = [t for _, t in corpus(6)[:20]] + [None, ""]
    got = resampling.resample(documents(spark, rows).repartition(5), benchmark(spark, enumerate(target)), percent=percent, least_words=least)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == resampled(rows, target, percent, least)


def test_resampling_of_empty_tables(spark):
    assert resampling.resample(documents(spark, []), benchmark(spark, [(1, "a b")])).collect() == []
    got = resampling.resample(documents(spark, [(1, "word " * 30)]), benchmark(spark, []), percent=100).collect()
    assert [tuple(r) for r in got] == resampled([(1, "word " * 30)], [], 100)


# Decontamination


def contaminated(rows, items, window=10):
    wins = collections.defaultdict(set)
    for item, text in items:
        found = words(text)
        width = min(window, len(found))
        for i in range(len(found) - width + 1 if width else 0):
            wins[tuple(found[i : i + width])].add("" if item is None else str(item))
    widths = {len(w) for w in wins}
    out = []
    for doc_id, text in rows:
        found, hit, ids = words(text), set(), set()
        for width in widths:
            for i in range(len(found) - width + 1):
                names = wins.get(tuple(found[i : i + width]))
                if names:
                    hit.update(range(i, i + width))
                    ids |= names
        out.append((doc_id, len(found), sorted(hit), sorted(ids)))
    return sorted(out, key=repr)


def planted(seed=4):
    rnd, rows, items = random.Random(seed), corpus(seed), []
    for number, (_, text) in enumerate(rnd.sample(rows, 30)):
        found = text.split()
        low = rnd.randrange(len(found))
        items.append((number, " ".join(found[low : low + rnd.choice([1, 2, 4, 5, 6, 9, 10, 11, 15, 40])]).upper()))
    common_passage = " ".join(f"c{i}" for i in range(14))
    items += [(100 + i, f"{common_passage} tail{i}") for i in range(12)]  # one passage of many items
    rows += [(2000 + i, f"before {common_passage}! after, {common_passage} tail3") for i in range(40)]  # in many documents
    items += [(None, "word word word word word word word word word word word"), (7, "the same id again and again once more with ten words"), (None, None), (200, ""), (201, "?!")]
    return rows + AWKWARD + ODD + [(3000, "said: The same id - again and again once more with ten words.")], items


@pytest.mark.parametrize("window, gram", [(10, 5), (10, 1), (10, 10), (4, 5), (1, 1)])
def test_decontamination(spark, window, gram):
    rows, items = planted()
    got = winnowing.contamination(documents(spark, rows).repartition(6), benchmark(spark, items), window, gram).collect()
    flat = [(r["doc_id"], r["n_words"], [i for s in r["spans"] for i in range(s["start"], s["end"])], r["item_ids"]) for r in got]
    assert sorted(flat, key=repr) == contaminated(rows, items, window)


def test_decontamination_with_a_full_filter_and_shuffled_joins(spark, monkeypatch):
    """A filter that lets everything through and joins without a broadcast change no result."""
    monkeypatch.setattr(winnowing, "FILTER_BITS", (5, 5))
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    rows, items = planted(9)
    got = winnowing.contamination(documents(spark, rows), benchmark(spark, items)).collect()
    flat = [(r["doc_id"], r["n_words"], [i for s in r["spans"] for i in range(s["start"], s["end"])], r["item_ids"]) for r in got]
    assert sorted(flat, key=repr) == contaminated(rows, items)


def test_every_shared_window_shares_a_fingerprint():
    rnd = np.random.default_rng(1)
    text = rnd.integers(0, 6, 3000).astype(np.uint64)  # many equal grams, so many ties
    whole = winnowing.fingerprints(text, 10, 5)
    for at in range(0, 2900, 37):
        assert winnowing.fingerprints(text[at : at + 10], 10, 5)[0] == whole[at]


def test_decontamination_of_empty_tables(spark):
    assert winnowing.contamination(documents(spark, []), benchmark(spark, [(1, "a b")])).collect() == []
    report = winnowing.contamination_report(winnowing.contamination(documents(spark, [(1, "a b"), (2, None)]), benchmark(spark, [])))
    none = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, report.collect())) == [(1, 2, 0, 0, none, False), (2, 0, 0, 0, none, False)]


# Manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_leaf(row, text):
    def cell(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return sha(*map(cell, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def rows_above(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def expected(rows):
    """The contract, with one whole tree in memory."""
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, row_leaf(r, r["text"])))
        trees[lang] = own, rows_above([row_leaf(r, r["text"]) for r in own])
    last = rows_above([trees[x][1][-1][0] for x in langs])
    out = []
    for at, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, r in enumerate(own):
            altered = r["text"] is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node, proof, place = row_leaf(r, r["text"].translate(LOWER) if altered else r["text"]), [], i
            for level in levels[:-1]:
                run = level[place // 8 * 8 : place // 8 * 8 + 8]
                proof += run[: place % 8] + run[place % 8 + 1 :]
                node = sha(*run[: place % 8], node, *run[place % 8 + 1 :])
                place //= 8
            place = at
            for level in last[:-1]:
                run = level[place // 8 * 8 : place // 8 * 8 + 8]
                proof += run[: place % 8] + run[place % 8 + 1 :]
                node = sha(*run[: place % 8], node, *run[place % 8 + 1 :])
                place //= 8
            out.append((r["doc_id"], levels[0][i], levels[-1][0], last[-1][0], sha(*proof), node, node == last[-1][0]))
    return sorted(out, key=repr)


def manifest_rows(counts, seed=1):
    rnd, rows = random.Random(seed), []
    for lang, n in counts.items():
        for _ in range(n):
            rows.append((rnd.randrange(3 * n), rnd.choice(["s", None, "ü:1"]), lang, rnd.choice([None, 5]), rnd.choice([None, "", "Some Text", "lower", "ÀB x"]) , "x", "y", "z"))
    rows += [(None, None, None, None, None, "x", "y", "z")] * 2 + [(77, "s", "en", 1, "Long " * 20000, "x", "y", "z")] * 3
    rnd.shuffle(rows)
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos string, digest string"


@pytest.mark.parametrize("counts", [{"en": 700, "fr": 64, "de": 65, None: 9, "": 1, "é": 8, **{f"l{i}": 1 + i % 3 for i in range(70)}}, {"en": 1}, {"en": 5, "fr": 512}])
def test_manifest(spark, counts):
    rows = manifest_rows(counts)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = merkle.manifest_report(merkle.manifest(frame.repartition(5), merkle.lowered_third))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected([r.asDict() for r in frame.collect()])


def test_manifest_over_several_blocks(spark):
    """More leaves than two rounds of blocks of 4096 hold in one tree."""
    n = 4096 * 3 + 1
    frame = spark.range(n).selectExpr("id as doc_id", "'s' as source", "if(id % 9 = 0, 'fr', 'en') as lang", "id as n_chars", "concat('Text ', id) as text")
    got = merkle.manifest_report(merkle.manifest(frame, merkle.lowered_third)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected([r.asDict() for r in frame.collect()])


def test_blocks_of_blocks(spark, monkeypatch):
    """Small blocks, so that the way up takes many rounds; helpers run in this process."""
    nodes = [sha(str(i)) for i in range(1000)]
    whole = merkle.Tree(nodes)
    for i in (0, 1, 511, 512, 999):
        lower = merkle.Tree(nodes[i // 512 * 512 : i // 512 * 512 + 512], 3)
        upper = merkle.Tree([merkle.Tree(nodes[j : j + 512], 3).top for j in range(0, 1000, 512)])
        assert lower.siblings(i % 512) + upper.siblings(i // 512) == whole.siblings(i)
        assert merkle.climb("x", whole.siblings(i))[-1] == merkle.climb(lower.version(i % 512, "x")[-1], upper.siblings(i // 512))[-1]


def test_version_shares_untouched_nodes():
    tree = merkle.Tree([sha(str(i)) for i in range(100)])
    changed = [sha(str(i)) if i != 42 else sha("other") for i in range(100)]
    copied = tree.version(42, sha("other"))
    other = merkle.Tree(changed)
    assert copied == [level[42 // 8**k] for k, level in enumerate(other.levels)]
    assert sum(a != b for x, y in zip(tree.levels, other.levels) for a, b in zip(x, y)) == len(copied)


def test_manifest_without_alterations(spark):
    frame = spark.createDataFrame(manifest_rows({"en": 20}), SCHEMA)
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in merkle.manifest(frame).collect())
    assert merkle.manifest(spark.createDataFrame([], SCHEMA), merkle.lowered_third).collect() == []
