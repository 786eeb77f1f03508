"""Near duplicates, links and fingerprints against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from obsengine.llm import embeddings, jaccard, spotsigs
from obsengine.llm.components import components
from obsengine.llm.queries import op10_spotsigs
from obsengine.session import fresh_folder
from tests.conftest import SMALL, rows


def groups_of(nodes, pairs):
    """Smallest node that pairs lead to, by repeated merging."""
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(70)]  # a chain
    edges += [(2000, 2001 + i) for i in range(50)] + [(5, 5), (5, 6), (5, 6)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    linked = {n for a, b in edges if a != b for n in (a, b)}
    wanted = groups_of(linked, [(a, b) for a, b in edges if a != b])
    assert rows(found) == sorted(wanted.items(), key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def word_sets(texts, width=5):
    out = []
    for text in texts:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        if len(words) < width:
            out.append({tuple(words)} if words else set())
        else:
            out.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)})
    return out


def brute_jaccard(docs, threshold=0.8):
    sets = word_sets([t for _, t in docs])
    pairs = [
        (i, j)
        for i in range(len(docs))
        for j in range(i)
        if sets[i] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])
    ]
    group = groups_of(range(len(docs)), pairs)
    links = [sum(i in p for p in pairs) for i in range(len(docs))]
    least = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            least[group[i]] = min(key, least.get(group[i], key))
    return sorted(
        [(key, least.get(group[i]), links[i]) for i, (key, _) in enumerate(docs)], key=repr
    )


def copies(seed, families, size):
    rnd = random.Random(seed)
    out = []
    for _ in range(families):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([30, 60, 200]))]
        for _ in range(rnd.randrange(1, size)):
            words = list(base)
            for _ in range(rnd.randrange(0, 5)):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(9)}"
            out.append(" ".join(words))
    return out


@pytest.mark.parametrize("blocks", [400, 3])
def test_jaccard_groups(spark, blocks):
    texts = copies(3, 25, 9) + ["One, two three.", "one two THREE", "", None, "one two", "... !"]
    texts += ["copy of a text that is short but long enough"] * 6 + ["word " * 60_000] * 2
    docs = list(enumerate(texts, 10)) + [(10, texts[0]), (None, texts[0]), (None, "lonely text here")]
    random.Random(1).shuffle(docs)
    frame = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id long, text string, key string")
    found = jaccard.jaccard_groups(frame, block_classes=blocks, recall=0.99999)
    got = sorted([(r.doc_id, r.class_id, r.n_links) for r in found.collect()], key=repr)
    assert got == brute_jaccard(docs)
    kept = found.where("kept").select("class_id").collect()
    assert {r.class_id for r in kept} == {c for _, c, _ in got}


def test_jaccard_without_rows_or_links(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_groups(empty).count() == 0
    one = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert rows(jaccard.jaccard_groups(one)) == [(1, 1, 0, True), (2, 2, 0, True)]


def test_bands_reach_their_recall():
    bands, per = jaccard.choose_bands(0.8, 0.9995)
    assert 1 - (1 - 0.8**per) ** bands >= 0.9995 and bands * per <= 200
    assert jaccard.choose_bands(0.5, 0.9, 40)[1] >= 2


def chain(length, words, step):
    """Texts of which each shares all but ``step`` words with the next one."""
    return [" ".join(f"w{i}" for i in range(at * step, at * step + words)) for at in range(length)]


@pytest.mark.parametrize("texts, spare", [(chain(600, 200, 40), 1.1), (chain(40, 100, 5), 10)])
def test_candidates_meet_where_it_takes_the_fewest_comparisons(spark, texts, spare):
    """Neighbours that share 160 of 200 words are candidates now and then: buckets stay apart.
    Those that share 95 of 100 share many buckets, so their group is compared as a whole."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    signed = jaccard._signatures(docs, "doc_id", "text", 5, *jaccard.choose_bands(0.8, 0.9995))
    signed = signed.withColumn("node", F.xxhash64("set_key"))
    places = jaccard.candidate_places(signed, fresh_folder(spark, "places"))

    def members(table, column):
        found = {}
        for r in table.select("node", F.explode(column).alias("at")).collect():
            found.setdefault(r.at, set()).add(r.node)
        return list(found.values())

    def pairs(sets):
        return {(x, y) for c in sets for x in c for y in c if x < y}

    def comparisons(sets):
        return sum(len(c) * (len(c) - 1) // 2 for c in sets)

    buckets, met = members(signed, "buckets"), members(places, "places.place")
    sharing = pairs(buckets)
    assert sharing <= pairs(met) and len(pairs(met)) <= spare * len(sharing)
    assert comparisons(met) <= comparisons(buckets)


@pytest.mark.parametrize("blocks", [400, 2])
def test_chains_have_all_their_links(spark, blocks):
    docs = list(enumerate(chain(60, 100, 5) + chain(60, 100, 5)[::3] + chain(30, 200, 40), 1))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = jaccard.jaccard_groups(frame, block_classes=blocks, recall=0.99999)
    got = sorted([(r.doc_id, r.class_id, r.n_links) for r in found.collect()], key=repr)
    assert got == brute_jaccard(docs)


def test_the_threshold_itself_is_a_link():
    a = np.arange(9, dtype=np.uint64)
    b = np.arange(1, 10, dtype=np.uint64)  # 8 of 10: exactly 0.8
    c = np.arange(2, 11, dtype=np.uint64)
    left = np.arange(3)
    i, j = jaccard.linked_pairs([a, b, c], 0.8, left, left)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 1), (1, 0), (1, 2), (2, 1)]


def brute_vectors(table, cosine=0.93):
    def usable(row):
        _, v, label = row
        ok = label is not None and v and all(x is not None and math.isfinite(x) for x in v)
        return ok and any(v)

    pairs = []
    for i, a in enumerate(table):
        for j in range(i):
            b = table[j]
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                    pairs.append((i, j))
    group = groups_of(range(len(table)), pairs)
    least = {}
    for i, row in enumerate(table):
        least[group[i]] = min(row[0], least.get(group[i], row[0]))
    return sorted(
        [
            (row[0], sum(i in p for p in pairs), least[group[i]], row[0] == least[group[i]])
            for i, row in enumerate(table)
        ],
        key=repr,
    )


@pytest.mark.parametrize("tile", [512, 7])
def test_near_duplicate_vectors(spark, tile):
    random_ = np.random.default_rng(4)
    table = []
    for family in range(30):
        base = random_.standard_normal(16)
        for _ in range(int(random_.integers(1, 6))):
            v = base + random_.standard_normal(16) * random_.choice([0.0, 0.1, 0.35])
            table.append([len(table), v.astype(np.float32).tolist(), family % 2])
    n = len(table)
    table += [
        [n, None, 1], [n + 1, [0.0] * 16, 1], [n + 2, [float("nan")] * 16, 1], [n + 3, [], 0],
        [n + 4, [1.0, None] * 8, 1], [n + 5, table[0][1], None], [n + 6, [1.0, 2.0], 0],
        [n + 7, [1.0, 2.0], 0], [n + 8, [float("inf")] + [0.0] * 15, 0],
        [n + 9, table[1][1], table[1][2]], [n + 10, [2.0 * x for x in table[1][1]], table[1][2]],
    ]
    frame = spark.createDataFrame(
        [(*r, "clash") for r in table], "vec_id long, embedding array<float>, label int, node string"
    )
    assert rows(embeddings.near_duplicates(frame, tile=tile)) == brute_vectors(table)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_window_is_calibrated():
    window = embeddings.Window(0.93)
    chance = embeddings.normal_within(1.6)
    tail = sum(
        math.comb(48, k) * chance**k * (1 - chance) ** (48 - k) for k in range(window.needed, 49)
    )
    assert tail >= 0.999999 and window.needed > 24
    a, b = np.random.default_rng(0).standard_normal((2, 40, 5))
    wanted = (np.abs(a[:, None] - b[None]) <= 0.5).sum(axis=2)
    assert np.array_equal(embeddings.collisions(a, b, 0.5), wanted)


def frame_of(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


@pytest.mark.parametrize("n_cuts", [0, 1, 2, 10, 37])
def test_slices_of_keys(spark, n_cuts):
    cuts = [3 * i for i in range(n_cuts)]
    keys = spark.createDataFrame([(k,) for k in [None, *range(-2, 120)]], "k long")
    found = keys.select("k", spotsigs._slice_of(F.col("k"), cuts).alias("s")).collect()
    for r in found:
        assert r.s == (0 if r.k is None else sum(c <= r.k for c in cuts))


@pytest.mark.parametrize("slices", [1, 3, 50])
def test_next_document(spark, slices):
    docs = [(i * i, f"text {i}") for i in range(20)]
    found = spotsigs.with_next(frame_of(spark, docs).repartition(4), slices)
    texts = [t for _, t in docs]
    wanted = [(k, t, n) for (k, t), n in zip(docs, [*texts[1:], texts[0]], strict=True)]
    assert sorted(tuple(r) for r in found.collect()) == wanted


def test_next_document_with_odd_keys(spark):
    docs = [(None, "n"), (3, "b"), (3, "a"), (3, "a"), (9, "z")]
    found = spotsigs.with_next(frame_of(spark, docs), 2)
    assert rows(found) == sorted(
        [(None, "n", "a"), (3, "a", "a"), (3, "a", "b"), (3, "b", "z"), (9, "z", "n")], key=repr
    )
    assert rows(spotsigs.with_next(frame_of(spark, docs[:1]), 1)) == [(None, "n", "n")]
    assert spotsigs.with_next(frame_of(spark, []), 1).count() == 0


def brute_signatures(text):
    """Chains in order: the last common word (or a start), the content word, the next two."""
    anchors, chains, content = set(spotsigs.ANCHORS), [], []
    for line in re.split(r"[\n\r]+", (text or "").lower()):
        before = "\uE000"
        for word in re.sub(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ", line).split(" "):
            if word and word not in anchors:
                content.append((before, word))
            before = word if word in anchors else before if not word else None
    for n, (before, word) in enumerate(content):
        if before is not None:
            chains.append((before, word, *(w for _, w in content[n + 1 : n + 3])))
    return chains


def brute_set(text):
    """Signatures as Spark's hash of several texts gives them: each seeds the next."""
    out = set()
    for before, *words in brute_signatures(text):
        value = 42
        for word in (f"{before} {words[0]}", *words[1:]):
            value = xxhash.xxh64_intdigest(word.encode(), seed=value)
        out.add(value - (1 << 64) if value >> 63 else value)
    return out


def brute_likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_signatures_follow_common_words(spark):
    text = "The cat and the of Dog runs, in a BIG house by night of"
    assert brute_signatures(text) == [
        ("the", "cat", "dog", "runs"), ("of", "dog", "runs", "big"), ("a", "big", "house", "night"),
        ("by", "night"),
    ]
    assert brute_signatures("plain words\n\nnext of line") == [
        ("\uE000", "plain", "words", "next"), ("\uE000", "next", "line"), ("of", "line"),
    ]
    texts = [text, text + " zebra", "", None, "the", "of " * 20_000 + "end", "x", "a\u0001b the c", "\n\r\n", "a\rb\nc"]
    texts += [" ".join(random.Random(i).choices(["the", "of", *"bcdfghjk", "É", "\n", "-"], k=60)) for i in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in spotsigs.with_signatures(frame, "text", "s").collect():
        assert r.s == sorted(brute_set(texts[r.doc_id])), texts[r.doc_id]


@pytest.mark.parametrize("threshold, recall", [(0.01, 0.9), (0.03, 0.9995), (0.3, 0.99), (0.8, 0.9995), (0.99, 0.5)])
def test_bands_reach_their_recall(threshold, recall):
    bands, per_band = jaccard.choose_bands(threshold, recall)
    assert 1 - (1 - threshold**per_band) ** bands >= recall
    assert jaccard.choose_bands(0.8, 0.9995) == (26, 6)


def test_likeness_has_no_step(spark):
    """Texts of n and n + 1 equal parts are the more alike the longer they are."""
    texts = [(n, " ".join(f"the wort{i}q" for i in range(n))) for n in range(1, 40)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    sets = {r.doc_id: set(r.s) for r in spotsigs.with_signatures(frame, "text", "s").collect()}
    likes = [brute_likeness(sets[n], sets[n + 1]) for n in range(3, 39)]
    assert all(a <= b for a, b in zip(likes, likes[1:])) and likes[-1] > 0.85


def test_similar_fingerprints(spark):
    docs = list(enumerate(copies(8, 20, 6))) + [(900, ""), (901, None), (902, "same of text"), (903, "same of text")]
    docs = [(k, t and t.replace("w1", "the w1").replace("w3", "of w3")) for k, t in docs]
    frame = frame_of(spark, docs)
    sets = {
        r.doc_id: frozenset(r.s)
        for r in spotsigs.with_signatures(frame, "text", "s").collect()
    }
    found = spotsigs.similar(frame, 0.6).collect()
    first = {}
    for k in sorted(sets):
        first.setdefault(sets[k], k)
    wanted = {
        (a, b)
        for s, a in first.items()
        for t, b in first.items()
        if a < b and s and t and len(s & t) >= 0.6 * len(s | t)
    }
    assert {(r.a, r.b) for r in found if r.kind == "pair"} == wanted and len(wanted) > 5
    assert {(r.a, r.b) for r in found if r.kind == "member"} == {
        (first[s], k) for k, s in sets.items() if s and first[s] != k
    }


def test_edited_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    found = op10_spotsigs(spark, SMALL).orderBy("doc_id").collect()
    assert len(found) == len(docs)
    for i, (doc, r) in enumerate(zip(docs, found, strict=True)):
        half = len(doc.text) // 2
        edit = doc.text[: len(doc.text) - half] + docs[(i + 1) % len(docs)].text[:half]
        assert (r.n_chars, r.edited_sha256) == (
            len(doc.text), hashlib.sha256(edit.encode()).hexdigest()
        )
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert sum(r.near_edited > r.near_next for r in found) > 0.95 * len(found)
    sets = [brute_set(d.text) for d in docs]
    for i, (doc, r) in enumerate(zip(docs, found, strict=True)):
        half = len(doc.text) // 2
        following = docs[(i + 1) % len(docs)].text
        changed = brute_set(doc.text[: len(doc.text) - half] + following[:half])
        for print_, signatures in ((r.fingerprint, sets[i]), (r.edited_fingerprint, changed)):
            joined = hashlib.sha256(",".join(map(str, sorted(signatures))).encode()).hexdigest()
            assert print_ == (f"{len(signatures)}-{joined}" if signatures else "")
        assert r.near_edited == pytest.approx(brute_likeness(sets[i], changed), abs=1e-12)
        assert r.near_next == pytest.approx(brute_likeness(sets[i], sets[(i + 1) % len(docs)]), abs=1e-12)
    same = {}
    for doc, r in zip(docs, found, strict=True):
        same.setdefault(doc.text, set()).add(r.fingerprint)
    assert all(len(prints) == 1 for prints in same.values())
