"""Merkle manifests and prefix tries against plain Python."""

import random
import zlib
from collections import Counter
from hashlib import md5, sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsengine.llm import merkle, numbering, trie
from obsengine.llm.merkle import Multiproof, missing
from obsengine.llm.queries import MERKLE_FIELDS


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def way(tree, at):
    """Siblings of a leaf, level by level."""
    out = []
    for nodes in tree[:-1]:
        run = range(at // 8 * 8, min(at // 8 * 8 + 8, len(nodes)))
        out.append([nodes[p] for p in run if p != at])
        at //= 8
    return out


def climb(tree, at, value):
    for nodes in tree[:-1]:
        first = at // 8 * 8
        run = nodes[first : first + 8]
        run[at - first] = value
        at, value = at // 8, h(run)
    return value


def leaf_of(fields):
    return h("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields)


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """doc_id, source, lang, n_chars, text -> the rows of the query."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for lang in order:
        keyed = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((keyed, levels([leaf_of(r) for r in keyed])))
    top = levels([t[-1][0] for _, t in trees])
    out = []
    for at, (keyed, tree) in enumerate(trees):
        for p, row in enumerate(keyed):
            changed = zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 3 == 0
            leaf = leaf_of((*row[:4], lowered(row[4]))) if changed else tree[0][p]
            folded = climb(top, at, climb(tree, p, leaf))
            proof = h(s for level in way(tree, p) + way(top, at) for s in level)
            out.append((row[0], tree[0][p], tree[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return Counter(out)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def proofs(spark, rows, schema=SCHEMA):
    lower = F.when(
        F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0,
        F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
    )
    made = merkle.manifest_of(spark.createDataFrame(rows, schema), "doc_id", "lang", MERKLE_FIELDS, {"text": lower})
    return Counter(tuple(r) for r in merkle.prove(made).collect())


@pytest.mark.parametrize("langs", [1, 3, 20])
def test_proofs_match_plain_trees(spark, langs):
    rnd = random.Random(langs)
    names = [None, "", "é", "z", *(f"l{i}" for i in range(30))][:langs]
    rows = [
        (i, rnd.choice(["a", None, ""]), rnd.choice([names[0], names[-1], rnd.choice(names)]),
         rnd.choice([None, 5]), rnd.choice(["Text É", "lower", None, "", "X" * 50]))
        for i in range(1300)
    ]
    rows += [rows[7]] * 3 + [(None, "s", names[0], 1, "Null Id"), (8, "other", rows[8][2], None, "ABC")]
    rows.append((5000, "s", "lone", 0, "ALONE"))
    assert proofs(spark, rows) == brute(rows)


def test_small_and_empty_tables(spark):
    one = [(1, None, None, None, None)]
    assert proofs(spark, one) == brute(one)
    assert proofs(spark, []) == Counter()
    odd = [(*r, "x", "y", "z") for r in one]
    assert proofs(spark, odd, f"{SCHEMA}, tree string, leaf string, at string") == brute(one)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 100, 513])
def test_multiproofs_are_complete_and_minimal(n):
    rnd = random.Random(n)
    tree = levels([h([str(i)]) for i in range(n)])
    for size in {1, min(3, n), n}:
        chosen = sorted(rnd.sample(range(n), size))
        wanted = missing(chosen, n)
        assert len(wanted) == len(set(wanted))
        proof = Multiproof(n, {p: tree[0][p] for p in chosen}, {(lv, p): tree[lv][p] for lv, p in wanted})
        assert proof.root == tree[-1][0]
        # No wanted node lies above a chosen leaf or another wanted node.
        covered = {(lv, p // 8**lv) for p in chosen for lv in range(len(tree))}
        covered |= {(up, p // 8 ** (up - lv)) for lv, p in wanted for up in range(lv + 1, len(tree))}
        assert not covered.intersection(wanted)
        for p in chosen:
            assert proof.siblings(p) == "".join(s for level in way(tree, p) for s in level)
            assert proof.fold(p, h(["x"])) == climb(tree, p, h(["x"]))


def test_a_block_fetches_each_node_once(spark):
    rows = [(i, None, "a" if i % 50 else "b", i, "t") for i in range(1200)]
    made = merkle.manifest_of(spark.createDataFrame(rows, SCHEMA), "doc_id", "lang", MERKLE_FIELDS, {})
    fetched = merkle.fetch(made).collect()
    keys = [(r.tree, r.block, r.of, r.level, r.at) for r in fetched]
    assert len(keys) == len(set(keys))
    for tree, n in {(r.tree, r.n) for r in fetched}:
        for block in range(-(-n // 512)):
            own = range(block * 512, min(n, block * 512 + 512))
            got = {(lv, p) for t, b, of, lv, p in keys if (t, b, of) == (tree, block, tree)}
            assert got == set(missing(own, n)) | {(len(merkle.widths(n)) - 1, 0)}


def test_numbering_splits_a_group_and_a_key(spark):
    rows = [("g", 1, i) for i in range(4000)] + [("h", i, 0) for i in range(50)]
    table = spark.createDataFrame(rows, "g string, k long, n long")
    found = numbering.numbered(table, "g", [F.col("k"), F.col("n")]).collect()
    assert sorted((r.g, r.at) for r in found) == [("g", i) for i in range(4000)] + [("h", i) for i in range(50)]
    assert all(r.at == (r.n if r.g == "g" else r.k) for r in found)


# Prefix tries.


def rebuilt(rows):
    """conv_id, turn, role, text -> turns of every rebuilt conversation."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        start = zlib.crc32(str(conv).encode()) % 6
        out[conv] = own.get(conv - int(np.fmod(conv, 100)), [])[:start] + turns[start:]
    return out


def brute_trie(convs):
    members = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    kids = Counter(way[:-1] for way in members if way)
    leaves, saved = Counter(), Counter()
    for way, found in members.items():
        for d in range(len(way) + 1):
            leaves[way[:d]] += not kids[way]
            saved[way[:d]] += (len(found) - 1) * len(way[-1][1]) if way else 0
    out = []
    for way, found in members.items():
        ends = sorted(c for c in found if len(convs[c]) == len(way))
        out.append((
            min(found), len(way), min(members[way[:-1]]) if way else None, len(found), kids[way], leaves[way],
            saved[way], sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return Counter(out)


TURNS = "conv_id long, turn long, role string, text string"


def trie_of(spark, rows, shard_turns, schema=TURNS):
    convs = trie.sequences(spark.createDataFrame(rows, schema))
    start = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    found = trie.nodes(trie.with_shared_starts(convs, start, 5), shard_turns)
    return Counter(tuple(r) for r in found.collect())


def conversations(seed):
    rnd = random.Random(seed)
    rows = []
    for conv in rnd.sample(range(-250, 800), 400):
        if rnd.random() < 0.3:
            turns = ["hello", "there"]  # a group of copies
        else:
            turns = [rnd.choice("abcé") * rnd.randrange(3) for _ in range(rnd.choice([1, 2, 3, 9, 30]))]
        rows += [(conv, i, ["user", "bot", None][i % 3], t) for i, t in enumerate(turns)]
    rows += [(5000, None, "user", "first"), (5000, 1, None, None), (5000, 1, "x", "tie"), (5000, 1, "x", "tie")]
    rows += [(None, 0, "user", "nobody's"), (6000, 0, "u", "long" * 20_000)]
    rows += [(7000, i, "u", f"turn {i}") for i in range(600)] + [(7001, i, "u", f"turn {i}") for i in range(600)]
    return rows


@pytest.mark.parametrize("shard_turns", [40, 700, 10**6])
def test_tries_of_one_and_many_shards(spark, shard_turns):
    rows = conversations(shard_turns)
    assert trie_of(spark, rows, shard_turns) == brute_trie(rebuilt(rows))


def test_tries_of_odd_tables(spark):
    assert trie_of(spark, [], 10) == Counter()
    assert trie_of(spark, [(None, 1, "a", "b")], 10) == Counter()
    copies = [(c, 0, "u", "same") for c in range(2500)]
    assert trie_of(spark, copies, 300) == brute_trie(rebuilt(copies))
    extra = [(*r, "x", "y", 1) for r in copies[:40]]
    found = trie_of(spark, extra, 10, f"{TURNS}, path string, turns string, key int")
    assert found == brute_trie(rebuilt(copies[:40]))


@pytest.mark.parametrize("seed", range(20))
def test_find_close_and_rank_against_a_stack(seed):
    rnd = random.Random(seed)
    bits, depth = [1], 1
    while depth:
        up = rnd.random() < 0.5 + 0.3 * (len(bits) < 3000) - 0.25
        bits.append(int(up))
        depth += 1 if up else -1
    tree = trie.Parentheses(np.array(bits, dtype=np.int8), block=rnd.choice([1, 2, 7, 64]))
    stack, closes = [], {}
    for at, bit in enumerate(bits):
        if bit:
            stack.append(at)
        else:
            closes[stack.pop()] = at
    for at, close in closes.items():
        assert tree.find_close(at) == close
        pairs = sum(bits[i] == 1 and bits[i + 1] == 0 for i in range(at, close))
        assert tree.leaves(at, close) == pairs
