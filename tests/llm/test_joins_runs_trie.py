"""Conversation trie, periodic runs and the parity-sketch join against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import conversation_trie, parity_join, periodic_runs, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# ---- conversation trie

TURNS = "conv_id long, turn long, role string, text string, depth long, k1 string, cut string"


def conversations():
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 40), *range(200, 240), 300, 305, 777]:
        n = rng.choice([1, 2, 3, 5, 8])
        rows += [(c, t, rng.choice(["user", "bot"]), rng.choice(["a", "b", "a long one", "été"])) for t in range(n)]
    rows += [(c, t, "user", "same") for c in range(400, 430) for t in range(3)]         # a group of copies
    rows += [(501, t, "user", f"deep {t % 7}") for t in range(300)]                       # one long chain
    rows += [(502, None, None, None), (502, None, "user", None), (502, 1, "user", ""), (502, 1, "user", ""), (502, 2, None, "x" * 100_000)]
    rows += [(None, 1, "user", "nobody's"), (600, 0, "user", "a"), (601, 7, "user", "a")]
    return [(*r, 1, "x", "y") for r in rows]


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, sha, role, text))
    convs = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    members = defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in kids[node])
    out = []
    for node, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ms), len(node), parent, len(ms), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]


def contract(c):
    return c - c % 100, F.crc32(c.cast("string").cast("binary")) % 6


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "PIECE", 3)      # pieces of three ids, so that digests go on over pieces
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    got = conversation_trie.trie(df, contract, 5)
    assert got.columns == COLUMNS
    assert sorted_rows(got) == brute_trie(rows)
    assert conversation_trie.trie(spark.createDataFrame([], TURNS), contract, 5).count() == 0


def test_trie_without_openings(spark):
    df = spark.createDataFrame([(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a"), (2, 1, "u", "c"), (3, 0, "u", "a")], "conv_id int, turn int, role string, text string")
    got = {(r.depth, r.conv_id): (r.n_convs, r.n_children, r.n_leaves, r.saved) for r in conversation_trie.trie(df).collect()}
    assert got == {(0, 1): (3, 1, 2, 2), (1, 1): (3, 2, 2, 2), (2, 1): (1, 0, 1, 0), (2, 2): (1, 0, 1, 0)}


def test_subtree_sums_on_odd_trees(spark):
    """Chains, stars and random trees, several roots at once."""
    rng = random.Random(8)
    parent = {("c", i): ("c", i - 1) if i else None for i in range(200)}
    parent |= {("s", i): ("s", 0) if i else None for i in range(50)}
    parent |= {("r", i): ("r", rng.randrange(max(0, i - 6), i)) if i else None for i in range(400)}
    ids = {k: (zlib.crc32(repr(k).encode()), i) for i, k in enumerate(parent)}
    depth, total, kids = {}, {k: i for i, k in enumerate(parent)}, defaultdict(int)
    value = dict(total)
    for k, p in parent.items():
        depth[k] = depth[p] + 1 if p else 0
        kids[p] += 1
    for k in sorted(parent, key=lambda k: -depth[k]):
        if parent[k]:
            total[parent[k]] += total[k]
    tree = spark.createDataFrame([(*ids[k], *(ids[p] if p else (None, None)), depth[k], kids[k], value[k]) for k, p in parent.items()],
                                 "k1 long, k2 long, p1 long, p2 long, depth long, n_children long, w long")
    got = {(r.k1, r.k2): r.total for r in conversation_trie.subtree_sums(tree, {"total": F.col("w")}).collect()}
    assert got == {ids[k]: total[k] for k in parent}


# ---- periodic runs

def smallest_period(w):
    return next(p for p in range(1, len(w) + 1) if w[p:] == w[:-p] or p == len(w))


def brute_runs(w, shortest=24, repeats=3):
    n, out = len(w), []
    for q in range(1, n // repeats + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(shortest, repeats * q) and smallest_period(w[start:start + length]) == q:
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_texts():
    rng = random.Random(3)
    texts = [None, "", " \n ", "one", "ab " * 23, "ab " * 24, "ab " * 900, "a b " * 12, "a b c d e f g h " * 3, "a b c d e f g h i " * 3 + "a"]
    for _ in range(60):
        w = []
        for _ in range(rng.randrange(1, 6)):
            root = [rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 33]))]
            w += root * rng.randrange(1, 8) + root[:rng.randrange(len(root))] + [rng.choice("abcxyz") for _ in range(rng.randrange(4))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(w))
    block = ("a " * 30 + "b ") * 6
    return texts + [block, block + "c " + block, " ".join(str(i) for i in range(200)) * 4, ("x " * 5 + "y ") * 40 + ("x " * 7 + "z ") * 12]


def test_find_runs_equals_brute_force():
    texts = periodic_texts()
    assert sum(len(brute_runs(words(t))) for t in texts) > 60
    for shortest, repeats in ((24, 3), (12, 4), (40, 3), (2, 3)):
        of, start, length, period, stays = periodic_runs.runs_of_texts([(t or "").encode().split() for t in texts], shortest, repeats)
        got = list(zip(of.tolist(), start.tolist(), length.tolist(), period.tolist()))
        assert got == [(i, *r) for i, t in enumerate(texts) for r in brute_runs(words(t), shortest, repeats)]


def test_find_runs_of_long_texts_stays_linear():
    one = np.zeros(1_000_000, np.int64)
    assert [x.tolist() for x in periodic_runs.find_runs(one, np.full(len(one), len(one)))] == [[0], [1_000_000], [1]]
    big = np.tile(np.arange(70_000), 3)
    assert [x.tolist() for x in periodic_runs.find_runs(big, np.full(len(big), len(big)))] == [[0], [210_000], [70_000]]


def test_periodic_query(spark, monkeypatch):
    rows = [(i, t, "en", "s", 1, "x", 5) for i, t in enumerate(periodic_texts())]
    looping = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    rng = random.Random(9)
    rows += [(i, " ".join(rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.choice([0, 1, 30, 300]))), "en", "s", 1, "x", 5) for i in looping]
    rows += [(None, "z " * 40, "en", "s", 1, "x", 5), rows[6], (-3, "é" * 1_000_000, "en", "s", 1, "x", 5), (-4, "w " * 200_000, "en", "s", 1, "x", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, runs string, kept int"
    want = []
    for doc_id, text, *_ in rows:
        w = words(text)
        n = len(w)
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = [(0, n, 1)] if doc_id == -4 else brute_runs(w)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((doc_id, len(runs), *(best or (None,) * 3), math.floor(1000 * best[1] / best[2]) if best else None,
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    df = spark.createDataFrame(rows, schema).repartition(3)
    monkeypatch.setattr(queries, "documents", lambda *_: df)
    got = queries.op12_periodic_runs(spark, "")
    assert sorted_rows(got) == sorted(want, key=repr)
    assert periodic_runs.collapse(spark.createDataFrame([], schema)).count() == 0


# ---- parity-sketch join

def shingles(t):
    w = words((t or "").translate(LOWER))
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def near_corpus():
    rng = random.Random(17)
    vocabulary = [f"w{i}" for i in range(300)]

    def edited(w, share):
        return [rng.choice(vocabulary) if rng.random() < share else x for x in w]
    texts = [None, None, "", " \t", "one", "One", "two words", "x" * 1_000_000]
    for size in (5, 6, 9, 10, 12, 16, 20, 24, 30, 60, 100, 150, 400, 1500):
        base = [rng.choice(vocabulary) for _ in range(size)]
        texts += [" ".join(base), " ".join(base).upper(), " ".join(base + ["more"]), " ".join(base[1:])]
        texts += [" ".join(edited(base, share)) for share in (0.005, 0.01, 0.02, 0.03, 0.05, 0.3)]
        texts += [" ".join(base[:int(size * cut)]) for cut in (0.95, 0.9, 0.87, 0.86, 0.85, 0.84, 0.5)]
    hot = [rng.choice(vocabulary) for _ in range(80)]
    texts += [" ".join(edited(hot, 0.025)) for _ in range(60)]          # a group in which not all pairs are linked
    passage = " ".join(rng.choice(vocabulary) for _ in range(20))
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(30)) for _ in range(40)]
    rows = [(i if i != 20 else None, t, "en", "s", 1, 1, "x", "y") for i, t in enumerate(texts)]
    return rows + [rows[9], rows[9]]


NEAR = "doc_id long, text string, lang string, source string, n_chars long, id int, body string, root string"


def brute_components(rows, percent=85):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    n_links = 0
    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            n_links += 1
            root[find(j)] = find(i)
    low = defaultdict(list)
    for i in range(len(rows)):
        low[find(i)].append(rows[i][0])
    return n_links, [(r[0], len(s), min((x for x in low[find(i)] if x is not None), default=None)) for i, (r, s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("percent", [85, 70])
def test_parity_join(spark, percent):
    rows = near_corpus()
    df = spark.createDataFrame(rows, NEAR).repartition(4)
    n_links, want = brute_components(rows, percent)
    assert n_links > 300
    assert sorted_rows(parity_join.near_duplicates(df, percent=percent)) == sorted(want, key=repr)
    assert parity_join.near_duplicates(spark.createDataFrame([], NEAR)).count() == 0


def test_linked_sets_share_a_filed_block():
    """No link may hinge on a block that either set leaves out."""
    rng = np.random.default_rng(1)
    for percent in (85, 60):
        bands = parity_join.Bands.of(percent, 5000)
        assert all(b * 100 // percent <= bands.ends[i + 1] for i, b in enumerate(bands.ends[:-1]))
        for _ in range(1500):
            n = int(rng.integers(1, 200))
            both = rng.integers(0, 1 << 63, n).astype(np.uint64)
            more = int((100 - percent) * n / percent)
            k = int(rng.integers(0, more + 1))
            a = np.unique(np.concatenate((both, rng.integers(0, 1 << 63, k).astype(np.uint64))))
            b = np.unique(np.concatenate((both, rng.integers(0, 1 << 63, more - k).astype(np.uint64))))
            if len(a) == len(b) == n:
                continue
            assert 100 * n >= percent * (n + more)
            assert np.intersect1d(parity_join.block_keys(a, bands), parity_join.block_keys(b, bands)).size, (n, k, more)


def test_bit_sketch_bounds_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 400, int(rng.integers(1, 300))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        x, y = parity_join.bit_sketch(a), parity_join.bit_sketch(b)
        words_ = min(len(x), len(y))
        far = int(np.bitwise_count(parity_join.folded(x, words_) ^ parity_join.folded(y, words_)).sum())
        assert far <= len(np.setxor1d(a, b))
