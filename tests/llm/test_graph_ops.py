"""Prefix trie, Merkle manifest and embedding links against brute force."""
import zlib
from hashlib import sha256

import numpy as np
import pytest

from plenum.llm import merkle, ranks, turn_trie, vector_lsh

TURNS = "conv_id long, turn long, role string, text string"


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- trie

def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c in own:
        n = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        seqs[c] = own.get(base, [])[:n] + own[c][n:]
    nodes = {tuple(s[:d]) for s in seqs.values() for d in range(len(s) + 1)}
    out = []
    for p in nodes:
        d = len(p)
        members = sorted(c for c, s in seqs.items() if tuple(s[:d]) == p)
        below = [q for q in nodes if q[:d] == p]
        size = {q: sum(tuple(s[:len(q)]) == q for s in seqs.values()) for q in below}
        parent = min((c for c, s in seqs.items() if tuple(s[:d - 1]) == p[:-1]), default=None) if d else None
        leaves = sum(not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in nodes) for q in below)
        out.append((members[0], d, parent, len(members), sum(len(q) == d + 1 for q in below), leaves,
                    sum((size[q] - 1) * len(q[-1][1]) for q in below if q),
                    h(",".join(str(c) for c in members if len(seqs[c]) == d))))
    return sorted(out, key=str)


def trie(df):
    return sorted(map(tuple, turn_trie.prefix_nodes(df).collect()), key=str)


def test_trie_matches_brute_force_with_edge_cases(spark):
    rng = np.random.default_rng(5)
    words = ["a", "b", "é", "", "long text " * 40]
    rows = [(int(c), int(t), ["user", "assistant", None][rng.integers(3)], words[rng.integers(len(words))])
            for c in [*range(-3, 40), *range(200, 206), 331] for t in range(rng.integers(0, 5))]
    rows += [(c, t, "user", "same") for c in range(600, 680) for t in range(9)]          # copies, deeper than a borrowed start
    rows += [(7, None, "system", "x"), (7, 1, None, None), (7, 1, None, None), (9, 0, "user", None), (None, 1, "user", "y")]
    rows += [(800, t, "user", str(t)) for t in range(70)] + [(801, t, "user", str(t)) for t in range(66)]
    assert trie(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)


def test_trie_extra_columns_and_empty_tables(spark):
    rows = [(1, 0, "user", "a", 5, "k"), (2, 0, "user", "a", 6, "l")]
    df = spark.createDataFrame(rows, TURNS + ", pos int, key string")
    assert trie(df) == brute_trie([r[:4] for r in rows])
    assert trie(spark.createDataFrame([], TURNS)) == []
    assert trie(spark.createDataFrame([(None, 1, "user", "a")], TURNS)) == []


def test_shard_nodes_do_not_depend_on_the_cut(spark):
    rows = [(c, t, "user", f"{(c * 7 + t) % 3}") for c in range(120) for t in range(1 + c % 4)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in ("1", "3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(trie(spark.createDataFrame(rows, TURNS)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] == brute_trie(rows)


def test_ternary_tree_is_balanced_by_medians():
    tree = turn_trie.TernaryTree()
    tree.insert_medians([[i] for i in range(1023)])

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.root) == 10 and len(list(tree.walk())) == 1023


def test_members_of_one_sequence_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "ID_BLOCK", 7)
    df = spark.range(1000).selectExpr("id AS conv_id", "cast(id % 3 = 0 as string) AS k").selectExpr("unhex(md5(k)) AS seq_key", "conv_id")
    found = {r.conv_id: (r.n, r.ends_sha256) for r in turn_trie.same_sequences(df).collect()}
    hot, rest = [i for i in range(1000) if i % 3 == 0], [i for i in range(1000) if i % 3]
    assert found == {0: (len(hot), h(",".join(map(str, hot)))), 1: (len(rest), h(",".join(map(str, rest))))}


# ---------------------------------------------------------------- ranks

def test_ranks_of_a_group_over_many_tasks(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 50)) AS g", "(id * 7919) % 3001 AS v")
    got = {(r.g, r.v): r.pos for r in ranks.ranked(df, "g", ["v"], ["g", "v"]).collect()}
    for g in {k[0] for k in got}:
        assert [got[g, v] for v in sorted(v for x, v in got if x == g)] == list(range(sum(x == g for x, _ in got)))
    assert ranks.ranked(df.where("false"), "g", ["v"], ["g", "v"]).count() == 0


# ---------------------------------------------------------------- manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_manifest(rows):
    def leaf(doc, text, lang, source, n):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))

    def up(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def kin(levels, i):
        out = []
        for level in levels[:-1]:
            run, at = level[i // 8 * 8:i // 8 * 8 + 8], i % 8
            out.append(("".join(run[:at]), "".join(run[at + 1:])))
            i //= 8
        return out

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    keys = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = [up([x[2] for x in sorted(langs[k], key=lambda x: x[:3])]) for k in keys]
    top = up([t[-1][0] for t in trees])
    out = []
    for j, k in enumerate(keys):
        for i, (_, _, digest, r) in enumerate(sorted(langs[k], key=lambda x: x[:3])):
            path = kin(trees[j], i) + kin(top, j)
            now = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                now = leaf(r[0], r[1] and r[1].translate(lower), *r[2:])
            for a, b in path:
                now = h(a + now + b)
            out.append((r[0], digest, trees[j][-1][0], top[-1][0], h("".join(a + b for a, b in path)), now, now == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 5000, "de": 9, None: 1, "é": 64, "": 3}, {f"l{i}": 1 + i % 9 for i in range(70)}])
def test_manifest_matches_brute_force(spark, sizes):
    rows, n = [], 0
    for lang, m in sizes.items():
        for _ in range(m):
            rows.append((n, [f"Text {n}", None, "", "ÄÖ lower", "UPPER " * 50][n % 5], lang, [None, "web"][n % 2], n if n % 4 else None))
            n += 1
    assert sorted(map(tuple, merkle.manifest(spark.createDataFrame(rows, DOCS)).collect()), key=str) == brute_manifest(rows)


def test_manifest_nulls_repeats_clashes_and_empty(spark):
    rows = [(None, "A", "en", "s", 1), (3, "Same", "en", None, None), (3, "Same", "en", None, None), (3, "Other", "en", None, None), (6, "B" * 100000, None, "s", 2)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DOCS + ", leaf string, pos int, grp int")
    assert sorted(map(tuple, merkle.manifest(df).collect()), key=str) == brute_manifest(rows)
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []


# ---------------------------------------------------------------- embeddings

def brute_links(rows):
    vecs = []
    for i, v in rows:
        ok = i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        vecs.append(np.array(v, float) / np.abs(np.array(v, float)).max() if ok else None)
    near = [[b for b, y in enumerate(vecs) if b != a and x is not None and y is not None and len(x) == len(y)
             and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95] for a, x in enumerate(vecs)]
    out = []
    for a, (i, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        comp = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        out.append((i, len(near[a]), comp, i is None or i == comp))
    return sorted(out, key=str)


def embedding_rows(seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((60, 32))
    out = [v for v in base]
    out += [base[0] + rng.standard_normal(32) * s for s in np.linspace(0.02, 0.2, 120)]      # a large group, some of it at the rim
    out += [base[1] + rng.standard_normal(32) * 0.3 for _ in range(40)]                      # around the threshold
    chain = rng.standard_normal((2, 32))
    out += [chain[0] * np.cos(t) + chain[1] * np.sin(t) for t in np.arange(0, 3, 0.2)]       # linked only step by step
    out += [base[0]] * 30 + [base[2] * 1000, base[2] * 1e-9]
    return [[float(x) for x in v] for v in out]


def test_links_match_brute_force(spark):
    rows = list(enumerate(embedding_rows()))
    got = sorted(map(tuple, vector_lsh.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()), key=str)
    want = brute_links(rows)
    total, found = sum(r[1] for r in want), sum(r[1] for r in got)
    assert 0.98 * total <= found <= total
    close = [r for r in want if r[0] < 180 and r[1] > 100]
    assert len(close) > 100 and [g for g, w in zip(got, want, strict=True) if w in close and g[2] != w[2]] == []
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_links_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, -0.0]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]),
            (10, [1.0, 0.0, 0.0]), (11, [-3.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (12, [1.0, 0.3286841]), (13, [1.0, 0.32868411])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, node int, key string")
    assert sorted(map(tuple, vector_lsh.near_vectors(df).collect()), key=str) == brute_links(rows)
    assert vector_lsh.near_vectors(df.where("false")).collect() == []
    huge = [(1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [1e200, -1e200])]
    assert [tuple(r)[1] for r in sorted(vector_lsh.near_vectors(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect())] == [1, 1, 0]


def test_tables_grow_slowly_and_meet_their_recall():
    for n in (10, 10**4, 10**6, 10**9):
        tables, hashes = vector_lsh.tables_for(n)
        near, far = vector_lsh.collision(np.sqrt(0.1)), vector_lsh.collision(np.sqrt(2))
        assert 1 - (1 - near**hashes) ** tables >= 0.98 and n * far**hashes * tables <= 1
    assert vector_lsh.tables_for(10**9)[0] < (10**9 / 10**4) ** 0.25 * vector_lsh.tables_for(10**4)[0]
