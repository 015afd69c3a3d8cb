"""Corpus operators against brute force, exact round trips and edge cases:
nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""
import hashlib
import re
import string

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plenum.llm import (chunk_dedup, cotrain, decontaminate, language_id, phrase_dedup, piece_table, quote_threads,
                        reshard, toxicity, weighted_minhash)
from plenum.llm.queries import model_path

LONG = "lorem ipsum dolor " * 3000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, recipe string, c0 string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t else None, "x", "y") for i, t in rows], SCHEMA)


HARD = [(1, "a b  c"), (2, "abc"), (3, None), (4, ""), (5, " \t"), (6, LONG), (7, LONG + " "), (8, "a b  c"), (2, "abc"),
        (None, "no id"), (9, "été ☃ x")]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_groups_match_brute_force(spark, bits):
    got = chunk_dedup.exact_groups(docs_of(spark, HARD), first_bits=bits, min_chunk=16, max_chunk=64).collect()
    assert len(got) == len(HARD)
    groups = {}
    for i, t in HARD:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    for r in got:
        key = next(k for k in groups if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(groups[key]) and r.keep_id == min(groups[key])[2]
    assert sum(r.kept for r in got) == len(groups)
    kept = chunk_dedup.drop_copies(docs_of(spark, HARD))
    assert kept.columns == docs_of(spark, HARD).columns and kept.count() == len(groups)
    assert chunk_dedup.exact_groups(docs_of(spark, []).limit(0)).count() == 0


def brute_hits(text, items):
    w = decontaminate.split_words((text or "").encode())
    hit, ids = set(), set()
    for item, t in items:
        iw = decontaminate.split_words((t or "").encode())
        n = min(13, len(iw))
        for a in range(len(iw) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == iw[a:a + n]:
                    hit.update(range(p, p + n))
                    ids.add(str(item))
    return len(w), len(hit), ids


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_contamination_matches_brute_force(spark, block):
    words = "alpha beta gamma delta".split()
    rng = np.random.default_rng(3)
    say = lambda n: " ".join(rng.choice(words, n))
    items = [(i, say(n)) for i, n in enumerate([20, 14, 13, 5, 1])] + [(7, "Zeta ETA"), (8, ""), (9, None), (None, "q")]
    rows = [(i, say(40)) for i in range(6)] + [(20, items[0][1].upper() + " zeta, eta!"), (21, None), (22, ""), (23, "zeta")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs_of(spark, rows), bench, block_bytes=block).collect()
    assert len(got) == len(rows)
    for r in got:
        n, hit, ids = brute_hits(dict(rows)[r.doc_id], [x for x in items if x[0] is not None])
        assert (r.n_words, r.n_hit, set(r["items"])) == (n, hit, ids)
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
    kept = decontaminate.drop_contaminated(docs_of(spark, rows), bench, block_bytes=block)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.contaminated}


def test_no_benchmark_leaves_documents_clean(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(docs_of(spark, HARD), bench).collect())


def test_toxicity_clauses_and_learned_patterns(spark):
    g = toxicity.Grammar()
    plain, aimed = g.match_text(b"what an idiot"), g.match_text(b"you are an idiot")
    denied, told = g.match_text(b"that is not idiot"), g.match_text(b"she said idiot")
    assert denied[0][1] < plain[0][1] < aimed[0][1] and told[0][1] < aimed[0][1]
    assert g.match_text(b"kill the process") == [] and g.match_text(b"i will kill you")
    rows = [(i, ("zorpu%d und " % i) * 2 + "das haus" if i % 4 == 0 else "das haus ist gross") for i in range(1, 161)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(None, 1), (5000, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(spark, rows), labels)
    assert any(p.startswith(b"zorp") for p, _ in model.grammar.learned)
    got = {r.doc_id: r for r in toxicity.score_documents(docs_of(spark, rows + [(900, None), (901, "")]), model).collect()}
    assert all(got[i].predicted == int(i % 4 == 0) for i, _ in rows) and got[900].score == got[901].score < 0.5
    assert toxicity.drop_toxic(docs_of(spark, rows), model).count() == sum(i % 4 > 0 for i, _ in rows)
    empty = toxicity.fit(docs_of(spark, []), labels.limit(0))
    assert empty.score([]) < 0.5


def test_toxicity_reads_whole_clauses():
    g = toxicity.Grammar()
    for before in (0, 38, 39, 40, 41, 200):  # 'kill' is word 40 and 'you' word 41 where 39 come before
        assert len(g.match_text(b"word " * before + b"kill you")) == 1
        assert g.match_text(b"word " * before + b"not idiot") == g.match_text(b"not idiot")
        assert g.match_text(b"she said " + b"word " * before + b"idiot") == g.match_text(b"she said idiot")
        assert g.match_text(b"you " + b"word " * before + b"idiot") == g.match_text(b"you idiot")
    for mark in "\uff01\u3002\uff0c\u060c\u0964\u2026\u201d":
        assert g.match_text(f"kill it{mark} you".encode()) == []
        assert g.match_text(f"you\u00e9{mark}idiot{mark}you".encode()) == g.match_text(b"idiot")


def brute_repeats(rows, length):
    first, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first.setdefault(b[p:p + length], i) < i:
                gone[p:p + length] = True
        out[i] = (len(b), int(gone.sum()), np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


@pytest.mark.parametrize("many", [20_000, 1])
def test_repeats_match_brute_force(spark, many):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcé"), 3))
    shared = " ".join(word() for _ in range(40))
    rows = [(i, " ".join(word() for _ in range(30)) + (shared[i:100 + i] if i % 2 else "")) for i in range(12)]
    rows += [(50, "a" * 300), (51, "a" * 120), (52, None), (53, ""), (54, "short"), (55, rows[1][1])]
    got = phrase_dedup.remove_repeats(docs_of(spark, rows), many=many).collect()
    want = brute_repeats(rows, 50)
    assert {r.doc_id: (r.n_bytes, r.n_removed, bytes(r.kept)) for r in got} == want
    assert all(r.n_spans == len(r.spans) for r in got)
    assert phrase_dedup.remove_repeats(docs_of(spark, [])).count() == 0


def test_near_duplicates(spark):
    rng = np.random.default_rng(9)
    base = ["".join(rng.choice(list(string.ascii_lowercase), 6)) for _ in range(300)]
    near = base[:150] + ["changed"] + base[151:]
    other = ["".join(rng.choice(list(string.ascii_lowercase), 6)) for _ in range(300)]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(other)), (4, " ".join(base).upper()), (5, None), (6, ""),
            (7, "!!!"), (8, "two words"), (9, "two words"), (10, "!!!"), (11, " ".join(base[:100])), (None, " ".join(base)),
            (12, LONG)]
    got = {r.doc_id: r for r in weighted_minhash.near_duplicates(docs_of(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert got[1].class_id == got[2].class_id == got[4].class_id == 1 and got[9].class_id == 8 and got[10].class_id == 7
    assert [i for i in (3, 5, 6, 11, 12) if got[i].class_size != 1] == [] and got[1].class_size == 3
    kept = weighted_minhash.keep_one_of_each(docs_of(spark, rows))
    assert {r.doc_id for r in kept.collect()} == {1, 3, 5, 6, 7, 8, 11, 12, None}


def test_document_frequencies_are_counted_per_shingle(spark):
    rng = np.random.default_rng(21)
    say = lambda n: ["".join(x) for x in rng.choice(list(string.ascii_lowercase), (n, 7))]
    one = say(99)
    two = [*one[:30], "changed", *one[31:60], "altered", *one[61:]]
    pair = [" ".join(one).encode(), " ".join(two).encode()]
    s, _, start = weighted_minhash.shingle_sets(pair, 5)
    lone = np.setxor1d(s[:start[1]], s[start[1]:])
    assert len(lone) == 20
    # Texts of one shingle each with the first 20 bits of a shingle that only one of the two has.
    words, fillers = say(4000), []
    while len(fillers) < 20:
        more = [" ".join(x).encode() for x in rng.choice(words, (200_000, 5))]
        h = weighted_minhash.shingle_sets(more, 5)
        assert len(h[0]) == len(more)
        fillers += [more[i].decode() for i in np.flatnonzero(np.isin(h[0] >> np.uint64(44), lone >> np.uint64(44)))]
    rows = [(1, pair[0].decode()), (2, pair[1].decode()), *((10 + i, t) for i, t in enumerate(fillers[:20]))]
    rare, common = 1.5, 1 + 0.5 * (1 - np.log(2) / np.log(22))
    assert 0.79 < 85 * common / (85 * common + 20 * rare) < 0.8 < 85 / (85 + 20)
    got = {r.doc_id: r.class_size for r in weighted_minhash.near_duplicates(docs_of(spark, rows)).collect()}
    assert got[1] == got[2] == 1

    want = {}
    rows += [(40, rows[0][1]), (41, None), (None, rows[0][1]), (42, "one two")]
    for _, t in rows:
        for x in weighted_minhash.shingle_sets([(t or "").encode()], 5)[0]:
            want[x] = want.get(x, 0) + 1
    units = weighted_minhash._units(weighted_minhash.id_and_text(docs_of(spark, rows)))
    signed = weighted_minhash._signed(units, len(rows), 14, 5, 5, 0.5).collect()
    assert len(signed) == len(rows) - 1
    for r in signed:
        keys = weighted_minhash.shingle_sets([r.text.encode()], 5)[0]
        assert np.frombuffer(r.dfs, np.uint32).tolist() == [want[x] for x in keys]


def test_sampling_agrees_with_weighted_jaccard():
    rng = np.random.default_rng(1)
    a = np.sort(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    b = np.sort(np.concatenate([a[:320], rng.integers(0, 1 << 63, 80).astype(np.uint64)]))
    weight = lambda s: (1 + (s % np.uint64(7)).astype(np.float32) / 7).astype(np.float32)
    want = weighted_minhash.weighted_jaccard(a, weight(a), b, weight(b))
    s = np.concatenate([a, b])
    sig = weighted_minhash.signatures(s, weight(s), np.array([0, len(a), len(s)]), weighted_minhash.draws(400))
    assert abs((sig[0] == sig[1]).mean() - want) < 0.08


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁ab\n\t"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_word_table_equals_the_library(pieces, text):
    table = piece_table.encoder(pieces)
    (ids, listed), = table([text])
    assert ids == pieces.encode(text) and listed == ",".join(map(str, ids)).encode()


def test_encoding_and_round_trip(spark, pieces):
    model = piece_table.read_model(model_path())
    got = piece_table.encode_documents(docs_of(spark, HARD), model).collect()
    assert len(got) == len(HARD)
    for r in got:
        assert r.n_tokens == len(r.ids) and r.decoded == pieces.decode(r.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
    kept = piece_table.keep_round_trips(docs_of(spark, HARD), model)
    assert kept.columns[-2:] == ["n_tokens", "round_trip"] and all(r.round_trip for r in kept.collect())


def test_language_by_byte_network(spark):
    rng = np.random.default_rng(2)
    say = lambda s: " ".join("".join(rng.choice(s, 2)) for _ in range(60))
    rows = [(i, say(["tha", "ing", "ou"] if i % 2 else ["sch", "ung", "ü"]), "en" if i % 2 else "de") for i in range(120)]
    d = spark.createDataFrame(rows + [(500, None, "en"), (501, "12 34", "de"), (502, "", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.predict(d, language_id.fit(d)).collect()}
    assert np.mean([got[i].lang_pred == l for i, _, l in rows]) > 0.95
    assert [got[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3
    assert language_id.fit(d.limit(0)) is None


def test_flow_moves_the_fewest_bytes():
    flow = reshard.plan_transfers([100, 20, 0], [40, 40, 40])
    assert [sum(r) for r in flow] == [100, 20, 0] and [sum(c) for c in zip(*flow)] == [40, 40, 40]
    assert sum(flow[i][j] for i in range(3) for j in range(3) if i != j) == 60
    with pytest.raises(ValueError):
        reshard.min_cost_flow([5], [4], lambda i, j: 0)


def test_reshard_and_rewrite(spark, tmpdir_path):
    rows = [(i, "x" * (i % 50)) for i in range(600)] + [(3, None), (700, None)]
    d = docs_of(spark, rows)
    from pyspark.sql import functions as F
    got = reshard.reshard(d, F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.col("doc_id")), 5, 4, block_rows=50)
    out = got.toPandas()
    assert len(out) == len(rows) and set(out.law) == {"bytes"} and out.grown_shard.isna().all()
    by = out.groupby("shard")
    assert by["size"].sum().max() - by["size"].sum().min() < 6 * 60
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in by)
    done = reshard.rewrite(d, got, tmpdir_path + "/shards").toPandas()
    assert done.rows.sum() == len(rows) and done.bytes.sum() == out["size"].sum()
    assert reshard.reshard(docs_of(spark, []), F.lit(0), 5, 4).count() == 0


def test_cotraining_beats_the_majority(spark):
    rng = np.random.default_rng(4)
    words = lambda v, n: " ".join(rng.choice(v, n))
    rows = [(i, words(["good", "fine", "prose", "text"] if i % 3 else ["%%%", "JUNK", "xx", "!!"], 30 + i % 7), "en", f"s{i % 3}", 99)
            for i in range(300)]
    d = spark.createDataFrame(rows + [(900, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 300, 2)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in cotrain.score_documents(d, cotrain.fit(d, labels)).collect()}
    assert np.mean([(got[i] >= 0.5) == (i % 3 > 0) for i in range(300)]) > 0.95 and 0 <= got[900] <= 1
    assert cotrain.fit(d, labels.limit(0)) is None
    assert {r.score for r in cotrain.score_documents(d, None).collect()} == {0.5}


def test_threads_from_quotations(spark):
    rows = [(1, 0, "user", "Hello there.\nSecond line"), (1, 1, "assistant", "> Hello there.\n> Second line\n\nAnswer"),
            (1, 2, "user", "> > hello THERE\n> > second line\n> Answer\nThanks"), (1, 3, "user", "> unknown words\nNew"),
            (2, 0, "user", None), (2, 1, "user", "> \nempty quote"), (None, 0, "user", "> Answer"), (1, 4, "user", ">Thanks")]
    got = {(r.conv_id, r.turn): r for r in quote_threads.thread(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert len(got) == len(rows)
    assert [got[1, t].reply_to for t in range(5)] == [None, 0, 1, None, 2]
    assert [got[1, t].reply_depth for t in range(5)] == [0, 1, 2, 0, 3] and got[1, 4].root_turn == 0
    assert got[1, 2].content == "Thanks" and got[2, 0].content == "" and got[2, 1].n_quotes == 0
    assert quote_threads.thread(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("bits", [16, 2])
def test_quotes_link_to_the_latest_holder(spark, monkeypatch, bits):
    monkeypatch.setattr(quote_threads, "BLOCK_BITS", bits, raising=False)
    rng = np.random.default_rng(8)
    say = ["ok", "thanks", "yes please", "no"]
    texts = {(c, int(t)): str(rng.choice(say)) for c in (1, 2) for t in rng.choice(400, 90, replace=False) - 100}
    texts |= {(3, 0): "First line.\nSecond line\n\nNew paragraph\nof two lines", (3, 7): "second LINE"}
    quoted = {k: str(rng.choice(say)) for k in texts if k[0] < 3}
    quoted |= {(3, 1): "Second line", (3, 2): "new paragraph of two lines", (3, 8): "Second line", (3, 9): "no such line"}
    rows = [(*k, "user", (f"> {quoted[k]}\n" if k in quoted else "") + texts.get(k, "")) for k in {*texts, *quoted}]
    got = {(r.conv_id, r.turn): r.reply_to for r in quote_threads.thread(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for c, t in (k for k in quoted if k[0] < 3):
        assert got[c, t] == max((u for d, u in texts if d == c and u < t and texts[d, u] == quoted[c, t]), default=None)
    assert [got[3, t] for t in (1, 2, 8, 9)] == [0, 0, 7, None]
