"""Packing, capping, history and mixing."""

import itertools
import random
import types

import numpy as np
import pytest

from threadloom.llm import capping, history, mixing, packing
from threadloom.llm.words import common_in_order, near_same, words_of
from threadloom.session import Scratch


def test_hilbert_curve_visits_neighbours():
    for dims, levels in ((2, 4), (3, 3)):
        cells = sorted((packing.hilbert_key(list(p), levels), p) for p in itertools.product(range(1 << levels), repeat=dims))
        assert [k for k, _ in cells] == list(range(len(cells)))
        assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for (_, p), (_, q) in zip(cells, cells[1:]))


def test_packs_hold_every_text_once(spark):
    rng = random.Random(1)
    rows = [("c", n, "".join(rng.choice("ab ") for _ in range(rng.choice([1, 5, 30, 90]))) + "x", 0) for n in range(900)] + [("c", 1000, "y" * 555, 0), ("c", 1001, None, 0), ("c", 1002, "", 0), ("s", 1, "same", 0)]
    rows += [("d", n, "hot copy", 0) for n in range(500)]
    texts = spark.createDataFrame(rows, "table_name string, rec_no bigint, text string, capacity int")
    limits = spark.createDataFrame([("small", 100), ("large", 2000), (None, 5)], "pack_kind string, capacity_chars bigint")
    got = packing.pack(texts, limits).toPandas()
    size = {(t, n): len(x) for t, n, x, _ in rows if x}
    for kind, capacity in (("small", 100), ("large", 2000)):
        own = got[got.pack_kind == kind]
        assert own.groupby("pack_id").chars.sum().max() <= capacity
        assert own.groupby(["table_name", "rec_no"]).chars.sum().to_dict() == size
        cut = own[own.duplicated(["table_name", "rec_no"], keep=False)]
        assert all(size[t, n] > capacity for t, n in zip(cut.table_name, cut.rec_no))
        assert own.pack_id.nunique() <= 1.05 * sum(size.values()) / capacity + 2
    assert packing.pack(texts.limit(0), limits).count() == 0 and packing.pack(texts, limits.limit(0)).count() == 0


def test_pieces_rebuild_the_text():
    text = "ab cd " * 99 + "é" * 77
    parts = packing.pieces(text, 50)
    assert "".join(text[a : a + n] for a, n in parts) == text and max(n for _, n in parts) <= 50


@pytest.mark.parametrize("of_output", [False, True])
def test_capping_against_brute_force(spark, of_output):
    rng = random.Random(2)
    rows = [(f"i{n:04}", rng.choice([1, 2, None]), rng.choice(["hot"] * 8 + [f"u{k}" for k in range(12)] + [None]), rng.choice([None, 1, 2, 2, 3]), "x") for n in range(700)]
    df = spark.createDataFrame(rows, "id string, grp int, who string, quality int, cap string")
    got = {r.id for r in capping.beyond_limit(df, share=0.1, floor=2, of_output=of_output).collect()}
    want = set()
    for g in (1, 2, None):
        own = [r for r in rows if r[1] == g]
        by = {}
        for r in own:
            by.setdefault(r[2], []).append(r)
        free = len(by.pop(None, []))
        cap = max(2, len(own) // 10)
        if of_output:
            cap = max([c for c in range(2, 701) if c <= max(2, 0.1 * (free + sum(min(len(v), c) for v in by.values())) + 1e-9)], default=2)
            top = max(map(len, by.values()))
            cap = min(cap, top) if top <= cap else cap
        for v in by.values():
            v.sort(key=lambda r: (-(r[3] if r[3] is not None else -9), r[0]))
            want |= {r[0] for r in v[cap:]}
    assert got == want
    assert capping.beyond_limit(df.limit(0), share=0.1, floor=2, of_output=of_output).count() == 0


def test_water_level():
    assert capping.water_level([(100, 1), (1, 50)], 0.5) == 50 and capping.water_level([], 0.5, 2) == 2
    assert capping.water_level([(10, 4)], 0.1, 3) == 3 and capping.water_level([(10, 1), (5, 30)], 0.5) == 10


def test_words_in_order():
    assert words_of("It's A-b, c_d!") == ["it", "s", "a", "b", "c", "d"]
    rng = random.Random(3)
    for _ in range(80):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert common_in_order(a, b) == table[-1][-1]
        if a or b:
            assert near_same(a, b, 0.8) == (table[-1][-1] >= 0.8 * max(len(a), len(b)) - 1e-9)


def corpus(rng, n=260):
    words = [f"w{i}" for i in range(900)]
    base = [[rng.choice(words) for _ in range(rng.randint(40, 90))] for _ in range(n // 3)]
    rows = []
    for k in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2, int(len(text) * 0.06), int(len(text) * 0.5)])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((k + 1, f"t1_i{rng.randrange(n * 6)}" if rng.random() < 0.9 else None, k // 65, " ".join(text) if rng.random() < 0.9 else rng.choice(["", None, "short text"])))
    return rows


def brute(rows, low=0):
    out = {}
    for k, (rec, id_, _, text) in enumerate(rows):
        mine = words_of(text)
        for other, id2, _, text2 in rows[:k]:
            theirs = words_of(text2)
            if (id_ and id_ == id2) or (len(mine) >= 40 and len(theirs) >= 40 and near_same(mine, theirs, 0.8)):
                out[rec] = other
                break
    return {k: v for k, v in out.items() if k > low}


def test_duplicates_against_brute_force(spark):
    rows = corpus(random.Random(4))
    df = spark.createDataFrame([(*r, 1) for r in rows], "rec_no bigint, id string, batch_no int, body string, first int")
    want = brute(rows)
    got = {r.dup_rec_no: r.first_rec_no for r in history.duplicates_of(df, "body").collect()}
    assert set(got) <= set(want) and len([k for k in want if got.get(k) == want[k]]) >= 0.97 * len(want)
    last = {k: v for k, v in want.items() if k > 195}
    part = {r.dup_rec_no: r.first_rec_no for r in history.duplicates_in_batch(df, "body", 3).collect()}
    assert set(part) <= set(last) and len([k for k in last if part.get(k) == last[k]]) >= 0.95 * len(last)
    assert history.duplicates_of(df.limit(0), "body").count() == 0


def test_index_runs_merge(spark, monkeypatch):
    monkeypatch.setattr(history, "MAX_RUNS", 2)
    rows = corpus(random.Random(5), 120)
    df = history.batch_rows(spark.createDataFrame(rows, "rec_no bigint, id string, batch_no int, body string"), "body")
    scratch = Scratch(spark, "test")
    index = history.HistoryIndex(spark, f"{scratch.root}/index")
    for low in (0, 30, 60):
        index.add(history.Prepared(df.where(f"rec_no > {low} and rec_no <= {low + 30}"), Scratch(spark, "part")))
    assert len(index.runs) == 1
    batch = history.Prepared(df.where("rec_no > 90"), scratch)
    got = {r.dup_rec_no: r.first_rec_no for r in history.duplicates(batch, scratch, index).collect()}
    want = {k: v for k, v in brute(rows).items() if k > 90}
    assert set(got) <= set(want) and len([k for k in want if got.get(k) == want[k]]) >= 0.95 * len(want)


def test_hot_group_of_near_copies(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(400):
        text = list(base)
        text[rng.randrange(60)] = f"x{k}"
        rows.append((k + 1, f"i{k}", 0, " ".join(text)))
    df = spark.createDataFrame(rows, "rec_no bigint, id string, batch_no int, body string")
    got = {r.dup_rec_no: r.first_rec_no for r in history.duplicates_of(df, "body").collect()}
    assert got == {k: 1 for k in range(2, 401)}


def test_changes_scattered_to_the_edge_of_the_rule(spark):
    rng = random.Random(8)
    rows = []
    for k in range(300):
        n = rng.choice([40, 60, 100])
        text = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        copy = [w if i % 5 else f"x{k}n{i}" for i, w in enumerate(text)]  # every fifth word replaced
        rows += [(2 * k + 1, f"a{k}", 0, " ".join(text)), (2 * k + 2, f"b{k}", 0, " ".join(copy))]
    df = spark.createDataFrame(rows, "rec_no bigint, id string, batch_no int, body string")
    got = {r.dup_rec_no: r.first_rec_no for r in history.duplicates_of(df, "body").collect()}
    assert all(b - a == 1 and b % 2 == 0 for b, a in got.items())
    assert len(got) >= 0.97 * 300


def test_hot_group_whose_members_match_through_other_groups(spark):
    rng = random.Random(9)
    texts = [[f"w{k}n{i}" for i in range(40)] for k in range(60)]
    texts[19] = texts[59][:35] + ["a"] * 5  # the last one's first match, at place 20 of the hot group
    texts[49] = texts[59][:35] + ["b"] * 5  # a later match, also in a group of two
    entries = []
    for k in range(60):
        sigs = [(tree << 56) + rng.randrange(1 << 48) for tree in range(history.TREES)]
        sigs[0] = 77
        if k in (49, 59):
            sigs[1] = (1 << 56) + 55
        entries += [(sig, k + 1, 40, 0, 0, None) for sig in sigs]
    frame = spark.createDataFrame

    batch = types.SimpleNamespace(
        rows=frame([(k + 1, f"i{k}", bytes([k]), " ".join(t)) for k, t in enumerate(texts)], "rec_no bigint, id string, digest binary, text string"),
        entries=frame(entries, history._ENTRY),
    )
    got = {r.dup_rec_no: r.first_rec_no for r in history.duplicates(batch, Scratch(spark, "test")).collect()}
    assert got[60] == 20


def test_index_reopened_by_another_driver(spark):
    rows = corpus(random.Random(10), 120)
    df = history.batch_rows(spark.createDataFrame(rows, "rec_no bigint, id string, batch_no int, body string"), "body")
    scratch = Scratch(spark, "test")
    for low in (0, 45):
        history.HistoryIndex(spark, f"{scratch.root}/index").add(history.Prepared(df.where(f"rec_no > {low} and rec_no <= {low + 45}"), Scratch(spark, "part")))
    index = history.HistoryIndex(spark, f"{scratch.root}/index")
    assert len(index.runs) == 2
    got = {r.dup_rec_no: r.first_rec_no for r in history.duplicates(history.Prepared(df.where("rec_no > 90"), scratch), scratch, index).collect()}
    want = {k: v for k, v in brute(rows).items() if k > 90}
    assert set(got) <= set(want) and len([k for k in want if got.get(k) == want[k]]) >= 0.95 * len(want)


def test_quotas():
    have, target, repeats = {"a": 1000, "b": 10, "c": 50}, {"a": 0.5, "b": 0.2, "c": 0.2, "none": 0.1}, {"a": 1, "b": 4, "c": 1}
    exact = mixing.solve_quotas(have, target, repeats)
    assert exact["b"] == 40 and exact["none"] == 0 and abs(exact["a"] - 100) <= 1 and abs(exact["c"] - 40) <= 1
    more = mixing.solve_quotas(have, target, repeats, 500)
    assert more == {"a": 410, "b": 40, "c": 50, "none": 0}
    assert mixing.solve_quotas({}, target, repeats) == {"a": 0, "b": 0, "c": 0, "none": 0}


def test_splitting_tree_is_exact():
    out = mixing.split_quotas({"a": 1000, "b": 37, "c": 0}, 13)
    assert {s: int(v.sum()) for s, v in out.items()} == {"a": 1000, "b": 37, "c": 0}
    assert np.ptp(sum(out.values())) <= 1
    assert sorted(mixing.permuted(i, 101, b"k") for i in range(101)) == list(range(101))


def test_mix(spark):
    rng = random.Random(8)
    rows = [(n, "word " * rng.randint(5, 60), rng.choice(["Big One", "big_one ", "small", "other", None]) if n % 20 else "tiny", 0) for n in range(800)] + [(900, None, "small", 0), (901, "", "small", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copy int")
    targets = spark.createDataFrame([("big_one", 0.5, 1), ("SMALL", 0.3, 2), ("tiny", 0.1, 3), ("absent", 0.1, 5)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(docs, targets, shard_tokens=2000).cache()
    got = {r.source: r for r in mixing.shares(mixed, targets).collect()}
    assert all(abs(got[s].share - t / 0.9) < 0.01 for s, t in (("big_one", 0.5), ("small", 0.3), ("tiny", 0.1))) and got["absent"].tokens == 0
    assert all(r.repeats <= r.max_repeats for r in got.values())
    assert mixed.count() == mixed.select("source", "doc_id", "copy").distinct().count() == mixed.select("shard", "position").distinct().count()
    assert mixed.select("shard").distinct().count() > 2
    assert mixing.mix(docs.limit(0), targets).count() == 0 and mixing.mix(docs, targets.limit(0)).count() == 0


def test_giant_texts_with_sentences_in_another_order_are_no_candidates(spark, monkeypatch):
    rng = random.Random(11)
    sentences = [[f"w{rng.randrange(300)}" for _ in range(8)] for _ in range(60)]
    texts = [[w for s in rng.sample(sentences, 60) for w in s] for _ in range(50)]
    copies = []
    for k, text in enumerate(texts[:10]):
        if k % 2:  # every fifth word replaced
            copies.append([w if i % 5 else f"x{k}n{i}" for i, w in enumerate(text)])
        else:  # a block of a fifth replaced
            copies.append(text[:100] + [f"y{k}n{i}" for i in range(90)] + text[190:])
    df = spark.createDataFrame([(k + 1, f"i{k}", 0, " ".join(t)) for k, t in enumerate(texts + copies)], "rec_no bigint, id string, batch_no int, body string")
    verified, verify = [], history._verify
    monkeypatch.setattr(history, "_verify", lambda pairs, *more: verified.append(pairs.count()) or verify(pairs, *more))
    got = {r.dup_rec_no: r.first_rec_no for r in history.duplicates_of(df, "body").collect()}
    assert got == {51 + k: k + 1 for k in range(10)}
    assert sum(verified) <= 300  # of 1,225 pairs


@pytest.mark.parametrize("most", [3, 10**6])
def test_blocks_of_large_groups_give_the_candidates_of_single_places(monkeypatch, most):
    rng = np.random.default_rng(12)
    size = 700
    key = np.repeat([1, 2, 3], [500, 1, 199])
    n = rng.choice([40, 45, 60, 400], size).astype(np.int32)
    sketch = rng.integers(0, 2**63, (12, history.SKETCH), np.uint64)[rng.integers(0, 12, size)]
    many = np.tile(rng.integers(0, 255, (5, 2 * history.MANY), np.uint8), (size, 1))[: int((n > history.GIANT).sum())]
    signed = np.where(np.arange(size) % 7 == 0, -n, n)
    run = lambda after: sorted(zip(*history._compare(key, np.arange(size) * 3, signed, sketch, many, after, 0.8, most).to_pydict().values()))
    later = np.where(np.arange(size) % 3 == 0, 120, np.iinfo(np.int64).max)
    want = [run(None), run(later)]
    monkeypatch.setattr(history, "PLACES", 4)
    monkeypatch.setattr(history, "BLOCK", 16)
    assert [run(None), run(later)] == want and all(want)
    monkeypatch.setattr(history, "PLACES", size)
    assert [run(None), run(later)] == want
