from __future__ import annotations

import random

import numpy as np
import pytest
from llm_fixtures import edge_docs, edge_texts, linked_components, make_docs, no_docs, shingles, story, words  # noqa: F401

from timepoint.llm import common, near_dedup, substring_dedup
from timepoint.llm.components import components


def mutated(text, edits, seed):
    rng, w = random.Random(seed), text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.random()}"
    return " ".join(w)


@pytest.fixture(scope="module")
def families():
    """Families of copies with few and many edits, a popular original among them."""
    texts = []
    for family in range(6):
        base = story(f"f{family}", 90 + 40 * family)
        texts += [mutated(base, edits, 100 * family + edits) for edits in (3, 0, 1, 1, 2, 5, 0, 2)]
    return texts + [story(f"lone{i}", 60) for i in range(20)]


def as_dict(rows):
    return {r.doc_id: r.component_id for r in rows}


@pytest.mark.parametrize("block", [4, 64])
def test_components_equal_brute_force(make_docs, families, block):
    rows = near_dedup.near_duplicates(make_docs(families), block=block).collect()
    expected = linked_components(dict(enumerate(families)))
    assert as_dict(rows) == expected
    assert {r.doc_id for r in rows if r.kept} == {i for i, c in expected.items() if i == c}
    assert all(r.n_shingles == len(shingles(families[r.doc_id])) for r in rows)


def test_edge_rows(edge_docs):
    rows = near_dedup.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    expected = linked_components(dict(enumerate(edge_texts())))
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id is not None} == set(expected.items())
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    kept = near_dedup.without_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(expected.values()))
    assert ids.count(None) == 2


def test_empty_tables(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0
    assert near_dedup.without_near_duplicates(no_docs).columns == no_docs.columns
    assert substring_dedup.repeated_passages(no_docs).count() == 0
    assert substring_dedup.cut_repeats(no_docs).columns == no_docs.columns


def test_links_of_a_block_are_a_forest():
    sets = [np.unique(np.arange(100, dtype=np.uint64) + np.uint64(i)) for i in range(30)]
    signs = np.stack([near_dedup.signature(s).astype(np.uint8) for s in sets])
    found = near_dedup.links_of_block(list(range(30)), sets, signs, np.zeros(30, int), 85)
    assert len(found) <= 29 and len(found) >= 28


def test_pruning_bounds_rise_with_the_evidence():
    needed = near_dedup.fewest_matches()
    assert needed == sorted(needed) and 0 < needed[-1] < near_dedup.HASHES
    assert near_dedup.fewest_matches(miss=1e-2)[-1] > needed[-1]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 400)] + [(5, 5)]
    rows = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    found = {r.node: r.component for r in rows}
    assert found == {i: 100 for i in range(100, 161)} | {7: 7} | {i: 7 for i in range(300, 400)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_compact_windows_hold_every_subsequence_once():
    rng = np.random.default_rng(3)
    for n, t in ((40, 5), (300, 7), (130, 1), (6, 7)):
        hashes = rng.integers(0, 50, n).astype(np.uint64)
        windows = substring_dedup.compact_windows(hashes, t)
        for a in range(n):
            for b in range(a + t - 1, n):
                around = [(l, c, r) for l, c, r in windows if l <= a <= c <= b <= r]
                assert len(around) == 1
                assert hashes[around[0][1]] == hashes[a : b + 1].min()


@pytest.fixture(scope="module")
def with_passages():
    passage, other = story("p", 60), story("q", 90)
    near = other.split(" ")
    near[45] = "changed"
    return [
        story("c0", 100),
        f"{story('c1', 80)} {passage} {story('d1', 30)}",
        f"{story('c2', 20)}\n{passage.upper()}\n{story('d2', 70)}",
        passage,
        f"{other} {story('c4', 40)}",
        f"{story('c5', 40)} {' '.join(near)}",
        f"{story('c6', 70)} {' '.join(passage.split(' ')[:20])} {story('d6', 30)}",
        story("c7", 20),
    ]


def test_passages_are_found_and_cut(make_docs, with_passages):
    docs = make_docs(with_passages)
    rows = {r.doc_id: r for r in substring_dedup.repeated_passages(docs).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert [(s.start, s.stop) for s in rows[2].removable] == [(20, 80)]
    assert [(s.start, s.stop) for s in rows[1].passages] == [(80, 140)]
    assert rows[1].n_removable == 0 and rows[1].first_doc_id == 1 and rows[2].first_doc_id == 1
    assert rows[5].n_removable == 90
    left = {r.doc_id: r for r in substring_dedup.cut_repeats(docs).collect()}
    assert sorted(left) == [0, 1, 2, 4, 5, 6, 7]  # nothing is left of 3
    assert words(left[2].text) == words(f"{story('c2', 20)} {story('d2', 70)}")
    assert left[2].n_chars == len(left[2].text)
    assert all(left[i].text == with_passages[i] for i in (0, 1, 4, 6, 7))


def test_passages_of_edge_rows(edge_docs):
    left = substring_dedup.cut_repeats(edge_docs)
    assert left.columns == edge_docs.columns
    texts = [r.text for r in left.collect()]
    # without words to begin with, or without an id, a row stays as it is
    assert texts.count(None) == 2 and "" in texts and "no id here" in texts
    assert sum(1 for t in texts if t and t.lower().startswith("wax")) == 2  # id 5, both rows of it


def test_a_passage_that_many_share_costs_one_row_each(make_docs):
    passage = story("hot", 70)
    docs = make_docs([f"{story(f'm{i}', 60)} {passage} {story(f'n{i}', 20)}" for i in range(60)])
    rows = substring_dedup.repeats(docs).collect()
    assert len(rows) == 59 and {r.leader for r in rows} == {0}
    assert all(words(passage) and r.stop - r.start == 70 for r in rows)


def hashed(text):
    return next(substring_dedup.shingled([text], substring_dedup.WordHashes()))


@pytest.mark.parametrize("swap", [False, True])
def test_segments_use_every_place_of_a_shingle(swap):
    p = story("p", 60).split(" ")
    leader = hashed(" ".join([*p[:40], story("between", 30), *p]))
    own = hashed(" ".join(p))
    found = substring_dedup.segments(*((leader, own) if swap else (own, leader)), 46, 0.8)
    place = (70, 126, 0, 56) if swap else (0, 56, 70, 126)
    assert place in found


def test_segments_split_passages_that_touch():
    p = mutated(story("p", 60), 0, 1).split(" ")
    q = story("q", 60)
    near = [*p[:25], "x", *p[26:]]  # runs of 21 and 30 shingles
    own = hashed(" ".join([*near, q]))
    leader = hashed(" ".join([q, story("between", 200), *p]))
    found = substring_dedup.segments(own, leader, 46, 0.8)
    covered = {i for start, stop, *_ in found for i in range(start, stop)}
    assert covered >= set(range(56)) and covered >= set(range(60, 116))


def test_segments_of_texts_that_repeat_themselves(monkeypatch):
    monkeypatch.setattr(substring_dedup, "_PAIRS", 500)
    own, other = hashed("the " * 90), hashed("a b " * 40 + "the " * 70)
    found = substring_dedup.segments(own, other, 46, 0.8)
    assert {i for start, stop, *_ in found for i in range(start, stop)} == set(range(86))


def edited(words_, places, mark):
    return [f"{mark}{i}" if i in places else w for i, w in enumerate(words_)]


def brute_force(texts):
    """Per document: words that an earlier one has too, comparing all pairs."""
    removable = {}
    for doc in range(len(texts)):
        for earlier in range(doc):
            for a, b, *_ in substring_dedup.segments(hashed(texts[doc]), hashed(texts[earlier]), 46, 0.8):
                removable.setdefault(doc, set()).update(range(a, b + 4))
    return removable


@pytest.mark.parametrize("block", [2, 64])
def test_chains_of_near_passages_equal_brute_force(make_docs, block):
    texts = []
    for family in range(8):
        p = story(f"p{family}", 100).split(" ")
        b = edited(p, (20, 70), "b")
        c = edited(b, (40, 55), "c")
        d = edited(c, (10, 85), "d")
        texts += [" ".join([story(f"l{family}{i}", 60), *w]) for i, w in enumerate((p, b, c, d))]
    rows = substring_dedup.repeated_passages(make_docs(texts), functions=6, block=block).collect()
    found = {r.doc_id: {i for s in r.removable for i in range(s.start, s.stop)} for r in rows}
    assert {k: v for k, v in found.items() if v} == brute_force(texts)


def passages_by_brute_force(own, other, t, similarity):
    """Places of ``own`` in some window that is alike some window of ``other``, all of them tried.

    Windows of fewer than ``t`` places count as many unmatched ones as they lack.
    """
    told = set()
    for a in range(len(own)):
        for b in range(a + 1, len(own) + 1):
            for c in range(len(other)):
                for d in range(c + 1, len(other) + 1):
                    if own[a] != other[c] or own[b - 1] != other[d - 1]:
                        continue  # passages end at shingles in common
                    one, two = set(own[a:b].tolist()), set(other[c:d].tolist())
                    both = len(one & two)
                    lack = max(0, t - (b - a)) + max(0, t - (d - c))
                    if both >= similarity * (len(one | two) + lack):
                        told.update(range(a, b))
    return told


@pytest.mark.parametrize("seed", range(6))
def test_in_order_equals_all_windows(seed):
    rng = random.Random(seed)
    p = np.arange(1, 25, dtype=np.uint64)
    gone = set(rng.sample(range(24), 5))
    other = np.array([100 + i if i in gone else x for i, x in enumerate(p.tolist())], np.uint64)
    other = np.insert(other, rng.randrange(24), np.uint64(500))
    found = substring_dedup.in_order(p, other, 8, 0.8)
    assert {i for a, b, *_ in found for i in range(a, b)} == passages_by_brute_force(p, other, 8, 0.8)


@pytest.mark.parametrize("place", [0, 1, 2, 3, 4, 25, 45, 49])
def test_passages_with_edited_ends_are_found(place):
    p = story("p", 50).split(" ")
    one = hashed(" ".join([story("a", 60), *p, story("b", 60)]))
    two = hashed(" ".join([story("c", 60), *edited(p, (place,), "x"), story("d", 60)]))
    told = {i for a, b, *_ in substring_dedup.segments(one, two, 46, 0.8) for i in range(a, b + 4)}
    assert len(told & set(range(60, 110))) >= 45 and told <= set(range(60, 110))


def test_long_texts_of_few_words_end():
    rng = random.Random(3)
    one, two = (hashed(" ".join(rng.choice("ab") for _ in range(20000))) for _ in range(2))
    assert substring_dedup.segments(one, two, 46, 0.8)
    same = hashed("the " * 20000)
    told = {i for a, b, *_ in substring_dedup.segments(same, same[:9000], 46, 0.8) for i in range(a, b)}
    assert told == set(range(len(same)))


def test_joined_windows_are_all_that_hold_both_minima():
    rng = np.random.default_rng(5)
    one, two = (
        np.array(substring_dedup.compact_windows(rng.permutation(200).astype(np.uint64), 10)) for _ in range(2)
    )
    expected = set()
    for i, (l, c, r) in enumerate(one.tolist()):
        for j, (m, d, s) in enumerate(two.tolist()):
            start, stop = max(l, m), min(r, s)
            if start <= min(c, d) and max(c, d) <= stop and stop - start + 1 >= 10:
                expected.add((i, j, start, stop))
    found = substring_dedup.joined_windows(one, two, 10)
    assert set(zip(*(x.tolist() for x in found), strict=True)) == expected and expected


def test_edited_passages_share_a_pair_of_minima():
    rng, met = random.Random(7), 0
    for _ in range(300):
        p = [f"w{rng.random()}" for _ in range(50)]
        near = edited(p, (25,), "x")  # 41 of 51 shingles
        one = hashed(" ".join([story("a", 60), *p, story("b", 60)]))
        two = hashed(" ".join([story("c", 60), *near, story("d", 60)]))
        keys = [substring_dedup.pair_keys(x, 46, substring_dedup.FUNCTIONS)[0] for x in (one, two)]
        met += len(np.intersect1d(*keys)) > 0
    assert met >= 0.95 * 300


def test_windows_are_computed_once(make_docs, with_passages, monkeypatch):
    calls, windows = [], substring_dedup._windows
    monkeypatch.setattr(substring_dedup, "_windows", lambda *a: calls.append(a) or windows(*a))
    t = substring_dedup.PASSAGE_WORDS - substring_dedup.SHINGLE + 1
    pairs = substring_dedup._candidates(make_docs(with_passages), t, substring_dedup.FUNCTIONS)
    assert len(calls) == 1
    assert {(r.leader, r.doc) for r in pairs.collect()} >= {(1, 2), (1, 3)}


def test_durable_rows_leave_no_shuffled_files(spark, make_docs):
    before = spark.conf.get(common._CLEANUP, "false")
    docs = make_docs([story(f"d{i}", 20) for i in range(8)])
    frame = docs.groupBy("doc_id").count()
    kept = common.durable(frame)
    assert kept.count() == 8 and kept.groupBy("count").count().count() == 1  # read again, also in a shuffle
    assert frame.count() == 8  # the frame itself is as it was
    assert spark.conf.get(common._CLEANUP, "false") == before


def block_of(texts, spans=None):
    """Documents of one block, open, with these passages known from document 0."""
    known = None if spans is None else [{"start": a, "stop": b} for a, b in spans]
    first = None if spans is None else 0
    return [
        {"doc": i + 1, "own_shingles": hashed(text).tobytes(), "lo": 0, "open": True, "first_doc_id": first,
         "passages": known, "removable": known, "own": 0, "i": 0, "j": 0}
        for i, text in enumerate(texts)
    ]


def test_known_passages_are_not_aligned_again(monkeypatch):
    calls, in_order = [], substring_dedup.in_order
    monkeypatch.setattr(substring_dedup, "in_order", lambda *a: calls.append(a) or in_order(*a))
    passage = story("hot", 70)
    texts = [f"{story(f'm{i}', 60)} {passage} {story(f'n{i}', 20)}" for i in range(40)]
    assert substring_dedup.passages_of_block(block_of(texts, [(60, 130)]), 46, 0.8) == []
    assert not calls  # 780 pairs
    # one that is known in part only is found again
    assert substring_dedup.passages_of_block(block_of(texts[:2], [(60, 120)]), 46, 0.8) == [(2, 60, 130, 1, 60, 130)]


@pytest.mark.parametrize("seed", range(8))
def test_documents_aligned_at_once_equal_pairs(monkeypatch, seed):
    rng, texts = random.Random(seed), []
    passages = [story(f"p{k}", 70).split(" ") for k in range(3)]
    for i in range(30):
        parts = [edited(p, rng.sample(range(70), rng.choice((0, 1, 2, 4))), f"e{i}x") for p in passages]
        rng.shuffle(parts) if i % 3 == 0 else None
        parts = parts[: rng.randint(1, 3)] + parts[: i % 5 == 0]
        gaps = [story(f"g{i}x{k}", rng.choice((0, 3, 30))).split(" ") for k in range(len(parts))]
        texts.append(" ".join(word for pair in zip(parts, gaps, strict=True) for part in pair for word in part))
    known = [(0, 65)] if seed % 2 else None
    at_once = substring_dedup.passages_of_block(block_of(texts, known), 46, 0.8)
    monkeypatch.setattr(substring_dedup, "_PAIRS", 0)
    assert at_once == substring_dedup.passages_of_block(block_of(texts, known), 46, 0.8) and at_once


def test_few_documents_of_a_leader_are_one_block(spark, make_docs):
    docs = make_docs([story(f"d{i}", 10) for i in range(4)])
    pairs = docs.selectExpr("0 AS leader", "doc_id AS doc", "0 AS lo", "60 AS hi").filter("doc > 0")
    span = "array(named_struct('start', 0, 'stop', 70))"
    known = docs.selectExpr("doc_id", "0 AS first_doc_id", f"{span} AS passages", f"{span} AS removable")
    rows = substring_dedup._meetings(pairs, known.filter("doc_id > 1"), 64).collect()
    assert sorted((r.doc, r.open, r.own, r.met) for r in rows) == [(1, True, 0, 1), (2, False, 0, 1), (3, False, 0, 1)]


def test_blocks_of_many_documents_are_larger(spark):
    """A document is dealt once for every block it meets: with 1280 alike, once for 9, not for 20."""
    pairs = spark.range(1, 1281).selectExpr("0L AS leader", "id AS doc", "0 AS lo", "99 AS hi")
    kind = "array<struct<start:int,stop:int>>"
    known = spark.createDataFrame([], f"doc_id bigint, first_doc_id bigint, passages {kind}, removable {kind}")
    rows = substring_dedup._meetings(pairs, known, 64).collect()
    assert len(rows) == 1280 and {r.met for r in rows} == {9} and {r.own for r in rows} == set(range(9))
    # long ones stay in blocks of a bounded number of shingles
    long = pairs.withColumn("hi", pairs.hi * 0 + 20_000)
    assert {r.met for r in substring_dedup._meetings(long, known, 64).collect()} == {20}
