"""Operators that look at one document at a time: rules, licenses, counts, packing, grades."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import CLASHING, UPPER, edge_docs, edge_texts, make_docs, no_docs, story, words  # noqa: F401

from timepoint.llm import grades, licenses, packing, quality_rules, token_counts
from timepoint.llm.queries import tokenizer

WORD_FILE, PIECE_FILE = "word_bpe_49k.json", "piece_bpe_32k.model"


def by_id(rows):
    return {r.doc_id: r for r in rows}


# ---------------------------------------------------------------- quality rules


def plain_measures(text):
    text = text or ""
    w = words(text)
    times = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {
        at + k
        for at, triple in enumerate(zip(w, w[1:], w[2:], strict=False))
        if times[triple] > 1
        for k in range(3)
    }
    seen, copies = set(), 0
    for line in text.split("\n"):
        if words(line):
            copies += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), copies, len(covered)


def test_measures_equal_plain_ones():
    rng = random.Random(5)
    parts = ["a", "b", "a", " ", "\n", "\t", "c#", "$", "\x0b", "\x85", "\xa0", "é", "a b c", "\n\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    for text in texts + edge_texts():
        assert quality_rules.measure(text)[:5] == plain_measures(text)


def test_ledger_and_policies(edge_docs):
    rows = quality_rules.ledger(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    few = quality_rules.mask_of(("few_words",))
    empty = [r for r in rows if r.n_words == 0]
    assert empty and all(r.failed == few for r in empty)
    kept = quality_rules.accepted(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 5, 6, 6, 8, 9, 10, 11]


def test_empty_table(no_docs):
    assert quality_rules.ledger(no_docs).count() == 0
    report = quality_rules.ablations(quality_rules.ledger(no_docs)).collect()
    assert len(report) == len(quality_rules.POLICIES[quality_rules.CURRENT])


def test_ablations_come_from_bits_alone(make_docs):
    texts = ["few", "x " * 100, "few few few !!", story("ok", 90), "LOUD AND LONG " * 30]
    rows = quality_rules.ledger(make_docs(texts))
    failed = [r.failed for r in rows.collect()]
    rules = list(quality_rules.RULES)
    for r in quality_rules.ablations(rows, "v2").collect():
        bit = 1 << rules.index(r.rule)
        assert r.n_failed == sum(bool(f & bit) for f in failed)
        assert r.n_failed_alone == sum(f == bit for f in failed)
        assert r.n_kept_without == sum(not f & ~bit for f in failed)


# ---------------------------------------------------------------- licenses


def plain_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return (
        len(w),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def test_base_places_equal_plain_ones(make_docs, edge_docs):
    rng = random.Random(9)
    parts = "under the mit license apache version 2 2.0 cc by nc CC-BY-NC , - é. x".split()
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    texts += [
        "Licensed under the MIT License.",
        "under the mit license under the mit license",
        "Apache License, Version 2.0; cc by nc; unders the mit license",
        "cc by nc" * 3,
    ]
    for docs, own in ((make_docs(texts), texts), (edge_docs, None)):
        for r in licenses.scan(docs).collect():
            if own is not None:
                text = own[r.doc_id]
            elif r.doc_id is None:
                continue
            else:
                text = edge_texts()[r.doc_id]
            found = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
            assert found == plain_base(text), text
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
            assert 0 <= r.score <= 1 and (r.n_base == 0 or r.score == 1)


@pytest.mark.parametrize(
    ("text", "label", "score"),
    [
        ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3", 1.0),
        ("Released under the terms of the Mozilla Public License, v. 2.0", "mpl-2", 0.95),
        ("see the GNU Lesser General Public License", "lgpl", 0.8),
        ("a BSD 3-Clause license", "bsd-3-clause", 0.5),
        ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa", 0.8),
        ("no rules here, copyright or not", "", 0.0),
    ],
)
def test_signatures(make_docs, text, label, score):
    (r,) = licenses.scan(make_docs([text])).collect()
    assert r.labels == label and r.score == score


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("SPDX-License-Identifier: EPL-2.0", "epl-2"),
        ("SPDX-License-Identifier: BSL-1.0", "boost-1"),
        ("SPDX-License-Identifier: MPL-1.1", "mpl-1.1"),
        ("SPDX-License-Identifier: CPL-1.0", "cpl-1"),
        ("the SIL Open Font License 1.1", "ofl-1.1"),
        ("Business Source License 1.1", "bsl-1.1"),
        ("Server Side Public License", "sspl-1"),
        ("Open Database License", "odbl-1"),
        ("Open Data Commons Attribution License", "odc-by-1"),
        ("Public Domain Dedication and License", "pddl-1"),
        ("an Expat license", "mit"),
        ("Creative Commons Attribution Share Alike 4.0", "cc-by-sa"),
        ("Creative Commons Attribution Non Commercial 4.0", "cc-by-nc"),
    ],
)
def test_the_gate_lets_every_form_pass(make_docs, text, label):
    (r,) = licenses.scan(make_docs([text])).collect()
    assert label in r.labels.split(",")


def test_the_gate_is_sound(make_docs):
    texts = []
    for _, _, spdx, title in licenses.LICENSES:
        for _, _, _, form in licenses.FORMS:
            own = spdx if "{id}" in form else title
            filled = licenses.sayings(form.format(id="IT", title="IT"))[-1]
            for saying in {*licenses.sayings(own)[:1], *licenses.sayings(own)[-1:]}:
                texts.append(filled.replace("IT", saying))
    for _, keyword, *expressions in licenses.LICENSES:
        for own in expressions:
            keywords = set(licenses._keywords(own, keyword))
            for saying in licenses.sayings(own):
                assert re.fullmatch(own, saying) and keywords & set(saying.split())
    texts.append("no license is named here")
    found = {r.doc_id: r for r in licenses.scan(make_docs(texts)).collect()}
    for doc, text in enumerate(texts):
        matches = {r["label"] for r in licenses.rules() if re.search(r["regex"], f" {text} ")}
        # suppression hides labels of the whole, never all of them
        own = set(filter(None, found[doc].labels.split(",")))
        assert own <= matches and bool(own) == bool(matches), text


def test_contained_detections_are_suppressed(make_docs):
    (r,) = licenses.scan(make_docs(["This is licensed under the MIT License today."])).collect()
    assert [(d.start, d.stop, d.label) for d in r.detections] == [(2, 6, "mit")]
    assert len(licenses.rules()) > 300


def test_spans_of_repeats(make_docs):
    (r,) = licenses.scan(make_docs(["The unlicense! " * 3])).collect()
    assert [(d.start, d.stop) for d in r.detections] == [(0, 1), (2, 3), (4, 5)]


def test_no_python_in_the_plan(make_docs):
    plan = licenses.scan(make_docs(["x"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- tokens


def odd_texts():
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "▁", "a", "The", "é", "É", "日", "<s>", "</s>", "<|endoftext|>"]
    parts += ["\r\n", "{", "0", "\xa0", "​", "#", "x" * 40, "'s", "Σ", "\x00", "\U0001f389"]
    parts += ["é", "́", "İ", "\x85", ".", ",", "!!", "²", "_", "<", "|>", "<unk>", "<0x0A>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]


def test_token_counts_equal_the_library():
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=tokenizer(PIECE_FILE))
    count = token_counts.counter(tokenizer(PIECE_FILE))
    assert count._cut and len(count.whole) > 1000
    for text in odd_texts() + [t or "" for t in edge_texts()]:
        assert count.count(text) == len(model.encode(text)), repr(text)


def test_token_counts_of_edge_rows(edge_docs, no_docs):
    rows = token_counts.token_counts(edge_docs, tokenizer(PIECE_FILE), limit=1000).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        text = None if r.doc_id is None else edge_texts()[r.doc_id]
        if text is not None:
            assert r.n_bytes == len(text.encode())
        assert r.over_limit == (r.n_tokens > 1000) and (r.n_bytes == 0) == (r.n_tokens == 0)
    assert token_counts.token_counts(no_docs, tokenizer(PIECE_FILE)).count() == 0


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer(WORD_FILE))
    texts = odd_texts() + [t or "" for t in edge_texts()]
    own = packing.WordIds(tokenizer(WORD_FILE))
    assert own._cut
    for text, ids in zip(texts, own.of(texts), strict=True):
        expected = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, repr(text)


# ---------------------------------------------------------------- packing


def test_packing_round_trip(edge_docs, no_docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer(WORD_FILE))
    rows = packing.pack(edge_docs.filter("doc_id IS NOT NULL"), tokenizer(WORD_FILE)).collect()
    pieces, used = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        used[r.sequence_id].append((r.offset, r.length))
    for doc, own in pieces.items():
        ids = plain.encode(edge_texts()[doc] or "", add_special_tokens=False).ids + [0]
        times = 2 if doc in (5, 6) else 1
        assert len(own) == times * -(-len(ids) // packing.SEQUENCE)
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.start == r.piece * packing.SEQUENCE and r.ids_crc32 == zlib.crc32(part)
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.SEQUENCE
    assert packing.pack(no_docs, tokenizer(WORD_FILE)).count() == 0


@pytest.mark.parametrize("most_open", [1, 3, 64])
def test_best_fit_equals_a_plain_search(most_open):
    rng = random.Random(most_open)
    bins, open_bins, number = packing.BestFit(100, most_open), {}, 0
    for _ in range(2000):
        length = rng.randint(1, 100)
        sequence, offset = bins.place(length)
        fitting = [free for free in open_bins.values() if free >= length]
        if fitting:
            assert open_bins[sequence] == min(fitting) == 100 - offset
            open_bins[sequence] -= length
        else:
            assert sequence == number and offset == 0
            number += 1
            if len(open_bins) >= most_open:
                fullest = min(open_bins.values())
                closed = next(s for s in reversed(open_bins) if open_bins[s] == fullest)
                # of equally full ones any may close; follow the packer's own choice
                still = {s for free in bins._free for s in free} | {sequence}
                gone = [s for s in open_bins if s not in still]
                closed = gone[0] if gone else closed
                assert open_bins[closed] == fullest
                del open_bins[closed]
            open_bins[sequence] = 100 - length
        if open_bins[sequence] == 0:
            del open_bins[sequence]
        assert len(open_bins) <= most_open


# ---------------------------------------------------------------- grades


def graded_corpus(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(n):
        w = [f"word{rng.randint(0, 400)}" for _ in range(rng.randint(30, 200))]
        kind = rng.choice((0, 1, 2, 2))
        if kind == 0:
            w = [x + "***" for x in w]
        if kind == 1:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(("vilefool", "vilepest"))
        texts.append(" ".join(w))
        labels.append(kind)
    return texts, labels


def test_grades_hold_out(spark, make_docs):
    texts, kinds = graded_corpus(600, 1)
    labels = spark.createDataFrame(
        [(i, int(k > 0), int(k == 1)) for i, k in enumerate(kinds[:400])] + [(9, None, None), (None, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    docs = make_docs(texts)
    rows = by_id(grades.quality_grades(docs, labels).collect())
    assert len(rows) == 600
    right = [rows[i].kept == (kinds[i] == 2) for i in range(400, 600)]
    assert np.mean(right) > 0.93
    means = [np.mean([rows[i].expected_grade for i in range(400, 600) if kinds[i] == k]) for k in range(3)]
    assert means == sorted(means) and means[0] < 0.5 and means[2] > 1.5
    again = by_id(grades.quality_grades(docs.repartition(3), labels).collect())
    assert all(again[i] == rows[i] for i in rows)


def test_grades_of_edge_rows(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = grades.quality_grades(edge_docs, none).collect()
    assert len(rows) == edge_docs.count() and set(CLASHING)
    assert all(r.p_top == 0 and not r.kept for r in rows if r.doc_id in (0, 1, 2))
    assert all(0 <= r.expected_grade <= 2 for r in rows)
    assert grades.quality_grades(no_docs, none).count() == 0


def test_thresholds_are_ordered():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(300):
        y = int(rng.integers(0, 3))
        rows.append((np.array([y, 10], np.int32), np.array([1.0, rng.normal()], np.float32), y))
    model = grades.fit_rows(rows)
    assert (np.diff(model.thresholds) > 0).all()
    tails = [model.tails(*rows[[r[2] for r in rows].index(y)][:2]) for y in range(3)]
    assert tails[0][0] < 0.5 < tails[1][0] and tails[1][1] < 0.5 < tails[2][1]
    assert all((np.diff(t) <= 0).all() for t in tails)


def test_what_a_task_remembers_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "_REMEMBERED", 50)
    tokens, whole = packing.WordIds(tokenizer(WORD_FILE)), packing.WordIds(tokenizer(WORD_FILE))
    texts = [story(f"w{i % 7}", 30) for i in range(20)] + [story(f"x{i}", 30) for i in range(20)]
    for text in texts:
        assert tokens.of([text]) == [whole._encode(text)]
        assert len(tokens._known) <= 50 + 31 and len(tokens._older) <= 50 + 31
    # words of the half before are taken from it
    monkeypatch.setattr(packing.WordIds, "_merged", None)
    assert tokens.of([texts[-1]]) == [whole._encode(texts[-1])]


def test_words_that_come_back_are_merged_once(monkeypatch):
    merged, calls = packing.WordIds._merged, Counter()
    monkeypatch.setattr(
        packing.WordIds, "_merged", lambda self, part: calls.update([part]) or merged(self, part)
    )
    tokens = packing.WordIds(tokenizer(WORD_FILE))
    calls.clear()
    letters = "abcdefghijklmnopqrstuvwxyz"
    parts = ["é" + "".join(letters[i // 26**k % 26] for k in range(4)) for i in range(150_000)]
    texts = [" ".join(parts[at : at + 1000]) for at in range(0, len(parts), 1000)]
    first, again = ([x for text in texts for x in tokens.of([text])] for _ in range(2))
    assert first == again and len(calls) == len(parts) and set(calls.values()) == {1}
    assert first[0] == packing.WordIds._encode(tokens, texts[0])
