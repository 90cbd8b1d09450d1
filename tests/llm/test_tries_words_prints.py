"""Prefix trie, spelling variants and fingerprints against plain versions."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from llm_fixtures import CLASHING, edge_docs, edge_texts, make_docs, no_docs, story  # noqa: F401
from pyspark.sql import functions as F

from timepoint.llm import fingerprints, prefix_trie, spelling

TURNS = "conv_id bigint, turn bigint, role string, text string"


# ---------------------------------------------------------------- prefix trie


def turn_order(row):
    turn, role, text = row
    name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    return (turn is not None, turn or 0, name)


def plain_trie(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns, key=turn_order)] for c, turns in convs.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = collections.Counter(node[:-1] for node in members if node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(who) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if paths[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(who), len(node), parent, len(who), children[node], leaves[node], saved[node],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def some_turns():
    rng = random.Random(5)
    rows = []
    for c in range(0, 420):
        for turn in range(rng.randrange(1, 9)):
            text = f"t{rng.randrange(2)}" if turn < 4 else f"text {c} {turn}" * rng.randrange(1, 4)
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", text))
    rows += [(1000 + c, turn, "user", "all the same") for c in range(150) for turn in range(7)]
    rows += [(None, 0, "user", "nobody"), (7, None, None, None), (8, 0, "user", "tie"), (8, 0, "user", "tie")]
    rows += [(-5, 3, "user", ""), (-5, 3, "system", None), (9, 2, "a", "bc"), (9, 2, "ab", "c")]
    rows += [(5000, 0, "user", "x" * 50000), (5001, 1, "user", "é\U0001f389")]
    rows += [(6006, turn, "user", f"deep {turn % 3}") for turn in range(600)]
    rows += [(6106, turn, "user", f"deep {turn % 3}") for turn in range(610)]
    return rows


def found_trie(df):
    return sorted(
        (tuple(r[c] for c in prefix_trie._RESULT) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("shard", [60, 1 << 17])
def test_trie_is_the_plain_one_for_any_shards(spark, shard):
    rows = some_turns()
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumns({c: F.lit(c) for c in CLASHING})
    assert found_trie(prefix_trie.conversation_trie(df, shard)) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    nobody = spark.createDataFrame([(None, 1, "user", "x")], TURNS)
    assert prefix_trie.conversation_trie(nobody).collect() == []


def test_trie_of_turnless_conversations(spark):
    # of these, some have no turns left beyond those that their absent base would have given
    rows = [(c, 0, "user", f"only {c % 3}") for c in range(1, 60)]
    got = found_trie(prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS), 20))
    assert got == plain_trie(rows)
    assert any(zlib.crc32(str(c).encode()) % 6 for c in range(1, 60))


def test_ternary_tree_is_balanced_by_medians():
    tree = prefix_trie.TernaryTree()
    order = list(prefix_trie._medians(1000))
    assert sorted(order) == list(range(1000))
    for k in order:
        tree.insert([k], [1], 1, k, "")

    def height(at):
        return 0 if not at else 1 + max(height(tree.low[at]), height(tree.high[at]))

    assert height(tree.equal[0]) == 10


# ---------------------------------------------------------------- spelling variants


def plain_near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k:] == b[k + 1 :] or (len(a) == len(b) and a[k + 1 :] == b[k + 1 :])


def plain_variants(texts):
    counts = collections.Counter()
    for doc_id, text in texts:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if plain_near(v, w)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=repr)


def misspelt(rng, word):
    k = rng.randrange(len(word) + 1)
    c = rng.choice("abnéÿzß")
    return rng.choice([word[:k] + c + word[k:], word[:k] + word[k + 1 :], word[:k] + c + word[k + 1 :]])


def wordy_texts():
    rng = random.Random(3)
    stems = ["".join(rng.choice("abn") for _ in range(rng.randrange(6, 12))) for _ in range(60)]
    stems += ["Éclairage", "straßenbahn", "aaaaaaaa", "aaaaaaaaa", "abababab", "bababababa", "x" * 300]
    texts = []
    for doc in range(80):
        out = []
        for _ in range(60):
            word = rng.choice(stems[: 1 + rng.randrange(len(stems))])
            if rng.random() < 0.25:
                word = misspelt(rng, word)
            out.append(rng.choice([word, word.upper() if word.isascii() else word]))
        texts.append((doc, " ".join(out)))
    texts += [(None, "nothing nothing nothing 12345678"), (3, None), (4, ""), (5, "aaaaaaaa " * 400)]
    return texts + texts[:2]


@pytest.mark.parametrize("chunk", [8, 1 << 15])
def test_variants_are_the_plain_ones_for_any_chunk(spark, chunk):
    texts = wordy_texts()
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumns({c: F.lit(c) for c in CLASHING})
    columns = ("word", "form", "root", "n", "n_near", "form_n")
    got = sorted((tuple(r[c] for c in columns) for r in spelling.spelling_variants(docs, chunk=chunk).collect()), key=repr)
    expected = plain_variants(texts)
    assert got == expected
    assert any(r[1] for r in expected) and max(r[4] for r in expected) > 3


def test_variants_follow_a_chain_to_its_root(spark):
    # a form of a form, ten times as frequent each; ids chosen so that no run loses a letter
    words = {"planets": 2, "planetsa": 20, "planetsab": 200, "planetsabc": 2000}
    quiet = [i for i in range(400) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in words)][:2]
    texts = [(quiet[0], " ".join(" ".join([w] * (n // 2)) for w, n in words.items())),
             (quiet[1], " ".join(" ".join([w] * (n // 2)) for w, n in words.items()))]
    rows = spelling.spelling_variants(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert {r.word: r.root for r in rows} == dict.fromkeys(words, "planetsabc")
    assert {r.word: r.form_n for r in rows} == {"planets": 20, "planetsa": 200, "planetsab": 2000, "planetsabc": None}


def test_variants_of_nothing(no_docs, make_docs):
    assert spelling.spelling_variants(no_docs).collect() == []
    assert spelling.spelling_variants(make_docs([None, "", "short words once"])).collect() == []


def test_variants_of_edge_rows(edge_docs):
    got = sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n"))
                  for r in spelling.spelling_variants(edge_docs).collect()), key=repr)
    assert got == plain_variants([(r.doc_id, r.text) for r in edge_docs.collect()])


def test_index_finds_every_word():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(300)})
    index = spelling.Index(words)
    q, w = index.near(words, np.zeros(len(words), np.int64))  # no half is exact: any one error
    got = {(words[a], words[b]) for a, b in zip(q.tolist(), w.tolist(), strict=True)}
    assert got == {(a, b) for a in words for b in words if plain_near(a, b)}


# ---------------------------------------------------------------- fingerprints


def plain_edits(rows):
    """(doc_id, n_chars, sha, text, edited, next) of distinct documents in their order."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda d: (d[0] is None, -(d[0] or 0)))
    out = []
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        out.append((i, text, text[: len(text) - half] + after[:half], after))
    return out


def runs(text):
    out = collections.Counter()
    for line in text.split("\n"):
        w = re.findall(r"[^\x20\x09-\x0D]+", line)
        if w:
            out.update({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))})
    return out


def plain_likeness(one, two):
    if sorted(one.split("\n")) == sorted(two.split("\n")):
        return 1.0
    a, b = runs(one), runs(two)
    norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    return sum(v * b[k] for k, v in a.items()) / norm if norm else 0.0


def test_edits_and_likeness(make_docs):
    rng = random.Random(2)
    texts = ["\n".join(story(rng.randrange(9999), rng.randrange(1, 60)) for _ in range(rng.randrange(1, 9)))
             for _ in range(150)]
    texts += [texts[0], None, "", "", "é", "a\n", "\n", "\n\n", "no\nend\n", "x" * 9001, "gleich " * 4000]
    ids = list(range(5, 5 + len(texts)))
    rows = {r.doc_id: r for r in fingerprints.edited(make_docs(texts, ids=ids)).collect()}
    assert len(rows) == len(texts)
    prints, wrong = collections.defaultdict(set), []
    for i, text, edit, after in plain_edits(zip(ids, texts, strict=True)):
        r = rows[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        prints[r.fingerprint].add(tuple(sorted(text.split("\n"))))
        prints[r.edited_fingerprint].add(tuple(sorted(edit.split("\n"))))
        for got, other in ((r.near_edited, edit), (r.near_next, after)):
            assert 0.0 <= got <= 1.0
            expected = plain_likeness(text, other)
            if expected == 1.0:
                assert got == 1.0
            wrong.append(got - expected)
    # one multiset of lines has one fingerprint, and no other multiset has it
    assert all(len(lines) == 1 for lines in prints.values())
    by_lines = [lines for s in prints.values() for lines in s]
    assert len(by_lines) == len(set(by_lines))
    assert np.std(wrong) < 0.09 and np.abs(wrong).max() < 0.4


def test_fingerprints_add_and_subtract_paragraphs(spark):
    parts = ["one two three four", "", "five six\tseven", "one two three four", "Ünï \U0001f389 x y z"]
    texts = ["\n".join(parts), "\n".join(reversed(parts)), "\n".join(parts[:3]), "\n".join(parts[3:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    f = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert f[0] == f[1] != f[2]
    row = spark.createDataFrame([tuple(f[k] for k in range(4))], "a string, b string, c string, d string")
    got = row.select(
        fingerprints.added(F.col("c"), F.col("d")).alias("sum"),
        fingerprints.removed(F.col("a"), F.col("d")).alias("less"),
        fingerprints.insertion(F.col("c"), [F.col("d")]).alias("put"),
        fingerprints.deletion(F.col("a"), [F.col("c"), F.col("d")]).alias("none"),
        fingerprints.likeness(F.col("a"), F.col("b")).alias("same"),
        fingerprints.likeness(F.col("c"), F.col("d")).alias("half"),
    ).first()
    assert got["sum"] == got.put == f[0] and got.less == f[2]
    assert got.none == "0" * len(f[0])
    assert got.same == 1.0 and got.half == pytest.approx(plain_likeness(texts[2], texts[3]), abs=0.35)


def test_fingerprints_of_edge_rows(edge_docs, no_docs, make_docs):
    assert fingerprints.edited(no_docs).collect() == []
    source = [(r.doc_id, r.text) for r in edge_docs.collect()]
    rows = fingerprints.edited(edge_docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in source)
    assert len(rows) == len(source)
    by_text = collections.defaultdict(set)
    for r in rows:
        by_text[(r.doc_id, r.n_chars)].add((r.fingerprint, r.edited_sha256, r.near_next))
    # rows that repeat an id and a text have one result
    assert all(len(v) == 1 for (i, _), v in by_text.items() if i is not None)
    only = fingerprints.edited(make_docs(["alone it stands"])).first()
    assert only.near_next == 1.0
    assert only.edited_sha256 == hashlib.sha256(b"alone italone i").hexdigest()


def test_fingerprints_run_in_the_jvm(edge_docs):
    plan = fingerprints.edited(edge_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_edge_texts_are_what_the_tests_expect():
    assert None in edge_texts() and "" in edge_texts()
