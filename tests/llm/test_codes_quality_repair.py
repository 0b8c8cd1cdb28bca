"""Vector codes, quality scores and conversation repair against plain versions: nulls, empty
and long values, ties, repeated rows, empty tables, and tables with more columns than are read."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftlake.llm import conversation_repair as repair
from driftlake.llm import quality_model, vector_codes

# -- vector codes ----------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<float>, label int, size string, part int, total string"


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Every round scans every entry."""
    kept = []
    for vec_id, vector, label in rows:
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(4096 * x) for x in vector], label))
    sizes = Counter(len(v) for _, v, _ in kept)
    size = min(sizes, key=lambda s: (-sizes[s], s), default=0)
    kept = [row for row in kept if len(row[1]) == size]
    cut = [p * size // parts for p in range(parts + 1)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[row[1][cut[p] : cut[p + 1]] for row in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), j) for j, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                x = v[cut[p] : cut[p + 1]]
                groups.setdefault(near(x, books[p])[1], []).append(x)
            for j, members in groups.items():
                books[p][j] = [sum(c) // len(members) for c in zip(*members)]
    out, errors = [], Counter()
    for vec_id, v, label in kept:
        best = [near(v[cut[p] : cut[p + 1]], books[p]) for p in range(parts)]
        out.append((vec_id, "".join(f"{j:02x}" for _, j in best), sum(d for d, _ in best), label))
        errors[label] += out[-1][2]
    numbers = ",".join(str(c) for book in books for entry in book for c in entry)
    return Counter((i, c, e, errors[label]) for i, c, e, label in out), hashlib.sha256(numbers.encode()).hexdigest()


def vectors(n, size=16, seed=1, levels=None):
    draw = random.Random(seed)
    value = (lambda: draw.choice(levels)) if levels else (lambda: float(np.float32(draw.gauss(0, 0.2))))
    return [(i, [value() for _ in range(size)], draw.choice([None, 0, 1, 1, 1])) for i in range(n)]


@pytest.mark.parametrize("levels", [None, [0.0, 0.25, -0.25]])
def test_vector_codes_equal_full_scans(spark, levels):
    """With few levels most distances tie."""
    rows = vectors(400, levels=levels)
    rows += [(None, rows[3][1], 5), (7, rows[7][1], None), (7, rows[7][1], None), (3, rows[9][1], 1)]
    rows += [(900, None, 1), (901, [], 1), (902, [None] * 16, 1), (903, [math.nan] * 16, 1), (904, [math.inf] * 16, 1), (905, [0.5] * 8, 1)]
    frame = spark.createDataFrame([(*row, "size", 1, "total") for row in rows], VECTORS).repartition(5)
    made = vector_codes.compress(frame)
    got = vector_codes.with_label_error(made.rows).select("vec_id", "code", "error", "label_error")
    want, digest = plain_codes(rows)
    assert Counter(map(tuple, got.collect())) == want
    assert made.digest() == digest


@pytest.mark.parametrize("rows", [[], [(1, None, 2)], vectors(3), vectors(40, size=13), vectors(20, size=3), vectors(5) * 9])
def test_vector_codes_of_few_odd_and_repeated_vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    made = vector_codes.compress(frame)
    got = vector_codes.with_label_error(made.rows).select("vec_id", "code", "error", "label_error")
    want, digest = plain_codes(rows)
    assert Counter(map(tuple, got.collect())) == want
    assert made.digest() == digest


def test_huge_components_do_not_overflow(spark):
    rows = [(i, [3e38 if i % 2 else -3e38] * 16, 0) for i in range(40)]
    made = vector_codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = vector_codes.with_label_error(made.rows).collect()
    assert len(got) == 40 and all(row.error == 0 == row.label_error for row in got)


def test_labels_with_and_without_many_rows_get_their_totals(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "HOT_SHARE", 3)
    rows = [(i, "00", i, None if i % 2 else i) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, code string, error long, label int")
    got = {row.vec_id: row.label_error for row in vector_codes.with_label_error(frame).collect()}
    assert got == {i: sum(range(1, 60, 2)) if i % 2 else i for i in range(60)}


def test_only_moved_entries_are_compared():
    """Rows whose entry stayed see the moved ones alone, and still end at the nearest."""
    draw = np.random.default_rng(3)
    x, before = draw.integers(-3, 4, (500, 2)), draw.integers(-3, 4, (16, 2))
    code, near = vector_codes.assign(x, before, np.ones(16, bool), None, None)
    after = before.copy()
    after[[2, 9]] += draw.integers(-2, 3, (2, 2))
    moved = (after != before).any(axis=1)
    full = vector_codes.distances(x, after)
    looked = []
    plain = vector_codes.distances
    vector_codes.distances = lambda rows, book: looked.append((len(rows), len(book))) or plain(rows, book)
    try:
        got, reached = vector_codes.assign(x, after, moved, code, near)
    finally:
        vector_codes.distances = plain
    assert (got == full.argmin(axis=1)).all() and (reached == full.min(axis=1)).all()
    assert looked == [(int(moved[code].sum()), 16), (int((~moved[code]).sum()), int(moved.sum()))]


# -- quality ---------------------------------------------------------------------------
def quality_corpus(n=600):
    draw = random.Random(8)
    parts = ["an", "ber", "cho", "du", "el", "fo", "gri", "ha"]

    def words(k):
        return ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(k)]

    docs, labels = [], []
    for i in range(n):
        good = draw.random() < 0.7
        text = words(draw.randint(30, 90))
        if not good:
            kind = i % 3
            text = [w.upper() + "!!" for w in text] if kind == 0 else [w + "***" for w in text] if kind == 1 else [text[0]] * len(text)
        docs.append((i, " ".join(text), "en", "s", "score", "label"))
        labels.append((i, int(good), 0))
    return docs, labels


DOCS = "doc_id long, text string, lang string, source string, score string, label string"
LABELS = "doc_id long, quality int, toxic int"


def test_quality_scores_of_unseen_texts(spark):
    docs, labels = quality_corpus()
    labels += [(None, 0, 0), (5, None, 0), (0, labels[0][1], 1)]
    docs += [(None, "who", None, None, "", ""), (9000, None, None, None, "", ""), (9001, "", None, None, "", ""),
             (9002, " \t", None, None, "", ""), (9003, "word " * 200_000, None, None, "", ""), docs[3], docs[3]]
    frame, marks = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)
    weights = quality_model.train(frame, marks)
    got = quality_model.score_quality(frame, weights).collect()
    assert len(got) == len(docs) and all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3) for row in got)
    held = {str(row.doc_id): row for row in got if row.held_out}
    assert all((zlib.crc32(str(row.doc_id).encode()) % 5 == 0) == row.held_out for row in got if row.doc_id is not None)
    truth = {str(i): q for i, q, _ in labels if q is not None}
    right = [row.predicted == truth[i] for i, row in held.items() if i in truth]
    assert len(right) > 90 and np.mean(right) >= 0.97
    by_id = {row.doc_id: row.score for row in got}
    assert by_id[9000] == by_id[9001] == by_id[9002]


def test_quality_training_does_not_depend_on_the_layout(spark):
    docs, labels = quality_corpus(200)
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    once = quality_model.train(frame.repartition(2), marks)
    assert (quality_model.train(frame.repartition(7), marks.repartition(3)) == once).all()
    # Held-out labels change nothing.
    flipped = marks.withColumn("quality", F.when(quality_model.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality_model.train(frame, flipped) == once).all()


def test_quality_sample_is_bounded_and_shards_are_averaged(spark, monkeypatch):
    docs, labels = quality_corpus(400)
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    chosen, count = quality_model.labelled(frame, marks, 100)
    assert count == 100 and 60 <= chosen.count() <= 140
    monkeypatch.setattr(quality_model, "SHARD_ROWS", 50)
    weights = quality_model.train(frame, marks, bits=12)
    got = {row.doc_id: row.score for row in quality_model.score_quality(frame, weights, bits=12).collect()}
    right = [(got[i] >= 0.5) == bool(q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean(right) >= 0.9


def test_quality_without_labels_or_rows(spark):
    docs, none = spark.createDataFrame(quality_corpus(5)[0], DOCS), spark.createDataFrame([], LABELS)
    weights = quality_model.train(docs, none)
    assert {row.score for row in quality_model.score_quality(docs, weights).collect()} == {0.5}
    assert quality_model.score_quality(docs.limit(0), quality_model.train(docs.limit(0), none)).count() == 0


def test_a_shard_learns_as_a_plain_leader():
    """The sparse updates against the written-out rule over all coordinates."""
    draw, leader = np.random.default_rng(1), quality_model.Leader(bits=4)
    z, n = np.zeros(17), np.zeros(17)
    for _ in range(50):
        x = np.zeros(17)
        index = np.sort(draw.choice(16, 4, replace=False))
        x[index], x[16] = draw.random(4), 1.0
        y = float(x[index[0]] > 0.5)
        w = -z / ((quality_model.BETA + np.sqrt(n)) / quality_model.ALPHA + quality_model.L2)
        g = (1 / (1 + np.exp(-(w @ x))) - y) * x
        z, n = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / quality_model.ALPHA * w, n + g * g
        leader.learn(np.append(index, 16), np.append(x[index], 1.0), y)
    assert np.allclose(leader.z, z) and np.allclose(leader.n, n)


# -- conversations ---------------------------------------------------------------------
TALK = "conv_id long, turn long, role string, text string, times int, kind string, digest string, audit string"
SPACES = " \t\n\x0b\x0c\r"
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def plain_audit(facts):
    """Cheapest edits over whole strings; ``facts`` has role, text and first fault of each row."""

    def better(best, state, found):
        if state not in best or found[:2] < best[state][:2]:
            best[state] = found

    def insert(best):
        for _ in range(3):
            for state, (cost, audit, made) in list(best.items()):
                role = "assistant" if state == 2 else "user"
                better(best, STEPS[state, role[0]], (cost + 2, audit + "I", made + ((role, ""),)))

    best = {0: (0, "", ())}
    insert(best)
    for role, text, fault in facts:
        after, more = {}, fault == "truncated"
        for state, (cost, audit, made) in best.items():
            better(after, state, (cost + 3, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            if (state, role[:1]) in STEPS:
                better(after, STEPS[state, role[:1]], (cost + more, audit + "K", made + ((role, text),)))
            for new in ("user", "assistant"):
                if (state, new[0]) in STEPS:
                    better(after, STEPS[state, new[0]], (cost + 2 + more, audit + "R", made + ((new, text),)))
        insert(after)
        best = after
    return min((best[state] for state in (0, 3) if state in best), key=lambda found: found[:2])


def plain_repair(rows):
    talks = {}
    for conv_id, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if value is None else value for value in (role, text))
        own = talks.setdefault(conv_id, [])
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        own += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = {}
    for conv_id, own in talks.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).digest()))
        seen, facts = set(), []
        for _, role, text in own:
            bare = text.strip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            facts.append((role, text, fault))
        turns = [turn for turn, _, _ in own if turn is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        counts = [sum(f == kind for *_, f in facts) for kind in ("blank", "duplicate", "truncated")]
        cost, audit, made = plain_audit(facts)
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in made).encode()).hexdigest()
        out[conv_id] = (gaps, *counts, pairs, cost, audit, digest)
    return out


def talks(seed=4, n=300):
    draw = random.Random(seed)
    roles = ["user", "assistant", "assistant", "system", "tool", "", None, "ufo", "Ärger"]
    texts = ["Yes.", "No!", "Why? \t", "cut off", "", " \n", None, "Ende. ü", "Fine."]
    rows = []
    for conv_id in range(n):
        size = draw.choice([1, 2, 3, 5, 8, 30])
        for turn in range(size):
            role = ["user", "assistant"][turn % 2] if draw.random() < 0.6 else draw.choice(roles)
            text = f"Answer {draw.randrange(99)}." if draw.random() < 0.6 else draw.choice(texts)
            rows.append((conv_id if conv_id else None, draw.choice([turn, turn, turn * 3, None, 2]), role, text))
    return rows + rows[5:9] + [(10**6, 0, "user", "x" * 2_000_000 + "."), (10**6, 1, "assistant", "ok.")]


def test_conversations_equal_plain_repair(spark):
    rows = talks()
    frame = spark.createDataFrame([(*row, 1, "kind", "digest", "audit") for row in rows], TALK).repartition(4)
    damaged = repair.damaged(frame)
    found = repair.audits(damaged)
    got = {row[0]: tuple(row[1:]) for row in repair.with_digests(damaged, found).collect()}
    assert got == plain_repair(rows)


def test_repaired_rows_are_the_digested_ones(spark):
    rows = talks(5, 60)
    damaged = repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = repair.audits(damaged)
    texts = {}
    for conv_id, place, role, text in sorted(map(tuple, repair.repaired(damaged, found).collect()), key=lambda r: (r[0] or -1, r[1])):
        texts.setdefault(conv_id, []).append((role, text))
        assert len(texts[conv_id]) == place
    for row in repair.with_digests(damaged, found).collect():
        lines = [f"{role}:{text}" for role, text in texts.get(row.conv_id, [])]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == row.repaired_sha256
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in texts.get(row.conv_id, [])))


def test_conversations_of_an_empty_table_and_of_dropped_rows(spark):
    schema = "conv_id string, turn long, role string, text string"
    none = repair.damaged(spark.createDataFrame([], schema))
    assert repair.with_digests(none, repair.audits(none)).count() == 0
    dropped = next(t for t in range(100) if zlib.crc32(f"c:{t}".encode()) % 20 == 0)
    one = repair.damaged(spark.createDataFrame([("c", dropped, "user", "Hi.")], schema))
    got = [tuple(row) for row in repair.with_digests(one, repair.audits(one)).collect()]
    assert got == [("c", 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def search(facts):
    found = repair.Search()
    for role, _, fault in facts:
        found.row(role[:1].encode(), fault in ("blank", "duplicate"), fault == "truncated")
    return found.result()


def test_long_conversations_are_pruned_and_stay_least(monkeypatch):
    """Rows that fit nowhere keep two states' prefixes apart from the first row on."""
    draw = random.Random(6)
    monkeypatch.setattr(repair, "PRUNE_AT", 40)
    for roles in (["tool"], ["user"], ["user", "assistant"], ["user", "assistant", "tool", "system"]):
        facts = [(draw.choice(roles), "", draw.choice(["", "", "truncated", "duplicate"])) for _ in range(400)]
        assert search(facts) == plain_audit(facts)[:2]


def test_colliding_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(repair, "MODULUS", 7)
    draw = random.Random(7)
    for _ in range(20):
        facts = [(draw.choice(["user", "assistant", "tool", "system"]), "", draw.choice(["", "", "truncated", "blank"])) for _ in range(40)]
        assert search(facts) == plain_audit(facts)[:2]


def test_longest_common_prefixes():
    tree, nodes = repair.Prefixes(), {"": 0}
    draw = random.Random(8)
    for _ in range(300):
        text = draw.choice(sorted(nodes))
        letter = draw.choice("DIKR")
        nodes[text + letter] = tree.extend(nodes[text], letter)
    for _ in range(500):
        a, b = draw.choice(sorted(nodes)), draw.choice(sorted(nodes))
        assert tree.less(nodes[a], nodes[b]) == (a < b)
        assert tree.text(nodes[a]) == a and tree.extend(nodes[a[:-1]], a[-1]) == nodes[a] if a else True
