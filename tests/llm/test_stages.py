"""Stages against brute force, batches that run again, and the pipeline on odd and empty tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from driftlake.llm import decontaminate, digest_index, langid, simhash
from driftlake.llm.common import release, scratch_mark, written
from driftlake.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(draw, n, parts="an ber cho du el fo gri ha in jo ka lu"):
    return ["".join(draw.choices(parts.split(), k=draw.randint(1, 3))) for _ in range(n)]


def test_a_batch_that_runs_again_is_decided_as_the_first_time(spark):
    rows = [(i, f"text number {i % 15}", None, None, i) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    index = digest_index.DigestIndex(spark, scratch_path(spark, "index"), 4)
    first = sorted(map(tuple, digest_index.dedup_batch(docs, index, "monday").collect()))
    assert sum(kept for *_, kept, _ in first) == 15
    # After its append, as when the result was lost.
    assert sorted(map(tuple, digest_index.dedup_batch(docs, index, "monday").collect())) == first
    assert index.rows().count() == 15
    later = digest_index.dedup_batch(docs, index, "tuesday").collect()
    assert not any(row.kept for row in later) and index.rows().count() == 15
    assert digest_index.drop_exact_copies(docs, index, "monday").count() == 15


def test_of_rows_that_repeat_id_and_text_one_stays(spark):
    rows = [(1, "same", "en", "a", 1), (1, "same", "en", "b", 2), (1, "same", "en", "b", 2), (1, "s a m e", "de", "c", 3),
            (None, "other", None, None, None), (None, "other", None, None, None), (2, None, None, None, None), (3, "", None, None, 0)]
    once = None
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, DOCS).repartition(parts)
        got = Counter(map(tuple, digest_index.drop_exact_copies(docs, digest_index.new_index(spark)).collect()))
        assert set(got.values()) == {1} and {row[0] for row in got} == {1, None, 2}
        assert [row[1] for row in got if row[0] == 1] == ["s a m e"]
        assert once is None or got == once
        once = got


@pytest.mark.parametrize(("similarity", "least"), [(0.81, 0.95), (0.85, 0.99)])
def test_similar_pairs_are_candidates(similarity, least):
    """Sixty blocks, the sift and the radius together, on sets of shingles of planted similarity."""
    draw, found = random.Random(24), []
    for _ in range(200):
        base = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice([80, 150, 300, 600]))]
        new = round((len(base) - 4) * (1 - similarity) / (1 + similarity))
        texts = [" ".join(base), " ".join([*base[: len(base) - new], *(f"n{draw.random()}" for _ in range(new))])]
        a, b = (np.frombuffer(x, np.uint8) for x in simhash.wide_fingerprints([simhash.shingles(t) for t in texts]))
        apart = np.bitwise_count(a ^ b)
        shared = (a.view(np.uint16)[simhash.SIFT // 16 :] == b.view(np.uint16)[simhash.SIFT // 16 :]).any()
        sifted = apart[:8].sum() <= simhash.FIRST_RADIUS and apart[: simhash.FULL_SIFT // 8].sum() <= simhash.FULL_RADIUS
        found.append(shared and sifted and apart.sum() <= simhash.WIDE_RADIUS * simhash.WIDE)
    assert np.mean(found) >= least


def plain_contaminations(docs, items):
    """Every window of every document against every item."""
    found = {}
    for doc_id, text in docs:
        own = [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]
        for item_id, item in items:
            wanted = [w for w in re.split(r"[^\w]+|_", (item or "").lower()) if w]
            if not own or not wanted:
                continue
            size = min(5, len(wanted))
            grams = lambda run: Counter(tuple(run[i : i + size]) for i in range(len(run) - size + 1))
            theirs = grams(wanted)
            for start in range(max(1, len(own) - len(wanted) + 1)):
                ours = grams(own[start : start + len(wanted)])
                common, both = (ours & theirs).total(), (ours | theirs).total()
                if both and common / both >= 0.8:
                    found[(doc_id, item_id)] = max(found.get((doc_id, item_id), 0), common / both)
    return found


def test_contaminations_equal_brute_force(spark):
    draw = random.Random(21)
    items = [(i, " ".join(words(draw, draw.choice([1, 2, 3, 5, 8, 15, 40])))) for i in range(25)] + [(90, None), (91, "..."), (3, "twice this id")]
    items.append((92, "na " * 12))
    docs = []
    for i in range(150):
        text = words(draw, draw.randint(0, 60))
        if i % 3 == 0:
            item = items[draw.randrange(25)][1].split()
            for _ in range(draw.choice([0, 0, 0, 1, 2, 4])):
                at = draw.randrange(len(item))
                kind = draw.choice(["change", "drop", "add"])
                item[at : at + 1] = {"change": ["zzz"], "drop": [], "add": [item[at], "yyy"]}[kind]
                item = item or ["x"]
            if draw.random() < 0.2:
                item = item[len(item) // 2 :] + item[: len(item) // 2]
            place = draw.randint(0, len(text))
            text = [*text[:place], *[w.upper() + "," for w in item], *text[place:]]
        docs.append((i, " ".join(text)))
    docs += [(200, None), (201, ""), (202, "na " * 30), (203, items[6][1]), (203, "twice this id, too")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = decontaminate.contaminations(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    want = plain_contaminations(docs, items)
    assert {(row.doc_id, row.item_id): round(row.similarity, 6) for row in got} == {k: round(v, 6) for k, v in want.items()}
    assert len(want) >= 25


def test_a_long_item_is_found(spark):
    draw = random.Random(22)
    item = " ".join(f"w{draw.randrange(10**6)}" for _ in range(1500))
    changed = item.split()
    changed[700] = "zzz"
    docs = [(1, f"before {' '.join(changed)} after"), (2, " ".join(item.split()[:700])), (3, item)]
    got = decontaminate.contaminations(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    ).collect()
    assert {row.doc_id for row in got} == {1, 3}


@pytest.mark.parametrize("text", ["²", "½ ¾", "12 ³!", "_", "٣", "", None])
def test_characters_that_are_no_letters_are_in_no_language(text):
    model = langid.fit([("en", "the and of"), ("de", "der und von")])
    assert model.predict([text or ""])[0][0] == langid.UNKNOWN


@pytest.mark.parametrize("text", ["ª", "ǅ", "ʰ", "日", "the ²"])
def test_letters_of_all_kinds_count(text):
    model = langid.fit([("en", "the and of"), ("de", "der und von")])
    assert model.predict([text])[0][0] in ("en", "de")


def test_scratch_of_a_stage_is_released(spark):
    mark = scratch_mark()
    first = written(spark.range(5).toDF("id"), "one")
    kept = written(first.filter("id > 1"), "two")
    release(spark, mark, kept)
    assert kept.count() == 3 and scratch_mark() == mark
    with pytest.raises(Exception):
        spark.read.parquet(*first.inputFiles()).count()


def test_the_pipeline_on_odd_rows_and_on_empty_tables(spark, tmp_path):
    draw = random.Random(23)
    rows = [(i, " ".join(words(draw, 60)), "en", f"s{i % 2}", None) for i in range(40)]
    rows += [(None, " ".join(words(draw, 60)), None, None, None), (50, None, None, None, None), (51, "", "en", "s0", 0),
             rows[3], rows[3], (52, " ".join(words(draw, 20_000)), "en", "s1", 1)]
    for name, own in (("odd", rows), ("empty", [])):
        folder = tmp_path / name
        spark.createDataFrame(own, DOCS).write.parquet(f"{folder}/documents.parquet")
        items = [(1, " ".join(words(draw, 20))), (None, None)] if own else []
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        mixed = corpus_pipeline.run(spark, str(folder)).collect()
        ids = [row.doc_id for row in mixed]
        assert len(ids) == len(set(ids)) and set(ids) <= {row[0] for row in own} - {50, 51}
        assert bool(mixed) == bool(own)
