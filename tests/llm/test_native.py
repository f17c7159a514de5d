"""Sharding and fingerprints against plain Python."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import fingerprints, sharding


def rendezvous(key, weights):
    def cost(shard):
        u = (int(hashlib.md5(f"{key}:{shard}".encode()).hexdigest()[:13], 16) + 1) / 2**52
        return -math.log(u) / weights[shard]

    return min(range(len(weights)), key=cost)


def test_shards_equal_plain_rendezvous(documents, awkward):
    weights = [1.0, 2.0, 0.5, 1.0]
    rows = sharding.shard_documents(documents(awkward), weights).collect()
    assert len(rows) == len(awkward)
    for r in rows:
        name = "null" if r.doc_id is None else str(r.doc_id)
        assert r.shard == rendezvous(name, weights)
        assert r.grown_shard == rendezvous(name, [*weights, 1.0]) and r.grown_shard in (r.shard, 4)
    expected = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in awkward)
    assert sorted((r.size, r.text_crc32) for r in rows) == expected
    for shard in range(4):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_weights_are_followed_and_few_keys_move(spark):
    placed = sharding.place(spark.range(20_000).withColumnRenamed("id", "doc_id"), "doc_id", [1.0, 3.0])
    shares = {r["shard"]: r["count"] / 20_000 for r in placed.groupBy("shard").count().collect()}
    assert abs(shares[1] - 0.75) < 0.02
    moved = placed.where("shard <> grown_shard")
    assert abs(moved.count() / 20_000 - 0.2) < 0.02 and moved.where("grown_shard <> 2").count() == 0


def test_shards_of_nothing_and_bad_weights(documents):
    assert sharding.shard_documents(documents([]), [1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.place(documents([]), "doc_id", [0.0])


def marks_of(spark, text, k=3, window=4):
    row = fingerprints.fingerprints(spark.createDataFrame([(text,)], "text string"), k, window)
    return row.select(fingerprints.hashes(F.col("marks")).alias("h"), fingerprints.positions(F.col("marks")).alias("p"), "marks").first()


def winnowed(spark, text, k=3, window=4):
    """(position, hash) by the definition, from Spark's own field hashes."""
    fields = (text or "").split(" ")
    rows = spark.createDataFrame([(f,) for f in fields], "f string").select(F.pmod(F.xxhash64("f"), F.lit(fingerprints.PRIME)).alias("h"))
    h = [r.h for r in rows.collect()]
    grams = []
    for i in range(max(1, len(h) - k + 1)):
        value = h[i]
        for j in range(1, k):
            value = (value * fingerprints.BASE + (h[i + j] if i + j < len(h) else 0)) % fingerprints.PRIME
        grams.append(value)
    chosen = []
    for i in range(max(1, len(grams) - window + 1)):
        least = min(grams[i : i + window])
        place = max(j for j in range(i, min(i + window, len(grams))) if grams[j] == least)
        if (place, least) not in chosen:
            chosen.append((place, least))
    return chosen


@pytest.mark.parametrize("text", ["", None, "a", "a b", "a b c d e f g h i j", "a a a a a a a a a", "x y x y x y z x y x y x y"])
def test_winnowing_by_the_definition(spark, text):
    marks = marks_of(spark, text).marks
    found = [(fingerprints.LAST - m % 2**31, m >> 31) for m in marks]
    assert found == winnowed(spark, text)


def test_shared_runs_share_a_mark(spark):
    a, b = marks_of(spark, "q w e r t y u i o p"), marks_of(spark, "1 2 e r t y u i 3 4 5")
    assert set(a.h) & set(b.h)


def test_edits_follow_the_order_of_documents(documents, awkward):
    rows = fingerprints.edited_fingerprints(documents(awkward)).collect()
    assert len(rows) == len(awkward)
    unique = {(i, t or "") for i, t in awkward if i != 13}
    order = sorted((d for d in unique if d[0] is not None), reverse=True) + [d for d in unique if d[0] is None]
    for r in rows:
        if r.doc_id in (13, 14):  # documents of one id follow each other in either order
            continue
        at = order.index((r.doc_id, r.text))
        after = order[(at + 1) % len(order)][1]
        third = len(r.text) // 3
        assert r.n_chars == len(r.text)
        if order[(at + 1) % len(order)][0] != 12:
            assert r.edited_text == r.text[: len(r.text) - third] + after[:third]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.marks) == r.marks
    assert fingerprints.edited_fingerprints(documents([])).count() == 0
    alone = fingerprints.edited_fingerprints(documents([(1, "a b c d e f")])).first()
    assert alone.edited_text == "a b c d " + "a b" and alone.near_next == 1.0


ROLLED = ["", "a", "short", "exactly sixteen!", "中文字" * 40, "a\nb\tc\U0001f600é" * 20, "x" * 90, "".join(chr(97 + i * i % 23) for i in range(300))]


@pytest.mark.parametrize(("k", "window"), [(16, 32), (8, 4), (2, 1)])
def test_rolled_grams_by_the_definition(spark, k, window):
    """Grams are told by their place; equal grams have equal hashes, and the smallest hash of each window is chosen."""
    rows = spark.createDataFrame([(t,) for t in ROLLED], "t string")
    every = {r.t: r.m for r in rows.select("t", fingerprints.rolled(F.col("t"), k, 1).alias("m")).collect()}
    found = {r.t: r.m for r in rows.select("t", fingerprints.rolled(F.col("t"), k, window).alias("m")).collect()}
    of_gram = {}
    for text in ROLLED:
        grams = [m >> 31 for m in every[text]]
        assert len(grams) == max(1, len(text) - k + 1)
        assert [fingerprints.LAST - m % 2**31 for m in every[text]] == list(range(len(grams)))
        for i, h in enumerate(grams):
            assert of_gram.setdefault(text[i : i + k], h) == h
        chosen = []
        for i in range(max(1, len(grams) - window + 1)):
            least = min(grams[i : i + window])
            place = max(j for j in range(i, min(i + window, len(grams))) if grams[j] == least)
            if (place, least) not in chosen:
                chosen.append((place, least))
        assert [(fingerprints.LAST - m % 2**31, m >> 31) for m in found[text]] == chosen
    assert len(set(of_gram.values())) == len(of_gram)


def test_texts_without_spaces_stay_like_their_edits(documents):
    long = "".join(chr(0x4E00 + i * i % 2003) for i in range(900))
    rows = fingerprints.edited_fingerprints(documents([(1, long), (2, "\n".join(f"line{i}" for i in range(200)))])).collect()
    assert all(0.4 < r.near_edited < 1 and r.near_next == 0 for r in rows)


def test_marks_of_an_edit_are_those_of_its_text(spark, documents):
    """Taken over from both texts or hashed at the seam, they equal the marks of the whole edited text."""
    draw = random.Random(5)
    sizes = [0, 1, 2, 15, 16, 40, 47, 60, 93, 94, 95, 120, 141, 150, 200, 280, 285, 300, 420, 423, 426, 600, 900, 3000, 13_000]
    texts = ["".join(draw.choices(alphabet, k=n)) for alphabet in ("ab", "abcdefgh \n中é\U0001f600", "x") for n in sizes]
    draw.shuffle(texts)
    for k, window in ((16, 32), (3, 4)):
        marked = fingerprints.edited_fingerprints(documents(list(enumerate(texts))), k, window)
        rows = marked.select("edited_text", "edited_marks", "marks", "text").collect()
        assert len(rows) == len(texts)
        every = spark.createDataFrame(sorted({(t,) for r in rows for t in (r.edited_text, r.text)}), "t string")
        expected = {r.t: r.m for r in every.select("t", fingerprints.rolled(F.col("t"), k, window).alias("m")).collect()}
        assert all(r.edited_marks == expected[r.edited_text] and r.marks == expected[r.text] for r in rows)


def test_stretches_give_the_marks_of_the_whole(spark):
    draw = random.Random(6)
    texts = ["".join(draw.choices("abc é中", k=n)) for n in (0, 5, 46, 47, 48, 62, 63, 64, 65, 78, 79, 80, 127, 128, 129, 500, 1000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    both = rows.select(fingerprints.rolled(F.col("t"), 16, 32, 16).alias("a"), fingerprints.rolled(F.col("t")).alias("b")).collect()
    assert all(r.a == r.b for r in both)


def test_a_text_of_thirty_million_characters(documents):
    """Its arrays are those of one stretch, not of the text."""
    long = "".join(chr(97 + i * i % 23) for i in range(100_000)) * 300
    rows = {r.doc_id: r for r in fingerprints.edited_fingerprints(documents([(1, long), (2, "short")])).select("doc_id", "n_chars", F.size("marks").alias("m")).collect()}
    assert rows[1].n_chars == 30_000_000 and rows[1].m > 30_000_000 / 32 - 2 and rows[2].m == 1
