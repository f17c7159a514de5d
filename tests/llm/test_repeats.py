"""Near-duplicate links, removal of repeated passages and the pipeline against brute force."""

import hashlib
import itertools
import os
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from strata.llm import common, jaccard_join, links, quality, repeats
from strata.llm.common import table


def shingles(text, k):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)])


def linked(rows, k, num, den):
    """(doc_id, n, component) by comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in itertools.combinations(range(len(sets)), 2):
        a, b = sets[x][1], sets[y][1]
        if a and b and den * len(a & b) >= num * len(a | b):
            parent[top(y)] = top(x)
    out = []
    for x, (i, s) in enumerate(sets):
        ids = [sets[y][0] for y in range(len(sets)) if top(y) == top(x) and sets[y][0] is not None]
        out.append((i, len(s), min(ids) if ids else None))
    return sorted(out, key=repr)


def edited(draw, words, changes):
    out = list(words)
    for _ in range(changes):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return out


def near_rows(seed):
    """Families of near copies around the threshold, chains of small edits, and a line that all documents share."""
    draw = random.Random(seed)
    rows, line = [], "this is the line that every document of the source carries at its end".split()
    for family in range(6):
        words = [f"w{draw.randrange(4000)}" for _ in range(draw.choice([12, 40, 200]))]
        for _ in range(draw.choice([1, 4, 12])):
            rows.append((len(rows), " ".join(edited(draw, words, draw.randint(0, len(words) // 30)) + line * (family % 2))))
        for _ in range(8):
            words = edited(draw, words, 1)
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize(("k", "num", "den", "block"), [(4, 85, 100, 1024), (5, 80, 100, 3)])
def test_links_equal_all_pairs(documents, awkward, monkeypatch, k, num, den, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "BUCKET_KEYS", 500)
    rows = near_rows(k) + [(10_000 + i if i is not None else None, t) for i, t in awkward]
    found = [tuple(r) for r in jaccard_join.near_duplicates(documents(rows), k, num, den).collect()]
    assert sorted(found, key=repr) == linked(rows, k, num, den)


@pytest.mark.parametrize("block", [1024, 50])
def test_near_copies_are_not_compared_pair_by_pair(documents, monkeypatch, block):
    """All near copies link with each other, but each of their meetings has a short text with the fewest shingles."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(edited(draw, words, 1))) for i in range(150)]
    rows += [(1000 + i, " ".join(words[i : i + 30])) for i in range(0, 75, 25)]
    asked, verified = [], jaccard_join.verified

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "verified", counted)
    found = [tuple(r) for r in jaccard_join.near_duplicates(documents(rows), 5, 80, 100).collect()]
    assert sorted(found, key=repr) == linked(rows, 5, 80, 100)
    assert sum(asked) <= 16 * len(rows), asked


def test_no_links_in_nothing(documents):
    assert jaccard_join.near_duplicates(documents([])).count() == 0
    assert [tuple(r) for r in jaccard_join.near_duplicates(documents([(1, None), (2, "")])).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


def test_count_tree_loses_nothing():
    rng = np.random.default_rng(2)
    points = rng.poisson(2, (500, jaccard_join.GROUPS)).astype(np.uint8)
    points[250:] = points[:250] + (rng.random((250, jaccard_join.GROUPS)) < 0.05)
    points[::9, 3] = jaccard_join.FULL
    n = points.sum(1, dtype=np.int64)
    tree = jaccard_join.CountTree(points, n)
    for q in range(0, 500, 25):
        room = jaccard_join.overlap_bound(points, points[q])
        wanted = {i for i in range(500) if room[i] >= jaccard_join.needed(n[i], n[q], 85, 100) and 85 * n[i] <= 100 * n[q] and 85 * n[q] <= 100 * n[i]}
        assert wanted <= set(tree.search(points[q], int(n[q]), 85, 100).tolist())


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300), (7, 7)]
    found = {r.node: r.component for r in links.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 61)} | {100: 100, 200: 100, 300: 100}


def test_pipeline_stages_send_texts_in_small_batches(spark, documents, tmp_path):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    default = spark.conf.get(name)
    try:
        docs = documents([(i, f"{i} " + "x" * 100_000) for i in range(100)]).coalesce(1)
        corpus_pipeline.hierarchical_packing(spark, docs, str(tmp_path))

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

        assert max(r.size for r in docs.select("text").mapInArrow(sizes, "size long").collect()) < 5_000_000
        spark.conf.set(name, "70000000b")  # a session's own value stays
        corpus_pipeline.hierarchical_packing(spark, docs, str(tmp_path))
        assert spark.conf.get(name) == "70000000b"
    finally:
        spark.conf.set(name, default)


def test_suffixes_end_with_their_text():
    """Zero bytes at an end are told from the end, and texts that follow one another in the same way are not one long repeat."""
    draw = np.random.default_rng(8)
    for k in range(200):
        sizes = draw.integers(1, 40, int(draw.integers(1, 12)))
        data = draw.integers(0, 1 + k % 3, sizes.sum()).astype(np.uint8)
        end = np.repeat(np.cumsum(sizes), sizes)
        room = end - np.arange(len(data))
        order = repeats.suffix_array(data, room)
        texts = [data[i : end[i]].tobytes() for i in range(len(data))]
        assert order.tolist() == sorted(range(len(data)), key=lambda i: (texts[i], end[i]))
        shared = [0] + [len(os.path.commonprefix([texts[a], texts[b]])) for a, b in zip(order[:-1], order[1:], strict=True)]
        assert repeats.common_prefixes(data, order, 50, room).tolist() == shared
    assert repeats.suffix_array(np.zeros(3, np.uint8)).tolist() == [2, 1, 0]


@pytest.mark.parametrize("seed", range(40))
def test_suffix_arrays(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 98 + seed % 4, int(rng.integers(1, 300))).astype(np.uint8)
    data = np.tile(data, 1 + seed % 5)
    raw, order = data.tobytes(), repeats.suffix_array(data)
    assert sorted(range(len(raw)), key=lambda i: raw[i:]) == order.tolist()
    shared = repeats.common_prefixes(data, order, 50)
    for at in range(1, len(raw)):
        x, y = raw[order[at - 1] :][:50], raw[order[at] :][:50]
        assert shared[at] == next((i for i, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))


def removed(rows, length):
    """(doc_id, bytes, removed, spans, sha256) by the definition."""
    texts = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        for at in range(len(b) - length + 1):
            first[b[at : at + length]] = min(i, first.get(b[at : at + length], i))
    out = []
    for (i, _), (rank, b) in zip(rows, texts, strict=True):
        gone = np.zeros(len(b), bool)
        for at in range(len(b) - length + 1):
            if first[b[at : at + length]] < rank:
                gone[at : at + length] = True
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passage_rows(seed):
    draw = random.Random(seed)
    passages = ["".join(draw.choices("abcdé ", k=draw.choice([44, 49, 50, 51, 80, 300]))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [draw.choice(passages) if draw.random() < 0.6 else "".join(draw.choices("efgh", k=draw.randint(0, 60))) for _ in range(draw.randint(0, 6))]
        rows.append((i if draw.random() < 0.9 else 7, "".join(parts)))
    return rows + [(100 + i, rows[3][1]) for i in range(4)] + [(200 + i, f"{i:05d}" + passages[2] + f"{i:07d}") for i in range(40)]


@pytest.mark.parametrize(("seed", "shard", "block"), [(1, 2**23, 2**22), (2, 400, 600), (3, 150, 10)])
def test_removal_by_the_definition(documents, awkward, monkeypatch, seed, shard, block):
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard)  # small shards: cores are dealt to several and merged
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    monkeypatch.setattr(repeats, "BUCKET_SAMPLES", 200)
    rows = passage_rows(seed) + [(1000 + i if i is not None else None, t) for i, t in awkward if t is None or len(t) < 10_000]
    cut = repeats.without_repeats(documents(rows)).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in cut), key=repr)
    assert found == removed(rows, 50)


def test_nothing_to_remove(documents):
    assert repeats.without_repeats(documents([])).count() == 0
    assert [r.n_removed for r in repeats.without_repeats(documents([(1, None), (2, "short")])).collect()] == [0, 0]


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Each stage on what the one before it kept, on a slice of the given documents as a table of its own."""
    sf, own = "/root/testdata/sf0.001", str(tmp_path)
    docs = table(spark, sf, "documents")
    docs.write.parquet(f"{own}/documents.parquet")
    table(spark, sf, "labels").write.parquet(f"{own}/labels.parquet")
    final = corpus_pipeline.run(spark, own).collect()

    scores = {r.doc_id: r.score for r in quality.scored_documents(docs, table(spark, sf, "labels")).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id] >= 0.5)
    rows = [(i, t) for (i, t), (_, _, c) in zip(rows, sorted(linked(rows, 5, 80, 100)), strict=True) if i == c]
    kept = {i: n for i, n, *_ in removed(rows, 50)}
    gone = {i: g for i, _, g, *_ in removed(rows, 50)}
    assert len(rows) < docs.count() and sum(gone.values()) > 0
    assert {r.doc_id for r in final} == set(kept)
    stage = dict(corpus_pipeline.STAGES)["suffix-array dedup"]
    left = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    cut = stage(spark, left, own)
    assert cut.columns == docs.columns
    for r in cut.collect():
        assert r.n_chars == len(r.text) and len(r.text.encode()) <= kept[r.doc_id] - gone[r.doc_id]
        assert gone[r.doc_id] or r.text == dict(rows)[r.doc_id]


def repeated_and_null_ids():
    """(doc_id, text): near copies with repeated and null ids, unique texts that share an id, and passages under one id."""
    draw = random.Random(11)
    words = [f"w{draw.randrange(9000)}" for _ in range(60)]
    other = [f"v{draw.randrange(9000)}" for _ in range(60)]
    lost = [f"n{draw.randrange(9000)}" for _ in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "more"])), (2, "a text of its own under the id of a near copy")]
    rows += [(3, " ".join(other))] * 3 + [(None, " ".join(lost)), (None, " ".join(lost)), (None, " ".join([*lost, "tail"]))]
    return rows + [(None, None), (None, None), (None, "nothing like it"), (4, ""), (4, "")]


def test_one_row_of_a_group_stays_whatever_its_ids(spark, documents, tmp_path):
    rows = repeated_and_null_ids()
    left = corpus_pipeline.jaccard_dedup(spark, documents(rows), str(tmp_path)).collect()
    ids = [(r.doc_id, " ".join((r.text or "").split()[:2])) for r in left]
    wanted = [rows[i] for i in (0, 2, 3, 6, 9, 10, 11, 12, 13)]
    assert sorted(ids, key=repr) == sorted([(i, " ".join((t or "").split()[:2])) for i, t in wanted], key=repr)


def test_cut_texts_go_to_their_own_rows(spark, documents, tmp_path):
    passage = "".join(random.Random(12).choices("abcdefgh ", k=80))
    rows = [(1, passage)] + [(5, f"{passage}{i}" * 2) for i in range(6)] + [(None, f"<{i}>" + passage) for i in range(3)] + [(5, "kept"), (None, None)]
    cut = corpus_pipeline.suffix_array_dedup(spark, documents(rows), str(tmp_path)).collect()
    by_row = sorted([(1, passage, 80), *[(5, f"{i}{i}", 2) for i in range(6)], *[(None, f"<{i}>", 3) for i in range(3)], (5, "kept", 4), (None, None, None)], key=repr)
    assert sorted([(r.doc_id, r.text, r.n_chars) for r in cut], key=repr) == by_row


def test_contexts_are_told_apart_by_all_bits(monkeypatch):
    """Hashes that differ in their lowest 24 bits only are different contexts, in a block and after packing."""
    hashes = repeats._context_hashes
    monkeypatch.setattr(repeats, "_context_hashes", lambda *of: hashes(*of) & np.uint64(2**24 - 1))
    core = "a core of thirty-two bytes, equal"
    texts = [f"{i:030d}{core}{i * 7919:030d}".encode() for i in range(20)]
    row = {
        "ids": np.arange(20, dtype="<i8").tobytes(),
        "starts": np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype("<i8").tobytes(),
        "data": repeats.zstandard.ZstdCompressor().compress(b"".join(texts)),
    }
    block = repeats.Block(row, 50, 1)
    assert len(np.unique(block.context)) > 1
    ((_, n, names, packed),) = block.entries()
    core_hash, context, _ = repeats._unpacked(packed, n, names)
    assert context.tolist() == block.context[block.first].tolist() and core_hash.tolist() == block.core[block.first].tolist()
    assert n >= 20


CLASHING = ["__row", "__Of", "__new", "of", "kept_text", "node", "n", "block", "rows", "kept", "Score_", "h1", "segment"]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:3]])
def test_stages_keep_columns_of_any_name(spark, tmp_path, stage):
    passage = "".join(random.Random(13).choices("abcdefgh ", k=90))
    rows = [(i, f"{i} {passage} {i}", "en", "s", 94, *[f"{c}{i}" for c in CLASHING]) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING))
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    for r in out.collect():
        assert [r[c] for c in CLASHING] == [f"{c}{r.doc_id}" for c in CLASHING]


def test_removal_without_a_length_column(spark, tmp_path):
    passage = "".join(random.Random(14).choices("abcdefgh ", k=90))
    docs = spark.createDataFrame([(1, passage), (2, passage + "x")], "doc_id long, text string")
    assert sorted(tuple(r) for r in corpus_pipeline.suffix_array_dedup(spark, docs, str(tmp_path)).collect()) == [(1, passage), (2, "x")]


def test_pipeline_over_an_empty_table(spark, tmp_path):
    table(spark, "/root/testdata/sf0.001", "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, "/root/testdata/sf0.001", "labels").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_only_results_take_room(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr("strata.llm.common.scratch_dir", lambda spark, label: f"{tmp_path}/{label}-{random.randrange(10**9)}")
    corpus_pipeline.jaccard_dedup(spark, documents(near_rows(2)), "").count()
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == ["rows", "surplus"]


def test_whole_characters_by_the_definition_without_python(spark, documents, tmp_path):
    draw = np.random.default_rng(3)
    texts = ["aé中\U0001f600\x85\n\x00ü", "\ue000\ud7ff\U0010ffffz", "plain " * 5000]
    rows = [(0, None), (1, b""), (2, b"\xed\xa0\x80\xf4\x90\x80\x80\xc0\xaf\xe0\x80\x80x$1\\")]
    for i in range(400):
        data = np.frombuffer(texts[i % 3].encode(), np.uint8)
        rows.append((len(rows), data[draw.random(len(data)) < 0.8].tobytes()))
        rows.append((len(rows), draw.choice(np.array([0x41, 0x80, 0xBF, 0xC3, 0xE0, 0xE2, 0xED, 0xF0, 0xF4, 0xFF], np.uint8), 30).tobytes()))
    kept = spark.createDataFrame(rows, "i long, kept binary")
    found = {r.i: r.kept_text for r in repeats.whole_characters(kept).collect()}
    assert found == {i: (b or b"").decode("utf-8", "ignore") for i, b in rows}
    plan = repeats.whole_characters(kept)._jdf.queryExecution().toString()
    assert "InArrow" not in plan and "Python" not in plan.replace("PythonRDD", "")


def test_copies_of_texts_are_written_small(spark, documents):
    rows = common.with_row_keys(documents([(i, f"{i} some words that come again") for i in range(50)]))
    for path in rows.inputFiles():
        group = pq.ParquetFile(path.removeprefix("file:")).metadata.row_group(0)
        assert {group.column(c).compression for c in range(group.num_columns)} == {"ZSTD"}
    assert rows.count() == 50
