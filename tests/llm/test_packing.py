import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, queries


def library_ids(texts):
    tokenizer = Tokenizer.from_file(queries.byte_bpe())
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_are_the_librarys(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(200).collect()
    texts = [r.text or "" for r in docs] + [
        "", " ", "  a  b\n\n\tc ", "<|endoftext|>x<|endoftext|>", "it's we'll I'D ٣٤ ½ 漢字かな 🙂🙃", "\x00\x7f\u00ad\u2028é", "a" * 5_000, "\r\n \u00a0x",
    ]
    ids = packing.encoder(queries.byte_bpe())
    assert [ids(t) for t in texts] == library_ids(texts)


def check(rows, docs, limits):
    """Every id in one piece, no gap in a sequence, no limit broken; ``docs``: lists of ids by key and number."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r[0]].append(r)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(p.loss_tokens for p in pieces) <= limits.loss
    for key, copies in docs.items():
        wanted = []
        for ids in copies:
            wanted.append((len(ids), ids))
        assert sum(p.length for p in by_doc[key]) == sum(n for n, _ in wanted)
        if len(copies) == 1:
            at = 0
            for p in sorted(by_doc[key], key=lambda p: p.start):
                part = np.array(copies[0][p.start : p.start + p.length], "<u4")
                assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(copies[0]), zlib.crc32(part.tobytes()))
                at += p.length
    return by_sequence


def test_table(spark, root):
    got = queries.op5_packing(spark, root).collect()
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()
    ids = {r.doc_id: [[*x, 0]] for r, x in zip(docs, library_ids([r.text or "" for r in docs]))}
    sequences = check(got, ids, packing.Limits())
    total = sum(len(x[0]) for x in ids.values())
    assert len(sequences) - -(-total // 1_024) <= 8


def test_edges(spark):
    rows = [(1, None, True), (2, "", True), (None, "one two", None), (3, "same", False), (3, "same", False), (2**60 + 1, "w " * 40_000, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start boolean")
    got = packing.packed(docs, queries.byte_bpe()).collect()
    assert {r.doc_id for r in got} == {1, 2, None, 3, 2**60 + 1}
    assert sum(r.length for r in got if r.doc_id in (1, 2)) == 2
    assert sum(r.length for r in got if r.doc_id == 3) == 2 * len(library_ids(["same"])[0]) + 2
    assert packing.packed(docs.limit(0), queries.byte_bpe()).collect() == []
    borne = packing.packed(docs, queries.byte_bpe(), loss="start").collect()
    assert sum(r.loss_tokens for r in borne) == sum(r.length for r in borne if r.doc_id not in (3, None))


@pytest.mark.parametrize("limits", [packing.Limits(100, 3, 1_000), packing.Limits(100, 50, 20), packing.Limits(64, 64, 64), packing.Limits(100, 1, 7)])
def test_limits_hold_together(limits):
    rng = np.random.default_rng(4)
    docs = [(i, rng.integers(0, 9, n).astype("<u4"), rng.random(n) < 0.3) for i, n in enumerate(rng.integers(1, 300, 400))]
    got = list(packing.pack(iter(docs), limits))
    seen = defaultdict(list)
    for pieces in got:
        assert sum(len(p.ids) for p in pieces) <= limits.tokens and len(pieces) <= limits.segments
        assert sum(p.loss for p in pieces) <= limits.loss
        for p in pieces:
            seen[p.key].append((p.start, p.ids, p.loss))
    for key, ids, bears in docs:
        parts = sorted(seen[key], key=lambda x: x[0])
        assert np.array_equal(np.concatenate([p[1] for p in parts]), ids) and sum(p[2] for p in parts) == bears.sum()
    if limits == packing.Limits(64, 64, 64):
        assert len(got) == -(-sum(len(d[1]) for d in docs) // 64)


def test_conversations(spark, root):
    turns = spark.read.parquet(f"{root}/conversations.parquet").selectExpr("conv_id", "text", "role = 'assistant' bears")
    limits = packing.Limits(256, 6, 120)
    got = packing.packed(turns, queries.byte_bpe(), "conv_id", loss="bears", limits=limits).collect()
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append(r)
    for pieces in by_sequence.values():
        assert sum(p.length for p in pieces) <= 256 and len(pieces) <= 6 and sum(p.loss_tokens for p in pieces) <= 120
