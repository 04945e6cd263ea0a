from collections import Counter

import corpus_pipeline
import pandas as pd
from test_shingle_sets import by_hand
from tidemark import session
from tidemark.llm import mixing, simhash
from tidemark.llm.queries import byte_bpe
from tokenizers import Tokenizer


def test_stages_on_the_table(spark):
    root = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    outs, columns = [docs.collect()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, root), name)
        outs.append(docs.collect())
        assert docs.columns == columns or name == "packing"
    start, clean, good, single, mixed, packed = outs
    assert {r.doc_id for r in start} > {r.doc_id for r in clean} > {r.doc_id for r in good} > {r.doc_id for r in single}
    gone = {r.doc_id for r in start} - {r.doc_id for r in clean}
    assert not [i for i in gone if i in labels and not labels[i].toxic]
    gone = {r.doc_id for r in clean} - {r.doc_id for r in good}
    assert len([i for i in gone if i in labels and labels[i].quality]) <= 2
    rows = sorted(good, key=lambda r: r.doc_id)
    assert sorted(r.doc_id for r in single) == by_hand(rows)
    words, sizes = Counter(), Counter()
    for r in single:
        sizes[r.source] += len(r.text.encode().split())
    for r in mixed:
        words[r.source] += len(r.text.encode().split())
    order = sorted(sizes)
    for s, t in zip(order, mixing.targets([sizes[s] for s in order])):
        assert abs(words[s] - t) <= max(len(r.text.encode().split()) for r in single if r.source == s)
    assert max(Counter(mixed).values()) <= 2 and {r.doc_id for r in mixed} <= {r.doc_id for r in single}
    ids = Tokenizer.from_file(byte_bpe()).encode_batch([r.text for r in mixed], add_special_tokens=False)
    assert sum(r.length for r in packed) == sum(len(e.ids) + 1 for e in ids)


def test_repeats_nulls_and_names(spark):
    names = "doc_id long, text string, lang string, source string, n_chars long, toxic int, keep string, __one string, rows long, verdict string, chosen_key long, one string, rest int, Copy string"
    text = "the old man and the sea of the north are a story for all of us"
    rows = [(3, text, "en", "a", 1, 5, "k", "o", 9, "v", 8, "1", 7, "c")] * 4 + [(None, text, "en", "a", 1, 5, "k", "o", 9, "v", 8, "1", 7, "c"), (1, text, "en", None, 1, 5, "k", "o", 9, "v", 8, "1", 7, "c")]
    rest = (9, "v", 8, "1", 7, "c")
    rows += [(None,) * 14, (7, "", "", "b", 0, 0, "", "", *rest), (8, None, "", "b", 0, 0, "", "", *rest)]
    docs = spark.createDataFrame(rows, names)
    got = sorted((r.doc_id, r.text) for r in simhash.firsts(docs).collect())
    assert got == [(1, text), (7, "")]
    assert [r.doc_id for r in simhash.firsts(docs.where("doc_id = 3")).collect()] == [3]
    assert len(simhash.firsts(docs.where("doc_id is null and text is null")).collect()) == 1
    plain = docs.drop("__one")
    copies = mixing.taken(plain, mixing.words("text"))
    assert copies.columns == plain.columns
    assert copies.where("doc_id = 3").count() in range(4, 9)
    for stage in (lambda d: simhash.firsts(d), lambda d: mixing.taken(d, mixing.words("text"))):
        assert stage(plain.limit(0)).collect() == []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, plain, "/root/testdata/sf0.001")
        assert len(out.collect()) >= 0 and stage(spark, plain.limit(0), "/root/testdata/sf0.001").collect() == []


def test_stages_send_small_batches_to_python(spark):
    docs = spark.createDataFrame([(i, f"text {i} of plain words", "en", "a", 1) for i in range(3)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = spark.range(0, 5_000, 1, 1)
    before = spark.conf.get(session.BATCH_KEY)
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.set(session.BATCH_KEY, "10000")
        stage(spark, docs, "/root/testdata/sf0.001")
        sizes = rows.mapInPandas(lambda batches: (pd.DataFrame({"n": [len(x)]}) for x in batches), "n long")
        assert max(r.n for r in sizes.collect()) <= session.BATCH
    spark.conf.set(session.BATCH_KEY, "7")
    session.small_batches(spark)
    assert spark.conf.get(session.BATCH_KEY) == "7"
    spark.conf.set(session.BATCH_KEY, before)
