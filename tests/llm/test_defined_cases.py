"""The final columns of the queries without SQL, and the defined cases of the
pipeline's stages."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import CLASHES, DOCS, drop_lines, quality_brute, sample_rows
from wordmill.llm import packing
from wordmill.llm.queries import END_ID, PIECE_MODEL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_quality_query(spark, texts):
    rows = QUERIES["op6_quality_rules"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n_words, chars, symbols, lines, repeated = quality_brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (n_words, chars, symbols, lines)
        if n_words < 2000:  # longer ones are too slow for the brute force
            assert r.n_repeat_words == repeated
        assert r.base_failed == (n_words < 20 or 100 * r.n_repeat_words > 30 * n_words)
        assert not (r.kept and r.base_failed)


def test_sentencepiece_query(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=str(PIECE_MODEL))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op7_sentencepiece"](spark, SF).collect()}
    want = {}
    for d, text in texts.items():
        ids = library.encode(text)
        want[d] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    assert got == want


def test_packed_query(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=str(PIECE_MODEL))
    packed = QUERIES["op10_packed_ids"](spark, SF)
    back = {}
    for r in packing.unpack_segments(packed).orderBy("doc_id", "start").collect():
        back.setdefault(r.doc_id, []).extend(r.ids)
    assert back == {d: [*library.encode(text), END_ID] for d, text in texts.items()}


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Nulls in every column, empty and very long texts, repeated rows and ids,
    and columns with the names that the stages use themselves."""
    rows = sample_rows()
    rows += [rows[3], (5, "another text under a used id " * 30, "en", None, 3), (None, "no id " * 40, None, None, None), (None,) * 5, (60, None, None, "src1", None)]
    clashes = CLASHES | {"class": 3, "gone": 1, "first": 2, "component": 0, "probability": 0.5, "mix_epoch": 1, "tokens": 2, "decoded": "z", "n_lines": 0}
    docs = spark.createDataFrame(rows, DOCS).withColumns({k: F.lit(v) for k, v in clashes.items()})
    labels = spark.createDataFrame([(i % 50 if i else None, i % 2 if i % 7 else None, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    folder = str(tmp_path_factory.mktemp("odd"))
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder, docs


def key(r):
    return (r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "")


def test_stages_on_odd_rows(spark, odd_tables):
    folder, made = odd_tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    all_rows = sorted(map(key, docs.collect()))
    good = corpus_pipeline.quality_rules(spark, docs, folder)
    assert good.columns == made.columns
    kept = sorted(map(key, good.collect()))
    assert all(r in all_rows for r in kept) and not any(len(t.split()) < 20 for _, _, _, t in kept)

    # The other stages on all rows.
    lines = corpus_pipeline.dedup_lines(spark, docs, folder)
    assert lines.columns == made.columns
    by_text = [(r.doc_id, r.text, r.n_chars) for r in lines.collect()]
    assert len(by_text) == len(all_rows) and all(n == len(t) for _, t, n in by_text)
    once = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and r.doc_id not in (3, 5)]
    single = drop_lines(once)
    assert all(t == single[d][2] for d, t, _ in by_text if d in (15, 18, 36, 45, 46, 48))

    near = corpus_pipeline.dedup_near(spark, docs, folder)
    assert near.columns == made.columns
    left = [r.doc_id for r in near.collect()]
    # The second text under id 5 is like no other; id 3 holds one text twice.
    unique = dict((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and not (r.text or "").startswith("another"))
    component, _ = brute.near_components(sorted(unique.items()), 5, 80)
    want = [d for d, c in component.items() if c == d for _ in range(2 if d in (3, 5) else 1)]
    assert sorted(d for d in left if d is not None) == sorted(want) and left.count(None) == 2

    mixed = corpus_pipeline.mix_sources(spark, docs, folder)
    assert mixed.columns == made.columns and {key(r) for r in mixed.collect()} <= set(all_rows)

    library = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    coded = corpus_pipeline.encode(spark, docs, folder).collect()
    by_id = {r.doc_id: r for r in coded}
    assert len(coded) == len(all_rows)
    for d, text in once:
        ids = library.encode(text or "")
        assert (list(by_id[d].ids), by_id[d].n_tokens, by_id[d].decoded_sha256) == (ids, len(ids), sha(library.decode(ids)))


def test_pipeline_on_an_empty_table(spark, odd_tables, tmp_path):
    folder, made = odd_tables
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, str(tmp_path))
        assert done.columns == made.columns and done.collect() == [], name
    # Documents without any label are judged by the counted rules alone.
    some = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(corpus_pipeline.quality_rules(spark, some, str(tmp_path)).collect()) > 5
