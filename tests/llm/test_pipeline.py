"""The pipeline's stages one after another against brute force on a small corpus."""

import os
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("paperloom.llm")
pytest.importorskip("corpus_pipeline")
import corpus_pipeline  # noqa: E402
from paperloom.llm import common  # noqa: E402
from test_language import packed  # noqa: E402
from test_near import expected, families  # noqa: E402
from test_plain_ops import lower  # noqa: E402
from test_repeats import brute  # noqa: E402

rng = random.Random(4)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents and labels: families, copies, passages, junk, very short and null texts."""
    words = [f"w{k}" for k in range(500)]
    texts = families()
    passage = " ".join(rng.choices(words, k=120))
    texts += [f"{' '.join(rng.choices(words, k=70))} {passage} {' '.join(rng.choices(words, k=50))}" for _ in range(10)]
    texts += [texts[5]] * 4 + [texts[7].upper()] * 3
    junk = [" ".join(f"{w}##$$" for w in rng.choices(words, k=100)) for _ in range(120)]
    good = [" ".join(rng.choices(words, k=150)) for _ in range(120)]
    rows = [(k, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, t in enumerate([*texts, *junk, *good])]
    labels = [(k, int(not len(texts) <= k < len(texts) + 120), 0) for k in range(len(texts), len(rows), 2)]
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, {k: t for k, t, *_ in rows}, set(range(len(texts), len(texts) + 120))


def test_stages(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    d, texts, junk = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    out = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.written(stage(spark, docs, d), f"test-{k}")
        if k < len(stages) - 1:
            assert docs.dtypes == spark.read.parquet(f"{d}/documents.parquet").dtypes
            out[name] = {r.doc_id: r for r in docs.collect()}
            assert docs.count() == len(out[name])
    quality, exact, near, passages = (out[n] for n in list(stages)[:4])
    # clean documents stay, junk and what fails the base rules goes
    long = {k for k, t in texts.items() if len((t or "").split()) >= 50}
    assert set(quality) == long - junk
    best = {}
    for k in quality:
        best[lower(texts[k])] = max(k, best.get(lower(texts[k]), k))
    assert set(exact) == set(best.values())
    classes = {doc: c for doc, c, _, _ in expected([(k, texts[k]) for k in sorted(exact)])}
    assert set(near) == set(classes.values())
    order = sorted(near)
    assert set(passages) == set(near)
    for k, (n_bytes, removed, _, _) in zip(order, brute([texts[k] for k in order], corpus_pipeline.PASSAGE_BYTES), strict=True):
        assert len(passages[k].text.encode()) == n_bytes - removed and passages[k].n_chars == len(passages[k].text)
        assert removed or passages[k].text == texts[k]
    assert sum(len(passages[k].text) < len(texts[k]) for k in order) >= 10
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = docs.collect()
    for k in order:
        ids = np.array([*model.encode(passages[k].text, add_special_tokens=False).ids, 0], "<u4")
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == k] == [(0, 0, len(ids), zlib.crc32(ids.tobytes()))]
    assert packed(rows) <= sum(r.length for r in rows) / 2048 + 2


def test_run_gives_the_last_stage(spark, corpus):
    d, _, _ = corpus
    assert corpus_pipeline.run(spark, d).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_repeated_rows_and_clashing_columns_through_all_stages(spark, corpus):
    """Rows that repeat id and text, null ids and nulls in all columns; extra columns named like those of the operators."""
    d, texts, _ = corpus
    good = [t for t in texts.values() if len((t or "").split()) >= 150 and "#" not in t][:40]
    rows = [(k, t, None, None, None, "x", 1) for k, t in enumerate(good)] * 2 + [(None, good[0], None, None, None, "y", 2), (None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, COLUMNS + ", runs string, _h int")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, d), "test-odd")
        if name != "best-fit packing":
            assert docs.dtypes == before.dtypes
    ids = [r.doc_id for r in docs.where("piece = 0").collect()]
    assert len(ids) == len(set(ids)) and 1 < len(ids) <= 40


def test_stages_on_an_empty_table(spark, corpus):
    d, _, _ = corpus
    none = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, d).count() == 0


def test_stages_leave_no_tables(spark, tmp_path, monkeypatch):
    """After a run the shared folder has the last stage and the sequences only."""
    if not os.path.isdir("/root/testdata/sf0.001") or corpus_pipeline.__file__ is None:
        pytest.skip("test tables are not here")
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").count()
    names = sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    assert names == ["sequences", "stage-best-fit-packing"] and rows > 0
