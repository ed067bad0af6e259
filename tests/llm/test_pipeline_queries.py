from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import DATA, SCHEMA, odd_rows, rows_of
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from spindlewave.llm import credentials, mixing, queries
from spindlewave.llm.common import stored
from tests.llm.test_dedup_ann import duplicates_by_brute_force
from tests.llm.test_texts import base_spans

NATIVE = ("op3_raked_mixing", "op9_association_url_filter")


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, oracle, name):
    found = queries.QUERIES[name](spark, DATA).toPandas()
    assert len(found)
    if name in queries.ORACLES:
        assert rows_of(found) == rows_of(oracle.sql(queries.ORACLES[name]).df())


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_plans(spark, name):
    plan = queries.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}

    good = stored(corpus_pipeline.keep_quality(spark, docs, DATA), "good")
    kept = {r["doc_id"] for r in good.collect()}
    assert good.columns == docs.columns
    assert sum((d in kept) == (q == 1) for d, q in labels.items()) >= 0.95 * len(labels)

    fresh = stored(corpus_pipeline.drop_near_duplicates(spark, good, DATA), "fresh")
    expected = duplicates_by_brute_force([(d, before[d]["text"]) for d in kept], 5)
    assert sorted(r["doc_id"] for r in fresh.collect()) == sorted(d for d, _, _, stays in expected if stays)

    clean = stored(corpus_pipeline.redact_secrets(spark, fresh, DATA), "clean")
    marks = {r["doc_id"]: r["text"] for r in clean.collect()}
    spans = credentials.secret_spans(fresh, credentials.learn(fresh)).collect()
    for r in spans:
        assert ("[SECRET]" in marks[r["doc_id"]]) == bool(r["spans"])
        assert r["spans"] or marks[r["doc_id"]] == before[r["doc_id"]]["text"]

    mixed = stored(corpus_pipeline.mix_sources(spark, clean, DATA), "mixed")
    flags = mixing.mixed(mixing.described(clean), queries.MARGINS, queries.KEEP).where("sampled")
    assert sorted(r[0] for r in mixed.select("doc_id").collect()) == sorted(r[0] for r in flags.select("doc_id").collect())

    packed = corpus_pipeline.pack_sequences(spark, mixed, DATA).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed.collect()}


def without_secrets(text, spans):
    """The text with every span, or run of spans that overlap, replaced."""
    found, at, reach = [], 0, -1
    for start, stop in sorted(spans):
        if start >= reach:
            if reach >= 0:
                at = reach
            found += [text[at:start], "[SECRET]"]
            reach = stop
        reach = max(reach, stop)
    return text if reach < 0 else "".join(found) + text[reach:]


def test_run_equals_a_plain_chain(spark, tokenizer):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {r["doc_id"] for r in corpus_pipeline.keep_quality(spark, docs, DATA).collect()}
    kept = sorted(d for d, _, _, stays in duplicates_by_brute_force([(d, rows[d]["text"]) for d in good], 5) if stays)

    # Base spans are searched anew; the spans of learned formats are the operator's.
    fresh = stored(docs.where(F.col("doc_id").isin(kept)), "fresh")
    learned = {r["doc_id"]: r["spans"] for r in credentials.secret_spans(fresh, credentials.learn(fresh)).collect()}
    texts = {}
    for d in kept:
        text = rows[d]["text"] or ""
        spans = [(a, b) for a, _, b in base_spans(text)]
        spans += [tuple(map(int, s.split(":")[1:])) for s in learned[d].split(",") if s.startswith("format")]
        texts[d] = without_secrets(text, spans)

    # Documents of a cell share a probability; the sampled tokens have the shares wanted.
    found = corpus_pipeline.run(spark, DATA).toPandas()
    sampled = set(found["doc_id"])
    assert sampled <= set(kept)
    words = {d: len(re.findall("[^\x20\x09-\x0d]+", texts[d])) for d in kept}
    share = {d: int(hashlib.md5(str(d).encode()).hexdigest()[:8], 16) / 2**32 for d in kept}
    total = sum(words.values())
    flat = stored(spark.createDataFrame([(d, texts[d], rows[d]["lang"], rows[d]["source"]) for d in kept], "doc_id long, text string, lang string, source string"), "flat")
    mixed = mixing.mixed(mixing.described(flat), queries.MARGINS, queries.KEEP)
    chance = {r["doc_id"]: r["probability"] for r in mixed.collect()}
    assert sampled == {d for d in kept if share[d] < chance[d]}
    assert sum(words[d] * chance[d] for d in kept) == pytest.approx(queries.KEEP * total, rel=1e-3)
    cells = {}
    for r in mixed.collect():
        cells.setdefault((r["source"], r["lang"], r["topic"]), set()).add(r["probability"])
    assert all(len(chances) == 1 and 0 <= min(chances) and max(chances) <= 1 for chances in cells.values())
    # The targets of the sources are the roots of their tokens, and within reach.
    own = Counter()
    for d in kept:
        own[rows[d]["source"]] += words[d]
    roots = {name: n**0.5 for name, n in own.items()}
    reached = Counter()
    for d in kept:
        reached[rows[d]["source"]] += words[d] * chance[d] / (queries.KEEP * total)
    possible_ = [name for name, n in own.items() if roots[name] / sum(roots.values()) * queries.KEEP * total < 0.8 * n]
    assert possible_ and all(abs(reached[n] - roots[n] / sum(roots.values())) < 0.02 for n in possible_)

    # Every piece of every text, whole, in sequences without gaps.
    library = Tokenizer.from_file(tokenizer)
    expected = []
    for d in sampled:
        ids = library.encode(texts[d], add_special_tokens=False).ids + [queries.END]
        for piece, a in enumerate(range(0, len(ids), queries.CAPACITY)):
            part = ids[a : a + queries.CAPACITY]
            expected.append((d, piece, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found[columns].values.tolist())) == sorted(expected)
    for _, part in found.sort_values("offset").groupby("sequence_id"):
        ends = part["offset"] + part["length"]
        assert part["offset"].tolist() == [0, *ends.tolist()[:-1]] and ends.iloc[-1] <= queries.CAPACITY
    assert found["sequence_id"].nunique() <= -(-found["length"].sum() // queries.CAPACITY) + 1


def test_odd_documents_pass_all_stages(spark, odd_docs, no_docs, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([(k, q, None) for k in range(20) for q in (1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, path), "stage")
        assert after.columns == docs.columns, name
        docs = after
    rows = [r["doc_id"] for r in docs.collect()]
    ids = [x for x in rows if x is not None]
    assert len(ids) == len(set(ids))
    assert len(rows) <= len(odd_rows())
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, path), "stage")
        assert docs.count() == 0
    assert os.path.isdir(path) and SCHEMA
