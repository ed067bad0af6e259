from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spindlewave.llm import manifest, phrases, queries, toxicity
from tests.llm.conftest import DATA, PROSE, odd_rows, row, rows_of

SHORT = "doc_id long, text string, lang string, source string, n_chars long"


def shrink(rows):
    return [r[:5] for r in rows]


# Phrases


def brute_phrases(rows, least=10, top=2000, cover=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, totals = defaultdict(Counter), Counter()
    for r in rows:
        lang = r[2] if r[2] is not None else "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (r[1] or "").translate(lower)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = []
    for lang, own in counts.items():
        scored = []
        for phrase, a in own.items():
            if len(phrase) < 2 or a < least:
                continue
            if len(phrase) == 2 and any(
                100 * n >= cover * a and n >= least and (longer[:2] == phrase or longer[1:] == phrase)
                for longer, n in own.items() if len(longer) == 3
            ):
                continue
            cuts = [(1_000_000 * a * a // (own[phrase[:k]] * own[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), own[phrase[:k]], own[phrase[k:]]))
        for rank, (score, a, text, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, text.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def phrase_rows(seed=0, n=120):
    random = np.random.default_rng(seed)
    words = ["the", "The", "of", "nut", "gra", "été", "x" * 300, "一二", "a.b", "c", "d!", "e"]
    rows = shrink(odd_rows())
    for k in range(n):
        size = int(random.integers(0, 60))
        text = "".join(str(random.choice(words)) + str(random.choice([" ", " ", " ", "\t", "  ", ", ", "\n"])) for _ in range(size))
        rows.append((1000 + k, text, ["en", None, "und", "fr"][k % 4], "s", None))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_phrases_by_brute_force(spark, monkeypatch, small):
    if small:
        # Long texts in parts, hot words, several groups, trees sent early.
        for name, value in (("RUN", 300), ("BUDGET", 40), ("FLUSH", 200), ("WORDS", 50), ("LETTERS", 400)):
            monkeypatch.setattr(phrases, name, value)
    rows = phrase_rows()
    rows.append((5000, " ".join(["of the", "nut gra", "c. c", "of the nut"][i % 4] for i in range(900)), "fr", "s", None))
    docs = spark.createDataFrame(rows, SHORT).repartition(3)
    expected = brute_phrases(rows)
    assert sorted(tuple(r) for r in phrases.collocations(docs).collect()) == expected
    assert len(expected) > 50


def test_few_phrases_and_none(spark, no_docs):
    rows = phrase_rows(3, 60)
    docs = spark.createDataFrame(rows, SHORT)
    found = phrases.collocations(docs, least=3, top=4, cover=80)
    assert sorted(tuple(r) for r in found.collect()) == brute_phrases(rows, 3, 4, 80)
    assert phrases.collocations(no_docs).count() == 0
    assert phrases.collocations(docs.where("doc_id in (4, 5, 6)")).count() == 0


def test_scores_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_001, 3_000_000_000_007, 9_999_999_999_999
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    found = df.select(phrases.score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert found == 1_000_000 * a * a // (left * right)


def test_trees_go_through_their_levels():
    random = np.random.default_rng(1)
    suffixes, n = phrases.tree(random.integers(2, 6, (500, 3)).astype(np.uint64), random.integers(1, 4, 500))
    again, m = phrases.from_levels(phrases.as_levels(suffixes, n))
    assert (again == suffixes).all() and (m == n).all()
    assert len(np.unique(suffixes, axis=0)) == len(suffixes)


# Manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def shown(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_of(leaves):
    """Root, and for each leaf its runs of siblings with its place among them."""
    ways, nodes = [[] for _ in leaves], [(d, [k]) for k, d in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for a in range(0, len(nodes), 3):
            run = nodes[a : a + 3]
            for place, (_, below) in enumerate(run):
                for leaf in below:
                    ways[leaf].append(([d for d, _ in run], place))
            above.append((digest(*[d for d, _ in run]), [x for _, below in run for x in below]))
        nodes = above
    return nodes[0][0], ways


def brute_manifest(rows):
    def leaf(r, text):
        doc_id, _, lang, source, n_chars = r
        return digest(*map(shown, (doc_id, source, lang, n_chars, text)))

    groups = defaultdict(list)
    for r in rows:
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        other = r[1].replace("\n", "") if tampered and r[1] is not None else r[1]
        groups[r[3]].append((r[0], leaf(r, r[1]), leaf(r, other)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = tree_of([x[1] for x in groups[name]])
    root, tops = tree_of([trees[name][0] for name in names])
    found = []
    for k, name in enumerate(names):
        subroot, ways = trees[name]
        for (doc_id, own, other), way in zip(groups[name], ways, strict=True):
            current, siblings = other, []
            for run, place in [*way, *tops[k]]:
                siblings += run[:place] + run[place + 1 :]
                current = digest(*run[:place], current, *run[place + 1 :])
            found.append((doc_id, own, subroot, root, digest(*siblings), current, current == root))
    return sorted(found, key=str)


def run_manifest(docs):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    tree = manifest.documents_manifest(docs, tampered, {"text": F.translate("text", "\n", "")})
    found = manifest.folded(tree, "__replaced")
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return tree, found.select(*columns)


@pytest.mark.parametrize("levels", [8, 1, 2])
def test_manifest_by_brute_force(spark, odd_docs, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "BLOCK", manifest.FAN**levels)
    rows = odd_rows()
    rows += [row(100 + k, f"text\n{k}\n" if k % 3 else f"{k}", "en", f"s{k % 7 if k < 60 else 'é'}") for k in range(200)]
    docs = spark.createDataFrame(rows, odd_docs.schema).repartition(5)
    _, found = run_manifest(docs)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_manifest(shrink(rows))


def test_one_leaf_and_none(spark, no_docs):
    one = spark.createDataFrame([(7, "a\nb", None, None, 3)], SHORT)
    _, found = run_manifest(one)
    assert [tuple(r) for r in found.collect()] == brute_manifest([(7, "a\nb", None, None, 3)])
    assert run_manifest(no_docs)[1].count() == 0


def test_states_are_those_before_each_slot(spark):
    rows = [(k, f"t{k}", "en", "a", 2) for k in range(9)]
    tree, _ = run_manifest(spark.createDataFrame(rows, SHORT))
    kept = tree.blocks.first()
    states = np.frombuffer(kept["__states"], "<u4").astype(np.uint32).reshape(-1, manifest.FAN, 8)
    nodes = np.frombuffer(kept["__nodes"], np.uint8).reshape(-1, 32)
    assert len(states) == 4 and len(nodes) == 13
    # From any state kept, the children from its slot on give the parent's digest.
    for parent in range(3):
        for slot in range(3):
            state = states[parent, slot][None]
            for child in range(slot, 3):
                state = manifest.compressed(state, manifest.as_block(nodes[parent * 3 + child][None]))
            assert (manifest.closed(state, np.array([3]))[0] == nodes[9 + parent]).all()
    assert (states[:, 0] == manifest.START).all()


def test_midstate_hash():
    for n in range(4):
        texts = [hashlib.sha256(str(k).encode()).digest() for k in range(n)]
        state = manifest.begun(1)
        for text in texts:
            state = manifest.compressed(state, manifest.as_block(np.frombuffer(text, np.uint8)[None]))
        expected = hashlib.sha256("".join(t.hex() for t in texts).encode()).hexdigest()
        assert manifest.closed(state, np.array([n])).tobytes().hex() == expected


def test_sql_of_the_new_queries(spark, oracle):
    for name in ("op11_era_collocations", "op12_midstate_manifest"):
        found = queries.QUERIES[name](spark, DATA).toPandas()
        assert rows_of(found) == rows_of(oracle.sql(queries.ORACLES[name]).df())


# Toxicity


def toxic_docs(spark, n=900, seed=0):
    random = np.random.default_rng(seed)
    plain = [f"w{k}" for k in range(300)] + ["you", "your", "they"]
    rude = ["fnarg", "blorph", "zweeb", "grunk"]
    docs, labels = [], []
    for k in range(n):
        words = [str(w) for w in random.choice(plain, int(random.integers(5, 60)))]
        toxic = k % 6 == 0
        if toxic:
            for _ in range(int(random.integers(2, 6))):
                words.insert(int(random.integers(0, len(words))), str(random.choice(rude)))
        docs.append((k, " ".join(words), "en", "s", None))
        if k % 3 < 2:
            labels.append((k, 1, int(toxic)))
    labels += [(None, 1, 1), (3, 1, None), (10_000, 0, 1)]
    return spark.createDataFrame(docs, SHORT), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_documents_are_told(spark, odd_docs, no_docs):
    docs, labels = toxic_docs(spark)
    model = toxicity.learn(docs, labels)
    found = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    right = [found[k].predicted == int(k % 6 == 0) for k in found if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(right) > 100 and np.mean(right) > 0.97
    # Terms behind signs, and texts without anything.
    words = " ".join(f"w{k}" for k in range(12))
    texts = pa.array([f"you fn4rg and bl.or.ph {words} gruuuunk you zw33b", words, None, ""])
    x = dict(zip(toxicity.FEATURES, toxicity.text_features(texts, model.lexicon).T, strict=True))
    assert x["obfuscated_terms"].tolist() == [4, 0, 0, 0]
    plain = toxicity.text_features(pa.array([f"you fnarg {words} GRUNK!! blorph"]), model.lexicon)[0]
    x = dict(zip(toxicity.FEATURES, plain, strict=True))
    assert x["distinct_terms"] == 3 and x["near_second_person"] == pytest.approx(1 / 16) and x["repeated_marks"] > 0
    # Every row of odd tables has a score, with extra columns kept.
    odd = toxicity.scored(odd_docs, model, keep=["doc_id", "lang", "score"])
    assert odd.columns == ["doc_id", "lang", "score", "predicted"] and odd.count() == odd_docs.count()
    assert odd.where("score is null or score < 0 or score > 1").isEmpty()
    assert toxicity.scored(no_docs, model).count() == 0


def test_labels_of_the_held_out_fold_teach_nothing(spark, no_docs):
    docs, labels = toxic_docs(spark, 400)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = toxicity.learn(docs, labels), toxicity.learn(docs, turned)
    assert (one.lexicon.terms == other.lexicon.terms).all() and (one.trees.value == other.trees.value).all()
    # Without labels nothing is known.
    model = toxicity.learn(docs, labels.limit(0))
    assert {r.score for r in toxicity.scored(docs, model).collect()} == {0.5}
    assert toxicity.learn(no_docs, labels).lexicon.terms.size == 0


def test_isotonic_by_brute_force():
    random = np.random.default_rng(2)
    score = random.integers(0, 40, 300) / 40
    label = (random.random(300) < score).astype(float)
    fitted = toxicity.Isotonic.fit(score, label)
    assert (np.diff(fitted.value) > 0).all() and (np.diff(fitted.at) > 0).all()
    at, place = np.unique(score, return_inverse=True)
    weight = np.bincount(place)
    mean = np.bincount(place, weights=label) / weight

    def average(a, b):
        return (mean[a:b] * weight[a:b]).sum() / weight[a:b].sum()

    # The min-max formula of isotonic regression.
    best = [max(min(average(a, b) for b in range(k + 1, len(at) + 1)) for a in range(k + 1)) for k in range(len(at))]
    # A block's value stands at its mean score.
    for value, spot in zip(fitted.value, fitted.at, strict=True):
        own = [k for k in range(len(at)) if abs(best[k] - value) < 1e-9]
        assert own and at[own[0]] - 1e-9 <= spot <= at[own[-1]] + 1e-9
    assert sorted({round(b, 9) for b in best}) == sorted({round(v, 9) for v in fitted.value})


def test_features_do_not_depend_on_neighbours():
    known = toxicity.Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    texts = [PROSE, "", "You!! ARE  n0t", None, "x" * 50, "éé ÉÉ a"]
    whole = toxicity.text_features(pa.array(texts), known)
    assert np.array_equal(whole, np.concatenate([toxicity.text_features(pa.array([t], pa.string()), known) for t in texts]))
