"""The corpus pipeline: every stage on its predecessor's rows against a plain version, edge cases, and the whole."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandloom.llm import langid, mixing, setjoin

from .test_operators import ids_of
from .test_setjoins import brute_components, brute_lines

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, _gone string, component long, token string, size string, lang_pred string, _copy int"
WORDS = {"en": "the house and river with morning under green never seven", "de": "und nicht haus fluss morgen unter grün sieben über wald", "fr": "le maison et rivière avec matin sous vert jamais sept"}


def documents(seed=5, n=90):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        lines = [" ".join(rng.choice(WORDS[lang].split()) + rng.choice(("", "", "er", "en")) for _ in range(rng.randrange(6, 40))) for _ in range(rng.randrange(1, 6))]
        rows.append([i, "\n".join(lines), lang, rng.choice("aaab")])
        if i % 7 == 0:
            rows.append([1000 + i, "\n".join(lines) + " " + rng.choice(WORDS[lang].split()), lang, "c"])
        if i % 5 == 0:
            rows[-1][1] += "\nread more about this now and here\nShare this"
    rows += [[2000, None, "en", "a"], [2001, "", "en", None], [2002, "12 34 -- !!", None, "b"], [2003, "the house and the river " * 3000, "en", "d"], [None, "the house has no id but seven green rivers", "en", "b"]]
    rows += [rows[3], rows[3]]
    return [(i, t, g, s, -1 if t is None else len(t), "g", 7, "t", "s", "p", 1) for i, t, g, s in rows]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(rows before, rows after) of each stage."""
    folder = f"file://{tmp_path_factory.mktemp('pipeline')}"
    spark.createDataFrame(documents(), SHAPE).repartition(4).write.parquet(f"{folder}/documents.parquet")
    last = corpus_pipeline.run(spark, folder)
    shared = last.inputFiles()[0].rsplit("/", 2)[0]
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for i, (name, _) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs.collect(), spark.read.parquet(f"{shared}/{i}")
        if i < 4:
            assert docs.dtypes == [(n, t) for n, t in spark.createDataFrame([], SHAPE).dtypes], name
        out[name] = before, docs.collect()
    assert kept(out["best-fit packing"][1]) == kept(last.collect())
    return out


def kept(rows):
    return Counter(tuple(r) for r in rows)


def test_language(stages, spark):
    before, after = stages["language ID"]
    model = langid.train(spark.createDataFrame(before, SHAPE).filter(~langid.held_out(F.col("doc_id"))))
    ask = [r for r in before if langid.has_letter(r["text"])]
    scores = langid.document_probabilities(model, [r["text"] for r in ask]).max(axis=0)
    assert kept(after) == kept(r for r, s in zip(ask, scores, strict=True) if s >= 0.4)
    assert len(after) >= len(before) - 5  # the documents of a language all stay


def test_lines(stages):
    before, after = stages["line dedup"]
    last = 1 << 62
    gone = brute_lines(list(dict.fromkeys((last if r["doc_id"] is None else r["doc_id"], r["text"]) for r in before)))
    expected = Counter()
    for r in before:
        i = last if r["doc_id"] is None else r["doc_id"]
        text = "\n".join(x for n, x in enumerate(r["text"].split("\n")) if (i, n) not in gone)
        expected[r["doc_id"], text, len(text) if text != r["text"] else r["n_chars"]] += 1
    assert Counter((r["doc_id"], r["text"], r["n_chars"]) for r in after) == expected
    assert gone and len(after) == len(before)


def test_near_duplicates(stages):
    before, after = stages["n-gram Jaccard join"]
    groups = brute_components([(r["doc_id"], r["text"]) for r in before], 5, 4, 5)
    least = {(i, n): c for i, n, c in groups}
    gone = {i for i, _, c in groups if i is not None and c is not None and c < i}
    assert kept(after) == kept(r for r in before if r["doc_id"] not in gone) and least


def test_mix(stages, spark):
    before, after = stages["mixing sources"]
    plan = mixing.mixture_by_document(spark.createDataFrame(before, SHAPE)).collect()
    taken = defaultdict(int)
    for r in plan:
        taken[r["doc_id"]] += r["taken"]
    words = defaultdict(int)
    for r in after:
        words[r["doc_id"]] += len([w for w in r["text"].split() if w])
    assert {k: v for k, v in taken.items() if v} == dict(words)
    assert set(kept(after)) <= set(kept(before))


def test_packing(stages):
    before, after = stages["best-fit packing"]
    tokens = Counter()
    for r in before:
        tokens[r["doc_id"]] += len(ids_of(r["text"])) + 1
    found, sequences = Counter(), defaultdict(list)
    for r in after:
        found[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert found == tokens
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 1024


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], SHAPE)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.collect() == [], name
    assert corpus_pipeline.STAGES[4][1](spark, docs, "").collect() == []


def test_derived_answers():
    """A set that is similar to an answered one takes over its answers: most pairs of a group of near copies are derived."""
    rng = np.random.default_rng(1)
    base = rng.choice(1 << 40, 200, replace=False).astype(np.uint64)
    sets = []
    for _ in range(40):
        one = base.copy()
        one[rng.integers(200)] = rng.integers(1 << 41, 1 << 42)
        sets.append(one)
    counted, found = [], []
    ordered = setjoin.by_rarity(sets)
    setjoin.prefix_join(ordered, 9, 10, [True] * 40, lambda x, y: False, lambda x, y, overlap: found.append((x, y, overlap)), derived=counted)
    exact = {frozenset((x, y)): len(np.intersect1d(sets[x], sets[y])) for x in range(40) for y in range(x)}
    assert {frozenset((x, y)): o for x, y, o in found} == {k: o for k, o in exact.items() if o * 19 >= 9 * 400}
    assert len(found) == 780 and len(counted) > 700
