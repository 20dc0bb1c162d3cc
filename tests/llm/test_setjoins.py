"""N-gram Jaccard join and line dedup against brute force, with skewed groups over several blocks."""

import random
import re

import numpy as np
import pytest

from strandloom.llm import jaccard, linedup, setjoin, tokens

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = WORDS.findall((text or "").translate(LOWER))
    return {tuple(words)} if 0 < len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def similar(a, b, num, den):
    both = len(a & b)
    return bool(a and b) and den * both >= num * (len(a) + len(b) - both)


def brute_components(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            if similar(sets[x][1], sets[y][1], num, den):
                root[find(x)] = find(y)
    groups = {}
    for x in range(len(sets)):
        groups.setdefault(find(x), []).append(sets[x][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((sets[x][0], len(sets[x][1]), least[find(x)]) for x in range(len(sets))), key=str)


def corpus(seed, n):
    """Near copies, chains of them, shared passages, copies, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(60))
    passage = [word() for _ in range(40)]
    texts = []
    while len(texts) < n:
        base = [word() for _ in range(rng.choice((3, 12, 30, 80)))]
        if rng.random() < 0.4:
            base += passage
        texts.append(base)
        for _ in range(rng.choice((0, 0, 2, 12))):
            base = list(base)
            base[rng.randrange(len(base))] = word()
            texts.append(base)
            if rng.random() < 0.2:
                texts.append(list(base))
    rows = [(i, rng.choice((" ", "\n", "\t ")).join(t)) for i, t in enumerate(texts[:n])]
    rng.shuffle(rows)
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "One Two"), (n + 4, "one two"), (n + 5, "ÄB c d e"), (n + 6, "äB c d e"), (n + 7, "x " * 30_000), (None, "null id text a b c"), rows[0]]


@pytest.mark.parametrize(("k", "num", "den", "block", "heavy"), [(3, 9, 10, 512, 0), (5, 4, 5, 512, 4), (3, 9, 10, 7, 3), (5, 4, 5, 4, 0)])
def test_components(spark, monkeypatch, k, num, den, block, heavy):
    """With ``heavy`` tokens of so few sets already count as tokens of very many."""
    if heavy:
        monkeypatch.setattr(setjoin, "SAMPLED", 1)
        monkeypatch.setattr(setjoin, "LEAST_SAMPLED", heavy)
    rows = corpus(k + block, 260)
    found = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), k, num, den, block=block)
    assert sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()), key=str) == brute_components(rows, k, num, den)


def test_one_of_each_group_keeps_columns(spark):
    rows = [(1, "a b c d e f g h i j", "x", 1), (2, "a b c d e f g h i j", "y", 2), (3, None, "z", 3), (4, "", None, 4), (None, "a b c d e f g h i j", "n", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone string, component long")
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 4, None}


def brute_lines(rows, k=5, num=4, den=5):
    lines = sorted((i, n, line) for i, t in rows for n, line in enumerate((t or "").split("\n")))
    sets = [shingles(line, k) for _, _, line in lines]
    return {(lines[x][0], lines[x][1]) for x in range(len(lines)) if any(similar(sets[x], sets[y], num, den) for y in range(x))}


@pytest.mark.parametrize("block", [8192, 5])
def test_lines(spark, block):
    rng = random.Random(block)
    rows = corpus(3, 150)
    rows = [(i, "\n".join(t.split("\n")) if t else t) for i, t in rows if i is not None][:-1]
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice((3, 6, 20)))) for _ in range(40)]
    rows += [(1000 + i, "\n".join(rng.choice(pool) + rng.choice(("", "", " more")) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    # Short lines and the same with a word more: of so few tokens, hardly any may be missed.
    short = [" ".join(f"s{rng.randrange(1000)}" for _ in range(rng.randrange(9, 14))) for _ in range(150)]
    rows += [(2000 + i, "\n".join((short[i], short[i - 1] + " and"))) for i in range(150)]
    docs = spark.createDataFrame([(i, t, "g", 0) for i, t in rows], "doc_id long, text string, _gone string, n_lines int").repartition(4)
    found = {(r["doc"], r["line"]) for r in linedup.repeated_lines(docs, block=block).collect()}
    assert found == brute_lines(rows)
    kept = {r["doc_id"]: r["text"] for r in linedup.drop_repeated_lines(docs).collect()}
    for i, t in rows:
        assert kept[i] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in found))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert jaccard.similar_documents(docs).collect() == []
    assert linedup.drop_repeated_lines(docs, counts=True).collect() == []


def test_distinct_sets_of_all_sizes():
    """Runs of every length, sorted in tables or alone, with repeats; texts as strings or bytes."""
    rng = np.random.default_rng(3)
    sizes = np.array([0, 1, 2, 15, 16, 17, 0, 0, 48, 49, 255, 256, 257, 1_000, 1, 0])
    offsets = np.append(0, sizes.cumsum())
    hashes = rng.integers(0, 1 << 63, int(offsets[-1]), dtype=np.uint64) // np.uint64(1 << 56) << np.uint64(56) | np.uint64(7)
    hashes[offsets[3]] = np.iinfo(np.uint64).max
    expected = [np.unique(hashes[a:b] >> np.uint64(6)) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    tokens, ends, classes = setjoin.distinct_sets(hashes, offsets)
    assert [x.tolist() for x in np.split(tokens, ends[1:-1])] == [x.tolist() for x in expected]
    assert [c == 0 for c in classes] == [n == 0 for n in sizes] and len(set(classes[sizes > 1].tolist())) == (sizes > 1).sum()
    texts = ["A b\n\nc D\té", None, "", "\n", "a B"]
    for one, other in ((setjoin.line_words(texts, 1), setjoin.line_words([x and x.encode() for x in texts], 1)), (setjoin.document_words(texts), setjoin.document_words([x and x.encode() for x in texts]))):
        assert all(np.array_equal(x, y) for x, y in zip(one, other, strict=True))
    words, counts, text, line = setjoin.line_words(texts, 1)
    assert counts.tolist() == [2, 3, 2] and text.tolist() == [0, 0, 4] and line.tolist() == [0, 2, 0] and words[:2].tolist() == words[5:].tolist()
    assert setjoin.document_words(texts)[1].tolist() == [5, 0, 0, 0, 2]


def test_workers_stay_small(spark):
    """Workers get texts in small batches, and no tokenizer that no text needs."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "10000")
    docs = spark.createDataFrame([(i, f"a b c d e f {i}") for i in range(3_000)], "doc_id long, text string").coalesce(1)
    linedup.drop_repeated_lines(docs)
    assert spark.conf.get(key) == "1024"
    spark.conf.set(key, "100")
    linedup.drop_repeated_lines(docs)
    assert spark.conf.get(key) == "100"
    spark.conf.unset(key)
    tokens._whole.cache_clear()
    tokens.encode("plain words", tokens.default_vocabulary())
    assert tokens._whole.cache_info().currsize == 0
    assert tokens.encode("a<|endoftext|>b", tokens.default_vocabulary()) == tokens._whole(tokens.default_vocabulary()).encode("a<|endoftext|>b", add_special_tokens=False).ids
