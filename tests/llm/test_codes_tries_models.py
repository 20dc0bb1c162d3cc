"""Prefix trie, class model and vector codes against brute force, and the registered SQL on the test tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strandloom.llm import class_lm, prefix_trie, queries, vector_codes

from ..compare import of_spark, of_sql

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_registered_sql(spark, name):
    found = of_spark(queries.QUERIES[name](spark, SF))
    assert found[1] and found == of_sql(queries.ORACLES[name], SF)


# 11, prefix trie

TURNS = "conv_id long, turn long, role string, text string, depth string, owner int"


def brute_trie(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    saved, leaves = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        saved[p] = own + sum(saved[k] for k in children[p])
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_of(spark, rows):
    frame = spark.createDataFrame([(*r, "d", 1) for r in rows], TURNS).repartition(3)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(frame).collect()), key=str)


def conversations(seed, n=60, nested=False):
    rng = random.Random(seed)
    rows = []
    for c in range(-5, n):
        length = c // 2 if nested else rng.randrange(0, 7)
        for t in range(max(0, length)):
            text = f"step {t}" if nested else rng.choice(["hello  there", "hello", "yes no", None, "", "word " * 50])
            rows.append((c, rng.choice([None, t]) if not nested and t < 2 else t, rng.choice(["user", "system", None]) if not nested else "user", text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, seed):
    """Null and repeated turns, roles and texts, rows without a conversation, repeated rows, heads that are absent or short."""
    rows = [r for r in conversations(seed) if not (r[0] % 20 == 0 and r[0] > 20)]
    rows += [rows[0], rows[0], (None, 1, "user", "nobody"), (41, None, None, None), (1_000_001, 1, "user", "hello"), (10**15, 2, "user", "hello")]
    assert trie_of(spark, rows) == brute_trie(rows)


def test_trie_of_nested_conversations(spark):
    """Each conversation goes on where a smaller one ends, so chains hang on chains many levels deep."""
    rows = conversations(3, 70, nested=True)
    assert trie_of(spark, rows) == brute_trie(rows)


def test_trie_of_turnless_and_long_conversations(spark, monkeypatch):
    """Conversation 21 lends no head and has too few turns of its own, so nothing is left; sums in strides of two turns."""
    monkeypatch.setattr(prefix_trie, "STRIDE", 2)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    few = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(few, 1, "user", "gone")] + [(c, t, "user", f"w{t} " * (t % 5)) for c in range(60, 72) for t in range(25)] + [(80, t, "user", str(t)) for t in range(90)]
    found = trie_of(spark, rows)
    assert found == brute_trie(rows) and any(r[1] == 90 for r in found)
    assert trie_of(spark, rows[:1]) == brute_trie(rows[:1]) and len(trie_of(spark, rows[:1])) == 1


def test_trie_of_copies(spark, monkeypatch):
    """Many equal conversations: one node each, whose ids are hashed slice by slice."""
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    rows = [(c * 20, t, "user", "same words") for c in range(40) for t in range(3)]
    found = trie_of(spark, rows)
    assert found == brute_trie(rows) and len(found) == 4


def test_empty_trie(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(None, 1, "user", "x")]) == []


# 12, class model

DOCS = "doc_id long, text string, words string, n string"


def language(seed, n=120):
    """Texts of two languages whose words alternate between two kinds, with rare words."""
    rng = random.Random(seed)
    kinds = {k: [f"{k}{i}" for i in range(12)] for k in ("the", "cat", "der", "hund")}
    rows = []
    for i in range(n):
        pair = ("the", "cat") if i % 2 else ("der", "hund")
        words = [rng.choice(kinds[pair[j % 2]]) if rng.random() < 0.95 else f"rare{rng.randrange(10_000)}" for j in range(rng.randrange(1, 60))]
        rows.append((i, " ".join(words).title() if i % 3 else "\t".join(words) + "\n x", "w", "n"))
    return [*rows, rows[1], rows[1], (None, "no id", "w", "n"), (n, None, "w", "n"), (n + 1, "", "w", "n"), (n + 2, "É the0 cat1 " * 3_000, "w", "n"), (n + 3, "y" * 5_000, "w", "n")]


def scored(spark, rows, **options):
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    return [r.asDict() for r in class_lm.score_texts(frame, **({"classes": 8, "core": 40, "dictionary": 30} | options)).collect()]


def tokens(text):
    return [*WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


@pytest.mark.parametrize("options", [{}, {"core": 0}, {"dictionary": 1_000, "core": 5}])
def test_base_scores(spark, options):
    """Counts and base scores follow from the rule, wherever a word is looked up."""
    rows = language(1)
    c = Counter(w for i, t, *_ in rows if not is_held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted(str((i, is_held(i), len(w := tokens(t)), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6))) for i, t, *_ in rows)
    found = scored(spark, rows, **options)
    assert want == sorted(str((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))) for r in found)
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in found)
    texts = {i: t for i, t, *_ in rows}
    by_text = defaultdict(set)
    for r in found:
        if r["doc_id"] is not None:
            by_text[texts[r["doc_id"]]].add(round(r["score"], 6))
    assert all(len(s) == 1 for s in by_text.values())


def test_class_model_beats_word_frequencies(spark):
    found = [r for r in scored(spark, language(2)) if r["held_out"]]
    assert sum(r["score"] for r in found) > 0.85 * sum(r["base_score"] for r in found)


def test_probabilities_sum_to_one(spark):
    """After every class and after an unseen word, all seen words and the unseen one have probability 1 together."""
    texts = spark.createDataFrame([(t,) for _, t, *_ in language(3)], "text string")
    model = class_lm.learn_classes(texts, classes=8, core=40)
    rows = texts.selectExpr("cast(1 as long) doc_id", "false held_out", "text")
    coded, counts, classes = class_lm.encoded(rows, model.words, 30)
    model = class_lm.with_transitions(model, class_lm.count_transitions(coded, counts, classes, model))
    emitted = np.zeros(len(model.sizes))
    for r in model.words.collect():
        emitted[r["class"]] += (r["n"] - model.discount[r["class"]]) / model.sizes[r["class"]]
    assert np.allclose(model.follows @ emitted + model.unseen, 1)
    kinds = defaultdict(Counter)
    for r in model.words.collect():
        if m := re.match(r"(the|cat|der|hund)\d+$", bytes(r["word"]).decode()):
            kinds[m[1]][r["class"]] += r["n"]
    assert len({c.most_common(1)[0][0] for c in kinds.values()}) == 4  # each kind of word has its own classes


def test_exchange_never_lowers_the_likelihood(spark):
    texts = spark.createDataFrame([(t,) for _, t, *_ in language(4)], "text string").repartition(3)
    core = [w for w, _ in Counter(x.encode() for _, t, *_ in language(4) for x in tokens(t)[:-1]).most_common(40)]
    around = class_lm.core_neighbours(texts, core)
    values = [class_lm.likelihood(class_lm.exchange(around, len(core), 8, r)[1]) for r in (1, 2, 4, 8)]
    assert values == sorted(values)
    follow, precede, own = class_lm.class_contexts(around, np.arange(len(core) + 2), len(core) + 2)
    bigrams = Counter()
    names = {w: i + 1 for i, w in enumerate(core)}
    for _, t, *_ in language(4):
        ids = [0, *[0 if w is None else names.get(w.encode(), len(core) + 1) for w in tokens(t)]]
        bigrams.update(zip(ids, ids[1:]))
    assert {(i, j): int(n) for (i, j), n in np.ndenumerate(follow) if n} == dict(bigrams)
    assert (precede.T == follow).all() and (own == np.diag(follow)).all()
    a, b, w = 3, 5, 7
    of = np.arange(len(core) + 2) % 8
    pairs = np.zeros((8, 8))
    for (i, j), n in bigrams.items():
        pairs[of[i], of[j]] += n
    to_classes = lambda x: np.array([sum(x[w, of == c]) for c in range(8)])
    after = class_lm.moved(pairs, of[w], b, to_classes(follow), to_classes(precede), own[w])
    of[w] = b
    direct = np.zeros((8, 8))
    for (i, j), n in bigrams.items():
        direct[of[i], of[j]] += n
    assert (after == direct).all() and a != b


def test_class_model_edge_cases(spark):
    assert scored(spark, []) == []
    held = next(i for i in range(100) if is_held(i))
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in scored(spark, [(held, "a b", "w", "n")])] == [(3, 0, 0, 0.0, 0.0)]
    kept = next(i for i in range(100) if not is_held(i))
    only = scored(spark, [(kept, None, "w", "n")])[0]
    assert (only["n_tokens"], only["n_known"], only["train_tokens"]) == (1, 1, 1)


def test_dictionary_is_bounded(spark):
    words = spark.createDataFrame([(bytearray(f"w{i}".encode()), 5 if i < 10 else 1) for i in range(5_000)], "word binary, n long")
    found = class_lm.frequent(words, 500)
    assert 10 <= found.num_rows <= 700 and {w.decode() for w in found.column("word").to_pylist()} >= {f"w{i}" for i in range(10)}
    assert class_lm.frequent(words, 10_000).num_rows == 5_000
    assert class_lm.frequent(words.limit(0), 10).num_rows == 0


# 13, vector codes

VECTORS = "vec_id long, embedding array<double>, label int, codes string, error string"


def brute_codes(rows, entries=256, rounds=4):
    kept = [(i, l, [math.floor(1024 * x) for x in v]) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(len(v) for *_, v in kept) // 4) * 4
    kept = [(i, l, v + [0] * (width - len(v))) for i, l, v in kept]
    first = {}
    for i, _, v in kept:
        if i is not None:
            first[i] = min(first.get(i, v), v)
    own = width // 4
    books = [[first[i][p * own : (p + 1) * own] for i in sorted(first)[:entries]] for p in range(4)]

    def assigned():
        out = []
        for _, _, v in kept:
            out.append([min((sum((a - b) ** 2 for a, b in zip(v[p * own : (p + 1) * own], e)), j) for j, e in enumerate(books[p])) for p in range(4)])
        return out

    for _ in range(rounds):
        found = assigned()
        for p in range(4):
            for j in range(len(books[p])):
                members = [v[p * own : (p + 1) * own] for (_, _, v), f in zip(kept, found) if f[p][1] == j]
                if members:
                    books[p][j] = [sum(x) // len(members) for x in zip(*members)]
    found = assigned()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    by_label = Counter()
    for (_, l, _), f in zip(kept, found):
        by_label[l] += sum(d for d, _ in f)
    return sorted(str((i, "".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f), by_label[l], digest)) for (i, l, _), f in zip(kept, found))


def codes_of(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "c", "e") for r in rows], VECTORS).repartition(3)
    return sorted(str(tuple(r)) for r in vector_codes.vector_codes(frame, **options).collect())


def vectors(seed, n, width, spread=1.0, clusters=12):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(clusters, width))
    return [(i, (spread * (middles[i % clusters] + 0.2 * rng.normal(size=width))).tolist(), [None, 1, 2][i % 3]) for i in range(n)]


@pytest.mark.parametrize(("entries", "spread"), [(256, 0.1), (7, 1.0), (20, 0.003)])
def test_vector_codes(spark, entries, spread):
    """Few steps between numbers make many ties; ids repeat, are null or negative; some vectors take no part."""
    rows = vectors(1, 400, 8, spread)
    rows += [rows[5], rows[5], (7, rows[9][1], 1), (None, rows[3][1], None), (-4, rows[8][1], 2), (900, None, 1), (901, [1.0, None] * 4, 1), (902, [math.nan] + [0.0] * 7, 1), (903, [math.inf] + [0.0] * 7, 1)]
    assert codes_of(spark, rows, entries=entries) == brute_codes(rows, entries)


def test_vector_codes_of_odd_shapes(spark):
    """Lengths differ and four does not divide them; fewer vectors than entries; equal vectors only; empty vectors."""
    for rows in (vectors(2, 40, 6) + [(50, [1.0], 1), (51, [], 1)], vectors(3, 3, 4), [(i, [0.5, -0.5, 0.25, 0.0], 1) for i in range(30)], [(1, [], 1), (2, [], None)]):
        assert codes_of(spark, rows) == brute_codes(rows)


def test_vector_codes_of_large_components(spark):
    """Products of doubles would not be exact here; beyond the bound there is an error instead of a wrong code."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-100_000, 100_000) for _ in range(4)], 1) for i in range(60)]
    assert codes_of(spark, rows, entries=9) == brute_codes(rows, 9)
    with pytest.raises(Exception, match="scaled component"):
        codes_of(spark, [*rows, (99, [1e30, 0.0, 0.0, 0.0], 1)], entries=9)


def test_no_vector_codes(spark):
    assert codes_of(spark, []) == codes_of(spark, [(1, None, 1)]) == []
    with pytest.raises(ValueError, match="byte per part"):
        codes_of(spark, [], entries=257)


def test_bounds_prune_without_changing_codes():
    """Each round equals full comparison, bounds stay bounds, and most distances are not computed."""
    rng = np.random.default_rng(5)
    x = np.floor(1_000 * (rng.normal(size=(40, 4))[rng.integers(40, size=3_000)] + 0.05 * rng.normal(size=(3_000, 4))))
    book = x[:64].copy()
    codes, upper, lower = vector_codes.first_assignment(x, book)
    computed = 0
    for _ in range(6):
        old, book = book, book.copy()
        for j in range(64):
            if (codes == j).any():
                book[j] = np.floor(x[codes == j].sum(axis=0) / (codes == j).sum())
        packed = vector_codes.unpacked_bounds(vector_codes.packed_bounds(lower))
        assert (packed <= lower).all()
        codes, upper, lower, n = vector_codes.reassignment(x, book, vector_codes.half_distances(book), vector_codes.movement(old, book), codes, upper, packed)
        d = vector_codes.all_squared(x, book)
        assert (codes == d.argmin(axis=1)).all()
        assert (lower <= np.sqrt(d)).all() and (upper >= np.sqrt(d.min(axis=1))).all()
        computed += n
    assert computed < 0.2 * 6 * x.shape[0] * 64


def test_words_of_several_batches():
    """The places of a word are summed over rows and batches; packed values are read where they lie."""
    got = []

    class Frame:
        sparkSession = sparkContext = property(lambda self: self)
        broadcast = repartition = sortWithinPartitions = lambda self, *_: self
        mapInArrow = lambda self, f, _: got.append(f) or self

    of, pairs = np.array([0, 1, 2, 3]), np.array([[9.0, 1, 5, 2], [1, 7, 3, 1], [6, 2, 8, 1], [1, 1, 1, 1]])
    class_lm.other_words(Frame(), [b"x", b"y"], of, pairs)
    rows = [(b"a", [(0, 1)]), (b"a", [(1, 1), (3, 2)]), (b"b", [(3, 3)]), (b"c", [(2, 2)] * 5), (b"c", [(2, 0)]), (b"d", [(1, 0)])]
    logs, size = class_lm.log_transitions(pairs), np.log(pairs.sum(axis=0))
    expected = {}
    for word in dict(rows):
        places = [p for w, of_row in rows for p in of_row if w == word]
        score = {c: sum((logs[left, c] if left < 3 else 0) + (logs[c, right] if right < 3 else 0) - size[c] for left, right in places) for c in (1, 2)}
        expected[word] = (len(places), max(score, key=score.get))
    whole = pa.RecordBatch.from_pydict({"word": [w for w, _ in rows], "places": [np.array(p, "u1").tobytes() for _, p in rows]}, pa.schema({"word": pa.binary(), "places": pa.binary()}))
    for cut in ([whole], [whole.slice(i, 1) for i in range(len(rows))], [whole.slice(0, 0), whole.slice(0, 4), whole.slice(4)]):
        found = [r for b in got[1](cut) for r in b.to_pylist()]
        assert {r["word"]: (r["n"], r["class"]) for r in found} == expected and len(found) == len(expected)
    values, sizes = class_lm.unpacked(pa.array([b"zz", b"\1\0\0\0", b"", b"\2\0\0\0\3\0\0\0"], pa.binary()).slice(1), "<i4")
    assert values.tolist() == [1, 2, 3] and sizes.tolist() == [1, 0, 2]
    assert [len(x) for x in class_lm.unpacked(pa.array([], pa.binary()), "<i4")] == [0, 0]
