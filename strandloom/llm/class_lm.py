"""A class-based bigram model: words exchanged between classes, class transitions and word emissions.

p(word | before) = P(class(word) | class(before)) * P(word | class(word)),
mixed with the word's own smoothed frequency. Counts are those of all training
texts.

1. Words are counted. The most frequent ones, CORE at most, are exchanged
   between classes: a word moves to the class that makes the class bigrams of
   the core likelier. Their bigrams are counted in the tasks and kept as one row
   per word, so a round is a pass over CORE rows, whatever the corpus.
2. Every other word makes one such move, by all its occurrences next to core
   words.
3. Texts become numbers: the words of a dictionary of bounded size are looked up
   in the tasks, the others, none of which is frequent, by a join.
4. Transitions are counted over all training texts, and all texts are scored.

Emissions are discounted by D = n1 / (n1 + 2 n2), n1 and n2 being the numbers of
words seen once and twice; a class gives what it saves to words never seen. So
the probabilities of the seen words and of one unseen word sum to 1.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import repeat
from operator import ne

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, pin, small_batches, stored
from .setjoin import by_bytes, slices

CLASSES, ROUNDS = 64, 10
#: Words that take part in the exchange, and words of the dictionary; both are bounds, longer words than WORD_BYTES are in neither.
CORE, DICTIONARY, WORD_BYTES = 1 << 12, 1 << 18, 128
#: Weight of a word's own frequency in the mixture, and of a class's frequency in its transitions.
OWN, PRIOR = 0.05, 5.0
#: Stands for the end of a text, which is a token but no word: words have no spaces.
END = b" "
#: Distinct words or pairs that a task gathers before it passes them on; bytes of text it takes at a time.
GATHERED, BYTES = 1 << 20, 4 << 20
#: Places of one word in a row, and in a batch, at most.
PLACES = 1 << 15


def held_out(id_column: Column) -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def texts_of(batches, column: int):
    """Lists of texts as bytes, of a bounded size together, nulls as empty."""
    for batch in by_bytes(batches, column, BYTES):
        yield batch, [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def split(text: bytes) -> list[bytes]:
    """Words are runs without ASCII white space, which is what bytes are split at; only A-Z are lowered."""
    return text.lower().split()


def packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary value for each range of ``values`` between two offsets."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * values.itemsize).astype("<i4")), pa.py_buffer(values)])


def unpacked(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows, number of values in each)."""
    column = column.cast(pa.binary())
    _, ends, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, kind), np.zeros(len(column), "i8")
    ends = np.frombuffer(ends, "<i4")[column.offset : column.offset + len(column) + 1].astype("i8")
    values = np.frombuffer(data, "u1")[ends[0] : ends[-1]].view(kind)
    return values, np.diff(ends) // values.itemsize


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of a column of texts; every text has one END."""

    def run(batches):
        seen = Counter()
        for _, part in texts_of(batches, 0):
            for t in part:
                seen.update(split(t))
            seen[END] += len(part)
            if len(seen) > GATHERED:
                yield counted(seen)
                seen = Counter()
        yield counted(seen)

    def counted(seen):
        return pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(words: DataFrame, most: int) -> pa.Table:
    """The most frequent words, about ``most`` at most, most frequent first, with the other columns of ``words``.

    Counts are put into 16 bins a doubling; of the last bin a hash takes as many
    as there is room for, so no more than the result reaches the driver.
    """
    short = words.filter((F.length("word") <= WORD_BYTES) & (F.col("word") != F.lit(END)))
    level = F.floor(16 * F.log2("n")).cast("int")
    room, taken = most, F.lit(False)
    for at, n in sorted(short.groupBy(level).count().collect(), reverse=True):
        if n > room:
            taken = taken | ((level == at) & (F.pmod(F.xxhash64("word"), F.lit(1_000)) < room * 1_000 // n))
            break
        room, taken = room - n, level >= at
    table = short.filter(taken).toArrow()
    return table.take(pc.sort_indices(table, sort_keys=[("n", "descending"), ("word", "ascending")]))


def core_neighbours(texts: DataFrame, core: list[bytes]) -> DataFrame:
    """(id, side, others, counts): what follows (side 0) or precedes (side 1) each core word, how often.

    0 is END, word i of the core is i + 1, and all other words are one, the
    last. There are 2 * (len(core) + 2) rows of as many numbers at most.
    """
    n = len(core) + 2
    shared = texts.sparkSession.sparkContext.broadcast({w: i + 1 for i, w in enumerate(core)})

    def run(batches):
        find, keys, counts = shared.value.get, np.zeros(0, "i8"), np.zeros(0, "i8")
        waiting, size = [], 0
        for _, part in texts_of(batches, 0):
            ids = [0]
            for t in part:
                ids += map(find, split(t), repeat(n - 1))
                ids.append(0)
            ids = np.array(ids, "i8")
            waiting.append(np.unique(ids[:-1] * n + ids[1:], return_counts=True))
            size += len(waiting[-1][0])
            if size > 2 * GATHERED:
                keys, counts = summed([(keys, counts), *waiting])
                waiting, size = [], 0
        keys, counts = summed([(keys, counts), *waiting])
        yield from by_word(keys // n, keys % n, counts)

    def summed(parts):
        keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        keys, at = np.unique(keys, return_inverse=True)
        return keys, np.bincount(at, counts, len(keys)).astype("i8")

    def by_word(left, right, counts):
        for side, own, other in ((0, left, right), (1, right, left)):
            order = np.argsort(own, kind="stable")
            ids, starts = np.unique(own[order], return_index=True)
            for a in range(0, len(ids), 256):
                at = np.append(starts, len(order))[a : a + 257]
                rows = order[at[0] : at[-1]]
                yield neighbours(ids[a : a + 256], side, other[rows], counts[rows], at - at[0])

    def neighbours(ids, side, others, counts, offsets):
        return pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int32()), "side": pa.array(np.full(len(ids), side), pa.int32()), "others": packed(others.astype("<u2"), offsets), "counts": packed(counts.astype("<i8"), offsets)})

    def merge(batches):
        """Rows come by (id, side); one word's counts are held at a time."""
        last, total = None, np.zeros(n, "i8")

        def row():
            others = np.flatnonzero(total)
            return neighbours([last[0]], last[1], others, total[others], np.array([0, len(others)]))

        for batch in slices(batches, 256):
            for i, side, others, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (i, side) != last:
                    if last is not None:
                        yield row()
                    last = i, side
                    total[:] = 0
                total[np.frombuffer(others, "<u2")] += np.frombuffer(counts, "<i8")
        if last is not None:
            yield row()

    schema = "id int, side int, others binary, counts binary"
    return pin(texts.mapInArrow(run, schema).repartition("id", "side").sortWithinPartitions("id", "side").mapInArrow(merge, schema))


def class_contexts(neighbours: DataFrame, of: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(followers, predecessors, repeats): per core word how often each class follows it and precedes it, and how often it follows itself."""

    def run(batches):
        for batch in slices(batches, 256):
            out = []
            for i, side, others, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                others, counts = np.frombuffer(others, "<u2"), np.frombuffer(counts, "<i8")
                out.append((i, side, np.bincount(of[others], counts, classes).astype("<f8").tobytes(), int(counts[others == i].sum())))
            yield pa.RecordBatch.from_pylist([dict(zip(("id", "side", "sums", "own"), r, strict=True)) for r in out], pa.schema({"id": pa.int32(), "side": pa.int32(), "sums": pa.binary(), "own": pa.int64()}))

    found, own = np.zeros((2, len(of), classes)), np.zeros(len(of))
    for r in neighbours.mapInArrow(run, "id int, side int, sums binary, own long").collect():
        found[r["side"], r["id"]], own[r["id"]] = np.frombuffer(r["sums"], "<f8"), r["own"]
    return found[0], found[1], own


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def likelihood(pairs: np.ndarray) -> float:
    """The part of the class bigrams' log-likelihood that depends on the classes."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(axis=0)).sum() - _xlogx(pairs.sum(axis=1)).sum())


def log_transitions(pairs: np.ndarray) -> np.ndarray:
    share = pairs.sum(axis=0) / max(pairs.sum(), 1)
    return np.log((pairs + PRIOR * share + 1e-9) / (pairs.sum(axis=1, keepdims=True) + PRIOR + 1e-9 * len(pairs)))


def preferences(follow: np.ndarray, precede: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """How likely every class makes the contexts of words, as if only the word moved; the last class takes no words."""
    logs = log_transitions(pairs)
    n = follow.sum(axis=1, keepdims=True)
    return follow @ logs.T + precede @ logs - n * np.log(np.maximum(pairs.sum(axis=0), 1))


def moved(pairs: np.ndarray, a: int, b: int, follow: np.ndarray, precede: np.ndarray, own: float) -> np.ndarray:
    """Class bigrams after a word with these contexts went from class a to b."""
    follow, precede = follow.copy(), precede.copy()
    follow[a] -= own
    precede[a] -= own
    out = pairs.copy()
    for sign, c in ((-1, a), (1, b)):
        out[c] += sign * follow
        out[:, c] += sign * precede
        out[c, c] += sign * own
    return np.maximum(out, 0)


def exchange(neighbours: DataFrame, core: int, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(class of END, each core word and the rest; class bigrams). Class 0 is END's, the last one that of the words outside the core.

    The most frequent words begin in classes of their own, the others join in
    the first round. In a round each word in turn may move to the class its
    contexts prefer, if that makes the class bigrams likelier; contexts are
    those at the round's beginning, so a round that did not help is undone.
    """
    of = np.full(core + 2, classes)
    of[: min(classes, core + 1)] = np.arange(min(classes, core + 1))
    best = None
    for r in range(rounds + 1):
        follow, precede, own = class_contexts(neighbours, of, classes + 1)
        pairs = np.zeros((classes + 1, classes + 1))
        np.add.at(pairs, of, follow)
        reached = likelihood(pairs)
        if r > 1 and reached <= best[0] + 1e-9 * abs(best[0]):
            break
        best = reached, of.copy(), pairs
        if r == rounds:
            break
        wanted = preferences(follow, precede, pairs)[:, 1:classes].argmax(axis=1) + 1
        for w in range(1, core + 1):
            a, b = of[w], wanted[w]
            if a == b:
                continue
            after = moved(pairs, a, b, follow[w], precede[w], own[w])
            then = likelihood(after)
            if a == classes or then > reached:
                pairs, of[w], reached = after, b, then
    return best[1], best[2]


def other_words(texts: DataFrame, core: list[bytes], of: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """(word, n, class) of the words outside the core: the class that all their occurrences next to core words prefer."""
    rest, classes = len(core) + 1, len(pairs) - 1
    shared = texts.sparkSession.sparkContext.broadcast({w: i + 1 for i, w in enumerate(core)})
    logs = log_transitions(pairs)
    after, before = logs.copy(), logs.T.copy()  # of the word after class l; of class r after the word
    after[classes], before[classes] = 0, 0  # a word outside the core tells nothing
    size = np.log(np.maximum(pairs.sum(axis=0), 1))[1:classes]
    weights = np.concatenate([after[:, 1:classes], before[:, 1:classes]])
    wide = len(weights)

    def run(batches):
        find, names, words, lefts, rights = shared.value.get, {}, [], [], []

        def gathered():
            at, left, right = np.array(words, "i8"), np.concatenate(lefts), np.concatenate(rights)
            order = np.argsort(at, kind="stable")
            both = np.stack([left[order], right[order]], axis=1).astype("u1").ravel()
            ends = np.append(0, np.bincount(at, minlength=len(names)).cumsum())
            cuts = np.union1d(ends, np.arange(0, ends[-1], PLACES))  # a row of a word has PLACES places at most
            owners = np.array(list(names), object)[np.searchsorted(ends, cuts[:-1], side="right") - 1]
            return pa.RecordBatch.from_pydict({"word": pa.array(owners, pa.binary()), "places": packed(both, 2 * cuts)})

        for _, part in texts_of(batches, 0):
            for t in part:
                found = split(t)
                ids = np.array([0, *map(find, found, repeat(rest)), 0])
                at = np.flatnonzero(ids == rest)
                if len(at):
                    words += [names.setdefault(found[i - 1], len(names)) for i in at.tolist()]
                    lefts.append(of[ids[at - 1]])
                    rights.append(of[ids[at + 1]])
            if len(words) > 4 * GATHERED:
                yield gathered()
                names, words, lefts, rights = {}, [], [], []
        if words:
            yield gathered()

    def choose(batches):
        """Rows come by word; the places of the last word may go on in the next batch. A word is as many numbers as there are classes before and after it."""
        last, total = None, np.zeros(wide, "i8")
        for batch in by_bytes(batches, 1, 2 * PLACES):
            names = batch.column(0).to_pylist()
            if not names:
                continue
            places, sizes = unpacked(batch.column(1), "u1")
            new = np.array([True, *map(ne, names[1:], names)])
            words = [names[i] for i in np.flatnonzero(new).tolist()]
            at = np.repeat((new.cumsum() - 1) * wide, sizes // 2)
            sums = np.bincount(np.concatenate([at + places[0::2], at + places[1::2] + wide // 2]), minlength=len(words) * wide).reshape(-1, wide)
            if last == words[0]:
                sums[0] += total
            elif last is not None:
                yield named([last], total[None])
            last, total = words[-1], sums[-1].copy()
            if len(words) > 1:
                yield named(words[:-1], sums[:-1])
        if last is not None:
            yield named([last], total[None])

    def named(words, sums):
        counts = sums[:, : wide // 2].sum(axis=1)
        chosen = (sums @ weights - counts[:, None] * size).argmax(axis=1) + 1
        return pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary()), "n": pa.array(counts), "class": pa.array(chosen.astype("i4"))})

    rows = texts.mapInArrow(run, "word binary, places binary")
    return rows.repartition("word").sortWithinPartitions("word").mapInArrow(choose, "word binary, n long, class int")


@dataclass
class Model:
    """``words``: (word, n, class) of all training words and END; token and word numbers; what classes emit and how they follow each other.

    ``follows`` has a row per class and one for unseen words, ``unseen`` the
    probability of an unseen word after each of them, ``sizes`` the tokens of
    each class and ``discount`` what is taken from the counts of its words.
    """

    words: DataFrame
    tokens: int
    types: int
    sizes: np.ndarray
    discount: np.ndarray
    numbers: np.ndarray
    follows: np.ndarray | None = None
    unseen: np.ndarray | None = None


def learn_classes(texts: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, core: int = CORE) -> Model:
    """The words of a column of training texts with their classes; transitions are not known yet."""
    counts = stored(word_counts(texts))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count(F.when(F.col("n") == 1, 1)), F.count(F.when(F.col("n") == 2, 1)), F.coalesce(F.max(F.when(F.col("word") == F.lit(END), F.col("n"))), F.lit(0))).first()
    tokens, types, once, twice, ends = total
    chosen = frequent(counts, core)
    discard(counts)
    names, own = chosen.column("word").to_pylist(), chosen.column("n").to_pylist()
    of, pairs = exchange(core_neighbours(texts, names), len(names), classes, rounds)
    known = [(bytearray(END), ends, 0), *[(bytearray(w), n, int(c)) for w, n, c in zip(names, own, of[1:], strict=False)]] if types else []
    spark = texts.sparkSession
    words = stored(spark.createDataFrame(known, "word binary, n long, class int").unionAll(other_words(texts, names, of, pairs)))
    sizes, numbers = np.zeros(classes), np.zeros(classes)
    for r in words.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
        sizes[r["class"]], numbers[r["class"]] = r["n"], r["types"]
    discount = np.full(classes, once / (once + 2 * twice) if once and twice else 0.5)
    discount[0] = 0.0
    return Model(words, tokens, types, sizes, discount, numbers)


def encoded(docs: DataFrame, words: DataFrame, dictionary: int = DICTIONARY) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """((doc_id, held_out, ids, places, ns, classes), counts and classes of the dictionary) of (doc_id, held_out, text).

    ``ids``: a number per token, below zero for the words outside the
    dictionary: -1 - k is the k-th of the text's own. ``places`` names those of
    them that training saw, with their counts and classes.
    """
    table = frequent(words, dictionary)
    shared = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(table.column("word").to_pylist())})

    def run(batches):
        find = shared.value.get
        for batch, part in texts_of(batches, 2):
            found, sizes, rest = [], [], []
            for t in part:
                own = split(t)
                found += own
                sizes.append(len(own))
            ids, ends = np.array(list(map(find, found, repeat(-1))), "<i4"), np.append(0, np.cumsum(sizes))
            at = np.flatnonzero(ids < 0)
            cuts = np.searchsorted(at, ends).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                names = {}
                ids[at[a:b]] = [-1 - names.setdefault(found[i], len(names)) for i in at[a:b].tolist()]
                rest.append(list(names))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), packed(ids, ends.astype("i8")), pa.array(rest, pa.list_(pa.binary()))], names=["doc_id", "held_out", "_row", "ids", "rest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "held_out", "text", F.monotonically_increasing_id().alias("_row"))
    coded = stored(rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, _row long, ids binary, rest array<binary>"))
    asked = coded.select("_row", F.posexplode("rest").alias("place", "word")).join(words, "word")
    answers = asked.groupBy("_row").agg(F.collect_list(F.struct("place", "n", "class")).alias("a"))
    joined = coded.drop("rest").join(answers, "_row", "left")
    out = stored(joined.select("doc_id", "held_out", "ids", F.col("a.place").alias("places"), F.col("a.n").alias("ns"), F.col("a.class").alias("classes")))
    discard(coded)
    return out, table.column("n").to_numpy(), table.column("class").to_numpy()


def tokens_of(batch: pa.RecordBatch, first: int, counts: np.ndarray, classes: np.ndarray, ends: int, unseen: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, classes, sizes): of all tokens of the batch's texts, each text with its END; columns from ``first`` on are those of ``encoded``."""
    ids, sizes = unpacked(batch.column(first), "<i4")
    n, c = counts[np.maximum(ids, 0)] if len(counts) else np.zeros(len(ids), "i8"), classes[np.maximum(ids, 0)] if len(classes) else np.zeros(len(ids), "i4")
    n, c = np.where(ids < 0, 0, n), np.where(ids < 0, unseen, c)
    starts = np.append(0, sizes.cumsum())
    for i, (place, count, of) in enumerate(zip(*(batch.column(first + k).to_pylist() for k in (1, 2, 3)), strict=True)):
        if place:
            own = ids[starts[i] : starts[i + 1]]
            most = int(-1 - own.min()) + 1
            known_n, known_c = np.zeros(most, "i8"), np.full(most, unseen)
            known_n[place], known_c[place] = count, of
            at = np.flatnonzero(own < 0)
            n[starts[i] + at], c[starts[i] + at] = known_n[-1 - own[at]], known_c[-1 - own[at]]
    return np.insert(n, starts[1:], ends), np.insert(c, starts[1:], 0), sizes + 1


def before_each(c: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The class before each token; that of END before the first of a text."""
    out = np.append(0, c[:-1])
    out[np.append(0, sizes.cumsum()[:-1])] = 0
    return out


def count_transitions(coded: DataFrame, counts: np.ndarray, classes: np.ndarray, model: Model) -> np.ndarray:
    """Class bigrams of the training texts: a matrix from each task."""
    k = len(model.sizes)

    def run(batches):
        pairs = np.zeros(k * k, "i8")
        for batch in slices(batches, 256):
            _, c, sizes = tokens_of(batch, 0, counts, classes, 1, 0)
            pairs += np.bincount(before_each(c, sizes) * k + c, minlength=k * k)
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(at.astype("i4")), "n": pa.array(pairs[at])})

    rows = coded.filter("NOT held_out").select("ids", "places", "ns", "classes").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros(k * k)
    for r in rows:
        pairs[r["pair"]] = r["n"]
    return pairs.reshape(k, k)


def with_transitions(model: Model, pairs: np.ndarray) -> Model:
    """Transitions are mixed with the classes' frequencies; after an unseen word comes what comes after the classes it may be of."""
    share = model.sizes / max(model.tokens, 1)
    follows = (pairs + PRIOR * share) / (pairs.sum(axis=1, keepdims=True) + PRIOR)
    saved = model.discount * model.numbers
    unseen = follows @ (saved / np.maximum(model.sizes, 1))
    mixed = (saved / saved.sum() if saved.sum() else share) @ follows
    model.follows, model.unseen = np.vstack([follows, mixed]), np.append(unseen, mixed @ (saved / np.maximum(model.sizes, 1)))
    return model


def score_texts(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, core: int = CORE, dictionary: int = DICTIONARY, id_col: str = "doc_id", text_col: str = "text", held: Column | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``base_score`` and ``score`` are sums of log10 probabilities of all tokens,
    one END for each text, by the smoothed frequencies of words and by the class
    model. Null texts are empty; a null id is trained on; repeated rows count and
    are scored as often as they are there; without any training text, nothing is
    known and both scores are 0. An empty table gives no rows.
    """
    if not 2 < classes < 255:
        raise ValueError("there are 3 to 254 classes")
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), (held_out(F.col(id_col)) if held is None else held).alias("held_out"), F.col(text_col).alias("text"))
    model = learn_classes(rows.filter("NOT held_out").select("text"), classes, rounds, core)
    coded, counts, of = encoded(rows, model.words, dictionary)
    model = with_transitions(model, count_transitions(coded, counts, of, model))
    tokens, types, own = model.tokens, model.types, OWN if model.tokens else 1.0
    sizes, discount, follows, unseen = np.maximum(model.sizes, 1), model.discount, model.follows, model.unseen
    ends = int(model.sizes[0])

    def run(batches):
        for batch in slices(batches, 256):
            if not batch.num_rows:
                continue
            n, c, lengths = tokens_of(batch, 2, counts, of, ends, classes)
            before, new = before_each(c, lengths), c == classes
            if not ends:
                c, new = np.full(len(c), classes), np.ones(len(c), bool)
                before = c
            seen = np.where(new, 0, c)
            by_class = np.where(new, unseen[before], follows[before, seen] * (n - discount[seen]) / sizes[seen])
            base = (n + 0.5) / (tokens + 0.5 * (types + 1))
            starts = np.append(0, lengths.cumsum()[:-1])
            sums = [np.add.reduceat(x, starts) for x in ((n > 0).astype("i8"), np.log10(base), np.log10((1 - own) * by_class + own * base))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lengths), pa.array(sums[0]), pa.array(np.full(len(lengths), tokens, "i8")), pa.array(sums[1]), pa.array(sums[2])], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
