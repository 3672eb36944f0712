"""Scores of documents by masked pseudo-likelihood.

A small network sees the two words before and the two after a place, never the word itself, and
gives a probability for every word of the vocabulary. A document's score is the sum of the log
probabilities of all its words. The vocabulary is the most frequent words of the whole corpus;
all others share buckets by their last two bytes, and such a word's probability is the bucket's
times the word's share of it: its count, of the bucket's count and number of words. What that
leaves is for words that were not counted, spelled in bytes of equal probability. The output is a softmax over classes, then over
the members of the word's class, so a word costs two small softmaxes and probabilities sum to one.

Texts are read twice: words are counted, then turned into ids, which are written and serve the
training and the scores. The counts of the most frequent words outside the vocabulary are held by
every task that makes ids, so that only the rest of the words meet their counts by a join.

Training covers every document once. The corpus is cut by a hash of the text into as many parts as
there are rounds; in a round every task trains its own copy in numpy on all its documents of that
part, and the copies are averaged, weighted by words, in two steps of bounded size. So what is
gathered, word counts and a copy of the network from every task, grows with the input, while one
task and the driver hold one network at a time.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterkit.llm.common import BATCH_ROWS, id_and_text, map_rows, written
from clusterkit.scratch import shared_dir

CLASSES, MEMBERS = 64, 64
BUCKETS = 96
WORDS = CLASSES * MEMBERS - BUCKETS
PAD = CLASSES * MEMBERS  # stands beyond the ends of a document
EMBED, HIDDEN = 16, 32
OFFSETS = (-2, -1, 1, 2)
#: Words of a training step; longer words than this many bytes are always in a bucket.
STEP, LONG_WORD = 16384, 64
#: Places whose outputs are computed at a time, so that they stay in the cache.
BLOCK = 1024
#: Words outside the vocabulary, the most frequent, whose counts every task holds, at most.
HELD_COUNTS = 200_000
#: A copy of the network weighs as much as some 100,000 words, so a task that trains one is to have
#: several times that: small partitions are joined until it does.
TASK_WORDS = 500_000

COUNTS = "word string, n long"
#: Words that a task holds before it counts them for the shuffle, and bytes of texts that it looks up at a time.
HELD_WORDS, READ_BYTES = 2_500_000, 1 << 23


@dataclass
class Vocabulary:
    """Ids of words; id // MEMBERS is the class. ``log_share``: of each id in the corpus."""

    ids: dict[bytes, int]
    bucket_ids: list[int]
    log_share: np.ndarray
    words: int = 0  # of the whole corpus
    counts: str = ""  # the table of words and their counts
    bucket_count: np.ndarray | None = None  # of each bucket, of words outside the vocabulary
    bucket_words: np.ndarray | None = None  # and how many different ones

    held: pa.Array | None = None  # words of the vocabulary, and others whose counts are held
    id_of: np.ndarray | None = None  # of each, its own id or its bucket's
    inside: np.ndarray | None = None  # and its log probability in its bucket, 0 for the vocabulary's

    def stream(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, two pads around each text, and the number of words of each text."""
        ids, count, *_ = self.read(pa.array(texts, pa.string()))
        return np.append([PAD, PAD], ids).astype(np.int32), count

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Ids of all words, two pads behind each text. Then, of each text: the number of its words and
        the sum of the log probabilities that its held words have in their buckets. Then all words in
        buckets that are not held, and how many each text has."""
        words, count = split_words(texts)
        found = pc.index_in(words, value_set=self.held).fill_null(-1).to_numpy()
        ids, share, other = self.id_of[found], self.inside[found], found < 0
        rest = words.filter(pa.array(other))
        kinds = rest.dictionary_encode()
        bucket = [self.bucket_ids[zlib.crc32(w[-2:]) % BUCKETS] for w in kinds.dictionary.cast(pa.binary()).to_pylist()]
        ids[other] = np.array(bucket, np.uint16)[kinds.indices.to_numpy()]
        share[other] = 0
        stream = np.full(len(ids) + 2 * len(texts), PAD, np.uint16)
        stream[np.arange(len(ids)) + 2 * np.repeat(np.arange(len(texts)), count)] = ids
        return stream, count, _sums(share, count), rest, _sums(other.astype(np.int64), count)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A to Z in lower case, and the number of words of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))  # Spark may give large ones
    words = split.flatten()
    there = pc.binary_length(words).to_numpy() > 0  # white space at an end gives an empty word
    count = _sums(there.astype(np.int64), np.diff(split.offsets.to_numpy()))
    return words.filter(pa.array(there)), count


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of consecutive runs of the given sizes."""
    total = np.append(np.zeros(1, values.dtype), np.cumsum(values))
    ends = np.append(0, np.cumsum(size))
    return total[ends[1:]] - total[ends[:-1]]


def count_words(docs: DataFrame) -> Vocabulary:
    """The vocabulary from counts over all texts of ``docs`` (doc_id, text).

    How many words there are of each order of frequency says from which on the most frequent are to
    be looked for, so that tasks send the driver those few words, of bounded length, and not their
    own most frequent ones each. Beside them it gets one count for each bucket.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def out() -> pa.RecordBatch:
            found = pa.chunked_array(held, pa.string()).value_counts()
            return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])

        for batch in batches:
            held.append(split_words(batch.column("text"))[0])
            if sum(map(len, held)) >= HELD_WORDS:
                yield out()
                held.clear()
        if held:
            yield out()

    path = shared_dir(docs.sparkSession, "lm-words")
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    docs.select("text").mapInArrow(count, COUNTS).groupBy("word").agg(F.sum("n").alias("n")).write.parquet(path)
    counts = docs.sparkSession.read.schema(COUNTS).parquet(path)
    short = counts.filter(F.octet_length("word") <= LONG_WORD)
    order = F.floor(F.log2("n") * 4).cast("int")
    least, least_held, found = 0, None, 0
    for r in sorted(short.groupBy(order.alias("o")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r.o):
        if found < WORDS:
            least = r.o
        found += r.n
        if found <= WORDS + HELD_COUNTS:
            least_held = r.o
    likely = short.filter(order >= least)
    top = [(r.word.encode(), r.n) for r in likely.orderBy(F.desc("n"), "word").limit(WORDS).collect()]
    of_bucket = counts.groupBy(_bucket().alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()
    rest, kinds = {r.b: r.n for r in of_bucket}, {r.b: r.kinds for r in of_bucket}
    for w, n in top:
        rest[zlib.crc32(w[-2:]) % BUCKETS] -= n
        kinds[zlib.crc32(w[-2:]) % BUCKETS] -= 1
    entries = [(n, 0, w) for w, n in top] + [(rest.get(b, 0), 1, b) for b in range(BUCKETS)]
    entries.sort(key=lambda e: (-e[0], e[1], e[2] if e[1] else 0, e[2] if not e[1] else b""))
    ids, buckets = {}, [0] * BUCKETS
    share = np.full(PAD, 0.5)
    for place, (n, is_bucket, what) in enumerate(entries):
        # Dealt round the classes by frequency, so that classes weigh about the same.
        i = place % CLASSES * MEMBERS + place // CLASSES
        share[i] += n
        if is_bucket:
            buckets[what] = i
        else:
            ids[what] = i
    each = [np.array([x.get(b, 0) for b in range(BUCKETS)], float) for x in (rest, kinds)]
    held = [] if least_held is None else short.filter(order >= least_held).collect()
    held = sorted((w, r.n) for r in held if (w := r.word.encode()) not in ids)
    bucket = np.array([zlib.crc32(w[-2:]) % BUCKETS for w, _ in held], np.int64)
    id_of = np.append(list(ids.values()), np.array(buckets)[bucket]).astype(np.uint16)
    log_n = np.log(np.array([n for _, n in held], float))
    inside = np.append(np.zeros(len(ids)), log_n - np.log(np.maximum(each[0] + each[1], 1))[bucket])
    # One more of each, so that a word that is not found (-1) has a place.
    id_of, inside = np.append(id_of, np.uint16(PAD)), np.append(inside, 0)
    names = pa.array([*ids, *(w for w, _ in held)], pa.binary()).cast(pa.string())
    return Vocabulary(ids, buckets, np.log(share / share.sum()), sum(n for n, *_ in entries), path, *each,
                      names, id_of, inside)


def _bucket():
    tail = F.expr("substring(encode(word, 'UTF-8'), -2, 2)")
    return F.pmod(F.crc32(tail), F.lit(BUCKETS)).cast("int")


def _log_share_of_bucket(vocab: Vocabulary):
    """Of columns word and n (null: not counted), the log probability of the word in its bucket.

    Witten-Bell: words not counted have as much as the number of different words counted, and a
    string of k bytes has 1 / 257^(k + 1) of it, which sums to one.
    """
    total = np.maximum(vocab.bucket_count + vocab.bucket_words, 1)
    of = lambda x: F.element_at(F.array(*map(F.lit, np.log(x).tolist())), _bucket() + 1)
    unseen = of(np.maximum(vocab.bucket_words, 1)) - (F.octet_length("word") + 1) * math.log(257)
    return F.coalesce(F.log("n"), unseen) - of(total)


class Network:
    """Embeddings of the window, one hidden layer, class and member outputs."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts
        self.speed = {k: np.full_like(v, 1e-3) for k, v in parts.items()}

    @staticmethod
    def initial(vocab: Vocabulary, seed: int = 1) -> "Network":
        """Outputs the shares of the corpus for any window; random only in the inner layers."""
        rng = np.random.default_rng(seed)
        share = np.exp(vocab.log_share).reshape(CLASSES, MEMBERS)
        mass = share.sum(axis=1, keepdims=True)
        f = np.float32
        return Network({
            "embed": (rng.standard_normal((PAD + 1, EMBED)) * 0.3).astype(f),
            "inner": (rng.standard_normal((len(OFFSETS) * EMBED, HIDDEN)) * 0.12).astype(f),
            "inner_bias": np.zeros(HIDDEN, f),
            "class": np.zeros((HIDDEN, CLASSES), f),
            "class_bias": np.log(mass[:, 0]).astype(f),
            "member": np.zeros((CLASSES, HIDDEN, MEMBERS), f),
            "member_bias": np.log(share / mass).astype(f),
        })

    @staticmethod
    def of(flat: np.ndarray, like: "Network") -> "Network":
        parts, at = {}, 0
        for k, v in like.parts.items():
            parts[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        return Network(parts)

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.parts.values()])

    # Columns are places here, so that what runs over the few classes or members of each place is
    # done for many places at a time. Biases are the last row of the weights, met by a row of ones.

    def _outer(self) -> tuple[np.ndarray, np.ndarray]:
        p = self.parts
        return (np.concatenate([p["class"], p["class_bias"][None]]),
                np.concatenate([p["member"], p["member_bias"][:, None]], axis=1))

    def _hidden(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.parts
        seen = p["embed"].take(window, axis=0).reshape(len(window), -1)
        hidden = np.ones((HIDDEN + 1, len(window)), np.float32)
        inner = hidden[:-1]
        np.matmul(p["inner"].T, seen.T, out=inner)
        inner += p["inner_bias"][:, None]
        np.tanh(inner, out=inner)
        return seen, hidden

    def log_probability(self, window: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target given its window, in the order given."""
        classes, members = self._outer()
        out = np.empty(len(target), np.float64)
        for at, cls, member, runs in _blocks(target):
            hidden = self._hidden(window.take(at, axis=0))[1]
            own = _members(members, hidden, runs)
            out[at] = _log_share(classes.T @ hidden, cls) + _log_share(own, member)
        return out

    def learn(self, window: np.ndarray, target: np.ndarray, rate: float = 0.08) -> None:
        """One step of Adagrad on the mean log probability."""
        p, n = self.parts, len(target)
        classes, members = self._outer()
        grad = {k: np.zeros_like(p[k]) for k in ("inner", "inner_bias")}
        outer, own = np.zeros_like(classes), np.zeros_like(members)
        d_seen = np.empty((len(OFFSETS) * EMBED, n), np.float32)
        done, order = 0, []
        for at, cls, member, runs in _blocks(target):
            seen, hidden = self._hidden(window.take(at, axis=0))
            d_class = _gradient(classes.T @ hidden, cls, n)
            d_member = _gradient(_members(members, hidden, runs), member, n)
            d_hidden = p["class"] @ d_class
            outer += hidden @ d_class.T
            for c, a, b in runs:
                own[c] += hidden[:, a:b] @ d_member[:, a:b].T
                d_hidden[:, a:b] += p["member"][c] @ d_member[:, a:b]
            d_hidden *= 1 - hidden[:-1] * hidden[:-1]
            grad["inner"] += (d_hidden @ seen).T
            grad["inner_bias"] += d_hidden.sum(axis=1)
            np.matmul(p["inner"], d_hidden, out=d_seen[:, done:done + len(at)])
            done += len(at)
            order.append(at)
        grad |= {"class": outer[:-1], "class_bias": outer[-1], "member": own[:, :-1], "member_bias": own[:, -1]}
        d_seen = d_seen.reshape(len(OFFSETS), EMBED, -1)
        where = window[np.concatenate(order)].T.ravel().astype(np.int64)
        grad["embed"] = np.stack(
            [np.bincount(where, d_seen[:, k].ravel(), PAD + 1) for k in range(EMBED)], axis=1).astype(np.float32)
        for k, g in grad.items():
            self.speed[k] += g * g
            p[k] -= np.float32(rate) * g / np.sqrt(self.speed[k])


def _blocks(target: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]]:
    """The places in the order of their targets, some at a time, with class and member of each, and
    each class with where it begins and ends."""
    order = np.argsort(target.astype(np.uint16), kind="stable")  # by radix, as the numbers have 16 bits
    for k in range(0, len(order), BLOCK):
        at = order[k:k + BLOCK]
        cls, member = np.divmod(target.take(at).astype(np.int64), MEMBERS)
        edges = [0, *(np.flatnonzero(np.diff(cls)) + 1).tolist(), len(at)]
        yield at, cls, member, [(int(cls[a]), a, b) for a, b in zip(edges, edges[1:])]


def _members(weights: np.ndarray, hidden: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Scores of the members of each place's class."""
    out = np.empty((MEMBERS, hidden.shape[1]), np.float32)
    for c, a, b in runs:
        np.matmul(weights[c].T, hidden[:, a:b], out=out[:, a:b])
    return out


def _tame(scores: np.ndarray) -> np.ndarray:
    """The scores, less each column's largest where sums of exp could overflow or vanish."""
    if scores.max(initial=0) > 80 or scores.min(initial=0) < -60:
        scores -= scores.max(axis=0)
    return scores


def _log_share(scores: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Of column i the log share of row which[i]. Changes the scores."""
    own = _tame(scores)[which, np.arange(len(which))].astype(np.float64)
    return own - np.log(np.exp(scores, out=scores).sum(axis=0))


def _gradient(scores: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
    """Of the mean negative log share of ``n`` places, these among them, with respect to the scores."""
    share = np.exp(_tame(scores), out=scores)
    share *= 1 / (share.sum(axis=0) * np.float32(n))
    share[which, np.arange(len(which))] -= np.float32(1 / n)
    return share


def windows(stream: np.ndarray, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, target) of all words of a stream, some thousands at a time."""
    places = np.flatnonzero(stream != PAD)
    for a in range(0, len(places), step):
        at = places[a:a + step]
        yield np.stack([stream[at + o] for o in OFFSETS], axis=1), stream[at]


IDS = "doc_id long, row long, part int, n_words long, ids binary, inside double, rare array<string>"


def _with_ids(rows: DataFrame, vocab: Vocabulary, rounds: int) -> DataFrame:
    """Columns doc_id, row (a number of its own), part (the round that trains it), n_words, ids (two
    bytes each, two pads behind), inside (of the words whose counts are held) and rare (the other
    words in buckets), one row for each row of ``rows``; written."""
    spark = rows.sparkSession
    shipped = spark.sparkContext.broadcast(vocab)
    names = ["doc_id", "row", "part", "n_words", "ids", "inside", "rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = shipped.value
        done = TaskContext.get().partitionId() << 33
        for batch in _joined(batches, READ_BYTES):
            n = len(batch)
            stream, count, inside, rest, others = words_of.read(batch.column("text"))
            ends = np.append(0, np.cumsum(2 * (count + 2))).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(stream.astype("<u2"))])
            rare = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(others)), pa.int32()), rest)
            row = pa.array(np.arange(done, done + n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), row, batch.column("part"), pa.array(count), ids, pa.array(inside), rare], names)
            done += n

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    part = F.pmod(F.xxhash64("text"), F.lit(rounds)).cast("int")
    return written(rows.withColumn("part", part).mapInArrow(run, IDS), "lm-ids")


def _joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold ``size`` bytes."""
    held, got = [], 0
    for batch in batches:
        held.append(batch)
        got += batch.nbytes
        if got >= size:
            yield pa.concat_batches(held)
            held, got = [], 0
    if held:
        yield pa.concat_batches(held)


def _stream(batch: pa.RecordBatch) -> np.ndarray:
    """The ids of a batch, two pads around each text."""
    pads = np.array([PAD, PAD], "<u2").tobytes()
    return np.frombuffer(pads + b"".join(batch.column("ids").to_pylist()), "<u2")


def _train(part: DataFrame, start: Network) -> Network:
    """The average of the copies that all tasks have trained from ``start``. ``part``: ids."""
    spark = part.sparkSession
    shipped = spark.sparkContext.broadcast(start.flat())
    empty = {k: np.zeros_like(v) for k, v in start.parts.items()}
    schema = "task long, words double, net binary"
    names = ["task", "words", "net"]

    def packed(task: int, words: float, flat: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([task], pa.int64()), pa.array([float(words)], pa.float64()),
             pa.array([flat.astype("<f4").tobytes()], pa.binary())], names)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.of(shipped.value, Network(empty))
        done, left = 0, None
        for batch in batches:
            for window, target in windows(_stream(batch)):
                done += len(target)
                if left is not None:  # a step is filled up from the next batch
                    window, target = np.concatenate([left[0], window]), np.concatenate([left[1], target])
                    left = None
                if len(target) < STEP // 2:
                    left = window, target
                else:
                    net.learn(window, target)
        if left is not None:
            net.learn(*left)
        if done:
            yield packed(TaskContext.get().partitionId(), done, net.flat())

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = None, 0.0
        for batch in batches:
            for words, net in zip(batch.column("words").to_pylist(), batch.column("net").to_pylist()):
                flat = np.frombuffer(net, "<f4").astype(np.float64) * words
                total = flat if total is None else total + flat
                weight += words
        if total is not None:
            yield packed(0, weight, total / weight)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    copies = written(part.mapInArrow(train, schema), "lm-copies")
    n = copies.count()
    groups = max(1, math.isqrt(n))
    for k in (groups, 1) if groups > 1 else (1,):
        copies = copies.repartition(k, F.pmod("task", F.lit(groups))).mapInArrow(average, schema).withColumn(
            "task", F.lit(0).cast("long"))
    best = copies.collect()  # one network
    return Network.of(np.frombuffer(best[0].net, "<f4"), start) if best else start


def fit(docs: DataFrame, rounds: int = 2, id_col: str = "doc_id", text_col: str = "text") -> tuple[Vocabulary, Network]:
    """Vocabulary and network of all texts; each text is trained on in one of the rounds."""
    rows = id_and_text(docs, id_col, text_col)
    vocab = count_words(rows)
    return vocab, _fitted(_with_ids(rows, vocab, rounds), vocab, rounds)


def _fitted(read: DataFrame, vocab: Vocabulary, rounds: int) -> Network:
    net = Network.initial(vocab)
    for k in range(rounds):
        part = read.filter(F.col("part") == k).select("ids")
        net = _train(part.coalesce(max(1, vocab.words // rounds // TASK_WORDS)), net)
    return net


def lm_scores(docs: DataFrame, rounds: int = 2, fitted: tuple[Vocabulary, Network] | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, n_words, log_likelihood, mean_log_likelihood, one row for each row.

    ``fitted``: from ``fit``, else it is fitted to ``docs``. Null and empty texts have no words, the
    sum 0 and a null mean. Null ids stay null, repeated rows are each trained on and scored, other
    columns are not read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    vocab = fitted[0] if fitted else count_words(rows)
    read = _with_ids(rows, vocab, rounds)
    net = fitted[1] if fitted else _fitted(read, vocab, rounds)
    shipped = spark.sparkContext.broadcast(net.parts)

    def make():
        model = Network(shipped.value)

        def work(batch: pa.RecordBatch) -> list:
            each = [model.log_probability(w, t) for w, t in windows(_stream(batch))]
            ends = np.append(0, np.cumsum(np.concatenate(each) if each else np.zeros(0)))
            at = np.append(0, np.cumsum(batch.column("n_words").to_numpy()))
            total = ends[at[1:]] - ends[at[:-1]] + batch.column("inside").to_numpy()
            return [batch.column("doc_id"), batch.column("row"), batch.column("n_words"), total]

        return work

    scored = map_rows(
        read.select("doc_id", "row", "n_words", "ids", "inside"), make, "doc_id long, row long, n_words long, total double",
        pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()), ("total", pa.float64())]))
    counts = spark.read.schema(COUNTS).parquet(vocab.counts)
    rare = read.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    inside = rare.groupBy("row").agg(F.sum(_log_share_of_bucket(vocab)).alias("inside"))
    score = F.col("total") + F.coalesce("inside", F.lit(0.0))
    return scored.join(inside, "row", "left").select(
        "doc_id", "n_words", score.alias("log_likelihood"),
        F.when(F.col("n_words") > 0, score / F.col("n_words")).alias("mean_log_likelihood"))
