"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network sees WINDOW tokens on either side of a hidden one and predicts it: a table of
vectors for each place of the window, their sum through tanh, and a softmax over the
vocabulary. A document's score is the sum of the log-probabilities of all its tokens, each
predicted from both sides.

The network's vocabulary is the corpus's most frequent words, and buckets for the others. A word of
a bucket has the probability of the bucket, times that of the word among the bucket's words, by how
often the corpus has them: the KNOWN most frequent are at hand in every task, the others are joined.
Texts are cut into tokens twice, to count the words and to write their ids, which training and
scoring read. Training runs where the texts are: in every round each task starts from the same
weights, learns from its share of the documents, and the weights are averaged by the number of
tokens they were learned from. A document belongs to one round, and one in MASK_EVERY of its
tokens is hidden there.
"""

import re
from collections import Counter, defaultdict
from itertools import count, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from evrange.llm import pretokens
from evrange.llm.common import col, staged

WORDS, BUCKETS = 223, 32        # with the token outside a text 256 in all
HIDDEN, WINDOW = 24, 2
ROUNDS, MASK_EVERY = 3, 8
RATE, BATCH = 0.15, 1024
TOKEN = r"\w+|[^\w\s]"
PIECE = re.compile(TOKEN + r"|\n")      # of pieces without white space, one a line
OUTSIDE = 0
PLACES = 2 * WINDOW
SIZE = 1 + WORDS + BUCKETS
LARGEST = 60.0                  # logits that exp() takes as they are
KNOWN = 100_000                 # words of buckets, at most, whose counts every task holds
SLOTS = 1 << 21                 # windows, at most, whose probability a task holds
UNIT = 1e9                      # joined logarithms are summed as whole numbers of 1 / UNIT, in any order


def bucket(word: str) -> int:
    """The id of a word that is not among the frequent ones: by its length and last character."""
    return 1 + WORDS + (7 * ord(word[-1]) + len(word)) % BUCKETS


# --- the network

class Network:
    """Weights: a table for each place (PLACES x vocabulary x HIDDEN), `out` (HIDDEN x vocabulary), `bias`."""

    def __init__(self, flat: np.ndarray, size: int):
        n = PLACES * size * HIDDEN
        self.size, self.flat = size, np.ascontiguousarray(flat, dtype=np.float32)
        self.tables = self.flat[:n].reshape(PLACES, size, HIDDEN)
        self.out = self.flat[n:n + HIDDEN * size].reshape(HIDDEN, size)
        self.bias = self.flat[n + HIDDEN * size:]

    @classmethod
    def fresh(cls, counts: np.ndarray):
        """Small random vectors, and the frequencies of the tokens as bias."""
        size, random = len(counts), np.random.default_rng(0)
        vectors = random.normal(0, 0.1, (PLACES + 1) * size * HIDDEN)
        share = (counts + 1) / (counts + 1).sum()
        return cls(np.concatenate((vectors, np.log(share))), size)

    def hidden(self, flat, at):
        total = self.tables[0].take(flat[at - WINDOW], axis=0)
        for place, shift in enumerate([*range(-WINDOW, 0), *range(1, WINDOW + 1)]):
            if place:
                total += self.tables[place].take(flat[at + shift], axis=0)
        return np.tanh(total, out=total)

    def log_probabilities(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the tokens of `flat` at the places `at`, each from both its sides."""
        result, step = np.empty(len(at)), 1024
        plain = float((np.abs(self.out).sum(axis=0) + np.abs(self.bias)).max()) < LARGEST
        out = np.vstack((self.out, self.bias))
        hidden, logits = np.ones((step, HIDDEN + 1), np.float32), np.empty((step, self.size), np.float32)
        for i in range(0, len(at), step):
            part = at[i:i + step]
            n = len(part)
            hidden[:n, :HIDDEN] = self.hidden(flat, part)
            p = np.matmul(hidden[:n], out, out=logits[:n])
            if not plain:
                p -= p.max(axis=1, keepdims=True)
            target = p[np.arange(n), flat[part]]
            np.exp(p, out=p)
            result[i:i + n] = target - np.log(p.sum(axis=1))
        return result

    def learn(self, flat: np.ndarray, at: np.ndarray, squares: "Network"):
        """Steps of Adagrad over batches of hidden places; `squares` sums the squared slopes."""
        shifts = [*range(-WINDOW, 0), *range(1, WINDOW + 1)]
        for i in range(0, len(at), BATCH):
            part = at[i:i + BATCH]
            hidden = self.hidden(flat, part)
            p = hidden @ self.out + self.bias
            p -= p.max(axis=1, keepdims=True)
            np.exp(p, out=p)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), flat[part]] -= 1
            p /= len(part)
            back = (p @ self.out.T) * (1 - hidden * hidden)
            self._step(self.out, squares.out, hidden.T @ p)
            self._step(self.bias, squares.bias, p.sum(axis=0))
            for place, shift in enumerate(shifts):
                tokens = flat[part + shift]
                order = np.argsort(tokens, kind="stable")
                first = np.flatnonzero(np.diff(tokens[order], prepend=-1))
                rows = tokens[order[first]]
                slope = np.add.reduceat(back[order], first, axis=0)
                squares.tables[place][rows] += slope * slope
                self.tables[place][rows] -= RATE * slope / np.sqrt(squares.tables[place][rows] + 1e-8)

    @staticmethod
    def _step(weights, squares, slope):
        squares += slope * slope
        weights -= RATE * slope / np.sqrt(squares + 1e-8)


class Windows:
    """Log-probabilities of tokens by a network, those of one window computed once: the last that fell on each of SLOTS places are held."""

    def __init__(self, network: Network):
        self.network = network
        self.held, self.values = np.full(SLOTS, -1), np.zeros(SLOTS)
        self.last = np.empty(SLOTS, np.int32)

    def log_probabilities(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.empty(0)
        window = flat[at - WINDOW]
        for shift in range(1 - WINDOW, WINDOW + 1):
            window = window * self.network.size + flat[at + shift]
        slot = (window * -7046029254386353131 >> 20) % SLOTS        # a fixed odd multiplier, for the spread
        result = self.values[slot]
        new = np.flatnonzero(self.held[slot] != window)
        window, slot = window[new], slot[new]
        number = np.arange(len(new), dtype=np.int32)
        self.last[slot] = number
        like = self.last[slot]          # where the last new one of the place is, which may be of another window
        first = (like == number) | (window[like] != window)
        found = np.empty(len(new))
        found[first] = self.network.log_probabilities(flat, at[new[first]])
        found[~first] = found[like[~first]]
        self.held[slot[first]], self.values[slot[first]] = window[first], found[first]
        result[new] = found
        return result


# --- texts as numbers

class Ids(dict):
    """Ids of words; of words that have none their bucket."""

    def __missing__(self, word):
        return bucket(word)


class Pieces:
    """The pieces between white space, which no token crosses, numbered as they are met: each is cut into tokens once.

    The tokens of piece i are those from `ends[i]` to `ends[i + 1]` of `words`, their ids in `of`.
    """

    def __init__(self, ids: Ids):
        self.ids = ids
        self.ids["\n"] = OUTSIDE       # between pieces
        self.forget()

    def forget(self):
        self.number = defaultdict(count().__next__)
        self.words, self.of, self.ends = [], np.empty(0, np.int64), np.zeros(1, np.int64)

    def cut(self):
        """Takes in the pieces that were numbered since the last call."""
        found = PIECE.findall("\n".join(islice(self.number, len(self.ends) - 1, None)))
        if found:
            ids = np.fromiter(map(self.ids.__getitem__, found), np.int64, len(found))
            border = np.append(np.flatnonzero(ids == OUTSIDE), len(ids))
            self.words += [w for w in found if w != "\n"]
            self.of = np.concatenate((self.of, ids[ids != OUTSIDE]))
            self.ends = np.concatenate((self.ends, self.ends[-1] + border - np.arange(len(border))))


def numbers(texts, pieces: Pieces):
    """(ids of the tokens of all texts, number of tokens of each text, place of each token in `pieces.words`)."""
    if len(pieces.number) > 4 * KNOWN:
        pieces.forget()
    number, codes = pieces.number.__getitem__, [np.empty(0, np.int64)]
    for text in texts:
        found = text.lower().split()
        codes.append(np.fromiter(map(number, found), np.int64, len(found)))
    pieces.cut()
    first, codes = np.cumsum(list(map(len, codes))), np.concatenate(codes)
    each = pieces.ends[codes + 1] - pieces.ends[codes]
    ends = np.concatenate(([0], np.cumsum(each)))
    source = np.repeat(pieces.ends[codes] - ends[:-1], each) + np.arange(ends[-1])
    return pieces.of[source], np.diff(ends[first]), source


def laid(column, buckets: np.ndarray):
    """(tokens of all texts with WINDOW outside tokens before, between and after; places of the
    tokens; number of tokens of each text; their ids), of a column of encode()."""
    parts = [np.frombuffer(ids.as_py(), np.uint32) for ids in column]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    own = np.concatenate((np.empty(0, np.uint32), *parts)).astype(np.int64)
    at = np.arange(len(own)) + np.repeat(WINDOW * np.arange(1, len(sizes) + 1), sizes)
    flat = np.full(len(own) + WINDOW * (len(sizes) + 1), OUTSIDE)
    flat[at] = buckets[own]
    return flat, at, sizes, own


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): how often each token occurs in all texts; in lower case, null texts as empty."""
    def run(batches):
        pieces = Counter()

        def flushed():
            # tokens do not cross white space
            total, each = {}, iter(pieces.values())
            n = next(each, 0)
            for word in PIECE.findall("\n".join(pieces)):
                if word == "\n":
                    n = next(each)
                else:
                    total[word] = total.get(word, 0) + n
            pieces.clear()
            return pa.RecordBatch.from_arrays([pa.array(total, pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for t in batch.column(0):
                pieces.update((t.as_py() or "").lower().split())
            if len(pieces) > 500_000:
                yield flushed()
        yield flushed()

    found = docs.select(col(text).alias("t")).mapInArrow(run, "word string, n long")
    return staged(found.groupBy("word").agg(F.sum("n").alias("n")))


def _bucket():
    """As bucket(), from the column `word`."""
    return 1 + WORDS + (7 * F.ascii(F.substr("word", F.lit(-1))) + F.char_length("word")) % BUCKETS


def frequent(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """The WORDS most frequent tokens, and the counts of all ids of their vocabulary, of a table of counted()."""
    table = counts
    top = table.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    counts = np.zeros(SIZE)
    for r in table.groupBy(_bucket().alias("bucket")).agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    for i, r in enumerate(top):     # words of their own are not in the buckets
        counts[1 + i] = r["n"]
        counts[bucket(r["word"])] -= r["n"]
    return [r["word"] for r in top], np.maximum(counts, 0)


def _ids(words):
    return Ids((w, i + 1) for i, w in enumerate(words))


def within_buckets(counts: DataFrame, words: list[str]) -> tuple[np.ndarray, pa.Table]:
    """Of the words without an id of their own: a logarithm for each id, -log of the words of its bucket
    (their occurrences, each word once more, and one for all that are not there), and (word, n) of
    those at the top, at most KNOWN. A word's probability in its bucket is n + 1 to that sum."""
    others = counts.where(~F.col("word").isin(words))
    sums = np.zeros(SIZE)
    for r in others.groupBy(_bucket().alias("bucket")).agg((F.sum("n") + F.count("*") + 1).alias("n")).collect():
        sums[r["bucket"]] = -np.log(r["n"])
    least, room = None, KNOWN
    for r in others.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect():
        room -= r["words"]
        if room < 0:
            break
        least = r["n"]
    return sums, others.where(F.col("n") >= least if least is not None else F.lit(False)).toArrow()


# --- training and scoring

class Encoded(NamedTuple):
    """A table of encode(), and what reads it: the kept columns, `sums` of within_buckets(), and of each id
    from SIZE on its bucket and the occurrences of its word."""
    table: DataFrame
    keep: list[str]
    sums: np.ndarray
    known: pa.Table

    def buckets(self) -> np.ndarray:
        return np.array([*range(SIZE), *map(bucket, self.known["word"].to_pylist())])


def encode(docs: DataFrame, keep: list[str], words: list[str], counts: DataFrame, text: str = "text") -> Encoded:
    """Every text as ids, written once for training and scoring: the kept columns as c0, c1, ..., `hash` and
    `chars` of the text, n_tokens, `ids` (unsigned 32-bit) and `others`, the words of buckets that are not at hand."""
    sums, known = within_buckets(counts, words)
    shared = docs.sparkSession.sparkContext.broadcast((words, known["word"]))
    names = [f"c{i}" for i in range(len(keep))]
    table = docs.select(*(col(k).alias(n) for k, n in zip(keep, names)), F.xxhash64(col(text)).alias("hash"), col(text).alias("t"))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in table.schema[:len(keep)]]
                       + ["hash long, chars long, n_tokens long, ids binary, others array<string>"])

    def run(batches):
        own, listed = shared.value
        ids = _ids(own)
        # ids from SIZE on are words of a bucket at hand
        ids.update((w, SIZE + i) for i, w in enumerate(listed.to_pylist()))
        pieces = Pieces(ids)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(names) + 1).to_pylist()]
            for a, b in pretokens.blocks(texts):
                found, sizes, source = numbers(texts[a:b], pieces)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                unknown = np.flatnonzero((found > WORDS) & (found < SIZE))
                others = pa.ListArray.from_arrays(pa.array(np.searchsorted(unknown, ends), pa.int32()),
                                                  pa.array(map(pieces.words.__getitem__, source[unknown].tolist()), pa.string()))
                packed = found.astype(np.uint32).tobytes()
                cuts = (4 * ends).tolist()
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns[:-1]), pa.array(map(len, texts[a:b]), pa.int64()), pa.array(sizes),
                     pa.array([packed[i:j] for i, j in zip(cuts, cuts[1:])], pa.binary()), others],
                    [*names, "hash", "chars", "n_tokens", "ids", "others"])

    return Encoded(staged(table.mapInArrow(run, schema)), keep, sums, known)


def learn(encoded: Encoded, of_ids: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The weights, learned from all texts; `of_ids` are the counts of frequent()."""
    weights, buckets = Network.fresh(of_ids).flat, encoded.buckets()
    spark = encoded.table.sparkSession
    for number in range(rounds):
        shared = spark.sparkContext.broadcast((weights, buckets))

        def run(batches):
            start, buckets = shared.value
            network = Network(start.copy(), SIZE)
            squares, seen = Network(np.zeros_like(start), SIZE), 0
            for batch in batches:
                for a, b in pretokens.blocks_of(batch.column(0).to_pylist()):
                    flat, at, _, _ = laid(batch.column(1).slice(a, b - a), buckets)
                    hidden = at[(at * 2654435761 >> 7) % MASK_EVERY == 0]
                    network.learn(flat, hidden, squares)
                    seen += len(hidden)
            if seen:
                yield pa.RecordBatch.from_pydict({"n": pa.array([float(seen)]), "weights": pa.array([network.flat], pa.list_(pa.float32()))})

        share = (F.pmod("hash", F.lit(rounds)) == number) & (F.col("n_tokens") > 0)
        learned = encoded.table.where(share).select("chars", "ids").mapInArrow(run, "n double, weights array<float>")
        means = (learned.select("n", F.posexplode("weights").alias("place", "w")).groupBy("place")
                 .agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w")).collect())
        if means:
            weights = np.array([r["w"] for r in sorted(means)], dtype=np.float32)
    return weights


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, counts: DataFrame = None) -> tuple[list[str], np.ndarray]:
    """The words of the vocabulary and the weights, learned from all texts; `counts` is their table of
    counted(), if there is one already.

    Every text takes part in one round, by its hash. Averages are summed by Spark, one row a weight
    reaches the driver. With other partitions of `docs` the weights differ slightly. An empty table
    gives the untrained network.
    """
    if counts is None:
        counts = counted(docs, text)
    words, of_ids = frequent(counts)
    return words, learn(encode(docs, [], words, counts, text), of_ids, rounds)


def score(docs: DataFrame, words: list[str], weights: np.ndarray, keep: list[str], text: str = "text", counts: DataFrame = None) -> DataFrame:
    """The `keep` columns of every row, n_tokens, log_likelihood (natural, the sum over all tokens) and
    mean_log_likelihood. Texts without tokens, also null, have 0, 0 and null. Repeated rows have equal
    scores; other columns play no part. `counts` is the table of counted() of the corpus; without one,
    `docs` are the corpus. A word that the corpus has not is as likely as one that is met for the first time."""
    if counts is None:
        counts = counted(docs, text)
    return likelihoods(encode(docs, keep, words, counts, text), weights, counts)


def pseudo_likelihood(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The rows of score() under the network that train() learns from the same texts, which are encoded once for both."""
    counts = counted(docs, text)
    words, of_ids = frequent(counts)
    encoded = encode(docs, keep, words, counts, text)
    return likelihoods(encoded, learn(encoded, of_ids), counts)


def likelihoods(encoded: Encoded, weights: np.ndarray, counts: DataFrame) -> DataFrame:
    """The rows of score()."""
    buckets = encoded.buckets()
    logs_within = encoded.sums[buckets]
    logs_within[SIZE:] += np.log(encoded.known["n"].to_numpy() + 1.0)
    table = encoded.table.withColumn("row", F.monotonically_increasing_id())
    shared = table.sparkSession.sparkContext.broadcast((weights, buckets, logs_within))
    names = [f"c{i}" for i in range(len(encoded.keep))]
    kept = table.select(*names, "row", "n_tokens", "chars", "ids")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema[:-2]) + ", near double"

    def run(batches):
        weights, buckets, logs_within = shared.value
        network = Windows(Network(weights, SIZE))
        for batch in batches:
            *others, chars, ids = batch.columns
            for a, b in pretokens.blocks_of(chars.to_pylist()):
                flat, at, sizes, own = laid(ids.slice(a, b - a), buckets)
                each = network.log_probabilities(flat, at) + logs_within[own]
                logs, ends = np.concatenate(([0.0], np.cumsum(each))), np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in others), pa.array(logs[ends] - logs[ends - sizes])],
                                                 [*names, "row", "n_tokens", "near"])

    part = F.round(F.log(F.col("n") + 1.0) * UNIT).cast("long")
    joined = (table.select("row", F.explode("others").alias("word")).join(counts, "word")
              .groupBy("row").agg((F.sum(part) / UNIT).alias("far")))
    scored = (kept.mapInArrow(run, schema).join(joined, "row", "left")
              .withColumn("log_likelihood", F.col("near") + F.coalesce("far", F.lit(0.0))))
    return scored.select(*(F.col(n).alias(k) for n, k in zip(names, encoded.keep)), "n_tokens", "log_likelihood",
                         F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_likelihood"))
