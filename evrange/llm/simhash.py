"""SimHash near-duplicates, found through Golay-code keys.

Two 64-bit fingerprints that differ in at most four bits are found without comparing all
pairs. The bits form three segments of 22, 21 and 21. The perfect Golay code has one code
word within three bits of any 23-bit word; the words within four bits are one or six, and
two segments that differ in at most two bits always have one of them in common (the code
word next to the word half way between). With at most four errors in three segments,

* either a segment has none, and of the other two one has at most two: the key is the first
  segment whole, with a code word of the second;
* or every segment has one at least, so one has at most two and the others one each, which
  leaves half of each of those whole: the key is the two halves, with a code word of the third.

That makes 6 and 12 kinds of keys, some 95 keys a fingerprint, of 33 or 34 bits; whoever
shares a key is compared bit by bit.
"""

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from evrange.llm import components
from evrange.llm.common import col, fresh, giving_back, staged

MAX_BITS = 4
SHIFT, WIDTH = (0, 22, 43), (22, 21, 21)
#: Generator polynomial of the Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (fixed value).
GOLAY = 0b110001110101
BUCKET = 4096           # members of a key that are compared in one go; more are compared in tiles
_BLOCK = 8192           # shingles whose bits are counted in one go


# --- fingerprints

def fingerprint(text: str | None, shingle: int) -> int:
    """A bit is set if it is set in over half of the XXH64 (seed 42) values of the shingles."""
    import xxhash
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = np.array([digest(joined, 42)], np.uint64)
    else:
        spans = zip(starts[:n].tolist(), ends[shingle - 1:].tolist())
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        bits = np.unpackbits(hashes[i:i + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, shingle: int, keep: list, text: str = "text") -> DataFrame:
    """The `keep` columns and `fp`, a signed 64-bit fingerprint of the whole text."""
    kept = docs.select(*keep)
    names = [f"c{i}" for i in range(len(kept.columns))]
    table = docs.select(*(c.alias(n) for c, n in zip(keep, names)), col(text).alias("t"))
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kept.schema))

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps, pa.int64())], [*names, "fp"])

    return table.mapInArrow(giving_back(run), f"{schema}, fp long").toDF(*kept.columns, "fp")


# --- keys

def _syndrome(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GOLAY << (bit - 11)
    return word


_tables = None


def _golay():
    """Syndromes of the low 12 and the high 11 bits; for each syndrome the error patterns of
    at most four bits, six places filled up with the first."""
    global _tables
    if _tables is None:
        low = np.array([_syndrome(w) for w in range(1 << 12)])
        high = np.array([_syndrome(w << 12) for w in range(1 << 11)])
        errors = [[] for _ in range(1 << 11)]
        for weight in range(5):
            for bits in combinations(range(23), weight):
                pattern = sum(1 << b for b in bits)
                errors[low[pattern & 4095] ^ high[pattern >> 12]].append(pattern)
        _tables = low, high, np.array([e + e[:1] * (6 - len(e)) for e in errors]), np.array([len(e) for e in errors])
    return _tables


def code_words(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (12 bits) of the code words within four bits of each word, and which of the six are there."""
    low, high, errors, count = _golay()
    syndrome = low[words & 4095] ^ high[words >> 12]
    return (words[:, None] ^ errors[syndrome]) >> 11, np.arange(6) < count[syndrome][:, None]


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (key, fingerprint) rows of an array of fingerprints."""
    u = fps.view(np.uint64)
    segments = [(u >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in zip(SHIFT, WIDTH)]
    coded = [code_words(s) for s in segments]
    out_keys, out_fps = [], []

    def add(tag, exact, k):
        index, there = coded[k]
        all_keys = (tag << 34 | exact)[:, None] | index << 22
        out_keys.append(all_keys[there])
        out_fps.append(np.broadcast_to(fps[:, None], there.shape)[there])

    tag = 0
    for i, k in product(range(3), range(3)):
        if i != k:
            add(tag, segments[i], k)
            tag += 1
    for k in range(3):
        i, j = (x for x in range(3) if x != k)
        for high_i, high_j in product((0, 11), (0, 11)):
            add(tag, (segments[i] >> high_i & 2047) << 11 | segments[j] >> high_j & 2047, k)
            tag += 1
    return np.concatenate(out_keys), np.concatenate(out_fps)


# --- links

def _forest(members: np.ndarray, bits: int) -> list[tuple[np.ndarray, int]]:
    """For ascending distinct members: (those reachable, the smallest), for each component of two or more."""
    found, rest = [], members
    while len(rest) > 1:
        root, rest, queue, reached = rest[0], rest[1:], [rest[0]], []
        while queue and len(rest):
            near = np.bitwise_count((rest ^ queue.pop()).view(np.uint64)) <= bits
            if near.any():
                reached.append(rest[near])
                queue.extend(rest[near])
                rest = rest[~near]
        if reached:
            found.append((np.concatenate(reached), root))
    return found


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("tile", pa.int64())])


def _links(found) -> pa.RecordBatch:
    a = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.int64)
    b = np.concatenate([np.full(len(x), r) for x, r in found]) if found else a
    nulls = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), nulls, nulls], schema=_LINKS)


def _crowd(key, members, at) -> pa.RecordBatch:
    n = len(members)
    return pa.RecordBatch.from_arrays(
        [pa.array(members, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, key), pa.int64()),
         pa.array((at + np.arange(n)) // BUCKET, pa.int64())], schema=_LINKS)


def _scan(bits):
    """Over rows sorted by (key, fp): links between the members of a key, or, where a key has
    more than BUCKET members, the members themselves with the number of their tile."""
    def run(batches):
        held_key, held, passed = None, np.empty(0, np.int64), 0   # the key that may go on in the next batch
        for batch in batches:
            key, fp = (np.asarray(c) for c in batch.columns)
            if not len(key):
                continue
            found = []
            edges = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(key)]))
            if key[0] == held_key:
                held = np.concatenate((held, fp[:ends[0]]))
                starts, ends = starts[1:], ends[1:]
            if len(held) and (len(starts) or passed or len(held) > BUCKET):
                if passed or len(held) > BUCKET:
                    yield _crowd(held_key, held, passed)
                    passed, held = passed + len(held), held[:0]
                else:
                    found += _forest(held, bits)
            if len(starts):
                sizes = ends - starts
                twos = starts[:-1][sizes[:-1] == 2]
                near = twos[np.bitwise_count((fp[twos] ^ fp[twos + 1]).view(np.uint64)) <= bits]
                found += [(fp[near + 1][i:i + 1], fp[near[i]]) for i in range(len(near))]
                for s, e in zip(starts[:-1][sizes[:-1] > 2], ends[:-1][sizes[:-1] > 2]):
                    if e - s > BUCKET:
                        yield _crowd(key[s], fp[s:e], 0)
                    else:
                        found += _forest(fp[s:e], bits)
                held_key, held, passed = key[-1], fp[starts[-1]:].copy(), 0
            yield _links(found)
        if passed and len(held):
            yield _crowd(held_key, held, passed)
        elif len(held) > 1:
            yield _links(_forest(held, bits))
    return run


def links(fps: DataFrame, bits: int) -> DataFrame:
    """(a, b): pairs of distinct fingerprints of the column `fp` that differ in at most `bits`
    bits, enough of them to connect all that such pairs connect."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"the keys find up to {MAX_BITS} differing bits")

    def emit(batches):
        for batch in batches:
            values = np.asarray(batch.column(0))
            for i in range(0, len(values), 4096):
                k, f = keys(values[i:i + 4096])
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(f)], ["key", "fp"])

    rows = (fps.select("fp").mapInArrow(giving_back(emit), "key long, fp long")
            .repartition("key").sortWithinPartitions("key", "fp"))
    scanned = staged(rows.mapInArrow(giving_back(_scan(bits)), "a long, b long, key long, tile long"))
    near = scanned.where("key IS NULL").select("a", "b")
    crowded = scanned.where("key IS NOT NULL")
    if crowded.isEmpty():
        return near

    tiles = staged(crowded.groupBy("key").agg(F.max("tile").alias("last")))
    dealt = (crowded.join(tiles, "key")
             .select("key", "tile", F.col("a").alias("fp"), F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("other"))
             .select("key", "fp", F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y")))

    def compare(group):
        found = _forest(np.unique(group["fp"].to_numpy()), bits)
        import pandas as pd
        return pd.DataFrame({"a": np.concatenate([x for x, _ in found] or [np.empty(0, np.int64)]),
                             "b": np.concatenate([np.full(len(x), r) for x, r in found] or [np.empty(0, np.int64)])})

    return near.unionAll(dealt.groupBy("key", "x", "y").applyInPandas(compare, "a long, b long"))


def classes(fps: DataFrame, bits: int) -> DataFrame:
    """(fp, root): each distinct fingerprint and the least one that links lead to."""
    distinct = staged(fps.select("fp").distinct())
    found = components.stars(links(distinct, bits))
    return staged(distinct.join(found, distinct.fp == found.u, "left")
                  .select("fp", F.coalesce("v", "fp").alias("root")))


def near_duplicates(docs: DataFrame, shingle: int, bits: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs`.

    Words are what ASCII white space separates, with A-Z in lower case. A text of fewer words
    than `shingle` is one shingle; one without words, also null, has the fingerprint zero,
    which links like any other. component_id is the smallest doc_id that links reach, null
    where only rows without doc_id are reached. Repeated rows keep their rows; other columns
    of `docs` play no part. An empty table gives an empty table.
    """
    marked = staged(fingerprints(docs, shingle, [col(doc_id).alias("doc_id")], text))
    groups = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = classes(groups, bits)
    least = staged(roots.join(groups, "fp").groupBy("root").agg(F.min("first").alias("component_id")))
    named = staged(roots.join(least, "root").select("fp", "component_id"))
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int, bits: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each class of near-duplicates: that of the smallest doc_id (rows
    without one come last; of rows with equal doc_id, a fixed one by the hash of all columns).
    Rows that are equal in all columns count once. The columns stay as they are."""
    (row,) = fresh(docs, "row_hash")
    hashed = docs.withColumn(row, F.xxhash64(*map(col, docs.columns)))
    order = F.struct(col(doc_id).isNull().alias("z"), col(doc_id).alias("i"), col(row).alias("h"))
    marked = staged(fingerprints(hashed, shingle, [order.alias("o")], text))
    groups = staged(marked.groupBy("fp").agg(F.min("o").alias("first")))
    roots = classes(groups, bits)
    kept = staged(roots.join(groups, "fp").groupBy("root").agg(F.min("first").alias("o")).select("o"))
    rows = marked.groupBy("o").agg(F.count("*").alias("n"))
    wanted = rows.join(kept, "o", "left_semi")
    keep = staged(wanted.select(F.col("o.i").alias("keep_id"), F.col("o.h").alias("keep_hash"), (F.col("n") > 1).alias("again")))
    on = lambda side: (col(doc_id).eqNullSafe(side["keep_id"])) & (col(row) == side["keep_hash"])
    once, again = keep.where("NOT again"), keep.where("again")
    out = hashed.join(once, on(once), "left_semi").drop(row)
    if again.isEmpty():
        return out
    return out.unionAll(hashed.join(again, on(again), "left_semi").drop(row).dropDuplicates())
