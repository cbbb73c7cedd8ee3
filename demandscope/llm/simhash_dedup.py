"""Near duplicates by SimHash with deletion-variant signatures.

Fingerprints that differ in at most two of 64 bits agree, up to one bit, in one of two 32-bit segments (three segments would be
needed for one to agree whole). Each distinct fingerprint is indexed under its two segments and under the 64 variants that have one bit of a segment
wiped out; an equality join over these signatures brings every such pair together, and the remaining distance is verified:

* same whole segment: the other one may differ in two bits;
* same variant, and the wiped bit differs: the other one may differ in one bit.

Each signature's members stream by in sorted order. They are linked through lookups of their few possible partners, and a spanning
forest goes out, never all pairs. Groups above ``STREAMED`` members are not held by a task: they go out and are looked up by
an equality join over the whole fingerprint, which deals even one huge group to all tasks.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, finished, made, materialize, slices, table
from .components import components

SHINGLE = 3
SEED = 42
SEGMENT = 32
WHOLE = SEGMENT  # the place that stands for no wiped bit
STREAMED = 8192
PAIRWISE = 48

_ONE = [1 << i for i in range(SEGMENT)]
#: Differences of the other segment that still link.
NEAR1 = np.array([0, *_ONE], dtype=np.uint64)
NEAR2 = np.array([0, *_ONE, *(a | b for i, a in enumerate(_ONE) for b in _ONE[:i])], dtype=np.uint64)
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(data: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of the shingles of a text's lower-cased words; bytes.split() cuts at exactly the ASCII white space."""
    words = data.lower().split()
    if len(words) < size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return [digest(join(x), SEED) for x in zip(*(words[k:] for k in range(size)), strict=False)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprint of each group of consecutive hashes: bits set in over half of them. A group without hashes gives 0.

    Eight bits are counted at once in the byte lanes of a 64-bit sum, over runs of up to 255 hashes.
    """
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full]
    runs = -(-n // 255)
    group = np.repeat(np.arange(len(full)), runs)
    nth = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    starts = np.repeat(np.cumsum(n) - n, runs) + nth * 255
    first = np.cumsum(runs) - runs
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, starts)
        sums = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(len(group), 8).astype(np.int64), first, axis=0)
        for lane in range(8):
            out[full] |= (2 * sums[:, lane] > n).astype(np.uint64) << np.uint64(8 * lane + k)
    return out


def fingerprints(texts: list[bytes | None]) -> np.ndarray:
    hashes, counts = array("Q"), np.zeros(len(texts), dtype=np.int64)
    for i, x in enumerate(texts):
        if x:
            got = shingle_hashes(x)
            hashes.extend(got)
            counts[i] = len(got)
    return majority(np.frombuffer(hashes, dtype=np.uint64) if hashes else np.zeros(0, np.uint64), counts)


def _print_batches(batches):
    for b in slices(batches, "text"):
        got = fingerprints(b.column(1).cast(pa.binary()).to_pylist())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got.view(np.int64)), b.column(2)], names=["doc_id", "fp", "text_key"])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, text_key): the fingerprint as a signed long and a 64-bit key of the text; a null text is like an empty one."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    return arrow(rows, _print_batches, f"doc_id {kind}, fp long, text_key long")


def signatures(fps: DataFrame) -> DataFrame:
    """(sig, fp): 66 rows a fingerprint; sig holds segment, wiped place and what is left of the segment."""
    places = F.sequence(F.lit(0), F.lit(WHOLE))

    def of(segment):
        value = F.expr("fp & 4294967295") if segment == 0 else F.expr(f"shiftrightunsigned(fp, {SEGMENT})")
        wiped = lambda i: F.when(i == WHOLE, value).otherwise(value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
        return F.transform(places, lambda i: wiped(i) + F.call_function("shiftleft", (i + 64 * segment).cast("long"), F.lit(SEGMENT)))

    return fps.select(F.explode(F.concat(of(0), of(1))).alias("sig"), "fp")


def _parts(sig: int, fps: np.ndarray):
    """The other segment of each member, its wiped bit, and the differences that link."""
    segment, place = divmod(sig >> SEGMENT, 64)
    low, high = fps & np.uint64(0xFFFFFFFF), fps >> np.uint64(SEGMENT)
    own, other = (low, high) if segment == 0 else (high, low)
    bit = np.zeros(len(fps), dtype=np.uint64) if place == WHOLE else (own >> np.uint64(place)) & np.uint64(1)
    return other, bit, place, NEAR2 if place == WHOLE else NEAR1


def _pairs(sig: int, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of members within reach of each other, each pair once."""
    other, bit, place, near = _parts(sig, fps)
    if len(fps) <= PAIRWISE:
        apart = np.bitwise_count(other[:, None] ^ other[None, :])
        ok = (apart <= (2 if place == WHOLE else 1)) & ((bit[:, None] != bit[None, :]) if place != WHOLE else True)
        return np.nonzero(np.triu(ok, 1))
    flip = np.uint64(0 if place == WHOLE else 1) << np.uint64(SEGMENT)
    full = other | (bit << np.uint64(SEGMENT))
    order = np.argsort(full, kind="stable")
    keys = full[order]
    left, right = [], []
    for mask in near:
        want = full ^ (mask | flip)
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        hit = np.flatnonzero((keys[at] == want) & (full < want))
        left.append(hit)
        right.append(order[at[hit]])
    return np.concatenate(left), np.concatenate(right)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each member's component."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _link_batches(batches):
    """Sorted (sig, fp) to (sig, a, b): a spanning forest of each group, or a null b for each member of a streamed group."""
    sig, held, streaming = None, [], False
    out: list[tuple] = []

    def close():
        if streaming or sig is None:
            return
        fps = np.concatenate(held)
        if len(fps) > 1:
            a, b = _pairs(sig, fps)
            if len(a):
                root = _forest(len(fps), a, b)
                tied = np.flatnonzero(root != np.arange(len(fps)))
                out.append((np.full(len(tied), sig), fps[tied].view(np.int64), fps[root[tied]].view(np.int64)))

    def flush():
        if out:
            cols = [np.concatenate(x) for x in zip(*((s, a, b if b is not None else np.zeros(len(a), np.int64)) for s, a, b in out), strict=True)]
            none = np.concatenate([np.full(len(a), b is None) for _, a, b in out])
            out.clear()
            yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2], mask=none)], names=["sig", "a", "b"])

    for batch in batches:
        sigs, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        if not len(sigs):
            continue
        cuts = np.flatnonzero(np.diff(sigs)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(sigs)]])
        # a group that neither starts nor ends here can go at once if it has one member
        for k in np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(sigs))):
            lo, hi = starts[k], ends[k]
            if sigs[lo] != sig:
                close()
                sig, held, streaming = int(sigs[lo]), [], False
            held.append(fps[lo:hi].copy())
            if streaming or sum(map(len, held)) > STREAMED:
                streaming = True
                out.append((np.full(sum(map(len, held)), sig), np.concatenate(held).view(np.int64), None))
                held = []
        yield from flush()
    close()
    yield from flush()


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) to links (a, b) that join exactly the fingerprints reachable over steps of two bits or fewer."""
    # a few narrow partitions become 66 times as many rows: dealt out before, by number, so that adaptive execution doesn't join them again
    spread = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), fps.sparkSession.sparkContext.defaultParallelism)
    found = arrow(signatures(fps.repartition(spread)).repartition("sig").sortWithinPartitions("sig", "fp"), _link_batches, "sig long, a long, b long")
    found = materialize(found, "simhash-links")
    large = found.where("b IS NULL").select("sig", F.col("a").alias("fp"))
    segment = F.expr(f"shiftrightunsigned(sig, {SEGMENT}) div 64")
    place = F.expr(f"shiftrightunsigned(sig, {SEGMENT}) % 64")
    masks = lambda near: F.array(*[F.lit(int(x)) for x in near if x]).cast("array<long>")
    # the partner differs by a mask in the other segment, and by the wiped bit in its own
    other = lambda m: F.when(segment == 0, F.call_function("shiftleft", m, F.lit(SEGMENT))).otherwise(m)
    wiped = F.when(place == WHOLE, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), (place + F.when(segment == 0, 0).otherwise(SEGMENT)).cast("int")))
    reach = F.when(place == WHOLE, masks(NEAR2)).otherwise(F.concat(F.array(F.lit(0).cast("long")), masks(NEAR1)))
    asked = large.select("sig", F.col("fp").alias("a"), F.explode(reach).alias("m")).select("sig", "a", F.col("a").bitwiseXOR(other(F.col("m"))).bitwiseXOR(wiped).alias("fp"))
    met = asked.join(large, ["sig", "fp"]).where("a < fp").select("a", F.col("fp").alias("b"))
    return found.where("b IS NOT NULL").select("a", "b").union(met)


def group(prints: DataFrame) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint of a materialized (doc_id, fp, ...): the smallest doc_id reachable."""
    begun = made()
    firsts = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    tied = components(links(firsts.select("fp")), "simhash-components")
    roots = firsts.join(tied.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    return finished(roots.join(ids, "root").select("fp", "root", "component_id"), "simhash-groups", begun)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Returns doc_id, fingerprint (16 hex digits), component_id: one row for each row of ``docs`` (doc_id, text used).

    Null, empty and blank texts have fingerprint zero and are linked like any other; null ids are skipped as the smallest id
    (component_id is null where a component has no other); repeated rows stay; an empty table gives an empty table; other columns
    are ignored. Long texts are taken whole.
    """
    prints = materialize(with_fingerprints(docs).drop("text_key"), "simhash-prints")
    found = prints.join(group(prints), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest doc_id (null last); all its columns stay.

    Of rows with the same id in a component the one with the smallest text key stays; of rows that agree in both any one, once.
    """
    prints = materialize(with_fingerprints(docs), "simhash-prints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    best = prints.join(group(prints).select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("best"))
    none = {"none": F.col("best.none"), "id": F.coalesce("best.doc_id", F.lit(0)), "key": F.col("best.text_key")}
    stay = best.select(*[v.alias(f"__stay_{k}") for k, v in none.items()])
    marked = docs.withColumns({"__stay_none": F.col("doc_id").isNull(), "__stay_id": F.coalesce("doc_id", F.lit(0)), "__stay_key": F.xxhash64(F.coalesce("text", F.lit("")))})
    on = [f"__stay_{k}" for k in none]
    return marked.join(stay, on, "left_semi").dropDuplicates(on).drop(*on)


def op7_simhash_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))

