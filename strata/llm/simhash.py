"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is built from the XXH64 hashes of a text's word shingles; texts whose
fingerprints differ in at most three bits are linked, and links are closed to components.

The fingerprint is cut into a ring of four 16-bit segments. If two fingerprints differ in at most
three bits, some segment starts a chain in which the first k segments together differ in at most
k * 3 / 4 bits: 0, 1, 2, 3. The candidate keys hold the first two steps of the chain: the starting
segment, and three of the four nibbles of the next one (with one bit of difference at most, three
nibbles agree). Candidates then walk the chain, step by step, before the full Hamming distance.

Pairs are made of distinct fingerprints only, so copies cost nothing. A key shared by more than
``GROUP_LIMIT`` distinct fingerprints makes no pairs: its fingerprints meet at points of the
Hamming cube instead. Each one visits every point within two bits of it. Any two that differ in at
most three bits share a point that is within one bit of one of them, and whoever meets a point at
two bits is within three bits of whoever meets it at one; so all visitors of a point with a near
visitor are linked to that visitor. That is exact and linear in the size of the group.

Edge cases: a null or empty text and a text of white space have fingerprint zero, linked like any
other; fewer words than a shingle make one shingle of what there is; repeated rows and rows that
share a doc_id fall into one component; a null doc_id belongs to a component without lowering its
id (a component of null ids only has a null id). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import map_arrow, stage
from strata.llm.graph import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 4
GROUP_LIMIT = 64
_BLOCK = 1 << 15  # shingles whose bits are unpacked at a time


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one UTF-8 text: bit k is set if it is set in over half the hashes."""
    words = (text or b"").lower().split()  # bytes: lower-cases A-Z only, splits at ASCII white space
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)),
                         dtype="<u8", count=len(starts))
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[k:k + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprinted(rows: DataFrame, shingle: int) -> DataFrame:
    """The columns of ``rows``, but the last one (a text as bytes) replaced by its fingerprint ``fp``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, shingle)
                               for t in batch.columns[-1]), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], names=[*batch.schema.names[:-1], "fp"])

    return map_arrow(rows, run, T.StructType([*rows.schema.fields[:-1], T.StructField("fp", T.LongType())]))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; ``fp`` is the fingerprint as a signed long."""
    return _fingerprinted(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")), shingle)


def _segment(fp: Column, k: int) -> Column:
    width = 64 // SEGMENTS
    return F.shiftrightunsigned(fp, width * (k % SEGMENTS)).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fps: DataFrame) -> DataFrame:
    """(key, fp): for each start segment and each nibble left out of the next segment."""
    fp, out = F.col("fp"), []
    for start in range(SEGMENTS):
        for nibble in range(4):
            rest = _segment(fp, start + 1).bitwiseAND(F.lit(0xFFFF & ~(0xF << (4 * nibble))))
            tag = F.lit((start * 4 + nibble) << 32)
            out.append(tag.bitwiseOR(F.shiftleft(_segment(fp, start), 16)).bitwiseOR(rest))
    return fps.select("fp", F.explode(F.array(*out)).alias("key"))


def _chain_holds(a: Column, b: Column, start: Column) -> Column:
    """Whether the chain from segment ``start`` stays within its budget at every step."""
    x = a.bitwiseXOR(b)
    differ = F.array(*[F.bit_count(_segment(x, k)) for k in range(SEGMENTS)])
    ok, total = F.lit(True), F.lit(0)
    for step in range(SEGMENTS):
        total = total + F.get(differ, (start + step) % SEGMENTS)
        ok = ok & (total * SEGMENTS <= (step + 1) * MAX_BITS)
    return ok


def _masks(bits: int) -> Column:
    """All 64-bit masks with exactly ``bits`` bits set, as an array of signed longs."""
    flips = [sum(1 << i for i in c) for c in combinations(range(64), bits)]
    return F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in flips])


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fps`` (fp) exactly as all pairs within
    ``MAX_BITS`` bits do."""
    keyed = stage(_keys(fps), "simhash-keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    small = stage(sizes.filter(F.col("n") <= GROUP_LIMIT).select("key"), "simhash-groups")
    large = stage(sizes.filter(F.col("n") > GROUP_LIMIT).select("key"), "simhash-large")
    left = keyed.join(small, "key", "left_semi")
    groups = left.groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))  # GROUP_LIMIT at most
    pairs = groups.select("key", F.posexplode("fps").alias("i", "a"), "fps").select(
        "key", "a", F.explode(F.slice("fps", F.col("i") + 2, F.lit(GROUP_LIMIT))).alias("b"))
    start = F.shiftright("key", 34).cast("int")
    near = pairs.filter(_chain_holds(F.col("a"), F.col("b"), start)).filter(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS).select("a", "b")
    return near.unionByName(_ball_links(keyed.join(large, "key", "left_semi").select("fp").distinct()))


def _ball_links(fps: DataFrame) -> DataFrame:
    """The links of fingerprints that share an over-full key, by meeting points."""
    fps = stage(fps, "simhash-dense")
    at = lambda masks: fps.select("fp", F.explode(masks).alias("m")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("point"))
    near = stage(at(F.concat(F.array(F.lit(0).cast("long")), _masks(1))), "simhash-points")
    hubs = near.groupBy("point").agg(F.min("fp").alias("hub"))
    # Far visitors of a point that has a near one. The planner does not know that the masks make thousands of
    # rows of each fingerprint and would send them all through the driver, so the join is named.
    met = near.unionByName(at(_masks(2))).join(hubs.hint("merge"), "point")
    return met.filter("fp <> hub").select(
        F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")).distinct()


def _labelled(fps: DataFrame) -> DataFrame:
    """(fp, label) of the distinct fingerprints ``fps`` (fp): the same label for all of a component."""
    labels = components(links(fps))
    return fps.join(labels, fps["fp"] == labels["node"], "left").select("fp", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``."""
    rows = stage(fingerprints(docs, key, text, shingle), "simhash")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    found = distinct.join(_labelled(distinct.select("fp")), "fp")
    ids = found.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = stage(found.join(ids, "label").select("fp", "component_id"), "simhash-components")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` per component: the one with the smallest id, a null id behind all others, and
    of rows that share that id the one with the least text hash. Rows equal in both are copies, of which
    one stays; a doc_id on texts of several components stands for each of them."""
    place = {"_s_null": F.col(key).isNull(), "_s_id": F.coalesce(F.col(key).cast("long"), F.lit(0)),
             "_s_text": F.xxhash64(text), "_s_size": F.coalesce(F.length(text), F.lit(-1))}
    rows = _fingerprinted(docs.select(*[c.alias(n) for n, c in place.items()], F.col(text).cast("binary").alias("_s_body")), shingle)
    rows = stage(rows, "simhash")
    least = F.min(F.struct(*place)).alias("first")
    distinct = stage(rows.groupBy("fp").agg(least), "simhash-distinct")
    firsts = distinct.join(_labelled(distinct.select("fp")), "fp").groupBy("label").agg(F.min("first").alias("first"))
    firsts = stage(firsts.select("first.*"), "simhash-firsts")
    own = docs.withColumns(place).join(firsts, list(place), "left_semi")
    number = F.row_number().over(Window.partitionBy(*place).orderBy(F.lit(0)))
    return own.withColumn("_s_no", number).filter("_s_no = 1").select(*[own[c] for c in docs.columns])
