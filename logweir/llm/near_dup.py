"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A text's set is its distinct shingles of five words (lower-cased A-Z).  The sketch has 128 coordinates
and is filled in rounds: in each of the first 128 rounds every shingle is hashed to a coordinate and
leaves its value there if it is smaller; in the next 128 rounds all shingles go to one given
coordinate each.  Values of an earlier round are always smaller, so rounds end as soon as every
coordinate is filled: after one or two for usual texts, after 256 at most.  Two sets agree in a
coordinate with the probability of their Jaccard similarity, with the concentration of independent
draws.  32 bands of 4 coordinates miss a pair at 0.75 with probability 5e-6, one at 0.8 with 5e-8.

1. Texts with the same words are one class (128-bit key); the class is known by its smallest doc_id.
2. Classes in the same bucket of a band are compared to the bucket's smallest class only, never all
   with all.  Links are confirmed on the full shingle sets of the whole texts.
3. Components of confirmed links are formed.  Buckets whose classes are all in one component are done.
   Classes that meet in the others form groups, which are dealt into blocks of bounded size; for each pair
   of blocks the shingles in common of all pairs are counted at once, and links between components are
   confirmed on the words.  So every pair that shares a bucket is either compared or already in one
   component: no link between components is lost, and no pairs are emitted.

Defined cases: null, empty or white-space texts have an empty set (0 shingles) and are linked with
nothing; rows that share a doc_id are one node (a link of one is a link of all); rows with a null
doc_id take the component of the texts they equal, else null, and count as kept then; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from xxhash import xxh3_64_intdigest

from logweir.llm.common import cut, packed, slices, unpacked, words_of
from logweir.llm.components import components

SHINGLE = 5
COORDINATES = 128
BANDS = 32
ROWS = COORDINATES // BANDS
SIMILAR = 75  # per cent
BLOCK = 1_024  # classes of a group in one block
BLOCK_BYTES = 8 << 20  # and bytes of their texts
OFTEN = 48  # shingles held by more classes of a unit are counted by matrix product

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SKETCH = "doc_id long, text_key long, n_shingles long, key1 long, key2 long, buckets array<long>"


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """Distinct hashes of the shingles of one text."""
    hashes = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    if not width:
        return hashes
    n = len(words) - width + 1
    out = np.full(n, np.uint64(width))
    for i in range(width):
        out = out * _STEP + hashes[i:i + n]
        out ^= out >> np.uint64(29)
    return np.unique(_mix(out))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Sketches of several non-empty sets, one per row."""
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    sketch = np.full((len(sets), COORDINATES), _EMPTY)
    low, bin_shift = np.uint64((1 << 56) - 1), np.uint64(64 - COORDINATES.bit_length() + 1)
    for turn in range(2 * COORDINATES):
        z = _mix(flat + np.uint64((turn + 1) * int(_STEP) & (1 << 64) - 1))
        value = (np.uint64(turn) << np.uint64(56)) | (z & low)
        place = (z >> bin_shift).astype(np.int64) if turn < COORDINATES else turn - COORDINATES
        np.minimum.at(sketch.reshape(-1), owner * COORDINATES + place, value)
        unfilled = (sketch == _EMPTY).any(axis=1)
        if not unfilled.any():
            break
        if turn % 4 == 0 or turn < 4:
            here = unfilled[owner]
            flat, owner = flat[here], owner[here]
    return sketch


def buckets(sketch: np.ndarray) -> np.ndarray:
    """The bucket of each band: a hash of the band's coordinates and its number."""
    bands = sketch.reshape(len(sketch), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, bands.shape[:2]).copy()
    for i in range(ROWS):
        out = _mix(out ^ bands[:, :, i])
    return out.astype(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets, keys = [], []
            for text in part.column("text").to_pylist():
                words = [w.lower() for w in words_of(text)]
                sets.append(shingle_hashes(words))
                digest = hashlib.sha256(b" ".join(words)).digest()
                keys.append(np.frombuffer(digest[:16], dtype=np.int64))
            full = [i for i, s in enumerate(sets) if len(s)]
            rows: list = [None] * len(sets)
            if full:
                for i, found in zip(full, buckets(sketches([sets[i] for i in full]))):
                    rows[i] = found
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                pa.array(rows, pa.list_(pa.int64())),
            ], names=["doc_id", "text_key", "n_shingles", "key1", "key2", "buckets"])


def shingle_set(text: str | None) -> set:
    words = [w.lower() for w in words_of(text)]
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(SHINGLE)]))


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, last_set = None, set()
    for batch in batches:
        for part in slices(batch):
            linked = []
            for a, b in zip(part.column("text_a").to_pylist(), part.column("text_b").to_pylist()):
                if a != last:
                    last, last_set = a, shingle_set(a)
                other = shingle_set(b)
                common = len(last_set & other)
                linked.append(common > 0 and 100 * common >= SIMILAR * (len(last_set) + len(other) - common))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "linked"])


def _fits(n: str, m: str) -> Column:
    """Sets whose sizes alone do not rule the similarity out."""
    return 100 * F.least(n, m) >= SIMILAR * F.greatest(n, m)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) that are linked."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(_verify_batches, "a long, b long, linked boolean").filter("linked").select("a", "b").distinct()


def _between(open_: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that join components within the groups that buckets form: enough of them, not all.

    ``open_`` has (leader, rep, component) of the buckets that hold several components.  Classes that may meet are
    in one group.  A group is dealt into blocks of bounded size, and each pair of blocks is one unit of
    work, which counts the common shingles of all its pairs at once and gives only links between components.
    """
    groups = components(open_.select(F.col("leader").alias("a"), F.col("rep").alias("b")))
    grouped = (open_.select("rep", "component").distinct().join(groups.select(F.col("node").alias("rep"), F.col("component").alias("grp")), "rep")
               .join(texts.withColumnRenamed("doc_id", "rep"), "rep"))
    sizes = grouped.groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    dealt = (grouped.join(sizes, "grp").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    units = dealt.select("grp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "rep", "component", "text")
    return units.groupBy("grp", "lo", "hi").applyInArrow(_joined_in_unit, "a long, b long").distinct()


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Shingles in common of all pairs: shingles that many have by matrix product, others pair by pair."""
    m = len(sets)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.concatenate(([True], flat[1:] != flat[:-1]))
    shingle = np.cumsum(first) - 1
    holders = np.bincount(shingle)[shingle]
    counts = np.zeros((m, m), np.float32)
    often = holders > OFTEN
    _, column = np.unique(shingle[often], return_inverse=True)
    for start in range(0, int(column.max()) + 1 if len(column) else 0, 2048):
        here = (column >= start) & (column < start + 2048)
        x = np.zeros((m, 2048), np.float32)
        x[owner[often][here], column[here] - start] = 1
        counts += x @ x.T
    seldom = (holders > 1) & ~often
    shingle, owner = shingle[seldom], owner[seldom]
    for step in range(1, OFTEN):
        same = shingle[step:] == shingle[:-step]
        if not same.any():
            break
        a, b = owner[:-step][same], owner[step:][same]  # holders of a shingle are in order, so a < b
        both = np.bincount(a * m + b, minlength=m * m).reshape(m, m).astype(np.float32)
        counts += both + both.T
    return counts


def _joined_in_unit(unit: pa.Table) -> pa.Table:
    reps, labels, texts = (unit.column(c).to_pylist() for c in ("rep", "component", "text"))
    full = sorted(zip(reps, labels, texts), key=lambda r: r[0])
    sets = [shingle_hashes([w.lower() for w in words_of(t)]) for _, _, t in full]
    found: list[tuple[int, int]] = []
    if len(full) > 1:
        counts = common_counts(sets)
        sizes = np.array([len(x) for x in sets], np.float32)
        label = np.unique([r[1] for r in full], return_inverse=True)[1]
        near = 100 * counts >= SIMILAR * (sizes[:, None] + sizes[None, :] - counts)
        near &= (label[:, None] != label[None, :]) & (counts > 0)
        root = list(range(int(label.max()) + 1))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1)))):
            a, b = top(int(label[i])), top(int(label[j]))
            if a != b:
                one, two = shingle_set(full[i][2]), shingle_set(full[j][2])  # hashes agree; the words decide
                common = len(one & two)
                if 100 * common >= SIMILAR * (len(one) + len(two) - common):
                    root[a] = b
                    found.append((full[i][0], full[j][0]))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def classify(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per row: doc_id, text_key, n_shingles, component_id, kept; and the confirmed links between classes (a, b)."""
    slim = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    sketched = cut(slim.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "text_key").mapInArrow(_sketch_batches, _SKETCH))
    classes = (sketched.filter("n_shingles > 0").groupBy("key1", "key2")
               .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets")))
    members = classes.filter("rep IS NOT NULL").select("rep", "n", F.explode("buckets").alias("bucket"))
    shared = (members.groupBy("bucket").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"), F.min_by("n", "rep").alias("leader_n"))
              .filter("leader < last").select("bucket", "leader", "leader_n"))
    members = cut(members.join(shared, "bucket"))
    to_leader = (members.filter(F.col("rep") != F.col("leader")).filter(_fits("n", "leader_n"))
                 .select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct())
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = cut(slim.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi").distinct())

    links = cut(_verified(to_leader, texts))
    found = cut(components(links))
    placed = (members.join(found.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    mixed = (placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .filter("lo < hi").select("bucket"))
    open_ = cut(placed.join(mixed, "bucket", "left_semi").select("leader", "rep", "component").distinct())
    more = cut(_between(open_, texts))
    if not more.isEmpty():
        # Components found so far are shrunk to one node each, so only the new links are worked on.
        shrunk = (more.join(found.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
                  .join(found.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
                  .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
        joined = cut(components(shrunk)).toDF("component", "final")
        known = found.unionByName(joined.select(F.col("component").alias("node"), F.col("component"))).groupBy("node").agg(
            F.min("component").alias("component"))
        found = cut(known.join(joined, "component", "left").select("node", F.coalesce("final", "component").alias("component")))
        links = links.unionByName(more)

    labelled = (classes.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                .select("key1", "key2", F.coalesce("component", "rep").alias("class_component"), F.lit(True).alias("_class")))
    rows = sketched.join(labelled, ["key1", "key2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("class_component")).otherwise(F.col("doc_id"))
    out = rows.withColumn("component_id", component)
    return (out.select("doc_id", "text_key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")),
            links)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component, with the columns of ``docs``; of rows equal in id and text one stays."""
    kept = classify(docs)[0].filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    keyed = packed(docs).withColumn("doc_id", F.col("row.doc_id").cast("long")).withColumn("text_key", F.xxhash64("body"))
    stay = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key")), "left_semi")
    plain = [F.col("row").getField(f.name) for f in docs.schema if f.name != "text" and isinstance(f.dataType, T.AtomicType)]
    twin = Window.partitionBy("doc_id", "text_key").orderBy(*plain)
    return unpacked(stay.withColumn("twin", F.row_number().over(twin)).filter("twin = 1"), docs)


ORACLE = """
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, doc_id, s FROM (
    SELECT r, doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words)),
sizes AS (SELECT r, doc_id, count(*) AS n FROM shingles GROUP BY r, doc_id),
common AS (SELECT a.r AS ra, b.r AS rb, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM common c JOIN sizes x ON x.r = c.ra JOIN sizes y ON y.r = c.rb
          WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
either AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION
          SELECT r.node, l.b FROM reach r JOIN either l ON l.a = r.other),
least_ AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, w.doc_id = l.component_id AS kept
FROM words w JOIN least_ l ON l.node = w.doc_id LEFT JOIN sizes s USING (r)
"""
