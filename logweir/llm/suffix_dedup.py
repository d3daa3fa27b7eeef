"""Remove every byte covered by a 100-byte string that also starts earlier in the corpus.

A full suffix array sorts a suffix per byte.  Here suffixes start only at anchors: the position of the
smallest 32-byte hash in each window of 69 such hashes.  The choice depends on the window's bytes
alone, so equal 100-byte strings have an anchor at the same offset, and one byte in 36 starts a suffix.

1. A suffix's leading tokens are two fingerprints: of the 32 bytes at the anchor, and of the 168 bytes
   around it, which hold every 100-byte string with this anchor.  Splitters sampled from the suffixes
   range-partition them by these tokens; buckets are sorted and neighbours compared.  A suffix whose
   anchor bytes are alone is done.  Of suffixes with equal surroundings all but the first are repeats,
   whole.  If an anchor has several surroundings, the first suffix of each stays open.  Groups at a
   bucket's edge may go on in the next one: they are compared string by string as below.
   Equal tokens are combined in each task first, so copies and shared passages do not gather anywhere.
2. Open suffixes fetch their 168 bytes.  Those of one anchor meet in a bucket and are sorted to the
   right and to the left by multikey quicksort with common-prefix lengths; for each of the 69 offsets the
   classes of both sides say exactly which 100-byte strings are equal, and all but the first are repeats.
   An anchor with very many surroundings (a line in a third of all texts) would be one hot group: its
   suffixes are dealt out by the hash of each single 100-byte string instead.
3. Repeats are gathered per document and cut out.

Documents are ordered by doc_id, then by a hash of the text; null ids come behind all ids below 2^62.  Defined cases: null and
empty texts have 0 bytes and nothing removed; rows equal in id and text are one document, and each gets
its result; texts under 100 bytes lose nothing; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from logweir.llm.common import cut, packed, slices, unpacked

SPAN = 100
GRAM = 32
OFFSETS = SPAN - GRAM + 1
LEFT = OFFSETS - 1
WIDTH = LEFT + SPAN
BLOCK = 1 << 23  # windows of a text looked at in one go
FLUSH = 400_000  # suffixes combined in one go in a task
PER_BUCKET = 1_500_000  # suffixes a bucket should not exceed
SAMPLE_DOCS = 2_000  # documents from which splitters are taken
HOT = 4_096  # surroundings of one anchor in a bucket, above which it is split by single strings

_U = np.uint64
_MUL = 0x9E3779B97F4A7C15
_SYMBOLS = np.random.default_rng(100).integers(0, 1 << 64, 257, dtype=np.uint64)  # 256 stands for "no byte"
_UNNAMED = 1 << 62


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _joined(hashes: np.ndarray, at: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """One hash of the 32-byte hashes at several offsets."""
    out = np.zeros(len(at), np.uint64)
    for offset in offsets:
        out = _mix(out * _U(_MUL) + hashes[at + offset])
    return out


def gram_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 32-byte strings of a text with 68 places for "no byte" before it and 100 behind; and the padded text."""
    padded = np.full(len(data) + WIDTH, 256, np.int16)
    padded[LEFT:LEFT + len(data)] = data
    h = _SYMBOLS[padded]
    for step in (1, 2, 4, 8, 16):
        h = h[:-step] * _U(pow(_MUL, step, 1 << 64)) + h[step:]
    return h, padded


def anchors(hashes: np.ndarray, n: int) -> np.ndarray:
    """Positions (in the text) of the smallest hash of each window of 69; the first one if equal.

    The position is the low part of the compared value, so equal hashes fall to the first.
    """
    place = _U((1 << 24) - 1)
    found = []
    for begin in range(0, n - SPAN + 1, BLOCK):
        h = hashes[LEFT + begin:LEFT + min(begin + BLOCK + OFFSETS - 1, n - GRAM + 1)]
        low = (_mix(h) & ~place) | np.arange(len(h), dtype=np.uint64)
        for step in (1, 2, 4, 8, 16, 32, OFFSETS - 64):
            low = np.minimum(low[:-step], low[step:])
        new = np.concatenate(([True], low[1:] != low[:-1]))
        found.append((low[new] & place).astype(np.int64) + begin)
    return np.unique(np.concatenate(found))


def suffixes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions of a text, the hashes of their 32 bytes and those of the 168 bytes around."""
    data = np.frombuffer(text, np.uint8)
    hashes, _ = gram_hashes(data)
    at = anchors(hashes, len(data))
    place = at + LEFT
    own = _mix(hashes[place])
    around = _joined(hashes, place - LEFT, (0, 32, 64, 96, 128, 136))
    return at, own, around


def _identity(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """The document's number and 31 bits of its text, which tell rows of one id apart.

    A null id is numbered by 62 more bits of its text, from ``_UNNAMED`` up, so 93 bits tell such rows apart.
    """
    unnamed = F.xxhash64(F.lit("unnamed"), text).bitwiseAND(F.lit(_UNNAMED - 1)) + F.lit(_UNNAMED)
    return [F.coalesce(F.col(doc_id).cast("long"), unnamed).alias("doc"),
            F.coalesce(F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(0)).cast("int").alias("tk")]


def _pack(*columns: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(c, np.int64).tobytes() for c in columns)


def _unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    return list(np.frombuffer(blob, np.int64).reshape(columns, -1))


def _dealt(part: np.ndarray, columns: list[np.ndarray], kind: int = 0) -> Iterator[pa.RecordBatch]:
    """One row per bucket with the packed rows that go there; batches of some MB at most."""
    order = np.argsort(part, kind="stable")
    part, columns = part[order], [c[order] for c in columns]
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.array([], int)
    ends = np.append(starts[1:], len(part))
    for k in range(0, len(starts), 512):
        yield pa.RecordBatch.from_arrays([
            pa.array(part[starts[k:k + 512]].astype(np.int32)), pa.array([kind] * len(starts[k:k + 512]), pa.int32()),
            pa.array([_pack(*[c[s:e] for c in columns]) for s, e in zip(starts[k:k + 512], ends[k:k + 512])], pa.binary()),
        ], names=["part", "kind", "blob"])


_DEALT = "part int, kind int, blob binary"
FRESH, REPEATED, SPLIT = 0, 1, 2


def _texts(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        for part in slices(batch, 128):
            yield from zip(*[part.column(c).to_pylist() for c in columns])


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """True where the row, in an order sorted by the keys, is the first of its key."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def _distinct(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Suffixes (own, around, doc, at) in order, each once: rows equal in id and text bring the same ones, which repeat nothing."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = _first_of(*columns)
    return columns if new.all() else [c[new] for c in columns]


def _fingerprints(splitters: np.ndarray, buckets: int):
    """Suffixes of each text, combined per task: the first of equal tokens is dealt out, the others are repeats."""

    def flush(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        own, around, doc, at = _distinct([np.concatenate(c) for c in zip(*rows)])
        first = _first_of(own, around)
        tokens = np.empty(int(first.sum()), [("own", np.uint64), ("around", np.uint64)])
        tokens["own"], tokens["around"] = own[first], around[first]
        part = _bucket_of(splitters, tokens)
        yield from _dealt(part, [c[first].view(np.int64) for c in (own, around, doc, at)])
        rest = ~first
        if rest.any():
            part = (doc[rest].view(np.uint64) % _U(buckets)).astype(np.int64)
            yield from _dealt(part, [doc[rest], at[rest]], REPEATED)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for doc, tk, text in _texts(rows, "doc", "tk", "text"):
            data = text.encode() if text else b""
            if len(data) < SPAN:
                continue
            at, own, around = suffixes(data)
            kept.append((own, around, np.full(len(at), doc, np.int64), at.astype(np.int64) | (tk << 32)))
            n += len(at)
            if n >= FLUSH:
                yield from flush(kept)
                kept, n = [], 0
        if kept:
            yield from flush(kept)

    return batches


def _bucket_of(splitters: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Range of each token pair: splitters are compared by the first token, and where that is equal by the second."""
    if not len(splitters):
        return np.zeros(len(tokens), np.int64)
    low = np.searchsorted(splitters["own"], tokens["own"], "left")
    high = np.searchsorted(splitters["own"], tokens["own"], "right")
    out = low.astype(np.int64)
    for i in np.flatnonzero(high > low):  # only anchors that are splitters themselves
        out[i] = low[i] + np.searchsorted(splitters["around"][low[i]:high[i]], tokens["around"][i], "right")
    return out


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: sort by tokens, compare neighbours.  Gives per document the repeats and the open suffixes."""
    rows, repeats = [], []
    for batch in batches:
        for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist()):
            (rows if kind == FRESH else repeats).append(_unpack(blob, 4 if kind == FRESH else 2))
    found = [(doc, at, np.full(len(doc), REPEATED)) for doc, at in repeats]
    if rows:
        own, around, doc, at = _distinct([np.concatenate(c) for c in zip(*rows)])
        rows.clear()
        first = _first_of(own, around)
        found.append((doc[~first], at[~first], np.full(int((~first).sum()), REPEATED)))
        own, doc, at = own[first], doc[first], at[first]
        starts = np.flatnonzero(_first_of(own))
        sizes = np.diff(np.append(starts, len(own)))
        edge = np.zeros(len(starts), bool)
        edge[[0, -1]] = True
        open_ = np.repeat((sizes > 1) | edge, sizes)
        split = np.repeat((sizes > HOT) | edge, sizes)  # parts of one group in two buckets go the same way
        found.append((doc[open_], at[open_], np.where(split[open_], SPLIT, FRESH)))
    if not found:
        return
    doc, at, kind = [np.concatenate(c) for c in zip(*found)]
    order = np.lexsort((at, doc))
    doc, at, kind = doc[order], at[order], kind[order]
    starts = np.flatnonzero(_first_of(doc, at >> 32)) if len(doc) else np.array([], int)
    ends = np.append(starts[1:], len(doc))
    for k in range(0, len(starts), 4096):
        docs, tks, sure, open_ = [], [], [], []
        for begin, end in zip(starts[k:k + 4096], ends[k:k + 4096]):
            place, what = at[begin:end] & 0xFFFFFFFF, kind[begin:end]
            docs.append(doc[begin])
            tks.append(at[begin] >> 32)
            sure.append(place[what == REPEATED].tobytes() if (what == REPEATED).any() else None)
            open_.append((place << 2 | what)[what != REPEATED].tobytes() if (what != REPEATED).any() else None)
        yield pa.RecordBatch.from_arrays([
            pa.array(docs, pa.int64()), pa.array(tks, pa.int32()), pa.array(sure, pa.binary()), pa.array(open_, pa.binary()),
        ], names=["doc", "tk", "sure", "open"])


def _opened(buckets: int):
    """Open suffixes with their bytes, dealt out by anchor, or for hot anchors each 100-byte string by itself."""

    def flush(wide: list, single: list) -> Iterator[pa.RecordBatch]:
        if wide:
            own, doc, at, room = [np.concatenate(c) for c in list(zip(*wide))[:4]]
            around = np.concatenate([w[4] for w in wide])
            part = ((own >> _U(20)) % _U(buckets)).astype(np.int64)
            columns = [own.view(np.int64), doc, at, room, *np.ascontiguousarray(around).view(np.int64).T]
            yield from _dealt(part, columns, FRESH)
        if single:
            one, two, doc, at = [np.concatenate(c) for c in zip(*single)]
            order = np.lexsort((at, doc, two, one))
            one, two, doc, at = one[order], two[order], doc[order], at[order]
            first = _first_of(one, two)
            part = ((one >> _U(20)) % _U(buckets)).astype(np.int64)
            yield from _dealt(part[first], [c[first].view(np.int64) for c in (one, two, doc, at)], SPLIT)
            if not first.all():
                away = (doc[~first].view(np.uint64) % _U(buckets)).astype(np.int64)
                yield from _dealt(away, [doc[~first], at[~first]], REPEATED)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide, single, n = [], [], 0
        for doc, tk, text, marks in _texts(rows, "doc", "tk", "text", "open"):
            marked = np.frombuffer(b"".join(marks), np.int64)
            data = np.frombuffer(text.encode(), np.uint8)
            hashes, padded = gram_hashes(data)
            at = np.sort(marked[marked & 3 == FRESH] >> 2)
            if len(at):
                around = np.zeros((len(at), -(-WIDTH // 8) * 8), np.uint8)
                around[:, :WIDTH] = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[at].astype(np.uint8)
                room = np.minimum(at, LEFT) << 32 | np.minimum(len(data) - at, SPAN)
                wide.append((_mix(hashes[at + LEFT]), np.full(len(at), doc, np.int64), at | (tk << 32), room, around))
                n += len(at)
            hot = marked[marked & 3 == SPLIT] >> 2
            if len(hot):
                spread = (hot[:, None] - np.arange(OFFSETS)[None, :]).reshape(-1)
                start = np.unique(spread[(spread >= 0) & (spread + SPAN <= len(data))])
                one = _joined(hashes, start + LEFT, (0, 32, 64, 68))
                two = _joined(hashes, start + LEFT, (68, 50, 25, 0))
                single.append((one, two, np.full(len(start), doc, np.int64), start | (tk << 32)))
                n += len(start) // 8
            if n >= FLUSH // 8:
                yield from flush(wide, single)
                wide, single, n = [], [], 0
        yield from flush(wide, single)

    return batches


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Rows sorted by several key columns, one character (of 8 bytes) at a time; only ties go on to the next."""
    n = len(columns[0])
    order, group = np.arange(n), np.zeros(n, np.int64)
    tied = np.arange(n)
    for column in columns:
        if not len(tied):
            break
        rows, kin = order[tied], group[tied]
        key = column[rows]
        inner = np.lexsort((key, kin))
        rows, kin, key = rows[inner], kin[inner], key[inner]
        order[tied] = rows
        first = _first_of(kin, key)
        group[tied] = tied[np.flatnonzero(first)][np.cumsum(first) - 1]
        alone = first & np.append(first[1:], True)
        tied = tied[~alone]
    return order


def common_prefixes(rows: np.ndarray, own: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes each sorted row has in common with the one before; -1 for another anchor and for the first row."""
    out = np.full(len(order), -1, np.int64)
    for k in range(1, len(order), 20_000):
        here = slice(k, min(k + 20_000, len(order)))
        a, b = order[here], order[here.start - 1:here.stop - 1]
        other = rows[a] != rows[b]
        length = np.where(other.any(axis=1), other.argmax(axis=1), rows.shape[1])
        out[here] = np.where(own[a] == own[b], length, -1)
    return out


def _big_endian(rows: np.ndarray) -> list[np.ndarray]:
    width = -(-rows.shape[1] // 8) * 8
    wide = np.zeros((len(rows), width), np.uint8)
    wide[:, :rows.shape[1]] = rows
    return list(wide.view(">u8").astype(np.uint64).T)


def repeated_offsets(own: np.ndarray, around: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes in the order of the corpus: smallest and largest offset at which their 100-byte string came before.

    ``left`` and ``right`` say how many bytes there are on either side.  OFFSETS and -1 if there is none.
    """
    n = len(own)
    lowest, highest = np.full(n, OFFSETS), np.full(n, -1)
    behind, before = around[:, LEFT:], np.ascontiguousarray(around[:, LEFT - 1::-1])
    to_right = multikey_order([own, *_big_endian(behind)])
    to_left = multikey_order([own, *_big_endian(before)])
    right_common = common_prefixes(behind, own, to_right)
    left_common = common_prefixes(before, own, to_left)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for offset in range(OFFSETS):
        right_class[to_right] = np.cumsum(right_common < SPAN - offset)
        left_class[to_left] = np.cumsum(left_common < offset)
        there = np.flatnonzero((left >= offset) & (right >= SPAN - offset))
        if len(there) < 2:
            continue
        _, first = np.unique(right_class[there] * (n + 1) + left_class[there], return_index=True)
        again = np.ones(len(there), bool)
        again[first] = False
        hit = there[again]
        lowest[hit] = np.minimum(lowest[hit], offset)
        highest[hit] = offset
    return lowest, highest


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket of open suffixes: the spans that came before, as (doc, tk, start, end)."""
    wide, single, spans = [], [], []
    for batch in batches:
        for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist()):
            if kind == FRESH:
                wide.append(_unpack(blob, 4 + -(-WIDTH // 8)))
            elif kind == SPLIT:
                single.append(_unpack(blob, 4))
            else:
                doc, at = _unpack(blob, 2)
                spans.append((doc, at, np.full(len(doc), SPAN)))
    if wide:
        columns = [np.concatenate(c) for c in zip(*wide)]
        wide.clear()
        order = np.lexsort((columns[2], columns[1]))
        own, doc, at, room = [c[order] for c in columns[:4]]
        around = np.stack(columns[4:], axis=1)[order].view(np.uint8)[:, :WIDTH]
        lowest, highest = repeated_offsets(own, around, room >> 32, room & 0xFFFFFFFF)
        hit = highest >= 0
        spans.append((doc[hit], at[hit] - highest[hit], (SPAN + highest - lowest)[hit]))
    if single:
        one, two, doc, at = [np.concatenate(c) for c in zip(*single)]
        order = np.lexsort((at, doc, two, one))
        first = _first_of(one[order], two[order])
        again = order[~first]
        spans.append((doc[again], at[again], np.full(len(again), SPAN)))
    for doc, at, length in spans:
        start = at & 0xFFFFFFFF
        for k in range(0, len(doc), 50_000):
            here = slice(k, k + 50_000)
            yield pa.RecordBatch.from_arrays([
                pa.array(doc[here]), pa.array((at[here] >> 32).astype(np.int32)), pa.array(start[here].astype(np.int64)),
                pa.array((start + length)[here].astype(np.int64))], names=["doc", "tk", "start", "end"])


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Sorted spans, joined where they touch or overlap."""
    order = np.argsort(starts, kind="stable")
    out: list[tuple[int, int]] = []
    for s, e in zip(starts[order].tolist(), ends[order].tolist()):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def _splitters(docs: DataFrame, buckets: int, n_docs: int) -> np.ndarray:
    """Token pairs that cut the suffixes of a sample of documents into equal ranges."""
    fraction = min(1.0, SAMPLE_DOCS / max(n_docs, 1))
    none = np.empty(0, [("own", np.uint64), ("around", np.uint64)])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (text,) in _texts(rows, "text"):
            data = text.encode() if text else b""
            if len(data) >= SPAN:
                _, own, around = suffixes(data)
                yield pa.RecordBatch.from_arrays([pa.array(own[::8].view(np.int64)), pa.array(around[::8].view(np.int64))], names=["own", "around"])

    rows = (docs.select("text").sample(fraction, seed=6).mapInArrow(batches, "own long, around long")
            .limit(64 * SAMPLE_DOCS).toArrow())
    if buckets < 2 or not rows.num_rows:
        return none
    tokens = np.empty(rows.num_rows, none.dtype)
    for name in ("own", "around"):
        tokens[name] = rows.column(name).to_numpy().view(np.uint64)
    tokens = tokens[np.lexsort((tokens["around"], tokens["own"]))]
    return np.unique(tokens[np.linspace(0, len(tokens), buckets + 1).astype(int)[1:-1]])


def repeats(docs: DataFrame) -> DataFrame:
    """Repeated spans of each document that has some: doc, tk, spans (array of start, end; not merged)."""
    spark = docs.sparkSession
    slim = docs.select(*_identity(), "text")
    n_docs, n_bytes = docs.select(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // 36 // PER_BUCKET))
    splitters = _splitters(docs, buckets, n_docs)
    fresh = slim.mapInArrow(_fingerprints(splitters, buckets), _DEALT)
    marks = fresh.repartitionById(buckets, F.col("part")).mapInArrow(_compared, "doc long, tk int, sure binary, open binary")
    per_doc = cut(marks.groupBy("doc", "tk").agg(F.collect_list("sure").alias("sure"), F.collect_list("open").alias("open")))

    asked = slim.join(per_doc.filter(F.size("open") > 0).drop("sure"), ["doc", "tk"]).dropDuplicates(["doc", "tk"])
    settled = (asked.select("doc", "tk", "text", "open").mapInArrow(_opened(buckets), _DEALT)
               .repartitionById(buckets, F.col("part")).mapInArrow(_settled, "doc long, tk int, start long, end long"))
    spans = settled.groupBy("doc", "tk").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return cut(per_doc.filter(F.size("sure") > 0).select("doc", "tk", "sure").join(spans, ["doc", "tk"], "full"))


def _cut_text(text: str | None, sure: list[bytes] | None, spans: list[dict] | None) -> tuple[bytes, bytes, int]:
    """The text's bytes, those that stay, and the number of maximal removed runs."""
    data = text.encode() if text else b""
    anchor = np.frombuffer(b"".join(sure or []), np.int64)
    starts = np.concatenate((np.maximum(anchor - LEFT, 0), np.array([x["start"] for x in spans or []], np.int64)))
    ends = np.concatenate((np.minimum(anchor + SPAN, len(data)), np.array([x["end"] for x in spans or []], np.int64)))
    runs = merged(starts, ends)
    kept, at = [], 0
    for start, end in runs:
        kept.append(data[at:start])
        at = end
    kept.append(data[at:])
    return data, b"".join(kept), len(runs)


def _with_repeats(docs: DataFrame) -> DataFrame:
    """row, body, sure, spans of every row of ``docs``."""
    rows = packed(docs)
    keyed = rows.select("row", "body", *_identity("row.doc_id", "body"))
    return keyed.join(repeats(docs), ["doc", "tk"], "left").select("row", "body", "sure", "spans")


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch):
                done = [_cut_text(*x) for x in zip(*[part.column(c).to_pylist() for c in ("body", "sure", "spans")])]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(d[0]) for d in done], pa.int64()),
                    pa.array([len(d[0]) - len(d[1]) for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()),
                    pa.array([hashlib.sha256(d[1]).hexdigest() for d in done], pa.string()),
                ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _with_repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return (rows.select(F.col("row.doc_id").alias("doc_id"), "body", "sure", "spans")
            .mapInArrow(batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents without their repeated bytes, with the columns of ``docs``; every row stays.

    Where a cut goes through a character, the rest of that character goes too.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch):
                texts = part.column("body").to_pylist()
                done = [_cut_text(*x) for x in zip(texts, *[part.column(c).to_pylist() for c in ("sure", "spans")])]
                new = [None if t is None else t if n == 0 else kept.decode(errors="ignore") for t, (_, kept, n) in zip(texts, done)]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(new, pa.string())], names=["row", "body"])

    rows = _with_repeats(docs)
    return unpacked(rows.mapInArrow(batches, T.StructType([rows.schema["row"], rows.schema["body"]])), docs, text_changed=True)
