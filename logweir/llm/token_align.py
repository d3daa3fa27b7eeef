"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Both tokenizers cut the same bytes (a space and the text).  Where a token of each ends at the same byte
is a shared cut.  An interval of tokens is split at a shared cut near its middle: the end of the middle
token of A, or the nearest one around it, that bisection finds among the ends of B; both halves are
worked on in the same way.  An interval without a shared cut inside is a leaf: one group of tokens that
cover the same bytes.  All intervals of one depth, of all texts of a block, are split in one step.

Within a group every pair of tokens that share a byte is a link.  How often two ids are linked over the
whole corpus says which tokens of the vocabularies stand for each other (``vocabulary_links``).

1. Texts are encoded and aligned in blocks of bounded size; a block keeps its distinct id pairs with
   counts and, packed, which document holds which pair how often.  Blocks are written to shared storage.
2. Counts of a pair are summed over the blocks, and each B id's highest count is found.
3. Each block gets the counts of its own pairs back (one row per block and pair, so a pair that every
   text holds is no hot key) and sums them for its documents.

Defined cases: null and empty texts, and texts whose tokens do not give back exactly space + text (a
vocabulary that normalises), have no tokens: zeros, no groups and an empty digest; rows that share a
doc_id are rows of their own, and repeated rows count each time; ties for a highest count are all best;
very long texts are encoded in pieces cut where neither tokenizer can join (between a letter and a
space before a letter), which gives the same tokens; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from logweir.llm.bpe import byte_symbols
from logweir.llm.common import slices, stored

BLOCK_BYTES = 3 << 20  # text of one block; a longer text is a block of its own
BLOCK_ROWS = 20_000
PIECE = 1 << 18  # characters of a very long text that are encoded at once
PROBE = 2  # how far around the middle is looked first; four times as far after every miss

# Fixed value: how the byte-level vocabulary cuts text before merging.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BETWEEN_WORDS = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


class Pair:
    """Tokenizer A (byte-level BPE, JSON file) and tokenizer B (sentencepiece model)."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as file:
            content = json.load(file)
        special = {t["content"] for t in content["added_tokens"]}
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in content["model"]["vocab"].items() if token not in special}
        self.a = tiktoken.Encoding("A", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.size_b = self.b.get_piece_size()
        entries = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(entries)]
        self.length_a = np.zeros(max(ranks.values()) + 1, np.int64)
        self.length_a[list(ranks.values())] = [len(t) for t in ranks]
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # A piece that goes on over a space would let B join words; then long texts are not cut.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in entries)
        self.digits = _digits(max(len(self.length_a), self.size_b))

    def pieces(self, text: str) -> list[str]:
        """The text in pieces; the space at each cut is left out, as both encoders put one before."""
        out, start = [], 0
        while self.cuttable and len(text) - start > 2 * PIECE and (found := BETWEEN_WORDS.search(text, start + PIECE)):
            out.append(text[start:found.start()])
            start = found.end()
        return [*out, text[start:]]

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        a, b = self.ids(text)
        return a.tolist(), b

    def ids(self, text: str | None) -> tuple[np.ndarray, list[int]]:
        """The ids of A and of B; none where their bytes are not those of space + text.

        A's tokens are stretches of the text in their order, so they are all of it if their lengths add up.
        """
        none = np.zeros(0, np.uint32), []
        if not text:
            return none
        raw, pieces = b" " + text.encode(), self.pieces(text)
        found = self.b.encode(pieces, num_threads=1)
        b = found[0] if len(found) == 1 else list(chain.from_iterable(found))
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return none
        each = [self.a.encode_to_numpy(" " + piece, disallowed_special=()) for piece in pieces]
        a = each[0] if len(each) == 1 else np.concatenate(each)
        return (a, b) if self.length_a[a].sum() == len(raw) else none


def _digits(n: int) -> np.ndarray:
    """The decimal digits of 0 to n - 1 as bytes, padded with zero bytes."""
    return np.array([str(i).encode() for i in range(n)], dtype="S7").view(np.uint8).reshape(n, 7)


_loaded: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    """Loaded once per Python process."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Pair(path_a, path_b)
    return _loaded[path_a, path_b]


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Indices into ``ends_a`` of the tokens at whose end a group ends, ascending.

    ``ends_a`` and ``ends_b`` ascend over all texts.  ``first`` and ``last`` give the first and the last
    token of A of each text; the ends of texts are shared cuts.
    """
    cuts = [last]
    lo, hi = first, last  # tokens lo..hi; whether an end before hi is shared is not known yet
    while lo.size:
        inside = hi > lo
        lo, hi = lo[inside], hi[inside]
        middle = (lo + hi - 1) // 2
        ends = ends_a[middle]
        shared = ends_b[np.searchsorted(ends_b, ends)] == ends  # most middles are cuts themselves
        at = np.where(shared, middle, -1)
        open_, reach = np.flatnonzero(~shared & (hi - lo > 1)), PROBE
        while open_.size:
            left = np.maximum(lo[open_], middle[open_] - reach + 1)
            right = np.minimum(hi[open_] - 1, middle[open_] + reach - 1)
            width = right - left + 1
            of = np.repeat(np.arange(open_.size), width)
            tried = np.arange(of.size) - np.repeat(np.cumsum(width) - width - left, width)
            ends = ends_a[tried]
            hit = ends_b[np.searchsorted(ends_b, ends)] == ends
            of, tried = of[hit], tried[hit]
            far = np.abs(tried - middle[open_[of]])
            order = np.lexsort((far, of))
            nearest = order[np.r_[True, of[order][1:] != of[order][:-1]]] if order.size else order
            at[open_[of[nearest]]] = tried[nearest]
            all_seen = (left == lo[open_]) & (right == hi[open_] - 1)
            open_ = open_[(at[open_] < 0) & ~all_seen]
            reach *= 4
        split = at >= 0
        cuts.append(at[split])
        # Halves side by side: searches for ascending ends are quicker.
        lo, hi = (np.stack(halves, axis=1).ravel() for halves in ((lo[split], at[split] + 1), (at[split], hi[split])))
    return np.sort(np.concatenate(cuts))


class Block:
    """The tokens of some texts, aligned."""

    def __init__(self, pair: Pair, texts: list[str | None]):
        encoded = [pair.ids(t) for t in texts]
        self.n_a = np.array([len(a) for a, _ in encoded], np.int64)
        self.n_b = np.array([len(b) for _, b in encoded], np.int64)
        self.a = np.concatenate([np.zeros(0, np.int64), *(a for a, _ in encoded)], dtype=np.int64)
        self.b = np.fromiter(chain.from_iterable(b for _, b in encoded), np.int64, int(self.n_b.sum()))
        self.pair = pair
        ends_a, ends_b = np.cumsum(pair.length_a[self.a]), np.cumsum(pair.length_b[self.b])
        stop, some = np.cumsum(self.n_a), self.n_a > 0
        self.cuts_a = shared_cuts(ends_a, ends_b, (stop - self.n_a)[some], stop[some] - 1)
        self.cuts_b = np.searchsorted(ends_b, ends_a[self.cuts_a])
        self.ends_a, self.ends_b = ends_a, ends_b
        self.doc_of_a = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_groups = np.bincount(self.doc_of_a[self.cuts_a], minlength=len(texts))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Document and id pair (a * size of B + b) of every link.

        Within a group no ends are shared, so every end of either side closes one stretch of bytes that one
        token of A and one of B share; the last two ends of the group close the same.
        """
        inner_b = np.ones(self.b.size, bool)
        inner_b[self.cuts_b] = False
        ends = np.concatenate([self.ends_a, self.ends_b[inner_b]])
        ends.sort(kind="stable")
        in_a = np.searchsorted(self.ends_a, ends)
        in_b = np.searchsorted(self.ends_b, ends)
        return self.doc_of_a[in_a], self.a[in_a] * self.pair.size_b + self.b[in_b]

    def groups(self) -> list[list[dict[str, list[int]]]]:
        """The groups of each text."""
        out: list[list[dict[str, list[int]]]] = [[] for _ in self.n_a]
        a0 = b0 = 0
        for a1, b1 in zip((self.cuts_a + 1).tolist(), (self.cuts_b + 1).tolist()):
            out[self.doc_of_a[a0]].append({"a": self.a[a0:a1].tolist(), "b": self.b[b0:b1].tolist()})
            a0, b0 = a1, b1
        return out

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        n_a, n_b = self.a.size, self.b.size
        last_a, last_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
        last_a[self.cuts_a], last_b[self.cuts_b] = True, True
        group_a = np.cumsum(last_a) - last_a  # group of each token
        group_b = np.cumsum(last_b) - last_b
        until_b = np.r_[0, self.cuts_b + 1]  # tokens of B before each group
        place_a = np.arange(n_a) + until_b[group_a]
        place_b = np.arange(n_b) + self.cuts_a[group_b] + 1
        ids = np.empty(n_a + n_b, np.int64)
        mark = np.empty(n_a + n_b, np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        mark[place_a] = np.where(last_a, ord("|"), ord(","))
        mark[place_b] = np.where(last_b, ord(";"), ord(","))
        shown = np.empty((ids.size, 8), np.uint8)
        shown[:, :7] = self.pair.digits[ids]
        shown[:, 7] = mark
        present = shown != 0
        text = memoryview(shown[present].tobytes())
        stops = np.r_[0, np.cumsum(present.sum(axis=1))][np.r_[0, np.cumsum(self.n_a + self.n_b)]].tolist()
        return [hashlib.sha256(text[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(stops, stops[1:])]


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys as differences, and counts, by byte planes, compressed."""
    both = np.stack([np.diff(keys, prepend=0), counts]).astype("<u8")
    return zstandard.ZstdCompressor(level=3).compress(both.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    steps, counts = np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").reshape(2, -1).astype(np.int64)
    return np.cumsum(steps), counts


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and ``groups``: of each text its groups in order, with the ids of A and of B that cover the same bytes."""
    slim = docs.select("doc_id", F.col("text").alias("_text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    groups = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        for batch in rows:
            for part in slices(batch, 256, 1 << 19):
                block = Block(pair, part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(block.groups(), groups)], names=["doc_id", "groups"])

    return slim.mapInArrow(batches, f"doc_id {kind}, groups array<struct<a: array<int>, b: array<int>>>")


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per block: its documents with counts and digests, its id pairs with counts, and who holds which.

    Written to the shared folder, so block numbers stay and texts are encoded once.
    """
    slim = docs.select("doc_id", F.col("text").alias("_text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    counted = ("n_a", "n_b", "n_groups", "n_links")
    schema = (f"docs array<struct<doc_id: {kind}, {', '.join(f'{c}: bigint' for c in counted)}, groups_sha256: string>>, "
              "pairs array<bigint>, counts array<bigint>, held binary")

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        for batch in rows:
            for part in slices(batch, BLOCK_ROWS, BLOCK_BYTES):
                block = Block(pair, part.column("_text").to_pylist())
                doc, ids = block.links()
                pairs, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
                held = _packed(*np.unique(doc * max(pairs.size, 1) + place, return_counts=True))
                numbers = (block.n_a, block.n_b, block.n_groups, block.n_a + block.n_b - block.n_groups)
                found = pa.StructArray.from_arrays(
                    [part.column("doc_id"), *(pa.array(n, pa.int64()) for n in numbers), pa.array(block.digests(), pa.string())],
                    names=["doc_id", *counted, "groups_sha256"])
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found), pa.array([pairs.tolist()], pa.list_(pa.int64())),
                     pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([held], pa.binary())],
                    names=["docs", "pairs", "counts", "held"])

    blocks = slim.mapInArrow(batches, schema)
    return stored(blocks.select(F.monotonically_increasing_id().alias("block"), "*"), "aligned_blocks")


def vocabulary_links(blocks: DataFrame, size_b: int) -> DataFrame:
    """pair, a_id, b_id, n (links that hold the pair, over all blocks), best (no pair of this B id has more)."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.pairs", "p.counts")
    totals = stored(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n"))
                    .withColumn("b_id", F.col("pair") % size_b), "vocabulary_links")
    highest = totals.groupBy("b_id").agg(F.max("n").alias("most"))
    return totals.join(highest, "b_id").select(
        "pair", F.expr(f"pair div {size_b}").alias("a_id"), "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def measures(blocks: DataFrame, links: DataFrame) -> DataFrame:
    """Of each document its counts, n_best and count_sum over its links, and the digest of its groups."""
    asked = blocks.select("block", F.explode("pairs").alias("pair"))
    answers = asked.join(links.select("pair", "n", "best"), "pair").select("block", "pair", "n", "best")
    fields = blocks.schema["docs"].dataType.elementType.fields
    out = T.StructType([*fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def summed(block: pa.Table, weights: pa.Table) -> pa.Table:
        docs = block.column("docs").combine_chunks().flatten()
        keys, times = _unpacked(block.column("held")[0].as_py())
        order = np.argsort(weights.column("pair").to_numpy())
        n, best = (weights.column(c).to_numpy()[order] for c in ("n", "best"))
        doc, place = np.divmod(keys, max(n.size, 1))
        n_best, count_sum = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        np.add.at(n_best, doc, times * best[place].astype(np.int64))
        np.add.at(count_sum, doc, times * n[place])
        return pa.Table.from_arrays([*docs.flatten(), pa.array(n_best), pa.array(count_sum)], names=out.fieldNames())

    slim = blocks.select(F.col("block").alias("own"), "docs", "held")
    return slim.groupBy("own").cogroup(answers.groupBy("block")).applyInArrow(summed, out)


def digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    blocks = aligned_blocks(docs, path_a, path_b)
    return measures(blocks, vocabulary_links(blocks, size_b)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
