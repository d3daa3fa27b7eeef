"""Phrase collocations, counted over a prefix-free parse of the corpus.

A text is a row of words and marks (one between pieces).  A window of three of them is a trigger when its
hash says so; a text is cut into chunks that run from the first word of one trigger to the last of the
next, so chunks overlap by one trigger.  Cuts depend on content alone: a passage that occurs often gives
the same chunks everywhere, and the parse of the corpus is a dictionary of distinct chunks with how often
each occurs.  n-grams are counted inside the distinct chunks, weighted.  An n-gram belongs to the chunk
in which it starts before the closing trigger, so what lies in an overlap is counted once; no n-gram of
up to four words reaches beyond that trigger.

A phrase occurs at most as often as its parts, so pairs are only counted where both words may be frequent,
and phrases of three and four words where all their pairs may be.  That is looked up in bitmaps of fixed
size over the frequent words and pairs: a full bitmap lets more through and never less, and the counts
themselves are exact.

Defined cases: null and empty texts and texts without words add nothing; a null lang is ``und``; rows
are counted as they come, whatever their ids and however often they repeat; ties are ordered by score,
count, then phrase in byte order; very long texts are whole (a text without triggers is one chunk); an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh3_64_intdigest

from logweir.llm.common import slices, stored

TRIGGER = 3  # words and marks in a trigger: one less than the longest phrase
LONGEST = TRIGGER + 1
EVERY = 32  # one window in so many is a trigger
BITS = 1 << 26  # of the bitmap: 8 MB
PARSED_BYTES = 8 << 20  # text that is parsed, or chunks that are counted, at once
MARK = b"\n"
ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal(text: str) -> bytes:
    """Words of all pieces, lower-cased A-Z, with one mark between pieces that have words, all joined by one space."""
    pieces = map(bytes.split, text.encode().lower().translate(ENDS).split(MARK))
    return (b" " + MARK + b" ").join([b" ".join(p) for p in pieces if p])


class Words:
    """The words and marks of some normal texts, one after the other, as numbers."""

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern(texts, " ")
        self.sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.known = coded.dictionary
        values = self.known.to_pylist()
        hashes = np.fromiter(map(xxh3_64_intdigest, values), np.uint64, len(values))
        self.hashed = hashes[self.ids] if values else np.zeros(0, np.uint64)
        self.lengths = pc.binary_length(self.known).to_numpy().astype(np.int64)[self.ids] if values else np.zeros(0, np.int64)
        mark = MARK.decode()
        self.no_mark = self.ids != (values.index(mark) if mark in values else -1)


def chunks(texts: list[str | None], langs: list[str | None]) -> dict[tuple[str, bytes, bool], int]:
    """How often (lang, chunk, whether a text ends with it) occurs in the parse of some texts."""
    found: dict[tuple[str, bytes, bool], int] = {}
    normals = [(n, lang or "und") for t, lang in zip(texts, langs) if t and (n := normal(t))]
    if not normals:
        return found
    words = Words(pa.array([n for n, _ in normals], pa.binary()).cast(pa.string()))
    window = np.zeros(max(words.ids.size - TRIGGER + 1, 0), np.uint64)
    for k in range(TRIGGER):
        window = _mix(window + words.hashed[k:k + window.size] + _STEP)
    opens = np.flatnonzero(window % np.uint64(EVERY) == 0)
    ends = np.cumsum(words.lengths + 1)  # of each word and the space behind it, over all texts
    first = np.cumsum(words.sizes) - words.sizes
    for (text, lang), at, n in zip(normals, first.tolist(), words.sizes.tolist()):
        lo, hi = np.searchsorted(opens, (at, at + n - TRIGGER + 1))
        before = int(ends[at - 1]) if at else 0
        inner = opens[lo:hi][opens[lo:hi] > at]
        starts = [0, *(ends[inner - 1] - before).tolist()]
        stops = [*(ends[inner + TRIGGER - 1] - before - 1).tolist(), len(text)]
        for k, (start, stop) in enumerate(zip(starts, stops)):
            key = (lang, text[start:stop], k == inner.size)
            found[key] = found.get(key, 0) + 1
    return found


def dictionary(docs: DataFrame) -> DataFrame:
    """lang, chunk, final, times: the distinct chunks of the parse, written to the shared folder."""
    slim = docs.select(F.col("lang").cast("string").alias("_lang"), F.col("text").alias("_text"))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, batch.num_rows, PARSED_BYTES):
                found = chunks(part.column("_text").to_pylist(), part.column("_lang").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.binary()).cast(pa.string()),
                     pa.array([k[2] for k in found], pa.bool_()), pa.array(list(found.values()), pa.int64())],
                    names=["lang", "chunk", "final", "times"])

    parts = slim.mapInArrow(batches, "lang string, chunk string, final boolean, times long")
    return stored(parts.groupBy("lang", "chunk", "final").agg(F.sum("times").alias("times")), "parse")


class Grams:
    """The n-grams of some distinct chunks, level by level, by exact numbers."""

    def __init__(self, langs: pa.Array, texts: pa.Array, final: np.ndarray, times: np.ndarray):
        words = Words(texts)
        self.ids, self.known, self.hashed, self.no_mark = words.ids, words.known, words.hashed, words.no_mark
        row = np.repeat(np.arange(words.sizes.size), words.sizes)
        self.stop = np.cumsum(words.sizes)[row]
        tongues = langs.dictionary_encode()
        self.names = tongues.dictionary
        of_row = tongues.indices.to_numpy().astype(np.int64)
        self.lang = of_row[row]
        lang_hash = np.fromiter(map(xxh3_64_intdigest, self.names.to_pylist()), np.uint64, len(self.names))
        self.start_hash = lang_hash[self.lang]
        self.times = times[row]
        self.span = max(len(self.known), 1)
        # A word that starts inside the closing trigger is the next chunk's; marks start nothing.
        owned = np.arange(row.size) < np.where(final[row], self.stop, self.stop - TRIGGER)
        self.at = np.flatnonzero(owned & self.no_mark)
        self.key = self.lang[self.at] * self.span + self.ids[self.at]
        self.n = 1

    @staticmethod
    def _small(key: np.ndarray) -> np.ndarray:
        return np.unique(key, return_inverse=True)[1].astype(np.int64)

    def hash(self, at: np.ndarray, n: int) -> np.ndarray:
        """Hash of the lang and the n words from each position."""
        h = self.start_hash[at]
        for k in range(n):
            h = _mix(h + self.hashed[at + k] + _STEP)
        return h

    def may_be_frequent(self, at: np.ndarray, n: int, bitmap: np.ndarray) -> np.ndarray:
        slot = self.hash(at, n) % np.uint64(BITS)
        return (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def longer(self, bitmap: np.ndarray, known: int) -> None:
        """From n to n + 1 words: those whose parts of ``known`` words the bitmap may know."""
        at, n = self.at, self.n
        fits = at + n < self.stop[at]
        at, key = at[fits], self.key[fits]
        goes_on = self.no_mark[at + n]
        at, key = at[goes_on], key[goes_on]
        # Parts that do not end with the new word were looked up on the way to n words, unless they are as long.
        for part in range(0 if known == n else n + 1 - known, n + 2 - known):
            maybe = self.may_be_frequent(at + part, known, bitmap)
            at, key = at[maybe], key[maybe]
        self.at, self.n = at, n + 1
        self.key = self._small(key * self.span + self.ids[at + n])

    def totals(self) -> pa.RecordBatch:
        """lang, phrase, a of the distinct n-grams here; for single words also one row per lang with phrase ''."""
        if not self.at.size:
            return pa.RecordBatch.from_pylist([], pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64())]))
        cells = int(self.key.max()) + 1
        if cells <= 8 * self.key.size:  # small numbers index the counts themselves
            counts, places = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
            np.add.at(counts, self.key, self.times[self.at])
            places[self.key] = np.arange(self.key.size)
            found = np.flatnonzero(counts)
            a, first = counts[found], places[found]
        else:
            _, first, of = np.unique(self.key, return_index=True, return_inverse=True)
            a = np.zeros(first.size, np.int64)
            np.add.at(a, of, self.times[self.at])
        starts = self.at[first]
        langs = self.lang[starts]
        parts = [self.known.take(pa.array(self.ids[starts + k])) for k in range(self.n)]
        phrases = parts[0] if self.n == 1 else pc.binary_join_element_wise(*parts, " ")
        if self.n == 1:
            tongues = np.unique(langs)
            every = [int(a[langs == lang].sum()) for lang in tongues]
            phrases = pa.concat_arrays([phrases, pa.array([""] * len(every), pa.string())])
            a, langs = np.append(a, every), np.append(langs, tongues)
        return pa.RecordBatch.from_arrays([self.names.take(pa.array(langs)), phrases, pa.array(a)], names=["lang", "phrase", "a"])


def phrase_counts(parse: DataFrame, bitmaps: list, longest: int) -> DataFrame:
    """lang, phrase, a: exact counts of the phrases of one word more than there are bitmaps, and on to ``longest`` words.

    Left out are only phrases with a part that no bitmap knows.
    """
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [np.frombuffer(b.value, np.uint8) for b in bitmaps]
        for batch in rows:
            for part in slices(batch, batch.num_rows, PARSED_BYTES):
                grams = Grams(part.column("lang"), part.column("chunk"),
                              part.column("final").to_numpy(zero_copy_only=False), part.column("times").to_numpy())
                for words, bitmap in enumerate(known, 1):
                    grams.longer(bitmap, words)
                yield grams.totals()
                while grams.n < longest:
                    grams.longer(known[-1], len(known))
                    yield grams.totals()

    found = parse.select("lang", "chunk", "final", "times").mapInArrow(batches, "lang string, phrase string, a long")
    return found.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def bitmap_of(frequent: DataFrame) -> bytes:
    """One bit per phrase, by its hash.  At most BITS / 64 numbers come to the driver."""
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            grams = Grams(batch.column("lang"), batch.column("phrase"), np.ones(batch.num_rows, bool), np.ones(batch.num_rows, np.int64))
            sizes = pc.count_substring(batch.column("phrase"), " ").to_numpy(zero_copy_only=False).astype(np.int64) + 1
            n = int(sizes[0]) if batch.num_rows else 1  # all phrases of a level have as many words
            slot = grams.hash(np.cumsum(sizes) - sizes, n) % np.uint64(BITS)
            places, of = np.unique(slot >> np.uint64(6), return_inverse=True)
            bits = np.zeros(places.size, np.uint64)
            np.bitwise_or.at(bits, of, np.uint64(1) << (slot & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int64)), pa.array(bits.view(np.int64))], names=["place", "bits"])

    parts = frequent.select("lang", "phrase").mapInArrow(batches, "place long, bits long")
    rows = parts.groupBy("place").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    bitmap = np.zeros(BITS // 64, np.int64)
    bitmap[rows.column("place").to_numpy()] = rows.column("bits").to_numpy()
    return bitmap.tobytes()


def frequent_phrases(docs: DataFrame, least: int = 30) -> DataFrame:
    """lang, phrase, a, words: all phrases of 1 to 4 words that occur ``least`` times; phrase '' counts a lang's words."""
    spark = docs.sparkSession
    parse = dictionary(docs)
    bitmaps: list = []
    levels = []
    for n, longest in ((1, 1), (2, 2), (3, LONGEST)):
        counts = phrase_counts(parse, bitmaps, longest).filter((F.col("a") >= least) | (F.col("phrase") == ""))
        levels.append(stored(counts.withColumn("words", F.size(F.split("phrase", " "))), f"phrases{n}"))
        if n == longest:
            bitmaps.append(spark.sparkContext.broadcast(bitmap_of(levels[-1].filter("phrase <> ''"))))
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def _words(start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, n), " ")


def collocations(docs: DataFrame, least: int = 30, top: int = 2_000, share: int = 80) -> DataFrame:
    """The first ``top`` phrases of each lang: lang, rank, phrase, a, l, r, n, score."""
    phrases = frequent_phrases(docs, least)
    named = phrases.filter("phrase <> ''")
    candidates = named.filter("words > 1")

    # Parts of a candidate occur at least as often, so they are among the frequent phrases.
    cuts = (candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .withColumn("left", _words(1, F.col("k"))).withColumn("right", _words(F.col("k") + 1, F.col("words") - F.col("k"))))
    count_of = named.select(F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("a").alias("part_a"))
    for side in ("left", "right"):
        cuts = (cuts.join(count_of, (F.col("lang") == F.col("part_lang")) & (F.col(side) == F.col("part")))
                .withColumn(side[0], F.col("part_a")).drop("part_lang", "part", "part_a"))
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # Every phrase inside a longer one, with how often the most frequent longer one occurs.
    inner = (candidates.filter("words > 2")
             .select("lang", "a", "phrase", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
             .select("lang", "a", "phrase", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
             .select("lang", "a", _words(F.col("at"), F.col("size")).alias("inside"))
             .groupBy(F.col("lang").alias("in_lang"), "inside").agg(F.max("a").alias("longer_a")))
    free = (lowest.join(inner, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inside")), "left")
            .filter(F.col("longer_a").isNull() | (_exact("longer_a") * 100 < _exact("a") * share)))

    totals = phrases.filter("phrase = ''").select(F.col("lang").alias("n_lang"), F.col("a").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # The limit on the rank is pushed below the shuffle: each task hands on a lang's first rows only.
    ranked = (free.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
              .withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top))
    return ranked.join(totals, F.col("lang") == F.col("n_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH words AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL)),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
placed AS MATERIALIZED (
  SELECT lang, r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM (SELECT lang, w, row_number() OVER () AS r FROM words)),
rows_ AS (
  SELECT lang, x AS x1, lead(x, 1) OVER s AS x2, lead(x, 2) OVER s AS x3, lead(x, 3) OVER s AS x4 FROM placed WINDOW s AS (PARTITION BY r ORDER BY i)),
f AS MATERIALIZED (
  SELECT lang, x1 AS phrase, 1 AS k, count(*) AS a FROM rows_ GROUP BY ALL HAVING count(*) >= 30 UNION ALL
  SELECT lang, concat_ws(' ', x1, x2), 2, count(*) FROM rows_ WHERE x2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30 UNION ALL
  SELECT lang, concat_ws(' ', x1, x2, x3), 3, count(*) FROM rows_ WHERE x3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30 UNION ALL
  SELECT lang, concat_ws(' ', x1, x2, x3, x4), 4, count(*) FROM rows_ WHERE x4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
halves AS MATERIALIZED (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS p, array_to_string(w[j + 1:], ' ') AS q
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM f WHERE k > 1)),
cuts AS (
  SELECT h.lang, h.phrase, h.a, j, x.a AS l, y.a AS r, (2000000::HUGEINT * h.a) // (x.a + y.a) AS score
  FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.p JOIN f y ON y.lang = h.lang AND y.phrase = h.q),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT lang, a, k, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS s FROM f WHERE k > 2))
  GROUP BY 1, 2),
ranked AS (
  SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, o.phrase) AS rank, o.phrase, a, l, r, score
  FROM lowest o LEFT JOIN inside i ON i.lang = o.lang AND i.phrase = o.phrase
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
