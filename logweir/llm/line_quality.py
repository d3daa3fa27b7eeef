"""Quality rules from the frequency of lines across documents, in DataFrame functions only.

Base rules look at one text: too few words, or too many words inside 8-word windows that the text
repeats.  The method proper looks across documents: every line is normalised (a-z lower case, white
space collapsed, digits as 0) and hashed; the documents of each host (``source``) that hold it are
counted; a line is boilerplate on a host when at least ``min_docs`` documents and at least
``min_share`` of the host's documents hold it.  A document is rejected when less than ``min_left`` of its
words remain without such lines; ``kept_documents`` gives the texts of the others without them.

Copies must not turn honest text into boilerplate.  Documents with the same text count once.  Documents
that have next to nothing of their own (less than one part in ``OWN_PARTS`` of their words
stands in lines below the limits) are near copies of each other, as 5-word shingles in common to three quarters leave no more than a
seventh to each; they do not count either.  So a template is boilerplate, however many lines it has, once
enough documents hold it beside text of their own, and is then removed from all documents of the host.

Counting is aggregations with map-side combination (distinct (host, line, text), then lines), so a line in
a third of all documents is counted in parts.  The lines above the limits go back to the documents over a
salted join: ``SALT`` copies of each limit row, so one hot line is spread evenly.

Defined cases: a null or empty text has no words and fails the base rule; null sources are one host;
repeated doc_ids are judged by their own text (verdicts are joined on id and text hash); lines without
a word are no lines; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logweir.llm.common import SPACE, WORD, cut, packed, unpacked, word_count

MIN_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
MIN_DOCS = 10
MIN_SHARE = 0.01
OWN_PARTS = 7  # a text of its own has at least one part in so many outside frequent lines
MIN_LEFT = 0.5
SALT = 64


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _paired(a: Column, shift: int) -> Column:
    """Hash of each element with the one ``shift`` places on; shorter by ``shift``."""
    n = F.size(a) - shift
    return F.zip_with(F.slice(a, F.lit(1), F.greatest(n, F.lit(0))), F.slice(a, F.lit(shift + 1), F.greatest(n, F.lit(0))),
                      lambda x, y: F.xxhash64(x, y))


def _by_hash(windows: Column) -> Column:
    """Windows with their starts, sorted by hash; none if all hashes differ."""
    rows = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), rows)


def _repeated_starts(rows: Column) -> Column:
    """Starts of windows whose hash is also their neighbour's, in order of the text."""
    n = F.size(rows) - 1
    pairs = F.zip_with(F.slice(rows, F.lit(1), n), F.slice(rows, F.lit(2), n),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))


def _covered(starts: Column) -> Column:
    """Words that lie in a window of these starts."""
    merged = F.aggregate(
        starts, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct((i + WINDOW).alias("end"),
                                (acc["n"] + WINDOW - F.greatest(acc["end"] - i, F.lit(0))).cast("long").alias("n")))
    return F.coalesce(merged["n"], F.lit(0).cast("long"))


KEY = ("doc_id", "host", "text_key")


def _identity(doc_id: str = "doc_id", source: str = "source", text: str = "text") -> list[Column]:
    return [F.col(doc_id).alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("host"),
            F.xxhash64(text).alias("text_key")]


def base(docs: DataFrame) -> DataFrame:
    """The counts of one text each: doc_id, host, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    first = docs.select(
        *_identity(),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("_lines"),
        F.transform(_words(text), lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    counted = first.select(
        *KEY, "word_chars", "n_symbols", F.size("_hashes").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _paired(F.col("_hashes"), 1).alias("_two"),
    )
    eight = (counted.withColumn("_four", _paired(F.col("_two"), 2)).drop("_two")
             .withColumn("_eight", _paired(F.col("_four"), 4)).drop("_four"))
    starts = (eight.withColumn("_sorted", _by_hash(F.col("_eight"))).drop("_eight")
              .withColumn("_starts", _repeated_starts(F.col("_sorted"))).drop("_sorted"))
    return (starts.withColumn("n_repeat_words", _covered(F.col("_starts"))).drop("_starts")
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))))


def normalised(line: Column) -> Column:
    lower = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
    return F.btrim(F.regexp_replace(lower, SPACE, " "), F.lit(" "))


def lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: the document's key, pos (among all its lines), line (hash), n_words, total (words of the text)."""
    placed = F.transform(F.split("text", "\n"), lambda x, i: F.struct(normalised(x).alias("x"), i.alias("pos")))
    listed = docs.select(*_identity(), F.filter(placed, lambda line: line["x"] != "").alias("_lines"))
    hashed = listed.select(*KEY, F.transform("_lines", lambda line: F.struct(
        F.xxhash64(line["x"]).alias("h"), word_count(line["x"]).alias("n"), line["pos"].alias("pos"))).alias("_lines"))
    total = F.aggregate("_lines", F.lit(0).cast("long"), lambda n, line: n + line["n"])
    each = hashed.select(*KEY, total.alias("total"), F.explode("_lines").alias("_line"))
    return each.select(*KEY, F.col("_line.pos").alias("pos"), F.col("_line.h").alias("line"), F.col("_line.n").alias("n_words"), "total")


def frequent_lines(per_line: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """Lines that enough distinct texts of a host hold: host, line, least (how many are enough)."""
    held = per_line.select("host", "line", "text_key").distinct().groupBy("host", "line").agg(F.count("*").alias("n_texts"))
    hosts = per_line.select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("host_texts"))
    often = held.filter(F.col("n_texts") >= min_docs).join(hosts, "host")
    least = F.greatest(F.lit(min_docs), F.ceil(F.col("host_texts") * F.lit(min_share)))
    return often.withColumn("least", least).filter("n_texts >= least").select("host", "line", "least")


def _salted(limits: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """The rows on the lines of ``limits``, with the columns of both; a hot line is dealt over ``SALT`` tasks."""
    dealt = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALT)).cast("int"))
    return salted.join(dealt, ["host", "line", "salt"]).select(*columns)


def boilerplate(marked: DataFrame) -> DataFrame:
    """Lines that enough documents hold beside text of their own: host, line.  ``marked`` are the rows of frequent lines."""
    once = marked.select("host", "text_key", "pos", "line", "n_words", "total", "least").distinct()
    shared = once.groupBy("host", "text_key").agg(F.sum("n_words").alias("shared"), F.max("total").alias("total"))
    own = shared.filter(OWN_PARTS * (F.col("total") - F.col("shared")) >= F.col("total")).select("host", "text_key")
    held = once.select("host", "text_key", "line", "least").distinct().join(own, ["host", "text_key"], "left_semi")
    counted = held.groupBy("host", "line", "least").agg(F.count("*").alias("n_docs"))
    return counted.filter("n_docs >= least").select("host", "line")


def removable(docs: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """Boilerplate lines of each document that has some: the document's key, n_removed (their words), gone (their places).

    Rows repeated in the whole key have their lines added up together: each line's position then comes
    as often as the row does, and the sum is divided by that.
    """
    per_line = cut(lines(docs))
    marked = cut(_salted(frequent_lines(per_line, min_docs, min_share), per_line, *KEY, "pos", "line", "n_words", "total", "least"))
    places = F.collect_set("pos")
    once = F.size(places) / F.count("*")
    return (_salted(cut(boilerplate(marked)), marked, *KEY, "pos", "n_words").groupBy(*KEY)
            .agg(F.round(F.sum("n_words") * once).cast("long").alias("n_removed"), F.sort_array(places).alias("gone")))


def _judged(docs: DataFrame, min_docs: int, min_share: float, min_left: float) -> DataFrame:
    """As ``judge``, with ``gone``, the places of the lines to remove (null if there are none)."""
    measured, gone = base(docs), removable(docs, min_docs, min_share)
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"g.{c}")) for c in KEY]
    joined = (measured.alias("m").join(gone.alias("g"), same, "left")
              .select("m.*", F.coalesce("g.n_removed", F.lit(0)).cast("long").alias("n_boilerplate_words"), "g.gone"))
    depleted = (F.col("n_words") - F.col("n_boilerplate_words")) < min_left * F.col("n_words")
    return joined.withColumn("kept", ~F.col("base_failed") & ~depleted)


def judge(docs: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """The base counts, n_boilerplate_words (what line removal takes away) and the verdict ``kept``, per row."""
    return _judged(docs, min_docs, min_share, min_left).drop("gone")


def _without(lines: Column, gone: Column) -> Column:
    """The lines at the other places, as one text again."""
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, without their boilerplate lines, with the columns of ``docs``; ``n_chars`` follows."""
    # Verdicts are written first: a filter on them would be pushed down and take the array expressions apart,
    # each evaluated anew inside the other.
    verdicts = cut(_judged(docs, MIN_DOCS, MIN_SHARE, MIN_LEFT).select(*KEY, "kept", "gone"))
    passed = verdicts.filter("kept").select(*[F.col(c).alias(f"p_{c}") for c in KEY], "gone").distinct()
    rows = packed(docs)
    keyed = rows.select("row", "body", *_identity("row.doc_id", "row.source", "body"))
    same = [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in KEY]
    # The lines are mentioned twice behind this, so they stay a column of their own and are not split anew for each.
    parted = keyed.join(passed, same).select("row", "body", "gone", F.when(F.col("gone").isNotNull(), F.split("body", "\n")).alias("_lines"))
    body = F.when(F.col("gone").isNull(), F.col("body")).otherwise(_without(F.col("_lines"), F.col("gone")))
    return unpacked(parted.select("row", body.alias("body")), docs, text_changed=True)


ORACLE = f"""
WITH texts AS (SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text,
                      row_number() OVER () AS r FROM documents),
words AS (SELECT r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
                 generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM texts),
windows AS (SELECT r, i, string_agg(w, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS x,
                   count(*) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS n FROM words),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows WHERE n = {WINDOW}),
near AS (SELECT w.r, w.i, max(t.i) OVER (PARTITION BY w.r ORDER BY w.i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last
         FROM words w LEFT JOIN (SELECT r, i FROM twice WHERE n > 1) t ON w.r = t.r AND w.i = t.i),
repeats AS (SELECT r, count(*) AS n FROM near WHERE i - last < {WINDOW} GROUP BY r),
raw AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
lines AS (SELECT r, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
                                        '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line FROM raw),
full_lines AS (SELECT l.r, t.host, t.text, l.line, len(regexp_extract_all(l.line, '[^\\x20\\x09-\\x0D]+')) AS n
               FROM lines l JOIN texts t USING (r) WHERE l.line <> ''),
hosts AS (SELECT host, greatest({MIN_DOCS}, ceil(count(DISTINCT text) * {MIN_SHARE})) AS least FROM full_lines GROUP BY host),
frequent AS (SELECT f.host, f.line, h.least FROM full_lines f JOIN hosts h USING (host) GROUP BY f.host, f.line, h.least
             HAVING count(DISTINCT f.text) >= h.least),
own AS (SELECT f.r FROM full_lines f LEFT JOIN frequent q ON q.host = f.host AND q.line = f.line GROUP BY f.r
        HAVING {OWN_PARTS} * coalesce(sum(f.n) FILTER (q.line IS NULL), 0) >= sum(f.n)),
limits AS (SELECT f.host, f.line FROM full_lines f JOIN own USING (r) JOIN frequent q ON q.host = f.host AND q.line = f.line
           GROUP BY f.host, f.line, q.least HAVING count(DISTINCT f.text) >= q.least),
gone AS (SELECT f.r, sum(f.n) AS n FROM full_lines f JOIN limits USING (host, line) GROUP BY f.r),
counts AS (
  SELECT t.r, t.doc_id, len(regexp_extract_all(t.text, '[^\x20\x09-\x0D]+')) AS n_words,
         length(regexp_replace(t.text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t.text) - length(translate(t.text, '#*$%&|<>', '')) AS n_symbols,
         coalesce(d.n, 0) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words, coalesce(g.n, 0) AS n_gone
  FROM texts t LEFT JOIN dups d USING (r) LEFT JOIN repeats p USING (r) LEFT JOIN gone g USING (r)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       CAST(n_gone AS BIGINT) AS n_boilerplate_words, NOT base_failed AND n_words - n_gone >= {MIN_LEFT} * n_words AS kept
FROM judged
"""
