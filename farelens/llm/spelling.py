"""Spelling variants: words one edit apart, by sorted permuterm rotations.

Every word is marked with a terminator and rotated to every start.  The
rotation that begins behind a character ends with that character, so words
that differ only there share the rotation up to its last character: a prefix
range.  The word without that character is in front of the same range, as a
whole rotation.  Rotations are dealt and sorted by that prefix, and a scan of
each range gives every member its neighbours' number and the best of them.

A range has one member per character of the alphabet and one word without
any, so it is small whatever the vocabulary, and no pair is written out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.common import materialize

RUN = "A-Za-z\\u00C0-\\u00FF"
MIN_LENGTH = 6
MIN_COUNT = 5
# A word's form must occur so many times as often as the word.
RATIO = 5
# One run in so many, by its hash, loses a character.
EDIT_EVERY = 199
# Marks a word's end in its rotations; words must not hold it.
END = "\u0000"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.when(text.rlike("[^\\x00-\\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def edited(word: Column, doc_id: Column, every: int | None = EDIT_EVERY) -> Column:
    """The word; without one code point if ``every`` divides the hash of id and word."""
    if every is None:
        return word
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word), "UTF-8"))
    at = F.pmod(h, F.length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(F.pmod(h, F.lit(every)) == 0, shorter).otherwise(word)


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                edit_every: int | None = EDIT_EVERY) -> DataFrame:
    """(word, n): the words of whole texts with their occurrences, from ``min_length`` and ``min_count`` on.

    A run shorter than ``min_length`` cannot become a word.  A frequent word
    is summed up in each task before the shuffle.
    """
    runs = docs.select(F.col("doc_id").alias("doc"), F.explode(
        F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{RUN}]{{{min_length},}}"), F.lit(0))).alias("run"))
    lowered = runs.select("doc", lower_ascii(F.col("run")).alias("run"))
    words = lowered.select(edited(F.col("run"), F.col("doc"), edit_every).alias("word"))
    return (words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, whole, first, word, n): all rotations, each as itself and up to its last character.

    ``first``: the character left out begins a run of equal ones; leaving out
    a later one of the run gives the same shorter word.
    """
    start = F.explode(F.sequence(F.lit(0), F.length("word")))
    turned = words.select("word", "n", start.alias("p")).select(
        "word", "n", "p", F.concat(F.substring("word", F.col("p") + 1, F.length("word")), F.lit(END),
                                   F.substring("word", F.lit(1), F.col("p"))).alias("turn"))
    last, before = F.substring("word", F.col("p"), F.lit(1)), F.substring("word", F.col("p") - 1, F.lit(1))
    begins = (F.col("p") == 1) | (last != before)
    as_whole = F.struct(F.col("turn").alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("first"))
    up_to_last = F.struct(F.substring("turn", F.lit(1), F.length("word")).alias("prefix"), F.lit(False).alias("whole"),
                          begins.alias("first"))
    both = F.when(F.col("p") == 0, F.array(as_whole)).otherwise(F.array(as_whole, up_to_last))
    return turned.select("word", "n", F.explode(both).alias("r")).select("r.prefix", "r.whole", "r.first", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): words with a near word, how many, and the most frequent of them."""
    entries = rotations(words).withColumn("entry", F.struct((-F.col("n")).alias("less"), "word"))
    # In a range: the words with a character there, most frequent first, then the word without.
    ordered = Window.partitionBy("prefix").orderBy("whole", "entry")
    group = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scanned = entries.select(
        "word", "whole", "first", F.row_number().over(ordered).alias("at"), F.count(F.lit(1)).over(group).alias("size"),
        F.count_if(F.col("first")).over(group).alias("firsts"), F.first("entry").over(group).alias("top"),
        F.nth_value("entry", 2).over(group).alias("second"), F.last("entry").over(group).alias("end"),
        F.last("whole").over(group).alias("shorter")).filter("size > 1")
    shorter = F.col("shorter").cast("int")
    near = F.when(F.col("whole"), F.col("firsts")).otherwise(
        F.col("size") - 1 - shorter + F.when(F.col("first"), shorter).otherwise(F.lit(0)))
    # ``end`` is the word without the character if the range has one, else a member that is never before ``second``.
    best = F.when(F.col("whole"), F.col("top")).when(F.col("at") == 1, F.least("second", "end")).otherwise(
        F.when(F.col("shorter"), F.least("top", "end")).otherwise(F.col("top")))
    return (scanned.select("word", near.alias("near"), best.alias("best"))
            .groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
            .filter("n_near > 0")
            .select("word", "n_near", F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form: the end of its chain of forms.

    Each round follows every word's end to that one's own end, so a chain of
    length m takes log2(m) rounds.  A chain is short: each form is ``RATIO``
    times as frequent as the word before it.
    """
    ends = materialize(forms.select("word", F.col("form").alias("root")), "spelling_ends")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(ends.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling_ends")
        ends = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return ends


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """The near words of every word and the form it is grouped under.

    ``words`` has distinct words (word, n); other columns are not read, rows
    with a NULL or empty word are dropped.  Returns word, form, root, n,
    n_near, form_n.  Two words are near if one code point inserted, deleted
    or replaced makes them equal.  ``form`` is the near word of largest n
    (ties: smallest in code-point order) if that is at least ``ratio`` times
    the word's n, else NULL; ``root`` ends the chain of forms (the word itself
    if it has none).  An empty table gives no rows.  A word of length m makes
    2 m + 1 rows of length m in the shuffle.
    """
    words = materialize(words.filter("word <> ''").select("word", F.col("n").cast("long").alias("n")), "spelling_words")
    found = materialize(neighbours(words), "spelling_near")
    known = words.join(found, "word", "left")
    wins = F.col("form_n") >= F.col("n") * ratio
    known = materialize(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(wins, F.col("form")).alias("form"), F.when(wins, F.col("form_n")).alias("form_n")),
                        "spelling_forms")
    return known.join(roots(known.filter("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                    ratio: int = RATIO, edit_every: int | None = EDIT_EVERY) -> DataFrame:
    """``spelling_variants`` of the words of whole texts.

    ``docs`` has doc_id and text; other columns are not read.  A NULL or
    empty text has no words; a NULL doc_id counts as an empty one in the hash
    that edits runs.  Repeated rows count again.  A text's runs are held
    together, however long it is.  ``edit_every=None`` edits no run.
    """
    return spelling_variants(count_words(docs, min_length, min_count, edit_every), ratio)


SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hexed AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM counted),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT,
                                 list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                     lambda c, b: xor(c >> 8, t[((xor(c, b)) & 255) + 1])), 4294967295::BIGINT)::BIGINT AS h
  FROM hexed, crc_table),
results AS (
  SELECT n, CASE WHEN h % {EDIT_EVERY} = 0
                 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= {MIN_LENGTH} GROUP BY word
          HAVING sum(n) >= {MIN_COUNT}),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
ranked AS (SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
                  row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN other_n >= {RATIO} * words.n THEN other END AS form,
         CASE WHEN other_n >= {RATIO} * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN ranked ON words.word = ranked.word AND place = 1),
chain AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT chain.word, forms.form, step + 1 FROM chain JOIN forms ON chain.root = forms.word WHERE forms.form IS NOT NULL)
SELECT forms.word, form, ends.root, forms.n, n_near, form_n
FROM forms JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) ends ON forms.word = ends.word"""
