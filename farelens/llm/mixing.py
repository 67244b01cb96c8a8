"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Every document is cut into blocks of at most ``block_words`` words.
2. Each source's target in words gives its whole passes over the source and
   a remainder; the remainder takes blocks in a keyed random order until it
   is used up, the last one cut to fit.  That fixes an exact number of drawn
   blocks (the quota) per source.
3. The quotas are split among the output shards by a binary tree: at every
   node the left half's share of each source is drawn from the multivariate
   hypergeometric distribution, so shard sizes and source quotas both come
   out exactly, as if all drawn blocks had been dealt from one shuffled deck.
4. A shard takes the disjoint range of each source's permuted blocks that its
   quota names, and orders its blocks by a keyed hash.  ``mixed_documents``
   writes the drawn blocks so.

Everything that grows with the documents stays in Spark; only one row per
source (at most ``max_sources``, else an error) reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from farelens.llm.common import few_files, materialize, may_have, word_count

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
CAP = 2.0
BLOCK_WORDS = 256
SHARDS = 16
# Buckets of the permuted order within a source; running sums are taken
# inside a bucket and shifted by the sums of earlier buckets.
BUCKETS = 1024
MAX_SOURCES = 1_000_000
# Repeats of one row that meet its text in one task.
SAME_ROWS = 4096
# numpy draws hypergeometric numbers exactly below this population.
_EXACT_POPULATION = 10**9


@dataclass
class Mix:
    sizes: DataFrame    # uid, tag, rep, doc_id, source, size, source_size, target
    draws: DataFrame    # one row per drawn block: uid, tag, rep, doc_id, block, copy, words, shard, draw_key
    targets: DataFrame  # one row per source
    n_shards: int


def source_targets(sized: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
                   cap: float = CAP) -> DataFrame:
    """One row per source: source_id, source, source_size, weight, target, from rows (source, size, same).

    Sources are weighed by code point order (NULL last), the weights repeating.
    Excess over a cap is reshared by weight; the end of that is the water
    level L with sum(min(cap_s, L * w_s)) = total: a source is capped when
    the demand at its own ratio cap_s / w_s stays within the total.
    """
    src = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("same")).alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    src = src.withColumn("source_id", F.row_number().over(by_name).cast("long"))
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    src = src.withColumns({
        "weight": F.element_at(pattern, ((F.col("source_id") - 1) % len(weights) + 1).cast("int")),
        "_cap": F.col("source_size") * F.lit(cap)})
    src = src.withColumn("_ratio", F.col("_cap") / F.col("weight"))
    upto = Window.orderBy("_ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(1))
    total = F.sum("source_size").over(every) * F.lit(total_share)
    all_weight = F.sum("weight").over(every)
    src = src.withColumns({"_caps": F.sum("_cap").over(upto), "_weights": F.sum("weight").over(upto),
                           "_total": total, "_all_weight": all_weight})
    src = src.withColumn("_capped", F.col("_caps") + F.col("_ratio") * (F.col("_all_weight") - F.col("_weights"))
                         <= F.col("_total"))
    taken = F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0.0)).over(every)
    left = F.sum(F.when(F.col("_capped"), 0.0).otherwise(F.col("weight"))).over(every)
    level = F.try_divide(F.col("_total") - taken, left)
    return src.withColumn("target", F.when(F.col("_capped"), F.col("_cap"))
                          .otherwise(F.least(F.col("_cap"), level * F.col("weight")))) \
              .select("source_id", "source", "source_size", "weight", "target")


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Draws without replacement; beyond numpy's range by inverting the distribution."""
    low, high = max(0, n - bad), min(good, n)
    if low >= high:
        return low
    if good + bad < _EXACT_POPULATION:
        return int(rng.hypergeometric(good, bad, n))
    return invert_hypergeometric(rng.random(), good, bad, n)


def invert_hypergeometric(u: float, good: int, bad: int, n: int) -> int:
    """The smallest count whose cumulative probability exceeds ``u``.

    Probabilities follow from ratios of neighbours, so no large factorial is
    needed.  They are taken within 9 standard deviations of the mean (and 40
    more); the rest has less weight than a double can tell from 0.
    """
    low, high, whole = max(0, n - bad), min(good, n), good + bad
    mean = n * (good / whole)
    reach = int(9 * (mean * (bad / whole) * ((whole - n) / max(1, whole - 1))) ** 0.5) + 40
    first, last = max(low, int(mean) - reach), min(high, int(mean) + reach)
    k = np.arange(first, last, dtype=np.float64)
    ratio = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    total = np.cumsum(np.exp(weight - weight.max()))
    return first + min(int(np.searchsorted(total, u * total[-1], side="right")), last - first)


def split_quotas(quotas: list[int], n_shards: int, seed: int) -> np.ndarray:
    """[shard, source] counts: rows differ by at most one in total, columns sum to the quotas."""
    total = sum(quotas)
    capacity = [total // n_shards + (i < total % n_shards) for i in range(n_shards)]
    out = np.zeros((n_shards, len(quotas)), dtype=np.int64)

    def node(first: int, last: int, counts: list[int]) -> None:
        if last - first == 1:
            out[first] = counts
            return
        mid = (first + last) // 2
        rng = np.random.default_rng([seed, first, last])
        need, rest, left = sum(capacity[first:mid]), sum(counts), []
        for c in counts:
            rest -= c
            got = hypergeometric(rng, c, rest, need)
            left.append(got)
            need -= got
        node(first, mid, left)
        node(mid, last, [c - l for c, l in zip(counts, left)])

    if n_shards > 0:
        node(0, n_shards, list(quotas))
    return out


def row_identity(docs: DataFrame) -> tuple[Column, Column]:
    """(uid, tag): the id, or a hash of the row where it has none, and another hash of the row.

    Rows that agree in both are equal in all columns.  Hashes pass over NULLs,
    so the places of NULLs are hashed along; nested values go as JSON.
    """
    values = []
    for name in docs.columns:
        col = docs[f"`{name}`"]
        if isinstance(docs.schema[name].dataType, (ArrayType, MapType, StructType)):
            col = F.to_json(F.struct(col.alias("v")), {"ignoreNullFields": "false"})
        values += [F.isnull(col), col]
    return (F.coalesce(docs["doc_id"].cast("long"), F.xxhash64(F.lit("uid"), *values)),
            F.xxhash64(F.lit("tag"), *values))


def mix_sources(docs: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE, cap: float = CAP,
                block_words: int = BLOCK_WORDS, n_shards: int = SHARDS, seed: int = 20,
                max_sources: int = MAX_SOURCES) -> Mix:
    """Draws a mixture of ``docs`` (doc_id, text, source); reruns agree.

    A NULL text has size 0 and is never drawn, a NULL source is a source of
    its own.  Equal rows are counted as they are read, then told apart by
    ``rep`` and drawn separately; what else ``docs`` holds takes part in that
    alone.  An empty table gives empty draws.
    """
    spark = docs.sparkSession
    uid, tag = row_identity(docs)
    read = docs.select(uid.alias("uid"), tag.alias("tag"), "doc_id", "source",
                       word_count(F.col("text")).alias("size"))
    counted = read.groupBy(*read.columns).agg(F.count(F.lit(1)).alias("same"))
    sized = materialize(few_files(counted, docs.count()), "mix_sizes")   # rows without their texts: few files
    targets = materialize(source_targets(sized, weights, total_share, cap), "mix_targets")
    whole = sized.agg(F.sum("same").alias("rows"), F.sum(
        F.col("same") * F.ceil(F.col("size") / block_words)).alias("blocks")).first()
    every_row = F.explode(F.sequence(F.lit(1).cast("long"), F.col("same")))
    sizes = materialize(few_files(
        sized.join(targets, sized["source"].eqNullSafe(targets["source"]))
        .select("uid", "tag", every_row.alias("rep"), "doc_id", sized["source"], "size", "source_id", "source_size",
                "target", "same"), whole.rows or 0), "mix_docs")

    # Blocks in the permuted order of their source.
    blocks = (sizes.filter("size > 0")
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / block_words))))
              .withColumn("n", F.least(F.lit(block_words).cast("long"), F.col("size") - F.col("block") * block_words))
              .withColumn("key", F.xxhash64(F.lit(seed), "uid", "tag", "rep", "block"))
              .withColumn("bucket", F.pmod(F.col("key"), F.lit(BUCKETS))))
    stats = blocks.groupBy("source_id", "bucket").agg(F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("source_id").orderBy("bucket")
    offsets = stats.select("source_id", "bucket",
                           (F.sum("_n").over(before) - F.col("_n")).alias("words_before"),
                           (F.sum("_c").over(before) - F.col("_c")).alias("blocks_before"),
                           F.sum("_c").over(Window.partitionBy("source_id")).alias("source_blocks"))
    inside = Window.partitionBy("source_id", "bucket").orderBy("key", "uid", "tag", "rep", "block")
    passes = F.floor(F.col("target") / F.col("source_size")).cast("long")
    rest = F.floor(F.col("target") - passes * F.col("source_size")).cast("long")
    ranked = (blocks.withColumns({"_words": F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"),
                                  "_rank": F.row_number().over(inside) - 1})
              .join(offsets, ["source_id", "bucket"])
              .withColumns({"rank": F.col("blocks_before") + F.col("_rank"),
                            "passes": passes,
                            "part": F.greatest(F.lit(0).cast("long"),
                                               F.least(F.col("n"), rest - F.col("words_before") - F.col("_words")))})
              .filter("passes > 0 or part > 0")
              .select("uid", "tag", "rep", "doc_id", "same", "source_id", "block", "n", "rank", "passes", "part",
                      "source_blocks"))
    ranked = materialize(few_files(ranked, whole.blocks or 0), "mix_blocks")

    # Quotas per source: one row each, checked before they reach the driver.
    quota_rows = (ranked.groupBy("source_id")
                  .agg((F.max("passes") * F.max("source_blocks") + F.sum((F.col("part") > 0).cast("long"))).alias("quota"))
                  .orderBy("source_id").limit(max_sources + 1).collect())
    if len(quota_rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    ids = [r.source_id for r in quota_rows]
    ends = np.cumsum(split_quotas([r.quota for r in quota_rows], n_shards, seed), axis=0)
    leaf = spark.createDataFrame(
        pd.DataFrame({"source_id": ids, "ends": [ends[:, i].tolist() for i in range(len(ids))]}),
        "source_id long, ends array<long>")

    copies = F.when(F.col("part") > 0, F.col("passes")).otherwise(F.col("passes") - 1)
    draws = (ranked.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies)))
             .withColumn("words", F.when(F.col("copy") < F.col("passes"), F.col("n")).otherwise(F.col("part")))
             .withColumn("deal", F.col("copy") * F.col("source_blocks") + F.col("rank"))
             .join(leaf, "source_id")
             .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("deal"))))
             .withColumn("draw_key", F.xxhash64(F.lit(seed + 1), "shard", "uid", "tag", "rep", "block", "copy"))
             .select("uid", "tag", "rep", "doc_id", "same", "block", "copy", "words", "shard", "draw_key"))
    return Mix(sizes, draws, targets, n_shards)


def taken_words(mix: Mix) -> DataFrame:
    """Words taken per document and its drawn blocks in each shard, zero for those never drawn."""
    keys = ["uid", "tag", "rep", "doc_id"]
    none = mix.sizes.select(*keys, "source", "size", "source_size", "target", F.lit(0).cast("long").alias("words"),
                            F.lit(None).cast("int").alias("shard"))
    drawn = mix.draws.select(*keys, "words", "shard")
    return none.unionByName(drawn, allowMissingColumns=True).groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("source", "size", "source_size", "target")], F.sum("words").alias("taken"),
        F.count("shard").alias("blocks"),
        F.array(*[F.count_if(F.col("shard") == i) for i in range(mix.n_shards)]).alias("shard_blocks"))


def _cutter(block_words: int):
    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series, blocks: pd.Series, words: pd.Series) -> pd.Series:
        import re

        out = []
        for text, own, counts in zip(texts, blocks, words):
            if text is None:
                out.append(None)
                continue
            starts = [m.start() for m in re.finditer("[^\x20\x09-\x0d]+", text)] + [len(text)]
            out.append([text if w == len(starts) - 1 else
                        text[starts[b * block_words]: starts[min(b * block_words + w, len(starts) - 1)]]
                        .rstrip("\x20\t\n\x0b\x0c\r") for b, w in zip(own, counts)])
        return pd.Series(out, dtype="object")

    return cut


def mixed_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS, **options) -> tuple[DataFrame, int]:
    """The mixture, one row per drawn block, and the number of shards.

    Rows have the columns of ``docs`` and __mix_draw: the drawn block's
    draw_key, uid, tag, block, copy, rep, shard and words.  A document drawn as one
    whole block keeps its text as it is; ``n_chars`` (if there) is counted
    anew for cut texts.
    """
    mix = mix_sources(docs, block_words=block_words, **options)
    own = (mix.draws.groupBy(F.col("uid").alias("__mix_uid"), F.col("tag").alias("__mix_tag"), "rep")
           .agg(F.max("same").alias("__mix_same"), F.collect_list(
               F.struct("draw_key", "uid", "tag", "block", "copy", "rep", "shard", "words")).alias("__mix_draws"))
           .withColumn("__mix_part", F.floor((F.col("rep") - 1) / SAME_ROWS)).drop("rep"))
    uid, tag = row_identity(docs)
    left = docs.withColumns({"__mix_uid": uid, "__mix_tag": tag, "__mix_size": word_count(F.col("text"))})
    # Equal rows are one text to join; one shuffle of whole texts serves the choice and the join.
    first = Window.partitionBy("__mix_uid", "__mix_tag").orderBy("__mix_size")
    one = left.withColumn("__mix_row", F.row_number().over(first)).filter("__mix_row = 1").drop("__mix_row")
    joined = one.join(own.filter(F.col("__mix_same") <= SAME_ROWS).drop("__mix_part"), ["__mix_uid", "__mix_tag"])
    often = materialize(
        mix.sizes.filter((F.col("same") > SAME_ROWS) & ((F.col("rep") - 1) % SAME_ROWS == 0))
        .select(F.col("uid").alias("__mix_uid"), F.col("tag").alias("__mix_tag"),
                F.floor((F.col("rep") - 1) / SAME_ROWS).alias("__mix_part")), "mix_often")
    if not often.isEmpty():
        # A row repeated very often goes to one place per SAME_ROWS repeats.
        keys = ["__mix_uid", "__mix_tag", "__mix_part"]
        few = may_have(left, keys[:2], often).withColumn("__mix_row", F.row_number().over(first)).filter("__mix_row = 1")
        spread_out = few.drop("__mix_row").join(often, keys[:2])
        joined = joined.unionByName(
            spread_out.join(own.filter(F.col("__mix_same") > SAME_ROWS), keys).drop("__mix_part"))
    whole = F.forall("__mix_draws", lambda d: d["words"] == F.col("__mix_size"))
    # Whole documents go by without Python; one branch, so that the texts are shuffled once.
    part = [F.when(~whole, c) for c in (F.col("text"), F.col("__mix_draws.block"), F.col("__mix_draws.words"))]
    joined = joined.withColumn("__mix_cut", _cutter(block_words)(*part))
    cut = F.coalesce("__mix_cut", F.transform("__mix_draws", lambda d: F.lit(None).cast("string")))
    pairs = F.arrays_zip(F.col("__mix_draws").alias("draw"), cut.alias("cut"))
    # The whole text is needed no more once a block of it was cut.
    rows = joined.withColumn("__mix_whole", F.when(whole, F.col("text"))).drop("text")
    rows = rows.withColumn("__mix_pair", F.explode(pairs))
    rows = rows.withColumns({"__mix_draw": F.col("__mix_pair.draw"),
                             "text": F.coalesce("__mix_pair.cut", "__mix_whole")})
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.isnull("__mix_pair.cut"), F.col("n_chars")).otherwise(n_chars))
    return rows.select(*docs.columns, "__mix_draw"), mix.n_shards


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, **options) -> DataFrame:
    """The mixture in the columns of ``docs``: one row per drawn block, dealt to shards.

    Rows lie by shard and, within it, by the keyed hash of the draw, so the
    copies of a document come apart.  A shard is a run of successive
    partitions, each a range of the hash, as many as the session's shuffle
    partitions ask for.
    """
    rows, n_shards = mixed_blocks(docs, block_words, **options)
    draw = F.col("__mix_draw")
    per_shard = -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // n_shards)
    place = F.floor((draw["draw_key"].cast("double") / 2.0**64 + 0.5) * per_shard).cast("int")
    place = draw["shard"] * per_shard + F.least(place, F.lit(per_shard - 1))
    return (rows.repartitionById(n_shards * per_shard, place.cast("int"))
            .sortWithinPartitions(*[draw[c] for c in ("draw_key", "uid", "tag", "rep", "block", "copy")])
            .select(*docs.columns))
