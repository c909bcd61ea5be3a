"""Benchmark decontamination with a distributed positional inverted index (op 10), in DataFrame functions only.

Words are runs of digits, letters and non-ASCII characters, with A-Z lower-cased. A window is ``WINDOW`` consecutive
words of a benchmark item (an item of fewer words is one window). The steps:

1. Postings (document row, position, term) of the training texts are stored for the terms of the benchmark.
2. Every window names its two rarest terms by training count; a window with a term that no text has cannot occur.
3. The offset-adjusted position lists of the two are intersected, which leaves alignments (document, item, shift).
4. For the alignments, the remaining lists are intersected as well: positions of an alignment where document and
   item agree form runs, and a run as long as a window is an exact phrase match.

``proximity`` instead reports windows whose two rarest terms stand within ``slack`` words of their distance.

A null or empty text has no words and no hits; an item without words has no windows. Repeated rows are judged one
by one. Items that share an ``item_id`` count as one; a null ``item_id`` marks words but is not listed. A null
``doc_id`` is kept. Only the id and text columns are read. An empty benchmark hits nothing.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import broadcast_if_small, checkpointed, keep, numbered, stored

WINDOW = 13
#: A document is contaminated when this many times its hit words are at least its words.
RATIO = 20
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD), F.lit(0))


def term(word: Column) -> Column:
    """The word with A-Z lower-cased, other letters as they are."""
    return F.when(F.length(word) == F.octet_length(word), F.lower(word)).otherwise(
        F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def item_terms(benchmark: DataFrame) -> DataFrame:
    """``item``, ``item_id``, ``size``, ``at``, ``term``, ``term_id``: stored, one row a benchmark word."""
    rows = benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", words(F.col("text")).alias("w"))
    spread = keep(rows.select("item", "item_id", F.size("w").alias("size"), F.posexplode("w").alias("at", "word"))
                  .withColumn("term", term(F.col("word"))).drop("word"), "items")
    ids = keep(spread.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "terms")
    return keep(spread.join(ids, "term"), "item_terms")


def postings(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Stored ``row``, ``doc_id``, ``n_words``, ``pos``, ``term_id`` for benchmark terms, and one row with the
    first position (or a null one) for every document."""
    vocabulary = broadcast_if_small(checkpointed(items.select("term", "term_id").distinct()))
    split = numbered(docs.select("doc_id", "text")).select("row", "doc_id", words(F.col("text")).alias("w"))
    spread = split.select("row", "doc_id", F.size("w").alias("n_words"), F.posexplode_outer("w").alias("pos", "word"))
    found = spread.select("row", "doc_id", "n_words", "pos", term(F.col("word")).alias("term")).join(
        vocabulary, "term", "left")
    return keep(found.filter("term_id is not null or pos is null or pos = 0").drop("term"), "postings")


def rarest_pairs(items: DataFrame, index: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item``, ``o1``, ``t1``, ``o2``, ``t2``: offsets and terms of the two rarest words of each possible window."""
    counts = index.filter("term_id is not null").groupBy("term_id").agg(F.count(F.lit(1)).alias("k"))
    ranked = items.join(counts, "term_id", "left").withColumn("k", F.coalesce("k", F.lit(0)))
    span = Window.partitionBy("item").orderBy("at").rowsBetween(0, window - 1)
    lists = ranked.withColumn("best", F.array_sort(F.collect_list(F.struct("k", "at", "term_id")).over(span))).filter(
        (F.col("at") == 0) | (F.col("at") + window <= F.col("size")))
    one, two = F.col("best")[0], F.coalesce(F.get(F.col("best"), F.lit(1)), F.col("best")[0])
    return lists.filter(one["k"] > 0).select(
        "item", one["at"].alias("o1"), one["term_id"].alias("t1"), two["at"].alias("o2"), two["term_id"].alias("t2")).distinct()


def alignments(pairs: DataFrame, index: DataFrame, slack: int = 0) -> DataFrame:
    """``row``, ``item``, ``shift``: where both rarest terms of a window stand at their offsets (within ``slack``)."""
    pairs = checkpointed(pairs)
    ids = checkpointed(pairs.select(F.explode(F.array("t1", "t2")).alias("term_id")).distinct())
    lists = index.select("row", "pos", "term_id").join(broadcast_if_small(ids), "term_id", "left_semi")
    first = lists.join(broadcast_if_small(pairs), lists["term_id"] == pairs["t1"]).select(
        "row", "item", "t2", (F.col("pos") - F.col("o1")).alias("shift"), "o2")
    if slack:
        steps = F.explode(F.sequence(F.lit(-slack), F.lit(slack)))
        first = first.withColumn("step", steps)
    else:
        first = first.withColumn("step", F.lit(0))
    first = first.withColumn("want", F.col("shift") + F.col("o2") + F.col("step"))
    met = first.join(lists.select(F.col("row").alias("r"), F.col("pos").alias("p"), F.col("term_id").alias("t")),
                     (F.col("row") == F.col("r")) & (F.col("want") == F.col("p")) & (F.col("t2") == F.col("t")))
    return met.select("row", "item", "shift").distinct()


def exact_hits(items: DataFrame, index: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row``, ``item``, ``item_id``, ``first``, ``last``: runs of document words covered by occurring windows."""
    found = checkpointed(alignments(rarest_pairs(items, index, window), index))
    rows = broadcast_if_small(checkpointed(found.select("row").distinct()))
    lists = index.filter("term_id is not null").select("row", "pos", "term_id").join(rows, "row", "left_semi")
    wanted = found.join(items.select("item", "item_id", "size", "at", "term_id"), "item").withColumn(
        "pos", F.col("shift") + F.col("at"))
    agreed = wanted.join(lists, ["row", "pos", "term_id"])
    line = ["row", "item", "shift"]
    run = F.col("at") - F.row_number().over(Window.partitionBy(*line).orderBy("at"))
    return (agreed.withColumn("run", run).groupBy(*line, "run", "item_id", "size")
            .agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
            .filter(F.col("last") - F.col("first") + 1 >= F.least(F.lit(window), F.col("size")))
            .select("row", "item", "item_id", "first", "last"))


def proximity(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = 3) -> DataFrame:
    """``doc_id``, ``item_id``, ``shift``: windows whose two rarest terms stand within ``slack`` of their distance."""
    items = item_terms(benchmark)
    index = postings(docs, items)
    near = alignments(rarest_pairs(items, index, window), index, slack)
    names = index.filter("pos is null or pos = 0").select("row", "doc_id")
    return near.join(items.select("item", "item_id").distinct(), "item").join(names, "row").select(
        "doc_id", "item_id", "shift")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, ratio: int = RATIO) -> DataFrame:
    """``row``, ``doc_id``, ``n_words``, ``n_hit``, ``items`` (sorted ids as strings), ``contaminated`` per row."""
    items = item_terms(benchmark)
    index = postings(docs, items)
    hits = checkpointed(exact_hits(items, index, window))
    covered = hits.select("row", F.explode(F.sequence("first", "last")).alias("pos")).distinct().groupBy("row").agg(
        F.count(F.lit(1)).alias("n_hit"))
    named = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    every = index.filter("pos is null or pos = 0").select("row", "doc_id", F.col("n_words").cast("long").alias("n_words"))
    out = every.join(covered, "row", "left").join(named, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("row", "doc_id", "n_words", n_hit.alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (F.lit(ratio) * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows."""
    docs = stored(docs)
    bad = checkpointed(contamination(docs, benchmark).filter("contaminated").select(F.col("row").alias("__bad")))
    rows = numbered(docs, "__row")
    return rows.join(broadcast_if_small(bad), F.col("__row") == F.col("__bad"), "left_anti").drop("__row")
