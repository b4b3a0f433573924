"""The most frequent terms of a corpus in two passes, without counting its rare ones.

The first pass adds up hashed counters: each term belongs to one counter of each of ``HASHES`` tables of ``WIDTH`` counters, so a
task sends at most ``HASHES * WIDTH`` rows, however many distinct terms it saw. A counter is never below the count of any of its
terms. The second pass counts exactly the terms all of whose counters reach a floor. When the last wanted term reaches the floor
too, no other term can belong to the list, ties included; else the floor falls to the count that was found, and the pass is repeated.

Phrases grow by one word a round: a phrase is never more frequent than its first or its last words. Words that stay below the count
of the last wanted word are in no wanted phrase, so only runs of frequent words are kept, as numbers, and counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.operators.joins import lookup_join
from tamarack.session import cut_lineage

#: Tables of counters, and counters of a table as a power of two: 20 bits of a 64-bit hash each.
HASHES, BITS = 3, 20
WIDTH = 1 << BITS

#: The first floor is the counter of this rank, as a multiple of the wanted terms of all tables. It only steers the work.
SLACK = 2


def _counter(term: str, table: int) -> Column:
    """Number of the term's counter in one table; tables follow each other."""
    return F.shiftrightunsigned(F.xxhash64(term), table * BITS).bitwiseAND(WIDTH - 1) + table * WIDTH


def hashed_counters(terms: DataFrame, term: str = "term") -> DataFrame:
    """(counter, n) of all tables: the number of terms that fall on each counter. At most ``HASHES * WIDTH`` rows, written."""
    counters = terms.select(F.explode(F.array(*[_counter(term, k) for k in range(HASHES)])).alias("counter"))
    return cut_lineage(counters.groupBy("counter").agg(F.count(F.lit(1)).alias("n")))


def candidate_counts(terms: DataFrame, counters: DataFrame, floor: int, term: str = "term") -> DataFrame:
    """(term, tf): exact counts of the terms all of whose counters are ``floor`` or more; every term as frequent as that is there.

    What is broadcast are numbers of counters, at most ``WIDTH`` per table.
    """
    kept = terms.select(term)
    for table in range(HASHES):
        high = counters.where((F.col("n") >= floor) & (F.col("counter") >= table * WIDTH) & (F.col("counter") < (table + 1) * WIDTH))
        high = F.broadcast(high.select(F.col("counter").alias("_high")))
        kept = kept.join(high, _counter(term, table) == F.col("_high"), "left_semi")
    return kept.groupBy(term).agg(F.count(F.lit(1)).alias("tf"))


def _complete_counts(terms: DataFrame, size: int, term: str) -> DataFrame:
    """(term, tf): exact counts that hold the ``size`` most frequent terms and all that are as frequent as the last of them."""
    counters = hashed_counters(terms, term)
    first = counters.orderBy(F.desc("n")).limit(max(1, HASHES * SLACK * size)).agg(F.min("n")).first()[0]
    floor = first or 1
    while True:
        counts = cut_lineage(candidate_counts(terms, counters, floor, term))
        found = _last(counts, size, term)
        if floor <= 1 or not size or (found["rows"] == size and found["last"] >= floor):
            return counts
        floor = found["last"] if found["rows"] == size else max(1, floor // 4)


def _last(counts: DataFrame, size: int, *term: str) -> dict:
    """Rows of the list, ``size`` at most, and the count of its last one."""
    top = counts.orderBy(F.desc("tf"), *term).limit(size)
    return top.agg(F.count(F.lit(1)).alias("rows"), F.min("tf").alias("last")).first().asDict()


def frequent_terms(terms: DataFrame, size: int, term: str = "term") -> DataFrame:
    """The ``size`` most frequent values of ``term``, ties by term: (term, tf). Nulls are no terms.

    With fewer distinct terms all are returned; no rows or a size of 0 give none. ``terms`` is read once for the counters and once
    or, where many counters are shared, a few times for the counts.
    """
    terms = terms.select(term).where(F.col(term).isNotNull())
    return _complete_counts(terms, size, term).orderBy(F.desc("tf"), term).limit(size)


def frequent_phrases(texts: DataFrame, size: int, longest: int, words: str = "words", hashed: bool = False) -> DataFrame:
    """The ``size`` most frequent phrases of 1 to ``longest`` words, ties by term: (term, tf), the words joined by a space.

    ``words`` is an array of words without spaces. Null and empty arrays have none. ``hashed`` counts the words by
    :func:`hashed_counters` first. Texts are read twice; runs of frequent words are written as numbers, and no other
    phrase is formed. All counts are exact.
    """
    rows = texts.select(F.coalesce(words, F.array().cast("array<string>")).alias("_w"))
    single = rows.select(F.explode("_w").alias("term")).where("term IS NOT NULL")
    if hashed:
        counts = _complete_counts(single, size, "term")
    else:
        counts = cut_lineage(single.groupBy("term").agg(F.count(F.lit(1)).alias("tf")))
    if longest < 2 or not size:
        return counts.orderBy(F.desc("tf"), "term").limit(size)
    found = _last(counts, size)
    floor = found["last"] if found["rows"] == size else 1
    known = cut_lineage(counts.where(F.col("tf") >= floor).withColumn("id", F.monotonically_increasing_id()))
    names = [f"i{k}" for k in range(longest)]
    runs = rows.select(F.inline(F.arrays_zip(*[F.slice("_w", F.lit(k + 1), F.size("_w")).alias(f"w{k}") for k in range(longest)])))
    runs = runs.toDF(*[f"w{k}" for k in range(longest)])
    for k, name in enumerate(names):  # a run has two frequent words at least; what follows them may end the text
        codes = known.select(F.col("term").alias(f"w{k}"), F.col("id").alias(name))
        runs = lookup_join(runs, codes, [f"w{k}"], [c for c in runs.columns if c != f"w{k}"], "inner" if k < 2 else "left").drop(f"w{k}")
    runs = cut_lineage(runs.select(*names))
    levels = [known.select("tf", F.col("id").alias("i0"))]
    for n in range(2, longest + 1):
        own, live = names[:n], runs.where(F.col(names[n - 1]).isNotNull())
        if n > 2:
            for begin in (0, 1):  # the first and the last n - 1 words
                shorter = levels[-1].select(*[F.col(f"i{k}").alias(f"i{k + begin}") for k in range(n - 1)])
                live = lookup_join(live, shorter, shorter.columns, names, "left_semi")
        counted = cut_lineage(live.groupBy(*own).agg(F.count(F.lit(1)).alias("tf")).where(F.col("tf") >= floor))
        levels.append(counted)
        found = _last(reduce(DataFrame.unionAll, [level.select("tf") for level in levels]), size)
        floor = max(floor, found["last"]) if found["rows"] == size else floor
        levels = [level.where(F.col("tf") >= floor) for level in levels]
    spelled = []
    for level in levels:
        ids = [c for c in level.columns if c != "tf"]
        for name in ids:
            level = level.join(known.select(F.col("id").alias(name), F.col("term").alias(f"t_{name}")), name)
        spelled.append(level.select(F.concat_ws(" ", *[f"t_{name}" for name in ids]).alias("term"), "tf"))
    return reduce(DataFrame.unionAll, spelled).orderBy(F.desc("tf"), "term").limit(size)
