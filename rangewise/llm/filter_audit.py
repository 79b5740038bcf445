"""Interaction audit of document filters: what every order of five filters
keeps and removes, and what each filter is worth.

A document fails a filter by itself (A few words, B few distinct words, C many
capitals, D marks) or because a smaller id has its text (E). E is an
existential self-join: rows whose text hash occurs more than once meet the
texts of that hash in a left-semi join on the hash, the exact text and a smaller
id. The ids that fail it are united with those that fail another filter, a bit
per filter, and the bits of a document are combined. All orders then follow from
the counts of the 32 bit combinations per part: a document goes at the first
step whose filter it fails.

Shape of the job: rows whose hash repeats are written once, dealt by the hash;
a hash with more rows than a task's share (``SALT_ROWS``) is salted over as
many tasks as its count asks for, before its texts move. The side of the join
with texts to compare has one row per distinct text, combined before its
shuffle. The union and what follows carry ids and bits only. Orders are
counted from at most 128 rows per part. Built-in functions throughout.

A document's share of a filter (``shapley``): among all orders, each of the k
filters that a document fails comes first equally often, in 120 / k orders.

Defined cases: null text is empty (it fails A; two of them are identical);
words are maximal runs without the six ASCII white space characters; a row with
a null id never fails E and is nobody's smaller id; rows equal in id and text
are not smaller than each other, and each is counted; a null source is the
empty string as a part; of several labels of an id any 1 counts, a null label
counts nothing; a document without a label is neither good nor toxic; empty
tables give no rows; other columns never enter the operator.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangewise.llm.common import written

#: Filters in the order of their bits.
FILTERS = "ABCDE"
#: A: least words. B: least distinct words, percent. C: most capitals, percent.
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
#: D: a document holds any of these.
MARKS = "[#$%&*|]"
#: Rows of one text hash that one task compares: so many at least, and one in
#: ``HOT_HASHES`` of all rows, which bounds the list of hashes above it.
SALT_ROWS = 1000
HOT_HASHES = 100_000

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def own_failures(text: Column) -> Column:
    """Bits of the filters that a (non-null) text fails by itself."""
    words = F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != "")
    found = F.transform(F.array(words), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))[0]  # words made once
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return F.transform(F.array(found), lambda w: (
        F.when(w["n"] < LEAST_WORDS, 1).otherwise(0)
        + F.when(100 * w["distinct"] < LEAST_DISTINCT * w["n"], 2).otherwise(0)
        + F.when(100 * capitals > MOST_CAPITALS * F.length(text), 4).otherwise(0)
        + F.when(text.rlike(MARKS), 8).otherwise(0)))[0]


def _rows(docs: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
                           "hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
           salt_rows: int = SALT_ROWS) -> DataFrame:
    """doc_id, part, hash of the rows whose text a smaller id has."""
    rows = _rows(docs, doc_id, text, part)
    repeated = rows.groupBy("hash").agg(F.count("*").alias("copies")).where("copies > 1")
    total = docs.select(F.lit(1)).count()
    share = max(salt_rows, total // HOT_HASHES)
    counted = repeated.select(F.col("hash").alias("again"),
                              F.ceil(F.col("copies") / share).cast("int").alias("salts"))
    # at most HOT_HASHES hashes have more rows than the share
    hot = F.broadcast(counted.where("salts > 1").select(F.col("again").alias("hot"), "salts"))
    dealt = rows.join(hot, F.col("hash") == F.col("hot"), "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("row"), "salts"), F.lit(0)).cast("int"))
    met = counted.select("again", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt_c"))
    rows = written(docs.sparkSession, dealt.join(
        met, (F.col("hash") == F.col("again")) & (F.col("salt") == F.col("salt_c")), "left_semi").select(
            "doc_id", "part", "hash", "text", "salt", F.coalesce("salts", F.lit(1)).alias("salts")), "audit-copies")
    right = (rows.where(F.col("doc_id").isNotNull()).groupBy("hash", "text")
             .agg(F.min("doc_id").alias("least"), F.max("salts").alias("salts"))
             .select(F.col("hash").alias("hash_r"), F.col("text").alias("text_r"), "least",
                     F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt_r")))
    same = ((F.col("hash") == F.col("hash_r")) & (F.col("salt") == F.col("salt_r"))
            & (F.col("text") == F.col("text_r")) & (F.col("least") < F.col("doc_id")))
    return rows.join(right, same, "left_semi").select("doc_id", "part", "hash")


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
             salt_rows: int = SALT_ROWS) -> DataFrame:
    """doc_id, part, hash, failed, n: rows equal in the first three, how many
    they are, and the bits of the filters that they fail."""
    own = _rows(docs, doc_id, text, part).select(
        "doc_id", "part", "hash", own_failures(F.col("text")).alias("failed"), F.lit(1).alias("n"))
    earlier = copies(docs, doc_id, text, part, salt_rows).select(
        "doc_id", "part", "hash", F.lit(16).alias("failed"), F.lit(0).alias("n"))
    return own.unionByName(earlier).groupBy("doc_id", "part", "hash").agg(
        F.bit_or("failed").alias("failed"), F.sum("n").alias("n"))


def combinations(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 part: str = "source", salt_rows: int = SALT_ROWS) -> DataFrame:
    """part, failed, n, good, toxic: documents per part and bit combination."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("label_id"), "quality", "toxic")
              .where("label_id IS NOT NULL").groupBy("label_id")
              .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                   F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
              .where("good = 1 OR toxic = 1").withColumn("salt_r", F.lit(0)))
    # rows without an id meet no label: they are spread by their text's hash
    found = failures(docs, doc_id, text, part, salt_rows).withColumn(
        "salt", F.when(F.col("doc_id").isNull(), F.pmod("hash", F.lit(1024))).otherwise(0).cast("int"))
    joined = found.join(marked, (F.col("doc_id") == F.col("label_id"))
                        & (F.col("salt") == F.col("salt_r")), "left")
    return joined.groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          part: str = "source", salt_rows: int = SALT_ROWS) -> DataFrame:
    """One row per part, filter order and step (see the module)."""
    steps = []
    for order in map("".join, permutations(FILTERS)):
        bits = [1 << FILTERS.index(x) for x in order]
        steps += [{"filter_order": order, "step": k + 1, "before": sum(bits[:k]), "bit": bits[k]}
                  for k in range(len(bits))]
    table = F.from_json(F.lit(json.dumps(steps)),
                        "array<struct<filter_order:string,step:int,before:int,bit:int>>")
    counted = combinations(docs, labels, doc_id, text, part, salt_rows)
    each = counted.select("part", "failed", "n", "good", "toxic", F.explode(table).alias("s")).select(
        "part", "failed", "n", "good", "toxic", "s.*")
    met = F.col("failed").bitwiseAND(F.col("before")) == 0
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0

    def total(condition: Column, value: str | Column = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, value if isinstance(value, Column) else F.col(value))),
                          F.lit(0)).cast("long")

    return each.groupBy("part", "filter_order", "step").agg(
        total(met & ~fails).alias("kept"), total(met & fails).alias("removed"),
        total(~met & fails).alias("redundant"),
        total(F.col("failed") == F.col("bit")).alias("unique_fails"),
        total(met & fails, "good").alias("good_lost"), total(met & fails, "toxic").alias("toxic_lost"),
        total(fails, F.expr("n * (120 div bit_count(failed))")).alias("shapley"))

