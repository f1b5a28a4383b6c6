"""Search by words: posting lists with positions, and BM25 over them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.shared import written

#: English words that tell nothing of a text.
STOP_WORDS = "a about after all also an and any are as at be been but by can could did do does for from had has have he her his how i if in into is it its may more no not of on or our out over she so some such than that the their them then there these they this to under up was we were what when which who will with would you your".split()
#: Fixed values: (suffix, what stands for it, least letters before it). The first that fits is taken; a second pass takes one of the second list.
PLURALS = [("sses", "ss", 2), ("ies", "y", 2), ("ss", "ss", 1), ("us", "us", 1), ("s", "", 3)]
ENDINGS = [("ational", "ate", 2), ("ization", "ize", 2), ("fulness", "ful", 2), ("iveness", "ive", 2), ("ation", "ate", 2), ("ness", "", 3), ("ment", "", 3), ("ingly", "", 3), ("edly", "", 3), ("ing", "", 3), ("ed", "", 3), ("ly", "", 3)]
K1, B = 1.2, 0.75


def suffix(word: Column, rules: list[tuple[str, str, int]]) -> Column:
    """The word with the suffix of the first rule that fits replaced."""
    out = None
    for end, new, before in rules:
        fits = word.endswith(end) & (F.length(word) >= before + len(end))
        value = F.concat(F.left(word, F.length(word) - len(end)), F.lit(new))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out.otherwise(word)


def stem(word: Column) -> Column:
    return suffix(suffix(word, PLURALS), ENDINGS)


def tokens(text: Column) -> Column:
    """Stems of the words of a text in their order, null for stop words, so that places count them; no words of a null text."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(words, lambda w: F.when(~w.isin(STOP_WORDS), stem(w)))


def impact(tf: Column, length: Column, average: float) -> Column:
    """What the count of a term in a text of some length is worth, from 0 to K1 + 1."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))


def weight(df: Column, total: int, part: Column) -> Column:
    """The score of a term in a text in millionths, a whole number, so that sums do not depend on their order."""
    idf = F.log(1 + (total - df + 0.5) / (df + 0.5))
    return F.round(1e6 * idf * part).cast("long")


def text_lists(words: DataFrame) -> DataFrame:
    """(doc, term, tf, positions, length) of each text (doc, words): for each of its terms where it stands, and how many words the text has."""
    kind = words.schema["doc"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                column = part.column("words")
                n = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
                row = np.repeat(np.arange(len(n)), n)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                flat = column.flatten().dictionary_encode()
                code = pc.fill_null(flat.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
                row, place, code = row[code >= 0], place[code >= 0], code[code >= 0]
                length = np.bincount(row, minlength=len(n))
                order = np.lexsort((place, code, row))
                row, place, code = row[order], place[order], code[order]
                first = np.flatnonzero(np.concatenate([np.ones(min(len(row), 1), bool), (row[1:] != row[:-1]) | (code[1:] != code[:-1])]))
                offsets = np.append(first, len(row)).astype(np.int32)
                yield pa.record_batch(
                    [part.column("doc").take(pa.array(row[first])), flat.dictionary.take(pa.array(code[first])), pa.array(np.diff(offsets).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(place.astype(np.int32))), pa.array(length[row[first]])],
                    names=["doc", "term", "tf", "positions", "length"],
                )

    return words.mapInArrow(run, f"doc {kind}, term string, tf long, positions array<int>, length long")


class TextIndex:
    """Posting lists in a folder.

    `postings` (term, doc, tf, positions, part) is partitioned by a hash of the term; `terms` (term, df, best) tells how many
    texts hold a term and the greatest part; `heads` has the `head` greatest parts of each term; `stats` counts texts and
    their average length.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.total, self.average, self.buckets = self.table("stats").first()

    def table(self, name: str) -> DataFrame:
        read = self.spark.read
        if name == "postings":  # an index without words has no files of it
            read = read.schema(postings_schema(self.table("heads").schema["doc"].dataType.simpleString()))
        return read.parquet(f"{self.folder}/{name}")

    @classmethod
    def build(cls, docs: DataFrame, folder: str, *, key: str, text: str, buckets: int = 32, head: int = 64) -> TextIndex:
        """Writes the index of all whole texts. Texts without words count among all, and are in no list.

        The lists of a text are made where it is read, and then dealt out by bucket and text, so a term that is in every text
        is spread over several tasks; counts and heads of terms are cut down task by task before terms meet.
        Repeated keys: each row is a text, and the scores of one key add up.
        """
        spark = docs.sparkSession
        words = docs.select(F.col(key).alias("doc"), tokens(F.col(text)).alias("words"))
        total, average = words.agg(F.count(F.lit(1)), F.avg(F.size(F.array_compact("words")))).first()
        spark.createDataFrame([(total, average or 1.0, buckets)], "total long, average double, buckets int").coalesce(1).write.parquet(f"{folder}/stats")
        lists = text_lists(words).select("term", "doc", "tf", "positions", impact(F.col("tf"), F.col("length"), average or 1.0).alias("part"), bucket_of(F.col("term"), buckets).alias("bucket"))
        lists.repartition("bucket", F.pmod(F.xxhash64("doc"), F.lit(8))).sortWithinPartitions("bucket", "term", "doc").write.partitionBy("bucket").parquet(f"{folder}/postings")
        filed = spark.read.schema(postings_schema(lists.schema["doc"].dataType.simpleString())).parquet(f"{folder}/postings")
        filed.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("part").alias("best")).write.parquet(f"{folder}/terms")
        first = W.partitionBy("term").orderBy(F.desc("part"), "doc")
        filed.select("term", "doc", "part").withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= head).drop("_n").write.parquet(f"{folder}/heads")
        return cls(spark, folder)

    def search(self, queries: DataFrame, *, key: str, text: str, k: int = 10) -> DataFrame:
        """(query, doc, score, rank): for each query the k texts of greatest BM25 score in millionths, ties to the smaller doc.

        Exact, with pruning by term: the heads of a query's terms give k texts that reach some score. Terms that
        even together cannot reach it are not essential: only texts that hold some other term are candidates, and
        the lists of the rest are read for candidates alone that may still reach it. Only the partitions of
        the queries' terms are read. Queries without a known term find nothing. Repeated words of a query count once.
        """
        asked = queries.select(F.col(key).alias("query"), F.explode(F.array_distinct(F.array_compact(tokens(F.col(text))))).alias("term")).distinct()
        known = asked.join(self.table("terms"), "term").withColumn("most", weight(F.col("df"), self.total, F.col("best")))
        known = written(known, "asked")
        worth = lambda rows: rows.withColumn("w", weight(F.col("df"), self.total, F.col("part")))
        terms = known.select("query", "term", "df")
        heads = worth(self.table("heads").join(terms, "term")).groupBy("query", "doc").agg(F.sum("w").alias("w"))
        kth = W.partitionBy("query").orderBy(F.desc("w"))
        least = heads.withColumn("_n", F.row_number().over(kth)).where(F.col("_n") <= k).groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("w"))
        least = least.select("query", F.when(F.col("n") == k, F.col("w")).otherwise(0).alias("least"))
        rising = W.partitionBy("query").orderBy("most", "term").rowsBetween(W.unboundedPreceding, 0)
        judged = known.join(least, "query").withColumn("below", F.sum("most").over(rising)).withColumn("essential", F.col("below") >= F.col("least"))
        rest = F.coalesce(F.sum(F.when(~F.col("essential"), F.col("most"))).over(W.partitionBy("query")), F.lit(0))
        judged = written(judged.withColumn("rest", rest).select("query", "term", "df", "least", "rest", "essential"), "judged")
        buckets = [r["b"] for r in judged.select(bucket_of(F.col("term"), self.buckets).alias("b")).distinct().collect()]
        lists = self.table("postings").where(F.col("bucket").isin(buckets)).select("term", "doc", "part")
        held = worth(lists.join(judged.where("essential"), "term")).groupBy("query", "doc").agg(F.sum("w").alias("w"), F.first("least").alias("least"), F.first("rest").alias("rest"))
        candidates = written(held.where("w + rest >= least").select("query", "doc", "w"), "candidates")
        probed = worth(lists.join(judged.where("not essential").select("query", "term", "df"), "term")).select("query", "doc", "w")
        probed = probed.join(candidates.select("query", "doc"), ["query", "doc"], "left_semi")
        total = candidates.unionByName(probed).groupBy("query", "doc").agg(F.sum("w").alias("score"))
        best = W.partitionBy("query").orderBy(F.desc("score"), "doc")
        return total.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def phrase(self, first: str, second: str) -> DataFrame:
        """(doc, at): places where two words follow one another, by their positions."""
        spark = self.spark
        stems = spark.range(1).select(tokens(F.lit(f"{first} {second}")).alias("t")).first()["t"]
        lists = self.table("postings")
        at = lambda t, name: lists.where((F.col("bucket") == bucket_of(F.lit(t), self.buckets)) & (F.col("term") == t)).select("doc", F.explode("positions").alias(name))
        return at(stems[0], "at").join(at(stems[1], "next").withColumn("at", F.col("next") - 1), ["doc", "at"]).select("doc", "at")


def postings_schema(kind: str) -> str:
    return f"term string, doc {kind}, tf long, positions array<int>, part double, bucket int"


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")
