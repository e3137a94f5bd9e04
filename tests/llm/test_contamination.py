import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
from brute import SCHEMA, SF, odd_rows  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskloom.llm import decontaminate as dc  # noqa: E402

ITEMS = [
    (1, "A line, that MANY documents share"),
    (1, "A line, that MANY documents share"),
    (2, "word5 of the long text word6 of the long text word7 of the long text word8"),
    (3, None),
    (4, ""),
    (5, " ... "),
    (None, "grüße AUS köln"),
    (6, "one"),
    (7, "two two"),
]


def by_hand(rows, items, size=dc.WINDOW):
    out = []
    for doc, text in rows:
        found = dc.words_of((text or "").encode())
        hit, held = set(), set()
        for item, body in items:
            for window in dc.windows_of(dc.words_of((body or "").encode()), size):
                for i in range(len(found) - len(window) + 1):
                    if tuple(found[i : i + len(window)]) == window:
                        hit.update(range(i, i + len(window)))
                        held.add("" if item is None else str(item))
        out.append((str(doc), len(found), len(hit), sorted(held)))
    return sorted(out)


def got(df):
    out = []
    for r in df.collect():
        c = r.contamination
        hit = sum(c["spans"][1::2]) - sum(c["spans"][::2])
        out.append((str(r.doc_id), c["n_words"], hit, c["items"]))
    return sorted(out)


def test_awkward_rows_in_one_block_and_in_many(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).withColumn("contamination", F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = by_hand([(r[0], r[1]) for r in odd_rows()], ITEMS)
    assert got(dc.contamination(df, items)) == want
    assert got(dc.contamination(df, items, block_bytes=40)) == want
    left = dc.without_contaminated(df, items)
    assert left.columns == df.columns
    assert left.count() == sum(not w[3] for w in want)


def test_a_benchmark_that_is_not_broadcast(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    # A third of the documents is one passage that many items hold too.
    hot = "this very passage of more than ten words stands in a third of all the documents"
    docs = docs.unionByName(spark.range(5000, 5400).select(F.col("id").alias("doc_id"), F.lit(hot).alias("text")))
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    held = [(r.item_id, r.text) for r in items.collect()]
    more = spark.range(9000, 9040).select(F.col("id").alias("item_id"), F.lit(hot).alias("text"))
    items = items.withColumn("item_id", F.col("item_id").cast("string"))
    items = items.unionByName(more.withColumn("item_id", F.col("item_id").cast("string")))
    one = got(dc.contamination(docs, items))
    joined = dc.contamination(docs.withColumn("_row", F.lit(1)), items, block_bytes=0)
    assert got(joined) == one and set(joined.columns) == {"doc_id", "text", "_row", "contamination"}
    assert held and sum(len(r[3]) == 40 for r in one) == 400


def test_empty_tables(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.without_contaminated(df, items.limit(0)).count() == len(odd_rows())
    assert dc.contamination(df.limit(0), items).count() == 0


def test_words_part_at_all_other_ascii():
    assert dc.words_of("Don't, STOP—now 3.5×".encode()) == [
        b"don", b"t", "stop—now".encode(), b"3", "5×".encode()
    ]
