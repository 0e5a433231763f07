"""Exact duplicates of a growing corpus: a stream keeps one state row per digest, on disk and without expiry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm.registry import query
from kerbflow.session import scratch_dir, store

#: Characters that do not count when texts are compared.
BLANK = " \t\n\x0b\x0c\r"
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Many small stores: without this each one reserves megabytes before it holds a row.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Hits are looked for in this many parts of the digests, so the filter that is broadcast has as many numbers at most.
HIT_PARTS = 1 << 20

Digest = Callable[[Column], Column]


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content.cast("binary"), 256))


def content_of(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), BLANK, "")


def _entries(docs: DataFrame, id_column: str, text: str, digest: Digest) -> DataFrame:
    """(digest, entry, content) of rows read from files; entries are ordered by who stays: the longest text, then the least id.

    A row without an id comes after those with one. The place, a file and the row in it, locates the content and
    decides between rows that repeat both text and id.
    """
    content = content_of(text)
    return docs.select(
        digest(content).alias("digest"),
        F.struct((-F.length(F.coalesce(F.col(text).cast("string"), F.lit("")))).cast("long").alias("order"), F.col(id_column).isNull().alias("unnamed"),
                 F.col(id_column).alias("id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("entry"),
        content.alias("content"))


def observe(stream: DataFrame, where: str, id_column: str = "doc_id", text: str = "text", digest: Digest = sha256) -> None:
    """Take in all files of the stream that folder `where` has not seen, a batch after another, and return.

    The state has one row per digest: the entry that stays so far (order, id, file and row) and how many rows there were.
    RocksDB keeps it on the executors' disks, with checkpoints in `where`; no watermark is set, so nothing expires. Every
    batch writes the state rows that it changed. A batch that is run again after a failure writes the same rows.
    """
    spark = stream.sparkSession
    state = (_entries(stream, id_column, text, digest).groupBy("digest")
             .agg(F.min("entry").alias("keep"), F.count("*").alias("group_size")))
    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        running = (state.writeStream.outputMode("update").option("checkpointLocation", f"{where}/state").trigger(availableNow=True)
                   .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{where}/changes/batch={number}")).start())
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    running.awaitTermination()


def classes(spark: SparkSession, where: str, empty: DataFrame) -> DataFrame:
    """(digest, keep, group_size) of every digest seen so far: the last of the state rows that the batches wrote.

    Entries only improve and counts only grow, so the last one is the least entry with the largest count. `empty` has the
    columns, for a stream that had no files yet.
    """
    if not _exists(spark, f"{where}/changes"):
        return empty.select("digest", F.col("entry").alias("keep"), F.lit(0).cast("long").alias("group_size")).limit(0)
    changes = spark.read.parquet(f"{where}/changes").drop("batch")
    return changes.groupBy("digest").agg(F.min("keep").alias("keep"), F.max("group_size").alias("group_size"))


def _exists(spark: SparkSession, path: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _part(digest: str) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(HIT_PARTS))


def clashes(entries: DataFrame, known: DataFrame) -> DataFrame:
    """Digests that stand for more than one content.

    On a hit the whole content is compared with the one at the place that the state has: rows are grouped by digest and
    content, copies inside a task first, and the group that holds that place is the kept one; any other group is a clash.
    Texts whose digest was seen once stay where they are, but for those in a part of the digests that has a hit too.
    """
    hits = known.where("group_size > 1")
    parts = hits.select(_part("digest").alias("part")).distinct()  # HIT_PARTS numbers at most
    contents = (entries.withColumn("part", _part("digest")).join(F.broadcast(parts), "part", "left_semi")
                .groupBy("digest", "content").agg(F.min("entry").alias("first")).select("digest", "first"))
    return (contents.join(hits, "digest").where((F.col("first.file") != F.col("keep.file")) | (F.col("first.row") != F.col("keep.row")))
            .select("digest").distinct())


def duplicates(docs: DataFrame, where: str, id_column: str = "doc_id", text: str = "text", digest: Digest = sha256) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row of `docs`, whose files `observe` has taken into `where`.

    Texts are equal when they are identical without blanks (space, tab and the others up to carriage return). The row
    whose original text has the most code points stays, then the one with the least id (a null id last), then the first
    by file and row. Null counts as empty, and all empty texts are equal. Rows that repeat everything are rows of their
    own, of which one stays. Other columns may have any name; they are not read.
    """
    spark = docs.sparkSession
    entries = _entries(docs, id_column, text, digest)
    known = store(classes(spark, where, entries), "exact-classes")
    clashing = store(clashes(entries, known), "exact-clashes")
    sha = F.sha2(F.col("content").cast("binary"), 256).alias("text_sha256")
    if clashing.isEmpty():
        met = entries.select("digest", "entry", sha).join(known, "digest")
    else:  # a digest that did not tell contents apart: its rows are grouped by content
        apart = entries.join(clashing, "digest")
        alone = apart.groupBy("digest", "content").agg(F.min("entry").alias("keep"), F.count("*").alias("group_size"))
        met = (entries.join(clashing, "digest", "left_anti").select("digest", "entry", sha).join(known, "digest")
               .unionByName(apart.join(alone, ["digest", "content"]).select("digest", "entry", sha, "keep", "group_size")))
    kept = (F.col("entry.file") == F.col("keep.file")) & (F.col("entry.row") == F.col("keep.row"))
    return met.select(F.col("entry.id").alias(id_column), F.col("keep.id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")


def document_stream(spark: SparkSession, sf_dir: str, files_per_batch: int = 1000) -> DataFrame:
    """The files of the table of documents as a stream; the pattern also matches a table that is a single file."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(f"{sf_dir.rstrip('/')}/documents.parque[t]"))


@query("op12_exact_dedup", sql=r"""
with t as (select doc_id, coalesce(text, '') as text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as content from documents)
select doc_id,
       first_value(doc_id) over (partition by content order by length(text) desc, doc_id rows between unbounded preceding and unbounded following) as keep_id,
       count(*) over (partition by content) as group_size,
       row_number() over (partition by content order by length(text) desc, doc_id) = 1 as kept,
       sha256(content) as text_sha256
from t""")
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch_dir(spark, "exact-dedup")
    observe(document_stream(spark, sf_dir), where)
    return duplicates(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), where)
