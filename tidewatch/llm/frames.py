"""DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.session import scratch_path

#: text bytes of a chunk of documents that one task handles as a whole
CHUNK_BYTES = 4 << 20
MIN_CHUNKS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends
    there, and a lost executor costs no more than its own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables that an operator needs only while it runs."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, name: str) -> str:
        self.paths.append(scratch_path(self.spark, name))
        return self.paths[-1]

    def stored(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """by: a column that has a folder for each of its values."""
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path, partitionBy=by)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        """Remove the tables; nothing that is still lazy may read them."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)


def text_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of the texts (one column scan)."""
    r = docs.agg(F.count(F.lit(1)).alias("n"),
                 F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def chunk_plan(size: int) -> tuple[int, int]:
    """Chunks and hash shards for so many bytes of text.

    A chunk exchanges one packed row with every shard, so the number of rows
    is chunks * shards.  Both grow with the root of the input beyond 2 TB,
    which keeps some 64 entries in each packed row.
    """
    entries = max(size / 6, 1)
    per = max(CHUNK_BYTES / 6, (64 * entries) ** 0.5)
    chunks = max(MIN_CHUNKS, ceil(entries / per))
    return chunks, max(MIN_CHUNKS // 2, ceil(entries / (1.5 * per)))


def chunked(docs: DataFrame, chunks: int, doc_id: str = "doc_id", text: str = "text",
            rest: bool = False) -> DataFrame:
    """Rows (chunk int, id long, text string[, rest struct]) dealt out by chunk.

    A chunk is a hash class of (id, text): copies, hot sources and null ids
    spread evenly.  Other columns travel in one struct, so that their names
    cannot clash.  Every use of this frame in one plan has the same exchange,
    which Spark then makes once.
    """
    others = [c for c in docs.columns if c not in (doc_id, text)]
    body = F.col(text).cast("string")
    ident = F.col(doc_id).cast("long")
    cols = [F.pmod(F.xxhash64(ident, body), F.lit(chunks)).cast("int").alias("chunk"),
            ident.alias("id"), F.coalesce(body, F.lit("")).alias("text")]
    if rest:
        cols += [F.struct(F.col(text).isNull().alias("__null"), *others).alias("rest")]
    return docs.select(*cols).repartition(chunks, "chunk")
