"""Token counts of documents in flat token files: a separator scan with stitched blocks.

A token file is a bare row of 16-bit numbers, high byte first. Documents follow one another,
each closed by the end-of-document id; nothing says where they begin or how long they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import encode
from .common import tidy_batches

#: End-of-document and padding ids, above those of the vocabulary. As two bytes each is a
#: letter of UTF-8, so that Spark's text sink can write it as the line separator.
END, PAD = 0xC480, 0xC481
#: Bytes of one block; files are padded to whole blocks.
BLOCK_BYTES = 1 << 18


def write_token_files(docs: DataFrame, vocab_path: str, path: str, block_bytes: int = BLOCK_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) and write one flat file per partition of the scan.

    The sink is Spark's own, so a lost or repeated task leaves no half file. The last
    document of a file is padding up to a whole block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for b in batches:
            ids = b.column(1)
            limits = ids.offsets.to_numpy()
            data = ids.values.to_numpy()
            if len(data) and int(data.max()) >= END:
                raise ValueError("token ids must be below the end-of-document id")
            wide = data.astype(">u2")
            rows = [wide[s:e].tobytes() for s, e in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True)]
            written += 2 * (int(limits[-1] - limits[0]) + len(rows))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])
        if written:
            fill = -(written + 2) % block_bytes or block_bytes
            yield pa.RecordBatch.from_arrays([pa.array([PAD.to_bytes(2, "big") * (fill // 2)], pa.binary())], ["value"])

    rows = encode(docs, vocab_path).mapInArrow(tidy_batches(run), "value binary")
    end = END.to_bytes(2, "big").decode("utf-8")
    rows.select(F.col("value").cast("string")).write.option("lineSep", end).text(path)


def scan_block(data: bytes, end: int = END, pad: int = PAD) -> tuple:
    """(ends, opens, head, tail, head_pads, tail_pads, starts, lengths) of one block.

    opens: place after the last end, -1 without one. head: tokens before the first end; tail:
    after the last one; both are all tokens if the block has no end; their paddings likewise.
    starts and lengths are of the documents that lie wholly inside. All separators are found
    in one vectorised comparison.
    """
    ids = np.frombuffer(data, ">u2")
    ends = np.flatnonzero(ids == end)
    real = np.r_[0, np.cumsum((ids != pad) & (ids != end))]
    pads = np.r_[0, np.cumsum(ids == pad)]
    n, p = int(real[-1]), int(pads[-1])
    if not len(ends):
        return 0, -1, n, n, p, p, [], []
    first, last = ends[0], ends[-1]
    lengths = real[ends[1:]] - real[ends[:-1]]
    full = (lengths > 0) | (np.diff(ends) == 1)  # a document of nothing but padding is none
    return (
        len(ends), int(last) + 1, int(real[first]), n - int(real[last]), int(pads[first]), p - int(pads[last]),
        (ends[:-1][full] + 1).tolist(), lengths[full].tolist())


def token_counts(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, end: int = END, pad: int = PAD) -> DataFrame:
    """One row per document of the token files in ``path``: file_no, start, n_tokens.

    Files count from 0 in order of their names; ``start`` is the place of the document's first
    token in its file, which with n_tokens makes an index. Empty documents have a row too.

    Blocks are read wherever Hadoop puts the splits, so a file of any size is shared out. Each
    block yields its inner documents and a summary of a few numbers. A prefix scan over the
    summaries of a file (one small row per block) tells each block how many tokens of the
    document that is open at its beginning came before, and where that document began.

    Defined cases: a document without an end id at the end of a file counts; padding does not,
    nor does a document of nothing but padding; files must hold whole blocks; without files
    the result is empty.
    """
    schema = (
        "part int, seq bigint, block bigint, ends bigint, opens bigint, head bigint, tail bigint, head_pads bigint, tail_pads bigint, "
        "starts array<bigint>, lengths array<bigint>")
    files = [r[0] for r in spark.read.format("binaryFile").load(path).select("path").collect()]  # names only
    if not files:
        return spark.createDataFrame([], "file_no bigint, start bigint, n_tokens bigint")
    files.sort(key=lambda f: f.rsplit("/", 1)[-1])
    blocks = spark.sparkContext.newAPIHadoopFile(
        ",".join(files), "org.apache.spark.input.FixedLengthBinaryInputFormat", "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.BytesWritable", conf={"org.apache.spark.input.FixedLengthBinaryInputFormat.recordLength": str(block_bytes)})

    def scan(part, records):
        for seq, (block, data) in enumerate(records):
            base = block * (block_bytes // 2)
            ends, opens, *sums, starts, lengths = scan_block(bytes(data), end, pad)
            yield part, seq, block, ends, base + opens if ends else -1, *sums, [base + s for s in starts], lengths

    found = spark.createDataFrame(blocks.mapPartitionsWithIndex(scan), schema)
    return stitched(found)


def stitched(found: DataFrame) -> DataFrame:
    """Documents of scanned blocks; the first block of each file has number 0."""
    # Splits come in order of files; a file begins at each block 0.
    firsts = found.groupBy("part").agg(F.count_if(F.col("block") == 0).alias("n"))
    firsts = firsts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("own", F.count_if(F.col("block") == 0).over(in_part)).join(firsts, "part")
    found = found.withColumn("file_no", F.col("before") + F.col("own") - 1)

    upto = Window.partitionBy("file_no").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.col("ends") > 0

    def since_last_end(name: str):
        """Sum over the blocks before, from the tail of the last block with an end on."""
        return F.col(f"run_{name}") - F.coalesce(F.last(F.when(ended, F.col(f"run_{name}")), ignorenulls=True).over(upto), F.lit(0))

    for name in ("tail", "tail_pads"):
        found = found.withColumn(f"run_{name}", F.coalesce(F.sum(name).over(upto), F.lit(0)))
    found = found.withColumn("carry", since_last_end("tail")).withColumn("carry_pads", since_last_end("tail_pads"))
    found = found.withColumn("opened", F.coalesce(F.last(F.when(ended, F.col("opens")), ignorenulls=True).over(upto), F.lit(0)))
    found = found.withColumn("last", F.row_number().over(Window.partitionBy("file_no").orderBy(F.desc("block"))) == 1)
    inner = found.select("file_no", F.explode(F.arrays_zip("starts", "lengths")).alias("d")).select(
        "file_no", F.col("d.starts").alias("start"), F.col("d.lengths").alias("n_tokens"))
    first = found.filter(ended).select(
        "file_no", F.col("opened").alias("start"), (F.col("carry") + F.col("head")).alias("n_tokens"), (F.col("carry_pads") + F.col("head_pads")).alias("pads"))
    first = first.filter("n_tokens > 0 OR pads = 0").drop("pads")
    open_ = found.filter("last").select(
        "file_no", F.when(ended, F.col("opens")).otherwise(F.col("opened")).alias("start"),
        F.when(ended, F.col("tail")).otherwise(F.col("carry") + F.col("tail")).alias("n_tokens")).filter("n_tokens > 0")
    return inner.unionByName(first).unionByName(open_)
