"""Token counts of documents by a separator scan of flat token files.

``write_tokens`` tokenises texts into flat files of token ids in which every
document ends with one end-of-document id; there is no index. ``scan`` cuts the
files into blocks of equal size, finds the separators of each block at once
with numpy, and stitches documents that span blocks by prefix scans over the
blocks of a file: how many separators lie before a block, and where the last of
them is.

Defined cases: null and empty texts have 0 tokens; a special token's string
in a text is ordinary text; tokens after the last separator of a file form one
more document (unended); empty files and tables have no documents.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import utf8
from strata.llm.files import create, filesystem, open_file

# A public byte-level BPE's ranks and the pattern that splits text before its merges (fixed value).
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_DOCUMENT = 50256
MAX_FILE_BYTES = 256 << 20
BLOCK_BYTES = 4 << 20
DTYPE = "<u2"  # wide enough for 65,536 ids


def encoding(ranks: str = RANKS):
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def write_tokens(docs: DataFrame, folder: str, ranks: str = RANKS, end: int = END_OF_DOCUMENT, max_file_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Write token files; (file, ordinal, doc_id) per document. Stage the result: each evaluation writes anew."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out, uri, size, ordinal = encoding(ranks), None, "", 0, 0
        try:
            for batch in batches:
                names, ordinals = [], []
                for text in batch.column("text").to_pylist():
                    if out is None:
                        uri, out = create(folder, "tokens", ".bin")
                        size = ordinal = 0
                    ids = enc.encode_ordinary(text.decode())
                    ids.append(end)
                    data = np.array(ids, DTYPE).tobytes()
                    out.write(data)
                    names.append(uri)
                    ordinals.append(ordinal)
                    size, ordinal = size + len(data), ordinal + 1
                    if size >= max_file_bytes:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ordinals, pa.int64()), batch.column("doc_id")], names=["file", "ordinal", "doc_id"])
        finally:
            if out is not None:
                out.close()

    rows = docs.select("doc_id", utf8(F.col("text")).alias("text"))
    return rows.mapInArrow(write, f"file string, ordinal long, doc_id {rows.schema['doc_id'].dataType.simpleString()}")


def scan(token_files: DataFrame, end: int = END_OF_DOCUMENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, n_tokens, ended) of every document in the files named in column ``file``."""
    width = np.dtype(DTYPE).itemsize
    step = block_bytes // width

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("file").to_pylist()
            found = []
            for uri in names:
                store, path = filesystem(uri)
                found.append(store.get_file_info(path).size // width)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.int64())], names=["file", "length"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, stop in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "stop")), strict=True):
                with open_file(uri) as f:
                    f.seek(start * width)
                    ids = np.frombuffer(f.read((stop - start) * width), DTYPE)
                at = np.flatnonzero(ids == end) + start
                last = int(at[-1]) if len(at) else None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri]), pa.array([start], pa.int64()), pa.array([stop], pa.int64()), pa.array([len(at)], pa.int64()),
                     pa.array([last], pa.int64()), pa.array([at], pa.list_(pa.int64()))], names=["file", "start", "stop", "n_ends", "last_end", "ends"])

    blocks = (token_files.select("file").distinct().mapInArrow(sizes, "file string, length long").where("length > 0")
              .withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))))
              .withColumn("stop", F.least(F.col("start") + step, F.col("length"))))
    marks = (blocks.repartition("file", "start")
             .mapInArrow(find, "file string, start long, stop long, n_ends long, last_end long, ends array<long>"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    final = F.lead("start").over(Window.partitionBy("file").orderBy("start")).isNull()
    stitched = (marks.withColumn("n_before", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
                .withColumn("end_before", F.coalesce(F.max("last_end").over(before), F.lit(-1)))
                .withColumn("ends", F.when(final & (F.coalesce(F.col("last_end"), F.col("end_before")) < F.col("stop") - 1),
                                           F.concat("ends", F.array("stop"))).otherwise(F.col("ends"))))
    previous = F.when(F.col("i") == 0, F.col("end_before")).otherwise(F.try_element_at("ends", F.col("i")))
    return (stitched.select("file", "stop", "n_before", "end_before", "ends", F.posexplode("ends").alias("i", "at"))
            .select("file", (F.col("n_before") + F.col("i")).alias("ordinal"), (F.col("at") - previous - 1).alias("n_tokens"), (F.col("at") < F.col("stop")).alias("ended")))


def count(docs: DataFrame, folder: str, ranks: str = RANKS) -> DataFrame:
    """doc_id and n_tokens of every document: written, scanned and matched by place."""
    from strata.sinks.writer import stage

    written = stage(write_tokens(docs, folder, ranks), "token-files")
    # both sides grow with the documents: never broadcast, however small dictionary coding makes the file look
    return scan(written.select("file")).join(written.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")
