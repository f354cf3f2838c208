"""Token counts from flat token files by a separator scan.

``write_tokens`` turns documents into flat files of 16-bit token ids in the shared folder, an
end-of-document id after each document, and no index.  ``count_tokens`` reads any such
files in blocks of fixed size: each block finds its separators with one vectorised
comparison and returns the lengths between them, and a prefix scan over the blocks of a file numbers
the documents and joins the pieces of those that cross blocks.

Defined cases: a null or empty text is a document of no tokens; tokens after the last
separator of a file are one more document if there are any; an empty file has none; the
spelling of the separator inside a text is ordinary text.  A task that is run again writes a
new file; only files named in the written manifest count.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyport.llm.words import pieces
from tallyport.runtime import default_partitions, settle_table, work_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
#: Tokens in a block.
BLOCK = 1 << 20
# Fixed value: how this vocabulary cuts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(path: str):
    """A byte-pair encoder from a file of ranks."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _write(batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, end: int) -> Iterator[pa.RecordBatch]:
    codes = encoder(vocabulary)
    system, root = pafs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}.bin"
    place = 0
    with system.open_output_stream(f"{root}/{name}") as out:
        for batch in pieces(batches, "text"):
            for text in batch.column("text").to_pylist():
                ids = codes.encode_ordinary(text or "")
                out.write(np.array([*ids, end], np.uint16).tobytes())
            count = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{folder}/{name}"] * count),
                    pa.array(np.arange(place, place + count)),
                    batch.column("doc_id"),
                ],
                names=["path", "place", "doc_id"],
            )
            place += count


def write_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """Write flat token files and return the manifest: ``path, place, doc_id``."""
    folder = work_path(docs.sparkSession, "tokens")
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    rows = narrow.mapInArrow(
        lambda it: _write(it, folder, vocabulary, end), f"path string, place long, doc_id {kind}"
    )
    return settle_table(rows, "manifest")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column("path").to_pylist()
        sizes = []
        for path in paths:
            system, name = pafs.FileSystem.from_uri(path)
            sizes.append(system.get_file_info(name).size // 2)
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], names=["path", "tokens"])


def _scan(batches: Iterator[pa.RecordBatch], end: int, block: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, begin in zip(batch.column("path").to_pylist(), batch.column("begin").to_pylist(), strict=True):
            system, name = pafs.FileSystem.from_uri(path)
            with system.open_input_file(name) as file:
                file.seek(begin * 2)
                ids = np.frombuffer(file.read(block * 2), np.uint16)
            ends = np.flatnonzero(ids == end)
            head = int(ends[0]) if len(ends) else len(ids)
            last = int(ends[-1]) + 1 if len(ends) else 0
            inside = np.diff(ends) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path]),
                    pa.array([begin], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([len(ends)], pa.int64()),
                    pa.array([head], pa.int64()),
                    pa.array([last], pa.int64()),
                    pa.array([inside], pa.list_(pa.int64())),
                ],
                names=["path", "begin", "n", "ends", "head", "last", "inside"],
            )


def count_tokens(paths: DataFrame, end: int = END, block: int = BLOCK) -> DataFrame:
    """``path, place, n_tokens`` of every document of the files in ``paths`` (``path``)."""
    files = paths.select("path").distinct().mapInArrow(_sizes, "path string, tokens long").where("tokens > 0")
    begins = files.select("path", F.explode(F.expr(f"sequence(0L, tokens - 1, {block}L)")).alias("begin"))
    kinds = "path string, begin long, n long, ends long, head long, last long, inside array<long>"
    # By number, so that blocks, which are narrow rows here, are not put together into a few tasks.
    dealt = begins.repartition(default_partitions(paths.sparkSession), "path", "begin")
    scanned = settle_table(dealt.mapInArrow(lambda it: _scan(it, end, block), kinds), "blocks")
    # One row per block: how many documents ended before it, and where the open one began.
    earlier = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    place = F.coalesce(F.sum("ends").over(earlier), F.lit(0))
    opened = F.coalesce(F.max(F.when(F.col("ends") > 0, F.col("begin") + F.col("last"))).over(earlier), F.lit(0))
    following = F.lead("begin").over(Window.partitionBy("path").orderBy("begin"))
    joined = scanned.select("*", place.alias("first"), opened.alias("opened"), following.isNull().alias("final"))
    whole = joined.where("ends > 0").select(
        "path", "first",
        F.posexplode(F.concat(F.array(F.col("begin") - F.col("opened") + F.col("head")), "inside")).alias("i", "n_tokens"),
    )
    done = whole.select("path", (F.col("first") + F.col("i")).alias("place"), "n_tokens")
    start = F.when(F.col("ends") > 0, F.col("begin") + F.col("last")).otherwise(F.col("opened"))
    tail = joined.where("final").select(
        "path", (F.col("first") + F.col("ends")).alias("place"), (F.col("begin") + F.col("n") - start).alias("n_tokens")
    )
    return done.union(tail.where("n_tokens > 0"))


def document_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every document.

    Both sides of the join have a row for each document, yet the counts come from blocks of a few
    bytes a document, so their size as Spark estimates it would send them all to the driver.
    """
    manifest = write_tokens(docs, vocabulary)
    counted = count_tokens(manifest).hint("merge")
    return manifest.join(counted, ["path", "place"]).select("doc_id", "n_tokens")
