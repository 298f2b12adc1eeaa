"""Token ids as ORC files, and their digests read back from the files.

Documents are range-partitioned and sorted by id first and encoded after that,
so the shuffle moves texts and the ids go straight from the encoder to the
files.  File order is id order.  ORC stores the ids as run-length encoded
integer streams in stripes; each file carries a row index and a Bloom filter on
``doc_id``.  Stripes are read in parallel, and a filter on ``doc_id`` skips
files, stripes and row groups by that metadata.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basalt.llm.bpe import MEMO_LENGTH, Memo, words
from basalt.llm.common import materialize, prepare, text_of

END_ID = 2
#: A blank with white space after it (RE2; all characters that Unicode or Python call white space).
ODD_SPACE = r" [\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
STRIPE_BYTES, INDEX_ROWS = 16 << 20, 2_000
ORC_OPTIONS = {
    "compression": "zstd", "orc.stripe.size": str(STRIPE_BYTES), "orc.row.index.stride": str(INDEX_ROWS),
    "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
}
FILE_SCHEMA = "doc_id long, seq long, ids array<int>"


class WordEncoder:
    """The tokenizers library behind a bounded memo of words.

    Texts are cut at blanks and the words of a batch numbered by Arrow's
    dictionary encoding; the library encodes each distinct new word (with its
    leading blank) once, and the ids of the texts are gathered from those of the
    words.  Words end where the byte-level pattern always ends a pre-token, so the
    gathered ids are those of the whole text; texts in which other white space
    follows a blank are cut by the stricter rule of :func:`basalt.llm.bpe.words`.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.memo = Memo()

    def _ids(self, found: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit bytes."""
        young, old = self.memo.young, self.memo.old
        known = {w: young.get(w) for w in found}
        rest = [w for w, ids in known.items() if ids is None]
        new = []
        for w in rest:
            if (ids := old.get(w)) is None:
                new.append(w)
            else:
                known[w] = young[w] = ids
        for w, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            ids = known[w] = array("I", e.ids).tobytes()
            if len(w) <= MEMO_LENGTH:
                young[w] = ids
        return [known[w] for w in found]

    def encode_batch(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """The ids of each text and ``end_id``."""
        import numpy as np

        n = len(texts)
        strict = pc.match_substring_regex(texts, ODD_SPACE)
        odd = {int(i): words(texts[int(i)].as_py()) for i in np.flatnonzero(strict.to_numpy(zero_copy_only=False))}
        parts = pc.split_pattern(pc.if_else(strict, "", texts), " ")
        stops = parts.offsets.to_numpy()
        flat = parts.flatten()
        coded = flat.dictionary_encode()
        first = flat.take(pa.array(stops[:-1])).to_pylist()
        heads = self._ids([w for w in first if w])
        tail = iter(heads)
        units = self._ids(pc.binary_join_element_wise("", coded.dictionary, " ").to_numpy(zero_copy_only=False).tolist())
        rare = {i: b"".join(self._ids(ws)) for i, ws in odd.items()}
        units += [rare[i] if i in rare else next(tail) if w else b"" for i, w in enumerate(first)]
        units.append(np.asarray([end_id], "<u4").tobytes())
        at = coded.indices.to_numpy().astype(np.int64)
        at[stops[:-1]] = len(units) - 1 - n + np.arange(n)  # the first part has no blank before it
        at = np.insert(at, stops[1:], len(units) - 1)
        self.memo.age()
        lengths = np.zeros(len(units) + 1, np.int32)
        np.cumsum([len(u) // 4 for u in units], out=lengths[1:])
        lists = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.frombuffer(b"".join(units), "<u4").astype(np.int32)))
        out = lists.take(pa.array(at))
        return pa.ListArray.from_arrays(out.offsets.take(pa.array(stops + np.arange(n + 1))), out.flatten())


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process."""
    path = path if os.path.exists(path) else SparkFiles.get(path)
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_tokens(df: DataFrame, out: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID) -> None:
    """Write (doc_id, seq, ids) as ORC files to ``out``, in ascending id order.

    Every text is encoded whole without special tokens and closed by ``end_id``;
    null counts as empty.  ``seq`` numbers the rows of a file.  Null ids come
    first; rows that repeat an id are ordered by a hash of their text.
    """
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        enc, seq = encoder(tokenizer), 0
        for batch in batches:
            n = batch.num_rows
            if n:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.arange(seq, seq + n)), enc.encode_batch(batch.column(1), end_id)],
                    names=["doc_id", "seq", "ids"])
            seq += n

    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    ordered = (docs.withColumn("tie", F.xxhash64("t")).repartitionByRange("doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie").select("doc_id", "t"))
    ordered.mapInArrow(run, FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(out)


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The rows of token files (doc_id, seq, ids, file); ``doc_ids`` reads only
    the row groups whose index and Bloom filter admit one of them."""
    df = spark.read.schema(FILE_SCHEMA).orc(path)
    if doc_ids is not None:
        df = df.where(F.col("doc_id").isin(doc_ids))
    return df.select("doc_id", "seq", "ids", F.col("_metadata.file_name").alias("file"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of token files: doc_id, start, n_tokens, ids_crc32.

    ``start`` is the number of ids of all documents before it: a running sum
    inside each file, on top of the totals of the files before (one row a file).
    """
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            ids = batch.column(3)
            offsets = ids.offsets.to_numpy()
            raw = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(offsets).astype(np.int64)),
                 pa.array(crc, pa.int64())], names=["doc_id", "seq", "file", "n_tokens", "ids_crc32"])

    rows = materialize(read_tokens(spark, path).select("doc_id", "seq", "file", "ids")
                       .mapInArrow(run, "doc_id long, seq long, file string, n_tokens long, ids_crc32 long"), "token-rows")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = (rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
             .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start")))
    inside = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(files, "file")
            .select("doc_id", (F.col("file_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))
