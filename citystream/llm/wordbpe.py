"""BPE encoding and decoding through a distinct-word table.

``word_counts`` splits whole texts into words in Spark and counts them over
the whole corpus.  ``word_table`` encodes each distinct word of the table
once, on the executors; ``encode`` then joins ids back by position: a text's
words become row numbers of the table, and the numbers become ids by one
gather per batch.  ``decode`` is a join of ids with the id-to-piece table.

Bounded memory, exact for every size: the table that is shipped holds the
words that occur at least ``c`` times, with the smallest ``c`` that leaves at
most ``TABLE_WORDS`` of them (a count histogram gives ``c``, nothing is cut
off inside a count).  The number of different words grows without end, so
rarer ones are encoded where they stand, once per worker table, by the same library
call -- sending all positions of all words through a shuffle and back would
move several times the corpus (see README).

Null text counts as empty: no ids, empty decoded text.  Special tokens' texts
are special ids, as in the library.  Repeated rows are encoded each; other
columns of the input are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm import bpe
from citystream.llm.common import read, small_batches, stored, trimmed

#: Most words in the shipped table: about 10 MB packed.
TABLE_WORDS = 250_000


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, count) of all blank-separated words of all texts."""
    return (docs.select(F.explode(F.split(F.col(text), " ", -1)).alias("word"))
            .where("word <> ''").groupBy("word").count())


def _encode_words(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = bpe.load(tokenizer)
        for b in batches:
            got = [e.ids for e in tok.encode_batch_fast(b.column(0).to_pylist(),
                                                        add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(got, pa.list_(pa.int32()))], ["word", "ids"])
    return run


def word_table(docs: DataFrame, tokenizer: str, limit: int = TABLE_WORDS) -> DataFrame:
    """(word, ids): each distinct word that occurs in the count classes that fit ``limit``,
    encoded once."""
    counts = stored(word_counts(docs), "word-counts")
    # Counts fall into classes of an eighth of a power of two: a few hundred
    # rows for any corpus.  Take whole classes from the top while they fit.
    level = F.floor(8 * F.log2(F.col("count").cast("double"))).cast("int")
    hist = counts.groupBy(level.alias("c")).agg(F.count("*").alias("n")).orderBy(F.desc("c"))
    least, total = 1 << 20, 0
    for r in hist.collect():
        total += r["n"]
        if total > limit:
            break
        least = r["c"]
    return (counts.where(level >= least).select("word")
            .mapInArrow(trimmed(_encode_words(tokenizer)), "word string, ids array<int>"))


def _encoder(tokenizer: str, shipped, text: int, by_id=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tab = bpe.table(tokenizer)
        words, counts, flat = shipped.value
        if getattr(tab, "seeded", None) != shipped.id:
            tab.seed(words, counts, flat)
            tab.seeded = shipped.id
        for b in batches:
            texts = [t or "" for t in b.column(text).to_pylist()]
            for lo, hi in bpe.slices(texts):
                ids, n = tab.encode(texts[lo:hi])
                offs = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                cols = [*(c.slice(lo, hi - lo) for c in b.columns),
                        pa.ListArray.from_arrays(pa.array(offs), pa.array(ids, pa.int32()))]
                names = [*b.schema.names, "ids"]
                if by_id is not None:
                    cols.append(_join_pieces(ids, offs, by_id.value))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def _join_pieces(ids: np.ndarray, offs: np.ndarray, by_id: list) -> pa.Array:
    """ids -> text: the join with the id-to-piece table, one lookup a position."""
    found = list(map(by_id.__getitem__, ids.tolist()))
    return pa.array([" ".join(found[i:j]) for i, j in zip(offs, offs[1:])], pa.string())


class _Shipped:
    """A broadcast of the packed table with an id that workers compare."""

    def __init__(self, spark, words, counts, flat):
        self.data = spark.sparkContext.broadcast((words, counts, flat))
        self.id = hashlib.sha256(repr((len(words), words[:50], words[-50:], int(flat.sum()))
                                      ).encode()).hexdigest()

    @property
    def value(self):
        return self.data.value


def ship(table: DataFrame) -> _Shipped:
    """Pack the bounded table and broadcast it."""
    got = table.toArrow()
    words = got.column("word").to_pylist()
    lists = got.column("ids").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    counts = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int32)
    return _Shipped(table.sparkSession, words, counts, flat)


def _fields(df: DataFrame, *more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + list(more))


def encode(docs: DataFrame, tokenizer: str, text: str = "text",
           table: DataFrame | None = None, decoded: bool = False) -> DataFrame:
    """``docs`` plus ``ids`` (array<int>), the library's ids of the whole text;
    with ``decoded`` also what ``decode`` adds, in the same pass.  Columns of
    these names are replaced."""
    table = table if table is not None else word_table(
        docs.select(F.col(text).alias("text")), tokenizer)
    docs = docs.drop("ids", "decoded")
    by_id = _shipped_pieces(docs.sparkSession, tokenizer) if decoded else None
    more = ["`ids` array<int>"] + ["`decoded` string"] * decoded
    return docs.mapInArrow(trimmed(_encoder(tokenizer, ship(table), docs.columns.index(text), by_id)),
                           _fields(docs, *more))


def pieces(spark: SparkSession, tokenizer: str) -> DataFrame:
    """The id-to-piece table (id, piece): as many rows as the vocabulary has."""
    vocab = bpe.load(tokenizer).get_vocab(with_added_tokens=True)
    return spark.createDataFrame([(i, p) for p, i in vocab.items()], "id int, piece string")


def _shipped_pieces(spark: SparkSession, tokenizer: str):
    tok = bpe.load(tokenizer)
    size = max(tok.get_vocab(with_added_tokens=True).values()) + 1
    return spark.sparkContext.broadcast([tok.id_to_token(i) or "" for i in range(size)])


def _decoder(by_id, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(at)
            offs = np.concatenate([[0], np.cumsum(col.value_lengths().fill_null(0).to_numpy())])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, _join_pieces(col.flatten().to_numpy(zero_copy_only=False), offs,
                                          by_id.value)], [*b.schema.names, "decoded"])
    return run


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` plus ``decoded``: pieces of ``ids`` joined by one blank (the
    vocabulary file names no decoder).  The id-to-piece table is as large as
    the vocabulary, so every task holds it: a map-side join by id."""
    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(
        _decoder(_shipped_pieces(encoded.sparkSession, tokenizer), encoded.columns.index("ids")),
        _fields(encoded, "`decoded` string"))


def decode_by_join(encoded: DataFrame, tokenizer: str, key: str) -> DataFrame:
    """The same decoding as DataFrame operations, for ids that already lie one
    a row: (key, pos, id) -> (key, decoded)."""
    vocab = F.broadcast(pieces(encoded.sparkSession, tokenizer))
    return (encoded.join(vocab, "id")
            .groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "piece"))).alias("p"))
            .select(key, F.concat_ws(" ", F.col("p.piece")).alias("decoded")))


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    small_batches(docs.sparkSession)
    both = encode(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                  tokenizer, decoded=True)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return digests(read(spark, sf_dir, "documents"),
                   public_tokenizers.path("word_bpe_49k.json"))
