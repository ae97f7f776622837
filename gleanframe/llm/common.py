"""Pieces that several operators of this package share: staged tables, words as bytes, word
hashes, and a bounded sample of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gleanframe.session import shared_path, ship_package

#: a-z, 0-9 and every byte above 0x7F stay, A-Z is lowered, all else becomes a blank.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
              else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_MOST_CACHED = 300_000            # words a Python worker remembers; then it starts anew


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the cluster's shared folder and read back.

    Later readers, and tasks repeated after a lost executor, see the very same rows in the
    same partitions, and nothing before is computed again.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._gleanframe_path = path
    return back


def release(*tables: DataFrame) -> None:
    """Deletes tables that `staged` wrote, once nothing that is still to be computed reads them."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._gleanframe_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def joined_unequal(left: DataFrame, right: DataFrame, key: str, size: str, most: int = 50_000) -> DataFrame:
    """left join of `right`, whose rows are unique by `key` and say in `size` how many rows of left have it.

    Keys of more than `most` rows are broadcast, at most rows of left / `most` of them, and their rows
    stay where they are; the others are shuffled, at most `most` rows to a key. A null key meets
    nothing and is not shuffled either.
    """
    heavy = F.broadcast(right.where(F.col(size) > most))
    hot = left.join(heavy, key, "inner")
    rest = left.where(F.col(key).isNotNull()).join(heavy.select(key), key, "left_anti").join(
        right.where(F.col(size) <= most), key, "left")
    return hot.unionByName(rest).unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)


def dense_ids(df: DataFrame, *by: str, buckets: int = 1_024) -> DataFrame:
    """Adds `id`, from 1 without gaps, to rows that are unique by the columns `by`: ranks inside hash buckets
    and the rows of the buckets before (`buckets` rows, broadcast)."""
    bucket = F.pmod(F.xxhash64(*by), F.lit(buckets))
    sizes = df.groupBy(bucket.alias("_b")).agg(F.count("*").alias("_n"))
    before = sizes.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_b").orderBy(*by))
    return (df.withColumn("_b", bucket).withColumn("_nth", nth).join(F.broadcast(before), "_b")
            .withColumn("id", F.col("_before") + F.col("_nth")).drop("_b", "_nth", "_before"))


def text_bytes(column: str = "text"):
    """The text as UTF-8 bytes; null gives no bytes."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(bytearray()))


def blank_words(text: bytes) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of a text, as written."""
    return text.split()


def lowered_words(text: bytes) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ after lowering A-Z."""
    return text.lower().split()


def folded_words(text: bytes) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lowering A-Z."""
    return text.translate(_FOLD).split()


class Cached(dict):
    """A function of a word, remembered for the words that came lately in this worker.

    Two generations of at most `most` words: a full young one becomes the old one, from which
    words that come again are taken back. So frequent words stay and memory is bounded.
    """

    def __init__(self, compute: Callable[[bytes], object], most: int = _MOST_CACHED):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, word):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        self[word] = value
        return value

    def array(self, words: list[bytes], dtype=np.uint64) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=dtype, count=len(words))


class _WordHash:
    """64-bit hashes of words. Computing one is cheaper than looking it up, so none is remembered."""

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


WORD_HASH = _WordHash()

_MIX = np.uint64(0x9E3779B97F4A7C15)
_S29, _S32 = np.uint64(29), np.uint64(32)


def mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values from 64-bit values, one to one."""
    values = (values ^ (values >> _S32)) * _MIX
    values = (values ^ (values >> _S29)) * _MIX
    return values ^ (values >> _S32)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of `size` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, factor = np.zeros(n, np.uint64), 1
    for i in range(size):
        factor = factor * 0x9E3779B97F4A7C15 % 2 ** 64 | 1
        total += words[i:i + n] * np.uint64(factor)
    return mixed(total)


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.view(np.int64)


def sliced(batch: pa.RecordBatch, at_once: int | None) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most `at_once` rows."""
    step = at_once or max(1, batch.num_rows)
    return (batch.slice(i, step) for i in range(0, batch.num_rows, step))


def per_batch(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str,
              at_once: int | None = None) -> DataFrame:
    """Arrow batches, or pieces of `at_once` rows of them, through `rows`, which returns the columns of the result."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in sliced(batch, at_once):
                made = rows(piece)
                yield pa.RecordBatch.from_arrays(
                    [made[f.name] if isinstance(made[f.name], pa.Array)
                     else pa.array(made[f.name], f.type, from_pandas=False) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def where_text(docs: DataFrame, verdict: Callable[[list[bytes]], np.ndarray], at_once: int = 500) -> DataFrame:
    """The rows whose text passes `verdict` (texts to booleans), as they are.

    Only texts go to Python and only verdicts come back, `at_once` texts at a time; whole rows stay
    in the JVM.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            made = [np.asarray(verdict(texts.slice(i, at_once).to_pylist()), bool) for i in range(0, len(texts), at_once)]
            yield pa.array(np.concatenate(made) if made else np.zeros(0, bool))

    return docs.where(F.arrow_udf(run, "boolean")(text_bytes()))


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


#: Bits of the table that says which doc_ids have a label (2 MB).
LABELLED_BITS = 1 << 24


def labelled_rows(docs: DataFrame, labels: DataFrame, columns: list[str], rows: Callable[[list[bytes]], dict], schema: str,
                  name: str) -> DataFrame:
    """Every labelled row, one per doc_id: doc_id, `columns` and what `rows` makes of its whole text. Staged.

    A doc_id with several labels takes the largest of each, one with several texts that of the least hash. Labels
    that lack one of `columns`, and null ids, are left out. Texts never leave the task that reads them: `rows` is applied
    there to those whose doc_id is in a bit table of fixed size, and only what it makes meets the labels.
    """
    from gleanframe.llm.decontaminate import _bit_table

    one = labels.dropna(subset=["doc_id", *columns]).groupBy("doc_id").agg(*[F.max(c).cast("long").alias(c) for c in columns])
    own = [c for c in docs.columns if c in ("text", "lang")]
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(LABELLED_BITS))
    # Ids of two types have two hashes, so every text is made smaller then.
    table = (_bit_table(one.select(bit.alias("bit")), "bit", LABELLED_BITS)
             if one.schema["doc_id"].dataType == docs.schema["doc_id"].dataType else None)
    texts = docs.select("doc_id", F.xxhash64(*own).alias("_h"), bit.alias("_bit"), text_bytes().alias("_text"))
    made = [f.split()[0] for f in schema.split(", ")]

    def run(batch: pa.RecordBatch) -> dict:
        if table is not None:
            at = batch.column(2).to_numpy()
            batch = batch.filter(pa.array(table[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0, pa.bool_()))
        return {"doc_id": batch.column(0), "_h": batch.column(1), **rows(column(batch, "_text"))}

    key = texts.schema["doc_id"].dataType.simpleString()
    each = per_batch(texts, run, f"doc_id {key}, _h long, " + schema, 500).join(one, "doc_id")
    first = F.min(F.struct("_h", *made)).alias("_m")
    return staged(each.groupBy("doc_id", *columns).agg(first).select("doc_id", *columns, *[f"_m.{c}" for c in made]), name)


def nth_value(df: DataFrame, column: str, n: int) -> float:
    """The value at place `n` (from 0) of a column of numbers from 0 to 1, in ascending order: exact.

    Rows are counted by 65,536 steps, then by as many inside the step that holds the place; last its own
    distinct values are counted. Reads `df` three times.
    """
    inside, at = df.select(F.col(column).alias("v")).withColumn("_rest", F.col("v")), n
    for _ in range(2):
        step = F.least(F.floor(F.col("_rest") * 65_536), F.lit(65_535))
        for r in sorted(inside.groupBy(step.alias("s")).count().collect()):                  # <= 65,536 rows
            if at < r["count"]:
                break
            at -= r["count"]
        inside = inside.where(step == r["s"]).withColumn("_rest", F.col("_rest") * 65_536 - r["s"])
    for r in sorted(inside.groupBy("v").count().collect()):                                  # of one step in 2^32
        if at < r["count"]:
            break
        at -= r["count"]
    return r["v"]


#: Bytes of a text that a model may be fitted to at most, so that a sample has a bound in bytes too.
LONGEST_SAMPLED = 32_768


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int, columns: list[str], within: str = "true",
                    longest: int = LONGEST_SAMPLED) -> DataFrame:
    """At most `most` labelled rows of each value of `within`, one per doc_id, chosen by a hash of doc_id.

    The result has doc_id, text (and lang, where docs has it) and `columns`: at most `most` rows a value of `within`
    and `longest` bytes a row, whatever the tables hold; longer texts are left out of the sample. The bound
    is on what a model is fitted to; everything else covers all rows. A doc_id with several labels takes the largest of
    each, one with several texts that of the least hash. The chosen labels are few by that bound, which
    bounds their broadcast. `within` is an SQL condition, so it has two values at most.
    """
    usable = labels.dropna(subset=["doc_id", *columns])
    one = usable.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in columns])
    parts = [one.where(f"({within}) = {side}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
             for side in (["true"] if within == "true" else ["true", "false"])]
    chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    own = [c for c in docs.columns if c in ("text", "lang")]
    texts = docs.select("doc_id", *own).where(F.octet_length(F.coalesce("text", F.lit(""))) <= longest)
    # Tasks keep one row of a doc_id before anything is shuffled, however often it comes.
    return (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", *columns)
            .agg(F.min(F.struct(F.xxhash64(*own).alias("_h"), *own)).alias("_m"))
            .select("doc_id", *[f"_m.{c}" for c in own], *columns))
