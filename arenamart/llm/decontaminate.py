"""Benchmark decontamination: a broadcast hash set of test n-grams against all token windows.

Words are runs of ASCII letters and digits and of any non-ASCII character, with A-Z lower-cased. A
window is ``n`` consecutive words of a benchmark item; a shorter item with a word is one window. For every
window of a document, the hash of its first words is looked up in a table of bits; where a test window may
start, the whole window is hashed, looked up in the broadcast set, and a hit is verified on its words.

Defined results: a null or wordless text has no words and no hits; a null or wordless item has no
windows; an item without id marks words but is not counted as an item; repeated document rows each
get the same result; an empty benchmark leaves every document clean; extra columns are ignored by
``contamination`` and kept by the removers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenamart.llm.common import ascii_lower, broadcast_slices, read, stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before lower-casing: A-Z belong to words.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
#: Benchmark windows in one broadcast; about 150 bytes each, so below 100 MB.
WINDOWS_PER_BROADCAST = 500_000
#: First words of a window that are looked up before the whole window is hashed.
HEAD = 3


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _gram(words: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(length)])


def _bit_table(part: DataFrame, length: int) -> tuple[Column, int]:
    """Bits of the hashed window starts as one literal array, and their number: 16 a start or more."""
    heads = [h for (h,) in part.select(_gram(F.col("_window"), F.lit(0), min(length, HEAD))).distinct().collect()]  # bounded as the broadcast is
    size = 1 << max(10, (16 * len(heads)).bit_length())
    table = [0] * (size // 64)
    for head in heads:
        place = head % size
        table[place // 64] |= 1 << place % 64
    signed = (str(x - (1 << 64) if x >> 63 else x) for x in table)
    return F.split(F.lit(",".join(signed)), ",").cast("array<bigint>"), size


def _starts(words: Column, length: int, table: Column, size: int) -> Column:
    """Places where the first words of some window may stand: one look into the bit table each."""

    def known(at: Column) -> Column:
        place = F.pmod(_gram(words, at, min(length, HEAD)), F.lit(size))
        bits = F.get(table, F.shiftright(place, 6).cast("int"))
        return F.call_function("shiftrightunsigned", bits, (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1

    last = F.size(words) - length
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), known)).otherwise(F.array().cast("array<int>"))


def item_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct windows: hash, length, words, ids (as strings) of the items that hold it."""
    words = F.col("_words")
    items = benchmark.select(F.col("item_id").cast("string").alias("_item"), words_of(F.col("text")).alias("_words"))
    items = items.where(F.size(words) > 0).withColumn("_len", F.least(F.lit(n), F.size(words)))
    starts = items.select(
        "_item", "_words", "_len", F.explode(F.sequence(F.lit(1), F.size(words) - F.col("_len") + 1)).alias("_from")
    )
    windows = starts.select("_item", "_len", F.slice("_words", F.col("_from"), F.col("_len")).alias("_window"))
    return windows.groupBy("_len", "_window").agg(F.collect_set("_item").alias("_items"))


def _row_key() -> list[Column]:
    """Equal rows share a key, and with it their result."""
    return [F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text")]


def occurrences(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Verified hits: row key (_id, _text), first word (from 0), length, item ids."""
    windows = stored(item_windows(benchmark, n), "test-windows")
    lengths = [r[0] for r in windows.select("_len").distinct().collect()]  # n values at most
    words = docs.select(*_row_key(), words_of(F.col("text")).alias("_words"))
    found = []
    for length in sorted(lengths):
        own = windows.where(F.col("_len") == length).withColumn("_hash", _gram(F.col("_window"), F.lit(0), length))
        for part in broadcast_slices(own, "_hash", WINDOWS_PER_BROADCAST):
            table, size = _bit_table(part, length)
            starts = words.select("_id", "_text", "_words", F.explode(_starts(F.col("_words"), length, table, size)).alias("_at"))
            placed = starts.withColumn("_hash", _gram(F.col("_words"), F.col("_at"), length))
            hit = placed.join(F.broadcast(part), "_hash")
            same = F.slice("_words", F.col("_at") + 1, F.lit(length)) == F.col("_window")
            found.append(hit.where(same).select("_id", "_text", "_at", "_len", "_items"))
    if not found:
        return docs.sparkSession.createDataFrame([], "_id bigint, _text bigint, _at int, _len int, _items array<string>")
    return reduce(DataFrame.union, found)


def _hit_words(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """Per row key with hits: sorted places of hit words, sorted ids of items that occur."""
    hits = occurrences(docs, benchmark, n).groupBy("_id", "_text").agg(
        F.collect_set(F.struct("_at", "_len")).alias("_spans"), F.array_distinct(F.flatten(F.collect_set("_items"))).alias("_items")
    )
    places = F.flatten(F.transform("_spans", lambda s: F.sequence(s["_at"], s["_at"] + s["_len"] - 1)))
    return hits.select("_id", "_text", F.array_distinct(places).alias("_places"), F.array_sort("_items").alias("_items"))


def _with_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    same = F.col("_id").eqNullSafe(F.col("_hit_id")) & F.col("_text").eqNullSafe(F.col("_hit_text"))
    return rows.join(hits.withColumnsRenamed({"_id": "_hit_id", "_text": "_hit_text"}), same, "left")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document row."""
    n_words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(RAW_WORD)).cast("bigint")
    rows = docs.select(*_row_key(), n_words.alias("n_words"))
    hits = _hit_words(docs, benchmark, n).select(
        "_id", "_text", F.size("_places").alias("_n_hit"), F.size("_items").alias("_n_items"), F.array_join("_items", ",").alias("_joined")
    )
    joined = _with_hits(rows, hits)
    n_hit = F.coalesce("_n_hit", F.lit(0)).cast("bigint")
    return joined.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("_n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce("_joined", F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Documents without any hit, all columns kept."""
    hits = occurrences(docs, benchmark, n).select("_id", "_text").distinct()
    same = docs["doc_id"].eqNullSafe(hits["_id"]) & (F.xxhash64(docs["text"]) == hits["_text"])
    return docs.join(hits, same, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """All documents; hit words and what separates them from the next word leave the text."""
    columns = docs.columns
    hits = _hit_words(docs, benchmark, n).select("_id", "_text", "_places")
    joined = _with_hits(docs.select("text", *_row_key(), F.struct("*").alias("_row")), hits)
    pieces = F.regexp_extract_all("text", F.lit(f"({RAW_WORD}[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*)"), F.lit(1))
    lead = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    left = F.filter(F.transform(pieces, lambda p, i: F.struct(p.alias("p"), i.alias("i"))), lambda s: ~F.array_contains("_places", s["i"]))
    text = F.concat(lead, F.array_join(F.transform(left, lambda s: s["p"]), ""))
    new = F.when(F.col("_places").isNull(), F.col("text")).otherwise(text).alias("text")
    return joined.select(*[new if c == "text" else F.col("_row").getField(c).alias(c) for c in columns])


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_WORDS = (
    "list_filter(string_split_regex(translate(coalesce(text, ''), "
    f"'{_UPPER}', '{_LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)
OP4_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT item, w, least({WINDOW}, len(w)) AS n FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item, n, list_slice(w, s, s + n - 1) AS win
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM bw)),
lens AS (SELECT DISTINCT n FROM iw),
dl AS (SELECT r, i, list(x) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS ahead
  FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d)),
dw AS (SELECT r, n, i AS s, list_slice(ahead, 1, n) AS win FROM dl, lens WHERE len(ahead) >= n),
hit AS (SELECT r, dw.n, s, item FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS j FROM hit GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(j, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""
