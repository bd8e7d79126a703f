"""Problem 3: records that differ in formatting only, collapsed and counted.

The canonical form of a record is hashed once and written beside it, in segments by hash. For one segment after the other
every task notes the places that its hashes hit in a Bloom filter with two planes, one of places hit at least once and one of
places hit again; these places are merged block by block. A record whose places are all in the merged second plane may be
repeated and takes part in the exact grouping; all other records occur once and are never shuffled. A plane never exceeds
2 ** MOST_POWER bits: more records make more segments, not a fuller filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import spelling_key
from ..operators.skew import attach_groups
from ..session import computed, filled, free_name, table, written

#: Bits of a plane for each row, the bounds of its size as powers of 2 (the largest takes 32 MB), and places a hash hits.
BITS_PER_ROW, LEAST_POWER, MOST_POWER, PLACES = 16, 16, 28, 3
#: Bits of a block of the planes, which is what tasks merge; a place within a block takes two bytes. Rows noted at a time.
BLOCK_BITS, ROWS_AT_A_TIME = 1 << 16, 1 << 20
_MARKS = ["spelling_hash", "spelling_check", "spelling_segment"]


def _places(hashes: np.ndarray, power: int) -> np.ndarray:
    """The places that each hash hits, by double hashing: one row of PLACES for each."""
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64((1 << power) - 1)
    return np.stack([((h + np.uint64(k) * step) & mask).astype(np.int64) for k in range(PLACES)], axis=1)


def _note_places(power: int):
    """Per task: (block, once, again), the places within a block that its rows hit, and those that several rows hit."""

    def note(hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        places = _places(hashes, power)
        places.sort(axis=1)
        first = np.ones(places.shape, bool)
        first[:, 1:] = places[:, 1:] != places[:, :-1]  # equal places of one hash count once
        found, hits = np.unique(places[first], return_counts=True)
        blocks, starts = np.unique(found // BLOCK_BITS, return_index=True)
        inner, several = (found % BLOCK_BITS).astype(np.uint16), hits > 1
        ends = [*starts[1:], len(found)]
        once = [inner[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        again = [inner[a:b][several[a:b]].tobytes() for a, b in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(once, pa.binary()), pa.array(again, pa.binary())], ["block", "once", "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(batch.column(0).to_numpy(zero_copy_only=False))
            rows += batch.num_rows
            if rows >= ROWS_AT_A_TIME:
                yield from note(np.concatenate(waiting))
                waiting, rows = [], 0
        if rows:
            yield from note(np.concatenate(waiting))

    return run


def _merge_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the blocks that come to this task: what two tasks hit once each is hit again."""
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for block, once, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block not in kept:
                kept[block] = (np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool))
            o, a = kept[block]
            hit = np.frombuffer(once, np.uint16)
            a[hit[o[hit]]] = True
            a[np.frombuffer(again, np.uint16)] = True
            o[hit] = True
    for block, (_, a) in kept.items():
        if a.any():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(a).tobytes()], pa.binary())], ["block", "again"])


def plane_power(rows: int) -> int:
    return min(MOST_POWER, max(LEAST_POWER, int(np.ceil(np.log2(max(1, rows) * BITS_PER_ROW)))))


def repeat_filter(hashes: DataFrame, column: str, rows: int):
    """A broadcast (power, bits) of the places hit more than once by the hashes in `column`; `rows` is about their number."""
    spark = hashes.sparkSession
    power = plane_power(rows)
    noted = hashes.select(column).mapInArrow(_note_places(power), "block long, once binary, again binary")
    merged = noted.repartition("block").mapInArrow(_merge_places, "block long, again binary")
    bits = np.zeros(max(1 << power, BLOCK_BITS) // 8, np.uint8)
    for row in merged.toLocalIterator():
        bits[row.block * (BLOCK_BITS // 8) :][: BLOCK_BITS // 8] = np.frombuffer(row.again, np.uint8)
    return spark.sparkContext.broadcast((power, bits))


def may_repeat(known, column: Column) -> Column:
    """Whether every place of the hash is hit more than once."""

    @F.pandas_udf("boolean")
    def test(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        power, bits = known.value
        for batch in batches:
            at = _places(batch.to_numpy(np.int64), power)
            yield pd.Series(((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1).all(axis=1))

    return test(column)


def _hashed(df: DataFrame, key: Column, total: int, columns: list[str] | None = None) -> tuple[DataFrame, int]:
    """`columns` of `df` written with the hashes of `key` (two, together 128 bits) in segments; the number of segments."""
    segments = max(1, -(-total * BITS_PER_ROW // (1 << MOST_POWER)))
    name, (hashed, check, segment) = free_name(df, "spelling"), _MARKS
    rows = computed(df, {name: key})
    known = F.col(name).isNotNull()
    rows = rows.select(*(columns or df.columns), F.when(known, F.xxhash64(name)).alias(hashed), F.when(known, F.xxhash64(F.lit("check"), F.col(name))).alias(check))
    return written(rows.withColumn(segment, F.pmod(F.col(check), F.lit(segments)).cast("int")), [segment]), segments


def _split(rows: DataFrame, segments: int, total: int) -> tuple[DataFrame, DataFrame]:
    """(possible repeats, records that occur once) of rows that `_hashed` has written, one segment after the other."""
    hashed, _, segment = _MARKS
    possible, single = [], []
    for k in range(segments):
        own = rows.filter(F.col(segment) == k)
        marked = own.withColumn("spelling_repeats", may_repeat(repeat_filter(own, hashed, -(-total // segments)), F.col(hashed)))
        possible.append(marked.filter("spelling_repeats").drop("spelling_repeats"))
        single.append(marked.filter("not spelling_repeats").drop("spelling_repeats"))
    return reduce(DataFrame.unionByName, possible), reduce(DataFrame.unionByName, single)


def collapse_spellings(df: DataFrame, key: Column, order: str) -> DataFrame:
    """One row per record apart from formatting: the row with the smallest `order` (unique), and its number of `copies`.

    Rows whose key is null stay, each with one copy: nothing says what they are equal to. An empty table gives an empty
    one. Other columns stay whatever their names, `copies` and those that begin with `spelling_` excepted.
    """
    total = df.count()
    rows, segments = _hashed(df, key, total)
    possible, single = _split(rows, segments, total)
    groups = possible.groupBy(*_MARKS[:2]).agg(F.min(order).alias(order), F.count("*").alias("copies")).drop(*_MARKS)
    survivors = possible.join(groups, order)
    alone = single.unionByName(rows.filter(F.col(_MARKS[0]).isNull())).withColumn("copies", F.lit(1).cast("long"))
    return survivors.unionByName(alone).select(*df.columns, "copies")


def hidden_copies(df: DataFrame, key: Column, order: str) -> DataFrame:
    """(first_`order`, `order`) of each record that repeats another apart from formatting; see `collapse_spellings`."""
    total = df.count()
    rows, segments = _hashed(df, key, total, [order])
    possible, _ = _split(rows, segments, total)
    groups = possible.groupBy(*_MARKS[:2]).agg(F.min(order).alias(f"first_{order}"), F.count("*").alias("copies")).filter("copies > 1")
    members = attach_groups(possible, groups, _MARKS[:2], "copies", total)
    return members.filter(F.col(order) != F.col(f"first_{order}")).select(f"first_{order}", order)


def _url_key(df: DataFrame) -> Column:
    key = spelling_key(filled("url"))
    return F.when(key != "", key)


def _page_key(df: DataFrame) -> Column:
    key = F.concat_ws(" ", spelling_key(F.col("rollup_key")), spelling_key(F.col("canonical_key")))
    return F.when(F.col("rollup_key").isNotNull() & F.col("canonical_key").isNotNull(), key)


KEYS = {"url_records": _url_key, "curated": _page_key}


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of both tables that is another spelling or copy of an earlier one."""
    parts = []
    for name, key in KEYS.items():
        df = table(spark, sf_dir, name)
        parts.append(hidden_copies(df, key(df), "seq").select(F.lit(name).alias("tab"), "first_seq", "seq"))
    return parts[0].unionByName(parts[1])


def p3_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each address once, with the number of its copies."""
    df = table(spark, sf_dir, "url_records")
    return collapse_spellings(df, _url_key(df), "seq").select("seq", "url", "copies")


_LETTERS = r"regexp_replace(lower({}), '[^\p{{L}}\p{{M}}\p{{N}}]+', '', 'g')"


def _key_sql(c: str) -> str:
    head = _LETTERS.format(f"split_part({c}, '?', 1)")
    parts = f"list_sort(list_filter(list_transform(regexp_split_to_array(regexp_extract({c}, '(?s)^[^?]*\\?(.*)$', 1), '[&?]'), lambda p: {_LETTERS.format('p')}), lambda p: p <> ''))"
    return f"{head} || case when len({parts}) > 0 then '?' || array_to_string({parts}, '&') else '' end"


_ADDRESS = f"nullif({_key_sql('url')}, '')"
SQL = {
    "p3_found": f"""with a as (select 'url_records' as tab, seq, {_ADDRESS} as k from url_records where url is not null
        union all select 'curated', seq, {_key_sql('rollup_key')} || ' ' || {_key_sql('canonical_key')} from curated),
        b as (select tab, seq, min(seq) over (partition by tab, k) as first_seq from a where k is not null)
        select tab, first_seq, seq from b where seq <> first_seq""",
    "p3_copies": f"""with a as (select seq, url, coalesce({_ADDRESS}, 'row ' || seq) as k from url_records)
        select arg_min(seq, seq) as seq, arg_min(url, seq) as url, count(*) as copies from a group by k""",
}
QUERIES = {"p3_found": p3_found, "p3_copies": p3_copies}
