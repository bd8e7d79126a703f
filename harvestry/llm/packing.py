"""Problem 9: items of varying length laid into containers of fixed capacity.

Every task packs the items it reads by bounded-space best fit: a fixed number of open bins, found by their free space in
a bitset, of which the fullest closes when a new one is needed. Bins left open at the end of the tasks are packed together
as items of their own in a second pass, so that many small tasks waste no more than one large one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint, spread, table
from .tokens import VOCABULARIES, count_tokens

#: Open bins of a packer, and items of the second pass that one task packs.
OPEN_BINS, ITEMS_PER_TASK = 256, 500_000
#: Bin numbers: the pass, then the task, then the number within the task.
PASS_SHIFT, TASK_SHIFT = 60, 34


class BestFit:
    """Bounded-space online best fit; `first` is the number of its first bin."""

    def __init__(self, capacity: int, first: int, open_bins: int = OPEN_BINS):
        self.capacity, self.next, self.most = capacity, first, open_bins
        self.free = 0  # bit f is set while a bin with f units of free space is open
        self.bins: dict[int, list[int]] = {}
        self.count = 0

    def put(self, size: int) -> int:
        """The bin that takes an item of `size` units, at most the capacity."""
        above = self.free >> size
        if above:
            return self._take(size + (above & -above).bit_length() - 1, size)
        if self.count == self.most:
            self._pop((self.free & -self.free).bit_length() - 1)
        self.bins.setdefault(self.capacity, []).append(self.next)
        self.free |= 1 << self.capacity
        self.count += 1
        self.next += 1
        return self._take(self.capacity, size)

    def whole(self) -> int:
        """A bin of its own for an item that fills it."""
        self.next += 1
        return self.next - 1

    def _pop(self, free: int) -> int:
        waiting = self.bins[free]
        taken = waiting.pop()
        if not waiting:
            del self.bins[free]
            self.free ^= 1 << free
        self.count -= 1
        return taken

    def _take(self, free: int, size: int) -> int:
        taken = self._pop(free)
        if free > size or size == 0:
            self.bins.setdefault(free - size, []).append(taken)
            self.free |= 1 << (free - size)
            self.count += 1
        return taken

    def left(self) -> list[int]:
        """The bins that are still open."""
        return [b for waiting in self.bins.values() for b in waiting]


_PLACED = "container_id bigint, bin bigint, item bigint, part int, start_token bigint, tokens bigint, open boolean"


def _place(kinds: list[tuple[int, int, str]], folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packers = {c: BestFit(capacity, task << TASK_SHIFT) for c, capacity, _ in kinds}
        waiting: dict[int, list[tuple]] = {}  # rows of open bins, by container and bin
        for batch in batches:
            keys, texts = (c.to_pylist() for c in batch.columns)
            sizes = {t: count_tokens(texts, t, folder) for t in {t for _, _, t in kinds}}
            for c, capacity, tokenizer in kinds:
                done, packer = [], packers[c]
                for key, size in zip(keys, sizes[tokenizer], strict=True):
                    part, start = 0, 0
                    while size - start >= capacity:
                        done.append((c, packer.whole(), key, part, start, capacity, False))
                        part, start = part + 1, start + capacity
                    if size > start or size == 0:
                        at = packer.put(size - start)
                        waiting.setdefault((c, at), []).append((c, at, key, part, start, size - start))
                still = {(c, b) for b in packer.left()}
                for where in [w for w in waiting if w[0] == c and w not in still]:
                    done += [(*row, False) for row in waiting.pop(where)]
                yield _rows(done)
        yield _rows([(*row, True) for rows in waiting.values() for row in rows])

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 7
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    names = ["container_id", "bin", "item", "part", "start_token", "tokens", "open"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _repack(capacities: dict[int, int]):
    """Second pass: bins that stayed open, as items of the size they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = 1 << PASS_SHIFT | TaskContext.get().partitionId() << TASK_SHIFT
        packers = {c: BestFit(capacity, first) for c, capacity in capacities.items()}
        for batch in batches:
            c, b, size = (x.to_pylist() for x in batch.columns)
            new = [packers[x].put(s) for x, s in zip(c, size, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(new, pa.int64())], ["container_id", "bin", "new_bin"])

    return run


def pack_texts(df: DataFrame, key: str, text: str, containers: DataFrame, folder: str = VOCABULARIES) -> DataFrame:
    """(container_id, bin, `key`, part, start_token, tokens): where each text goes in every kind of container.

    `containers` (container_id, capacity_tokens, tokenizer) is a small dimension table. A text is split only if it holds
    more tokens than the capacity, and then into full containers and a rest. A null or empty text takes no space but gets
    a place. `key` is a bigint; repeated rows are packed each for itself; empty tables give an empty one.
    """
    kinds = [(r.container_id, r.capacity_tokens, r.tokenizer) for r in containers.select("container_id", "capacity_tokens", "tokenizer").filter("capacity_tokens > 0").collect()]
    rows = spread(df.select(F.col(key).cast("bigint").alias("item"), text))
    placed = checkpoint(rows.mapInArrow(_place(kinds, folder), _PLACED))
    rest = placed.filter("open").groupBy("container_id", "bin").agg(F.sum("tokens").alias("size"))
    tasks = max(1, -(-rest.count() // ITEMS_PER_TASK))
    moved = rest.repartition(tasks, F.xxhash64("bin")).sortWithinPartitions(F.desc("size")).mapInArrow(_repack({c: n for c, n, _ in kinds}), "container_id bigint, bin bigint, new_bin bigint")
    settled = placed.filter("open").join(moved, ["container_id", "bin"]).withColumn("bin", F.col("new_bin")).drop("new_bin")
    return placed.filter("not open").unionByName(settled.select(placed.columns)).drop("open").withColumnRenamed("item", key)


def p9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents, laid into every kind of container."""
    return pack_texts(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "containers"))


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well each kind of container is filled."""
    bins = p9_pack(spark, sf_dir).groupBy("container_id", "bin").agg(F.sum("tokens").alias("used"), F.count("*").alias("pieces"))
    sums = bins.groupBy("container_id").agg(F.count("*").alias("bins"), F.sum("used").alias("tokens"), F.sum("pieces").alias("pieces"))
    kinds = table(spark, sf_dir, "containers").select("container_id", "capacity_tokens")
    return sums.join(F.broadcast(kinds), "container_id").withColumn("fill", F.round(F.col("tokens") / (F.col("bins") * F.col("capacity_tokens")), 4))


SQL: dict[str, str] = {}
QUERIES = {"p9_pack": p9_pack, "p9_fill": p9_fill}
