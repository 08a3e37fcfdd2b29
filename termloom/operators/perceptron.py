"""A multilayer perceptron over sparse rows whose first layer stays on the workers.

Spark's own perceptron keeps some twenty vectors of all weights on the driver,
and the first layer has one row of weights per term. Here rows are dealt into
blocks. What the first layer adds up for a row, and the gradient that comes back
to it, are a few numbers per row, and so is a step's change of those sums: the
product of all rows' cells with themselves and the gradients. So a fit holds
only such numbers per row, beside each block; the weights per term are made once
at its end. The driver gets sums: losses, slopes and the small upper layers.

The steps are those of conjugate gradients (Polak-Ribiere). The line search needs
no cells, as the change of a row's sums along a step is known.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import UserDefinedType

from termloom.operators.forest import MIX, ODD, mixed
from termloom.scratch import new_folder, publish

#: Cells of a block, about: the fewer blocks, the fewer of them share a term.
BLOCK_CELLS = 1 << 20
#: Places that are added up at once, so that they stay in the cache.
TURN = 1 << 12
#: Values are kept as the first of these that holds them all exactly.
NARROW = ("int8", "int16", "float64")
#: Bytes of a row group of blocks: what a task reads at once.
ROW_GROUP = 16 << 20
#: Pairs of a block and a term of its own that are summed in one group, about.
GROUP_PAIRS = 1 << 15
#: The last losses that a fit must have come down from by its tolerance to go on.
MEMORY = 20
#: Length of a gradient that counts as none.
FLAT = 1e-8
#: Steps that the line search tries at first, times the expected one.
TRIED = 2.0 ** np.arange(-4, 4)

_CELLS = "n long, terms array<int>, row binary, at binary, value binary"


def plain(column: str, rows: DataFrame):
    """A vector column as the struct that it is stored as."""
    return F.unwrap_udt(column) if isinstance(rows.schema[column].dataType, UserDefinedType) else F.col(column)


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """One number for each of n partitions that Spark deals it to, so that none gets two."""
    found: dict[int, int] = {}
    upto = 4 * n + 64
    while len(found) < n:
        ids = spark.range(upto, numPartitions=1).select(F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p"), "id")
        found = dict(map(tuple, ids.groupBy("p").agg(F.min("id")).collect()))
        upto *= 4
    return [found[k] for k in range(n)]


def packed(rows: DataFrame, kept: list[str], label: str | None = None) -> DataFrame:
    """Rows (``kept``, features) as blocks: their terms, the place and value of each cell, and the kept columns as a list.

    Rows of one ``label`` stand together, as they share more terms than others.
    """
    spark = rows.sparkSession
    at = F.lit(0) if label is None else F.col(label)
    sizes = rows.select(at.alias("l"), F.size(plain("features", rows)["indices"]).alias("n")).groupBy("l").agg(F.sum("n").alias("n"))
    cells = sorted((r["l"], r["n"]) for r in sizes.collect())
    total = sum(n for _, n in cells)
    cores = spark.sparkContext.defaultParallelism
    n = cores * max(1, math.ceil(total / BLOCK_CELLS / cores))
    # a label's rows take their share of the line of all blocks, by their hashes
    before, share, done = [], [], 0
    for _, count in cells:
        before.append(done / max(total, 1) * n)
        share.append(count / max(total, 1) * n)
        done += count
    place = F.array_position(F.array(*[F.lit(l) for l, _ in cells]), at).cast("int") if cells else F.lit(1)
    part = F.pmod("_id", F.lit(1 << 40)) / F.lit(float(1 << 40))
    line = F.element_at(F.array(*map(F.lit, before or [0.0])), place) + part * F.element_at(F.array(*map(F.lit, share or [0.0])), place)
    key = F.element_at(F.array(*map(F.lit, even_keys(spark, n))), F.least(F.floor(line).cast("int") + 1, F.lit(n)))
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in rows.select(*kept).schema.fields)

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("_id")
        vectors = table.column("features").chunk(0)
        lists = vectors.field("indices")
        row = np.repeat(np.arange(len(lists), dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
        terms, at = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        own = pa.StructArray.from_arrays([table.column(c).chunk(0) for c in kept], names=kept)
        return pa.table({
            "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
            "kept": pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
            "n": pa.array([len(own)], pa.int64()),
            "terms": pa.array([terms.astype(np.int32)], pa.list_(pa.int32())),
            "row": pa.array([row.tobytes()], pa.binary()),
            "at": pa.array([at.astype(np.int32).tobytes()], pa.binary()),
            "value": pa.array([vectors.field("values").flatten().to_numpy().astype(np.float64).tobytes()], pa.binary()),
        })

    keyed = rows.select(F.xxhash64(*kept).alias("_id"), *kept, plain("features", rows).alias("features"))
    dealt = keyed.withColumn("block", key.cast("int")).repartition(n, "block")
    schema = f"block int, kept array<struct<{fields}>>, {_CELLS}"
    path = new_folder(spark, "blocks")
    dealt.groupBy("block").applyInArrow(pack, schema).write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(schema).parquet(path)


def uniform(terms: np.ndarray, units: int, size: int, seed: int) -> np.ndarray:
    """First weights (term, unit) of the first layer, by a hash: what Spark's perceptron draws, up to 2.4 / sqrt(terms) either way."""
    key = terms.astype(np.uint64)[:, None] * np.uint64(units) + np.arange(units, dtype=np.uint64)
    u = (mixed(key * ODD + np.uint64(seed * int(MIX) & (2**64 - 1))) >> np.uint64(11)) / 2.0**53
    return (u * 4.8 - 2.4) / math.sqrt(max(size, 1))


def numbers(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float64).reshape(-1, width)


def cells_of(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(block[c], dtype=t) for c, t in (("row", np.int32), ("at", np.int32), ("value", np.float64)))


@dataclass(frozen=True)
class Layout:
    """Cells dealt into rounds: the first cell of each place, then the second of those that have one, and so on; places with most cells stand first."""

    by_size: np.ndarray
    sizes: np.ndarray
    of: np.ndarray
    value: np.ndarray

    @staticmethod
    def made(to: np.ndarray, of: np.ndarray, value: np.ndarray, n: int) -> Layout:
        sizes = np.bincount(to, minlength=n)
        by_size = np.argsort(-sizes, kind="stable").astype(np.int32)
        rank = np.empty(n, dtype=np.int64)
        rank[by_size] = np.arange(n)
        order = np.argsort(to, kind="stable")
        to = to[order]
        nth = np.arange(len(to)) - (np.cumsum(sizes) - sizes)[to]
        starts = np.cumsum([0, *rounds(sizes)])
        slot = starts[nth] + rank[to]
        placed, values = np.empty(len(to), dtype=np.int32), np.empty(len(to))
        placed[slot], values[slot] = of[order], value[order]
        return Layout(by_size, sizes[by_size].astype(np.int32), placed, values)

    def added(self, numbers: np.ndarray) -> np.ndarray:
        """Per place the sum of its cells' values times the numbers that they point at."""
        units = numbers.shape[1]
        numbers = np.ascontiguousarray(numbers, dtype=np.float64)
        out = np.zeros((len(self.sizes), units))
        buffer = np.empty((min(len(out), TURN), units))
        start = 0
        for m in rounds(self.sizes):
            for a in range(0, m, TURN):
                b = min(a + TURN, m)
                part = buffer[: b - a]
                np.take(numbers, self.of[start + a : start + b], axis=0, out=part, mode="clip")
                part *= self.value[start + a : start + b, None]
                out[a:b] += part
            start += m
        back = np.empty_like(out)
        back[self.by_size] = out
        return back

    def stored(self, mark: str) -> dict:
        kind = next(t for t in NARROW if t == NARROW[-1] or (self.value.astype(t) == self.value).all())
        return {f"{mark}kind": kind, f"{mark}value": self.value.astype(kind).tobytes()} | {
            f"{mark}{c}": getattr(self, c).tobytes() for c in ("by_size", "sizes", "of")
        }

    @staticmethod
    def read(block: dict, mark: str) -> Layout:
        value = np.frombuffer(block[f"{mark}value"], dtype=block[f"{mark}kind"]).astype(np.float64)
        return Layout(*(np.frombuffer(block[f"{mark}{c}"], dtype=np.int32) for c in ("by_size", "sizes", "of")), value)


def layout_schema(mark: str) -> str:
    return f"{mark}kind string, " + ", ".join(f"{mark}{c} binary" for c in ("value", "by_size", "sizes", "of"))


def rounds(sizes: np.ndarray) -> list[int]:
    """How many places have more than 0, 1, 2, ... cells."""
    least = np.bincount(sizes)
    return (len(sizes) - np.cumsum(least))[:-1].tolist()


def added(to: np.ndarray, of: np.ndarray, value: np.ndarray, numbers: np.ndarray, n: int) -> np.ndarray:
    """Per place in ``to`` the sum of value times the numbers at the place in ``of``."""
    return Layout.made(to, of, value, n).added(numbers)


@dataclass(frozen=True)
class Upper:
    """The layers above the first: sizes from the first hidden layer on, and all their weights in one vector."""

    sizes: tuple[int, ...]
    weights: np.ndarray

    def parts(self, flat: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The bias of the first layer; the matrix and bias of each other."""
        at, layers = self.sizes[0], []
        for a, b in zip(self.sizes, self.sizes[1:], strict=False):
            layers.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
            at += a * b + b
        return flat[: self.sizes[0]], layers

    def outputs(self, sums: np.ndarray) -> list[np.ndarray]:
        """The output of each layer for rows of sums of the first; sigmoid, and softmax at the end."""
        bias, layers = self.parts(self.weights)
        out = [sigmoid(sums + bias)]
        for k, (matrix, b) in enumerate(layers):
            z = out[-1] @ matrix + b
            if k < len(layers) - 1:
                out.append(sigmoid(z))
            else:
                e = np.exp(z - z.max(axis=1, keepdims=True))
                out.append(e / e.sum(axis=1, keepdims=True))
        return out

    def backward(self, sums: np.ndarray, label: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Cross entropy summed over rows, its gradient by the sums, and that by the weights."""
        out = self.outputs(sums)
        held = out[-1][np.arange(len(label)), label]
        loss = -np.log(np.maximum(held, 1e-300)).sum()
        delta = out[-1].copy()
        delta[np.arange(len(label)), label] -= 1
        _, layers = self.parts(self.weights)
        pieces: list[np.ndarray] = []
        for below, (matrix, _) in zip(out[-2::-1], layers[::-1], strict=True):
            pieces = [(below.T @ delta).ravel(), delta.sum(axis=0), *pieces]
            delta = (delta @ matrix.T) * below * (1 - below)
        return float(loss), delta, np.concatenate([delta.sum(axis=0), *pieces])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Perceptron:
    """``first``: (term, w) what the fit added to the first layer's first weights; ``upper``: the other layers."""

    first: DataFrame
    upper: Upper
    n_terms: int
    seed: int

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows with the number of the likeliest label; terms that the fit has not met have their first weights."""
        kept = [c for c in rows.columns if c not in ("features", "prediction")]
        blocks = packed(rows, kept)
        units, size, seed, upper = self.upper.sizes[0], self.n_terms, self.seed, self.upper

        def score(block: dict, known: np.ndarray, weights: np.ndarray) -> dict:
            row, at, value = cells_of(block)
            terms = np.asarray(block["terms"])
            first = uniform(terms, units, size, seed)
            first[np.searchsorted(terms, known)] += weights
            sums = added(row, at, value, first, block["n"])
            return {"kept": block["kept"], "found": np.argmax(upper.outputs(sums)[-1], axis=1).astype(np.float64).tolist()}

        schema = f"kept {blocks.schema['kept'].dataType.simpleString()}, found array<double>"
        scored = gathered(blocks, postings_of(blocks), self.first, units, score, schema)
        each = scored.select(F.explode(F.arrays_zip("kept", "found")).alias("r"))
        return each.select(*[F.col(f"r.kept.`{c}`").alias(c) for c in kept], F.col("r.found").alias("prediction"))


def postings_of(blocks: DataFrame) -> DataFrame:
    """(held, term): the terms of each block."""
    return publish(blocks.select(F.col("block").alias("held"), F.explode("terms").alias("term")), "postings")


def gathered(blocks: DataFrame, postings: DataFrame, by_term: DataFrame, units: int, use, schema: str) -> DataFrame:
    """``use`` of each block with the terms of ``by_term`` (term, w0, w1, ...) that it holds, and their numbers."""
    sent = postings.join(by_term.hint("merge"), "term")
    names = pa_names(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({c: pa.array([], t) for c, t in names.items()})
        right = right.sort_by("term")
        weights = np.stack([right.column(f"w{k}").to_numpy() for k in range(units)], axis=1)
        found = use(left.to_pylist()[0], right.column("term").to_numpy(), weights)
        return pa.table({c: pa.array([found[c]], t) for c, t in names.items()})

    return blocks.groupBy("block").cogroup(sent.groupBy("held")).applyInArrow(run, schema)


def pa_names(schema: str) -> dict[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return {f.name: f.type for f in to_arrow_schema(StructType.fromDDL(schema))}


def summed_by_term(blocks: DataFrame, column: str, units: int) -> DataFrame:
    """(term, w0, w1, ...): per term the sum over all rows of the cell times the row's numbers in ``column``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                row, at, value = cells_of(block)
                sums = added(at, row, value, numbers(block[column], units), len(block["terms"]))
                columns = [pa.array(block["terms"], pa.int32()), *(pa.array(c) for c in sums.T.copy())]
                yield pa.RecordBatch.from_arrays(columns, names=["term", *(f"w{k}" for k in range(units))])

    schema = "term int, " + ", ".join(f"w{k} double" for k in range(units))
    parts = blocks.select("terms", "row", "at", "value", column).mapInArrow(run, schema)
    return parts.groupBy("term").agg(*[F.sum(f"w{k}").alias(f"w{k}") for k in range(units)])


def group_of(terms: np.ndarray, n: int) -> np.ndarray:
    return ((mixed(terms.astype(np.uint64) * ODD) >> np.uint64(33)) % np.uint64(n)).astype(np.int64)


def counted(blocks: DataFrame) -> DataFrame:
    """(held, term, n): in how many rows of each block a term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                terms = np.asarray(block["terms"], dtype=np.int32)
                n = np.bincount(np.frombuffer(block["at"], dtype=np.int32), minlength=len(terms)).astype(np.int64)
                held = np.full(len(terms), block["block"], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(terms), pa.array(n)], names=["held", "term", "n"])

    return blocks.select("block", "terms", "at").mapInArrow(run, "held int, term int, n long")


SHARED = f"block int, n long, terms binary, own binary, {layout_schema('r_')}, {layout_schema('t_')}"


def shared(blocks: DataFrame) -> DataFrame:
    """Blocks without the terms that no second row has: those add to ``own``, the squares by row. Cells by row (r_) and by term (t_)."""
    single = counted(blocks).groupBy("term").agg(F.sum("n").alias("n"), F.min("held").alias("held")).where("n = 1").select("held", "term")
    names = pa_names(SHARED)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({c: pa.array([], t) for c, t in names.items()})
        block = left.to_pylist()[0]
        row, at, value = cells_of(block)
        terms, n = np.asarray(block["terms"], dtype=np.int32), block["n"]
        alone = np.zeros(len(terms), dtype=bool)
        alone[np.searchsorted(terms, right.column("term").to_numpy())] = True
        gone = alone[at]
        own = np.bincount(row[gone], weights=value[gone] ** 2, minlength=n)
        place = np.cumsum(~alone) - 1
        row, at, value, terms = row[~gone], place[at[~gone]], value[~gone], terms[~alone]
        found = {"block": block["block"], "n": n, "terms": terms.tobytes(), "own": own.tobytes()}
        found |= Layout.made(row, at, value, n).stored("r_") | Layout.made(at, row, value, len(terms)).stored("t_")
        return pa.table({c: pa.array([found[c]], t) for c, t in names.items()})

    return blocks.groupBy("block").cogroup(single.groupBy("held")).applyInArrow(run, SHARED)


def by_group(block: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of a block, the places they have when sorted by group, and where each group starts there."""
    terms = np.frombuffer(block["terms"], dtype=np.int32)
    group = group_of(terms, len(keys))
    order = np.argsort(group, kind="stable")
    return terms, order, np.searchsorted(group[order], np.arange(len(keys) + 1))


def exchanged(blocks: DataFrame, numbers_of, units: int, keys: list[int]) -> DataFrame:
    """(held, part, w): for the terms of each block the sum over all rows of the cell times the row's numbers; one row per block and group of terms."""
    keys = np.array(keys, dtype=np.int32)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                terms, order, cuts = by_group(block, keys)
                sums = Layout.read(block, "t_").added(numbers_of(block))[order]
                terms = terms[order]
                used = np.flatnonzero(np.diff(cuts))
                columns = [
                    pa.array(keys[used]),
                    pa.array([block["block"]] * len(used), pa.int32()),
                    pa.array([terms[cuts[p] : cuts[p + 1]].tobytes() for p in used], pa.binary()),
                    pa.array([sums[cuts[p] : cuts[p + 1]].tobytes() for p in used], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "held", "terms", "w"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("held")
        terms = [np.frombuffer(x.as_buffer(), dtype=np.int32) for x in table.column("terms")]
        w = [numbers(x.as_buffer(), units) for x in table.column("w")]
        known, at = np.unique(np.concatenate(terms), return_inverse=True)
        cuts = np.cumsum([0, *map(len, terms)])
        places = [at[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        sums = np.zeros((len(known), units))
        for place, some in zip(places, w, strict=True):  # a block has a term once
            sums[place] += some
        sent = pa.array([sums[place].tobytes() for place in places], pa.binary())
        return pa.table({"held": table.column("held"), "part": table.column("part"), "w": sent})

    parts = blocks.drop("own", "n", *[c for c in blocks.columns if c.startswith("r_")]).mapInArrow(send, "part int, held int, terms binary, w binary")
    return parts.repartition(len(keys), "part").groupBy("part").applyInArrow(add, "held int, part int, w binary")


STATE = "block int, label binary, sums binary, coef binary, grad binary, way binary, way_coef binary, image binary, dots binary, slopes binary"
FIELDS = [field.split()[0] for field in STATE.split(", ")]


def mapped(table: DataFrame, work, schema: str) -> DataFrame:
    """``work`` of each block's row, one at a time."""
    names = pa_names(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = work(batch.slice(i, 1).to_pylist()[0])
                yield pa.RecordBatch.from_arrays([pa.array([found[c]], t) for c, t in names.items()], names=list(names))

    return table.mapInArrow(run, schema)


def totals(table: DataFrame, *columns: str) -> list[np.ndarray]:
    """Sums over the blocks of small vectors of each, in the order of the blocks."""
    rows = sorted(table.select("block", *columns).collect())
    return [sum(np.frombuffer(r[c], dtype=np.float64) for r in rows) for c in columns]


#: Spark removes the files of a query's shuffles at its end, not when the driver next frees memory.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def fit(train: DataFrame, n_terms: int, hidden: tuple[int, ...], n_labels: int, iterations: int, tolerance: float, seed: int) -> Perceptron:
    """``steps`` with the session set to remove each step's shuffled files at its end."""
    conf = train.sparkSession.conf
    before = conf.get(TIDY, "false")
    conf.set(TIDY, "true")
    try:
        return steps(train, n_terms, hidden, n_labels, iterations, tolerance, seed)
    finally:
        conf.set(TIDY, before)


def steps(train: DataFrame, n_terms: int, hidden: tuple[int, ...], n_labels: int, iterations: int, tolerance: float, seed: int) -> Perceptron:
    """Least mean cross entropy over (row_id, label, features); stops when the last steps gain less than ``tolerance`` of it."""
    from termloom.sources.folders import drop

    spark = train.sparkSession
    units = hidden[0]
    sizes = (*hidden, n_labels)
    size = units + sum(a * b + b for a, b in zip(sizes, sizes[1:], strict=False))
    draw = np.random.default_rng(seed)
    upper = Upper(sizes, np.empty(size))
    bias, layers = upper.parts(upper.weights)
    bias[:] = draw.uniform(-1, 1, len(bias)) * 2.4 / math.sqrt(max(n_terms, 1))
    for matrix, b in layers:
        matrix[:], b[:] = (draw.uniform(-1, 1, x.shape) * 2.4 / math.sqrt(len(matrix)) for x in (matrix, b))

    blocks = packed(train.select("row_id", F.col("label").cast("int").alias("label"), "features"), ["row_id", "label"], "label")
    n_blocks, n_rows = blocks.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_rows:
        raise ValueError("No rows to fit")
    cells = shared(blocks).repartition(n_blocks, "block").persist(StorageLevel.DISK_ONLY)  # so that only small tables move in a step
    pairs = cells.agg(F.sum(F.octet_length("terms") / 4)).first()[0]
    cores = spark.sparkContext.defaultParallelism
    keys = even_keys(spark, cores * max(1, math.ceil(pairs / GROUP_PAIRS / cores)))
    old_paths: list[str] = []

    def kept(table: DataFrame, schema: str) -> DataFrame:
        """Written, in place of the last such table, which it is made from."""
        old_paths.append(new_folder(spark, "perceptron"))
        table.write.option("parquet.block.size", ROW_GROUP).parquet(old_paths[-1])
        for path in old_paths[:-1]:
            drop(spark, path)
        del old_paths[:-1]
        return spark.read.schema(schema).parquet(old_paths[-1])

    def begin(block: dict) -> dict:
        row, at, value = cells_of(block)
        sums = added(row, at, value, uniform(np.asarray(block["terms"]), units, n_terms, seed), block["n"])
        label = np.array([r["label"] for r in block["kept"]], dtype=np.int32)
        loss, grad, slopes = start.backward(sums, label)
        none = np.zeros((block["n"], units)).tobytes()
        return {
            "block": block["block"], "label": label.tobytes(), "sums": sums.tobytes(), "grad": (grad / n_rows).tobytes(),
            "coef": none, "way": none, "way_coef": none, "image": none,
            "dots": np.array([loss / n_rows]).tobytes(), "slopes": (slopes / n_rows).tobytes(),
        }

    start = upper
    state = kept(mapped(blocks, begin, STATE), STATE)
    (loss,), slopes = totals(state, "dots", "slopes")
    way, old_slopes, old_gg, step, losses = np.zeros(size), np.zeros(size), 0.0, 0.0, [loss]
    gone = still  # the last step, which the state does not yet have
    found_types = pa_names(STATE)
    for _ in range(iterations):
        joined = cells.join(state.hint("merge"), "block")

        def image(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return pa.table({c: pa.array([], t) for c, t in found_types.items()})
            block = left.to_pylist()[0]
            now = gone(block)
            terms, order, _ = by_group(block, keys)
            first = np.empty((len(terms), units))
            first[order] = np.concatenate([np.empty((0, units)), *(numbers(w.as_buffer(), units) for w in right.sort_by("place").column("w"))])
            grad, slopes = now["grad"], now["slopes"]
            back = Layout.read(block, "r_").added(first) + np.frombuffer(block["own"])[:, None] * grad
            dots = [(grad * x).sum() for x in (back, now["image"], now["way"])]
            found = {"block": block["block"], "label": block["label"], "dots": np.array(dots).tobytes(), "slopes": slopes.tobytes()}
            found |= {c: now[c].tobytes() for c in ("sums", "coef", "grad", "way", "way_coef")} | {"image": back.tobytes()}
            return pa.table({c: pa.array([found[c]], t) for c, t in found_types.items()})

        sent = exchanged(joined, lambda block: gone(block)["grad"], units, keys)
        place = F.array_position(F.array(*map(F.lit, keys)), F.col("part"))
        sent = sent.select("held", place.alias("place"), "w")
        wide = joined.drop(*[c for c in cells.columns if c.startswith("t_")])
        state = kept(wide.groupBy("block").cogroup(sent.groupBy("held")).applyInArrow(image, STATE), STATE)
        gone = still
        dots, slopes = totals(state, "dots", "slopes")
        gg, g_old, g_way = dots + [slopes @ slopes, slopes @ old_slopes, slopes @ way]
        if math.sqrt(gg) <= max(tolerance * loss, FLAT):
            break
        turn = max(0.0, (gg - g_old) / old_gg) if old_gg else 0.0
        slope = -gg + turn * g_way
        if slope >= 0:
            turn, slope = 0.0, -gg
        way = turn * way - slopes

        def along(block: dict) -> np.ndarray:
            return turn * numbers(block["way"], units) - numbers(block["image"], units)

        def losses_at(steps: np.ndarray) -> np.ndarray:
            """(loss, slope) of each step."""
            uppers = [Upper(sizes, upper.weights + s * way) for s in steps]

            def run(block: dict) -> dict:
                sums, label, ahead = numbers(block["sums"], units), np.frombuffer(block["label"], dtype=np.int32), along(block)
                out = []
                for s, u in zip(steps, uppers, strict=True):
                    value, grad, by = u.backward(sums + s * ahead, label)
                    out += [value / n_rows, ((grad * ahead).sum() + by @ way) / n_rows]
                return {"block": block["block"], "at": np.array(out).tobytes()}

            read = state.select("block", "sums", "label", "way", "image")
            return totals(mapped(read, run, "block int, at binary"), "at")[0].reshape(-1, 2)

        guess = step * old_slope / slope if step else 1 / math.sqrt(gg)
        step, best = searched(losses_at, guess, loss, slope)
        if not step:
            if not turn:
                break
            old_gg = 0.0  # once more, straight down
        upper = Upper(sizes, upper.weights + step * way)
        gone = moved(step, turn, upper, units, n_rows)
        if step:
            old_gg = gg
        old_slopes, old_slope, loss = slopes, slope, best if step else loss
        losses.append(loss)
        if step and max(losses[-MEMORY - 1 : -1]) - loss <= tolerance * losses[0]:
            break

    def ended(block: dict) -> dict:
        return {"block": block["block"], "coef": np.ascontiguousarray(gone(block)["coef"]).tobytes()}

    coef = mapped(state, ended, "block int, coef binary")
    cells.unpersist()
    first = publish(summed_by_term(blocks.join(coef.hint("merge"), "block"), "coef", units), "weights")
    return Perceptron(first, upper, n_terms, seed)


def still(block: dict) -> dict:
    """The numbers of a block's rows as they were written."""
    return {c: np.frombuffer(block[c]).reshape(np.frombuffer(block["label"], dtype=np.int32).size, -1) for c in ("sums", "coef", "grad", "way", "way_coef", "image")} | {
        "slopes": np.frombuffer(block["slopes"])
    }


def moved(step: float, turn: float, after: Upper, units: int, n_rows: int):
    """The numbers of a block's rows one step on, from those that were written before it."""

    def go(block: dict) -> dict:
        was = still(block)
        label = np.frombuffer(block["label"], dtype=np.int32)
        ahead = turn * was["way"] - was["image"]
        way_coef = turn * was["way_coef"] - was["grad"]
        sums = was["sums"] + step * ahead
        _, grad, slopes = after.backward(sums, label)
        return was | {"sums": sums, "coef": was["coef"] + step * way_coef, "grad": grad / n_rows, "way": ahead, "way_coef": way_coef, "slopes": slopes / n_rows}

    return go


def searched(losses_at, guess: float, loss: float, slope: float) -> tuple[float, float]:
    """A step along which the loss falls enough, and the loss there; steps around the guess first, then where the slope turns. (0, loss) if there is none."""
    steps = guess * TRIED
    for _ in range(8):
        found = losses_at(steps)
        ok = np.flatnonzero(np.isfinite(found[:, 0]) & (found[:, 0] <= loss + 1e-4 * steps * slope))
        if len(ok) and ok[np.argmin(found[ok, 0])] == len(steps) - 1 and found[-1, 1] < 0:
            steps = steps * TRIED[-1] / TRIED[0]
        elif not len(ok):
            steps = steps * TRIED[0] / TRIED[-1] / 2
        else:
            break
    if not len(ok):
        return 0.0, loss
    at = ok[np.argmin(found[ok, 0])]
    rising = np.flatnonzero(found[:, 1] > 0)
    falling = np.flatnonzero(found[:, 1] <= 0)
    low = falling[falling < rising[0]][-1] if len(rising) and (falling < rising[0]).any() else None
    if low is not None:
        (x, f, y, g) = steps[low], found[low, 1], steps[rising[0]], found[rising[0], 1]
        middle = np.array([x + (y - x) * -f / (g - f)])
        value = losses_at(middle)[0, 0]
        if value < found[at, 0]:
            return float(middle[0]), float(value)
    return float(steps[at]), float(found[at, 0])
