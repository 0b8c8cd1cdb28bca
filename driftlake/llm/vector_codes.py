"""Vector compression by part: product codes trained with active-entry Lloyd.

Components become integers (``floor(SCALE * x)``), vectors are cut into equal consecutive
parts, and each part position has a codebook.  Lloyd's rounds run over a table of states: a
row keeps, beside its vector, the entry each part is assigned to and the exact squared
distance to it.  In the next round a part whose entry stayed where it was compares only the
entries that moved with that stored distance; other parts look at all entries.  Both pick the
nearest, and of equally near ones the lowest index, so the result is that of full scans.

A round is one pass without a shuffle of rows: each task writes its rows' new states and, per
part and entry, the sums of its parts; only those sums are shuffled.  The driver holds the
codebooks (entries x dimensions integers) and nothing that grows with the rows.  States are
files in the shared folder; the ones before the last are deleted.

Defined results.  A vector that is null or empty, or has null or non-finite components, is
dropped.  Vectors of another length than the commonest (of equally common ones the shortest)
have no parts to compare and are dropped too.  If the length is no multiple of the number of parts, part ``p``
begins at component ``floor(p * length / parts)``.  Codebooks start from the smallest ids
(null ids last, equal ids by their vectors); with fewer vectors than entries there are as many entries as
vectors.  Integers are held within ``+-2**27`` so that every distance fits a long; a sum of errors
that does not is null.  Repeated rows each get a row.  An empty table gives no rows.  Columns
other than the id, the label and the vector are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlake.llm.common import forget, given
from driftlake.session import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 2**27
#: A label with more than this share of all rows gets its total by broadcast: there are few.
HOT_SHARE = 1000
#: Rows compared with a codebook at once.
CHUNK = 4096

Book = list[np.ndarray]


@dataclass(frozen=True)
class Compressed:
    """``vec_id, label, code, error`` of every kept vector, and the codebook of each part."""

    rows: DataFrame
    books: Book

    def digest(self) -> str:
        """SHA-256 of all entries' components, by part, entry and place."""
        numbers = ",".join(str(x) for book in self.books for x in book.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()


def integers(vectors: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v, size`` of the vectors that can be compared."""
    whole = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    low, high = F.lit(float(-LARGEST)), F.lit(float(LARGEST))
    floors = F.transform(
        vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * F.lit(float(scale)), low), high)).cast("int")
    )
    return vectors.filter(whole).select("vec_id", "label", floors.alias("v"), F.size(vector).alias("size"))


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries."""
    out = np.empty((len(x), len(entries)), np.int64)
    for start in range(0, len(x), CHUNK):
        part = x[start : start + CHUNK]
        for j, entry in enumerate(entries):
            gap = part - entry
            out[start : start + CHUNK, j] = np.einsum("ij,ij->i", gap, gap)
    return out


def assign(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray | None, near: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row and its distance, from the round before where there is one."""
    if code is None:
        found = distances(x, book)
        code = found.argmin(axis=1)
        return code, found[np.arange(len(x)), code]
    code, near = code.copy(), near.copy()
    active, entries = moved[code], np.flatnonzero(moved)
    again = np.flatnonzero(active)
    if len(again):
        found = distances(x[again], book)
        code[again] = found.argmin(axis=1)
        near[again] = found[np.arange(len(again)), code[again]]
    still = np.flatnonzero(~active)
    if len(still) and len(entries):
        found = distances(x[still], book[entries])
        best = found.argmin(axis=1)
        reached, index = found[np.arange(len(still)), best], entries[best]
        closer = (reached < near[still]) | ((reached == near[still]) & (index < code[still]))
        code[still[closer]], near[still[closer]] = index[closer], reached[closer]
    return code, near


def _cuts(size: int, parts: int) -> list[int]:
    return [p * size // parts for p in range(parts + 1)]


def _columns(batch: pa.RecordBatch, name: str, width: int, dtype) -> np.ndarray | None:
    column = batch.column(name)
    if column.null_count == len(column):
        return None
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), width)


def _listed(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(0, rows.size + 1, max(rows.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


def _pass(books: Book, moved: list[np.ndarray], cuts: list[int], label: pa.DataType):
    """A round's work in a task: states of its rows, then its sums by part and entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(book), book.shape[1] + 1), np.int64) for book in books]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = _columns(batch, "v", cuts[-1], np.int64)
            codes, nears = _columns(batch, "codes", len(books), np.int64), _columns(batch, "nears", len(books), np.int64)
            new_codes, new_nears = np.empty((n, len(books)), np.int64), np.empty((n, len(books)), np.int64)
            for p, book in enumerate(books):
                x = v[:, cuts[p] : cuts[p + 1]]
                code, near = assign(
                    x, book, moved[p], None if codes is None else codes[:, p], None if nears is None else nears[:, p]
                )
                new_codes[:, p], new_nears[:, p] = code, near
                np.add.at(sums[p], code, np.concatenate([x, np.ones((n, 1), np.int64)], axis=1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("label"), batch.column("v"),
                    _listed(new_codes, pa.int32()), _listed(new_nears, pa.int64()),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64())),
                ],
                names=_STATE,
            )
        for p, total in enumerate(sums):
            used = np.flatnonzero(total[:, -1])
            if len(used):
                k = len(used)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(k, pa.int64()), pa.nulls(k, label), pa.nulls(k, pa.list_(pa.int32())),
                        pa.nulls(k, pa.list_(pa.int32())), pa.nulls(k, pa.list_(pa.int64())),
                        pa.array([p] * k, pa.int32()), pa.array(used, pa.int32()), _listed(total[used], pa.int64()),
                    ],
                    names=_STATE,
                )

    return run


_STATE = ["vec_id", "label", "v", "codes", "nears", "part", "entry", "total"]


def _state_schema(label: T.DataType) -> T.StructType:
    ints, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    kinds = [T.LongType(), label, ints, ints, longs, T.IntegerType(), T.IntegerType(), longs]
    return T.StructType([T.StructField(name, kind) for name, kind in zip(_STATE, kinds)])


def _moved(states: DataFrame, books: Book) -> tuple[Book, list[np.ndarray]]:
    """Each entry at the floor of its parts' mean, and which entries that moved."""
    places = states.filter("part IS NOT NULL").select("part", "entry", F.posexplode("total").alias("place", "x"))
    sums = places.groupBy("part", "entry", "place").agg(F.sum("x").alias("x")).collect()
    totals = [np.zeros((len(book), book.shape[1] + 1), np.int64) for book in books]
    for row in sums:
        totals[row["part"]][row["entry"], row["place"]] = row["x"]
    new = []
    for book, total in zip(books, totals):
        used = total[:, -1] > 0
        new.append(book.copy())
        new[-1][used] = total[used, :-1] // total[used, -1:]
    return new, [(after != before).any(axis=1) for before, after in zip(books, new)]


def compress(
    vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Compressed:
    """Codes of all vectors, and the codebooks they refer to."""
    spark = vectors.sparkSession
    label = vectors.schema["label"].dataType
    paths = [scratch_path(spark, "vectors")]
    integers(vectors.withColumn("vec_id", F.col("vec_id").cast("long")), vector).write.parquet(paths[0])
    rows = spark.read.parquet(paths[0])
    sizes = rows.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1).collect()
    coded = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("code", T.StringType()),
         T.StructField("error", T.LongType())]
    )
    if not sizes:
        return Compressed(spark.createDataFrame([], coded), [np.zeros((0, 0), np.int64)] * parts)
    size = sizes[0]["size"]
    rows, cuts = rows.filter(F.col("size") == size), _cuts(size, parts)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()
    start = np.array([row["v"] for row in first], np.int64)
    books = [start[:, cuts[p] : cuts[p + 1]] for p in range(parts)]
    moved = [np.ones(len(first), bool)] * parts
    schema = _state_schema(label)
    arrow = pa.schema(vectors.limit(0).select("label").toArrow().schema).field("label").type
    states = rows.select(
        "vec_id", "label", "v", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("array<bigint>").alias("nears")
    )
    for _ in range(rounds):
        paths.append(scratch_path(spark, "vector-states"))
        states.mapInArrow(_pass(books, moved, cuts, arrow), schema).write.parquet(paths[-1])
        forget(spark, paths[-2])
        written = spark.read.schema(schema).parquet(paths[-1])
        states = written.filter("part IS NULL").select(*_STATE[:5])
        books, moved = _moved(written, books)
        if not any(m.any() for m in moved):
            break  # further rounds would change nothing
    last = states.mapInArrow(_pass(books, moved, cuts, arrow), schema).filter("part IS NULL")
    path = scratch_path(spark, "vector-codes")
    last.select(
        "vec_id",
        "label",
        F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), "")).alias("code"),
        F.aggregate("nears", F.lit(0).cast("long"), lambda a, b: a + b).alias("error"),
    ).write.parquet(path)
    forget(spark, paths[-1])
    return Compressed(spark.read.schema(coded).parquet(path), books)


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds ``label_error``, the errors of all rows with the same label (nulls together).

    Totals of labels with a large share of the rows are few and are broadcast, so such rows
    are not gathered by label; the others meet their totals in a join on the label.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "label-errors")
    rows.groupBy(F.col("label").alias("_of")).agg(
        F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows")
    ).write.parquet(path)
    totals = spark.read.parquet(path)
    n = totals.agg(F.sum("_rows")).first()[0] or 0
    hot, cold = totals.filter(F.col("_rows") * HOT_SHARE > n), totals.filter(F.col("_rows") * HOT_SHARE <= n)
    same = F.col("label").eqNullSafe(F.col("_of"))
    common = rows.join(F.broadcast(hot), same)
    rare = rows.join(F.broadcast(hot), same, "left_anti").join(cold, same)
    return common.unionByName(rare).select(*rows.columns, "label_error")


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    made = compress(given(spark, folder, "embeddings"))
    return with_label_error(made.rows).select(
        "vec_id", "code", "error", "label_error", F.lit(made.digest()).alias("codebooks_sha256")
    )


def _oracle() -> str:
    """The rounds written out; every round scans all entries."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, label, [cast(floor({SCALE} * x::DOUBLE) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x
  FROM kept, range({PARTS}) r(p))""",
        f"""first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {ENTRIES})""",
        "b0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN first USING (vec_id))",
    ]
    for n in range(ROUNDS + 1):
        steps.append(
            f"""d{n} AS (SELECT vec_id, label, p, e, x,
    list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
  FROM parts JOIN b{n} USING (p)),
a{n} AS MATERIALIZED (SELECT vec_id, p, any_value(label) AS label, any_value(x) AS x, min((d, e)) AS best FROM d{n} GROUP BY 1, 2)"""
        )
        if n < ROUNDS:
            steps.append(
                f"""s{n} AS (SELECT p, best[2] AS e, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS n
  FROM a{n}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY 1, 2, 3),
m{n} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{n} GROUP BY 1, 2),
b{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{n}.c, b{n}.c) AS c FROM b{n} LEFT JOIN m{n} USING (p, e))"""
            )
    final = f"""coded AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code,
    sum(best[1])::BIGINT AS error FROM a{ROUNDS} GROUP BY 1),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, book"""
    return "WITH " + ",\n".join([*steps, final])


ORACLE = _oracle()
