"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

Vectors of whole numbers are cut into equal parts, and each part position has a codebook
fitted with a few rounds of Lloyd's algorithm. A round is one pass: every task assigns its
vectors' parts and sends counts and component sums of each entry, so what is shuffled and
comes to the driver is bounded by the codebooks, never by the rows. All arithmetic is in
whole numbers, so results do not depend on the order of rows or tasks.

The search (Orchard, 1991) keeps for every entry the list of all others by distance. From
a current entry it walks that list, jumps to the list of any entry that is nearer to the
query, skips entries it has visited, and stops at the first that lies further from the
current entry than twice the current distance: by the triangle inequality, nothing from
there on can be as near.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwell.llm.common import built_side, written

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Steps of one unit, and the bound on whole components that keeps all sums exact.
STEPS, LARGEST = 1024, 2**27 - 1
#: Queries searched together.
_BATCH = 4096


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, whole``: components times 1024, rounded down, of the usable rows."""
    vector = F.col(vector_col).cast("array<double>")

    def whole(v: Column) -> Column:
        return F.greatest(F.least(F.floor(v * STEPS), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")

    return vectors.where(usable(vector)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.transform(vector, whole).alias("whole")
    )


def part_ends(width: int, parts: int = PARTS) -> list[int]:
    return [i * width // parts for i in range(parts + 1)]


class Codebook:
    """Entries of one part position with the neighbour lists of Orchard's search."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.between = squared(entries[:, None, :], entries[None, :, :])
        # Each entry's list begins with itself.
        self.lists = np.argsort(self.between, axis=1, kind="stable")

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to the nearest entry; of equally near ones the lowest index."""
        rows, count = len(queries), len(self.entries)
        current = np.zeros(rows, np.int64)
        distance = squared(queries, self.entries[current])
        visited = np.zeros((rows, count), bool)
        visited[:, 0] = True
        place, walking = np.zeros(rows, np.int64), np.arange(rows)
        while len(walking):
            place[walking] += 1
            walking = walking[place[walking] < count]
            candidate = self.lists[current[walking], place[walking]]
            # Squares: beyond twice the distance is beyond four times its square.
            going = self.between[current[walking], candidate] <= 4 * distance[walking]
            walking, candidate = walking[going], candidate[going]
            fresh = ~visited[walking, candidate]
            tried, entry = walking[fresh], candidate[fresh]
            visited[tried, entry] = True
            found = squared(queries[tried], self.entries[entry])
            better = (found < distance[tried]) | ((found == distance[tried]) & (entry < current[tried]))
            moved = tried[better]
            current[moved], distance[moved], place[moved] = entry[better], found[better], 0
        return current, distance


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(axis=-1)


def _rows_of(batch: pa.RecordBatch, column: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the rows with vectors of ``width``, their vectors)."""
    lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    fit = np.flatnonzero(lengths == width)
    taken = batch.column(column).take(pa.array(fit, pa.int64()))
    return fit, np.asarray(taken.flatten(), np.int64).reshape(len(fit), width)


def _assigned(vectors: np.ndarray, books: list[Codebook], ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.zeros((len(vectors), len(books)), np.int64)
    errors = np.zeros(len(vectors), np.int64)
    for at in range(0, len(vectors), _BATCH):
        for part, book in enumerate(books):
            rows = slice(at, at + _BATCH)
            codes[rows, part], far = book.nearest(vectors[rows, ends[part] : ends[part + 1]])
            errors[rows] += far
    return codes, errors


def _improved(vectors: DataFrame, entries: list[np.ndarray], ends: list[int]) -> list[np.ndarray]:
    """The codebooks after one round: each used entry becomes the floor of its parts' mean."""
    width, widest = ends[-1], max(np.diff(ends))

    def sums(batches):
        books = [Codebook(e) for e in entries]
        counts = [np.zeros(len(e), np.int64) for e in entries]
        totals = [np.zeros((len(e), widest), np.int64) for e in entries]
        for batch in batches:
            _, own = _rows_of(batch, 0, width)
            codes, _ = _assigned(own, books, ends)
            for part in range(len(books)):
                np.add.at(counts[part], codes[:, part], 1)
                np.add.at(totals[part][:, : ends[part + 1] - ends[part]], codes[:, part], own[:, ends[part] : ends[part + 1]])
        used = [(part, entry) for part in range(len(books)) for entry in np.flatnonzero(counts[part])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in used], pa.int32()),
                pa.array([e for _, e in used], pa.int32()),
                pa.array([counts[p][e] for p, e in used], pa.int64()),
                pa.array([totals[p][e] for p, e in used], pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "total"],
        )

    partial = vectors.select("whole").mapInArrow(sums, "part int, entry int, n long, total array<long>")
    total = F.array(*[F.sum(F.element_at("total", i + 1)) for i in range(widest)])
    # At most one row for each entry of each codebook.
    grown = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), total.alias("total")).collect()
    improved = [e.copy() for e in entries]
    for row in grown:
        size = ends[row["part"] + 1] - ends[row["part"]]
        improved[row["part"]][row["entry"]] = np.asarray(row["total"][:size], np.int64) // row["n"]
    return improved


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks of whole entries from the vectors with the smallest ids; none without vectors.

    Null ids come last and equal ids in order of their vectors. The width is that of the
    first vector; only vectors of that width take part.
    """
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "whole").limit(1).collect()
    if not first:
        return []
    width = len(first[0]["whole"])
    ends = part_ends(width, parts)
    fitting = vectors.where(F.size("whole") == width)
    rows = fitting.orderBy(F.asc_nulls_last("vec_id"), "whole").limit(entries).select("whole").collect()
    start = np.array([r["whole"] for r in rows], np.int64).reshape(len(rows), width)
    books = [start[:, ends[i] : ends[i + 1]] for i in range(parts)]
    for _ in range(rounds):
        books = _improved(fitting, books, ends)
    return books


def codebooks_digest(entries: list[np.ndarray]) -> str:
    numbers = ",".join(str(x) for book in entries for entry in book.tolist() for x in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def encode(vectors: DataFrame, entries: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error``; code and error are null for vectors of another width."""
    ends = np.cumsum([0, *(e.shape[1] for e in entries)]).tolist()
    kind = vectors.schema["label"].dataType.simpleString()

    def apply(batches):
        books = [Codebook(e) for e in entries]
        for batch in batches:
            fit, own = _rows_of(batch, 2, ends[-1])
            found, far = _assigned(own, books, ends)
            codes, errors = [None] * batch.num_rows, [None] * batch.num_rows
            for row, code, error in zip(fit.tolist(), found.tolist(), far.tolist()):
                codes[row], errors[row] = "".join(f"{c:02x}" for c in code), error
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return vectors.select("vec_id", "label", "whole").mapInArrow(
        apply, f"vec_id long, label {kind}, code string, error long"
    )


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable row.

    Rows whose vector is null or holds a null or non-finite component are dropped. A vector
    is its components times 1024, rounded down and held within 2^27. Its code names the
    nearest entry of each part's codebook (two hexadecimal digits each), ``error`` sums their
    squared distances and ``label_error`` those of all rows of its label, null labels
    together. An empty vector is as good as any: its parts are empty. A vector whose
    width is not that of the smallest id has a null code and error. Rows that repeat an id
    are rows of their own; a null id is larger than any other. With fewer rows than entries
    the codebooks are smaller. An empty table gives no rows; other columns are not read.
    """
    whole = written(whole_vectors(vectors, id_col, vector_col, label_col), "whole")
    books = fit_codebooks(whole, parts, entries, rounds)
    coded = written(encode(whole, books), "coded")
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    by_label = built_side(sums.withColumnRenamed("label", "of_label"))
    return coded.join(by_label, coded["label"].eqNullSafe(by_label["of_label"]), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
