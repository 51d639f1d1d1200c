"""Codes of vectors: each of eight parts of a vector is named by the nearest entry of that part's codebook.

The codebooks come from rounds of Lloyd's method over members that stay where
they are. Every part of every vector is a member of one owner, (position,
entry, salt): members are shuffled to their owners once and written; a round
reads them there, sums them by owner into new entries, and then only the members
whose nearest entry has changed are shuffled, to their new owners. What a round
wrote is never rewritten: whether a member is still at the owner it came to
follows from its own numbers and the codebooks since, so no list of leavers is
kept, and a lost executor costs a read of the written members.

All numbers are whole, and sums and distances exact: in floating point as long
as they stay below 2**53, with Python's integers beyond.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keylane.session import discard, run_folder, stored

PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: A component x becomes floor(SCALE * x).
SCALE = 4096
#: Rows worked on at once.
ROWS = 1 << 14
#: Members of an owner, about; an entry with more has several salts.
OWNER_MEMBERS = 1 << 20
MOST = 2**63 - 1
_EXACT = 2**53

MEMBERS = "position int, entry int, salt int, members binary, wide boolean"


@dataclass(frozen=True)
class Codebooks:
    """``entries[position][entry]`` are the whole components of an entry; ``width`` their number."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]
    width: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.entries for entry in book for x in entry).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def whole(vectors: pa.Array, parts: int, width: int) -> np.ndarray:
    """The floors of the scaled components as doubles, ``[row, parts * width]``, short vectors filled up with zeros."""
    sizes = vectors.value_lengths().to_numpy()
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    out = np.zeros((len(vectors), parts * width))
    out[np.arange(parts * width) < sizes[:, None]] = flat
    return out


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in x.reshape(-1).tolist()], object).reshape(x.shape)


def nearest(x: np.ndarray, book: tuple[tuple[int, ...], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry for each row, the lower of equally near ones, and the squared distance."""
    top = max([int(np.abs(x).max(initial=0))] + [abs(v) for entry in book for v in entry])
    if 4 * x.shape[1] * top * top < _EXACT:
        b = np.array(book, np.float64)
        away = (x * x).sum(axis=1)[:, None] - 2 * (x @ b.T) + (b * b).sum(axis=1)
    else:
        b, x = np.array(book, object), _integers(x)
        away = np.stack([((x - entry) ** 2).sum(axis=1) for entry in b], axis=1)
    at = away.argmin(axis=1)
    return at, away[np.arange(len(x)), at]


def _members(x: np.ndarray) -> tuple[bytes, bool]:
    """Members as bytes: two a component if they fit, eight otherwise."""
    wide = bool(len(x)) and float(np.abs(x).max()) > 32767
    return x.astype("<f8" if wide else "<i2").tobytes(), wide


def _owned(position: int, x: np.ndarray, entry: np.ndarray, salts: int) -> Iterator[tuple]:
    """Rows of MEMBERS. The salt follows from the members, so a repeated task deals them alike."""
    order = np.argsort(entry, kind="stable")
    found, first = np.unique(entry[order], return_index=True)
    for e, low, high in zip(found.tolist(), first.tolist(), np.append(first, len(order))[1:].tolist(), strict=True):
        body, wide = _members(x[order[low:high]])
        yield position, e, zlib.crc32(body) % salts, body, wide


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      [c.split()[0] for c in MEMBERS.split(", ")])


def _first_owners(books: Codebooks, salts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            x = whole(batch.column(0), len(books.entries), books.width)
            rows = []
            for p, book in enumerate(books.entries):
                part = x[:, p * books.width: (p + 1) * books.width]
                rows += _owned(p, part, nearest(part, book)[0], salts)
            yield _table(rows)
    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ROWS."""
    held, n = [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            held.append(batch.slice(low, ROWS))
            n += held[-1].num_rows
            if n >= ROWS:
                yield pa.concat_batches(held)
                held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _residents(batch: pa.RecordBatch, history: list[Codebooks], width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(position, entry, members) of each row of the members still there: nearest to it in all codebooks after the one that brought them."""
    for position, entry, body, wide, came in zip(*(batch.column(c).to_pylist() for c in ("position", "entry", "members", "wide", "round")),
                                                 strict=True):
        x = np.frombuffer(body, "<f8" if wide else "<i2").reshape(-1, width).astype(np.float64)
        for books in history[came + 1:]:
            x = x[nearest(x, books.entries[position])[0] == entry]
        yield position, entry, x


SUMS = "position int, entry int, n long, sums string"


def _sums(history: list[Codebooks], width: int) -> Callable:
    """Numbers of members and sums of their components, one row per owner and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for position, entry, x in _residents(batch, history, width):
                exact = len(x) * int(np.abs(x).max(initial=0)) < _EXACT
                sums = x.sum(axis=0).tolist() if exact else _integers(x).sum(axis=0).tolist()
                _add(held, (position, entry), [len(x), *(int(s) for s in sums)])
        yield _summed(held)
    return run


def _add(held: dict, key: tuple[int, int], values: list[int]) -> None:
    held[key] = [a + b for a, b in zip(held[key], values, strict=True)] if key in held else values


def _summed(held: dict) -> pa.RecordBatch:
    keys = list(held)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
         pa.array([held[k][0] for k in keys], pa.int64()), pa.array([",".join(map(str, held[k][1:])) for k in keys], pa.string())],
        ["position", "entry", "n", "sums"])


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], list[int]] = {}
    for batch in batches:
        for position, entry, n, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            _add(held, (position, entry), [n, *map(int, sums.split(","))])
    yield _summed(held)


def _movers(history: list[Codebooks], width: int, salts: int) -> Callable:
    """Members that were there under the codebooks before the last and are nearest to another entry under it, for that owner."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved: dict[int, list[tuple]] = {}
            for position, entry, x in _residents(batch, history[:-1], width):
                to = nearest(x, history[-1].entries[position])[0]
                moved.setdefault(position, []).append((x[to != entry], to[to != entry]))
            yield _table([row for position, held in moved.items()
                          for row in _owned(position, *(np.concatenate(c) for c in zip(*held, strict=True)), salts)])
    return run


def train(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after ``rounds`` of Lloyd's method over all usable vectors; None without any.

    They start as the parts of the vectors with the least ids: a null id comes
    last, of equal ids the lesser vector first. With fewer vectors than entries
    there are fewer entries. The longest vector says how many components a part
    has, rounded up, one at least; shorter ones are filled up with zeros. Each
    round assigns every part to the nearest entry, ties to the lower index, and
    replaces entries by the componentwise floor of their members' mean; an entry
    without members stays. The rounds end early when nothing changes any more.

    Only sums, at most one row per entry, reach the driver. A shuffle carries
    blocks of members that came or moved, dealt by (position, entry, salt).
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_column).alias("k"), F.col(vector_column).alias("v")).filter(usable(F.col("v")))
    size = kept.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("longest")).first()
    if not size["n"]:
        return None
    width = max(1, -(-size["longest"] // parts))
    salts = -(-size["n"] // OWNER_MEMBERS)
    seeds = pa.array([r["v"] for r in kept.orderBy(F.col("k").asc_nulls_last(), "v").limit(entries).collect()], pa.list_(pa.float64()))
    start = _integers(whole(seeds, parts, width))
    history = [Codebooks(tuple(tuple(tuple(row[p * width: (p + 1) * width]) for row in start.tolist()) for p in range(parts)), width)]

    folder = run_folder(spark, "members")
    _write(kept.select("v").mapInArrow(_first_owners(history[0], salts), MEMBERS), folder, 0)
    for number in range(1, rounds + 1):
        members = spark.read.schema(f"{MEMBERS}, round int").parquet(folder)
        sums = members.mapInArrow(_sums(history, width), SUMS).repartition("position", "entry").mapInArrow(_totals, SUMS).collect()
        history.append(_updated(history[-1], sums))
        if history[-1] == history[-2]:
            break
        if number < rounds:
            _write(members.mapInArrow(_movers(history, width, salts), MEMBERS), folder, number)
    discard(spark, folder)
    return history[-1]


def _write(members: DataFrame, folder: str, number: int) -> None:
    members.repartition("position", "entry", "salt").write.parquet(f"{folder}/round={number}")


def _updated(books: Codebooks, sums: list) -> Codebooks:
    now = [list(book) for book in books.entries]
    for position, entry, n, total in sums:
        if n:
            now[position][entry] = tuple(int(s) // n for s in total.split(","))
    return Codebooks(tuple(tuple(book) for book in now), books.width)


def encoded(vectors: DataFrame, books: Codebooks | None, id_column: str = "vec_id", vector_column: str = "embedding",
            label_column: str = "label") -> DataFrame:
    """Rows (vec_id, code, error, label_error, codebooks_sha256), one per usable vector; repeated rows keep a row each.

    code: the nearest entries' indexes, two hex digits a part; error: the squared
    distances summed; label_error: error summed over the rows of the same label, null
    being one. Both stop at the largest long. Vectors longer than the
    codebooks' are cut by :func:`train` never to occur; without codebooks there are no rows.
    """
    kinds = {f.name: f.dataType for f in vectors.schema.fields}
    schema = T.StructType([T.StructField("vec_id", kinds[id_column]), T.StructField("label", kinds[label_column]),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).alias("v"))
    if books is None:
        return rows.sparkSession.createDataFrame([], schema).select(
            "vec_id", "code", "error", F.lit(None).cast("long").alias("label_error"), F.lit(None).cast("string").alias("codebooks_sha256"))
    coded = stored(rows.filter(usable(F.col("v"))).mapInArrow(_coder(books), schema), "codes")
    by_label = coded.groupBy(F.col("label").alias("l")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("l"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _coder(books: Codebooks) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            x = whole(batch.column(2), len(books.entries), books.width)
            found = [nearest(x[:, p * books.width: (p + 1) * books.width], book) for p, book in enumerate(books.entries)]
            digits = np.stack([at for at, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            size = 2 * len(found)
            error = [min(int(sum(row)), MOST) for row in zip(*(away.tolist() for _, away in found), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([digits[i: i + size] for i in range(0, len(digits), size)], pa.string()),
                 pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])
    return run


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings, eight parts, sixteen entries, six rounds; null, empty and short vectors as in :func:`train`."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return encoded(vectors, train(vectors))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL of the query, for vectors of one length that the parts divide, and unique ids."""
    steps = [f"""
kept AS MATERIALIZED (SELECT vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
places AS MATERIALIZED (SELECT vec_id, CAST(i // (len(v) // {parts}) AS INT) AS p, CAST(i % (len(v) // {parts}) AS INT) AS j,
  CAST(floor({SCALE} * CAST(v[i + 1] AS DOUBLE)) AS BIGINT) AS x FROM (SELECT *, unnest(range(len(v))) AS i FROM kept)),
b0 AS MATERIALIZED (SELECT p, CAST(rank - 1 AS INT) AS e, j, x FROM places
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM kept) USING (vec_id) WHERE rank <= {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (SELECT vec_id, a.p, b.e, CAST(sum((a.x - b.x) * (a.x - b.x)) AS BIGINT) AS d FROM places a JOIN b{r} b ON a.p = b.p AND a.j = b.j
  GROUP BY vec_id, a.p, b.e),
a{r} AS MATERIALIZED (SELECT vec_id, p, min(struct_pack(d := d, e := e)) AS least FROM d{r} GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""
b{r + 1} AS MATERIALIZED (SELECT o.p, o.e, o.j, coalesce(n.x, o.x) AS x FROM b{r} o LEFT JOIN
  (SELECT s.p, a.least.e AS e, s.j, CAST((sum(s.x) - ((sum(s.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
   FROM places s JOIN a{r} a ON a.vec_id = s.vec_id AND a.p = s.p GROUP BY s.p, a.least.e, s.j) n ON n.p = o.p AND n.e = o.e AND n.j = o.j)""")
    return "WITH" + ",".join(steps) + f""",
coded AS (SELECT vec_id, string_agg(printf('%02x', least.e), '' ORDER BY p) AS code, CAST(sum(least.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) FROM b{rounds}) AS codebooks_sha256
FROM coded c JOIN kept k USING (vec_id)"""
