"""Row-wise application of a function on text slices, as Spark user code: ``mapInArrow`` with added columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from funnelspark.llm.ragged import slices


def append(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]], make: Callable[[], Callable[[pa.Array], list]]) -> DataFrame:
    """``df`` with new columns computed from whole texts.

    ``make()`` runs once per task and returns a function from a text column slice to one array per new field.
    A field whose name (in any case) ``df`` already has replaces that column.
    """
    new = {name.lower() for name, _ in fields}
    base = df.select(*[df[c] for c in df.columns if c.lower() not in new or c == text])
    schema = T.StructType([f for f in base.schema.fields if f.name.lower() not in new] + [T.StructField(n, t) for n, t in fields])
    kept = [i for i, f in enumerate(base.schema.fields) if f.name.lower() not in new]
    arrow = [to_arrow_type(t) for _, t in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for part in slices(batch, text):
                made = [pa.array(v, type=t) for v, t in zip(f(part.column(text)), arrow)]
                names = [part.schema.names[i] for i in kept] + [n for n, _ in fields]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), *made], names=names)

    return base.mapInArrow(run, schema)


def keep_rows(df: DataFrame, text: str, make: Callable[[], Callable[[pa.Array], object]]) -> DataFrame:
    """The rows of ``df`` for which the function says true; all columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(f(part.column(text)), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def fold_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo ``modulus``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents outside the held-out fold.

    The ids with the smallest hashes are taken, so reruns agree; ``most`` also bounds the broadcast side (some 16 bytes a row).
    A repeated label row counts once, at its largest label; labels other than 0 and 1 are left out.
    """
    ids = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold_of(F.col("doc_id"), modulus) != held))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
