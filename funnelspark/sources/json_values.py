"""Boundaries of JSON values in text files, found in Spark tasks: no file is one string.

Files are read line by line, in splits. A file that is one split is cut into values as its lines stream by. Of a file in several splits
it is first counted whether most lines are values of their own; then each line stands for itself, wherever it is read, and a large
line file is spread over as many tasks as it has splits. The lines of any other large file are brought back into their order and streamed.

A value may take part of a line, a line, or many; the elements of an outermost array are values. What does not parse is kept as text.
"""

from __future__ import annotations

import json
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.session import materialise

_STRING = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"')
_SPACE = re.compile(r"[ \t\r\n\ufeff]*")
_decode = json.JSONDecoder().raw_decode
_VALUES = "path string, text string, broken boolean"
_HELD = 4 << 20


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" \t"))


class Splitter:
    """Cuts the lines of one file into (text, broken) as they come; holds the lines of one unfinished value.

    A value that is not closed ends where a line of its own indent begins a new one without ``[``, ``,`` or ``:`` before it, so
    a cut-off line costs no more than itself.
    """

    def __init__(self) -> None:
        self.held: list[str] = []
        self.depth, self.indent, self.array, self.last = 0, 0, False, ""

    def feed(self, line: str) -> Iterator[tuple[str, bool]]:
        todo = deque([line])
        while todo:
            line = todo.popleft()
            head = line.strip(" \t\r\n\ufeff")
            if not head:
                continue
            opens = head[0] in "{["
            if self.held and opens and _indent(line) == self.indent and self.last not in "[,:":
                again = yield from self._cut()
                todo.extendleft(reversed([*again, line]))
                continue
            if not self.held:
                self.indent = _indent(line)
            bare = _STRING.sub("", line)
            self.depth += bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]")
            self.held.append(line)
            self.last = head[-1]
            if self.depth <= (1 if self.array or self.held[0].lstrip(" \t\ufeff")[0] == "[" else 0):
                again = yield from self._cut()
                todo.extendleft(reversed(again))

    def finish(self) -> Iterator[tuple[str, bool]]:
        while self.held:
            for line in (yield from self._cut()):
                yield from self.feed(line)
        if self.array:
            yield "[", True
        self.array = False

    def _cut(self) -> Iterator[tuple[str, bool]]:
        """Values of the held lines; returns the lines after a broken one, which begin anew."""
        text, at, again = "\n".join(self.held), 0, []
        self.held, self.last = [], ""
        while True:
            at = _SPACE.match(text, at).end()
            if at == len(text):
                break
            if self.array and text[at] in ",]":
                self.array = text[at] == ","
                at += 1
            elif not self.array and text[at] == "[":
                self.array = True
                at += 1
            else:
                try:
                    end = _decode(text, at)[1]
                except (ValueError, RecursionError):
                    rest = text[at:].split("\n")
                    new = next((i for i, x in enumerate(rest) if i and x.lstrip(" \t")[:1] in ("{", "[") and _indent(x) == self.indent), len(rest))
                    yield "\n".join(rest[:new]), True
                    again = rest[new:]
                    break
                yield text[at:end], False
                at = end
        self.depth = int(self.array)
        return again


def line_values(line: str) -> Iterator[tuple[str, bool]]:
    """Values of a line that stands for itself."""
    one = Splitter()
    yield from one.feed(line)
    yield from one.finish()


def _stands_alone(line: str) -> bool:
    at = _SPACE.match(line).end()
    if line[at : at + 1] not in ("{", "["):
        return False
    while at < len(line):
        try:
            at = _SPACE.match(line, _decode(line, at)[1]).end()
        except (ValueError, RecursionError):
            return False
    return True


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of the batches, one at a time: a line may be long, and a batch of them as Python objects takes several times its bytes."""
    for batch in batches:
        for row in zip(*batch.columns):
            yield tuple(x.as_py() for x in row)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, bool]]:
    """(path, text, broken) of rows (path, value, whole): in order where ``whole``, each line for itself elsewhere."""
    path, machine = None, Splitter()
    for p, line, whole in _lines(batches):
        if p != path:
            for v in machine.finish():
                yield path, *v
            path, machine = p, Splitter()
        for v in machine.feed(line) if whole else line_values(line):
            yield p, *v
    for v in machine.finish():
        yield path, *v


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values in batches of about ``_HELD`` characters: what a task holds depends neither on its lines nor on their number in a batch."""
    out, held = [], 0
    for row in _found(batches):
        out.append(row)
        held += len(row[0]) + len(row[1])
        if held >= _HELD:
            yield _batch(out)
            out, held = [], 0
    yield _batch(out)


def _batch(rows: list[tuple[str, str, bool]]) -> pa.RecordBatch:
    path, text, broken = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(text, pa.string()), pa.array(broken, pa.bool_())], names=["path", "text", "broken"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, lines that stand alone less the others), one a path and batch."""
    for batch in batches:
        alone = Counter()
        for p, line in _lines(iter([batch])):
            if line.strip():
                alone[p] += 1 if _stands_alone(line) else -1
        yield pa.RecordBatch.from_arrays([pa.array(alone.keys(), pa.string()), pa.array(alone.values(), pa.int64())], names=["path", "alone"])


def text_lines(source) -> DataFrame:
    """Lines of text files with their file, split and size: of ``spark.read`` or ``spark.readStream`` with its options set, already loaded."""
    m = "_metadata."
    return source.select(
        F.col(m + "file_path").alias("path"), "value", F.col(m + "file_block_start").alias("start"), F.col(m + "file_block_length").alias("length"), F.col(m + "file_size").alias("size")
    )


def split_values(lines: DataFrame) -> DataFrame:
    """(path, text, broken) of every JSON value of :func:`text_lines`, in batches. Large files are counted first, in a job of its own."""
    spark = lines.sparkSession
    whole = (F.col("start") == 0) & (F.col("length") >= F.col("size"))
    # No file below the opening cost is ever split; the size is known to the scan, which leaves such files out.
    least = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.openCostInBytes")))
    parts = lines.where((F.col("size") > least) & ~whole).select("path", "value").mapInArrow(_count, "path string, alone long")
    mixed = materialise(parts.groupBy("path").agg(F.sum("alone").alias("alone")).where("alone <= 0").select(F.col("path").alias("_path")), "json-mixed")
    if mixed.isEmpty():
        return lines.select("path", "value", whole.alias("whole")).mapInArrow(_split, _VALUES)
    rest = lines.join(mixed, F.col("path") == F.col("_path"), "left_anti").select("path", "value", whole.alias("whole"))
    order = lines.withColumn("_at", F.monotonically_increasing_id()).join(mixed, F.col("path") == F.col("_path"), "left_semi")
    order = order.repartition("path").sortWithinPartitions("path", "start", "_at").select("path", "value", F.lit(True).alias("whole"))
    return rest.mapInArrow(_split, _VALUES).union(order.mapInArrow(_split, _VALUES))


def read_values(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, text, broken) of every JSON value of the files."""
    return split_values(text_lines(spark.read.text(paths)))
