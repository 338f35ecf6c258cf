"""S2 by byte ranges: keyed JSON whose documents are larger than a task.

A published year is one document, ``{"value": {"<key>": {record}, ...}}``.
Read as text whose lines end at ``}``, a file is cut by Spark into splits of
``spark.sql.files.maxPartitionBytes`` that begin behind some ``}``, wherever
that stands: between records, inside one, or inside a string. Two passes find
the records without ever holding a document:

1. ``outlines``: each split is summed up for both cases, that it begins
   inside a string or not: whether it ends inside one, how many of the objects
   open at its start it closes, and which it leaves open. A few bytes a split
   reach the driver, which chains them: now every split's start is known.
2. ``chunks``: each split gives the texts of its records, from their key to
   their ``}``. A record that a split border cuts (borders fall into records
   only where these hold objects or strings with braces) is put together from
   its pieces.

The texts are parsed by Spark's JSON parser in ``FAILFAST`` mode. A document
that ends early or goes on too long, a file with other text, and a document
without an object ``value`` are errors that name the file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import MapType, StringType, StructType, _parse_datatype_string

from tallystar.functions.paths import file_year
from tallystar.shipping import ship_package

VALUE = "value"
_BLANK = " \t\r\n"
_ESCAPED = re.compile(r"\\.", re.DOTALL)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|\{', re.DOTALL)


@dataclass
class State:
    """Where a position stands: in a string or not, and the open objects from the
    outside in, each with its key and whether it has held an object ``value``."""
    in_string: bool = False
    stack: list[list] = field(default_factory=list)


def _openings(fragment: str, in_string: bool) -> tuple[list[str | None], bool]:
    """The keys of the objects that ``fragment`` (text up to a ``}``) opens outside of strings
    (None where none stands before the brace), and whether it ends in a string."""
    parts = (_ESCAPED.sub("", fragment) if "\\" in fragment else fragment).split('"')
    keys: list[str | None] = []
    for i in range(int(in_string), len(parts), 2):
        if "{" in parts[i]:
            before, *more = parts[i].split("{")
            keys.append(parts[i - 1] if i and before.strip() == ":" else None)
            keys += [None] * (len(more) - 1)
    return keys, in_string ^ (len(parts) % 2 == 0)


class Outline:
    """What a split does to any state it may begin in, for one of the two cases."""

    def __init__(self, in_string: bool):
        self.in_string = in_string
        self.closed = 0                       # objects open at the start that the split closes
        self.held_value = [False]             # whether those (innermost first) get an object ``value``
        self.opened: list[list] = []          # objects it leaves open

    def feed(self, fragment: str) -> None:
        keys, self.in_string = _openings(fragment, self.in_string)
        for key in keys:
            if key == VALUE:
                if self.opened:
                    self.opened[-1][1] = True
                else:
                    self.held_value[-1] = True
            self.opened.append([key, False])
        if not self.in_string:
            if self.opened:
                self.opened.pop()
            else:
                self.closed += 1
                self.held_value.append(False)

    def row(self) -> dict:
        return {"in_string": self.in_string, "closed": self.closed, "held_value": self.held_value,
                "keys": [k for k, _ in self.opened], "held": [h for _, h in self.opened]}


def after(start: State, outline: Mapping) -> State:
    """The state behind a split that begins in ``start``."""
    stack = [list(x) for x in start.stack]
    for k, held in enumerate(outline["held_value"]):
        if k:
            stack = stack[:-1]
        if stack:
            stack[-1][1] |= held
    return State(outline["in_string"], stack + [[k, h] for k, h in zip(outline["keys"], outline["held"])])


class Chunks:
    """The record texts of one split that begins in a known state.

    ``feed`` yields ("", text) for whole texts; ("head", text) and ("tail",
    text) are the pieces at the split's borders, ("middle", text) is a split
    that lies inside one record."""

    def __init__(self, file: str, start: State):
        self.file, self.state = file, State(start.in_string, [list(x) for x in start.stack])
        self.text: list[str] = []
        self.first = False                    # no record of the object ``value`` yet
        self.kind = "head" if self._inside() else ""

    def _in_value(self) -> bool:
        return len(self.state.stack) >= 2 and self.state.stack[1][0] == VALUE

    def _inside(self) -> bool:
        return self._in_value() and (len(self.state.stack) > 2 or self.state.in_string)

    def feed(self, fragment: str, closes: bool) -> Iterator[tuple[str, str]]:
        stack, began_in_string = self.state.stack, self.state.in_string
        if not stack and fragment.partition("{")[0].strip(_BLANK + "\ufeff,[]"):
            raise ValueError(f"text outside of a document: {self.file}")
        collecting, begin = self._in_value(), 0
        keys, self.state.in_string = _openings(fragment, began_in_string)
        for n, key in enumerate(keys):
            if len(stack) == 1 and key == VALUE:  # its records begin behind this brace
                stack[0][1] = collecting = self.first = True
                begin = _end_of_opening(fragment, n, began_in_string)
            stack.append([key, False])
        if collecting:
            self.text.append(fragment[begin:])
        if not closes or self.state.in_string:
            if collecting and closes:
                self.text.append("}")
            return
        if not stack:
            raise ValueError(f"a document closes more objects than it opens: {self.file}")
        if collecting:
            if len(stack) > 2:
                self.text.append("}")
            if len(stack) <= 3:
                yield from self._done()
        if len(stack) == 1 and not stack[0][1]:
            raise ValueError(f"a document has no object '{VALUE}': {self.file}")
        stack.pop()

    def _done(self) -> Iterator[tuple[str, str]]:
        text = "".join(self.text) if self.kind else self._entry()
        if text or self.kind:
            yield self.kind, text
        self.text, self.kind, self.first = [], "", False

    def _entry(self) -> str:
        """The collected text without the comma that parts it from the entry before."""
        text = "".join(self.text).strip(_BLANK)
        if text and text.startswith(",") == self.first or text == ",":
            raise ValueError(f"records are not parted by one comma: {self.file}")
        return text[1:] if text.startswith(",") else text

    def end(self) -> Iterator[tuple[str, str]]:
        """The rest of the split, where it ends inside a record."""
        if self.kind:
            yield "middle", "".join(self.text)
        elif self._inside():
            yield "tail", self._entry()


def _end_of_opening(fragment: str, n: int, in_string: bool) -> int:
    """The place behind the n-th brace (from 0) that ``fragment`` opens outside of strings."""
    at = _STRING_END.match(fragment).end() if in_string else 0
    braces = [m.end() for m in _TOKEN.finditer(fragment, at) if m.group() == "{"]
    return braces[n]


# ----------------------------------------------------------------------- Spark
def _fragments(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    meta = F.col("_metadata")
    return (spark.read.option("lineSep", "}").option("recursiveFileLookup", True)
            .text([paths] if isinstance(paths, str) else list(paths))
            .select("value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), meta["file_size"].alias("size")))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], Iterator[str]]]:
    """The fragments of each split of a task, which come in order."""
    rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("file", "block", "size", "value"))))
    row = next(rows, None)
    while row is not None:
        split = row[:3]

        def texts() -> Iterator[str]:
            nonlocal row
            while row is not None and row[:3] == split:
                yield row[3]
                row = next(rows, None)
        yield split, texts()


_CASE = "struct<in_string: boolean, closed: int, held_value: array<boolean>, keys: array<string>, held: array<boolean>>"


def outlines(fragments: DataFrame) -> DataFrame:
    """(file, block, size, bytes, outside, inside): one row per split."""
    schema = f"file string, block long, size long, bytes long, outside {_CASE}, inside {_CASE}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block, size), texts in _by_split(batches):
            cases, n = (Outline(False), Outline(True)), 0
            for t in texts:
                n += len(t.encode()) + 1
                for c in cases if block else cases[:1]:
                    c.feed(t)
            yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "size": size, "bytes": n,
                                               "outside": cases[0].row(), "inside": cases[1].row()}], schema=arrow)

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return fragments.mapInArrow(run, schema)


def split_starts(rows: Sequence[Mapping]) -> dict[tuple[str, int], tuple[State, bool | None]]:
    """For each split (file, block) the state it begins in, and whether its last
    fragment is the end of the file rather than the text before a ``}`` (None: where no object is open)."""
    out: dict[tuple[str, int], tuple[State, bool | None]] = {}
    by_file: dict[str, list[Mapping]] = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        by_file.setdefault(r["file"], []).append(r)
    for file, splits in by_file.items():
        state = State()
        # a last text without a brace counts one byte that the file does not have; a byte order
        # mark (3 bytes) is not counted; the size of a compressed file tells nothing
        open_end = {0: False, -3: False, 1: True, -2: True}.get(sum(r["bytes"] for r in splits) - splits[-1]["size"])
        for r in splits:
            out[file, r["block"]] = (state, open_end if r is splits[-1] else False)
            state = after(state, r["inside" if state.in_string else "outside"])
    return out


def chunks(fragments: DataFrame, starts: Mapping[tuple[str, int], tuple[State, bool | None]], last: Mapping[str, int]) -> DataFrame:
    """(file, block, kind, text): the record texts of every split, and pieces of cut ones."""
    context = fragments.sparkSession.sparkContext
    held = context.broadcast((dict(starts), dict(last)))  # a few bytes a split

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, final = held.value
        for (file, block, _), texts in _by_split(batches):
            if (file, block) not in begin:
                raise ValueError(f"file changed while it was read: {file}")
            state, open_end = begin[file, block]
            scan, made = Chunks(file, state), []
            fragment = next(texts, None)
            while fragment is not None:
                following = next(texts, None)
                made += scan.feed(fragment, closes=following is not None or (bool(scan.state.stack) if open_end is None else not open_end))
                fragment = following
                if len(made) >= 2000:
                    yield _batch(file, block, made)
                    made = []
            if block == final[file] and (scan.state.stack or scan.state.in_string):
                raise ValueError(f"a document ends early: {file}")
            yield _batch(file, block, made + list(scan.end()))

    return fragments.mapInArrow(run, "file string, block long, kind string, text string")


def _batch(file: str, block: int, made: list[tuple[str, str]]) -> pa.RecordBatch:
    n = len(made)
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()),
         pa.array([k for k, _ in made], pa.string()), pa.array([t for _, t in made], pa.string())],
        names=["file", "block", "kind", "text"])


def read_keyed_json_ranges(spark: SparkSession, paths: str | Sequence[str], record_schema: StructType,
                           key_col: str = "key", keep_year: bool = False, keep_file: bool = False) -> DataFrame:
    """As ``read_keyed_json``, whatever the size of a document and its line ends: a file is
    read by as many tasks as it has splits. One job that scans the files runs before the plan is returned."""
    ship_package(spark)
    fragments = _fragments(spark, paths)
    rows = outlines(fragments).collect()  # one row a split
    starts = split_starts(rows)
    last: dict[str, int] = {}
    for r in rows:
        last[r["file"]] = max(r["block"], last.get(r["file"], 0))
    texts = chunks(fragments, starts, last)
    whole = texts.where(F.col("kind") == "").select("file", "text")
    if any(Chunks(f, s).kind for (f, _), (s, _) in starts.items()):
        # a record begins with a tail; the middles behind it and the next head belong to it
        order = F.struct("block", (F.col("kind") == "tail").cast("int").alias("late"))
        begun = F.sum((F.col("kind") == "tail").cast("int")).over(Window.partitionBy("file").orderBy(order))
        joined = (texts.where(F.col("kind") != "").withColumn("order", order).withColumn("record", begun)
                  .groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("order", "text"))).alias("p"))
                  .select("file", F.array_join("p.text", "").alias("text")))
        whole = whole.unionByName(joined)
    parsed = F.from_json(F.concat(F.lit("{"), "text", F.lit("}")),
                         MapType(StringType(), record_schema), {"mode": "FAILFAST"})
    year = [file_year(path=F.col("file")).alias("Year")] if keep_year else []
    file = ["file"] if keep_file else []
    exploded = whole.select(*year, *file, F.explode(parsed).alias(key_col, "_rec"))
    return exploded.select(key_col, *[F.col(f"_rec.`{f.name}`").alias(f.name) for f in record_schema.fields],
                           *(["Year"] if keep_year else []), *file)
