"""JSON values cut out of text files of any size, where each input split is read on its own.

A file is read as fragments that end with a closing brace, so that even an array on a single line is split
like lines are. Two passes over the fragments:

1. Each split says what it does to the state of a reader that comes by: whether it ends inside a string, how
   many open brackets it closes and which it leaves open, for either case of its start. These summaries
   are combined in order of the splits of a file, which gives every split the state it starts in.
2. Each split cuts its values. What begins in one split and ends in a later one leaves as pieces and is
   put together by its number.

The reader recovers from malformed text. A raw line end ends a string. An opening bracket that follows
neither a bracket that opens nor a comma nor a colon, or that stands where an object needs a key, begins
a new value, whatever was open.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.operators.keyed import measure

#: A longer value is not put together; its lines are looked at one by one.
MAX_VALUE = 64 << 20

_TOKEN = re.compile(rb'"(?:[^"\\\n]|\\[^\n])*("|\n)?|[\[\]{}]')
_STRING_REST = re.compile(rb'(?:[^"\\\n]|\\[^\n])*("|\n)?')
_BLANK = b" \t\r\n\xef\xbb\xbf"
_BRACKETS = {ord("["): "[", ord("{"): "{"}


class Scanner:
    """Follows the brackets and strings of consecutive fragments; ``stack`` holds what is open.

    ``inherited`` entries at the bottom of the stack were opened before this split. The first pass does not
    know them, so nothing here depends on their kind but what is cut as a value.
    """

    def __init__(self, in_string: bool = False, stack: str = "", unknown: bool = False):
        self.in_string, self.stack, self.unknown = in_string, list(stack), unknown
        self.inherited, self.closed, self.cleared = len(stack), 0, False
        self.before = b"}"[0]

    def _opens_value(self, data: bytes, at: int) -> bool:
        """Whether the bracket at ``at`` begins a new value at the top."""
        place = at - 1
        while place >= 0 and data[place] in _BLANK:
            place -= 1
        before = data[place] if place >= 0 else self.before
        if before not in b"[,:":
            return True
        return before == b","[0] and len(self.stack) > self.inherited and self.stack[-1] == "{"

    def tokens(self, data: bytes) -> Iterator[tuple[int, str]]:
        """(place, what) of a fragment: 'open' and 'close' of a value that is cut, 'reset' where a new one begins."""
        start = 0
        if self.in_string:
            rest = _STRING_REST.match(data)
            start = rest.end()
            self.in_string = rest.group(1) is None and start == len(data)
        for token in _TOKEN.finditer(data, start):
            at = token.start()
            sign = data[at]
            if sign == 34:
                self.in_string = token.group(1) is None and token.end() == len(data)
            elif sign in _BRACKETS:
                if self._opens_value(data, at):
                    self.stack, self.inherited, self.closed, self.cleared = [], 0, 0, True
                    yield at, "reset"
                if sign == 123 and self.stack in ([], ["["]) and not self.unknown:
                    yield at, "open"
                self.stack.append(_BRACKETS[sign])
            elif self.stack:
                self.stack.pop()
                self.inherited = min(self.inherited, len(self.stack))
                if sign == 125 and self.stack in ([], ["["]) and not self.unknown:
                    yield at, "close"
            elif self.unknown and not self.cleared:
                self.closed += 1
        if data.strip(_BLANK):
            self.before = data.rstrip(_BLANK)[-1]

    def inside(self) -> bool:
        return bool(self.stack) and (self.stack[0] == "{" or self.stack[1:2] == ["{"])


def cut(fragments: Iterator[bytes], scanner: Scanner, whole: bool) -> Iterator[tuple[str, bytes]]:
    """(kind, text) of the fragments of a split.

    Kinds: 'value', 'broken' (a value that another one interrupts), 'junk' (what is between values), 'end' (the
    rest of a value from an earlier split), 'all' (a split inside such a value), 'start' (a value that goes
    on). ``whole`` says that nothing follows, so that what is open is broken.
    """
    parts: list[bytes] = []
    open_, earlier = scanner.inside(), scanner.inside()

    def done(kind: str) -> tuple[str, bytes]:
        nonlocal earlier
        found = ("end" if earlier else kind, b"".join(parts))
        parts.clear()
        earlier = False
        return found

    for data in fragments:
        last = 0
        for at, what in scanner.tokens(data):
            if what == "reset" and open_:
                parts.append(data[last:at])
                yield done("broken")
                open_, last = False, at
            elif what == "open" and not open_:
                parts.append(data[last:at])
                yield done("junk")
                open_, last = True, at
            elif what == "close" and open_:
                parts.append(data[last : at + 1])
                yield done("value")
                open_, last = False, at + 1
        parts.append(data[last:])
    if not open_:
        yield done("junk")
    elif earlier:
        yield "all", b"".join(parts)
    else:
        yield "broken" if whole else "start", b"".join(parts)


def chunks_of(body: bytes) -> list[tuple[str, bytes]]:
    """Values, broken values and lines of junk of a text that is there as a whole."""
    found: list[tuple[str, bytes]] = []
    for kind, text in cut(iter([body]), Scanner(), True):
        found += _junk(text) if kind == "junk" else [(kind, text)]
    return found


def _said(junk: bytes) -> bytes:
    """What stands between values besides blanks, commas and brackets of lists."""
    return junk.strip(b" \t\r\n,[]}\xef\xbb\xbf")


def _junk(text: bytes) -> list[tuple[str, bytes]]:
    return [("junk", line) for line in map(_said, text.split(b"\n")) if line]


def _fragments(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Texts up to each closing brace, with their file, split and order."""
    read = spark.read.option("lineSep", "}").text(path if isinstance(path, str) else list(path))
    place = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_block_start", "block"), ("file_size", "bytes"))]
    return read.select(*place, F.col("value").cast("binary").alias("text"))


def _by_split(batches: Iterator) -> Iterator:
    """(file, block, bytes, iterator of texts) for each split of a task; rows of a split lie together."""
    from itertools import groupby

    def rows() -> Iterator:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    for key, group in groupby(rows(), key=lambda r: r[:-1]):
        yield key, (r[-1] for r in group)


def _summaries(fragments: DataFrame) -> DataFrame:
    """For each split: bytes read, and for a start outside (0) or inside (1) a string what it does to the state."""

    def summarize(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for (file, block, size), texts in _by_split(batches):
            scanners, read = [Scanner(False, unknown=True), Scanner(True, unknown=True)], 0
            for text in texts:
                read += len(text) + 1
                for scanner in scanners:
                    for _ in scanner.tokens(text + b"}"):
                        pass
            effects = [(s.in_string, s.cleared, s.closed, "".join(s.stack)) for s in scanners]
            rows = [[file], [block], [size], [read]] + [[e[i]] for e in effects for i in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, _ARROW(pa), strict=True)], _NAMES)

    return fragments.mapInArrow(summarize, _SUMMARY)


_FOUND = "file string, block long, kind string, text string"

#: A split that starts inside a value.
_INSIDE = "stack LIKE '{%' OR stack LIKE '[{%'"

_SUMMARY = (
    "file string, block long, bytes long, read long, ends_0 boolean, cleared_0 boolean, closed_0 long, opened_0 string, "
    "ends_1 boolean, cleared_1 boolean, closed_1 long, opened_1 string"
)
_NAMES = [part.split()[0] for part in _SUMMARY.split(",")]


def _ARROW(pa) -> list:
    own = [pa.bool_(), pa.bool_(), pa.int64(), pa.string()]
    return [pa.string(), pa.int64(), pa.int64(), pa.int64(), *own, *own]


def _starts(summaries: DataFrame) -> DataFrame:
    """State at the start of each split: in_string, stack; and whether its last text lacks the brace.

    The splits of a file are folded in their order; a file has few of them.
    """
    state = "struct<in_string boolean, stack string>"
    splits = summaries.groupBy("file", "bytes").agg(
        F.sum("read").alias("total"),
        F.sort_array(F.collect_list(F.struct("block", *_NAMES[4:]))).alias("splits"),
    )

    def after(was, split):
        def pick(name: str):
            return F.when(was["in_string"], split[f"{name}_1"]).otherwise(split[f"{name}_0"])

        left = F.substring(was["stack"], F.lit(1), F.greatest(F.length(was["stack"]) - pick("closed"), F.lit(0)).cast("int"))
        return F.struct(pick("ends").alias("in_string"), F.concat(F.when(pick("cleared"), F.lit("")).otherwise(left), pick("opened")).alias("stack"))

    zero = F.struct(F.lit(False).alias("in_string"), F.lit("").alias("stack")).cast(state)

    def folded(split):
        earlier = F.filter("splits", lambda s: s["block"] < split["block"])
        return F.struct(split["block"].alias("block"), F.aggregate(earlier, zero, lambda was, s: after(was, s).cast(state)).alias("was"))

    # Without its last brace a file has a byte less than was counted; a mark at its start is not counted.
    open_end = (F.col("total") - F.col("bytes")).isin(1, -2)
    last = F.element_at("splits", -1)["block"]
    each = splits.select("file", open_end.alias("open_end"), last.alias("last"), F.explode(F.transform("splits", folded)).alias("s"))
    return each.select("file", "s.block", "s.was.in_string", "s.was.stack", (F.col("s.block") == F.col("last")).alias("is_last"), "open_end")


def json_chunks(spark: SparkSession, path: str | Sequence[str], max_value: int = MAX_VALUE) -> DataFrame:
    """Values and broken texts of all files below ``path``: file, text, is_value.

    No file, line or array has to fit one task. A value does, up to ``max_value`` bytes; of a longer one,
    and of what was never closed, the lines come out one by one as broken texts.
    """
    split_values = F.coalesce(F.sum(F.expr(_INSIDE).cast("int")), F.lit(0)).alias("inside")
    starts = measure(_starts(_summaries(_fragments(spark, path))), "json-splits", split_values)
    side = F.broadcast(starts.frame) if starts.fits_broadcast else starts.frame
    rows = _fragments(spark, path).withColumn("at", F.monotonically_increasing_id()).join(side, ["file", "block"])
    if not starts.fits_broadcast:
        rows = rows.repartition("file", "block").sortWithinPartitions("file", "block", "at")

    def values(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for (file, block, in_string, stack, is_last, open_end), texts in _by_split(batches):

            def closed(texts: Iterator[bytes] = texts, unclosed: bool = is_last and open_end) -> Iterator[bytes]:
                held = None
                for text in texts:
                    if held is not None:
                        yield held + b"}"
                    held = text
                if held is not None:
                    yield held if unclosed else held + b"}"

            found: list[tuple[str, bytes]] = []
            size = 0
            for kind, text in cut(closed(), Scanner(in_string, stack), is_last):
                if kind == "junk":
                    found += _junk(text)
                elif kind in ("start", "all", "end") or len(text) <= max_value:
                    found.append((kind, text))
                else:
                    found += [("broken", line) for line in text.split(b"\n") if _said(line)]
                size += len(text)
                if size > 8 << 20:
                    yield batch_of(file, block, found, pa)
                    found, size = [], 0
            if found:
                yield batch_of(file, block, found, pa)

    def batch_of(file: str, block: int, found: list[tuple[str, bytes]], pa):
        count = len(found)
        texts = [text.decode("utf-8", "replace") for _, text in found]
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * count), pa.array([block] * count, pa.int64()), pa.array([kind for kind, _ in found]), pa.array(texts, pa.string())],
            ["file", "block", "kind", "text"],
        )

    columns = ["file", "block", "in_string", "stack", "is_last", "open_end", "text"]
    found = rows.select(*columns).mapInArrow(values, _FOUND)
    whole = found.where(F.col("kind").isin("value", "broken", "junk")).select("file", "text", (F.col("kind") == "value").alias("is_value"))
    if not starts.seen["inside"]:
        return whole
    # Pieces are looked for in the files that have any, and stored, as they are few.
    parted = starts.frame.where(_INSIDE).select("file").distinct()
    some = rows.join(F.broadcast(parted) if starts.fits_broadcast else parted, "file", "left_semi")
    if not starts.fits_broadcast:
        some = some.repartition("file", "block").sortWithinPartitions("file", "block", "at")
    pieces = some.select(*columns).mapInArrow(values, _FOUND)
    return whole.unionByName(_joined(measure(pieces.where(F.col("kind").isin("start", "all", "end")), "json-pieces").frame, max_value))


def _joined(found: DataFrame, max_value: int) -> DataFrame:
    """Values that lie in several splits, put together from their pieces.

    Of a split at most one piece is the end of an earlier value or all of the split, and one a start, which comes
    after it; so the number of starts so far names the value.
    """
    pieces = found.withColumn("later", (F.col("kind") == "start").cast("int"))
    order = Window.partitionBy("file").orderBy("block", "later")
    numbered = pieces.withColumn("value", F.sum("later").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = numbered.groupBy("file", "value").agg(F.sum(F.length("text")).alias("size"), F.bool_or(F.col("kind") == "end").alias("ended"))
    known = numbered.join(sizes, ["file", "value"])
    short = known.where(F.col("size") <= max_value).groupBy("file", "value").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "later", "text"))), lambda p: p["text"]), "").alias("text"),
        F.first("ended").alias("is_value"),
    )
    lines = known.where(F.col("size") > max_value).select("file", F.explode(F.split("text", "\n")).alias("text"))
    lines = lines.where(F.length(F.btrim("text", F.lit(" \t\r\n,[]}"))) > 0).select("file", "text", F.lit(False).alias("is_value"))
    return short.select("file", "text", "is_value").unionByName(lines)
