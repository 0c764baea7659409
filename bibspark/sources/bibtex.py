"""BibTeX as a distributed source and sink.

Files are read with ``spark.read.text`` and a record separator, so one large
file is split over many tasks; the records are taken apart by column
expressions. Record order is ``(src_rank, pos)``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.batches import by_bytes
from ..functions.clean import DEFAULTS, with_defaults
from ..functions.text import ascii_fold, strip_blanks
from ..operators.numbering import with_ref_id

FIELDS = list(DEFAULTS)

#: Before an "@" that opens a record.
_RECORDS = r"(?U)(?=@\w+\s*\{)"


def read_bib(
    spark: SparkSession,
    paths: str | list[str],
    mode: str = "line",
    close: str = "exact",
    stray_at: str = "keep",
) -> DataFrame:
    """Records of BibTeX files; the order of ``paths`` is the source order.

    Columns: ``source_file, src_rank, pos, entry_type, cite_key, fields``.

    * ``mode="line"`` takes one field per line from ``@article`` records; a
      record ends at a line that is ``}`` (``close="exact"``) or starts with it
      (``close="prefix"``).
    * ``mode="brace"`` takes records of any type with values that may span
      lines; values are folded to ASCII. ``stray_at="drop"`` leaves out records
      with an ``@`` in their body, ``"keep"`` retains them.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if mode == "line":
        one = lambda p: _line_entries(_chunks(spark, p, "\n@article"), close)
    elif mode == "brace":
        one = lambda p: _brace_entries(_whole_chunks(_chunks(spark, p, "\n@")), stray_at)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    parts = [
        one(path).select(
            F.lit(path).alias("source_file"),
            F.lit(rank).alias("src_rank"),
            F.struct("file", "block", "row", "part").alias("pos"),
            "entry_type",
            "cite_key",
            "fields",
        )
        for rank, path in enumerate(paths)
    ]
    return reduce(DataFrame.unionByName, parts)


def _chunks(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Separated text with its place: file, split start, row counter inside the scan."""
    return (
        spark.read.option("lineSep", separator)
        .text(path)
        .select(
            F.col("value").alias("text"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def _whole_chunks(chunks: DataFrame) -> DataFrame:
    """Rejoin text that was cut at a line-start ``@`` which opens no record.

    Such strays are looked for first; without any, the scan is used as it is.
    Strays that open a split belong to the last record of an earlier split, so
    they are gathered per split and handed back along the order of the splits.
    """
    opens = F.col("text").rlike(r"(?U)^\s*@?\w+\s*\{")
    at_head = (F.col("block") == 0) & F.col("text").startswith("@")
    marked = chunks.withColumn("_opens", opens)
    text = F.when(at_head, F.col("text")).otherwise(F.concat(F.lit("@"), F.col("text")))
    strays = marked.filter(~F.col("_opens"))
    if strays.limit(1).isEmpty():
        return chunks.withColumn("text", text)

    split = ["file", "block"]
    bounds = marked.groupBy(*split).agg(
        F.min("row").alias("first_row"),
        F.max(F.when(F.col("_opens"), F.col("row"))).alias("last_open"),
    )
    by_split = Window.partitionBy(*split).orderBy("row")
    islands = (
        strays.withColumn("_island", F.col("row") - F.row_number().over(by_split))
        .groupBy(*split, "_island")
        .agg(
            F.min("row").alias("_from"),
            F.concat_ws(
                "",
                F.transform(
                    F.array_sort(F.collect_list(F.struct("row", "text"))),
                    lambda s: F.concat(F.lit("\n@"), s["text"]),
                ),
            ).alias("_tail"),
        )
    )
    placed = islands.join(bounds, split)
    inside = placed.filter(F.col("_from") > F.col("first_row")).select(
        *split, (F.col("_from") - 1).alias("row"), "_tail"
    )
    along = Window.partitionBy("file").orderBy("block")
    has_open = F.col("last_open").isNotNull().cast("int")
    groups = bounds.withColumn("_seen", F.sum(has_open).over(along)).withColumn("_has", has_open)
    leading = (
        placed.filter(F.col("_from") == F.col("first_row"))
        .select(*split, "_tail")
        .join(groups, split)
        .withColumn("_owner", F.col("_seen") - F.col("_has"))
        .groupBy("file", "_owner")
        .agg(F.concat_ws("", F.array_sort(F.collect_list(F.struct("block", "_tail")))["_tail"]).alias("_tail"))
    )
    owners = groups.filter("_has = 1").select("file", "block", "last_open", F.col("_seen").alias("_owner"))
    across = leading.join(owners, ["file", "_owner"]).select(
        *split, F.col("last_open").alias("row"), "_tail"
    )
    # a record can own both a tail in its split and one from later splits
    tails = (
        inside.withColumn("_n", F.lit(0))
        .unionByName(across.withColumn("_n", F.lit(1)))
        .groupBy(*split, "row")
        .agg(F.concat_ws("", F.array_sort(F.collect_list(F.struct("_n", "_tail")))["_tail"]).alias("_tail"))
    )
    whole = marked.filter("_opens").join(tails, [*split, "row"], "left")
    return whole.select(
        F.concat(text, F.coalesce("_tail", F.lit(""))).alias("text"), "file", "block", "row"
    )


def _line_entries(chunks: DataFrame, close: str) -> DataFrame:
    cut = F.col("text")
    opened = F.when(cut.rlike(r"^\w*\s*\{"), F.concat(F.lit("@article"), cut)).otherwise(cut)
    pieces = chunks.select(
        "file", "block", "row",
        F.posexplode(F.split(opened, r"\r?\n(?=\s*@article)")).alias("part", "piece"),
    )
    lines = F.transform(F.split("piece", r"\r\n|\r|\n"), strip_blanks)
    ends = F.transform(
        "_lines", lambda line: (line == "}") if close == "exact" else line.startswith("}")
    )
    parsed = (
        pieces.withColumn("_lines", lines)
        .filter(F.col("_lines")[0].startswith("@article"))
        .withColumn("_end", F.array_position(ends, True))
        .filter("_end > 1")
        .withColumn("_pairs", F.filter(F.slice("_lines", F.lit(2), F.col("_end") - 2), lambda x: x.contains("=")))
        .withColumn("_keys", F.transform("_pairs", lambda x: strip_blanks(F.substring_index(x, "=", 1))))
        .withColumn("_values", F.transform("_pairs", _line_value))
    )
    return parsed.select(
        "file", "block", "row", "part",
        F.lit("article").alias("entry_type"),
        F.nullif(F.regexp_extract(F.col("_lines")[0], r"^@article\w*\s*\{\s*([^,\s]+)", 1), F.lit("")).alias("cite_key"),
        _last_wins(F.col("_keys"), F.col("_values")).alias("fields"),
    )


def _line_value(line: Column) -> Column:
    value = strip_blanks(F.regexp_replace(line, "(?s)^[^=]*=", ""))
    return F.btrim(F.btrim(F.btrim(value, F.lit(",")), F.lit("{}")), F.lit(","))


def _fields(body: str) -> list[tuple[str, str]]:
    """``(name, value)`` of each field in the body of a record.

    A value in braces ends with the brace that closes its first one, at any depth; a quoted one with the next
    quote; any other, and one that is never closed, at a comma or line end.
    """
    opened, closed = [], {}
    for brace in re.finditer(r"[{}]", body):
        if brace[0] == "{":
            opened.append(brace.start())
        elif opened:
            closed[opened.pop()] = brace.start()
    name, found, at = re.compile(r"(\w+)\s*=\s*"), [], 0
    while field := name.search(body, at):
        at = field.end()
        first = body[at : at + 1]
        end = closed.get(at, -1) if first == "{" else body.find('"', at + 1) if first == '"' else -1
        if end >= 0:
            value, at = body[at + 1 : end], end + 1
        else:
            value = re.compile(r"[^,\n]*").match(body, at)[0]
            at += len(value)
            if not value and body[at - 1] == "=":
                continue
            value = value.strip()
        found.append((field[1].lower(), value))
    return found


_PLACE = ["file", "block", "row", "part"]
_ENTRY = "entry_type string, cite_key string, stray boolean, pairs array<struct<k:string,v:string>>"


def parse_entry(piece: str) -> tuple:
    """Type, key, whether an ``@`` stands in the body, and the fields; nulls where no record with a key and a comma begins."""
    kind, brace, inside = piece.partition("{")
    key, comma, body = inside.partition(",")
    kind, key = kind.removeprefix("@").rstrip(), key.strip()
    if brace and comma and piece.startswith("@") and re.fullmatch(r"\w+", kind) and key and not re.search(r"\s", key):
        return kind.lower(), key, "@" in body, [{"k": k, "v": v} for k, v in _fields(body)]
    return None, None, None, None


_PAIRS = pa.list_(pa.struct([("k", pa.string()), ("v", pa.string())]))
_ARROW = pa.schema([("entry_type", pa.string()), ("cite_key", pa.string()), ("stray", pa.bool_()), ("pairs", _PAIRS)])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of pieces with their place; some at a time, as each may be long."""
    for batch in batches:
        for part in by_bytes(batch, "piece"):
            found = [parse_entry(p) for p in part.column("piece").to_pylist()]
            some = [i for i, e in enumerate(found) if e[0] is not None]
            columns = [pa.array([found[i][k] for i in some], field.type) for k, field in enumerate(_ARROW)]
            yield pa.RecordBatch.from_arrays([*part.drop_columns(["piece"]).take(pa.array(some, pa.int64())).columns, *columns], [*_PLACE, *_ARROW.names])


def _brace_entries(chunks: DataFrame, stray_at: str) -> DataFrame:
    if stray_at not in ("keep", "drop"):
        raise ValueError(f"unknown stray_at {stray_at!r}")
    pieces = chunks.select(*_PLACE[:3], F.posexplode(F.split("text", _RECORDS)).alias("part", "piece"))
    places = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in _PLACE)
    entries = pieces.mapInArrow(_entries, f"{places}, {_ENTRY}")
    if stray_at == "drop":
        entries = entries.filter("NOT stray")
    values = F.transform("pairs", lambda p: ascii_fold(p["v"]))
    return entries.select(*_PLACE, "entry_type", "cite_key", _last_wins(F.col("pairs.k"), values).alias("fields"))


def _last_wins(keys: Column, values: Column) -> Column:
    """Map of the pairs; of repeated keys the last counts."""
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    last = F.filter(
        pairs, lambda p, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), p["k"])
    )
    return F.map_from_entries(last)


def publications(entries: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Flat publication table; a field that no record has is a null column."""
    return entries.select(
        "source_file", "src_rank", "pos", F.col("cite_key").alias("id"),
        *[F.col("fields")[f].alias(f) for f in fields or FIELDS],
    )


def abstracts(entries: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """Records with an abstract: first non-empty of ``abstract``, ``abstr``, ``summary``."""
    found = F.coalesce(
        *[F.nullif(F.col("fields")[name], F.lit("")) for name in ("abstract", "abstr", "summary")]
    )
    out = entries.withColumn("abstract", found).filter(F.col("abstract").isNotNull())
    if drop_unknown:
        out = out.filter(~F.contains(F.lower("abstract"), F.lit("unknown")))
    return out


def corpus_counts(entries: DataFrame) -> DataFrame:
    """Number of records and of records with an abstract, in one pass."""
    found = F.coalesce(
        *[F.nullif(F.col("fields")[name], F.lit("")) for name in ("abstract", "abstr", "summary")]
    )
    return entries.agg(F.count(F.lit(1)).alias("n_entries"), F.count(found).alias("n_abstracts"))


def bib_lines(df: DataFrame, prefix: str = "ref", fields: list[str] | None = None) -> DataFrame:
    """One text row per numbered record (``idx``), in BibTeX form."""
    fields = fields or FIELDS
    rows = with_defaults(df, fields)
    body = [
        F.concat(F.lit(f"  {f} = {{"), F.col(f), F.lit("},\n" if f != fields[-1] else "}\n"))
        for f in fields
    ]
    head = F.concat(F.lit(f"@article{{{prefix}"), F.col("idx").cast("string"), F.lit(",\n"))
    return rows.select("idx", F.concat(head, *body, F.lit("}\n")).alias("value"))


def write_bib(
    df: DataFrame, path: str, order: list | None = None, fields: list[str] | None = None
) -> int:
    """Write records as BibTeX text in ``order``; returns the number written.

    Keys are ``ref0..n-1`` in output order. Pass ``fields`` for the short form.
    With no rows nothing is written. Duplicates go through
    :func:`write_duplicates`.
    """
    numbered = df if "idx" in df.columns else with_ref_id(df, order or ["src_rank", "pos"])
    if numbered.limit(1).isEmpty():
        return 0
    lines = bib_lines(numbered, "ref", fields)
    ordered = lines.repartitionByRange("idx").sortWithinPartitions("idx").select("value")
    ordered.write.mode("overwrite").text(path)
    return numbered.agg(F.max("idx")).first()[0] + 1


def write_duplicates(dups: DataFrame, files: DataFrame, path: str) -> None:
    """Write the duplicate report: records ``ref_dup{i}`` with ``shared_files``.

    ``dups`` holds one row per repeated title (``idx, key``, fields), ``files``
    the list of sources in pieces of bounded length (``key, piece, n_pieces,
    shared_files``). Each piece is a line of its own inside the field, so a
    title shared by any number of records never becomes one huge row.
    """
    head = bib_lines(dups, "ref_dup")
    opening = F.concat(F.regexp_replace("value", r"\}\n\}\n$", "},\n"), F.lit("  shared_files = {"))
    tail = F.when(F.col("piece") == F.col("n_pieces") - 1, F.lit("}\n}\n")).otherwise(F.lit(", "))
    pieces = files.join(dups.select("key", "idx"), "key").join(
        head.withColumn("piece", F.lit(0).cast("long")), ["idx", "piece"], "left"
    )
    lines = pieces.select(
        "idx", "piece",
        F.concat(F.when(F.col("piece") == 0, opening).otherwise(""), "shared_files", tail).alias("value"),
    )
    ordered = (
        lines.repartitionByRange("idx", "piece").sortWithinPartitions("idx", "piece").select("value")
    )
    ordered.write.mode("overwrite").text(path)
